"""Registered queries: each one runs an operator over the whole of the given tables."""

import hashlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import config, schemas
from casewatch.functions import ids, numbers, severity, text
from casewatch.operators import (
    categorize,
    context,
    counts,
    evaluate,
    explain,
    flatten,
    incremental,
    inference,
    lsh,
    products,
    ranking,
    vector_store,
    vectors,
)
from casewatch.operators import holt_winters as hw
from casewatch.operators import isolation_forest as forest
from casewatch.operators import timeseries as ts
from casewatch.plans import detection, diagnostics
from casewatch.session import tune
from casewatch.sources import bindings as b
from casewatch.sources import files
from casewatch.sources.workspace import fresh_path, staged
from casewatch.streaming import ingest as stream

QUERIES = {}
FIXED_WEIGHTS = (0.3, 0.05, 0.1)
LIST_SEPARATOR = "|"
BATCH_BUCKETS = 4096
REFUSED_BATCH = 5


def query(fn):
    """Register a query; dates leave as ISO text."""

    def run(spark, sf_dir):
        tune(spark)
        df = fn(spark, sf_dir)
        return df.select(
            *[
                F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
                for f in df.schema.fields
            ]
        )

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# ---- shared inputs


def daily(spark, sf):
    return counts.daily_counts(b.case_mentions(spark, sf, serious_only=True))


def filled(spark, sf):
    return ts.gap_fill(daily(spark, sf))


WHOLE_PERIOD = (None, None)


def named_reports(spark, sf):
    return flatten.scan_reports(b.case_reports(spark, sf), b.TRACKED, *WHOLE_PERIOD)


def summaries(spark, sf):
    first_named = flatten.scan_first_named(b.case_reports(spark, sf), b.TRACKED, *WHOLE_PERIOD)
    return flatten.flatten_reports(ranking.dedup_reports(first_named, b.TRACKED, then_by=["receivedate"]))


def categorized(spark, sf):
    return categorize.with_rule_labels(summaries(spark, sf), b.REACTION_RULES)


def zscores(spark, sf):
    return detection.zscore_table(daily(spark, sf))


def flagged(spark, sf):
    return detection.high_confidence(zscores(spark, sf), "is_anomaly_zscore")


def labelled_context(spark, sf):
    """Nearest mentions of every flagged day first, then the reports of those alone."""
    mentions = b.case_mentions(spark, sf).select("safetyreportid", "drug", F.col("date").alias("received"))
    wanted = staged(flagged(spark, sf).select("drug", *diagnostics.FIGURES), "anomalies")
    nearest = staged(context.context_top_n(wanted, mentions), "nearest")
    reports = b.case_reports(spark, sf, ids=nearest.select("safetyreportid"))
    return diagnostics.labelled_nearest(nearest, reports, b.REACTION_RULES)


def explanations(spark, sf):
    return explain.explain_extractive(labelled_context(spark, sf))


def scores(spark, sf):
    context_rows = staged(labelled_context(spark, sf), "context")
    return diagnostics.explain_and_score(context_rows)[1]


def round6(column):
    return numbers.round_half_even(column, 6)


def joined(column):
    return F.array_join(column, LIST_SEPARATOR)


# ---- scans, projections, filters


@query
def scan_reports(spark, sf):
    period = ("1996-01-01", "1998-12-31")
    reports = flatten.scan_reports(b.case_reports(spark, sf, *period), b.TRACKED, *period)
    return reports.select("safetyreportid", "drug", "receivedate")


@query
def reports_mentioning_drug(spark, sf):
    reports = b.case_reports(spark, sf)
    return reports.filter(flatten.mentions_drug(F.col("patient.drug"), "economy")).select(
        "safetyreportid", "receivedate"
    )


@query
def daily_counts(spark, sf):
    return daily(spark, sf)


@query
def daily_counts_from_reports(spark, sf):
    """The same counts from the nested reports, by phrase match on their product names."""
    return counts.daily_counts(counts.mentions_of(named_reports(spark, sf)))


@query
def counts_summary(spark, sf):
    return counts.counts_summary(daily(spark, sf))


@query
def union_counts(spark, sf):
    events = counts.daily_counts(b.event_mentions(spark, sf))
    return counts.union_all([daily(spark, sf), events], "drug string, date date, count bigint", spark)


@query
def csv_roundtrip(spark, sf):
    table = daily(spark, sf).withColumn("tags", F.array("drug", F.lit('a "quoted", tag'), F.lit("it's")))
    path = fresh_path(spark, "csv")
    files.write_csv(table, path)
    return files.read_csv(spark, path, table.schema).withColumn("tags", joined("tags"))


@query
def read_labels_as_strings(spark, sf):
    template = b.labelled_documents(spark, sf)
    path = fresh_path(spark, "labels")
    files.write_csv(template, path)
    back = files.read_csv_as_strings(spark, path, template.schema)
    return back.withColumn("text_digest", F.sha2("patient_summary_text", 256)).drop("patient_summary_text")


@query
def write_counts(spark, sf):
    """Counts as one CSV folder per drug, read back with the drug from the folder name."""
    path = fresh_path(spark, "counts")
    files.write_csv(daily(spark, sf), path, partition_by="drug")
    return files.read_csv(spark, path, schemas.DAILY_COUNTS)


@query
def write_reports(spark, sf):
    """Flat reports as Parquet by drug, read back."""
    path = fresh_path(spark, "reports")
    files.write_parquet(summaries(spark, sf), path, partition_by="drug")
    return spark.read.schema(schemas.PATIENT_SUMMARIES).parquet(path)


@query
def optional_scan(spark, sf):
    """Progress over a result table that does not exist yet."""
    done = files.optional_parquet(spark, fresh_path(spark, "missing"), schemas.FAITHFULNESS)
    return counts.progress(done, daily(spark, sf))


@query
def distinct_values(spark, sf):
    return counts.distinct_values(daily(spark, sf), "drug")


# ---- flattening and its parts


@query
def flatten_reports(spark, sf):
    return flatten.flatten_reports(named_reports(spark, sf))


@query
def summary_text(spark, sf):
    return summaries(spark, sf).select("safetyreportid", "patient_summary_text")


@query
def array_names(spark, sf):
    reports = b.case_reports(spark, sf)
    names = text.names_of(F.col("patient.reaction"), "reactionmeddrapt")
    return reports.select(
        "safetyreportid", F.size(names).cast("bigint").alias("n_names"), joined(names).alias("names")
    )


@query
def decode_sex(spark, sf):
    reports = b.case_reports(spark, sf)
    return reports.select("safetyreportid", flatten.decode_sex(F.col("patient.patientsex")).alias("sex"))


@query
def seriousness_flags(spark, sf):
    flags = flatten.seriousness_flags()
    return b.case_reports(spark, sf).select("safetyreportid", joined(flags).alias("flags"))


@query
def dedup_reports(spark, sf):
    mentions = b.case_mentions(spark, sf)
    return ranking.dedup_reports(mentions, b.TRACKED).select("safetyreportid", "drug", "date")


@query
def cap_per_drug(spark, sf):
    reports = b.case_mentions(spark, sf)
    return ranking.cap_per_drug(reports, config.PER_DRUG_LIMIT, date_column="date").select(
        "drug", "date", "safetyreportid"
    )


@query
def stratified_cap(spark, sf):
    return ranking.stratified_sample(b.case_mentions(spark, sf), 350).select("drug", "safetyreportid")


@query
def stratified_even(spark, sf):
    mentions = staged(ranking.dedup_reports(b.case_mentions(spark, sf), b.TRACKED), "mentions")
    return ranking.stratified_even(mentions, config.LABEL_SAMPLE).select("drug", "safetyreportid")


@query
def date_formats(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    ymd = text.yyyymmdd(F.col("o_orderdate"))
    dirty = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("x"), ymd)).otherwise(ymd)
    return orders.select("o_orderkey", ymd.alias("ymd"), text.parse_yyyymmdd(dirty).alias("parsed"))


@query
def normalize_array(spark, sf):
    tags = F.array(F.concat(F.lit("\t"), F.upper("p_name"), F.lit(" \n")), F.col("p_brand"))
    return b.table(spark, sf, "part").select("p_partkey", joined(text.normalize_array(tags)).alias("tags"))


@query
def join_tags(spark, sf):
    tags = F.when(F.col("p_size") > 5, F.array("p_type", "p_brand"))
    return b.table(spark, sf, "part").select("p_partkey", text.join_tags(tags).alias("tags"))


@query
def parse_list_column(spark, sf):
    words = F.split("p_name", " ")
    stored = (
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("']")))
        .when(F.col("p_size") % 3 == 1, F.col("p_name"))
        .otherwise(F.concat(F.lit("["), F.col("p_name")))
    )
    parsed = text.parse_list_text(stored)
    return b.table(spark, sf, "part").select(
        "p_partkey", F.size(parsed).cast("bigint").alias("n"), joined(parsed).alias("items")
    )


@query
def entity_id(spark, sf):
    day = F.col("date").cast("string")
    params = F.create_map(
        F.lit("search"), F.concat(F.col("drug"), F.lit(" "), day), F.lit("count"), F.lit("receivedate")
    )
    return daily(spark, sf).select(
        "drug",
        "date",
        ids.entity_id(F.col("drug"), ids.timestamp_text(F.col("date"))).alias("explanation_id"),
        ids.entity_id(F.col("drug"), day).alias("score_id"),
        ids.request_signature(params).alias("signature"),
    )


def _raw_severity():
    """Loose severity texts of mention rows, by seriousness and drug."""
    by_drug = {
        "ECONOMY": "NON-SERIOUS",
        "LARGE": " unknown ",
        "MEDIUM": "non-serious/other",
        "PROMO": "Severe",
        "SMALL": "odd",
        "STANDARD": "mild",
    }
    chain = F.when(F.col("serious") == "1", F.lit("\tHospitalization \n"))
    for drug, value in by_drug.items():
        chain = chain.when(F.col("drug") == drug, F.lit(value))
    return chain


@query
def normalize_severity_lookup(spark, sf):
    rows = b.case_mentions(spark, sf).withColumn("raw", _raw_severity())
    return rows.select(
        "safetyreportid", "drug", severity.severity_by_lookup(F.col("raw")).alias("severity")
    )


@query
def normalize_severity_ladder(spark, sf):
    flags = joined(flatten.seriousness_flags())
    raw = F.when(F.col("seriousnessdisabling") == "1", F.concat(F.lit("non-serious/other and "), flags)).when(
        flags == "", F.when(F.col("patient.patientsex").isNotNull(), "Non-Serious/other")
    ).otherwise(F.upper(flags))
    return b.case_reports(spark, sf).select(
        "safetyreportid", severity.severity_by_ladder(raw).alias("severity")
    )


# ---- incremental work, labels


def _label_rows(spark, sf):
    """Several labels per report, one batch per drug."""
    return b.case_mentions(spark, sf).select(
        F.col("drug").alias("batch_id"),
        F.col("safetyreportid").cast("bigint").alias("position"),
        F.col("safetyreportid").alias("id"),
        F.lower("drug").alias("primary_organ_system"),
        _raw_severity().alias("severity"),
    )


def _first_labels(spark, sf):
    return incremental.first_labels(_label_rows(spark, sf), severity.severity_by_lookup)


@query
def merge_labels(spark, sf):
    reports = summaries(spark, sf).select("safetyreportid", "drug", "receivedate")
    return incremental.merge_labels(reports, _first_labels(spark, sf))


@query
def normalized_count(spark, sf):
    """Labels changed by the lookup, and by the ladder where "odd" labels are missing ones."""
    first = _first_labels(spark, sf)
    some = F.nullif(F.col("severity_before"), F.lit("odd"))
    return first.agg(
        explain.normalized_count(some, severity.severity_by_ladder(some)).alias("n_changed_by_ladder"),
        explain.normalized_count(F.col("severity_before"), F.col("severity")).alias("n_changed"),
        F.count("*").alias("n"),
    )


@query
def pending_anti(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", "source")
    return incremental.pending(docs, b.table(spark, sf, "labels"), "doc_id")


@query
def progress_status(spark, sf):
    done = b.table(spark, sf, "labels").select("doc_id")
    total = b.table(spark, sf, "documents").select("doc_id")
    return counts.progress(done, total).withColumn("percent", round6(F.col("percent")))


def _batches(spark, sf):
    rows = summaries(spark, sf).select("safetyreportid", "patient_summary_text")
    return incremental.make_batches(rows, config.CATEGORIZE_BATCH, BATCH_BUCKETS)


@query
def make_batches(spark, sf):
    return _batches(spark, sf).select(
        "bucket",
        "batch",
        F.col("n_items").cast("bigint").alias("n_items"),
        F.sha2(incremental.request_json(F.col("items")), 256).alias("request_digest"),
    )


@query
def batch_id(spark, sf):
    return _batches(spark, sf).select("batch_id", F.col("n_items").cast("bigint").alias("n_items"))


def _label_batches(spark, sf):
    label = lambda i: F.struct(
        i["id"].alias("id"), F.length(i["patient_summary_text"]).cast("bigint").alias("text_length")
    )
    return _batches(spark, sf).select("batch_id", F.transform("items", label).alias("reports"))


@query
def explode_label_batches(spark, sf):
    rows = incremental.explode_label_batches(_label_batches(spark, sf))
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query
def done_ids(spark, sf):
    return incremental.done_ids(_label_batches(spark, sf))


def _responses(spark, sf):
    """Model answers, one per order: good, cut off, or without the expected key."""
    key = F.col("o_orderkey").cast("string")
    good = F.concat(
        F.lit('{"reports": [{"id": "'),
        key,
        F.lit('", "primary_organ_system": "hepatic", "severity": "'),
        F.lower("o_orderpriority"),
        F.lit('", "category_tags": ["a", "b"]}]}'),
    )
    response = (
        F.when(F.col("o_orderstatus") == "P", good)
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit('{"reports": [{"id": "'), key))
        .otherwise(F.lit('{"items": []}'))
    )
    return b.table(spark, sf, "orders").select(key.alias("safetyreportid"), response.alias("response"))


@query
def parse_model_json(spark, sf):
    return incremental.parse_label_batches(_responses(spark, sf)).select(
        "safetyreportid",
        F.coalesce(F.size("reports"), F.lit(-1)).cast("bigint").alias("n_reports"),
        F.element_at("reports", 1)["severity"].alias("severity"),
        "reject_reason",
    )


@query
def json_results_scan(spark, sf):
    """Label batches written as JSON and read back strictly."""
    path = fresh_path(spark, "results")
    labels = F.transform(
        "items", lambda i: F.struct(i["id"].alias("id"), F.lit("mild").alias("severity"))
    )
    _batches(spark, sf).select("batch_id", labels.alias("reports")).write.json(path)
    schema = T.StructType([T.StructField("batch_id", T.StringType()), *schemas.LABEL_BATCH.fields])
    rows = incremental.explode_label_batches(files.read_json_results(spark, path, schema, per_file=False))
    return rows.select("batch_id", F.col("position").cast("bigint").alias("position"), "id", "severity")


@query
def json_tolerant_scan(spark, sf):
    """Stored model answers read tolerantly: labels of the readable ones and what was skipped."""
    path = fresh_path(spark, "answers")
    _responses(spark, sf).select("response").write.text(path)
    good, skipped = files.read_json_results_tolerant(
        spark, path, schemas.LABEL_BATCH, per_file=False, glob="*.txt"
    )
    labels = good.select(F.explode("reports").alias("r")).select(
        F.lit("label").alias("kind"), F.col("r.id").alias("id"), F.col("r.severity").alias("severity")
    )
    cut_id = F.regexp_extract("content", r'"id": "(\d+)', 1)
    return labels.unionByName(
        skipped.select(F.lit("skipped").alias("kind"), cut_id.alias("id"), F.lit(None).cast("string").alias("severity"))
    )


@query
def incremental_run(spark, sf):
    """Two capped runs that append their results: the second takes further reports."""
    path = fresh_path(spark, "done")
    rows = staged(ranking.dedup_reports(b.case_mentions(spark, sf), b.TRACKED), "mentions")
    schema = rows.select("drug", "safetyreportid").schema
    for _ in range(2):
        done = files.optional_parquet(spark, path, schema)
        todo = incremental.pending_sample(rows, done, per_drug=300)
        files.append_results(todo.select("drug", "safetyreportid"), path)
    return spark.read.schema(schema).parquet(path)


@query
def categorize_rules(spark, sf):
    labels = categorize.categorize_rules(summaries(spark, sf), b.REACTION_RULES)
    return labels.withColumn("category_tags", joined("category_tags"))


@query
def categorize_mapinpandas(spark, sf):
    reports = summaries(spark, sf).select("safetyreportid", "patient_summary_text", "reactions", "drugs_involved")
    load = categorize.keyword_model(b.REACTION_RULES, id_column="id")
    labels = inference.succeeded(categorize.categorize(reports, load))
    return labels.withColumn("category_tags", joined("category_tags"))


def _refusing_model():
    """A model that fails on texts with a listed word, to exercise failure isolation."""

    def model(batch):
        for value in batch["text"]:
            if any(word in value.lower() for word in b.TOXIC_WORDS):
                raise ValueError("refused")
        return batch.assign(n=batch["text"].str.len())[["id", "n"]]

    return model


def _digest_model(*columns):
    """A model that answers with the digest of the text it got, so that SQL can tell what it was given."""

    def load():
        def model(batch):
            digests = [hashlib.sha256(value.encode()).hexdigest() for value in batch["text"]]
            answer = {"entity_id": batch["entity_id"], "score": 0.5, "dominant_organ_systems": [["x"]] * len(batch)}
            answer |= {c: digests for c in columns}
            known = ("summary", "dominant_severity", "notable_pattern", "confidence_caveat", "justification")
            return pd.DataFrame({c: None for c in known if c not in answer} | answer, index=batch.index)

        return model

    return load


def _length_model():
    """An embedding by the length of a text and its number of blanks; it gives no vector to empty texts."""

    def model(batch):
        texts = batch["document"]
        vectors_ = [[float(len(t)), float(t.count(" "))] for t in texts]
        return pd.DataFrame({"id": batch["id"], "embedding": vectors_})

    return model


@query
def inference_errors(spark, sf):
    """A refused text fails exactly the batch that it is in."""
    docs = b.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("safetyreportid"), "text")
    batches = incremental.make_batches(docs, REFUSED_BATCH, BATCH_BUCKETS, payload=("text",))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    return inference.infer_batches(batches, lambda: _refusing_model(), schema)


@query
def explain_model(spark, sf):
    """Explanations by a model, which gets the figures and the numbered reports of a flagged day."""
    asked = staged(diagnostics.to_explain(staged(labelled_context(spark, sf), "context")), "asked")
    rows = inference.succeeded(diagnostics.explain_with(asked, _digest_model("summary"), 4))
    return rows.select("drug", "date", "count", "zscore", "n_context_reports", "summary", joined("dominant_organ_systems").alias("organs"))


@query
def judge_model(spark, sf):
    """Scores by a model, which gets the numbered sources and the claim of an explanation."""
    found = staged(labelled_context(spark, sf), "context")
    asked = diagnostics.to_judge(explain.explain_extractive(found), context.context_bundle(found))
    rows = inference.succeeded(diagnostics.judge_with(staged(asked, "asked"), _digest_model("justification"), 4))
    return rows.select("entity_id", "drug", "date", "score", "justification")


@query
def embed_model(spark, sf):
    """A store built by a pluggable embedding; labelled documents are stored already."""
    reports = _document_rows(spark, sf)
    done = b.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("safetyreportid"))
    path = fresh_path(spark, "store")
    for part in (reports.join(done, "safetyreportid", "left_semi"), reports):
        stored = vector_store.current(spark, path)
        vector_store.upsert(spark, path, vectors.build_vectors(part, stored, load=lambda: _length_model()))
    built = vector_store.current(spark, path)
    component = lambda i: F.element_at("embedding", i).cast("double")
    return built.select("id", "drug", component(1).alias("length"), component(2).alias("blanks"))


# ---- series


@query
def gap_fill(spark, sf):
    return filled(spark, sf)


@query
def rolling_mean_7(spark, sf):
    return filled(spark, sf).select("drug", "date", round6(ts.rolling_mean()).alias("mean_7"))


@query
def rolling_std_7(spark, sf):
    return filled(spark, sf).select("drug", "date", round6(ts.rolling_std()).alias("std_7"))


@query
def rolling_zscore(spark, sf):
    scored = ts.with_zscore(ts.with_expected(filled(spark, sf)))
    return scored.select("drug", "date", round6(F.col("raw_z")).alias("zscore"))


@query
def residuals(spark, sf):
    return zscores(spark, sf).select("drug", "date", "expected_count", "residual", "zscore")


@query
def zscore_flags(spark, sf):
    scored = ts.with_zscore(ts.with_expected(filled(spark, sf)))
    return scored.select("drug", "date", ts.zscore_flag().alias("is_anomaly_zscore"))


@query
def warmup_mask(spark, sf):
    scored = ts.with_zscore(ts.with_expected(filled(spark, sf)))
    return scored.select(
        "drug",
        "date",
        ts.zscore_flag().alias("flag_before"),
        ts.after_warmup(ts.zscore_flag()).alias("flag_after"),
    )


@query
def holt_winters_fixed(spark, sf):
    fitted = hw.holt_winters(filled(spark, sf), FIXED_WEIGHTS)
    return fitted.select("drug", "date", numbers.round_half_even(F.col("fitted"), 4).alias("fitted"))


@query
def holt_winters_fit(spark, sf):
    fitted = hw.holt_winters(filled(spark, sf))
    return fitted.select("drug", "date", "count", numbers.round_half_even(F.col("fitted"), 4).alias("fitted"))


@query
def expected_with_fallback(spark, sf):
    series = ts.gap_fill(counts.daily_counts(b.event_mentions(spark, sf)))
    expected = ts.with_expected(hw.holt_winters(series), "fitted")
    return expected.select("drug", "date", "count", round6(F.col("expected")).alias("expected"))


@query
def iforest_features(spark, sf):
    features = ts.forest_features(filled(spark, sf))
    return features.select(
        "drug",
        "date",
        F.col("count"),
        *[round6(F.col(c)).alias(c) for c in ("roll_mean_7", "roll_std_7", "dow_sin", "dow_cos")],
    )


def _forest_features(spark, sf):
    return staged(forest.with_chunks(ts.forest_features(filled(spark, sf))), "features")


@query
def isolation_sample(spark, sf):
    """Which days each tree of a drug is grown on."""
    return forest.samples(_forest_features(spark, sf)).select("drug", "tree", "date")


@query
def isolation_nodes(spark, sf):
    """The forest as a table of nodes."""
    nodes = forest.forest_nodes(forest.grow_forest(_forest_features(spark, sf)))
    return nodes.withColumn("threshold", round6(F.col("threshold")))


@query
def isolation_forest(spark, sf):
    flags = forest.forest_flags(forest.isolation_scores(_forest_features(spark, sf)))
    return flags.select("drug", "date", "count", "isolation_forest_score", "is_anomaly_isoforest")


@query
def anomaly_table(spark, sf):
    return detection.anomaly_table(daily(spark, sf))


@query
def anomaly_table_totals(spark, sf):
    """Per drug: days, reports and flagged days of the anomaly table."""
    flags = ("is_anomaly_zscore", "is_anomaly_isoforest", "is_anomaly_high_confidence")
    return detection.anomaly_table(daily(spark, sf)).groupBy("drug").agg(
        F.count("*").alias("n_days"),
        F.sum("count").alias("total_reports"),
        *[F.count_if(c).cast("bigint").alias(c.replace("is_anomaly", "n")) for c in flags],
    )


@query
def anomaly_direction(spark, sf):
    return zscores(spark, sf).select("drug", "date", ts.direction(F.col("zscore")).alias("direction"))


@query
def high_confidence(spark, sf):
    return flagged(spark, sf)


@query
def anomaly_totals(spark, sf):
    totals = detection.anomaly_totals(zscores(spark, sf), "is_anomaly_zscore")
    return totals.withColumn("drug", F.coalesce("drug", F.lit("ALL")))


# ---- vectors


def _query_vectors(spark, sf, n=5):
    """The query arguments: the n lowest vector ids."""
    rows = b.table(spark, sf, "embeddings").orderBy("vec_id").select("embedding").limit(n).collect()
    return [r["embedding"] for r in rows]


def _hits(hits):
    return hits.select(
        F.col("query").cast("bigint").alias("query"),
        "id",
        round6(F.col("similarity")).alias("similarity"),
        F.col("rank").cast("bigint").alias("rank"),
    )


@query
def l2_normalize(spark, sf):
    unit = vectors.l2_normalize(F.transform("embedding", lambda x: x * 3))
    rows = b.vector_rows(spark, sf).select("id", unit.alias("u"))
    norm = F.sqrt(F.aggregate("u", F.lit(0.0), lambda s, x: s + x * x))
    return rows.select(
        "id",
        F.size("u").cast("bigint").alias("dim"),
        round6(norm).alias("norm"),
        round6(F.element_at("u", 1)).alias("first"),
        round6(F.element_at("u", -1)).alias("last"),
    )


@query
def knn_topk(spark, sf):
    return _hits(vectors.search(b.vector_rows(spark, sf), _query_vectors(spark, sf)))


@query
def knn_filtered(spark, sf):
    where = {"primary_organ_system": "3"}
    return _hits(vectors.search(b.vector_rows(spark, sf), _query_vectors(spark, sf), where=where))


def _near(spark, sf, where=None):
    rows, path = b.vector_rows(spark, sf), fresh_path(spark, "index")
    queries = _query_vectors(spark, sf)
    normals = lsh.planes(len(queries[0]))
    lsh.write_index(rows, path, normals)
    return _hits(lsh.search(rows, lsh.read_index(spark, path), queries, normals, where=where))


@query
def knn_lsh(spark, sf):
    return _near(spark, sf)


@query
def knn_lsh_filtered(spark, sf):
    return _near(spark, sf, {"primary_organ_system": "3"})


@query
def vector_upsert(spark, sf):
    """Label 3 is stored again with label 'updated'; label 4 comes in under new ids."""
    store = b.vector_rows(spark, sf)
    changed = store.filter("primary_organ_system = '3'").withColumn(
        "primary_organ_system", F.lit("updated")
    )
    added = store.filter("primary_organ_system = '4'").withColumn("id", F.concat(F.lit("new-"), "id"))
    return incremental.upsert(store, changed.unionByName(added)).select(
        "id", "primary_organ_system", round6(F.element_at("embedding", 1).cast("double")).alias("first")
    )


@query
def vector_store_upsert(spark, sf):
    """The same in a store: written, upserted twice, written whole, upserted once more."""
    path = fresh_path(spark, "store")
    rows = vectors.vector_metadata(b.vector_rows(spark, sf)).withColumn("document", F.lit("")).select(*schemas.VECTORS.names)
    changed = rows.filter("primary_organ_system = '3'").withColumn("primary_organ_system", F.lit("updated"))
    added = rows.filter("primary_organ_system = '4'").withColumn("id", F.concat(F.lit("new-"), "id"))
    vector_store.upsert(spark, path, rows)
    vector_store.upsert(spark, path, changed.withColumn("primary_organ_system", F.lit("first")))
    vector_store.compact(spark, path)
    vector_store.upsert(spark, path, changed.unionByName(added))
    return vector_store.current(spark, path).select(
        "id", "primary_organ_system", round6(F.element_at("embedding", 1).cast("double")).alias("first")
    )


def _document_rows(spark, sf):
    return b.spread_table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("safetyreportid"),
        F.col("text").alias("patient_summary_text"),
        F.when(F.col("lang") != "de", F.col("source")).alias("drug"),
        F.col("lang").alias("primary_organ_system"),
        F.array("lang", "source").alias("category_tags"),
        F.col("n_chars").alias("receivedate"),
    )


@query
def vector_metadata(spark, sf):
    rows = vectors.vector_metadata(_document_rows(spark, sf))
    return rows.select("safetyreportid", *vectors.METADATA)


def _embedded(spark, sf):
    rows = vectors.vector_metadata(_document_rows(spark, sf)).withColumnsRenamed(
        {"safetyreportid": "id", "patient_summary_text": "document"}
    )
    model = vectors.fit_embedding(rows.select("document"))
    return vectors.embed(rows, model), model


@query
def embed_documents(spark, sf):
    docs, _ = _embedded(spark, sf)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return docs.select(
        "id",
        F.size("embedding").cast("bigint").alias("dim"),
        numbers.round_half_even(norm, 3).alias("norm"),
    )


@query
def vector_build(spark, sf):
    """The store holds the labelled documents; the others are embedded and added."""
    docs, model = _embedded(spark, sf)
    done = b.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"))
    path = fresh_path(spark, "store")
    vector_store.upsert(spark, path, docs.join(done, "id", "left_semi").select(*schemas.VECTORS.names))
    vector_store.upsert(spark, path, vectors.build_vectors(_document_rows(spark, sf), vector_store.current(spark, path), model))
    return vector_store.current(spark, path).select("id", "drug", "primary_organ_system", F.size("embedding").cast("bigint").alias("dim"))


# ---- context, explanations, evaluation


@query
def context_interval_join(spark, sf):
    reports = b.case_mentions(spark, sf).select("safetyreportid", "drug", F.col("date").alias("received"))
    pairs = context.context_reports(flagged(spark, sf).select("drug", "date"), reports)
    return pairs.select(
        "drug", "date", "safetyreportid", "received", F.col("distance").cast("bigint").alias("distance")
    )


@query
def context_topn(spark, sf):
    reports = b.case_mentions(spark, sf).select("safetyreportid", "drug", F.col("date").alias("received"))
    wanted = staged(flagged(spark, sf).select("drug", "date"), "anomalies")
    return context.context_top_n(wanted, reports).select(
        "drug", "date", F.col("position").cast("bigint").alias("position"), "safetyreportid", "received"
    )


@query
def context_bundle(spark, sf):
    return context.context_bundle(labelled_context(spark, sf)).drop("texts")


@query
def stats_block(spark, sf):
    rows = staged(labelled_context(spark, sf), "context")
    figures = rows.filter("position = 1").select("drug", *diagnostics.FIGURES)
    bundles = context.context_bundle(rows)
    return figures.join(bundles, ["drug", "date"]).select(
        "drug", "date", context.stats_block().alias("stats")
    )


@query
def explain_extractive(spark, sf):
    rows = explanations(spark, sf)
    return rows.withColumn("dominant_organ_systems", joined("dominant_organ_systems"))


@query
def claim_text(spark, sf):
    return explanations(spark, sf).select("drug", "date", context.claim_text().alias("claim"))


@query
def faithfulness(spark, sf):
    return scores(spark, sf).select("drug", "date", round6(F.col("score")).alias("score"))


@query
def faithfulness_summary(spark, sf):
    summary = evaluate.score_summary(scores(spark, sf))
    return summary.withColumn("mean_score", round6(F.col("mean_score")))


@query
def faithfulness_ranked(spark, sf):
    return products.ranked_scores(scores(spark, sf)).withColumn("score", round6(F.col("score")))


def _collected(spark, sf):
    """Flagged days as collected explanations with loose severity texts."""
    z = F.col("zscore")
    raw = (
        F.when(z >= 3.5, "Hospitalization and death")
        .when(z >= 3, " Life threatening")
        .when(z >= 2.7, "non-serious/other and hospitalization")
        .when(z > 0, "Non-Serious/other")
    )
    return flagged(spark, sf).select(
        "drug",
        "date",
        "count",
        "zscore",
        raw.alias("dominant_severity"),
        F.array(F.lit(" Skin "), F.upper("drug")).alias("dominant_organ_systems"),
    )


@query
def explanations_merge(spark, sf):
    merged = explain.merge_explanations(_collected(spark, sf))
    return merged.withColumn("dominant_organ_systems", joined("dominant_organ_systems"))


@query
def explanations_sorted(spark, sf):
    return explain.merge_explanations(_collected(spark, sf)).select("drug", "date", "dominant_severity")


@query
def explanations_filter(spark, sf):
    merged = explain.merge_explanations(_collected(spark, sf))
    kept = explain.filter_explanations(merged, ["ECONOMY", "SMALL"], ["fatal", "life-threatening"])
    return kept.orderBy("date").select("drug", "date", "dominant_severity", "zscore")


@query
def explanations_shown(spark, sf):
    merged = staged(explain.merge_explanations(_collected(spark, sf)), "explanations")
    kept = explain.filter_explanations(merged, ["ECONOMY", "SMALL"], [])
    return products.shown_of_total(merged, kept)


@query
def labeling_template(spark, sf):
    return evaluate.labeling_template(staged(categorized(spark, sf), "categorized"))


@query
def categorization_accuracy(spark, sf):
    accuracy = evaluate.categorization_accuracy(b.labelled_documents(spark, sf))
    return accuracy.withColumns({c: round6(F.col(c)) for c in ("organ_accuracy", "severity_accuracy")})


@query
def label_mismatches(spark, sf):
    return evaluate.label_mismatches(b.labelled_documents(spark, sf))


@query
def report_lines(spark, sf):
    template = b.labelled_documents(spark, sf)
    lines = evaluate.report_lines(
        evaluate.categorization_accuracy(template), evaluate.label_mismatches(template)
    )
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


def _ground_truth(spark, sf):
    z = F.col("zscore")
    mark = F.when(z >= 3, "\ty\n").when(z >= 2.6, "N").otherwise("Uncertain")
    return flagged(spark, sf).withColumn("is_real_signal", mark)


@query
def anomaly_precision(spark, sf):
    precision = evaluate.anomaly_precision(_ground_truth(spark, sf))
    return precision.withColumn("precision", round6(F.col("precision")))


@query
def seed_ground_truth(spark, sf):
    seeds = {
        ("ECONOMY", "1996-05-13"): {"is_real_signal": "Y", "notes": "known"},
        ("SMALL", "1997-02-03"): {"is_real_signal": "N", "fda_reference_url": "https://example.org"},
    }
    return evaluate.ground_truth_template(zscores(spark, sf).select("drug", "date", "count"), seeds)


# ---- overview


@query
def overview_kpis(spark, sf):
    series = staged(daily(spark, sf), "daily")
    reports = ranking.dedup_reports(b.case_mentions(spark, sf), b.TRACKED)
    return products.overview_kpis(series, reports, detection.zscore_table(series), "is_anomaly_zscore")


@query
def value_counts_organ(spark, sf):
    return counts.value_counts(categorized(spark, sf), "primary_organ_system")


@query
def value_counts_severity(spark, sf):
    return counts.value_counts(categorized(spark, sf), "severity")


@query
def drug_timeline(spark, sf):
    return products.drug_timeline(zscores(spark, sf), "ECONOMY")


@query
def flagged_for_drug(spark, sf):
    return products.flagged_for_drug(zscores(spark, sf), "ECONOMY", "is_anomaly_zscore")


# ---- streams


def _arrivals(spark, sf, consume):
    """Feed the events to a stream in three arrivals, the latest first; each brings some of the one before again."""
    events, source = b.table(spark, sf, "events"), fresh_path(spark, "arrivals")
    third = F.pmod(F.xxhash64("user_id"), F.lit(3))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / 3
    part = F.when(F.col("ts") >= F.lit(last - step), 0).when(F.col("ts") >= F.lit(first + step), 1).otherwise(2)
    for n in range(3):
        again = events.filter((part == n - 1) & (third == 0))
        events.filter(part == n).unionByName(again).write.mode("append").parquet(source)
        consume(stream.with_event_time(stream.read_files(spark, source, events.schema)))


@query
def stream_ingest(spark, sf):
    out, checkpoint = fresh_path(spark, "ingested"), fresh_path(spark, "progress")
    _arrivals(spark, sf, lambda rows: stream.ingest(rows, out, checkpoint, "event_id"))
    return spark.read.parquet(out).select("event_id", "event_type", "user_id", "value")


@query
def stream_daily_counts(spark, sf):
    out, checkpoint = fresh_path(spark, "running"), fresh_path(spark, "progress")
    _arrivals(
        spark, sf, lambda rows: stream.daily_counts(rows, out, checkpoint, "event_type", id_column="event_id")
    )
    return stream.latest_counts(spark, out)
