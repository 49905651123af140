"""The phases as file-to-file jobs. Each reads finished tables, writes its own, and can be
run again: what is already in its result folder is not done twice."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import config, schemas
from casewatch.functions import ids
from casewatch.functions.severity import severity_by_lookup
from casewatch.functions.text import parse_list_text
from casewatch.operators import categorize, context, counts, evaluate, explain, flatten
from casewatch.operators import incremental, inference, ranking, vector_store, vectors
from casewatch.operators.explain import normalized_count
from casewatch.plans import detection, diagnostics
from casewatch.session import tune
from casewatch.sources import archive as page_archive
from casewatch.sources import files
from casewatch.sources.workspace import fresh_path, staged

LABELS = T.StructType(
    [T.StructField("batch_id", T.StringType()), T.StructField("position", T.LongType()), *schemas.LABEL_ROW.fields]
)
EXPLAINED = T.StructType([T.StructField("entity_id", T.StringType()), *schemas.EXPLANATIONS.fields])
SCORED = T.StructType([T.StructField("entity_id", T.StringType()), *schemas.FAITHFULNESS.fields])
CATEGORIZED = T.StructType([*schemas.PATIENT_SUMMARIES.fields, *schemas.LABEL_ROW.fields[1:]])
JUDGED = T.StructType(
    [*schemas.EXPLANATIONS.fields]
    + [T.StructField(c, T.StringType()) for c in ("is_real_signal", "fda_reference_url", "notes")]
)


BATCHES_PER_TASK = 16


def append_in_slices(todo, id_column, work, results, batch_size, slices=None):
    """work(part) appended to the result folder for one part of the ids after another.

    A model's answers cost: a run that breaks keeps those of its finished parts, and the next run does not
    ask for them again. Without a number of slices, a part has some BATCHES_PER_TASK batches for each core, so a
    break loses so many answers whatever the size of the table. todo is staged in a folder per part, because
    results grow while it is read.
    """
    spark = todo.sparkSession
    todo = staged(todo, "todo")
    total, per_task = todo.count(), batch_size * BATCHES_PER_TASK
    if slices is None:
        slices = max(1, -(-total // (per_task * spark.sparkContext.defaultParallelism)))
    if slices == 1:
        files.append_results(work(todo), results)
        return
    path = fresh_path(spark, "slices")
    part = ids.hash_bucket(F.col(id_column), slices)
    todo.withColumn("_slice", part).hint("rebalance", "_slice").write.partitionBy("_slice").parquet(path)
    for name in sorted(n for n in files.children(spark, path) if n.startswith("_slice=")):
        rows = spark.read.schema(todo.schema).parquet(f"{path}/{name}")
        files.append_results(work(rows.repartition(max(1, -(-total // (slices * per_task))))), results)


def raw_reports(spark, pages, archive=None, months=None):
    """Reports of a folder of pages: parsed anew, or by way of an archive, which first takes the pages it lacks.

    months: callable that tells the months wanted, for the archive; None for all.
    """
    if archive is None:
        return files.read_report_pages(spark, pages)
    page_archive.update(spark, pages, archive)
    return page_archive.read(spark, archive, months() if months else None)


# ---- 1: reports in


def ingest_counts(spark, pages, out, drugs=config.DRUGS, start=config.START_DATE, end=config.END_DATE, archive=None):
    """Daily serious counts, one CSV folder per drug. Returns days and totals per drug.

    archive: folder of an archive of the pages, kept up to date, of which the months of the range are read.
    """
    reports = raw_reports(spark, pages, archive, lambda: page_archive.months_between(start, end))
    named = flatten.scan_reports(reports, drugs, start, end)
    files.write_csv(counts.daily_counts(counts.mentions_of(named)), out, partition_by="drug")
    return counts.counts_summary(files.read_csv(spark, out, schemas.DAILY_COUNTS))


def ingest_reports(
    spark,
    pages,
    out,
    drugs=config.DRUGS,
    start=config.START_DATE,
    end=config.END_DATE,
    per_drug_limit=config.PER_DRUG_LIMIT,
    archive=None,
):
    """Flat unique reports: limited per drug first, then each report kept for its first drug; archive as above."""
    tune(spark)
    reports = raw_reports(spark, pages, archive, lambda: page_archive.months_between(start, end))
    named = flatten.scan_reports(reports, drugs, start, end)
    unique = ranking.dedup_reports(ranking.cap_per_drug(named, per_drug_limit), drugs, then_by=["receivedate"])
    files.write_parquet(flatten.flatten_reports(unique), out)


# ---- 2: labels


def categorize_pending(
    spark,
    summaries,
    results,
    run_id,
    load=None,
    rules=None,
    per_drug=None,
    batch_size=config.CATEGORIZE_BATCH,
    slices=None,
):
    """Label the reports without a label and append the good rows to the result folder.

    load: a model for `inference.infer`, or None for the keyword rules. run_id orders the
    runs. Failed batches are left out, so the next run takes them again. A model's labels are
    appended in slices.
    """
    rows = files.required_parquet(spark, summaries, schemas.PATIENT_SUMMARIES, "Ingest reports first.")
    done = files.optional_parquet(spark, results, LABELS).select(F.col("id").alias("safetyreportid")).distinct()
    todo = incremental.pending_sample(rows, done, per_drug)

    def stamped(labels):
        return labels.select(
            F.lit(run_id).cast("string").alias("batch_id"), F.lit(0).cast("bigint").alias("position"), *schemas.LABEL_ROW.names
        )

    if load is None:
        files.append_results(stamped(categorize.categorize_rules(todo, rules)), results)
    else:
        label = lambda part: stamped(inference.succeeded(categorize.categorize(part, load, batch_size)))
        append_in_slices(todo, "safetyreportid", label, results, batch_size, slices)


def import_label_batches(spark, folder, results):
    """Append labels from a folder of {"reports": [...]} files; unreadable files are skipped.

    Returns the names of the skipped files.
    """
    with_name = (
        spark.read.schema(T.StructType([*schemas.LABEL_BATCH.fields, T.StructField("_corrupt", T.StringType())]))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", multiLine=True, pathGlobFilter="*.json")
        .json(folder)
        .filter(F.col("_corrupt").isNull() & F.col("reports").isNotNull())
        .select(F.col("_metadata.file_name").alias("batch_id"), "reports")
    )
    files.append_results(
        incremental.explode_label_batches(with_name).select(*[F.col(f.name).cast(f.dataType) for f in LABELS.fields]),
        results,
    )
    return files.read_json_results_tolerant(spark, folder, schemas.LABEL_BATCH)[1].select("file_name")


def merge_categorized(spark, summaries, results, out):
    """Join reports with their first label. Returns one row: labels changed by normalising."""
    first = incremental.first_labels(spark.read.schema(LABELS).parquet(results), severity_by_lookup)
    merged = incremental.merge_labels(
        files.required_parquet(spark, summaries, schemas.PATIENT_SUMMARIES, "Ingest reports first."), first
    )
    files.write_parquet(merged.select(*CATEGORIZED.names), out)
    return first.agg(normalized_count(F.col("severity_before"), F.col("severity")).alias("n_changed"))


def labels_status(spark, summaries, results):
    """done, total, percent."""
    done = files.optional_parquet(spark, results, LABELS).select("id").distinct()
    return counts.progress(done, files.optional_parquet(spark, summaries, schemas.PATIENT_SUMMARIES))


# ---- 3: vectors


def build_store(spark, categorized, store, model_path=None, load=None):
    """Append the reports that the vector store lacks; only those are embedded. Returns the fitted embedding, if any.

    The embedding is fitted with the first reports and saved at model_path; later runs load it, so all vectors stay
    comparable. load: a model for vectors.embed_with instead.
    """
    reports = files.required_parquet(spark, categorized, CATEGORIZED, "Merge labels first.")
    model = None
    if load is None and vector_store.exists(spark, store):
        model = PipelineModel.load(model_path)
    elif load is None:
        model = vectors.fit_embedding(reports.select(F.col("patient_summary_text").alias("document")))
        if model_path:
            model.write().save(model_path)
    stored = vector_store.current(spark, store)
    vector_store.upsert(spark, store, vectors.build_vectors(reports, stored, model, load=load))
    return model


def search_text(spark, store, model, text, k=config.SEARCH_K, where=None, load=None):
    """Nearest stored reports to a text, with their documents and metadata; load as in build_store."""
    asked = spark.createDataFrame([("question", text)], "id string, document string")
    question = vectors.embed(asked, model) if load is None else inference.succeeded(vectors.embed_with(asked, load, 1))
    stored = vector_store.current(spark, store)
    hits = vectors.search(stored, [question.first()["embedding"]], k, where)
    shown = ["document", "drug", "primary_organ_system", "severity"]
    return vectors.hits_with_documents(hits, stored, shown).orderBy("rank")


def store_status(spark, store, categorized):
    """Stored and categorised reports."""
    return counts.progress(vector_store.current(spark, store), files.optional_parquet(spark, categorized, CATEGORIZED))


# ---- 4: detection, explanations


def detect(spark, counts_path, out, **parameters):
    """The anomaly table as CSV. Returns flagged days per drug and in total."""
    daily = files.read_csv(spark, counts_path, schemas.DAILY_COUNTS)
    files.write_csv(detection.anomaly_table(daily, **parameters), out)
    return detection.anomaly_totals(files.read_csv(spark, out, schemas.ANOMALIES))


def _explanation_id():
    return ids.entity_id(F.col("drug"), ids.timestamp_text(F.col("date")))


def diagnose(
    spark,
    anomalies,
    pages,
    results,
    drugs=config.DRUGS,
    rules=None,
    n=config.CONTEXT_REPORTS,
    days=config.CONTEXT_DAYS,
    load=None,
    batch_size=1,
    slices=None,
    archive=None,
):
    """Explain the flagged days that have no explanation yet; days without reports are skipped.

    load: a model for diagnostics.explain_with, or None for the extractive explanations. A model's
    answers are appended in slices; days whose batch failed stay open. archive: folder of an archive of the
    pages, of which only the months around the open days are read.
    """
    table = files.read_csv(spark, anomalies, schemas.ANOMALIES)
    flagged = detection.high_confidence(table).withColumn("entity_id", _explanation_id())
    todo = incremental.pending(flagged, files.optional_parquet(spark, results, EXPLAINED), "entity_id")
    reports = raw_reports(spark, pages, archive, lambda: page_archive.months_around(todo, reach=days)).withColumn(
        "drug", F.explode(flatten.tracked_drugs_named(F.col("patient.drug"), drugs))
    )
    found = diagnostics.labelled_context(todo, reports, rules, n, days)
    as_stored = lambda rows: rows.withColumn("date", F.col("date").cast("string")).select(*EXPLAINED.names)
    if load is None:
        files.append_results(as_stored(explain.explain_extractive(found).withColumn("entity_id", _explanation_id())), results)
    else:
        answered = lambda part: as_stored(inference.succeeded(diagnostics.explain_with(part, load, batch_size)))
        append_in_slices(diagnostics.to_explain(staged(found, "context"), days), "entity_id", answered, results, batch_size, slices)


def merge_diagnoses(spark, results, out):
    """Clean and sort the explanations into CSV. Returns one row: changed severities."""
    merged = explain.merge_explanations(spark.read.schema(EXPLAINED).parquet(results))
    files.write_csv(merged.select(*schemas.EXPLANATIONS.names), out)
    return merged.agg(
        normalized_count(F.col("severity_before"), F.col("dominant_severity")).alias("n_changed")
    )


def import_explanations(spark, folder):
    """Explanations kept as one JSON file per flagged day; one unreadable file is an error."""
    return files.read_json_results(spark, folder, schemas.EXPLANATIONS)


def read_foreign_explanations(spark, path):
    """Explanation CSV whose list column is list text such as ['skin', 'renal']."""
    rows = files.read_csv_as_strings(spark, path, schemas.EXPLANATIONS, blank_nulls=False)
    return rows.select(
        *[
            parse_list_text(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schemas.EXPLANATIONS.fields
        ]
    )


def diagnoses_status(spark, anomalies, results):
    """Explained and flagged days."""
    flagged = detection.high_confidence(files.read_csv(spark, anomalies, schemas.ANOMALIES))
    return counts.progress(files.optional_parquet(spark, results, EXPLAINED), flagged)


# ---- 5: evaluation


def label_template(spark, categorized, out, total=config.LABEL_SAMPLE, seed=config.SEED):
    reports = files.required_parquet(spark, categorized, CATEGORIZED, "Merge labels first.")
    files.write_csv(evaluate.labeling_template(reports, total, seed), out)


def score_labels(spark, template, out):
    """Accuracy report of a filled template as text. Returns the figures."""
    rows = files.read_csv_as_strings(spark, template, schemas.LABELING_TEMPLATE)
    accuracy = evaluate.categorization_accuracy(rows)
    files.write_text_report(evaluate.report_lines(accuracy, evaluate.label_mismatches(rows)), out)
    return accuracy


def anomaly_template(spark, explanations, out, seeds=None):
    rows = files.read_csv(spark, explanations, schemas.EXPLANATIONS)
    files.write_csv(evaluate.ground_truth_template(rows, seeds).select(*JUDGED.names), out)


def score_anomalies(spark, template, out, schema=JUDGED):
    """Precision report of a filled template as text. Returns the figures."""
    precision = evaluate.anomaly_precision(files.read_csv_as_strings(spark, template, schema))
    files.write_text_report(evaluate.precision_lines(precision), out)
    return precision


def judge(
    spark,
    explanations,
    pages,
    results,
    drugs=config.DRUGS,
    n=config.CONTEXT_REPORTS,
    days=config.CONTEXT_DAYS,
    load=None,
    batch_size=1,
    slices=None,
    archive=None,
):
    """Score the explanations that have no score yet. Returns mean score and count of all.

    load: a model for diagnostics.judge_with, or None for word coverage; its scores are appended in slices.
    archive: as in diagnose().
    """
    rows = files.read_csv(spark, explanations, schemas.EXPLANATIONS).withColumn(
        "entity_id", ids.entity_id(F.col("drug"), F.col("date"))
    )
    todo = incremental.pending(rows, files.optional_parquet(spark, results, SCORED), "entity_id")
    todo = staged(todo.withColumn("date", F.to_date("date")), "unscored")
    reports = raw_reports(spark, pages, archive, lambda: page_archive.months_around(todo, reach=days)).withColumn(
        "drug", F.explode(flatten.tracked_drugs_named(F.col("patient.drug"), drugs))
    )
    found = diagnostics.labelled_context(todo, reports, None, n, days)
    bundles = context.context_bundle(found)
    as_stored = lambda rows: rows.withColumn("date", F.col("date").cast("string")).select(*SCORED.names)
    if load is None:
        scores = evaluate.faithfulness(todo, bundles, context.claim_text())
        entity = ids.entity_id(F.col("drug"), F.col("date").cast("string"))
        files.append_results(as_stored(scores.withColumn("entity_id", entity)), results)
    else:
        answered = lambda part: as_stored(inference.succeeded(diagnostics.judge_with(part, load, batch_size)))
        append_in_slices(diagnostics.to_judge(todo, bundles), "entity_id", answered, results, batch_size, slices)
    return evaluate.score_summary(spark.read.schema(SCORED).parquet(results))
