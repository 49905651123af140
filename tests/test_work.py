"""Incremental work, inference, vectors, context, evaluation, files, streams."""

import datetime as dt
import json
import os
import shutil
import types

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import config, schemas
from casewatch.functions import severity
from casewatch.operators import (
    categorize,
    context,
    counts,
    evaluate,
    explain,
    incremental,
    inference,
    lsh,
    ranking,
    vector_store,
    vectors,
)
from casewatch.sources import bindings, files, workspace
from casewatch.streaming import ingest as stream

DAY = dt.date(2023, 5, 10)


# ---- ranking under a hot key


def test_top_n_is_exact_for_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i % 30}", i * 7919 % 1000, str(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "drug string, v int, id string").repartition(16)
    got = ranking.top_n_per_key(df, ["drug"], ["v", "id"], 25, salts=16).collect()
    expected = []
    for key in {r[0] for r in rows}:
        expected += sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))[:25]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_keep_first_over_many_copies(spark):
    rows = [("same", d, i) for i in range(500) for d in ("b", "a")] + [("x", "b", 1)]
    df = spark.createDataFrame(rows, "safetyreportid string, drug string, n int")
    got = ranking.dedup_reports(df, ["a", "b"], then_by=["n"])
    assert sorted((r.safetyreportid, r.drug) for r in got.collect()) == [("same", "a"), ("x", "b")]
    assert ranking.dedup_reports(got, ["a", "b"]).count() == 2


def test_sample_is_repeatable_and_capped(spark):
    df = spark.createDataFrame([(d, str(i)) for d in "ab" for i in range(40)], "drug string, safetyreportid string")
    one = {tuple(r) for r in ranking.stratified_sample(df, 7).collect()}
    two = {tuple(r) for r in ranking.stratified_sample(df.repartition(9), 7).collect()}
    assert one == two and len(one) == 14
    assert {tuple(r) for r in ranking.stratified_sample(df, 7, seed=1).collect()} != one
    assert ranking.stratified_even(df, 1).count() == 2  # at least one per drug


# ---- incremental


def ids_frame(spark, values):
    return spark.createDataFrame([(str(v), "a", f"text {v}") for v in values], "safetyreportid string, drug string, patient_summary_text string")


def test_pending_shrinks_to_nothing(spark, tmp_path):
    rows = ids_frame(spark, range(50))
    path = str(tmp_path / "results")
    schema = T.StructType([T.StructField("safetyreportid", T.StringType())])
    sizes = []
    for _ in range(5):
        done = files.optional_parquet(spark, path, schema)
        todo = incremental.pending_sample(rows, done, per_drug=20)
        sizes.append(todo.count())
        if sizes[-1] == 0:
            break
        files.append_results(todo.select("safetyreportid"), path)
    assert sizes == [20, 20, 10, 0]  # each capped run takes further reports


def test_cap_of_whole_set_does_not_drift(spark):
    rows = ids_frame(spark, range(50))
    first = incremental.pending_sample(rows, rows.limit(0), per_drug=20)
    again = incremental.pending_sample(rows, first.select("safetyreportid"), per_drug=20, cap_all=True)
    assert again.count() == 0


def test_batches_cover_every_row_once(spark):
    got = incremental.make_batches(ids_frame(spark, range(205)), 20, buckets=5).collect()
    covered = [i["id"] for r in got for i in r["items"]]
    assert sorted(covered) == sorted(map(str, range(205)))
    assert max(r.n_items for r in got) <= 20
    assert len({r.batch_id for r in got}) == len(got)


def test_batches_of_other_buckets_keep_their_ids(spark):
    before = {r.batch_id: r.bucket for r in incremental.make_batches(ids_frame(spark, range(60)), 7, buckets=4).collect()}
    more = ids_frame(spark, range(5000, 5003))
    touched = {r.bucket for r in incremental.make_batches(more, 7, buckets=4).collect()}
    after = incremental.make_batches(ids_frame(spark, range(60)).unionByName(more), 7, buckets=4).collect()
    kept = {i for i, bucket in before.items() if bucket not in touched}
    assert kept and kept <= {r.batch_id for r in after}


def test_overfull_buckets_are_split_and_others_keep_their_ids(spark):
    few, many = ids_frame(spark, range(300)), ids_frame(spark, range(3000))
    one = incremental.make_batches(few, 7, buckets=16, split_rows=40).collect()
    assert {r.part for r in one} == {0}  # nothing to split yet: as without
    assert {r.batch_id for r in one} == {r.batch_id for r in incremental.make_batches(few, 7, buckets=16).collect()}
    split = incremental.make_batches(many, 7, buckets=16, split_rows=40).collect()
    assert sorted(i["id"] for r in split for i in r["items"]) == sorted(map(str, range(3000)))
    sizes = {}
    for r in split:
        sizes[r.bucket, r.part] = sizes.get((r.bucket, r.part), 0) + r.n_items
    assert len(sizes) > 16 * 4 and max(sizes.values()) <= 60 and max(r.n_items for r in split) <= 7
    grown = many.unionByName(ids_frame(spark, range(9000, 9004)))
    again = {r.batch_id for r in incremental.make_batches(grown, 7, buckets=16, split_rows=40).collect()}
    kept = [r for r in split if r.batch_id in again]
    assert len({r.bucket for r in kept}) >= 12


def test_many_buckets_spread_evenly(spark):
    """No task of the numbering holds twice the median, whatever the size of the table."""
    for n in (4_000, 40_000):
        rows = spark.range(n).select(F.col("id").cast("string").alias("safetyreportid"), F.lit("t").alias("patient_summary_text"))
        batches = incremental.make_batches(rows, 20, buckets=4096)
        per_task = batches.groupBy(F.pmod(F.hash("bucket", "part"), F.lit(8)).alias("task")).agg(F.sum("n_items").alias("n"))
        held = sorted(r.n for r in per_task.collect())
        assert held[-1] < 2 * held[len(held) // 2]


def test_missing_severity_that_is_filled_counts_as_changed(spark):
    df = spark.createDataFrame([(None,), ("\tMild\n",), ("Hospitalization\n",)], "s string")
    got = df.select(explain.normalized_count(F.col("s"), severity.severity_by_ladder(F.col("s"))).alias("n")).first()
    assert got.n == 2


def test_versions_of_a_report_are_chosen_by_content(spark):
    rows = [("1", "a", "20240101", v) for v in "cab"]
    df = spark.createDataFrame(rows, "safetyreportid string, drug string, receivedate string, v string")
    for parts in (1, 3):
        shuffled = df.repartition(parts, "v")
        assert ranking.dedup_reports(shuffled, ["a"], then_by=["receivedate"]).first().v == "a"
        assert sorted(r.v for r in ranking.cap_per_drug(shuffled, 2).collect()) == ["a", "b"]


def test_product_names_are_no_symptoms(spark):
    df = spark.createDataFrame([("1", "patient taking RASHOFF experienced: Nausea", "Nausea", "RASHOFF")], "safetyreportid string, patient_summary_text string, reactions string, drugs_involved string")
    got = categorize.categorize_rules(df).first()
    assert (got.primary_organ_system, got.likely_causal_drug) == ("gastrointestinal", "RASHOFF")


def test_label_batches_checked_and_merged(spark):
    good = {"reports": [{"id": 7, "severity": "Hospitalization", "category_tags": ["x"]}, {"id": "8", "severity": "odd"}]}
    again = {"reports": [{"id": "7", "severity": "mild"}]}
    raw = spark.createDataFrame(
        [("b1", json.dumps(good)), ("b2", json.dumps(again)), ("b3", "{oops"), ("b4", '{"items": 1}'), ("b5", None)],
        "batch_id string, response string",
    )
    checked = incremental.parse_label_batches(raw)
    reasons = {r.batch_id: r.reject_reason for r in checked.collect()}
    assert reasons == {"b1": None, "b2": None, "b3": "invalid json", "b4": "missing reports", "b5": "invalid json"}
    labels = incremental.first_labels(
        incremental.explode_label_batches(checked), lambda c: F.when(F.lower(c) == "hospitalization", "severe").otherwise(c)
    )
    assert {(r.safetyreportid, r.severity) for r in labels.collect()} == {("7", "severe"), ("8", "odd")}
    merged = incremental.merge_labels(ids_frame(spark, [7, 9]), labels)
    assert [r.safetyreportid for r in merged.collect()] == ["7"]


def test_upsert_replaces_and_adds(spark):
    store = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    new = spark.createDataFrame([("2", "B"), ("3", "c")], "id string, v string")
    once = incremental.upsert(store, new)
    assert sorted(map(tuple, once.collect())) == [("1", "a"), ("2", "B"), ("3", "c")]
    assert sorted(map(tuple, incremental.upsert(once, new).collect())) == sorted(map(tuple, once.collect()))


# ---- inference


def test_failing_batch_is_isolated_and_retried(spark):
    schema = T.StructType([T.StructField("safetyreportid", T.StringType()), T.StructField("n", T.LongType())])
    rows = ids_frame(spark, range(40)).coalesce(1)

    def load():
        def model(batch):
            if "13" in set(batch["safetyreportid"]):
                raise RuntimeError("boom")
            return batch.assign(n=batch["patient_summary_text"].str.len())

        return model

    results = inference.infer(rows, load, schema, batch_size=10)
    good, bad = inference.succeeded(results), inference.failed(results)
    assert (good.count(), bad.count()) == (30, 10)
    assert bad.first().error == "RuntimeError: boom"
    assert incremental.pending(rows, good).count() == 10


def test_keyword_model_equals_rules(spark):
    texts = [
        "Nausea and vomiting", "rash, nausea", "nothing", "RASH Rash urticaria; cough", "", None, "skinskin skin pruritus",
        "Female, patient taking A, B experienced: Rash. Seriousness: Death, Hospitalization.",
        "patient taking C experienced: Seizure. Seriousness: Non-Serious.", "Seriousness: life threatening .",
    ]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "safetyreportid string, patient_summary_text string")
    wide = rows.withColumn("reactions", F.lower("patient_summary_text")).withColumn(
        "drugs_involved", F.when(F.col("safetyreportid") < 4, "X; Y").when(F.col("safetyreportid") < 8, "")
    )
    for table in (rows, wide):
        given = table.fillna("", ["patient_summary_text"])
        rules = {r.id: r for r in categorize.categorize_rules(given).collect()}
        model = inference.succeeded(categorize.categorize(table, categorize.keyword_model(id_column="id"), batch_size=2))
        assert {r.id: tuple(r) for r in model.collect()} == {i: tuple(r) for i, r in rules.items()}
    assert rules["0"].primary_organ_system == "gastrointestinal" and rules["2"].primary_organ_system == categorize.OTHER
    organs = {r.primary_organ_system for r in rules.values()}
    assert organs <= set(config.ORGAN_SYSTEMS) and set(categorize.CLINICAL_RULES) < set(config.ORGAN_SYSTEMS)


# ---- vectors


def vector_frame(spark, matrix, labels=None):
    rows = [(str(i), [float(x) for x in v], str(labels[i]) if labels else "x") for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id string, embedding array<float>, primary_organ_system string")


def brute(matrix, q, k, keep=None):
    matrix = np.asarray(matrix, dtype=np.float32).astype(float)
    sims = matrix @ q / (np.linalg.norm(matrix, axis=1) * np.linalg.norm(q))
    order = sorted((i for i in range(len(matrix)) if keep is None or keep[i]), key=lambda i: (-round(sims[i], 12), str(i)))
    return [str(i) for i in order[:k]]


def test_search_is_exact_with_copies(spark):
    rng = np.random.default_rng(0)
    matrix = rng.normal(size=(300, 16)).astype(np.float32)
    matrix[100:200] = matrix[7]  # a third of all rows are copies
    queries = [matrix[7].astype(float), rng.normal(size=16)]
    df = vector_frame(spark, matrix).repartition(7)
    got = vectors.search(df, queries, 12).orderBy("query", "rank").collect()
    for q in range(2):
        assert [r.id for r in got if r.query == q] == brute(matrix, queries[q], 12)


def test_filtered_search(spark):
    rng = np.random.default_rng(1)
    matrix, labels = rng.normal(size=(90, 8)), [i % 3 for i in range(90)]
    got = vectors.search(vector_frame(spark, matrix, labels), [matrix[0]], 5, {"primary_organ_system": "1"})
    ids = [r.id for r in got.orderBy("rank").collect()]
    assert ids == brute(matrix, matrix[0], 5, [x == 1 for x in labels])


def recall(spark, df, queries, path, k=5, where=None, keep=None, **options):
    normals = lsh.planes(len(queries[0]))
    if not os.path.exists(path):
        lsh.write_index(df, path, normals)
    near = lsh.search(df, lsh.read_index(spark, path), queries, normals, k, where, **options)
    exact = vectors.search(df, queries, k, where)
    pairs = lambda rows: {(r["query"], r["id"]) for r in rows.collect()}
    return len(pairs(near) & pairs(exact)) / exact.count()


def test_lsh_recall_against_exact(spark, folder, tmp_path):
    df = bindings.vector_rows(spark, folder)
    queries = [r.embedding for r in df.orderBy("id").limit(20).collect()]
    path = f"{tmp_path}/index"
    assert recall(spark, df, queries, path) >= 0.9
    assert recall(spark, df, queries, path, where={"primary_organ_system": "3"}) >= 0.9
    assert recall(spark, df, queries, path, probes=1) < recall(spark, df, queries, path, probes=6) < 1
    assert recall(spark, df, queries[:3], path, probes=64) == 1  # all codes


def test_lsh_probes_the_nearest_codes_first():
    normals = lsh.planes(8, tables=1, n=3)
    query = np.random.default_rng(2).normal(size=8)
    margins = normals[0] @ query
    home = sum(1 << j for j in range(3) if margins[j] > 0)
    costs = {home ^ f: sum(margins[j] ** 2 for j in range(3) if f >> j & 1) for f in range(8)}
    assert [c for _, c in lsh.probed_cells([query], normals, 8)] == sorted(costs, key=costs.get)


def test_lsh_of_awkward_vectors(spark, tmp_path):
    rows = [("z", [0.0, 0.0], "1"), ("n", None, "1"), ("s", [1.0], "1"), ("a", [1.0, 0.0], "1"), ("b", [1.0, 0.0], "1")]
    df = spark.createDataFrame(rows, "id string, embedding array<float>, primary_organ_system string")
    normals = lsh.planes(2, tables=2, n=2)
    lsh.write_index(df, f"{tmp_path}/i", normals)
    index = lsh.read_index(spark, f"{tmp_path}/i")
    got = lsh.search(df, index, [[2.0, 0.0], [0.0, 0.0]], normals, probes=4).orderBy("query", "rank").collect()
    assert [(r["query"], r["id"], r["similarity"]) for r in got] == [
        (0, "a", 1.0), (0, "b", 1.0), (0, "z", 0.0), (1, "a", 0.0), (1, "b", 0.0), (1, "z", 0.0),
    ]
    none = df.limit(0)
    lsh.write_index(none, f"{tmp_path}/none", normals)
    assert lsh.search(none, index.limit(0), [[1.0, 0.0]], normals).count() == 0


def test_index_folders_of_unprobed_cells_are_not_read(spark, folder, tmp_path):
    df = bindings.vector_rows(spark, folder)
    query = df.first().embedding
    normals = lsh.planes(len(query))
    lsh.write_index(df, f"{tmp_path}/i", normals)
    near = lsh.search(df, lsh.read_index(spark, f"{tmp_path}/i"), [query], normals, probes=1)
    plan = near._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan and "PushedFilters" in plan


# ---- vector store


def stored(spark, *rows):
    wide = [(i, [v], "d", "", o, "", "", "", "") for i, v, o in rows]
    return spark.createDataFrame(wide, schemas.VECTORS)


def test_store_keeps_the_newest_row_of_an_id(spark, tmp_path):
    store = f"{tmp_path}/store"
    model = {}
    told = lambda: {r.id: r.primary_organ_system for r in vector_store.current(spark, store).collect()}
    assert told() == {} and not vector_store.exists(spark, store)
    rng = np.random.default_rng(4)
    for turn in range(14):
        ids = [str(i) for i in rng.choice(30, 6, replace=False)]
        model |= {i: str(turn) for i in ids}
        vector_store.upsert(spark, store, stored(spark, *[(i, 1.0, str(turn)) for i in ids]), compact_every=4)
        if turn == 6:  # a broken upsert leaves a folder that does not count
            stored(spark, ("x", 1.0, "x")).write.parquet(f"{store}/changes/{turn + 1}")
            os.remove(f"{store}/changes/{turn + 1}/_SUCCESS")
        assert told() == model
    assert sum(len(os.listdir(f"{store}/{kind}")) for kind in ("changes", "whole")) <= 2 * 4 + 4


def test_repeated_ids_of_one_upsert_count_once(spark, tmp_path):
    store = f"{tmp_path}/store"
    vector_store.upsert(spark, store, stored(spark, ("a", 1.0, "x"), ("a", 2.0, "x"), ("a", 2.0, "x"), (None, 1.0, "n")))
    assert sorted((str(r.id), r.embedding[0]) for r in vector_store.current(spark, store).collect()) == [("None", 1.0), ("a", 2.0)]


def test_an_upsert_writes_its_own_rows_only(spark, tmp_path):
    store = f"{tmp_path}/store"
    vector_store.upsert(spark, store, stored(spark, *[(str(i), float(i), "a") for i in range(2000)]))
    vector_store.upsert(spark, store, stored(spark, *[(str(i), 0.0, "b") for i in range(20)]))
    written = [spark.read.parquet(f"{store}/changes/{n}").count() for n in (0, 1)]
    assert written == [2000, 20] and vector_store.current(spark, store).count() == 2000


def test_embedding_is_unit_length_and_finds_itself(spark):
    texts = ["severe liver damage after tablets", "mild headache", "liver failure and jaundice", "knee pain"]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, document string")
    model = vectors.fit_embedding(docs)
    embedded = vectors.embed(docs, model)
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-5 and len(r.embedding) == 384 for r in embedded.collect())
    q = vectors.embed(spark.createDataFrame([("q", "damage of the liver")], "id string, document string"), model)
    best = vectors.search(embedded, [q.first().embedding], 2).orderBy("rank").collect()
    assert {r.id for r in best} == {"0", "2"}


def test_build_vectors_adds_only_pending(spark):
    reports = spark.createDataFrame(
        [(str(i), f"text number {i}", None, ["a", "b"]) for i in range(6)],
        "safetyreportid string, patient_summary_text string, drug string, category_tags array<string>",
    )
    model = vectors.fit_embedding(reports.select(F.col("patient_summary_text").alias("document")))
    empty = spark.createDataFrame([], schemas.VECTORS)
    store = workspace.staged(vectors.build_vectors(reports.filter("safetyreportid < 3"), empty, model), "store")
    assert store.count() == 3
    added = vectors.build_vectors(reports, store, model)
    assert {r.id for r in added.collect()} == {"3", "4", "5"} and added.columns == schemas.VECTORS.names
    row = added.filter("id = '5'").first()
    assert (row.drug, row.category_tags, row.severity) == ("", "a; b", "")


def test_l2_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


# ---- context


def report_frame(spark, offsets):
    rows = [(f"r{i:03d}", "a", DAY + dt.timedelta(days=o), f"t{i}") for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "safetyreportid string, drug string, received date, patient_summary_text string")


def anomaly_frame(spark, days=(0,)):
    return spark.createDataFrame([("a", DAY + dt.timedelta(days=d)) for d in days], "drug string, date date")


def test_context_window_is_inclusive(spark):
    got = context.context_reports(anomaly_frame(spark), report_frame(spark, [-4, -3, 0, 3, 4]))
    assert sorted((r.received - DAY).days for r in got.collect()) == [-3, 0, 3]


def test_context_limit_and_missing(spark):
    got = context.context_top_n(anomaly_frame(spark, (0, 100)), report_frame(spark, [0] * 9), 8)
    assert [r.safetyreportid for r in got.orderBy("position").collect()] == [f"r{i:03d}" for i in range(8)]
    bundle = context.context_bundle(got).collect()
    assert len(bundle) == 1 and bundle[0].n_context_reports == 8
    assert bundle[0].context.split("\n")[:2] == ["1. t0", "2. t1"]


def test_nearest_context_equals_brute_force_with_a_crowded_day(spark):
    rng = np.random.default_rng(3)
    offsets = [int(o) for o in rng.integers(-12, 12, 400)] + [1] * 400
    days = (-5, -1, 0, 2, 9)
    got = context.context_top_n(anomaly_frame(spark, days), report_frame(spark, offsets), 8).collect()
    for d in days:
        near = sorted((abs(o - d), f"r{i:03d}") for i, o in enumerate(offsets) if abs(o - d) <= 3)[:8]
        mine = sorted((r.position, r.distance, r.safetyreportid) for r in got if r.date == DAY + dt.timedelta(days=d))
        assert [(m[1], m[2]) for m in mine] == near


def test_explanation_from_context(spark):
    rows = [
        ("a", DAY, 9, 3.0, 2.7, 1, "hepatic", "severe", "Jaundice; Rash"),
        ("a", DAY, 9, 3.0, 2.7, 2, "hepatic", "fatal", "Jaundice"),
        ("a", DAY, 9, 3.0, 2.7, 3, "renal", "fatal", ""),
    ]
    df = spark.createDataFrame(
        rows,
        "drug string, date date, count long, expected_count double, zscore double, position int, "
        "primary_organ_system string, severity string, reactions string",
    )
    got = explain.explain_extractive(df).first()
    assert got.dominant_organ_systems == ["hepatic"] and got.dominant_severity == "fatal"
    assert got.notable_pattern == "most frequent reaction: Jaundice, 2 mentions"
    assert got.n_context_reports == 3 and got.summary.startswith("SPIKE")


# ---- evaluation


def template(spark, rows):
    full = [(str(i), "a", "t", po, ps, to, tsv, "") for i, (po, ps, to, tsv) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.LABELING_TEMPLATE)


def test_accuracy_denominators(spark):
    df = template(
        spark,
        [("Renal ", "mild", " renal", "MILD"), ("renal", "mild", "hepatic", ""), ("renal", "mild", " ", "mild")],
    )
    got = evaluate.categorization_accuracy(df).first()
    assert (got.n_labelled, got.organ_accuracy, got.severity_accuracy, got.n_mismatches) == (2, 0.5, 1.0, 1)
    none = evaluate.categorization_accuracy(template(spark, [("a", "b", "a", "")])).first()
    assert none.severity_accuracy is None


def test_report_text(spark, tmp_path):
    df = template(spark, [("renal", "mild", "hepatic", "mild")] * 23 + [("renal", "mild", "renal", "mild")] * 2)
    lines = evaluate.report_lines(evaluate.categorization_accuracy(df), evaluate.label_mismatches(df))
    path = str(tmp_path / "report")
    files.write_text_report(lines, path)
    text = [r.value for r in spark.read.text(path).collect()]
    assert text[2:5] == ["Labeled sample size: 25", "Organ system accuracy: 8.0%", "Severity accuracy: 100.0%"]
    assert text[6] == "Mismatches (23):" and len(text) == 7 + 20


def test_precision_of_published_labels(spark):
    marks = ["Y"] * 16 + [" n "] * 6 + ["Uncertain"] * 15
    df = spark.createDataFrame([(m,) for m in marks], "is_real_signal string")
    got = evaluate.anomaly_precision(df)
    row = got.first()
    assert (row.n_flagged, row.n_labelled, row.n_confirmed) == (37, 22, 16)
    assert [r.line for r in evaluate.precision_lines(got).collect()][4] == "Precision: 72.7%"


def test_seeded_truth(spark):
    df = spark.createDataFrame([("amoxicillin", "2022-11-22"), ("amoxicillin", "2022-03-02")], "drug string, date string")
    seeds = {("amoxicillin", "2022-11-22"): {"is_real_signal": "Y"}}
    got = {r.date: r.is_real_signal for r in evaluate.ground_truth_template(df, seeds).collect()}
    assert got == {"2022-11-22": "Y", "2022-03-02": ""}


def test_score_mean_and_coverage(spark):
    df = spark.createDataFrame([(s,) for s in [0.8] * 20 + [0.5] * 16 + [1.0]], "score double")
    row = evaluate.score_summary(df).first()
    assert row.n == 37 and round(row.mean_score, 4) == 0.6757
    cover = spark.createDataFrame([("Rash rash liver", ["a rash"]), ("", ["x"])], "c string, s array<string>")
    assert [r[0] for r in cover.select(evaluate.claim_coverage(F.col("c"), F.col("s"))).collect()] == [0.5, 0.0]


def test_progress_of_nothing(spark):
    empty = spark.createDataFrame([], "id string")
    assert tuple(counts.progress(empty, empty).first()) == (0, 0, 0.0)


def test_union_of_no_frames(spark):
    assert counts.union_all([], schemas.DAILY_COUNTS, spark).count() == 0


def test_filters_with_empty_lists_keep_all(spark):
    df = spark.createDataFrame([("a", "mild"), ("b", "fatal")], "drug string, dominant_severity string")
    assert explain.filter_explanations(df).count() == 2
    assert explain.filter_explanations(df, ["a"], ["fatal"]).count() == 0


# ---- files


def test_report_pages(spark, tmp_path):
    page = {
        "results": [
            {"safetyreportid": "1", "receivedate": "20220101", "patient": {"drug": [{"medicinalproduct": "METFORMIN"}]}},
            {"safetyreportid": "2"},
        ]
    }
    (tmp_path / "p.json").write_text(json.dumps(page, indent=1))
    got = files.read_report_pages(spark, str(tmp_path))
    assert got.count() == 2 and got.schema == schemas.RAW_REPORT


def test_json_scans(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"reports": [{"id": "1"}, {"id": "2"}]}')
    (tmp_path / "b.json").write_text('{"reports": [')
    good, skipped = files.read_json_results_tolerant(spark, str(tmp_path), schemas.LABEL_BATCH)
    assert {r.id for r in incremental.done_ids(good).collect()} == {"1", "2"}
    assert [r.file_name for r in skipped.collect()] == ["b.json"]
    with pytest.raises(Exception):
        files.read_json_results(spark, str(tmp_path), schemas.LABEL_BATCH).collect()
    assert {r.id for r in files.done_ids_from_names(spark, str(tmp_path)).collect()} == {"a", "b"}


def test_csv_keeps_awkward_text(spark, tmp_path):
    rows = [("1", ' lead "q", x\nnext ', ["a'b", 'c"d']), ("2", "", []), ("3", None, None)]
    df = spark.createDataFrame(rows, "id string, t string, tags array<string>")
    path = str(tmp_path / "csv")
    files.write_csv(df, path)
    # CSV has no difference between empty and missing text: both come back missing
    expected = [rows[0], ("2", None, []), rows[2]]
    assert sorted(map(tuple, files.read_csv(spark, path, df.schema).collect())) == expected
    text = files.read_csv_as_strings(spark, path, df.schema)
    assert {r.id: r.t for r in text.collect()} == {"1": rows[0][1], "2": "", "3": ""}


def test_counts_and_reports_sinks(spark, tmp_path):
    df = spark.createDataFrame([(DAY, 3, "a"), (DAY, 4, "b")], schemas.DAILY_COUNTS)
    files.write_csv(df, str(tmp_path / "c"), partition_by="drug")
    assert sorted(p for p in os.listdir(tmp_path / "c") if p.startswith("drug")) == ["drug=a", "drug=b"]
    files.write_parquet(df, str(tmp_path / "p"), partition_by="drug")
    assert spark.read.parquet(str(tmp_path / "p")).filter("drug = 'b'").first()["count"] == 4


def test_optional_and_required(spark, tmp_path):
    path = str(tmp_path / "none")
    assert files.optional_parquet(spark, path, schemas.ANOMALIES).count() == 0
    with pytest.raises(FileNotFoundError, match="Run counts first"):
        files.required_parquet(spark, path, schemas.ANOMALIES, "Run counts first.")


def test_work_folder_is_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = workspace.work_dir(spark)
    assert folder == configured.rstrip("/") if configured else folder


# ---- streams


def test_stream_resumes_without_repeats(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    at = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
    spark.createDataFrame([(i, at(i)) for i in (0, 1, 1, 2)], schema).write.parquet(source)

    def run():
        stream.ingest(stream.with_event_time(stream.read_files(spark, source, schema)), out, checkpoint, "id")
        return sorted(r.id for r in spark.read.parquet(out).collect())

    assert run() == [0, 1, 2]
    assert run() == [0, 1, 2]
    spark.createDataFrame([(i, at(i)) for i in (2, 3)], schema).write.mode("append").parquet(source)
    assert run() == [0, 1, 2, 3]


def test_stream_takes_late_rows_and_replays(spark, tmp_path):
    source, out, counts_out, cp, cp2 = (str(tmp_path / n) for n in ("in", "out", "counts", "cp", "cp2"))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("k", T.StringType()), T.StructField("ts", T.TimestampNTZType())])
    day = lambda d: dt.datetime(2024, 1, d)
    for rows in ([("a", "x", day(20)), ("b", "x", day(20))], [("late1", "x", day(2)), ("late2", "y", day(1)), ("a", "x", day(20))]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        live = stream.with_event_time(stream.read_files(spark, source, schema))
        stream.ingest(live, out, cp, "id")
        stream.daily_counts(live, counts_out, cp2, "k", id_column="id")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "late1", "late2"]
    # what a broken micro-batch leaves beside the log is not read
    spark.read.schema(schema).parquet(source).limit(1).write.mode("append").parquet(f"{tmp_path}/stray")
    for n in os.listdir(f"{tmp_path}/stray"):
        if n.endswith(".parquet"):
            shutil.copy(f"{tmp_path}/stray/{n}", f"{out}/part-99999-left-over.parquet")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "late1", "late2"]
    got = {(r.drug, r.date.day): r["count"] for r in stream.latest_counts(spark, counts_out).collect()}
    assert got == {("x", 20): 2, ("x", 2): 1, ("y", 1): 1}


def test_upsert_takes_the_last_of_repeated_keys(spark):
    store = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    new = spark.createDataFrame([("a", 9, 1), ("a", 3, 2), ("c", 5, 1)], "id string, v int, place int")
    got = incremental.upsert(store, new, order="place").collect()
    assert sorted(map(tuple, got)) == [("a", 3), ("b", 1), ("c", 5)]


def test_wrongly_typed_answers_fail_their_batch_only(spark):
    schema = T.StructType([T.StructField("safetyreportid", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))])
    df = spark.createDataFrame([(str(i),) for i in range(6)], "safetyreportid string").coalesce(1)

    def load():
        def model(batch):
            out = batch[["safetyreportid"]].copy()
            out["tags"] = [7 if i == "3" else ["t"] for i in batch["safetyreportid"]]
            return out

        return model

    rows = inference.infer(df, load, schema, batch_size=2).collect()
    assert {r["safetyreportid"] for r in rows if r["error"]} == {"2", "3"} and len(rows) == 6


class LocalFrame:
    """Runs what infer hands to mapInPandas here, on the given Arrow batches' frames."""

    def __init__(self, *frames):
        self.frames = frames

    def mapInPandas(self, run, schema):  # noqa: N802
        return pd.concat(list(run(iter(self.frames))), ignore_index=True)


NUMBERED = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def test_types_are_checked_for_many_batches_at_once(monkeypatch):
    """Else 20 rows to a batch cost more to check than to label."""
    checks = []

    class RecordBatch:
        @staticmethod
        def from_pandas(frame, *args, **kwargs):
            checks.append(len(frame))
            return pa.RecordBatch.from_pandas(frame, *args, **kwargs)

    monkeypatch.setattr(inference, "pa", types.SimpleNamespace(RecordBatch=RecordBatch))
    table = pd.DataFrame({"id": [str(i) for i in range(9000)]})
    given = LocalFrame(table[:3333], table[3333:3340], table[3340:])
    sizes = []

    def model(batch):
        sizes.append(len(batch))
        return pd.DataFrame({"n": range(len(batch)), "id": batch["id"]})

    rows = inference.infer(given, lambda: model, NUMBERED, 20, "id")
    assert sizes == [20] * 450 and rows["id"].tolist() == table["id"].tolist() and rows["error"].isna().all()
    assert len(checks) <= 3 and sum(checks) == 9000


def test_each_failed_batch_keeps_its_own_reason():
    def model(batch):
        first = batch["id"][0]
        out = batch.assign(n=[int(i) for i in batch["id"]])
        if first == "2":
            raise KeyError("two")
        if first == "4":
            out["n"] = "four"
        if first == "6":
            out["id"] = "6"
        if first == "8":
            out["id"], out["n"] = "0", [[8], [9]]  # told by its types, which come first
        if first == "10":
            return out[["id"]]
        return out[:1] if first == "12" else out

    rows = inference.infer(LocalFrame(pd.DataFrame({"id": [str(i) for i in range(15)]})), lambda: model, NUMBERED, 2, "id")
    assert rows["id"].tolist() == [str(i) for i in range(13)] + ["14"]
    good = rows[rows["error"].isna()]
    assert good["n"].tolist() == [0, 1, 12, 14] and rows["n"].isna().sum() == 10
    why = rows.groupby("error", sort=False)["id"].agg(list).to_dict()
    assert list(why.values()) == [["2", "3"], ["4", "5"], ["6", "7"], ["8", "9"], ["10", "11"]]
    begins = ("KeyError: 'two'", "Arrow", "ValueError: answers to ids", "Arrow", "KeyError")
    assert all(reason.startswith(b) for reason, b in zip(why, begins, strict=True))


@pytest.fixture
def one_partition(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_fifty_micro_batches_cost_alike_and_leave_few_folders(spark, tmp_path, one_partition):
    """What a micro-batch writes and reads does not grow with what came before it."""
    source, out, counts_out, cp, cp2 = (str(tmp_path / n) for n in ("in", "out", "counts", "cp", "cp2"))
    schema = "id long, k string, ts timestamp"
    batches = 50
    rows = spark.range(200 * batches).selectExpr("id", "'k' || id % 3 AS k", "timestamp_seconds(86400 * (id % 7)) AS ts")
    # every file brings half of the one before again
    files_of = rows.selectExpr("*", "explode(array(id div 200, id div 200 + if(id % 2 = 0, 1, 0))) AS part")
    for n in range(batches):
        files_of.filter(f"part = {n}").drop("part").coalesce(1).write.mode("append").parquet(source)
    live = stream.read_files(spark, source, schema, files_per_batch=1)
    progress = stream.ingest(live, out, cp, "id").recentProgress
    assert len(progress) >= batches and progress[0]["stateOperators"][0]["customMetrics"].get("rocksdbPutCount", 0) > 0
    read = [p["stateOperators"][0]["customMetrics"]["rocksdbTotalBytesRead"] for p in progress][:batches]
    written = [p["stateOperators"][0]["customMetrics"]["rocksdbBytesCopied"] for p in progress][:batches]
    assert sorted(read[-10:])[5] <= 2 * max(sorted(read[5:15])[5], 1)
    assert sorted(written[-10:])[5] <= 2 * max(sorted(written[5:15])[5], 1)
    assert spark.read.parquet(out).count() == spark.read.parquet(out).distinct().count() == 200 * batches

    query = stream.daily_counts(live, counts_out, cp2, "k", id_column="id", compact_every=4)
    assert query.lastProgress["batchId"] >= batches - 1
    assert sum(len(os.listdir(f"{counts_out}/{kind}")) for kind in ("changes", "whole")) <= 2 * 4 + 2
    expected = {(r[0], r[1]): r[2] for r in rows.groupBy("k", F.to_date("ts")).count().collect()}
    told = lambda: {(r.drug, r.date): r["count"] for r in stream.latest_counts(spark, counts_out).collect()}
    assert told() == expected
    newest = max(int(n) for n in os.listdir(f"{counts_out}/whole"))
    stream._compact(spark, counts_out, newest)  # a micro-batch once more
    assert told() == expected
    os.remove(f"{counts_out}/whole/{newest}/_SUCCESS")  # broken off in the middle
    assert told() == expected


def test_stream_counts_equal_batch(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("ts", T.TimestampNTZType())])
    rows = [("ab"[i % 2], dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * i)) for i in range(40)]
    for part in (rows[:25], rows[25:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(source)
        live = stream.with_event_time(stream.read_files(spark, source, schema))
        stream.daily_counts(live, out, checkpoint, "k")
    got = {(r.drug, r.date): r["count"] for r in stream.latest_counts(spark, out).collect()}
    expected = {}
    for k, ts in rows:
        expected[(k, ts.date())] = expected.get((k, ts.date()), 0) + 1
    assert got == expected
