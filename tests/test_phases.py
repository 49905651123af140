"""All phases end to end over generated report pages, run twice where they can resume."""

import datetime as dt
import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from casewatch.plans import phases
from casewatch.sources import archive, files

START = dt.date(2023, 1, 1)
DRUGS = ("metformin", "ibuprofen")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Two drugs over 150 days with one day full of hepatic reports."""
    base = tmp_path_factory.mktemp("phases")
    (base / "pages").mkdir()
    rng = np.random.default_rng(0)
    reports, n = [], 0
    for day in range(150):
        for drug in DRUGS:
            spike = drug == "metformin" and day == 120
            for _ in range(40 if spike else 2 + rng.poisson(2)):
                n += 1
                named = [drug.upper() + " 500 MG"] + (["ibuprofen"] if n % 17 == 0 else [])
                reports.append(
                    {
                        "safetyreportid": str(n),
                        "receivedate": (START + dt.timedelta(days=day)).strftime("%Y%m%d"),
                        "serious": "1" if spike or n % 5 else "2",
                        "seriousnesshospitalization": "1",
                        "patient": {
                            "patientsex": "2",
                            "reaction": [{"reactionmeddrapt": "Jaundice" if spike else "Nausea"}],
                            "drug": [{"medicinalproduct": d} for d in named],
                        },
                    }
                )
    for i in range(0, len(reports), 200):
        page = {"results": reports[i : i + 200]}
        (base / "pages" / f"{i}.json").write_text(json.dumps(page))
    return base


def at(folder, name):
    return str(folder / name)


def test_reports_to_labels_to_store(spark, folder):
    pages, summaries, results = (at(folder, n) for n in ("pages", "summaries", "labels"))
    phases.ingest_reports(spark, pages, summaries, DRUGS, per_drug_limit=600)  # reaches past the spike day
    flat = spark.read.parquet(summaries)
    assert flat.count() == flat.select("safetyreportid").distinct().count() > 500

    for run in range(2):
        phases.categorize_pending(spark, summaries, results, run, per_drug=100)
    # two runs of at most 100 reports for each of the two drugs
    assert phases.labels_status(spark, summaries, results).first().done == 2 * 100 * len(DRUGS)
    phases.categorize_pending(spark, summaries, results, 3)
    assert phases.labels_status(spark, summaries, results).first().percent == 100.0

    categorized = at(folder, "categorized")
    assert phases.merge_categorized(spark, summaries, results, categorized).first().n_changed == 0
    organs = {r[0] for r in spark.read.parquet(categorized).select("primary_organ_system").distinct().collect()}
    assert organs == {"gastrointestinal", "hepatic"}

    store, model_path = at(folder, "store1"), at(folder, "model")
    phases.build_store(spark, categorized, store, model_path=model_path)
    model = phases.build_store(spark, categorized, store, model_path)  # nothing left to add
    status = phases.store_status(spark, store, categorized).first()
    assert status.done == status.total == flat.count()
    hits = phases.search_text(spark, store, model, "jaundice", 3, {"primary_organ_system": "hepatic"}).collect()
    assert len(hits) == 3 and all("Jaundice" in h.document for h in hits)

    template, report = at(folder, "template"), at(folder, "report")
    phases.label_template(spark, categorized, template, total=20)
    assert phases.score_labels(spark, template, report).first().n_labelled == 0


def test_counts_to_explanations_to_scores(spark, folder):
    pages, daily, anomalies, results = (at(folder, n) for n in ("pages", "counts", "anomalies", "explained"))
    totals = {r.drug: r.n_days for r in phases.ingest_counts(spark, pages, daily, DRUGS).collect()}
    assert set(totals) == set(DRUGS)
    flagged = {r.drug: r.n_anomalies for r in phases.detect(spark, daily, anomalies).collect()}
    assert flagged["metformin"] >= 1 and flagged[None] == sum(v for k, v in flagged.items() if k)

    phases.diagnose(spark, anomalies, pages, results, DRUGS)
    once = spark.read.parquet(results).count()
    phases.diagnose(spark, anomalies, pages, results, DRUGS)
    assert spark.read.parquet(results).count() == once == flagged[None]
    status = phases.diagnoses_status(spark, anomalies, results).first()
    assert status.done == status.total

    merged = at(folder, "explanations")
    phases.merge_diagnoses(spark, results, merged)
    spike = START + dt.timedelta(days=120)
    rows = spark.read.parquet(results).filter((F.col("drug") == "metformin") & (F.col("date") == str(spike)))
    assert rows.first().dominant_organ_systems == ["hepatic"] and rows.first().n_context_reports == 8

    scores = at(folder, "scores")
    first = phases.judge(spark, merged, pages, scores, DRUGS).first()
    again = phases.judge(spark, merged, pages, scores, DRUGS).first()
    assert first == again and first.n == once and 0 < first.mean_score <= 1

    truth = at(folder, "truth")
    seeds = {("metformin", str(spike)): {"is_real_signal": "Y"}}
    phases.anomaly_template(spark, merged, truth, seeds)
    got = phases.score_anomalies(spark, truth, at(folder, "precision")).first()
    assert (got.n_flagged, got.n_labelled, got.precision) == (once, 1, 1.0)


def logged(log, answer):
    """A model that writes the ids it is asked to a file."""

    def load():
        def model(batch):
            with open(log, "a") as f:
                f.writelines(f"{i}\n" for i in batch.iloc[:, 0])
            return answer(batch)

        return model

    return load


def test_broken_run_keeps_what_a_model_has_answered(spark, tmp_path, monkeypatch):
    rows = [(str(i), "a", "20240101", "male", "1", "Rash", "A", "", f"text {i}") for i in range(60)]
    spark.createDataFrame(rows, phases.schemas.PATIENT_SUMMARIES).write.parquet(str(tmp_path / "summaries"))
    summaries, results, log = (str(tmp_path / n) for n in ("summaries", "labels", "log"))

    def answer(batch):
        tags = [["t"]] * len(batch)
        return pd.DataFrame({"id": batch["id"], "category_tags": tags}).assign(
            primary_organ_system="x", severity="mild", likely_causal_drug=None, rationale=None
        )

    append, calls = files.append_results, []

    def breaks(df, path):
        calls.append(path)
        if len(calls) == 3:
            raise RuntimeError("lost")
        append(df, path)

    monkeypatch.setattr(files, "append_results", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        phases.categorize_pending(spark, summaries, results, 1, logged(log, answer), batch_size=5, slices=4)
    assert 0 < spark.read.parquet(results).count() < 60
    phases.categorize_pending(spark, summaries, results, 2, logged(log, answer), batch_size=5, slices=4)
    asked = open(log).read().split()
    assert len(asked) == len(set(asked)) == 60 == spark.read.parquet(results).count()


def test_models_explain_judge_and_embed(spark, folder):
    pages, anomalies, categorized = (at(folder, n) for n in ("pages", "anomalies", "categorized"))
    results, scores, merged, log = (at(folder, n) for n in ("m-explained", "m-scores", "m-merged", "log"))

    def explain(batch):
        assert batch["text"].str.startswith("Drug: ").all()
        systems = [["Hepatic"]] * len(batch)
        return pd.DataFrame({"entity_id": batch["entity_id"], "dominant_organ_systems": systems}).assign(
            summary="s", dominant_severity="Death", notable_pattern="p", confidence_caveat="c"
        )

    def score(batch):
        assert batch["text"].str.contains("CLAIM:\nOrgan systems affected: ['hepatic']", regex=False).all()
        return pd.DataFrame({"entity_id": batch["entity_id"], "score": 0.25, "justification": "j"})

    for _ in range(2):
        phases.diagnose(spark, anomalies, pages, results, DRUGS, load=logged(log, explain), slices=2)
    assert len(open(log).read().split()) == spark.read.parquet(results).count() > 0
    phases.merge_diagnoses(spark, results, merged)
    found = phases.judge(spark, merged, pages, scores, DRUGS, load=logged(log, score), slices=2).first()
    assert (found.mean_score, found.n) == (0.25, spark.read.parquet(results).count())

    def lengths(batch):
        return pd.DataFrame({"id": batch["id"], "embedding": [[1.0, float("Jaundice" in t)] for t in batch["document"]]})

    store = at(folder, "m-store")
    phases.build_store(spark, categorized, store, load=lambda: lengths)
    hits = phases.search_text(spark, store, None, "Jaundice", 3, load=lambda: lengths).collect()
    assert len(hits) == 3 and all("Jaundice" in h.document for h in hits)


def test_archive_parses_each_page_once(spark, folder, tmp_path, monkeypatch):
    pages, kept = tmp_path / "pages", str(tmp_path / "archive")
    pages.mkdir()
    names = sorted(os.listdir(folder / "pages"))
    for name in names[:3]:
        (pages / name).write_text((folder / "pages" / name).read_text())
    parsed = []
    plain = files.read_report_pages
    monkeypatch.setattr(files, "read_report_pages", lambda s, paths: parsed.append(len(paths)) or plain(s, paths))
    key = lambda r: (r.safetyreportid, r.receivedate)
    assert archive.update(spark, str(pages), kept) == 3 and archive.update(spark, str(pages), kept) == 0
    odd = {"results": [{"safetyreportid": "x", "receivedate": "soon"}, {"safetyreportid": "y"}]}
    (pages / "odd.json").write_text(json.dumps(odd))
    assert archive.update(spark, str(pages), kept) == 1 and parsed == [3, 1]
    assert sorted(map(str, map(key, archive.read(spark, kept).collect()))) == sorted(map(str, map(key, plain(spark, str(pages)).collect())))
    (pages / names[3]).write_text((folder / "pages" / names[3]).read_text())
    update = archive.update(spark, str(pages), kept)
    for n in os.listdir(f"{kept}/pages/2"):  # as if broken off before the list of pages was complete
        if n == "_SUCCESS":
            os.remove(f"{kept}/pages/2/{n}")
    before = archive.read(spark, kept).count()
    assert update == 1 and archive.update(spark, str(pages), kept) == 1
    assert archive.read(spark, kept).count() == plain(spark, str(pages)).count() > before


def test_phases_by_way_of_the_archive(spark, folder, tmp_path, monkeypatch):
    pages, kept, anomalies = at(folder, "pages"), str(tmp_path / "archive"), at(folder, "anomalies")
    plain = phases.ingest_counts(spark, pages, str(tmp_path / "c1"), DRUGS).collect()
    assert phases.ingest_counts(spark, pages, str(tmp_path / "c2"), DRUGS, archive=kept).collect() == plain
    monkeypatch.setattr(files, "read_report_pages", None)  # from here on no page is parsed
    phases.diagnose(spark, anomalies, pages, str(tmp_path / "found"), DRUGS, archive=kept)
    monkeypatch.undo()
    phases.diagnose(spark, anomalies, pages, str(tmp_path / "plain"), DRUGS)
    key = lambda path: sorted(map(str, spark.read.parquet(str(tmp_path / path)).collect()))
    assert key("found") == key("plain") != []
    some = archive.read(spark, kept, {"202203"})
    plan = some._jdf.queryExecution().toString()
    assert "PartitionFilters: [(month" in plan or "PartitionFilters: [isnotnull(month" in plan
    assert {r[0][:6] for r in some.select("receivedate").distinct().collect()} <= {"202203"}
    assert archive.months_between("2022-11-30", "2023-02-01") == {"202211", "202212", "202301", "202302"}


def test_slices_follow_the_number_of_batches(spark, tmp_path):
    rows = spark.range(200).selectExpr("cast(id as string) AS id")
    sizes = []
    work = lambda part: sizes.append(part.count()) or part
    phases.append_in_slices(rows, "id", work, str(tmp_path / "a"), batch_size=1000)
    assert sizes == [200]
    sizes.clear()
    monkey = phases.BATCHES_PER_TASK
    phases.BATCHES_PER_TASK = 1
    try:
        phases.append_in_slices(rows, "id", work, str(tmp_path / "b"), batch_size=5)
    finally:
        phases.BATCHES_PER_TASK = monkey
    assert len(sizes) == -(-200 // (5 * spark.sparkContext.defaultParallelism)) and sum(sizes) == 200
    assert spark.read.parquet(str(tmp_path / "b")).distinct().count() == 200


def test_imported_batches_and_foreign_tables(spark, tmp_path):
    folder = tmp_path / "batches"
    folder.mkdir()
    (folder / "b1.json").write_text('{"reports": [{"id": "1", "severity": "unknown"}]}')
    (folder / "b2.json").write_text('{"reports": [{"id": "1", "severity": "mild"}, {"id": "2"}]}')
    (folder / "bad.json").write_text("{")
    results = str(tmp_path / "labels")
    assert [r[0] for r in phases.import_label_batches(spark, str(folder), results).collect()] == ["bad.json"]
    first = phases.incremental.first_labels(spark.read.parquet(results), phases.severity_by_lookup)
    assert {(r.safetyreportid, r.severity) for r in first.collect()} == {("1", "moderate"), ("2", None)}

    table = tmp_path / "e.csv"
    table.write_text(
        "drug,date,count,expected_count,zscore,n_context_reports,summary,dominant_organ_systems,"
        "dominant_severity,notable_pattern,confidence_caveat\n"
        "a,2022-03-02,54,29.07,2.71,8,\"x, y\",\"['skin', 'renal']\",fatal,p,c\n"
    )
    row = phases.read_foreign_explanations(spark, str(table)).first()
    assert row.dominant_organ_systems == ["skin", "renal"] and (row["count"], row.zscore) == (54, 2.71)

    days = tmp_path / "days"
    days.mkdir()
    (days / "x.json").write_text(json.dumps({"drug": "a", "date": "2022-03-02", "dominant_organ_systems": ["Skin"]}))
    assert phases.import_explanations(spark, str(days)).first().dominant_organ_systems == ["Skin"]
