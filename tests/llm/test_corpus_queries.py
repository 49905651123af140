"""Registered corpus queries against their SQL, and the pipeline stage by stage."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import check_oracle  # noqa: E402
import corpus_pipeline  # noqa: E402
from casewatch.llm import queries  # noqa: E402
from casewatch.plans import registry  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, folder, monkeypatch, name):
    monkeypatch.setitem(registry.QUERIES, name, queries.QUERIES[name])
    assert check_oracle.compare(spark, check_oracle.connect(folder), name, queries.SQL[name], folder) == ""


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    kept = before
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, spark.createDataFrame(list(kept.values()), docs.schema), folder)
        assert docs.columns == list(corpus_pipeline.table(spark, folder, "documents").columns)
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(kept)
        if name == "redact":
            assert set(after) == set(kept) and all(r["n_chars"] == len(r["text"]) for r in after.values())
        else:
            assert all(after[i] == kept[i] for i in after) and len(after) < len(kept)
        kept = after
    last = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in last} == set(kept)


def test_pipeline_of_nothing(spark, folder):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
