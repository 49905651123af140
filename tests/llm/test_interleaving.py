"""Interleaved shards: plain ranks, even counts, the mixture of every shard."""

from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from casewatch.llm import interleaving, queries


def table_of(spark, counts):
    rows = [(i, f"text {s} {i}", s) for s, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("counts", [{"a": 700, "b": 200, None: 100, "c": 3}, {f"s{i}": 1 for i in range(500)}, {"a": 5}])
def test_shards_match_the_mixture(spark, counts):
    rows = interleaving.sharded(table_of(spark, counts), bucket_rows=20).collect()
    total = sum(counts.values())
    assert len(rows) == total and sorted(r["position"] for r in rows) == list(range(total))
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes[s] for s in range(8)) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    for source, n in counts.items():
        held = Counter(r["shard"] for r in rows if r["source"] == source)
        slack = 2 + 2 * Fraction(n * len(counts), total)
        assert all(abs(held[s] - Fraction(n, 8)) <= slack for s in range(8))


def test_order_does_not_depend_on_buckets_or_partitions(spark):
    docs = table_of(spark, {"a": 300, "b": 50, None: 20})
    key = lambda r: (str(r["source"]), r["doc_id"], r["position"], r["shard"], r["slot"])
    one = sorted(map(key, interleaving.sharded(docs, bucket_rows=10**6).collect()))
    assert sorted(map(key, interleaving.sharded(docs.repartition(7), bucket_rows=3).collect())) == one
    other = sorted(map(key, interleaving.sharded(docs, seed="x").collect()))
    assert [r[:2] for r in other] == [r[:2] for r in one] and other != one


def test_blocks_of_buckets(spark, monkeypatch):
    docs = table_of(spark, {"a": 300, "b": 50})
    key = lambda r: (r["source"], r["doc_id"], r["position"])
    one = sorted(map(key, interleaving.sharded(docs).collect()))
    monkeypatch.setattr(interleaving, "BLOCK_BUCKETS", 3)
    assert sorted(map(key, interleaving.sharded(docs, bucket_rows=2).collect())) == one


def test_awkward_rows(spark):
    rows = [(1, "x", "s"), (1, "x", "s"), (1, None, "s"), (1, "", None), (None, None, None), (None, "x", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for clash in ("shard", "slot", "position", "row", "rank", "bucket", "before", "stratum", "digest", "n", "fraction"):
        docs = docs.withColumn(clash, F.lit("clash"))
    got = interleaving.sharded(docs)
    assert got.columns == [c for c in docs.columns if c not in ("shard", "slot", "position")] + ["shard", "slot", "position"]
    kept = sorted([(r["doc_id"], r["text"], r["source"], r["row"]) for r in got.collect()], key=str)
    assert kept == sorted([(*r, "clash") for r in rows], key=str)
    assert interleaving.sharded(docs.limit(0)).count() == 0 and interleaving.assigned(docs.limit(0)).count() == 0
    assert sorted(r["shard"] for r in interleaving.assigned(docs, shards=3).collect()) == [0, 0, 1, 1, 2, 2]


def test_more_shards_than_rows(spark):
    got = interleaving.sharded(table_of(spark, {"a": 10, "b": 3}), shards=1000).collect()
    assert {r["slot"] for r in got} == {0} and len({r["shard"] for r in got}) == 13


def test_written_shards(spark, tmp_path):
    docs = table_of(spark, {"a": 60, "b": 20, None: 5})
    interleaving.write_shards(docs, f"{tmp_path}/out", file_rows=10)
    back = spark.read.parquet(f"{tmp_path}/out")
    columns = ["doc_id", "text", "source", "shard", "slot", "position"]
    key = lambda r: tuple(map(str, r))
    assert sorted(back.select(columns).collect(), key=key) == sorted(interleaving.sharded(docs).select(columns).collect(), key=key)


def test_query_covers_all_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = queries.op13_sharding(spark, folder).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
