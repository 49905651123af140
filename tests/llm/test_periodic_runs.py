"""Periodic runs against a search that compares all words for every period."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casewatch.llm import periodic_runs, queries


def slow_runs(w, least=12):
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            start, stop = i, j + q
            if stop - start >= max(least, 2 * q) and not any(w[start : stop - p] == w[start + p : stop] for p in range(1, q)):
                found.append((start, stop, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def fast_runs(w, least=12):
    got = periodic_runs.find_runs(np.array(w, np.int64), np.zeros(len(w), np.int64), least)
    return [tuple(map(int, r)) for r in got]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def stretches():
    word = st.integers(0, 2)
    piece = st.builds(lambda u, k, tail: u * k + tail, st.lists(word, min_size=1, max_size=9), st.integers(1, 6), st.lists(word, max_size=4))
    return st.lists(piece, max_size=4).map(lambda parts: [w for p in parts for w in p])


@settings(max_examples=400, deadline=None)
@given(stretches(), st.sampled_from([2, 12]))
def test_equals_search_for_every_period(w, least):
    assert fast_runs(w, least) == slow_runs(w, least)


@pytest.mark.parametrize("least", [2, 12])
def test_words_with_many_runs(least):
    thue = [bin(i).count("1") % 2 for i in range(160)]
    for w in (fibonacci(180), fibonacci(55) * 3, thue, thue * 2, [0] * 60, [0] * 20 + [1] + [0] * 15 + [1] + [0] * 15):
        assert fast_runs(w, least) == slow_runs(w, least)


def test_wide_numbers_are_ordered_without_packing():
    w = np.array([2**40, 5, 2**40, 5] * 8 + [7], np.int64)
    assert [tuple(r) for r in periodic_runs.find_runs(w, np.zeros(len(w), np.int64) + 2**30)] == [(0, 32, 2)]


def test_no_run_goes_over_the_end_of_a_text():
    w, texts = np.zeros(30, np.int64), np.repeat([0, 1, 2], [11, 12, 7])
    assert [tuple(map(int, r)) for r in periodic_runs.find_runs(w, texts)] == [(11, 23, 1)]


def test_very_long_repetitive_text(spark):
    rows = spark.createDataFrame([(1, "a b c " * 100_000), (2, "x " * 320_000)], "id long, text string")
    got = {r["id"]: r for r in periodic_runs.runs_of(rows).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 300_000, 3)] and got[1]["collapsed"] == "a b c"
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 320_000, 1)] and got[2]["collapsed"] == "x"


def test_chunks_change_nothing(spark):
    texts = [" ".join(np.random.default_rng(i).choice(["a", "b"], i).tolist()) for i in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    whole = {r["id"]: r for r in periodic_runs.runs_of(rows).collect()}
    for most in (1, 37):
        assert {r["id"]: r for r in periodic_runs.runs_of(rows, chunk_words=most).collect()} == whole


def test_nulls_and_own_columns(spark):
    schema = "runs string, n_words string, words array<string>, collapsed int, period int"
    rows = spark.createDataFrame([("r", "n", None, 1, 2), ("r", "n", [], 1, 2), ("r", "n", ["a", None] * 12, 1, 2)], schema)
    got = periodic_runs.periodic_runs(rows)
    assert got.columns == ["period", "n_words", "runs", "collapsed"]
    assert sorted((r["n_words"], len(r["runs"]), r["collapsed"], r["period"]) for r in got.collect()) == [
        (0, 0, "", 2), (0, 0, "", 2), (12, 1, "a", 2),
    ]


def slow_report(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(w)
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    numbers = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (
        doc_id, len(runs), *numbers, sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)),
        sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_query_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    small = {r["doc_id"]: r["text"] for r in docs.collect() if len(r["text"] or "") < 6000}
    got = {r["doc_id"]: tuple(r) for r in queries.op11_periodic_runs(spark, folder).collect()}
    assert set(small) <= set(got) and len(got) == docs.count()
    assert {i: got[i] for i in small} == {i: slow_report(i, t) for i, t in small.items()}
    assert sum(r[1] > 0 for r in got.values()) > len(got) // 20


def test_report_of_awkward_ids(spark):
    rows = [(None, "a " * 40), (3, None), (7, ""), *[(i, "one two three four five six seven eight nine ten " * (i % 4)) for i in range(60)]]
    got = periodic_runs.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted((slow_report(*r) for r in rows), key=key)
    assert periodic_runs.report(spark.createDataFrame([(1, "a")], "doc_id long, text string").filter(F.lit(False))).count() == 0
