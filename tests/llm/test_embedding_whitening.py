"""Whitened embeddings against a dense eigendecomposition and exact sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewatch.llm import embedding_whitening as whitening
from casewatch.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vectors):
    return np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000


def held_against(rows, ids, vectors, k, digits=1e-9):
    """rows of a result against numpy on the vectors that belong to ids (unique, none dropped)."""
    x = whole(vectors)
    n, d = x.shape
    y = n * x.astype(object) - x.astype(object).sum(axis=0)
    exact = (y * y).sum(axis=1)
    centred = x - x.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == n * k
    w = np.array([[got[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    expected = centred @ u / np.sqrt(e)
    sign = np.sign((w * expected).sum(axis=0))
    assert np.abs(w - expected * sign).max() < digits
    for i, dev in zip(ids, exact):
        for c in range(k):
            r = got[i, c + 1]
            assert r["n"] == n and r["deviation"] == dev
            assert r["explained"] == pytest.approx(e[c] / np.trace(centred.T @ centred / n), rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-10
    assert len({r["identity_error"] for r in rows}) == 1


def test_query_equals_dense_eigenvectors(spark, folder):
    source = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = queries.op12_embedding_whitening(spark, folder).collect()
    held_against(rows, [r["vec_id"] for r in source], [r["embedding"] for r in source], 8)


@pytest.mark.parametrize("shape", ["steep", "flat", "narrow", "repeats"])
def test_spectra(spark, shape):
    rng = np.random.default_rng(3)
    d = {"narrow": 5}.get(shape, 40)
    vectors = rng.standard_normal((300, d))
    if shape == "steep":
        vectors *= 1.7 ** -np.arange(d)
        vectors[:, 0] *= 50
    if shape == "repeats":
        vectors[100:] = vectors[0]
    rows = spark.createDataFrame([(i, [float(e) for e in v], 0) for i, v in enumerate(vectors)], SCHEMA)
    held_against(whitening.whiten(rows).collect(), range(300), vectors, min(8, d), 1e-8)


class Dense:
    """A covariance that is at hand as a matrix."""

    def __init__(self, matrix):
        self.matrix, self.base, self.trace, self.passes = matrix, np.zeros(len(matrix)), float(np.trace(matrix)), 0

    def products(self, *matrices, squares=False):
        self.passes += 1
        return [self.matrix @ m for m in matrices]


@pytest.mark.parametrize("tail", [0.2, 0.9, 0.99])
def test_eigenpairs_of_close_spectra(tail):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    values = np.concatenate([[90.0, 12.0], np.linspace(1.3, 1.0, 10), np.linspace(tail, tail / 2, 188)])
    v = Dense(turn * values @ turn.T)
    got, vectors = whitening.eigenpairs(v, 8)
    assert np.abs(got - values[:8]).max() < 1e-11
    assert np.abs(np.abs((vectors * turn[:, :8]).sum(axis=0)) - 1).max() < 1e-12
    assert v.passes < 200


def test_equal_eigenvalues_and_no_variance():
    got, vectors = whitening.eigenpairs(Dense(np.eye(60)), 8)
    assert np.allclose(got, 1) and np.allclose(vectors.T @ vectors, np.eye(8))
    assert not whitening.eigenpairs(Dense(np.zeros((60, 60))), 8)[0].any()


def test_says_when_it_is_not_certified():
    matrix = np.diag(np.linspace(1, 2, 300))
    with pytest.raises(whitening.NotCertified):
        whitening.eigenpairs(Dense(matrix), 8, degree=2, cycles=2)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0], 1), (1, [0.5, 1.0], 1), (None, [-0.25, 0.125], 1), (4, [2.0, -1.0], None)]
    bad = [(5, None, 0), (6, [], 0), (7, [1.0, None], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [1.0, 2.0, 3.0], 0)]
    rows = spark.createDataFrame(good + bad, SCHEMA)
    for clash in ("x", "component", "n", "deviation", "whitened", "explained", "at", "part"):
        rows = rows.withColumn(clash, F.lit("clash"))
    got = whitening.whiten(rows).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((str(i), c) for i in (1, 1, None, 4) for c in (1, 2))
    assert all(r["n"] == 4 and r["whitened"] is not None for r in got)
    assert whitening.whiten(rows.filter("vec_id > 4 and vec_id < 10")).count() == 0
    assert whitening.whiten(rows.limit(0)).count() == 0


def test_without_variance(spark):
    rows = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(3)], SCHEMA)
    got = whitening.whiten(rows).collect()
    assert len(got) == 9
    assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, None, None, None)}
    few = whitening.whiten(spark.createDataFrame([(0, [1.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0)], SCHEMA)).collect()
    assert {r["component"] for r in few if r["whitened"] is not None} == {1}
    assert all(r["identity_error"] < 1e-12 for r in few)


def test_huge_entries_count_as_the_limit(spark):
    rows = spark.createDataFrame([(0, [3e38, 1.0], 0), (1, [-3e38, 1.0], 0), (2, [1.0, 5.0], 0)], SCHEMA)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(rows).collect()}
    x = np.array([[2**40 + 100_000, 101_024], [100_000 - 2**40, 101_024], [101_024, 105_120]], object)
    y = 3 * x - x.sum(axis=0)
    assert [got[i, 1]["deviation"] for i in range(3)] == list((y * y).sum(axis=1))
