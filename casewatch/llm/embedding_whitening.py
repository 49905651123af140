"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x = floor(SCALE c) + OFFSET. With V the covariance of x (divisor n), the leading unit
eigenvectors come from a block of as many random vectors and GUARD more:

1. A Chebyshev polynomial of V, as a three-term recurrence, damps what lies in the unwanted part of the spectrum.
   Every step is one distributed pass: tasks centre their rows before multiplying and send Xc'(Xc Q), a matrix as
   wide as the block, to be summed in Spark. The unwanted part ends at the block's smallest Ritz value; it begins
   where a Lanczos vector, which rides along as one more column, saw the spectrum begin.
2. QR and Rayleigh-Ritz on the filtered block, with FRESH random columns that would show a missed direction.
3. Certified are eigenpairs whose residual is at most TOLERANCE times the largest eigenvalue in two cycles on end
   that agree in the eigenvalues; cycles go on while residuals still fall, to the precision of doubles.

The driver holds matrices of (dimension x block) only. The rows are read from a table in the shared folder, so
lost executors cost their tasks of one pass. Sums of doubles depend on the order in which tasks end: the last digits
of the results may differ between runs.
"""

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from casewatch.sources.workspace import staged

SCALE = 1024.0
OFFSET = 100_000
WIDEST = float(1 << 40)  # scaled entries beyond it, either way, count as it
COMPONENTS = 8
GUARD = 16
FRESH = 3
DEGREE = 10
SPREAD = 1e10  # one cycle may amplify the first wanted direction by so much more than the last
TOLERANCE = 1e-12
CYCLES = 200
SEED = 12


class NotCertified(RuntimeError):
    """The residuals did not reach the tolerance within the cycles allowed."""


def integers(rows, keep=("vec_id",), vector="embedding"):
    """keep and x, whole-numbered vectors of the rows that can be used.

    Dropped are rows whose vector is null, holds null or non-finite entries, or has not the most frequent length
    (of equally frequent ones the longest; empty vectors never count). Repeated rows stay.
    """
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))), F.lit(False)))
    good = rows.filter(F.coalesce((F.size(vector) > 0) & finite, F.lit(False)))
    limit = F.lit(WIDEST)
    x = F.transform(values, lambda e: F.floor(F.greatest(F.least(e * SCALE, limit), -limit)) + OFFSET)
    return good.select(*keep, x.alias("x"))


def _matrix(column):
    """Rows of a list array of equal lengths as a matrix of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64, copy=False)


def _summed(table, of, shape):
    """Sum over all rows of a matrix that of() tells for a block of them; one small row per entry and task is shuffled."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            entries = [pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())]
            yield pa.RecordBatch.from_arrays(entries, ["at", "part"])

    parts = table.select("x").mapInArrow(run, "at int, part double")
    out = np.zeros(shape)
    for r in parts.groupBy("at").agg(F.sum("part")).collect():  # as many rows as the matrix has entries
        out.flat[r[0]] = r[1]
    return out


class Covariance:
    """The covariance of staged vectors, known by its products with narrow matrices."""

    def __init__(self, table, n, sums):
        self.table, self.n, self.passes = table, n, 0
        self.sums = sums
        self.base = np.array([round(s / n) for s in sums], np.int64)  # whole part of the mean
        self.rest = np.array([float(Decimal(s - n * int(b)) / n) for s, b in zip(sums, self.base)])
        self.trace = 0.0

    def products(self, *matrices, squares=False):
        """V times each matrix; squares also finds the trace of V."""
        q = np.concatenate(matrices, axis=1)
        d, width = q.shape
        base, rest = self.base, self.rest

        def products_of(x):
            rows = (x - base) - rest
            own = np.einsum("ij,ij->j", rows, rows) if squares else np.zeros(d)
            return np.concatenate([rows.T @ (rows @ q), own[:, None]], axis=1)

        out = _summed(self.table, products_of, (d, width + 1)) / self.n
        self.passes += 1
        if squares:
            self.trace = float(out[:, width].sum())
        return np.split(out[:, :width], np.cumsum([m.shape[1] for m in matrices])[:-1], axis=1)


class _Lanczos:
    """One vector's Lanczos steps; tells where the spectrum begins, less the error bound of that."""

    def __init__(self, d, rng):
        v = rng.standard_normal((d, 1))
        self.basis, self.alphas, self.betas = [v / np.linalg.norm(v)], [], []

    @property
    def vector(self):
        return self.basis[-1]

    def step(self, product):
        v = self.basis[-1]
        self.alphas.append((v.T @ product).item())
        w = product.copy()
        for u in self.basis * 2:  # orthogonal to double precision
            w -= u * (u.T @ w).item()
        beta = float(np.linalg.norm(w))
        open_end = beta > 1e-10 * max(abs(self.alphas[0]), 1e-300) and len(self.basis) < len(v)
        self.betas.append(beta if open_end else 0.0)
        self.basis.append(w / beta if open_end else v)
        return open_end

    def low(self):
        n = len(self.alphas)
        if not n:
            return 0.0
        values, vectors = np.linalg.eigh(np.diag(self.alphas) + np.diag(self.betas[: n - 1], 1) + np.diag(self.betas[: n - 1], -1))
        return max(0.0, values[0] - self.betas[-1] * abs(vectors[-1, 0]))


def _ritz(basis, image):
    """Ritz values, falling, and vectors and their images under V of an orthonormal basis."""
    h = basis.T @ image
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], basis @ turn, image @ turn


def eigenpairs(v, k, guard=GUARD, fresh=FRESH, degree=DEGREE, tolerance=TOLERANCE, cycles=CYCLES, seed=SEED):
    """The k largest eigenvalues, falling, and unit eigenvectors (as columns) of a Covariance, certified.

    All zero without variance. Vectors of equal eigenvalues are any orthonormal ones of their space. Each vector's
    largest entry is positive. Raises NotCertified if the cycles do not suffice.
    """
    d = len(v.base)
    block = min(d, k + guard)
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((d, block)))[0]
    lanczos, riding = _Lanczos(d, rng), True
    (image, lane) = v.products(q, lanczos.vector, squares=True)
    riding = lanczos.step(lane)
    values, q, image = _ritz(q, image)
    if v.trace <= 0:
        return np.zeros(k), np.eye(d)[:, :k]
    before, best, calm = None, np.inf, 0
    for _ in range(cycles):
        top = max(values[0], v.trace / d)
        residual = np.linalg.norm(image[:, :k] - q[:, :k] * values[:k], axis=0).max() / top
        settled = before is not None and np.abs(values[:k] - before).max() <= tolerance * top
        if residual <= tolerance and (settled or block == d):
            calm = calm + 1 if residual > best / 2 else 0
            if calm or block == d:
                vectors = q[:, :k]
                sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
                return values[:k], vectors * sign
        best, before = min(best, residual), values[:k]
        high = max(values[block - 1], 0.0)
        low = min(lanczos.low(), high)
        half, centre = max((high - low) / 2, 1e-9 * top), (high + low) / 2
        first, last = (np.arccosh(max(1.0, (values[i] - centre) / half)) for i in (0, k - 1))
        steps = int(np.clip(np.log(SPREAD) / max(first - last, 1e-9), 2, degree))
        scale = half / max(values[0] - centre, half)
        sigma = scale
        extra = rng.standard_normal((d, min(fresh, d - block)))
        old = np.concatenate([q, extra / np.linalg.norm(extra, axis=0)], axis=1)
        new = None
        for _ in range(steps):
            at = old if new is None else new
            if riding:
                image, lane = v.products(at, lanczos.vector)
                riding = lanczos.step(lane)
            else:
                (image,) = v.products(at)
            if new is None:
                new = (image - centre * old) * (sigma / half)
            else:
                following = 1 / (2 / scale - sigma)
                old, new = new, (image - centre * new) * (2 * following / half) - old * (sigma * following)
                sigma = following
        basis = np.linalg.qr(new / np.maximum(np.linalg.norm(new, axis=0), 1e-300))[0]
        (image,) = v.products(basis)
        values, q, image = _ritz(basis, image)
        values, q, image = values[:block], q[:, :block], image[:, :block]
    raise NotCertified(f"residual {residual:.1e} of the largest eigenvalue after {cycles} cycles")


def _totals(table):
    """Number of vectors per length, and the sums of each dimension of the most frequent one, exactly."""
    lengths = table.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    best = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not best:
        return 0, 0, []
    d, n = best[0]["d"], best[0]["n"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sums = _matrix(batch.column(0)).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(sums)], ["at", "part"])

    parts = table.filter(F.size("x") == d).select("x").mapInArrow(run, "at int, part long")
    rows = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("s")).collect()  # d rows
    return d, n, [int(r["s"]) for r in sorted(rows, key=lambda r: r["at"])]


def _deviations(x, n, sums, base):
    """Sum of (n x - S)^2 of each row, exactly: with u = x - base and r = n base - S it is n^2 uu + 2 n ur + rr."""
    u = x - base
    r = [n * int(b) - s for b, s in zip(base, sums)]
    widest = int(np.abs(u).max(initial=0))
    if max(widest, max(map(abs, r), default=0)) * widest * max(1, len(r)) < 2**62:
        squares, mixed = (u * u).sum(axis=1), u @ np.array(r, np.int64)
    else:
        u = u.astype(object)
        squares, mixed = (u * u).sum(axis=1), u @ np.array(r, object)
    rr = sum(e * e for e in r)
    return [n * n * int(a) + 2 * n * int(b) + rr for a, b in zip(squares, mixed)]


def whiten(rows, keep=("vec_id",), vector="embedding", components=COMPONENTS, checkpoint=staged, **options):
    """One row per usable vector and component, the first the one of greatest variance.

    keep, then component int (from 1), n long, deviation decimal (sum over dimensions of (n x - S)^2, exact; null
    beyond 38 digits), whitened double, explained double (share of the trace), identity_error double (largest entry
    by which the covariance of whitened differs from the identity, components without variance aside).

    See integers() for the rows that are dropped. There are as many components as dimensions, at most `components`.
    A component without variance (all vectors equal, fewer vectors than components) has null for whitened, and for
    explained where there is no variance at all. Equal vectors get equal results. Only the columns named in keep are
    carried along, so others cannot clash. An empty table, or one without a usable vector, gives an empty one.
    """
    spark = rows.sparkSession
    table = checkpoint(integers(rows, keep, vector), "vectors")
    schema = table.drop("x").withColumns(
        {
            "component": F.lit(0),
            "n": F.lit(0).cast("long"),
            "deviation": F.lit(None).cast("decimal(38,0)"),
            "whitened": F.lit(None).cast("double"),
            "explained": F.lit(None).cast("double"),
            "identity_error": F.lit(None).cast("double"),
        }
    ).schema
    d, n, sums = _totals(table)
    if not n:
        return spark.createDataFrame([], schema)
    table = table.filter(F.size("x") == d)
    v = Covariance(table, n, sums)
    k = min(components, d)
    values, vectors = eigenpairs(v, k, **options)
    full = values > d * np.finfo(float).eps * max(values[0], 0.0)  # of the others only rounding is left
    project = np.where(full, vectors / np.sqrt(np.where(full, values, 1.0)), 0.0)
    base, rest = v.base, v.rest

    def whitened(x):
        return ((x - base) - rest) @ project

    def moments(x):
        w = whitened(x)
        return np.concatenate([w.T @ w, w.sum(axis=0)[:, None]], axis=1)

    second = _summed(table, moments, (k, k + 1)) / n
    error = np.abs(second[:, :k] - np.outer(second[:, k], second[:, k]) - np.diag(full.astype(float)))
    error = float(error.max()) if full.any() else None
    explained = [float(e / v.trace) for e in values] if v.trace > 0 else [None] * k

    def tell(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch.column(batch.num_columns - 1))
            repeat = np.repeat(np.arange(m), k)
            deviations = _deviations(x, n, sums, base)
            exact = pa.array([Decimal(e) if e < 10**38 else None for e in deviations], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    *[c.take(pa.array(repeat)) for c in batch.columns[:-1]],
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()),
                    exact.take(pa.array(repeat)),
                    pa.array(whitened(x).ravel(), mask=~np.tile(full, m)),
                    pa.array(explained * m, pa.float64()),
                    pa.array([error] * (m * k), pa.float64()),
                ],
                schema.names,
            )

    return table.select(*keep, "x").mapInArrow(tell, schema)
