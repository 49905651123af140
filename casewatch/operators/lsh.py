"""Approximate similarity search: sign codes of random planes, kept beside the vectors.

In each of several tables a vector's code says on which side of the table's planes it lies. The index is a
table of (id, cell), one row per table, written once in folders by cell, so a search reads the cells it probes and
then only the vectors found there. A query probes the codes whose region is nearest: turning a sign costs the
squared distance to that plane. More probes find more; all codes give the exact answer. Planes are digests of
(seed, table, plane, dimension), so the index is the same wherever it is built.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from casewatch import config
from casewatch.functions.numbers import round_half_even
from casewatch.operators.ranking import top_n_per_key
from casewatch.operators.vectors import filtered

TABLES = 8
PLANES = 6  # 2 ** PLANES codes a table
PROBES = 12  # codes a table that a query looks at
INDEX = "id string, cell int"


def planes(dim, tables=TABLES, n=PLANES, seed=config.SEED):
    """Array (tables, n, dim) of numbers from -1 to below 1."""

    def part(*key):
        return int(hashlib.md5("/".join(map(str, (seed, *key))).encode()).hexdigest()[:8], 16) / 2.0**31 - 1

    return np.array([[[part(t, j, d) for d in range(dim)] for j in range(n)] for t in range(tables)])


def _codes(matrix, normals):
    """(tables, rows) codes and (tables, rows, planes) signed distances, but for the lengths of the normals."""
    margins = np.einsum("nd,tjd->tnj", matrix, normals)
    return (margins > 0) @ (1 << np.arange(normals.shape[1])), margins


def cells(vectors, normals, id_column="id"):
    """(id, cell) of every vector and table: table * codes + code. Rows without a vector have none."""
    tables, n, dim = normals.shape

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                matrix = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                code = _codes(matrix, normals)[0] + (np.arange(tables) << n)[:, None]
                ids = batch.column(0).take(pa.array(np.tile(np.arange(len(matrix)), tables)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(code.ravel(), pa.int32())], ["id", "cell"])

    rows = vectors.filter(F.size("embedding") == dim).select(F.col(id_column).cast("string").alias("id"), "embedding")
    return rows.mapInArrow(run, INDEX)


def write_index(vectors, path, normals, id_column="id"):
    """Writes the index to a new folder, one subfolder a cell; a crowded cell has several files."""
    cells(vectors, normals, id_column).hint("rebalance", "cell").write.partitionBy("cell").parquet(path)


def read_index(spark, path):
    return spark.read.schema(INDEX).parquet(path)


def probed_cells(queries, normals, probes=PROBES):
    """(query, cell) pairs: of each table the `probes` codes nearest to the query, ties to the fewer turned low planes."""
    tables, n, _ = normals.shape
    turned = np.arange(1 << n)
    bits = turned[:, None] >> np.arange(n) & 1
    home, margins = _codes(np.asarray(queries, dtype=np.float64), normals)
    pairs = []
    for t in range(tables):
        for q in range(len(queries)):
            cost = np.round(bits @ margins[t, q] ** 2, 9)
            nearest = np.lexsort((turned, cost))[:probes]
            pairs += [(q, int(t << n | code)) for code in home[t, q] ^ nearest]
    return pairs


def search(vectors, index, queries, normals, k=config.SEARCH_K, where=None, probes=PROBES, id_column="id"):
    """Top k by cosine for each query vector among the vectors in its probed cells, ties by id.

    queries: local list of vectors, the argument of the call. where: condition or {column: value} on metadata. There
    are fewer than k rows where the probed cells hold fewer.
    """
    spark = vectors.sparkSession
    pairs = probed_cells(queries, normals, probes)
    asked = spark.createDataFrame(pairs, "query int, cell int")
    near = index.filter(F.col("cell").isin(sorted({cell for _, cell in pairs}))).join(asked, "cell").select("query", "id").distinct()
    rows = filtered(vectors, where).select(F.col(id_column).cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    texts = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(queries)], "query int, q array<double>")
    both = near.join(rows, "id").join(texts, "query")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    lengths = F.sqrt(dot("v", "v")) * F.sqrt(dot("q", "q"))
    sim = F.coalesce(round_half_even(F.try_divide(dot("v", "q"), lengths), 12), F.lit(0.0))
    scored = both.select("query", "id", sim.alias("similarity"))
    return top_n_per_key(scored, ["query"], [F.desc("similarity"), F.asc("id")], k, rank="rank")
