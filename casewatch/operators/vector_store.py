"""The vector store: upserts are appended, the newest row of an id counts at read.

An upsert writes its own rows only. Every COMPACT_EVERY upserts the store is written whole once, which
bounds the number of parts a reader meets. One writer at a time; readers need no lock.
"""

from functools import reduce

from pyspark.sql import functions as F

from casewatch import schemas
from casewatch.sources import generations

COMPACT_EVERY = 16
NUMBER = "_number"


def _parts(spark, store, below=None):
    base, parts = generations.live(spark, store, below)
    read = spark.read.schema(schemas.VECTORS)
    return base, [read.parquet(path).withColumn(NUMBER, F.lit(n).cast("long")) for n, path in parts]


def _newest(spark, frames):
    """Rows that no later part replaces: ids of later parts, a small share of the store, are all that is compared."""
    if not frames:
        return spark.createDataFrame([], schemas.VECTORS)
    rows = reduce(lambda a, b: a.union(b), frames)
    if len(frames) > 1:
        later = reduce(lambda a, b: a.union(b), [f.select("id", NUMBER) for f in frames[1:]])
        last = later.groupBy(F.col("id").alias("_id")).agg(F.max(NUMBER).alias("_last"))
        rows = rows.join(last, (F.col("id") == F.col("_id")) & (F.col(NUMBER) < F.col("_last")), "left_anti")
    return rows.select(*schemas.VECTORS.names)


def current(spark, store):
    """The stored vectors, one row per id; an empty table before the first upsert."""
    return _newest(spark, _parts(spark, store)[1])


def exists(spark, store):
    return bool(generations.live(spark, store)[1])


def upsert(spark, store, new, compact_every=COMPACT_EVERY):
    """Appends rows, of each id the largest, that replace stored rows of the same ids and add the others."""
    row = F.struct(*schemas.VECTORS.names)
    one = new.groupBy(F.col("id").alias("_id")).agg(F.max(row).alias("_row")).select("_row.*")
    number = generations.next_number(spark, store)
    one.write.parquet(f"{store}/{generations.CHANGES}/{number}")
    if len(generations.live(spark, store)[1]) > compact_every:
        compact(spark, store)


def compact(spark, store):
    """Writes the store whole and removes what the generation before the last one needed."""
    base, frames = _parts(spark, store)
    number = generations.live(spark, store)[1][-1][0]
    if number > base:
        _newest(spark, frames).write.parquet(f"{store}/{generations.WHOLE}/{number}")
        generations.retire(spark, store, base)
