"""Shared expressions of the corpus operators."""

from functools import reduce

from pyspark.sql import functions as F

# The white space that separates words everywhere in this subpackage.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column="text"):
    return F.coalesce(F.col(column), F.lit(""))


def words(text):
    """Words of a text column: maximal runs without the six white-space characters."""
    return F.filter(F.split(text, SPACE_CLASS, -1), lambda w: w != "")


def n_words(text):
    """Number of words without building their strings: word ends are non-spaces before a space or the end."""
    return F.size(words(text)).cast("long")


def remainder(column, divisor):
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def row_key(*columns):
    """A 64-bit digest of columns that tells nulls from values and does not depend on their order in memory."""
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c).cast("string"))]
    return F.xxhash64(*parts)


def same(left, right, *columns):
    """Null-safe equality of like-named columns of two frames, as one join condition."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def aside(docs, *used):
    """The used columns, and all of a row as `_rest`: whatever else its columns are called, they meet no other name."""
    return docs.select(*used, F.struct(*docs.columns).alias("_rest"))


def spread(df, *keys):
    """Fixed number of hash partitions by keys, for Python work whose cost bytes do not show."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(2 * n, *keys)
