"""Keep-first, per-key limits and stratified samples.

All of them are a row_number() <= n filter, which Spark limits per task before the
shuffle. `salts` adds a first round per (key, salt): what many tasks kept of one key is cut
down by several tasks before one task sees the rest.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F


def _columns(names):
    return [F.col(n) if isinstance(n, str) else n for n in names]


def id_salt(id_columns, salts):
    """Salt that depends on the row alone, for use in join keys."""
    return F.pmod(F.xxhash64(*_columns(id_columns)), F.lit(salts)).cast("int")


def top_n_per_key(df, keys, order, n, salts=1, salt_column=None, rank=None):
    """The first n rows of every key in the given total order; exact for any key size.

    salts: number of first-round groups per key. A task puts all its rows into one of them,
    so it hands on at most n rows per key whatever the number of salts.
    salt_column: a column of df that already splits the keys, instead of salts.
    """
    rank_name = rank or "__rank"
    order = _columns(order)
    if salts > 1 and salt_column is None:
        salt_column = "__salt"
        df = df.withColumn(salt_column, F.spark_partition_id() % salts)
    if salt_column is not None:
        first = Window.partitionBy(*keys, salt_column).orderBy(*order)
        df = (
            df.withColumn("__first", F.row_number().over(first))
            .filter(F.col("__first") <= n)
            .drop(salt_column, "__first")
        )
    final = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rank_name, F.row_number().over(final)).filter(F.col(rank_name) <= n)
    return out if rank else out.drop(rank_name)


def keep_first(df, key, order):
    """One row per key: the first in the given order."""
    return top_n_per_key(df, [key], order, 1)


def list_position(column, values):
    """Position of a value in a fixed list, for ordering by that list."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), column)


def dedup_reports(mentions, drugs, id_column="safetyreportid", drug_column="drug", then_by=()):
    """A report that names several tracked drugs belongs to the earliest in the list.

    Versions of a report that are equal up to there are told apart by their whole content.
    """
    order = [list_position(F.col(drug_column), drugs), *then_by, *mentions.columns]
    return keep_first(mentions, id_column, order)


def cap_per_drug(df, n, date_column="receivedate", id_column="safetyreportid", salts=16):
    """At most n reports per drug, oldest first, then by id, then by their whole content."""
    return top_n_per_key(df, ["drug"], [date_column, id_column, *df.columns], n, salts=salts)


def sample_order(id_column, seed):
    """Random but repeatable order: a digest of seed and id."""
    return F.sha2(F.concat(F.lit(str(seed)), F.col(id_column).cast("string")), 256)


def stratified_sample(df, n, seed=42, key="drug", id_column="safetyreportid", salts=16):
    """n rows of every stratum, or all of it when it is smaller."""
    order = [sample_order(id_column, seed), id_column]
    return top_n_per_key(df, [key], order, n, salts=salts)


def stratified_even(df, total, seed=42, key="drug", id_column="safetyreportid", salts=16):
    """A sample of about `total` rows, split evenly over the strata, at least one each.

    `df` is read twice (counting the strata first): pass a stored table.
    """
    strata = df.select(key).distinct().count()
    share = max(1, total // strata) if strata else total
    return stratified_sample(df, share, seed, key, id_column, salts)
