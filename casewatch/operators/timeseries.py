"""Daily series per drug: gap filling, trailing statistics, residual z-scores, flags.

A series has one row per calendar day, so a window partition is bounded by the length of
the observed period, not by the number of reports. All windows share one partitioning by
drug and therefore one shuffle.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from casewatch import config
from casewatch.functions.numbers import round_half_even


def by_drug():
    return Window.partitionBy("drug")


def by_day():
    return by_drug().orderBy("date")


def trailing(rows):
    """The current row and the rows - 1 before it."""
    return by_day().rowsBetween(1 - rows, 0)


def gap_fill(daily):
    """Insert the missing days of every drug, within its own first and last day, as 0.

    Each row emits itself and the zero days up to the next one, so no calendar table is
    built and the counts are not read a second time for a join.
    """
    next_day = F.lead("date").over(by_day())
    until = F.coalesce(F.date_sub(next_day, 1), F.col("date"))
    return (
        daily.select("drug", "date", "count", until.alias("until"))
        .select(
            "drug",
            "date",
            "count",
            F.explode(F.sequence("date", "until", F.expr("interval 1 day"))).alias("day"),
        )
        .select(
            "drug",
            F.col("day").alias("date"),
            F.when(F.col("day") == F.col("date"), F.col("count")).otherwise(F.lit(0)).cast("bigint").alias("count"),
        )
    )


def rolling_mean(column="count", rows=config.SEASON):
    return F.avg(column).over(trailing(rows))


def rolling_std(column="count", rows=config.SEASON):
    """Sample deviation; a single row has none and counts as 0."""
    return F.coalesce(F.stddev_samp(column).over(trailing(rows)), F.lit(0.0))


def rolling_zscore(column, rows=config.ROLLING_WINDOW, min_rows=config.ROLLING_MIN_ROWS):
    """(x - trailing mean) / trailing deviation; 0 without enough rows or any spread."""
    window = trailing(rows)
    spread = F.nullif(F.stddev_samp(column).over(window), F.lit(0.0))
    score = (F.col(column) - F.avg(column).over(window)) / spread
    enough = F.count(column).over(window) >= min_rows
    return F.coalesce(F.when(enough, score), F.lit(0.0))


def is_modelled(min_length=config.MIN_SERIES_LENGTH):
    """True for a series long enough and not constant."""
    return (F.count("*").over(by_drug()) >= min_length) & (F.stddev_samp("count").over(by_drug()) > 0)


def with_expected(series, fitted=None, min_length=config.MIN_SERIES_LENGTH):
    """Add expected (unrounded): the fitted value where there is one, else the trailing mean.

    fitted: name of a column of `series` holding one-step model values, or None.
    """
    mean = rolling_mean()
    if fitted is None:
        return series.withColumn("expected", mean)
    usable = is_modelled(min_length) & F.col(fitted).isNotNull()
    return series.withColumn("expected", F.when(usable, F.col(fitted)).otherwise(mean))


def with_zscore(series, rows=config.ROLLING_WINDOW):
    """Add raw_residual and raw_z from the unrounded expectation."""
    return series.withColumn("raw_residual", F.col("count") - F.col("expected")).withColumn(
        "raw_z", rolling_zscore("raw_residual", rows)
    )


def published(series):
    """The rounded columns. residual is taken from the rounded expectation."""
    expected = round_half_even(F.col("expected"))
    return (
        series.withColumn("expected_count", expected)
        .withColumn("residual", round_half_even(F.col("count") - F.col("expected_count")))
        .withColumn("zscore", round_half_even(F.col("raw_z")))
    )


def position():
    """0-based day position within the gap-filled series."""
    return F.row_number().over(by_day()) - 1


def after_warmup(flag, warmup=config.WARMUP_DAYS):
    """The flag, forced to false on the first days of a series."""
    return F.when(position() < warmup, F.lit(False)).otherwise(flag)


def zscore_flag(threshold=config.Z_THRESHOLD):
    """Strict comparison of the unrounded score."""
    return F.abs(F.col("raw_z")) > F.lit(threshold)


def zscore_detector(series, threshold=config.Z_THRESHOLD, warmup=config.WARMUP_DAYS, rows=config.ROLLING_WINDOW):
    """Published columns and warm-up-masked z flag of a series that has `expected`."""
    scored = published(with_zscore(series, rows))
    return scored.withColumn("is_anomaly_zscore", after_warmup(zscore_flag(threshold), warmup))


def forest_features(series):
    """The five features of a day: level, trailing mean and deviation, weekday on a circle."""
    angle = F.lit(2 * math.pi) * F.weekday("date") / F.lit(7)
    return (
        series.withColumn("roll_mean_7", rolling_mean())
        .withColumn("roll_std_7", rolling_std())
        .withColumn("dow_sin", F.sin(angle))
        .withColumn("dow_cos", F.cos(angle))
    )


FEATURES = ("count", "roll_mean_7", "roll_std_7", "dow_sin", "dow_cos")


def direction(zscore):
    return F.when(zscore >= 0, F.lit(config.SPIKE)).otherwise(F.lit(config.DROP))
