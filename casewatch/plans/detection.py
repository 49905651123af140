"""Counts to anomaly table: one plan keyed by drug for all drugs."""

from pyspark.sql import functions as F

from casewatch import config
from casewatch.operators import timeseries as ts
from casewatch.operators.holt_winters import holt_winters
from casewatch.operators.isolation_forest import forest_flags, isolation_scores, with_chunks
from casewatch.sources.workspace import staged

COLUMNS = (
    "date",
    "count",
    "drug",
    "expected_count",
    "residual",
    "zscore",
    "is_anomaly_zscore",
    "isolation_forest_score",
    "is_anomaly_isoforest",
    "is_anomaly_high_confidence",
)


def anomaly_table(
    daily,
    threshold=config.Z_THRESHOLD,
    contamination=config.CONTAMINATION,
    warmup=config.WARMUP_DAYS,
    min_length=config.MIN_SERIES_LENGTH,
    window=config.ROLLING_WINDOW,
    seed=config.SEED,
    refine=False,
):
    """Days of every drug with expectation, z-score, forest score and flags.

    refine: search the Holt-Winters weights and start states beyond the grid.

    The modelled series is staged once: the forest reads it to draw samples and again to
    score, and the report scan behind it must not run twice.
    """
    modelled = holt_winters(ts.gap_fill(daily), min_length=min_length, refine=refine)
    features = staged(with_chunks(ts.forest_features(modelled)), "features")
    scored = isolation_scores(features, seed=seed)
    detected = ts.zscore_detector(
        ts.with_expected(scored, "fitted", min_length), threshold, warmup, window
    )
    flagged = forest_flags(detected, contamination).withColumn(
        "is_anomaly_isoforest", ts.after_warmup(F.col("is_anomaly_isoforest"), warmup)
    )
    return flagged.withColumn(
        "is_anomaly_high_confidence", F.col("is_anomaly_zscore") & F.col("is_anomaly_isoforest")
    ).select(*COLUMNS)


def zscore_table(daily, threshold=config.Z_THRESHOLD, warmup=config.WARMUP_DAYS):
    """The same with the trailing-mean expectation and the z-score detector alone."""
    series = ts.with_expected(ts.gap_fill(daily))
    return ts.zscore_detector(series, threshold, warmup).select(
        "drug", "date", "count", "expected_count", "residual", "zscore", "is_anomaly_zscore"
    )


def high_confidence(anomalies, flag="is_anomaly_high_confidence"):
    return anomalies.filter(F.col(flag))


def anomaly_totals(anomalies, flag="is_anomaly_high_confidence"):
    """Flagged days per drug and, on the row whose drug is null, over all drugs."""
    return anomalies.rollup("drug").agg(F.count_if(F.col(flag)).cast("bigint").alias("n_anomalies"))
