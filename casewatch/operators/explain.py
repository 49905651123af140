"""Explanations of anomalies from their context reports."""

from pyspark.sql import functions as F

from casewatch.functions.severity import changed_by, severity_by_ladder
from casewatch.functions.text import normalize_array
from casewatch.operators.timeseries import direction

NO_PATTERN = "no reaction stands out in the reports nearby"
CAVEAT = "Drawn from a few nearby reports: a hint where to look, not a medical finding."


def _most_frequent(values):
    """Value with the highest count, ties by name, of a short array; null if empty."""
    distinct = F.array_distinct(values)
    ranked = F.transform(
        distinct,
        lambda v: F.struct(
            (-F.size(F.filter(values, lambda x: x == v))).alias("n"), v.alias("value")
        ),
    )
    return F.array_min(ranked)


def explain_extractive(context):
    """Explanation columns per anomaly from labelled context rows (at most n per anomaly).

    context: drug, date, count, expected_count, zscore, position, primary_organ_system,
    severity, reactions ('; '-joined).
    """
    grouped = context.groupBy("drug", "date", "count", "expected_count", "zscore").agg(
        F.count("*").alias("n_context_reports"),
        F.sort_array(F.collect_list("primary_organ_system")).alias("_organs"),
        F.sort_array(F.collect_list("severity")).alias("_severities"),
        F.flatten(
            F.collect_list(F.filter(F.split("reactions", "; "), lambda r: r != ""))
        ).alias("_reactions"),
    )
    top = grouped.select(
        "*",
        _most_frequent(F.col("_organs")).alias("_organ"),
        _most_frequent(F.col("_severities")).alias("_severity"),
        _most_frequent(F.col("_reactions")).alias("_reaction"),
    )
    share = F.concat((-F.col("_reaction.n")).cast("string"), F.lit(" mentions"))
    return top.select(
        "drug",
        "date",
        "count",
        "expected_count",
        "zscore",
        "n_context_reports",
        F.concat(
            direction(F.col("zscore")),
            F.lit(": "),
            F.col("count").cast("string"),
            F.lit(" reports for "),
            F.col("drug"),
            F.lit(" on "),
            F.col("date").cast("string"),
            F.lit("."),
        ).alias("summary"),
        F.array(F.col("_organ.value")).alias("dominant_organ_systems"),
        F.col("_severity.value").alias("dominant_severity"),
        F.when(
            F.col("_reaction.n") <= -2,
            F.concat(F.lit("most frequent reaction: "), F.col("_reaction.value"), F.lit(", "), share),
        )
        .otherwise(F.lit(NO_PATTERN))
        .alias("notable_pattern"),
        F.lit(CAVEAT).alias("confidence_caveat"),
    )


def merge_explanations(results):
    """Clean collected explanations: severity ladder, lower-case systems, (drug, date) order.

    Keeps severity_before for counting changes.
    """
    return (
        results.withColumn("severity_before", F.col("dominant_severity"))
        .withColumn("dominant_severity", severity_by_ladder(F.col("dominant_severity")))
        .withColumn("dominant_organ_systems", normalize_array(F.col("dominant_organ_systems")))
        .orderBy("drug", "date")
    )


def normalized_count(before, after):
    """Number of rows that normalising changed beyond case and blanks."""
    return F.count_if(changed_by(before, after)).cast("bigint")


def filter_explanations(explanations, drugs=(), severities=()):
    """Optional lists: an empty one keeps everything."""
    out = explanations
    if drugs:
        out = out.filter(F.col("drug").isin(*drugs))
    if severities:
        out = out.filter(F.col("dominant_severity").isin(*severities))
    return out


