"""Reports around an anomalous day: interval join, nearest n, numbered text, text templates.

The wording of stats_block and claim_text is a fixed format.
"""

from pyspark.sql import functions as F

from casewatch import config
from casewatch.functions.text import numbered_lines
from casewatch.operators.ranking import id_salt, top_n_per_key
from casewatch.operators.timeseries import direction


def window_days(anomalies, days=config.CONTEXT_DAYS):
    """One row per anomaly and calendar day within +/- days."""
    span = F.sequence(F.date_sub("date", days), F.date_add("date", days), F.expr("interval 1 day"))
    return anomalies.withColumn("day", F.explode(span))


def context_reports(anomalies, reports, days=config.CONTEXT_DAYS, id_column="safetyreportid", salts=16):
    """All reports of the same drug within +/- days of each anomaly, both ends included.

    The interval becomes an equality on (drug, day, salt): work spreads over days as well as
    drugs, a crowded day over its salts, and no range condition is evaluated per pair.
    reports: needs drug, received (date) and the id.
    """
    dated = reports.withColumnRenamed("received", "day").withColumn("__salt", id_salt([id_column], salts))
    wanted = window_days(anomalies, days).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = wanted.join(dated, ["drug", "day", "__salt"]).drop("__salt")
    return joined.withColumn("distance", F.abs(F.datediff("day", "date"))).withColumnRenamed(
        "day", "received"
    )


def context_top_n(
    anomalies,
    reports,
    n=config.CONTEXT_REPORTS,
    days=config.CONTEXT_DAYS,
    id_column="safetyreportid",
    salts=16,
):
    """The n reports nearest to each anomaly, by (distance in days, id); exact.

    Only the first n ids of a (drug, day) can be among the n nearest, so every day is cut
    to n rows before the join. However many reports a day holds, an anomaly meets at most
    n of them per day of its window. The salt is part of the key already when reports are
    narrowed to the wanted days, so a crowded day is spread from there on.
    `anomalies` is read twice: pass a staged table.
    """
    wanted = (
        window_days(anomalies.select("drug", "date"), days)
        .select("drug", F.col("day").alias("received"))
        .distinct()
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    candidates = reports.withColumn("__salt", id_salt([id_column], salts)).join(
        wanted, ["drug", "received", "__salt"], "left_semi"
    )
    per_day = top_n_per_key(candidates, ["drug", "received"], [id_column], n, salt_column="__salt")
    return top_n_per_key(
        context_reports(anomalies, per_day, days, id_column, salts=1),
        ["drug", "date"],
        ["distance", id_column],
        n,
        rank="position",
    )


def context_bundle(context, text="patient_summary_text"):
    """Numbered context text per anomaly, from at most n rows each (see context_top_n).

    An anomaly without context is absent.
    """
    return (
        context.groupBy("drug", "date")
        .agg(F.array_sort(F.collect_list(F.struct("position", F.col(text).alias("text")))).alias("items"))
        .select(
            "drug",
            "date",
            F.size("items").cast("bigint").alias("n_context_reports"),
            F.transform("items", lambda i: i["text"]).alias("texts"),
            numbered_lines(F.transform("items", lambda i: i["text"])).alias("context"),
        )
    )


def stats_block(days=config.CONTEXT_DAYS):
    """The anomaly's figures and its context as one text. date is rendered as a timestamp."""
    line = lambda label, value: F.concat(F.lit(label), value)
    return F.concat_ws(
        "\n",
        line("Drug: ", F.col("drug")),
        line("Date: ", F.concat(F.col("date").cast("string"), F.lit(" 00:00:00"))),
        line("Direction: ", direction(F.col("zscore"))),
        line("Actual report count that day: ", F.col("count").cast("string")),
        line("Expected count (Holt-Winters forecast): ", F.col("expected_count").cast("string")),
        line("Z-score: ", F.col("zscore").cast("string")),
        F.concat(
            F.lit("Sample of "),
            F.col("n_context_reports").cast("string"),
            F.lit(f" reports from +/-{days} days:"),
        ),
        F.col("context"),
    )


def claim_text():
    """The qualitative claim of an explanation, without counts or dates."""
    return F.concat(
        F.lit("Organ systems affected: ['"),
        F.array_join("dominant_organ_systems", "', '"),
        F.lit("']. Severity: "),
        F.col("dominant_severity"),
        F.lit(". Notable pattern: "),
        F.col("notable_pattern"),
    )
