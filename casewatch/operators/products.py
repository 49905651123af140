"""Small result tables behind a surveillance overview."""

from pyspark.sql import functions as F

from casewatch.functions.numbers import thousands


def overview_kpis(daily, categorized, anomalies, flag):
    """One row: tracked drugs, reports, flagged days, first and last day.

    Each input is aggregated by itself; the one-row results are stacked and folded.
    """
    empty = {
        "n_drugs": "bigint",
        "n_reports": "bigint",
        "n_anomalies": "bigint",
        "first_day": "date",
        "last_day": "date",
    }

    def row(df, **values):
        return df.agg(*[v.alias(k) for k, v in values.items()]).select(
            *[(F.col(k) if k in values else F.lit(None)).cast(t).alias(k) for k, t in empty.items()]
        )

    stacked = (
        row(daily, n_drugs=F.countDistinct("drug"), first_day=F.min("date"), last_day=F.max("date"))
        .unionByName(row(categorized, n_reports=F.count("*")))
        .unionByName(row(anomalies, n_anomalies=F.count_if(F.col(flag))))
    )
    return stacked.agg(*[F.max(c).alias(c) for c in empty]).withColumn(
        "n_reports_text", thousands(F.col("n_reports"))
    )


def drug_timeline(anomalies, drug):
    return anomalies.filter(F.col("drug") == drug).orderBy("date")


def flagged_for_drug(anomalies, drug, flag):
    return (
        anomalies.filter((F.col("drug") == drug) & F.col(flag))
        .select("date", "count", "expected_count", "zscore")
        .orderBy("date")
    )


def shown_of_total(explanations, shown):
    """Caption numbers: rows left by the filters and rows in total."""
    marks = shown.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        explanations.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    return marks.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("shown"), F.coalesce(F.sum("t"), F.lit(0)).alias("total")
    )


def ranked_scores(scores):
    return scores.orderBy("score", "drug", "date")
