"""Daily counts and their summaries."""

from pyspark.sql import functions as F

from casewatch.functions.text import parse_yyyymmdd


def in_range(column, start, end):
    """Inclusive at both ends."""
    return F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def mentions_of(named_reports):
    """The few columns counting needs, from raw reports with the tracked drug they name."""
    return named_reports.select(
        "safetyreportid", "drug", parse_yyyymmdd(F.col("receivedate")).alias("date"), "serious"
    )


def daily_counts(mentions, start=None, end=None):
    """Distinct serious reports per (drug, day). A report counts for each drug it names.

    Counted in two rounds: (drug, day, id) first, so a day or drug with a large share of
    all rows is spread over many tasks.
    """
    rows = mentions.filter(F.col("serious") == "1")
    if start is not None:
        rows = rows.filter(in_range("date", start, end))
    return rows.groupBy("drug", "date").agg(F.countDistinct("safetyreportid").alias("count"))


def counts_summary(daily):
    return daily.groupBy("drug").agg(
        F.count("*").alias("n_days"), F.sum("count").alias("total_reports")
    )


def union_all(frames, schema, spark):
    """Union by name; no frames give an empty table of the schema."""
    out = None
    for frame in frames:
        out = frame if out is None else out.unionByName(frame)
    return spark.createDataFrame([], schema) if out is None else out


def value_counts(df, column):
    """Occurrences per value, most frequent first, without nulls."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def distinct_values(df, column):
    return df.select(column).distinct().orderBy(column)


def progress(done, total):
    """One row: done, total, percent; 0 percent of an empty total."""
    marks = done.select(F.lit(1).alias("d"), F.lit(0).alias("t")).unionByName(
        total.select(F.lit(0).alias("d"), F.lit(1).alias("t"))
    )
    sums = marks.agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("done"), F.coalesce(F.sum("t"), F.lit(0)).alias("total")
    )
    return sums.withColumn(
        "percent",
        F.when(F.col("total") > 0, F.col("done") / F.col("total") * 100).otherwise(F.lit(0.0)),
    )
