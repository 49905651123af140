"""Report pages kept as Parquet by month of receipt: every page is parsed once.

An update parses the pages that no update before it has seen, appends their reports in folders by month, and then
writes which pages these were. Only updates whose list of pages is complete count, so a broken one leaves nothing that
is read and its pages come again. A page is known by its path; pages are taken not to change once they are there.
"""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import schemas
from casewatch.sources import files, generations

MONTH = "month"
NO_MONTH = "none"
REPORTS = T.StructType([*schemas.RAW_REPORT.fields, T.StructField(MONTH, T.StringType())])
PAGES = "path string"


def _month(received):
    digits = F.regexp_extract(received, r"^(\d{6})\d{2}$", 1)
    return F.coalesce(F.nullif(digits, F.lit("")), F.lit(NO_MONTH))


def _updates(spark, archive):
    return generations.complete(spark, f"{archive}/pages")


def seen_pages(spark, archive):
    """Paths of the pages that the archive holds."""
    read = spark.read.schema(PAGES)
    frames = [read.parquet(f"{archive}/pages/{n}") for n in _updates(spark, archive)]
    return reduce(lambda a, b: a.union(b), frames, spark.createDataFrame([], PAGES))


def update(spark, pages, archive):
    """Adds the pages of a folder that the archive has not seen; returns how many these were. One writer at a time."""
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(pages).select("path")  # names only
    new = [r["path"] for r in there.join(seen_pages(spark, archive), "path", "left_anti").collect()]
    if not new:
        return 0
    number = max([-1, *generations.complete(spark, f"{archive}/reports"), *_updates(spark, archive)]) + 1
    reports = files.read_report_pages(spark, new).withColumn(MONTH, _month(F.col("receivedate")))
    by_month = reports.hint("rebalance", MONTH)
    by_month.write.mode("overwrite").partitionBy(MONTH).parquet(f"{archive}/reports/{number}")
    spark.createDataFrame([(p,) for p in new], PAGES).write.mode("overwrite").parquet(f"{archive}/pages/{number}")
    return len(new)


def read(spark, archive, months=None):
    """Raw reports of the archive, of the given months ("202402") only, or all with those of no readable day."""
    frames = [spark.read.schema(REPORTS).parquet(f"{archive}/reports/{n}") for n in _updates(spark, archive)]
    rows = reduce(lambda a, b: a.union(b), frames, spark.createDataFrame([], REPORTS))
    wanted = rows if months is None else rows.filter(F.col(MONTH).isin(sorted(months)))
    return wanted.drop(MONTH)


def months_around(days, date="date", reach=0):
    """Months that the days of a table, and `reach` days before and after them, fall into: few, for read()."""
    each = F.explode(F.sequence(F.date_sub(F.col(date), reach), F.date_add(F.col(date), reach), F.expr("interval 1 day")))
    return {r[0] for r in days.select(each.alias("d")).select(F.date_format("d", "yyyyMM")).distinct().collect()}


def months_between(start, end):
    """Months from one date text to another, both included; None where an end is open."""
    if start is None or end is None:
        return None
    first, last = (int(d[:4]) * 12 + int(d[5:7]) - 1 for d in (start, end))
    return {f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(first, last + 1)}
