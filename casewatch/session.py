"""Session defaults. A cluster's own settings always win."""

from pyspark.sql import SparkSession

# n <= this keeps the per-task pre-limit in front of the shuffle of a
# row_number() <= n filter; the stock value (1000) is below the 2000-row report cap.
GROUP_LIMIT_THRESHOLD = "spark.sql.optimizer.windowGroupLimitThreshold"


def local_session(cores="*", shuffle_partitions=8, memory="8g", app="casewatch"):
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark):
    """Set the few SQL options the plans rely on; report days are UTC days."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if int(spark.conf.get(GROUP_LIMIT_THRESHOLD, "1000")) == 1000:
        spark.conf.set(GROUP_LIMIT_THRESHOLD, "10000")
    return spark


def spread(df, *keys):
    """Hash-partition by keys into a fixed number of tasks.

    For Python work on few, small, costly groups: adaptive execution merges small shuffle
    partitions by bytes, which would run those groups one after another.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(2 * n, *keys)
