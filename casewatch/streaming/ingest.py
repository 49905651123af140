"""Structured Streaming lane: resumable ingestion and running daily counts, however late rows arrive.

Which ids were seen, and the running counts, are state of the streaming query. In the RocksDB store a micro-batch looks
up its own ids only and checkpoints its own changes, so its work does not grow with what came before; each
executor keeps its share of the state on disk and a lost one is rebuilt from the checkpoint. The number of state
partitions is spark.sql.shuffle.partitions at the first start. Nothing expires: state grows with the number of ids.
"""

from functools import reduce

from pyspark.sql import functions as F

from casewatch.sources import generations

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
COMPACT_EVERY = 10  # micro-batches
COUNTS = "drug string, date date, count bigint"


def read_files(spark, folder, schema, glob=None, files_per_batch=None):
    """Stream of Parquet files appearing in a folder."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def with_event_time(stream, column="ts"):
    """Zone-less time as TIMESTAMP, which watermarks need."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def _started(spark, writer, checkpoint):
    """Runs over all that is present and stops. A state store that the session names stays; the default gives way."""
    before = {key: spark.conf.get(key, None) for key in (PROVIDER, CHANGELOG)}
    if before[PROVIDER] is None or before[PROVIDER].endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKSDB)
        spark.conf.set(CHANGELOG, "true")
    try:
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:  # the query has its own copy of the settings
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    return query


def ingest(stream, out, checkpoint, id_column):
    """Store each report once, whatever the order in which reports arrive; start again to resume.

    out belongs to one checkpoint. Its log names the files that count, which spark.read.parquet() follows: what
    a broken or repeated micro-batch left besides is not read. Rows without an id count as one. Of different
    rows of one id that come in one micro-batch, any may be the one that is stored.
    """
    rows = stream.dropDuplicates([id_column])
    return _started(stream.sparkSession, rows.writeStream.format("parquet").option("path", out), checkpoint)


def daily_counts(stream, out, checkpoint, key, time_column="ts", id_column=None, compact_every=COMPACT_EVERY):
    """Running counts per (key, day) for latest_counts().

    With id_column every id counts once, in the micro-batch that brings it first; without, every row counts. A
    micro-batch writes the counts it changed to a folder of its own, which a replay overwrites. Every
    compact_every micro-batches the current counts are written whole and what they replace, but for the
    generation before, is removed: the number of folders is bounded.
    """
    spark = stream.sparkSession
    rows = stream if id_column is None else stream.dropDuplicates([id_column])
    counted = rows.groupBy(F.col(key).alias("drug"), F.to_date(time_column).alias("date")).agg(F.count("*").alias("count"))

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/{generations.CHANGES}/{batch_id}")
        if (batch_id + 1) % compact_every == 0:
            _compact(batch.sparkSession, out, batch_id)

    return _started(spark, counted.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def _current(spark, out, below=None):
    """The newest whole counts and the changes after them, of which the last of a key holds."""
    base, parts = generations.live(spark, out, below)
    frames = [spark.read.schema(COUNTS).parquet(path).withColumn("batch", F.lit(n).cast("long")) for n, path in parts]
    if not frames:
        return base, spark.createDataFrame([], COUNTS)
    rows = reduce(lambda a, b: a.union(b), frames)  # some 2 * compact_every at most
    return base, rows.groupBy("drug", "date").agg(F.max_by("count", "batch").alias("count"))


def _compact(spark, out, batch_id):
    """Writes the counts whole as of a micro-batch. The generation it is made from stays, for readers and for a replay."""
    base, rows = _current(spark, out, below=batch_id)
    rows.write.mode("overwrite").parquet(f"{out}/{generations.WHOLE}/{batch_id}")
    generations.retire(spark, out, base)


def latest_counts(spark, out):
    """Current counts per (drug, day); none before the first micro-batch."""
    return _current(spark, out)[1]
