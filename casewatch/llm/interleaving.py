"""Shards that each match the mixture, by proportional stratified interleaving.

1. The rows of a source stand in a seeded order, that of a digest of id and text. A row's fractional rank is
   (rank - 1 + u) / (rows of the source), where u, from 0 to below 1, is the source's own: without it the
   first rows of all small sources would crowd at one place.
2. All rows stand by fractional rank. Any stretch of them holds each source in proportion, to within a row or two.
3. The order is cut into shards whose row counts differ by one at most; a row's slot is its place behind the cut.

Neither order needs a task that sees a whole source, or all rows: digests and fractions fall into buckets of at most
about BUCKET_ROWS rows, buckets into blocks of BLOCK_BUCKETS. A place is the rows in blocks before, in buckets of the
block before, and in the bucket before; the first two are running sums over few rows, one row for some 16
million of the input in one task. A source with a third of all rows is in all buckets.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from casewatch.llm.common import text_or_empty
from casewatch.sources.workspace import staged

SHARDS = 8
SEED = "shard-1"
BUCKET_ROWS = 4_000
BLOCK_BUCKETS = 4_096
FILE_ROWS = 1_000_000


def stratum(column="source"):
    """The source as a key that is never null."""
    return F.when(F.col(column).isNull(), "").otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


def seeded(seed, *parts):
    return F.md5(F.concat_ws("/", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def leading(digest):
    """The first 32 bits of a digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _before(rows, keys, bucket):
    """keys, bucket, n rows with the same keys, and how many of them lie in smaller buckets."""
    counts = rows.groupBy(*keys, bucket).agg(F.count("*").alias("here"))
    counts = counts.withColumn("block", F.floor(F.col(bucket) / BLOCK_BUCKETS))
    blocks = counts.groupBy(*keys, "block").agg(F.sum("here").alias("in_block"))

    def earlier(value, order, *within):
        running = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(running), F.lit(0))

    blocks = blocks.select(
        *keys, "block", F.sum("in_block").over(Window.partitionBy(*keys)).alias("n"), earlier("in_block", "block", *keys).alias("blocks_before")
    )
    inside = counts.withColumn("buckets_before", earlier("here", bucket, *keys, "block"))
    both = inside.join(blocks, [*keys, "block"])
    return both.select(*keys, bucket, "n", (F.col("blocks_before") + F.col("buckets_before")).alias("before"))


def interleave(rows, shards=SHARDS, seed=SEED, bucket_rows=BUCKET_ROWS, checkpoint=staged):
    """Adds shard, slot and position to rows of (row, stratum, digest); stratum and digest go.

    Rows of equal stratum and digest come one after another in any order, so `row` must not tell them apart where
    reruns have to agree. No rows give no rows; with fewer rows than shards some shards stay empty.
    """
    rows = checkpoint(rows, "rows")
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))

    # as many buckets for every source: rows need not meet the size of their source, which a hot one would crowd
    placed = rows.withColumn("bucket", F.floor(leading("digest") * buckets / 2.0**32))
    within = Window.partitionBy("stratum", "bucket").orderBy("digest")
    ranked = placed.join(_before(placed, ["stratum"], "bucket"), ["stratum", "bucket"]).withColumn(
        "rank", F.col("before") + F.row_number().over(within)
    )
    u = leading(seeded(seed, F.col("stratum"))) / 2.0**32
    fraction = (F.col("rank") - 1 + u) / F.col("n")
    ordered = ranked.select("row", "stratum", "digest", fraction.alias("fraction"))
    ordered = ordered.withColumn("bucket", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)))
    ordered = checkpoint(ordered, "fractions")

    along = Window.partitionBy("bucket").orderBy("fraction", "stratum", "digest")
    position = F.col("before") + F.row_number().over(along) - 1
    found = ordered.join(_before(ordered, [], "bucket"), "bucket").select("row", position.alias("position"))
    of = F.expr(f"cast(position * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return found.withColumn("shard", of).withColumn("slot", F.col("position") - first).select("row", "shard", "slot", "position")


def sharded(docs, shards=SHARDS, seed=SEED, text="text", **options):
    """All columns of docs and shard int, slot long (gapless from 0 in a shard), position long (over all shards).

    Columns of these names give way to the new ones; no other name can clash. Null ids, sources and texts count as
    values of their own in the order (a null text as an empty one); a null source is a source. Rows of equal id,
    source and text stand next to each other in any order. An empty table gives an empty one.
    """
    own = [c for c in docs.columns if c not in ("shard", "slot", "position")]
    digest = seeded(seed, F.col("doc_id"), F.md5(text_or_empty(text)))
    rows = docs.select(F.struct(*own).alias("row"), stratum().alias("stratum"), digest.alias("digest"))
    return interleave(rows, shards, seed, **options).select("row.*", "shard", "slot", "position")


def write_shards(docs, path, shards=SHARDS, file_rows=FILE_ROWS, **options):
    """Writes sharded() rows to a new folder path, one subfolder a shard, files in the order of slots."""
    rows = staged(sharded(docs, shards, **options), "sharded")
    files = max(1, -(-rows.count() // file_rows))
    in_order = rows.repartitionByRange(files, "position").sortWithinPartitions("position")
    in_order.write.partitionBy("shard").parquet(path)


def assigned(docs, shards=SHARDS, seed=SEED, text="text", **options):
    """doc_id, size (bytes of the text and 1), text_crc32, shard and slot of every document; texts do not travel.

    Rows are treated as in sharded().
    """
    digest = seeded(seed, F.col("doc_id"), F.md5(text_or_empty(text)))
    row = F.struct(
        "doc_id",
        (F.octet_length(text_or_empty(text)).cast("long") + 1).alias("size"),
        F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"),
    )
    rows = docs.select(row.alias("row"), stratum().alias("stratum"), digest.alias("digest"))
    return interleave(rows, shards, seed, **options).select("row.*", "shard", "slot")
