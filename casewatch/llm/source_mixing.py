"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every number that a document gets follows from (source, doc_id, size): a rerun, another
partitioning or a lost executor gives the same mix.

1. Sources weigh 5, 2, 1, repeating, in code-point order with null last. They share a multiple of all
   tokens; a source stops at twice its size and what it leaves is shared among the others by weight.
2. The mix has total / block seats. Highest quotients target / (2 k - 1) get them, first over sources,
   then over the shards of a source, so a shard has an integer quota.
3. A shard's documents stand in a seeded order and are cut into blocks of equal tokens. A quota of more
   blocks than there are takes all of them once; the rest goes to the blocks with the smallest digests.

Sources and shards are few rows; blocks are about BLOCKS in number whatever the input. Shards bound
what a window has to order, so that a source with a third of all rows is as spread as the others.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from casewatch.llm.common import n_words, text_or_empty
from casewatch.sources.workspace import staged

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST = 2  # times a source's own size
BLOCKS = 1 << 20  # the block is total / BLOCKS tokens, rounded up
SHARD_DOCUMENTS = 4_000  # documents of a shard, about
SEED = "mix-1"


def sizes(docs, text="text"):
    """doc_id, source, size; a null text has size 0."""
    return docs.select("doc_id", "source", n_words(text_or_empty(text)).alias("size"))


def targets(source_sizes, weights=WEIGHTS, share_percent=SHARE_PERCENT, most=MOST):
    """source, source_size, target of every source.

    With sources ordered by the level at which they are full (most * size / weight), the level of the water
    is found at the first source that stays below its own: one pass instead of repeated resharing.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = source_sizes.withColumn("weight", weight.cast("long")).withColumn("full", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    filled = weighed.select(
        "*",
        (F.sum("source_size").over(every) * share_percent / 100 - F.coalesce(F.sum("full").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"),
        F.row_number().over(by_level).alias("rank"),
    )
    fits = (F.col("left") * F.col("weight") <= F.col("full") * F.col("open")) & (F.col("open") > 0)
    first = F.min(F.when(fits, F.struct("rank", "left", "open"))).over(every)
    return filled.select("source", "source_size", "full", "weight", "rank", first.alias("first")).select(
        "source",
        "source_size",
        F.when(F.col("first").isNull() | (F.col("rank") < F.col("first.rank")), F.col("full").cast("double"))
        .otherwise(F.col("weight") * F.col("first.left") / F.col("first.open"))
        .alias("target"),
    )


def apportion(shares, seats, share, keys, group=()):
    """Adds quota: `seats` integers per group by highest quotients share / (2 k - 1).

    shares: rows with keys (unique within a group), `share` and `seats` columns. Rounding share / d for a divisor d
    above and below the right one brackets every quota, so about two seats a row remain to be ranked. Equal
    quotients go to the smaller key.
    """
    every = Window.partitionBy(*group)
    total, n = F.sum(share).over(every), F.count("*").over(every)
    scaled = shares.withColumn("_per", F.coalesce(F.try_divide(F.col(share), total), F.lit(0.0)))

    def rounded(count):
        return F.floor(F.greatest(F.col("_per") * count, F.lit(0.0)) + F.lit(0.5)).cast("long")

    bracket = scaled.withColumn("_n", n).withColumn(
        "_sure", F.greatest(rounded(F.col(seats) - F.col("_n") / 2 - 1) - 1, F.lit(0))
    ).withColumn("_most", rounded(F.col(seats) + F.col("_n") / 2 + 1) + 1)
    left = bracket.withColumn("_open", F.col(seats) - F.sum("_sure").over(every))
    candidates = left.withColumn("_seat", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))))
    best = Window.partitionBy(*group).orderBy(
        F.desc(F.col(share) / (2 * F.col("_seat") - 1)), *[part for k in keys for part in (F.col(k).isNull(), F.col(k))], "_seat"
    )
    ranked = candidates.withColumn("_place", F.row_number().over(best))
    won = F.sum(((F.col("_place") <= F.col("_open")) & (F.col(share) > 0)).cast("long"))
    return ranked.groupBy(*shares.columns).agg((F.max("_sure") + won).alias("quota"))


def plan(
    rows, weights=WEIGHTS, share_percent=SHARE_PERCENT, most=MOST, blocks=BLOCKS, shard_documents=SHARD_DOCUMENTS, seed=SEED,
    checkpoint=staged,
):
    """doc_id, source, size, source_size, target, taken for every row of sizes().

    Rows of equal doc_id, source and size are told apart by their place in the shard only; together they take
    the same. Nothing is taken from empty documents. An empty table gives an empty one.
    """
    # rows that repeat stand together as one, with a count, so that their order need not be known
    one = checkpoint(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")), "sizes")
    per_source = one.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("documents")
    )
    aims = targets(per_source.select("source", "source_size"), weights, share_percent, most).withColumnRenamed("source", "_source")
    aims = aims.join(per_source.select("source", "documents"), F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    aims = aims.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    aims = aims.withColumn("block", F.greatest(F.ceil(F.col("total") / blocks), F.lit(1)).cast("long"))
    # in whole numbers: sums of targets depend on their order
    aims = aims.withColumn("seats", F.expr(f"total * {min(share_percent, 100 * most)} div (100 * block)")).drop("total")
    aims = apportion(aims, "seats", "target", ("source",)).withColumnRenamed("quota", "source_quota")

    digest = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string")))
    # few rows, one per source: joined to every document by Spark's own choice
    known = aims.withColumnRenamed("source", "_source")
    placed = (
        one.join(known, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("digest", digest)
        .withColumn(
            "shard",
            F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.ceil(F.col("documents") / shard_documents)),
        )
    )
    shard = ("source", "shard")
    in_order = Window.partitionBy(*shard).orderBy("digest", F.col("doc_id").isNull(), "doc_id", "size")
    length = F.col("size") * F.col("copies")
    placed = placed.withColumn("end", F.sum(length).over(in_order)).withColumn("start", F.col("end") - length)
    placed = checkpoint(placed.drop("weight", "documents", "seats"), "placed")

    shards = placed.groupBy(*shard, "source_quota", "block").agg(F.max("end").alias("tokens"))
    quotas = apportion(shards, "source_quota", "tokens", ("shard",), ("source",)).select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "tokens", "quota"
    )
    quotas = quotas.filter("tokens > 0")
    joined = placed.filter("size > 0").join(
        quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard"))
    )
    pieces = joined.select(
        "doc_id", "source", "size", "shard", "block", "quota", "tokens", "start", "end",
        F.explode(F.sequence(F.floor(F.col("start") / F.col("block")), F.floor((F.col("end") - 1) / F.col("block")))).alias("at"),
    )
    count = F.ceil(F.col("tokens") / F.col("block"))
    block_rows = pieces.select(*shard, "at", "quota", count.alias("count")).distinct()
    by_digest = Window.partitionBy(*shard).orderBy(
        F.md5(F.concat_ws("/", F.lit(seed), F.coalesce("source", F.lit("null")), "shard", "at")), "at"
    )
    times = block_rows.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), F.col("at").alias("_at"),
        (F.floor(F.col("quota") / F.col("count"))
         + (F.row_number().over(by_digest) <= F.col("quota") % F.col("count")).cast("long")).alias("times"),
    )
    overlap = F.least(F.col("end"), (F.col("at") + 1) * F.col("block")) - F.greatest(F.col("start"), F.col("at") * F.col("block"))
    taken = (
        pieces.join(
            times,
            F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")) & (F.col("at") == F.col("_at")),
        )
        .groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"))
        .agg(F.sum(overlap * F.least("times", F.lit(most))).alias("together"))
    )
    # a document's rows share what was taken from them together
    out = placed.join(
        taken,
        F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")),
        "left",
    ).withColumn("together", F.coalesce("together", F.lit(0)))
    row = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return out.withColumn("_row", row).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.floor(F.col("together") / F.col("copies"))
         + (F.col("_row") <= F.col("together") % F.col("copies")).cast("long")).alias("taken"),
    )


def mix(docs, text="text", **options):
    """The plan for a table of documents."""
    return plan(sizes(docs, text), **options)
