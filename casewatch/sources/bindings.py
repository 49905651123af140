"""Views that let the order, event, document and vector tables play the surveillance data.

A line of an order is one product mention of one case report (the order). The tracked
names are the six product types, so a report can name several of them.
"""

from pyspark.sql import functions as F

# Fixed values of the test tables.
TRACKED = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SERIOUS_PRIORITIES = ("1-URGENT", "2-HIGH")
# Organ-system keywords that match the reaction words occurring in these tables.
REACTION_RULES = {
    "musculoskeletal": ("anvil",),
    "cardiovascular": ("bolt",),
    "neurological": ("gear",),
    "psychiatric": ("gizmo",),
    "hepatic": ("plate",),
    "dermatological": ("ring",),
    "gastrointestinal": (" rod",),
    "respiratory": ("widget",),
}
TOXIC_WORDS = ("trash", "clown", "scum", "idiot", "worthless", "moron", "pathetic", "loser", "stupid")


# Column types of the tables used; a declared schema saves a footer-reading job per scan.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark, sf_dir, name):
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark, sf_dir, name):
    """A table for costly row-wise work: redistributed only if it has fewer splits than cores."""
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _lines(spark, sf_dir, *part_columns):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", *part_columns)
    return lines.join(parts, lines.l_partkey == parts.p_partkey)


def case_mentions(spark, sf_dir, serious_only=False):
    """One row per (report, tracked drug named in it).

    Lines are folded to one flag per tracked drug before the shuffle, so an order that
    holds a large share of all lines leaves each task as a single row; the join with
    the order header then reuses the partitioning of that aggregation.
    """
    flags = [F.bool_or(F.col("p_type") == d).alias(f"has_{d}") for d in TRACKED]
    per_order = _lines(spark, sf_dir, "p_type").groupBy("l_orderkey").agg(*flags)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    if serious_only:
        orders = orders.filter(F.col("o_orderpriority").isin(*SERIOUS_PRIORITIES))
    named = F.filter(
        F.array(*[F.when(F.col(f"has_{d}"), F.lit(d)) for d in TRACKED]), lambda d: d.isNotNull()
    )
    return per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("safetyreportid"),
        F.explode(named).alias("drug"),
        F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderpriority").isin(*SERIOUS_PRIORITIES), "1").otherwise("2").alias("serious"),
    )


def received_between(start, end):
    """Inclusive range of days on the order time itself, so that it reaches the scan; None does not limit."""
    within = []
    if start is not None:
        within.append(F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        within.append(F.col("o_orderdate") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return within


def case_reports(spark, sf_dir, start=None, end=None, ids=None):
    """Nested raw reports in the declared raw schema.

    start, end: inclusive days; ids: a frame with the safetyreportid of the reports wanted. Both narrow
    the lines before their names are collected.

    Product and reaction lists are sets over small vocabularies (types x brands, part
    names), collected with map-side combining: their size does not grow with the rows.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    limits = received_between(start, end)
    for limit in limits:
        orders = orders.filter(limit)
    if ids is not None:
        keys = ids.select(F.col("safetyreportid").cast("bigint").alias("o_orderkey")).distinct()
        orders = orders.join(keys, "o_orderkey", "left_semi")
    lines = _lines(spark, sf_dir, "p_type", "p_brand", "p_name", "p_size")
    if ids is not None:
        lines = lines.join(keys, lines.l_orderkey == keys.o_orderkey, "left_semi")
    elif limits:
        wanted = orders.select("o_orderkey")
        lines = lines.join(wanted, lines.l_orderkey == wanted.o_orderkey, "left_semi")
    per_order = lines.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set(F.concat_ws(" ", "p_type", "p_brand"))).alias("products"),
        # a few blank names stand for entries without a coded reaction
        F.sort_array(F.collect_set(F.when(F.col("p_size") <= 2, "").otherwise(F.col("p_name")))).alias(
            "names"
        ),
    )
    prio, status, cust = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_custkey")
    flag = lambda cond: F.when(cond, "1").otherwise("2")
    return per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("safetyreportid"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("receivedate"),
        flag(prio.isin(*SERIOUS_PRIORITIES)).alias("serious"),
        flag((prio == "1-URGENT") & (status == "F")).alias("seriousnessdeath"),
        flag(prio.isin(*SERIOUS_PRIORITIES)).alias("seriousnesshospitalization"),
        flag((prio == "1-URGENT") & (status == "P")).alias("seriousnesslifethreatening"),
        F.when((prio == "2-HIGH") & (status == "O"), "1").alias("seriousnessdisabling"),
        F.struct(
            F.when(cust % 10 != 0, (cust % 90 + 1).cast("string")).alias("patientonsetage"),
            F.when(cust % 4 == 1, "1").when(cust % 4 == 2, "2").when(cust % 4 == 3, "0").alias("patientsex"),
            F.transform("names", lambda n: F.struct(n.alias("reactionmeddrapt"))).alias("reaction"),
            F.transform("products", lambda p: F.struct(p.alias("medicinalproduct"))).alias("drug"),
        ).alias("patient"),
    )


def event_mentions(spark, sf_dir):
    """Events as a short series: key = event type, one report per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("safetyreportid"),
        F.col("event_type").alias("drug"),
        F.to_date("ts").alias("date"),
        F.lit("1").alias("serious"),
    )


def contains_any(column, words):
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(column, F.lit(word))
    return hit


def labelled_documents(spark, sf_dir):
    """Documents in the labelling-template shape: rule predictions next to given labels.

    A document without a label keeps blank truth columns. The second truth is also blank
    for low-quality documents, so the two accuracies have different denominators.
    """
    docs = spread_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("safetyreportid"),
        F.col("source").alias("drug"),
        F.col("text").alias("patient_summary_text"),
        F.when(F.col("n_chars") >= 500, "High ").otherwise(" low").alias("predicted_organ_system"),
        F.when(contains_any(F.lower("text"), TOXIC_WORDS), "Severe").otherwise("mild").alias("predicted_severity"),
        F.when(F.col("quality") == 1, " high").when(F.col("quality") == 0, "LOW").otherwise("").alias(
            "true_organ_system"
        ),
        F.when((F.col("quality") == 1) & (F.col("toxic") == 1), "severe")
        .when((F.col("quality") == 1) & (F.col("toxic") == 0), "mild")
        .otherwise(" ")
        .alias("true_severity"),
        F.lit("").alias("notes"),
    )


def vector_rows(spark, sf_dir):
    """Vectors in the stored layout; the label is the metadata used for filtering."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        "embedding",
        F.col("label").cast("string").alias("primary_organ_system"),
    )

