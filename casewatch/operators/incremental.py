"""Resumable work: what is pending, batches with stable ids, label batches, upserts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from casewatch import schemas
from casewatch.functions.ids import batch_id, hash_bucket
from casewatch.operators.ranking import keep_first, stratified_sample

BUCKETS = 65_536


def pending(rows, done, id_column="safetyreportid", done_column=None):
    """Rows whose id is not done yet. Ids are compared as text."""
    ids = done.select(F.col(done_column or id_column).cast("string").alias("__done"))
    return rows.join(ids, F.col(id_column).cast("string") == F.col("__done"), "left_anti")


def pending_sample(rows, done, per_drug=None, cap_all=False, seed=42, id_column="safetyreportid"):
    """Pending rows, at most per_drug of each drug.

    The cap applies to what is left after removing done rows, so a capped rerun takes
    further rows. cap_all=True caps the whole set first, so reruns keep the same rows.
    """
    if per_drug is None:
        return pending(rows, done, id_column)
    if cap_all:
        return pending(stratified_sample(rows, per_drug, seed, id_column=id_column), done, id_column)
    return stratified_sample(pending(rows, done, id_column), per_drug, seed, id_column=id_column)


def _split(rows, bucket, split_rows, id_column):
    """The part of its bucket a row is in: overfull buckets are halved by digest ranges until a part has split_rows or so."""
    sizes = rows.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    halvings = F.greatest(F.ceil(F.log2(F.col("n") / split_rows)), F.lit(0))
    crowded = sizes.select(F.col("bucket").alias("_bucket"), F.pow(F.lit(2), halvings).alias("_parts")).filter("_parts > 1")
    second = F.conv(F.substring(F.sha2(F.col(id_column).cast("string"), 256), 9, 8), 16, 10).cast("long")
    joined = rows.join(crowded, bucket == F.col("_bucket"), "left")
    part = F.coalesce(F.floor(second * F.col("_parts") / 2.0**32), F.lit(0)).cast("int")
    return joined.withColumn("part", part).drop("_bucket", "_parts")


def make_batches(
    rows, size, buckets=BUCKETS, id_column="safetyreportid", payload=("patient_summary_text",), split_rows=None
):
    """Batches of at most `size` rows with a digest id and their items.

    Positions are counted inside hash buckets of the id, never over the whole table. The number of
    buckets belongs to the results and must stay the same for them: then new rows change only
    the batches of the buckets they fall into. Take thousands, so that a bucket is a small share of any
    table. split_rows: halve buckets that hold more rows; this counts the ids first, and a bucket's batches change
    anew whenever it doubles beyond that. Ids must be unique.
    """
    bucket = hash_bucket(F.col(id_column), buckets)
    placed = rows.withColumn("part", F.lit(0)) if split_rows is None else _split(rows, bucket, split_rows, id_column)
    within = Window.partitionBy("bucket", "part").orderBy(id_column)
    numbered = placed.withColumn("bucket", bucket).withColumn(
        "batch", F.floor((F.row_number().over(within) - 1) / size).cast("int")
    )
    item = F.struct(F.col(id_column).alias("id"), *[F.col(c) for c in payload])
    return (
        numbered.groupBy("bucket", "part", "batch")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select(
            batch_id(F.transform("items", lambda i: i["id"])).alias("batch_id"),
            "bucket",
            "part",
            "batch",
            "items",
            F.size("items").alias("n_items"),
        )
    )


def request_json(items):
    return F.to_json(items)


def parse_label_batches(raw, text="response"):
    """Check model output: accepted rows get `reports`, the others a reason.

    Returns the input with `reports` (null when rejected) and `reject_reason`.
    """
    parsed = F.from_json(F.col(text), schemas.LABEL_BATCH)
    has_key = F.get_json_object(F.col(text), "$.reports").isNotNull()
    valid = F.expr(f"try_parse_json(`{text}`)").isNotNull()
    return raw.withColumn("_parsed", parsed["reports"]).select(
        *[F.col(c) for c in raw.columns],
        F.when(valid & has_key, F.col("_parsed")).alias("reports"),
        F.when(~valid | F.col(text).isNull(), F.lit("invalid json"))
        .when(~has_key, F.lit("missing reports"))
        .alias("reject_reason"),
    )


def explode_label_batches(batches):
    """One row per label with its batch and position; batches without labels give none."""
    return batches.select("batch_id", F.posexplode("reports").alias("position", "label")).select(
        "batch_id", "position", "label.*"
    )


def done_ids(batches):
    """Distinct ids over all finished batches."""
    return batches.select(F.explode("reports").alias("r")).select(F.col("r.id").alias("id")).distinct()


def first_labels(labels, severity):
    """First label per report by (batch, position), with normalised severity.

    Also keeps severity_before, so the number of changed labels can be counted.
    """
    first = keep_first(labels.withColumn("id", F.col("id").cast("string")), "id", ["batch_id", "position"])
    return (
        first.withColumnRenamed("id", "safetyreportid")
        .withColumnRenamed("severity", "severity_before")
        .withColumn("severity", severity(F.col("severity_before")))
        .drop("batch_id", "position")
    )


def merge_labels(summaries, labels):
    """Reports that have a label, with it."""
    ids = summaries.withColumn("safetyreportid", F.col("safetyreportid").cast("string"))
    return ids.join(labels.drop("severity_before"), "safetyreportid", "inner")


def upsert(store, new, key="id", order=None):
    """The store with rows of the same key replaced and the others added.

    Of several new rows of one key the last by `order` is taken; without an order, the largest row.
    Write the result to a new path and switch readers over; the old version stays whole.
    """
    row = F.struct(*new.columns)
    last = new.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, F.struct(order, row) if order else row).alias("_row"))
    one = last.select("_row.*").select(*store.columns)
    return store.join(one.select(key), key, "left_anti").select(*store.columns).unionByName(one)
