"""Stable identifiers: prefixes of SHA-256 digests."""

from pyspark.sql import functions as F


def _digest(column, length):
    return F.substring(F.sha2(column, 256), 1, length)


def entity_id(drug, date):
    """Id of a (drug, date) entity. date is text, so the caller decides its form."""
    return _digest(F.concat_ws("_", drug, date), 16)


def timestamp_text(date):
    """The date as midnight timestamp text, the form hashed for explanations."""
    return F.concat(date.cast("date").cast("string"), F.lit(" 00:00:00"))


def batch_id(ids):
    """Id of a batch: digest of its sorted ids as a JSON list."""
    quoted = F.concat(F.lit('["'), F.array_join(F.array_sort(ids), '", "'), F.lit('"]'))
    return _digest(quoted, 24)


def request_signature(params):
    """Digest of a map of text parameters written as JSON with sorted keys."""
    entries = F.transform(
        F.array_sort(F.map_entries(params)),
        lambda e: F.concat(F.lit('"'), e["key"], F.lit('": "'), e["value"], F.lit('"')),
    )
    return _digest(F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")), 24)


def hash_bucket(column, buckets):
    """Even bucket 0..buckets-1 of an id, the same on every run and engine."""
    head = F.conv(F.substring(F.sha2(column.cast("string"), 256), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(buckets)).cast("int")
