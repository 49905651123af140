"""Quality classifier: boosted trees over statistics of a document's text.

One pass turns whole texts into a few numbers, kept in the shared folder. The trees are fitted on
at most MAX_FIT_ROWS labelled rows, those with the smallest digests of their ids, and score every
row from the kept numbers. Nothing but the text enters a score.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from casewatch.llm import boosted_trees
from casewatch.llm.common import remainder, text_or_empty
from casewatch.sources.workspace import staged

FOLDS = 5
HELD_OUT = 0
THRESHOLD = 0.3
MAX_FIT_ROWS = 40_000  # bound of the sample that the trees are fitted on
SEED = 7

_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
            "symbol": b"#*$%&|<>", "mark": b"!?", "stop": b".", "comma": b",;:", "quote": b"\"'()[]{}", "other": b"-_=+/\\~^@`",
            "space": b" \t\x0b\x0c\r", "line": b"\n"}
_TABLE = np.full(256, len(_CLASSES), np.uint8)  # the rest: bytes outside ASCII and controls
for _k, _bytes in enumerate(_CLASSES.values()):
    _TABLE[list(_bytes)] = _k
STATISTICS = (
    *(f"share_{c}" for c in _CLASSES), "share_rest", "log_words", "mean_length", "spread_length", "short_words", "long_words",
    "distinct_words", "distinct_pairs", "distinct_triples", "repeated_lines", "log_lines", "words_per_line", "entropy",
    "upper_starts",
)


def statistics(text):
    """The numbers of one UTF-8 text; all zero for a text without words."""
    words = text.split()
    out = np.zeros(len(STATISTICS), np.float32)
    if not words:
        return out
    raw = np.frombuffer(text, np.uint8)
    histogram = np.bincount(raw, minlength=256)
    n = len(words)
    shares = np.bincount(_TABLE, histogram, len(_CLASSES) + 1) / len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip()]
    seen = histogram[histogram > 0] / len(raw)
    space = np.isin(raw[:-1], (32, 9, 10, 11, 12, 13))
    starts = (raw[1:][space] >= 65) & (raw[1:][space] <= 90)
    pairs, triples = zip(words, words[1:], strict=False), zip(words, words[1:], words[2:], strict=False)
    out[: len(shares)] = shares
    out[len(shares) :] = (
        np.log1p(n), lengths.mean(), lengths.std(), (lengths <= 3).mean(), (lengths >= 12).mean(),
        len(set(words)) / n, len(set(pairs)) / max(1, n - 1), len(set(triples)) / max(1, n - 2),
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), n / max(1, len(lines)), -(seen * np.log2(seen)).sum(),
        starts.sum() / n,
    )
    return out


def with_statistics(docs, keep=("doc_id",), text="text"):
    """The kept columns and `stats`, an array of floats in the order of STATISTICS."""
    narrow = docs.select(*keep, text_or_empty(text).cast("binary").alias("_bytes"))
    schema = narrow.drop("_bytes").withColumn("stats", F.array().cast("array<float>")).schema

    def run(batches):
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            flat = np.concatenate(found) if found else np.zeros(0, np.float32)
            offsets = np.arange(len(found) + 1, dtype=np.int32) * len(STATISTICS)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, column], names=schema.names)

    return narrow.mapInArrow(run, schema)


def fit_rows(labels, label="quality", folds=FOLDS, held_out=HELD_OUT, most=MAX_FIT_ROWS, seed=SEED):
    """At most `most` labelled ids outside the held-out fold, by the smallest digest of (seed, id).

    Rows without an id or a label teach nothing. An id labelled twice counts once, with its smaller label.
    """
    usable = labels.filter(F.col(label).isNotNull() & (remainder("doc_id", folds) != held_out))
    one = usable.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64(F.lit(seed), F.col("doc_id")), "doc_id").limit(most)


def fit(stats, rows, **parameters):
    """Trees fitted on the statistics of the chosen rows (bounded by fit_rows)."""
    known = stats.join(rows, "doc_id").groupBy("doc_id").agg(F.min("stats").alias("stats"), F.min("label").alias("label"))
    table = known.orderBy("doc_id").toArrow()
    flat = table.column("stats").combine_chunks().flatten().to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0)
    x = flat.reshape(table.num_rows, len(STATISTICS)).astype(np.float64)
    y = table.column("label").to_numpy().astype(np.float64)
    return boosted_trees.fit(x, y, **parameters)


def score(stats, forest):
    """Adds score, the probability of label 1, to rows that have `stats`; drops `stats`."""
    schema = stats.drop("stats").withColumn("score", F.lit(0.0).cast("double")).schema
    at = stats.columns.index("stats")

    def run(batches):
        for batch in batches:
            x = batch.column(at).flatten().to_numpy(zero_copy_only=False)
            x = x.reshape(batch.num_rows, len(STATISTICS)).astype(np.float64)
            others = [batch.column(i) for i in range(batch.num_columns) if i != at]
            found = pa.array(boosted_trees.probability(forest, x))
            yield pa.RecordBatch.from_arrays([*others, found], names=schema.names)

    return stats.mapInArrow(run, schema)


def classify(docs, labels, keep=("doc_id",), label="quality", text="text", threshold=THRESHOLD, checkpoint=staged, **sample):
    """The kept columns, score and predicted for every row of docs.

    Null and empty texts score like texts without words. Without usable labels the score is the same for all rows.
    """
    columns = tuple(dict.fromkeys(("doc_id", *keep)))
    stats = checkpoint(with_statistics(docs, columns, text), "statistics")
    forest = fit(stats.select("doc_id", "stats"), fit_rows(labels, label, **sample))
    scored = score(stats, forest)
    return scored.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs, labels, label="quality", text="text", threshold=THRESHOLD, **sample):
    """The rows of docs that are predicted good, unchanged and in place: texts are never shuffled.

    The statistics of labelled rows come from a first pass; the second one scores and filters.
    """
    forest = fit(with_statistics(docs, ("doc_id",), text), fit_rows(labels, label, **sample))
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            found = [statistics((t.as_py() or "").encode()) for t in batch.column(at)]
            x = np.array(found, np.float64).reshape(batch.num_rows, len(STATISTICS))
            yield batch.filter(pa.array(boosted_trees.probability(forest, x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
