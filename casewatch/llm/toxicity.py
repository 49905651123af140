"""Toxicity by compression distance: which of two zstandard dictionaries fits a window of text better.

Both dictionaries hold the same trained ordinary text; one also holds what is peculiar to toxic text. A
window that compresses better with it has something in common with toxic text that ordinary text does
not explain. Sharing the ordinary part matters: with two unrelated dictionaries the chance differences
of ordinary words outweigh a single insult.

A document's window gains are summed up in a few numbers, and boosted trees turn those into a
calibrated probability. Dictionaries and calibration are learnt from at most MAX_FIT_ROWS labelled rows.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from casewatch.llm import boosted_trees
from casewatch.llm.common import text_or_empty
from casewatch.llm.quality_classifier import fit_rows
from casewatch.sources.workspace import staged

FOLDS = 3
HELD_OUT = 1
THRESHOLD = 0.7
MAX_FIT_ROWS = 20_000  # bound of the labelled sample; its ids are broadcast, 16 bytes each
WINDOW, STEP = 8, 4  # words
ORDINARY_BYTES = 16_384  # of the trained ordinary dictionary
PECULIAR_BYTES = 8_192  # of toxic material, most
TRAINING_WINDOWS = 20_000  # windows of ordinary text that the ordinary dictionary is trained on, most
LEAST_CONTEXTS = 3  # of a peculiar word in toxic text, at least
LEAST_LOG_ODDS = 1.5  # lower bound of its log odds ratio
CANDIDATES = 20_000  # words whose contexts are counted, most
WORD_BYTES = 64  # of a peculiar word, most
LEAST_MATCH = 6  # bytes: shorter matches are chance
GAINS = 13


def windows(text, size=WINDOW, step=STEP):
    """Overlapping windows of lower-cased words, each with a space on either side."""
    words = text.lower().split()
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, max(1, len(words) - size + step), step)]


def _compressor(content):
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=15, chain_log=15, search_log=3, min_match=LEAST_MATCH, target_length=0,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary)


class Distance:
    """Window gains of a text: bytes that the toxic dictionary saves. Built from two byte strings in each task."""

    def __init__(self, ordinary, peculiar):
        self.usable = bool(ordinary) and bool(peculiar)
        if self.usable:
            self.plain, self.toxic = _compressor(ordinary).compress, _compressor(ordinary + peculiar).compress

    def gains(self, text):
        parts = windows(text) if self.usable else []
        return np.array([len(self.plain(w)) - len(self.toxic(w)) for w in parts], np.float64)

    def summary(self, text):
        """GAINS numbers; all zero without words."""
        g = self.gains(text)
        out = np.zeros(GAINS, np.float32)
        if len(g):
            top = np.sort(g)[::-1]
            out[: min(3, len(g))] = top[:3]
            out[3:5] = g.mean(), g.std()
            out[5:11] = [(g >= k).sum() for k in (2, 3, 4, 5, 6, 8)]
            out[11:] = np.log1p(len(g)), (g >= 4).mean()
        return out


def peculiar_words(sample, least=LEAST_CONTEXTS, least_log_odds=LEAST_LOG_ODDS, most_bytes=PECULIAR_BYTES):
    """Words of toxic text whose log odds against ordinary text are surely high, the surest last.

    sample: _bytes, label. What counts is in how many different contexts (the words on both sides) a word
    stands: near copies of one toxic document repeat their words, but always in the same places. Counts
    are formed in Spark; what comes back fills at most most_bytes.
    """
    texts = F.regexp_replace(F.lower(F.col("_bytes").cast("string")), r"[\x20\x09-\x0D]+", " ")
    step = sample.select("label", F.filter(F.split(texts, " "), lambda w: w != "").alias("words"))
    sizes = step.groupBy("label").agg(F.sum(F.size("words")).alias("n"))
    n = {r["label"]: r["n"] for r in sizes.collect()}  # two rows
    toxic, plain = max(1, n.get(1, 0)), max(1, n.get(0, 0))

    def surely(a, b):
        a, b = F.col(a) + 0.5, F.col(b) + 0.5
        return F.log(a / toxic) - F.log(b / plain) - 2 * F.sqrt(1 / a + 1 / b)

    def counted(rows):
        return rows.groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).filter(F.col("a") >= least)

    documents = counted(step.select("label", F.explode(F.array_distinct("words")).alias("word")))
    likely = documents.filter((F.octet_length("word") <= WORD_BYTES) & (surely("a", "b") > 0))
    likely = likely.orderBy(F.desc(surely("a", "b")), "word").limit(CANDIDATES).select("word")
    places = step.select("label", "words", F.posexplode("words").alias("i", "word"))
    places = places.join(F.broadcast(likely), "word")  # CANDIDATES words of WORD_BYTES at most
    contexts = places.select(
        "label", "word", F.xxhash64(F.get("words", F.col("i") - 1), F.get("words", F.col("i") + 1)).alias("context")
    ).distinct()
    found = counted(contexts).select("word", surely("a", "b").alias("bound")).filter(F.col("bound") > least_log_odds)
    chosen, used = [], 0
    for row in found.orderBy(F.desc("bound"), "word").limit(most_bytes // 2).collect():
        word = row["word"].encode()
        if used + len(word) + 1 <= most_bytes:
            chosen.append(word)
            used += len(word) + 1
    return b" " + b" ".join(reversed(chosen)) + b" " if chosen else b""


def ordinary_text(sample, most=TRAINING_WINDOWS, size=ORDINARY_BYTES):
    """A trained dictionary of ordinary text; its raw samples where there are too few to train on."""
    schema = "digest long, part binary"

    def run(batches):
        import xxhash

        for batch in batches:
            parts = [w for t in batch.column(0) for w in windows(t.as_py(), 16, 16)]
            digests = [xxhash.xxh64_intdigest(w) >> 1 for w in parts]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(parts, pa.binary())], ["digest", "part"])

    rows = sample.filter("label = 0").select("_bytes").mapInArrow(run, schema).orderBy("digest", "part").limit(most).collect()
    parts = [bytes(r["part"]) for r in rows]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples
        return b"".join(parts)[:size]


def _summaries(docs, keep, distance):
    schema = docs.drop("_bytes").withColumn("gains", F.array().cast("array<float>")).schema

    def run(batches):
        measure = Distance(*distance)
        for batch in batches:
            found = [measure.summary(t.as_py()) for t in batch.column(len(keep))]
            flat = np.concatenate(found) if found else np.zeros(0, np.float32)
            offsets = np.arange(len(found) + 1, dtype=np.int32) * GAINS
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), column], names=schema.names)

    return docs.mapInArrow(run, schema)


def learn(docs, labels, label="toxic", text="text", checkpoint=staged, **bounds):
    """(ordinary, peculiar, forest) from the labelled sample. Copies of a text count once."""
    chosen = fit_rows(labels, label, **{"folds": FOLDS, "held_out": HELD_OUT, "most": MAX_FIT_ROWS} | bounds)
    rows = docs.select("doc_id", text_or_empty(text).cast("binary").alias("_bytes"))
    # the ids are MAX_FIT_ROWS at most, so documents are filtered where they lie
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("_bytes").agg(F.min("label").cast("long").alias("label"))
    sample = checkpoint(sample, "toxic-sample")
    ordinary, peculiar = ordinary_text(sample), peculiar_words(sample)
    table = _summaries(sample.select("label", "_bytes"), ("label",), (ordinary, peculiar)).toArrow()
    x = np.array(table.column("gains").to_pylist(), np.float64).reshape(table.num_rows, GAINS)
    y = table.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # rows come back in any order
    return ordinary, peculiar, boosted_trees.fit(x[order], y[order], trees=60, depth=3, rate=0.15, least=10)


def classify(docs, model, keep=("doc_id",), text="text", threshold=THRESHOLD):
    """The kept columns, score and predicted for every row of docs, by a model of learn().

    Null and empty texts score like texts without toxic words. Without usable labels all scores are equal.
    """
    ordinary, peculiar, forest = model
    rows = docs.select(*keep, text_or_empty(text).cast("binary").alias("_bytes"))
    schema = rows.drop("_bytes").withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0)).schema

    def run(batches):
        measure = Distance(ordinary, peculiar)
        for batch in batches:
            found = [measure.summary(t.as_py()) for t in batch.column(len(keep))]
            scores = boosted_trees.probability(forest, np.array(found, np.float64).reshape(batch.num_rows, GAINS))
            columns = [*(batch.column(i) for i in range(len(keep))), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
