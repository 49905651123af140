"""Quality rules with cross-document line frequency, in DataFrame functions only.

A line that many different documents of one host carry is boilerplate. Lines are normalised,
counted once per document, and removed where a host's limit is exceeded; a document that loses
most of its words is rejected. Exact copies of a document count as one document, or popular
copies would turn their own prose into boilerplate.

In-row work (words, repeated windows, repeated lines) needs no shuffle. Only line digests travel.
"""

from pyspark.sql import functions as F

from casewatch.llm.common import SPACE_CLASS, aside, row_key, text_or_empty, words
from casewatch.sources.workspace import staged

MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_SHARE = 20  # per cent of the words
SYMBOLS = "#*$%&|<>"
MIN_DOCUMENTS = 10  # a line in at most so many documents of a host is never boilerplate
MAX_SHARE = 0.02  # nor one in at most this share of the host's documents
LEAST_LEFT = 0.3  # share of the words that must be left
SALTS = 32


def _repeated_positions(ordered):
    """Positions, in order, of the (digest, position) structs of a sorted array whose digest occurs twice or more."""
    n = F.size(ordered)
    repeated = F.filter(
        ordered,
        lambda x, k: (
            ((k > 0) & (F.get(ordered, k - 1)["h"] == x["h"])) | ((k < n - 1) & (F.get(ordered, k + 1)["h"] == x["h"]))
        ),
    )
    return F.sort_array(F.transform(repeated, lambda x: x["i"]))


def measured(docs, text="text", window=WINDOW, symbols=SYMBOLS):
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long).

    A null text has none of anything. Rows stay as they are otherwise.
    """
    content = text_or_empty(text)
    # each step is a projection of its own, so that arrays are built once and read by position
    step = docs.withColumn("_words", words(content)).withColumn("_lines", F.filter(F.split(content, "\n", -1), _has_word))
    step = step.withColumn(
        "_windows",
        F.when(
            F.size("_words") > window,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size("_words") - (window - 1), F.lit(1))),
                    lambda i: F.struct(F.xxhash64(F.slice(F.col("_words"), i, window)).alias("h"), i.alias("i")),
                )
            ),
        ),
    )
    step = step.withColumn("_at", _repeated_positions(F.col("_windows")))
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(window)), F.lit(window))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    bare = F.regexp_replace(content, SPACE_CLASS, "")
    return step.select(
        *[F.col(c) for c in docs.columns],
        F.size("_words").cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(content) - F.length(F.regexp_replace(content, f"[{symbols}]", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _has_word(line):
    return F.regexp_replace(line, SPACE_CLASS, "") != ""


def normalised(line):
    """Lower case, digits alike, single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, "[0-9]", "0")), SPACE_CLASS, " "))


def line_rows(docs, text="text", host="source"):
    """One row per document, host and normalised line: key, host, line digest, words, words in all such lines.

    Repeated lines of a document are one row. key identifies (doc_id, host, text).
    """
    content = text_or_empty(text)
    lines = F.filter(F.split(content, "\n", -1), _has_word)
    rows = docs.select(
        row_key("doc_id", host, text).alias("key"),
        F.col("doc_id"),
        F.col(host).alias("host"),
        F.xxhash64(content).alias("content"),
        F.explode(F.transform(lines, normalised)).alias("line"),
    )
    return rows.select(
        "key", "doc_id", "host", "content", F.xxhash64("line").alias("line"), F.size(F.split("line", " ")).cast("long").alias("words")
    )


def frequent_lines(lines, documents, min_documents=MIN_DOCUMENTS, max_share=MAX_SHARE):
    """(host, line) found in more documents of the host than its limit. Copies count once.

    lines: line_rows(); documents: host and content of every document. Distinct rows are formed first, so
    that a line that every document has is counted in many tasks.
    """
    of_host = documents.distinct().groupBy("host").agg(F.count("*").alias("host_documents"))
    counted = (
        lines.select("host", "line", "content").distinct().groupBy("host", "line").agg(F.count("*").alias("documents"))
    )
    limited = counted.filter(F.col("documents") > min_documents).withColumnRenamed("host", "_host")
    return (
        limited.join(of_host, F.col("_host").eqNullSafe(F.col("host")))
        .filter(F.col("documents") > F.col("host_documents") * max_share)
        .select("host", "line", "documents", "host_documents")
    )


def _hits(docs, text, host, min_documents, max_share, checkpoint):
    """The rows of line_rows() in lines above their host's limit.

    The frequent lines are few and kept as a table first, so that Spark knows their size and need not
    shuffle all lines to meet them; where they are many, salts spread a line that a third of all rows has.
    """
    lines = line_rows(docs, text, host)
    documents = docs.select(F.col(host).alias("host"), F.xxhash64(text_or_empty(text)).alias("content"))
    frequent = checkpoint(frequent_lines(lines, documents, min_documents, max_share), "frequent-lines")
    salted = frequent.select(
        F.col("host").alias("_host"), F.col("line").alias("_line"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    return lines.join(
        salted,
        (F.col("line") == F.col("_line"))
        & F.col("host").eqNullSafe(F.col("_host"))
        & (F.pmod(F.col("key"), F.lit(SALTS)) == F.col("_salt")),
    )


def removed_words(docs, text="text", host="source", min_documents=MIN_DOCUMENTS, max_share=MAX_SHARE, checkpoint=staged):
    """key, doc_id, removed: words of a document in lines above its host's limit; only documents that have some."""
    hit = _hits(docs, text, host, min_documents, max_share, checkpoint)
    return hit.groupBy("key", "doc_id").agg(F.sum("words").alias("removed"))


def judged(docs, text="text", host="source", min_documents=MIN_DOCUMENTS, max_share=MAX_SHARE, least_left=LEAST_LEFT):
    """Measures and verdict per row of docs: base_failed, removed_words, kept.

    Rows of equal id, host and text get equal verdicts. A null host is a host of its own. A document
    without words fails the base rule. An empty table gives an empty one.
    """
    removed = removed_words(docs, text, host, min_documents, max_share)
    keyed = measured(
        docs.select("doc_id", F.col(text).alias("_text"), row_key("doc_id", host, text).alias("_key")), "_text"
    ).drop("_text")
    # a document's rows are counted once per row of the same key in `removed`
    repeats = keyed.groupBy("_key", "doc_id").agg(F.count("*").alias("_rows"))
    shares = (
        removed.join(repeats, (F.col("key") == F.col("_key")) & removed.doc_id.eqNullSafe(repeats.doc_id))
        .select(F.col("key"), removed.doc_id.alias("_id"), (F.col("removed") / F.col("_rows")).cast("long").alias("removed_words"))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_SHARE * F.col("n_words"))
    joined = keyed.join(shares, (F.col("_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    lost = F.coalesce(F.col("removed_words"), F.lit(0))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("n_words") - lost >= least_left * F.col("n_words"))).alias("kept"),
        lost.alias("removed_words"),
    )


def without_frequent_lines(
    docs, text="text", host="source", min_documents=MIN_DOCUMENTS, max_share=MAX_SHARE, checkpoint=staged
):
    """docs with the lines above their host's limit taken out of the text; other columns as they are, whatever their names.

    Rows that repeat are treated alike; null and empty texts, and an empty table, stay as they are.
    """
    hit = _hits(docs, text, host, min_documents, max_share, checkpoint)
    drop = hit.groupBy(F.col("key").alias("_key")).agg(F.collect_set("line").alias("_drop"))  # at most a text's own lines
    keyed = aside(docs, "doc_id", host, text).withColumn("_row", row_key("doc_id", host, text))
    left = F.filter(
        F.split(F.col(text), "\n", -1),
        lambda line: ~F.array_contains(F.coalesce(F.col("_drop"), F.array().cast("array<bigint>")), F.xxhash64(normalised(line))),
    )
    joined = keyed.join(drop, F.col("_row") == F.col("_key"), "left")
    return joined.select(F.col("_rest").withField(text, F.array_join(left, "\n")).alias("_rest")).select("_rest.*")
