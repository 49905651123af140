"""Repeated lines and sentences are removed everywhere but at their earliest place.

Units are the sentences of every line, long ones in pieces. Lines alone would miss a passage that stands inside another
document's line; its sentences are found wherever they stand. A unit is normalised (lower case, no
punctuation, single spaces) and digested. A unit of fewer than MIN_WORDS words is digested together with
the words before it, up to that number: a short sentence is repeated only where what precedes it is
repeated too, so chance repetitions of short sentences in unrelated texts do not count.

Sentences of more than LONG words are cut further where their own words say so: after the word whose digest
(with the word before it) is the smallest of SPAN neighbours. A passage cuts itself the same way wherever it
stands, so one of over 50 words always holds a whole unit even inside sentences that differ otherwise.

Digests are grouped over all documents; the occurrence with the smallest (doc_id, start) stays. Texts
never travel, only digests with offsets, and of those only repeated ones go further.
"""

import re
from collections import deque

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from casewatch.llm.common import aside, text_or_empty
from casewatch.sources.workspace import staged

MIN_WORDS = 8
LONG = 24  # words; of a passage of over 50 that holds no whole sentence, one sentence has more
SPAN = 16  # any so many words of a long sentence hold a cut
PUNCTUATION = b".,;:!?\"'()[]{}|"
# a sentence: no line break inside, up to marks that white space or the line's end follows
SENTENCE = re.compile(r"[^\x20\x09-\x0D][^\n.!?]*(?:[.!?]+(?=[^\x20\x09-\x0D.!?])[^\n.!?]*)*[.!?]*")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMIT = 100_000


def cuts(words, span=SPAN):
    """Numbers of words after which a word list is cut: at the smallest digest of every span of neighbours.

    Of equal digests the chosen one stays as long as it is in the span, then the last one is chosen.
    """
    digests = [xxhash.xxh3_64_intdigest(a + b" " + b) for a, b in zip(words, words[1:], strict=False)]
    rising, chosen = deque(), None  # places of digests that nothing behind them undercuts, smallest first
    for i, digest in enumerate(digests):
        while rising and digests[rising[-1]] >= digest:
            rising.pop()
        rising.append(i)
        if rising[0] <= i - span:
            rising.popleft()
        if i >= span - 1:
            if chosen is not None and chosen > i - span and digests[chosen] == digests[rising[0]]:
                continue
            chosen = rising[0]
            yield chosen + 2


def pieces_of(sentence, min_words=MIN_WORDS):
    """(start, end, words) of a sentence, a match: one piece, or several of a long one."""
    words = sentence[0].lower().encode().translate(None, PUNCTUATION).split()
    if len(words) <= LONG:
        yield sentence.start(), sentence.end(), words
        return
    places, words = [], []
    for word in WORD.finditer(sentence[0]):
        plain = word[0].lower().encode().translate(None, PUNCTUATION)
        if plain:
            places.append(word.span())
            words.append(plain)
    done, start = 0, sentence.start()
    for cut in cuts(words):
        # the first piece needs no words before it, so a sentence that is repeated goes as a whole
        if min_words <= cut < len(words):
            yield start, sentence.start() + places[cut - 1][1], words[done:cut]
            done, start = cut, sentence.start() + places[cut][0]
    yield start, sentence.end(), words[done:]


def units_of(text, min_words=MIN_WORDS):
    """(start, end, words, digest) of every unit of a text that is long enough; offsets in code points."""
    before = []
    for sentence in SENTENCE.finditer(text):
        for start, end, words in pieces_of(sentence, min_words):
            if not words:
                continue
            before = (before[-min_words:] if len(words) < min_words else []) + words
            if len(before) >= min_words:
                known = before[-max(len(words), min_words) :]
                yield start, end, len(words), xxhash.xxh3_128_digest(b" ".join(known))


def units(docs, text="text", min_words=MIN_WORDS):
    """doc_id, start, end, words, digest: one row per unit. Null and empty texts have none."""
    narrow = docs.select("doc_id", text_or_empty(text).alias("_text"))
    schema = docs.sparkSession.createDataFrame([], "start int, end int, words int, digest binary").schema
    out = narrow.select("doc_id").schema
    for field in schema:
        out = out.add(field)
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())

    def run(batches):
        for batch in batches:
            ids, at, rows = batch.column(0), [], []
            for i, value in enumerate(batch.column(1)):
                for unit in units_of(value.as_py(), min_words):
                    at.append(i)
                    rows.append(unit)
                    if len(rows) == EMIT:
                        yield frame(ids, at, rows)
                        at, rows = [], []
            if rows:
                yield frame(ids, at, rows)

    def frame(ids, at, rows):
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *columns], names=out.names)

    return narrow.mapInArrow(run, out)


def repeats(docs, text="text", min_words=MIN_WORDS, checkpoint=staged):
    """doc_id, start, end, words, first_doc_id, first_start: every unit that goes, and the one that stays.

    Units rank by (doc_id, start), a null doc_id last. Rows that repeat a doc_id are that same document: their
    units at the same place stand or go together. An empty table gives an empty one.
    """
    rows = checkpoint(units(docs, text, min_words), "units")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("start"))
    firsts = rows.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # as a table of its own, so that a digest with a third of all rows is a skewed key that Spark can split
    firsts = checkpoint(firsts, "first-places")
    found = rows.join(firsts.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"))
    return found.filter(~place.eqNullSafe(F.col("first"))).select(
        "doc_id", "start", "end", "words", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start")
    )


def deduplicated(docs, text="text", min_words=MIN_WORDS, checkpoint=staged):
    """docs with repeated units cut out of the text, and `removed`: their (start, end) in the original text.

    White space around a cut stays. Other columns, whatever their names, and texts without repetition stay as they
    are; a column named removed gives way.
    """
    spans = (
        repeats(docs, text, min_words, checkpoint)
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed"))  # at most a document's own units
    )
    joined = aside(docs.drop("removed"), "doc_id", text).join(spans, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    ends = F.concat(F.array(F.lit(0)), F.transform("removed", lambda s: s["end"]))
    pieces = F.transform(
        ends,
        lambda end, i: F.substring(
            F.col(text), end + 1, F.coalesce(F.get(F.col("removed"), i)["start"], F.length(text)) - end
        ),
    )
    left = F.when(F.col("removed").isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return joined.select(
        F.col("_rest").withField(text, left).alias("_rest"), F.coalesce("removed", none).alias("removed")
    ).select("_rest.*", "removed")
