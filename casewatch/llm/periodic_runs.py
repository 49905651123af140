"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
max(LEAST_WORDS, 2 q) words that no neighbouring word extends keeping q.

1. Per power-of-two length m every factor of m words gets a number: words first, then pairs of numbers m / 2
   apart. Factors that occur once in their text get none, so the next length only looks at the rest.
2. Occurrences of one factor that start within m words of each other form an arithmetic progression (its
   difference is the factor's period). For every place the nearest and the farthest occurrence from m to
   below 2 m words on propose periods; what lies between them cannot be the smallest period of a run of two
   periods around that place which neither end of its progression proposes elsewhere.
3. A proposal is extended to both sides over the numbers, longest factors first. Equal stretches are one run; of
   several periods over one stretch the smallest holds.

No text meets another: the work is one pass over the table without a shuffle. A task holds the words of one
Arrow batch and, for at most CHUNK_WORDS of them or one longer text, 4 bytes a word and length.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from casewatch.llm.common import text_or_empty, words

LEAST_WORDS = 12
CHUNK_WORDS = 400_000
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _ordered(first, second, places, bits):
    """places sorted by (first, second, place), and where a new (first, second) begins."""
    limit = int(first.max()) + 1, int(second.max()) + 1
    if (limit[0] * limit[1]).bit_length() + bits < 63:
        packed = ((first * limit[1] + second) << bits) | places
        packed.sort()
        places, key = packed & ((1 << bits) - 1), packed >> bits
        fresh = key[1:] != key[:-1]
    else:
        order = np.lexsort((places, second, first))
        first, second, places = first[order], second[order], places[order]
        fresh = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return places, np.concatenate(([True], fresh))


def _proposals(codes, texts):
    """Numbers per length, and proposed (place, period) of words given as codes; texts: text of each word, ascending."""
    n = len(codes)
    bits = (4 * n).bit_length()
    levels, proposed = [], []
    first, second, places, m = codes.astype(np.int64), texts.astype(np.int64), np.arange(n, dtype=np.int64), 1
    while len(places):
        places, fresh = _ordered(first, second, places, bits)
        alone = fresh & np.append(fresh[1:], True)
        places, group = places[~alone], np.cumsum(fresh)[~alone]
        if not len(places):
            break
        numbers = np.zeros(n, np.int32)  # 0: occurs once
        numbers[places] = group
        levels.append(numbers)
        line = (group.astype(np.int64) << bits) | places  # other groups are farther away than any text is long
        near = np.flatnonzero(np.diff(line) < 2 * m)
        if len(near):
            here = line[near]
            nearest = line[np.minimum(np.searchsorted(line, here + m), len(line) - 1)] - here
            farthest = line[np.searchsorted(line, here + 2 * m) - 1] - here
            periods, starts = np.concatenate([nearest, farthest]), np.tile(places[near], 2)
            good = (periods >= m) & (periods < 2 * m)
            found = np.unique((periods[good] << bits) | starts[good])
            proposed.append(found[np.diff(found, prepend=-1) != 1])  # others extend to the stretch of the place before
        places = np.sort(places)
        places = places[places + m < n]
        places = places[(numbers[places + m] > 0) & (texts[places] == texts[places + m])]
        first, second = numbers[places].astype(np.int64), numbers[places + m].astype(np.int64)
        m *= 2
    found = np.concatenate([np.zeros(0, np.int64), *proposed])
    return levels, found >> bits, found & ((1 << bits) - 1)


def find_runs(codes, texts, least=LEAST_WORDS):
    """start, stop, period of all runs of words given as codes, by start, then period.

    texts: number of the text of each word, ascending; no run goes from one text into another. Periods of runs that
    share their first word differ, so the order is total. No words, no runs.
    """
    levels, period, place = _proposals(codes, texts)
    n = len(codes)
    left, right = place.copy(), place.copy()
    for k in range(len(levels) - 1, -1, -1):
        numbers, m = levels[k], 1 << k
        far = np.minimum(right + period, n - 1)
        same = (right + period < n) & (numbers[right] > 0) & (numbers[right] == numbers[far])
        right = right + m * same
        back = np.maximum(left - m, 0)
        same = (left >= m) & (numbers[back] > 0) & (numbers[back] == numbers[np.minimum(back + period, n - 1)])
        left = left - m * same
    stop = right + period
    long = stop - left >= np.maximum(least, 2 * period)
    rows = np.stack([left[long], stop[long], period[long]], axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[smallest]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _chunks(sizes, most):
    """Cuts texts, by their numbers of words, into ranges of at most `most` words or one text."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if len(sizes):
        yield begin, len(sizes)


def _of_chunk(column, least):
    """Arrays of runs and of collapsed texts for a list array of words."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    ends = np.cumsum(sizes)
    begins = ends - sizes
    texts = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    runs = find_runs(codes, texts, least)
    owner = texts[runs[:, 0]]
    offsets = pa.array(np.searchsorted(owner, np.arange(len(sizes) + 1)), pa.int32())
    told = pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in (runs[:, 0] - begins[owner], runs[:, 1] - runs[:, 0], runs[:, 2])],
        ["start", "length", "period"],
    )
    depth = np.zeros(len(codes) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    kept = np.cumsum(depth)[:-1] == 0
    left = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], ends))]
    rest = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept)))
    return pa.ListArray.from_arrays(offsets, told), pc.binary_join(rest, " ")


def periodic_runs(rows, least=LEAST_WORDS, chunk_words=CHUNK_WORDS):
    """Adds n_words, runs and collapsed to rows with an array column `words`.

    runs: structs of start (word number), length and period, by start, then period. collapsed: the words that no run
    holds after its first period, joined by one space. An array that is null, or empty, has no runs and an empty
    text; null words in it are left out. Every row is answered by itself, repeated rows too; other columns stay as
    they are. Columns named n_words, runs or collapsed give way to the new ones. An empty table gives an empty one.
    """
    rest = rows.drop("words", "n_words", "runs", "collapsed")
    schema = rest.withColumns(
        {"n_words": F.lit(0).cast("long"), "runs": F.array().cast(f"array<{RUN}>"), "collapsed": F.lit("")}
    ).schema

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            counts = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            for begin, end in _chunks(counts, chunk_words):
                part = batch.slice(begin, end - begin)
                runs, collapsed = _of_chunk(part.column(0), least)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(counts[begin:end], pa.int64()), runs, collapsed], schema.names
                )

    present = F.filter(F.coalesce("words", F.array().cast("array<string>")), lambda w: w.isNotNull())
    return rows.select(present.alias("words"), *[rest[c] for c in rest.columns]).mapInArrow(run, schema)


def runs_of(docs, text="text", **options):
    """periodic_runs() of the words of a text column; a null text is empty.

    Neither the text nor a column named words is carried along; for the rest see periodic_runs().
    """
    return periodic_runs(docs.withColumn("words", words(text_or_empty(text))).drop(text), **options)


def repeated_tail(words_column, doc_id):
    """Words whose tail repeats itself in a tenth of the documents, as their ids decide.

    With h the crc32 of the id, g = h div 10, and h divisible by 10: each word from a = g % n on becomes word
    a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). The words of a null id, or none, stay.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words_column)
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (3 + g % 8))

    def word(w, i):
        return F.when(i < a, w).otherwise(F.get(words_column, (a + (i - a) % p).cast("int")))

    chosen = F.coalesce((h % 10 == 0) & (n > 0), F.lit(False))
    return F.when(chosen, F.transform(words_column, word)).otherwise(words_column)


def longest(runs="runs"):
    """The run of greatest length of an array of runs; of equals the first by start, then period. Null without runs."""
    return F.aggregate(
        runs,
        F.lit(None).cast(RUN),
        lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best),
    )


def told(runs="runs"):
    """Every run as `start,length,period` and a line end, joined."""
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))


def report(docs):
    """Runs of documents whose words repeated_tail() changed: one row per document, with digests of runs and rest."""
    rows = docs.select("doc_id", words(text_or_empty()).alias("words"))
    found = periodic_runs(rows.select("doc_id", repeated_tail(F.col("words"), "doc_id").alias("words")))
    first = found.withColumn("first", longest())
    return first.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "first.start",
        "first.length",
        "first.period",
        F.floor(1000 * F.col("first.length") / F.col("first.period")).alias("exponent_milli"),
        F.sha2(told(), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
