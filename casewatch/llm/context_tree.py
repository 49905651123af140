"""Context-tree weighting over bytes: the probability of every text under a model of the corpus.

A byte is eight binary decisions. Every decision has a tree of contexts, the preceding bytes up to
DEPTH of them. A node holds how often each outcome was seen there; its Krichevsky-Trofimov estimate and
those of its children are weighted half and half by how well they code the training texts, so all depths
are mixed with weights that the data set. The counts are final before anything is scored, so a weight
depends on sums only and the whole tree is worked out by grouping. A context that training never saw
has no node: the mixture ends at the deepest one that it did see.

A text is its lower-cased words with single spaces and an end mark. Work is split twice:

* Bundles of documents (about BUNDLE_BYTES each) count their byte strings of DEPTH + 1, and in the end are
  scored with just the probabilities of the strings they have. Texts are shuffled into bundles, never
  compared with each other.
* The tree is split by the last SPLIT bytes of context. All deeper nodes of such a part stand together:
  at most 256 ** (DEPTH - SPLIT + 1) strings. Above, levels 1 and 2 are worked out by last byte (at most
  65,536 contexts each), and the root from at most 65,280 rows on the driver.
"""

import contextlib
import ctypes
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from casewatch.llm.common import remainder, text_or_empty
from casewatch.sources.workspace import staged

DEPTH = 5
SPLIT = 3
FOLDS, HELD_OUT = 5, 1
BUNDLE_BYTES = 48_000_000
CHUNK_BYTES = 1_000_000
CHUNK_ROWS = 250_000
END = 255  # no byte of UTF-8: the end of a text and what stands before its start
STRINGS, WORDS = 0, 1


def canonical(text):
    """Lower-case A-Z, words with single spaces."""
    return b" ".join(text.lower().split())


def byte_strings(texts, depth=DEPTH):
    """(keys, starts): for every byte of every canonical text and its end, that byte behind its context.

    The context stands in the higher bytes, the most recent byte lowest; starts has the first key of each text.
    """
    pad = bytes([END]) * depth
    joined = np.frombuffer(b"".join([part for t in texts for part in (pad, t, b"\xff")]), np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    keys = joined.astype(np.uint64)
    for j in range(1, depth + 1):
        keys[j:] |= joined[:-j].astype(np.uint64) << np.uint64(8 * j)
    real = np.ones(len(joined), bool)
    begins = np.cumsum(lengths + depth) - lengths - depth
    for j in range(depth):
        real[begins + j] = False
    return keys[real], np.cumsum(lengths) - lengths


def _merge(found):
    """Sums of sorted (keys, counts) pieces, without arrays of the length of all pieces but one."""
    unique = np.unique(np.concatenate([k for k, _ in found])) if found else np.zeros(0, np.uint64)
    counts = np.zeros(len(unique), np.int64)
    for k, c in found:
        counts[np.searchsorted(unique, k)] += c
    return unique, counts


def _give_back():
    """Return freed memory to the system: workers live on, and what they hold counts against the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _chunks(values, flags=None):
    """Lists of canonical texts of about CHUNK_BYTES, with their positions and their common flag."""
    held = {}
    for i, value in enumerate(values):
        flag = flags[i].as_py() if flags is not None else None
        texts, at, size = held.get(flag, ([], [], 0))
        text = canonical(value.as_py())
        texts.append(text)
        at.append(i)
        held[flag] = texts, at, size + len(text) + DEPTH + 1
        if held[flag][2] >= CHUNK_BYTES:
            yield *held.pop(flag)[:2], flag
    for flag, (texts, at, _) in held.items():
        yield texts, at, flag


def _word_keys(words):
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


COUNTS = "bundle int, kind int, key long, n long"


def _count(table):
    """COUNTS rows of one bundle: every string and word in it, n of them in training texts."""
    strings, words, other = [], Counter(), set()
    for texts, _, learns in _chunks(table.column("text"), table.column("learns")):
        unique, counts = np.unique(byte_strings(texts)[0], return_counts=True)
        strings.append((unique, counts if learns else np.zeros(len(unique), np.int64)))
        if len(strings) > 6:
            strings = [_merge(strings)]
        for text in texts:
            words.update(text.split()) if learns else other.update(text.split())
    keys, counts = _merge(strings)
    other.difference_update(words)
    listed = [*words, *other]
    many = np.array([*words.values(), *([0] * len(other))], np.int64)
    n = len(keys) + len(listed)
    del strings, words, other
    _give_back()
    return pa.table(
        {
            "bundle": pa.array(np.full(n, table.column("bundle")[0].as_py(), np.int32)),
            "kind": pa.array(np.repeat(np.array([STRINGS, WORDS], np.int32), [len(keys), len(listed)])),
            "key": pa.array(np.concatenate([keys, _word_keys(listed)]).view(np.int64)),
            "n": pa.array(np.concatenate([counts, many])),
        }
    )


# --- the trees ------------------------------------------------------------------------------------


def _log_gamma(x):
    """Of half and whole numbers above 0: Stirling's series from 8 on, recurrence below."""
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] -= np.log(y[low])
        y[low] += 1
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)


def _estimate(n0, n1):
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


class Level:
    """Nodes of one depth: their numbers, and the node of every row."""

    def __init__(self, nodes, weight0, weight1):
        self.nodes, self.of = np.unique(nodes, return_inverse=True)
        self.n0 = np.bincount(self.of, weight0, len(self.nodes))
        self.n1 = np.bincount(self.of, weight1, len(self.nodes))
        self.seen = self.n0 + self.n1 > 0
        self.one = (self.n1 + 0.5) / (self.n0 + self.n1 + 1)
        self.own = _estimate(self.n0, self.n1)

    def weigh(self, below=None, below_weighted=None):
        """Sets weighted (log) and stop, the share of the node's own estimate; below_weighted comes by row if below is None."""
        if below_weighted is None:
            self.weighted, self.stop = self.own, np.ones(len(self.nodes))
            return self
        if below is None:
            children = np.bincount(self.of, below_weighted, len(self.nodes))
        else:
            parent = np.zeros(len(below.nodes), np.int64)
            parent[below.of] = self.of
            children = np.bincount(parent, below_weighted, len(self.nodes))
        self.weighted = np.logaddexp(self.own, children) - math.log(2)
        self.stop = np.exp(self.own - math.log(2) - self.weighted)
        return self


def _nodes(context, prefix, depth):
    mask = np.uint64((1 << 8 * depth) - 1)
    return ((context & mask) << np.uint64(8)) | prefix


def _deep(keys, n, bit):
    """Levels SPLIT..DEPTH of the decision `bit` of whole parts, weighed from below."""
    symbol, context = keys & np.uint64(255), keys >> np.uint64(8)
    prefix = (np.uint64(1) << np.uint64(bit)) | (symbol >> np.uint64(8 - bit))
    one = ((symbol >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.float64)
    levels = [Level(_nodes(context, prefix, d), n * (1 - one), n * one) for d in range(SPLIT, DEPTH + 1)]
    below = levels[-1].weigh()
    for level in reversed(levels[:-1]):
        below = level.weigh(below, below.weighted)
    return levels, one


NODES = "context long, prefix int, n0 double, n1 double, weighted double"


def _node_batch(level, names):
    columns = [
        pa.array((level.nodes >> np.uint64(8)).astype(np.int64)),
        pa.array((level.nodes & np.uint64(255)).astype(np.int32)),
        pa.array(level.n0),
        pa.array(level.n1),
        pa.array(level.weighted),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _parts(batches):
    """Whole parts of the sorted rows of a task as columns, about CHUNK_ROWS rows at a time."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        suffix = table.column(0).to_numpy()
        cut = int(np.searchsorted(suffix, suffix[-1], side="left"))
        if cut:
            yield table.slice(0, cut)
        held, rows = table.slice(cut).to_batches(), len(suffix) - cut
    if rows:
        yield pa.Table.from_batches(held)


def _column(table, name):
    return table.column(name).to_numpy()


def _bottom(batches):
    names = ["context", "prefix", "n0", "n1", "weighted"]
    for table in _parts(batches):
        keys, n = _column(table, "key").view(np.uint64), _column(table, "n").astype(np.float64)
        for bit in range(8):
            yield _node_batch(_deep(keys, n, bit)[0][0], names)


def _middle(table):
    """Levels 1 and 2 over the nodes of level SPLIT with one last byte (rows of NODES)."""
    context, prefix = _column(table, "context").astype(np.uint64), _column(table, "prefix").astype(np.uint64)
    n0, n1 = _column(table, "n0"), _column(table, "n1")
    levels = [Level(_nodes(context, prefix, d), n0, n1) for d in range(1, SPLIT)]
    below, weighted = None, _column(table, "weighted")
    for level in reversed(levels):
        level.weigh(below, weighted)
        below, weighted = level, level.weighted
    return levels, n0 + n1 > 0


class Root:
    """The empty context, one node per prefix: the estimate of a one and the share of its own estimate."""

    def __init__(self, rows):
        prefix = np.array([r["prefix"] for r in rows], np.uint64)
        sums = [np.array([r[c] for r in rows], np.float64) for c in ("n0", "n1", "weighted")]
        level = Level(prefix, sums[0], sums[1]).weigh(None, sums[2])
        self.one, self.stop = np.full(256, 0.5), np.ones(256)
        at = level.nodes.astype(np.int64)
        self.one[at], self.stop[at] = level.one, level.stop


def _descend(mixed, left, one, stop, deeper):
    """One step down: adds a level's share to the mixture; all that is left where nothing deeper was seen."""
    share = left * np.where(deeper, stop, 1.0)
    return mixed + share * one, left - share


def _from_above(table, root):
    levels, seen = _middle(table)
    prefix = _column(table, "prefix").astype(np.int64)
    path = [(root.one[prefix], root.stop[prefix], levels[0].seen[levels[0].of])]
    for i, level in enumerate(levels):
        deeper = levels[i + 1].seen[levels[i + 1].of] if i + 1 < len(levels) else seen
        path.append((level.one[level.of], level.stop[level.of], deeper))
    mixed, left = np.zeros(len(prefix)), np.ones(len(prefix))
    for one, stop, deeper in path:
        mixed, left = _descend(mixed, left, one, stop, deeper)
    return pa.table({"context": table.column("context"), "prefix": table.column("prefix"), "mixed": mixed, "left": left})


def _probabilities(batches):
    """key, value: log10 of the probability of a string's last byte. Rows: part, key, n of strings; part, prefix, mixed, left of nodes."""
    for table in _parts(batches):
        strings = _column(table, "kind") == 0
        keys = _column(table, "key")[strings].view(np.uint64)
        n = _column(table, "n")[strings].astype(np.float64)
        nodes = (_column(table, "part")[~strings].astype(np.uint64) << np.uint64(8)) | _column(table, "key")[~strings].view(np.uint64)
        order = np.argsort(nodes)
        nodes, above, rest = nodes[order], _column(table, "mixed")[~strings][order], _column(table, "left")[~strings][order]
        total = np.zeros(len(keys))
        for bit in range(8):
            levels, one = _deep(keys, n, bit)
            at = np.searchsorted(nodes, levels[0].nodes)[levels[0].of]
            mixed, left = above[at], rest[at]
            for i, level in enumerate(levels):
                deeper = levels[i + 1].seen[levels[i + 1].of] if i + 1 < len(levels) else np.zeros(len(keys), bool)
                mixed, left = _descend(mixed, left, level.one[level.of], level.stop[level.of], deeper)
            total += np.log10(np.where(one == 1, mixed, 1 - mixed))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(total)], names=["key", "value"])
    _give_back()


def string_probabilities(strings, checkpoint=staged):
    """key, value for rows of distinct (key, n): log10 of the probability of the last byte after the others."""
    part = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * SPLIT) - 1)).alias("part")
    leaves = strings.select(part, "key", "n")
    nodes = leaves.repartition("part").sortWithinPartitions("part").mapInArrow(_bottom, NODES)
    nodes = checkpoint(nodes, "nodes")
    last = nodes.withColumn("last", F.col("context").bitwiseAND(F.lit(255)).cast("int"))

    def upper(table):
        level = _middle(table)[0][0]
        return pa.Table.from_batches([_node_batch(level, ["context", "prefix", "n0", "n1", "weighted"])])

    root = Root(last.groupBy("last").applyInArrow(upper, NODES).collect())  # 256 x 255 rows at most
    above = last.groupBy("last").applyInArrow(
        lambda table: _from_above(table, root), "context long, prefix int, mixed double, left double"
    )
    zero = F.lit(0.0)
    rows = leaves.select("part", F.lit(0).alias("kind"), "key", "n", zero.alias("mixed"), zero.alias("left")).unionByName(
        above.select(
            F.col("context").alias("part"), F.lit(1).alias("kind"), F.col("prefix").cast("long").alias("key"),
            F.lit(0).cast("long").alias("n"), "mixed", "left",
        )
    )
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(_probabilities, "key long, value double")


# --- scoring --------------------------------------------------------------------------------------


class Lookup:
    """Open-addressing table over unsigned keys: about as fast as memory allows, and no sorting of queries."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys, values):
        self.bits = max(4, int(1.5 * len(keys) + 1).bit_length())
        self.slots, self.values = np.full(1 << self.bits, self.EMPTY), np.zeros(1 << self.bits, values.dtype)
        rows, at = np.arange(len(keys)), self._slot(keys)
        while len(rows):
            free = rows[self.slots[at[rows]] == self.EMPTY]
            self.slots[at[free]] = keys[free]
            placed = self.slots[at[rows]] == keys[rows]
            self.values[at[rows[placed]]] = values[rows[placed]]
            rows = rows[~placed]
            at[rows] = (at[rows] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, keys):
        """Values of keys that are all in the table."""
        at = self._slot(keys)
        wrong = np.flatnonzero(self.slots[at] != keys)
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[self.slots[at[wrong]] != keys[wrong]]
        return self.values[at]


def _score(docs, known, train_tokens, vocabulary, train_documents, names):
    kinds = _column(known, "kind")
    keys, values = _column(known, "key").view(np.uint64), _column(known, "value")
    strings = Lookup(keys[kinds == STRINGS], values[kinds == STRINGS])
    word_keys, word_counts = keys[kinds == WORDS], values[kinds == WORDS]
    order = np.argsort(word_keys)
    word_keys, word_counts = word_keys[order], word_counts[order]
    size = train_tokens + 0.5 * (vocabulary + 1)
    end = math.log10((train_documents + 0.5) / size)
    n = docs.num_rows
    tokens, known_tokens, length = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    base, score, counts = np.zeros(n), np.zeros(n), {}
    del kinds, keys, values, order
    for texts, at, _ in _chunks(docs.column("text")):
        found, starts = byte_strings(texts)
        score[at] = np.add.reduceat(strings[found], starts)
        length[at] = np.diff(np.append(starts, len(found)))
        split = [t.split() for t in texts]
        new = list(set().union(*split).difference(counts))
        if new:
            counts.update(zip(new, word_counts[np.searchsorted(word_keys, _word_keys(new))].tolist(), strict=True))
        for i, words in zip(at, split, strict=True):
            c = np.fromiter(map(counts.__getitem__, words), np.float64, len(words))
            tokens[i] = len(words) + 1
            known_tokens[i] = np.count_nonzero(c) + (train_documents > 0)
            base[i] = np.log10((c + 0.5) / size).sum() + end
    del strings, counts, word_keys, word_counts
    _give_back()
    columns = [docs.column(c) for c in docs.column_names if c not in ("bundle", "text", "learns")]
    return pa.table(
        [*columns, pa.array(tokens), pa.array(known_tokens), pa.array(np.full(n, train_tokens, np.int64)), pa.array(base),
         pa.array(score), pa.array(-score / math.log10(2) / length)],
        names=names,
    )


def score(docs, text="text", folds=FOLDS, held_out=HELD_OUT, bundle_bytes=BUNDLE_BYTES, checkpoint=staged):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of docs.

    Learns from documents whose id's remainder is not held_out; a document without an id is scored only, and not
    held out. Null and empty texts are the end mark alone. Repeated rows are each learnt from and scored. With
    nothing to learn from every bit has probability 1/2. An empty table gives an empty one.
    """
    fold = remainder("doc_id", folds)
    value = text_or_empty(text)
    totals = docs.agg(
        F.sum(F.octet_length(value)).alias("bytes"), F.sum((fold != held_out).cast("long")).alias("documents")
    ).first()
    bundles = max(1, math.ceil((totals["bytes"] or 0) / bundle_bytes))
    train_documents = totals["documents"] or 0
    rows = docs.select(
        "doc_id",
        F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
        F.coalesce(fold != held_out, F.lit(False)).alias("learns"),
        value.cast("binary").alias("text"),
        F.pmod(F.xxhash64("doc_id", value), F.lit(bundles)).cast("int").alias("bundle"),
    )
    counts = checkpoint(rows.groupBy("bundle").applyInArrow(_count, COUNTS), "counts")
    sums = checkpoint(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "sums")
    words = sums.filter(F.col("kind") == WORDS)
    learnt = words.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    train_tokens = (learnt["n"] or 0) + train_documents
    vocabulary = (learnt["v"] or 0) + (train_documents > 0)
    values = string_probabilities(sums.filter(F.col("kind") == STRINGS).select("key", "n"), checkpoint)
    values = values.select(F.lit(STRINGS).alias("kind"), "key", "value").unionByName(
        words.select("kind", "key", F.col("n").cast("double").alias("value"))
    )
    slices = counts.select("bundle", "kind", "key").join(values, ["kind", "key"])
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    schema = rows.select(
        "doc_id", "held_out", *[F.lit(0).cast("long").alias(c) for c in names[2:5]], *[F.lit(0.0).alias(c) for c in names[5:]]
    ).schema

    def scored(mine, known):
        return _score(mine, known, train_tokens, vocabulary, train_documents, names)

    return rows.groupBy("bundle").cogroup(slices.groupBy("bundle")).applyInArrow(scored, schema)
