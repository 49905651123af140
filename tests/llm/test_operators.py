"""The corpus operators on small tables: brute force, round trips, and awkward rows."""

import gzip
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from casewatch.llm import (
    boosted_trees,
    context_tree,
    decontamination,
    interleaving,
    line_frequency,
    periodic_runs,
    personal_data,
    quality_classifier,
    queries,
    simhash_dedup,
    source_mixing,
    substring_dedup,
    toxicity,
    warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "long words make " * 40_000
# extra columns carry names that the operators use inside
EXTRA = "score string, key string, n string, label string, start string, bundle string, kind string, digest string, fp string, _words string"
CLASHES = "_id", "_rows", "_key", "_row", "_cuts", "_drop", "_rest", "removed", "item_id", "hit", "component_id", "at", "text_"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t) if t else 0) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [
        (1, "Call +1 (269) 555-3296 now. The quick brown fox jumps over the lazy dog again and again today.", "a"),
        (1, "Call +1 (269) 555-3296 now. The quick brown fox jumps over the lazy dog again and again today.", "a"),
        (2, None, "a"),
        (3, "", None),
        (4, " \t\n\x0b\f\r ", "b"),
        (None, "no id but text with words enough to be a document of its own kind here", "b"),
        (5, LONG, "c"),
        (6, "İstanbul ß ﬁ 😀 \u0000 zero space word", "c"),
        (7, None, None),
    ]
    out = docs(spark, rows)
    for field in EXTRA.split(", "):
        out = out.withColumn(field.split()[0], F.lit("clash"))
    return out


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.limit(0)


def labels(spark, column="quality"):
    return spark.createDataFrame([(1, 1, 0), (None, 1, 0), (4, None, None), (1, 0, 1)], "doc_id long, quality int, toxic int")


def bench(spark, rows=((1, "no id but text with words enough to be a document"), (2, None), (None, "x"), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "context_tree": lambda s, d: context_tree.score(d),
    "line_frequency": lambda s, d: line_frequency.judged(d),
    "without_lines": lambda s, d: line_frequency.without_frequent_lines(d),
    "classify": lambda s, d: quality_classifier.classify(d, labels(s)),
    "keep_good": lambda s, d: quality_classifier.keep_good(d, labels(s), threshold=0.0),
    "clean": lambda s, d: decontamination.clean(d, bench(s)).unionByName(decontamination.clean(d, bench(s)).limit(0)),
    "mix": lambda s, d: source_mixing.mix(d),
    "personal": lambda s, d: personal_data.report(d),
    "redacted": lambda s, d: personal_data.redacted(d),
    "toxicity": lambda s, d: toxicity.classify(d, toxicity.learn(d, labels(s))),
    "simhash": lambda s, d: simhash_dedup.near_duplicates(d),
    "periodic_runs": lambda s, d: periodic_runs.runs_of(d),
    "periodic_report": lambda s, d: periodic_runs.report(d),
    "sharded": lambda s, d: interleaving.sharded(d),
    "assigned": lambda s, d: interleaving.assigned(d),
    "substring": lambda s, d: substring_dedup.deduplicated(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows_each_get_a_row(spark, awkward, name):
    """Nulls, empty and long texts, repeated rows, clashing columns: one row out for each row in."""
    lost = 1 if name == "clean" else 0  # the leaked one
    assert OPERATORS[name](spark, awkward).count() == awkward.count() - lost


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(spark, nothing, name):
    assert OPERATORS[name](spark, nothing).count() == 0


def test_keep_first_of_awkward_rows(spark, awkward):
    kept = [r["doc_id"] for r in simhash_dedup.keep_first(awkward).select("doc_id").collect()]
    assert sorted(kept, key=str) == [1, 2, 5, 6, None]  # empty texts are one group


@pytest.mark.parametrize("name", ["keep_first", "clean", "redacted", "without_lines", "substring"])
def test_names_used_inside_do_not_clash(spark, name):
    """Rows come back whole whatever their columns are called."""
    texts = {1: ITEM, 2: "mail me at joe.doe@example.org or not, as you like it best of all my friends", 3: None, 4: "plain words " * 9}
    plain = docs(spark, [(i, t, "s") for i, t in texts.items()])
    wide = plain
    for clash in CLASHES:
        wide = wide.withColumn(clash, F.concat(F.lit("own "), F.col("doc_id").cast("string")))
    run = {
        "keep_first": simhash_dedup.keep_first,
        "clean": lambda d: decontamination.clean(d, bench(spark, [(7, ITEM)])),
        "redacted": personal_data.redacted,
        "without_lines": line_frequency.without_frequent_lines,
        "substring": substring_dedup.deduplicated,
    }[name]
    want = {r["doc_id"]: r["text"] for r in run(plain).collect()}
    got = run(wide)
    assert got.columns[: len(plain.columns)] == plain.columns
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {i: r["text"] for i, r in rows.items()} == want and len(want) == (3 if name == "clean" else 4)
    own = [c for c in CLASHES if not (name == "substring" and c == "removed")]
    assert all(r[c] == f"own {i}" for i, r in rows.items() for c in own)


@pytest.mark.parametrize("n", [2_000, 80_000])
def test_long_repetitive_texts_are_looked_at_in_full(spark, n):
    item = "alpha beta gamma delta " * 10
    long = "alpha beta gamma delta " * (n // 4)
    other = "alpha beta delta gamma " * (n // 4)
    assert leaked(spark, item, long, "so " + long + " end", other) == [0, 1]


def test_fingerprints_links_and_components(spark):
    words = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(words[: 40 + i % 3] + [f"x{i // 9}"]) for i in range(30)}
    texts |= {100: "", 101: None, 102: "one two", 103: "ONE two"}

    def slow(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    prints = {i: slow(t) for i, t in texts.items()}
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = simhash_dedup.near_duplicates(docs(spark, [(i, t, "s") for i, t in texts.items()]))
    rows = got.select("doc_id", simhash_dedup.hexadecimal().alias("f"), "component_id").collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == {i: (f"{prints[i]:016x}", root(i)) for i in prints}


def test_links_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63, 40)
    found = {int(v) for v in base}
    for v in base:
        for _ in range(6):
            flipped = int(v)
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                flipped ^= 1 << int(bit) if bit < 63 else -(1 << 63)
            found.add(flipped)
    nodes = spark.createDataFrame([(v,) for v in found], "fp long")
    got = [tuple(r) for r in simhash_dedup.links(nodes).collect()]
    mask = 2**64 - 1
    want = {(a, b) for a in found for b in found if a < b and ((a ^ b) & mask).bit_count() <= 2}
    assert len(got) == len(set(got)) and set(got) == want


def test_pipeline_drops_near_copies(spark, folder):
    words = [f"w{i}" for i in range(200)]
    far = [w if i % 25 else "z" for i, w in enumerate(words)]
    rows = [(1, " ".join(words), "s"), (2, "  ".join(words).upper(), "s"), (3, " ".join(far), "s")]
    kept = corpus_pipeline.near_duplicates(spark, docs(spark, rows), folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_components_along_a_chain(spark):
    n = 40
    nodes = spark.createDataFrame([(i, 1000 - i) for i in range(n)], "fp long, doc_id long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1) if i != 19], "src long, dst long")
    got = {r[0]: r[1] for r in simhash_dedup.components(nodes, edges).collect()}
    assert got == {i: 1000 - (19 if i < 20 else n - 1) for i in range(n)}


def tree_probability(train, text, depth):
    """Context-tree weighting by its recursion, one node at a time."""
    counts = Counter()
    for t in train:
        b = bytes([255]) * depth + t + b"\xff"
        for i in range(depth, len(b)):
            for bit in range(8):
                p, one = (1 << bit) | (b[i] >> (8 - bit)), b[i] >> (7 - bit) & 1
                for d in range(depth + 1):
                    counts[b[i - d : i], p, one] += 1
    nodes = {(c, p) for c, p, _ in counts}
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    memo = {}

    def weighted(c, p):
        if (c, p) not in memo:
            own = kt(counts[c, p, 0], counts[c, p, 1])
            if len(c) == depth:
                memo[c, p] = own
            else:
                below = sum(weighted(bytes([x]) + c, p) for x in range(256) if (bytes([x]) + c, p) in nodes)
                memo[c, p] = np.logaddexp(own, below) - math.log(2)
        return memo[c, p]

    total, b = 0.0, bytes([255]) * depth + text + b"\xff"
    for i in range(depth, len(b)):
        for bit in range(8):
            p, one = (1 << bit) | (b[i] >> (8 - bit)), b[i] >> (7 - bit) & 1
            mixed, left = 0.0, 1.0
            for d in range(depth + 1):
                c = b[i - d : i]
                n0, n1 = counts[c, p, 0], counts[c, p, 1]
                stop = 1.0
                if d < depth and (b[i - d - 1 : i], p) in nodes:
                    stop = math.exp(kt(n0, n1) - math.log(2) - weighted(c, p))
                mixed += left * stop * ((n1 if one else n0) + 0.5) / (n0 + n1 + 1)
                left *= 1 - stop
            total += math.log10(mixed)
    return total


def test_context_tree_equals_recursion(spark):
    texts = {i: t for i, t in enumerate(["abra cadabra", "Abra  abra\tcad", "", None, "zebra é", "abracadabra abra", "cad"] * 2)}
    learns = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    train = [context_tree.canonical((t or "").encode()) for i, t in texts.items() if learns(i)]
    tokens = Counter(w for t in train for w in t.split()) + Counter({"end": len(train)})
    n, v = sum(tokens.values()), len(tokens)
    got = {r["doc_id"]: r for r in context_tree.score(docs(spark, [(i, t, "s") for i, t in texts.items()]), bundle_bytes=30).collect()}
    for i, t in texts.items():
        text = context_tree.canonical((t or "").encode())
        assert got[i]["score"] == pytest.approx(tree_probability(train, text, context_tree.DEPTH), abs=1e-6)
        words = [*text.split(), "end"]
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(words), sum(tokens[w] > 0 for w in words))
        assert got[i]["train_tokens"] == n and got[i]["held_out"] == (not learns(i))


def test_context_tree_codes_learnt_texts_better_than_new_ones(spark, folder):
    got = queries.op1_context_tree(spark, folder).groupBy("held_out").agg(F.sum("score") / F.sum("n_tokens")).collect()
    per_token = {r[0]: r[1] for r in got}
    assert per_token[False] > per_token[True] > -8 * 7 * math.log10(2)  # less than a bit for every bit


def test_trees_learn_and_fall_back():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    forest = boosted_trees.fit(x[:2000], y[:2000])
    assert ((boosted_trees.probability(forest, x[2000:]) > 0.5) == (y[2000:] == 1)).mean() > 0.95
    assert boosted_trees.probability(boosted_trees.fit(x, np.ones(3000)), x).min() > 0.999
    assert boosted_trees.probability(boosted_trees.fit(x[:0], y[:0]), x).tolist() == [0.5] * 3000


@pytest.mark.parametrize("name,label", [("op3_quality_classifier", "quality"), ("op7_toxicity", "toxic")])
def test_held_out_accuracy(spark, folder, name, label):
    big = folder.replace("sf0.001", "sf0.01")
    got = queries.QUERIES[name](spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").filter("held_out").collect()
    ones, zeros = ([r["score"] for r in got if r[label] == v] for v in (1, 0))
    better = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    assert better > (0.98 if label == "quality" else 0.85)


def test_templates_and_slots(spark):
    item = "Alice told Bob that Carol has 12 apples and 30 kg of pears, so how many days until 12 apples are eaten?"
    changed = item.replace("12", "17").replace("30", "45").replace("Carol", "Dora")
    broken = item.replace("12 apples and", "17 apples and").replace("30", "12")
    rows = [(1, f"Before it. {item} And after.", "s"), (2, f"Intro words here, {changed}", "s"), (3, broken, "s"), (4, "Nothing of it at all.", "s")]
    got = {r["doc_id"]: r["changed"] for r in decontamination.leaks(docs(spark, rows), bench(spark, [(7, item)])).collect()}
    assert set(got) == {1, 2} and got[1] == 0 and got[2] > 0
    assert [r["doc_id"] for r in decontamination.clean(docs(spark, rows), bench(spark, [(7, item)])).orderBy("doc_id").collect()] == [3, 4]


def leaked(spark, item, *texts):
    found = decontamination.leaks(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), bench(spark, [(7, item)]))
    return sorted(r["doc_id"] for r in found.collect())


ITEM = (
    "the old farmer grows 12 rows of beans behind his red barn and sells 30 bags of them every week at the "
    "market near Dover so we want to know how much money this honest man earns with 12 such rows in the end"
)


def test_slots_outside_the_matched_windows_do_not_count(spark):
    words = ITEM.split()
    part = " ".join(words[:33]) + " and then comes quite another text that has 99 words and not 12 or 30 of them at all"
    late = " ".join(words[:31] + ["really"] + words[31:])
    shifted = " ".join(words[:31] + ["very", "7", "8"] + words[31:])
    assert leaked(spark, ITEM, part, late, shifted, ITEM.replace("12 rows", "13 rows")) == [0, 1, 2]


def test_single_edits_and_longer_values_keep_an_item_found(spark):
    words = ITEM.split()
    middle = len(words) // 2
    put_in, left_out = words[:middle] + ["clearly"] + words[middle:], words[:middle] + words[middle + 1 :]
    longer = ITEM.replace("12", "12 000").replace("Dover", "New Haven")
    item = "a cook needs 5kg of flour and then 3 l of milk for the cakes that he wants to bake for all of us today"
    assert leaked(spark, ITEM, " ".join(put_in), " ".join(left_out), longer, ITEM.replace("12", "x").replace("and", "or")) == [0, 1, 2]
    assert leaked(spark, item, item.replace("5kg", "5 kg").replace("3 l", "3l"), item.replace("5kg", "1 200 kg")) == [0, 1]


def test_leaks_equal_plain_search(spark, folder):
    texts = {r["doc_id"]: " ".join((r["text"] or "").split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r["item_id"]: " ".join(r["text"].split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in texts.items() for i, q in items.items() if f" {q} " in f" {t} "}
    assert want <= {(r["doc_id"], r["item_id"]) for r in queries.op4_decontamination(spark, folder).collect()}


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def test_base_spans_equal_plain_expressions(spark):
    rng = np.random.default_rng(3)
    alphabet = ["a", "b.c", "@", "x@y.z", ".", "1", "25", "256", "4242424242424242", "+1", " ", "-", "(", "é", "\n", "_", "1.2.3.4", "😀"]
    texts = {i: "".join(rng.choice(alphabet, 40)) for i in range(300)}
    texts[300] = "a" * 200_000 + "@" + "b.c" * 20_000 + " " + "1" * 100_000 + "." * 50_000

    def luhn(d):
        return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(d))) % 10 == 0

    def ok(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in value.split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]

    got = {r["doc_id"]: r for r in personal_data.report(docs(spark, [(i, t, "s") for i, t in texts.items()])).collect()}
    for i, t in texts.items():
        if i == 300:
            assert got[i]["n_email"] == 1
            continue
        want = [f"{k}:{m.start()}:{m.end()}" for k, e in BASE for m in re.finditer(e, t) if ok(k, m[0])]
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("context")] == want


def test_contexts_find_unseen_identifiers(spark):
    seeds = [(i, f"Please contact account holder user{i}@mail.com right away", "s") for i in range(6)]
    rows = [*seeds, (50, "Please contact account holder AB-998877 right away", "s"), (51, "The year 1998 was fine", "s")]
    got = {r["doc_id"]: r["spans"] for r in personal_data.report(docs(spark, rows)).collect()}
    assert got[50] == "context:30:39" and got[51] == ""
    clean = {r["doc_id"]: r["text"] for r in personal_data.redacted(docs(spark, rows)).collect()}
    assert clean[50] == "Please contact account holder [CONTEXT] right away" and clean[51] == rows[-1][1]
    assert clean[0] == "Please contact account holder [EMAIL] right away"


def test_mix_reaches_targets(spark, folder):
    rows = queries.op5_source_mixing(spark, folder).collect()
    again = queries.op5_source_mixing(spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    per = {}
    for r in rows:
        per.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(v) - t) <= max(8, 0.01 * t) or len({s for s, _ in per}) < 2 for (_, t), v in per.items())


def test_apportionment_is_by_highest_quotient(spark):
    shares = [53.0, 24.0, 24.0, 7.0, 1.0, 0.0]
    for seats in (0, 1, 5, 10, 11, 99):
        table = spark.createDataFrame([(str(i), s, seats) for i, s in enumerate(shares)], "source string, target double, seats long")
        got = {r["source"]: r["quota"] for r in source_mixing.apportion(table, "seats", "target", ("source",)).collect()}
        won = Counter()
        for _ in range(seats):
            won[max(range(6), key=lambda i: (shares[i] / (2 * won[i] + 1), -i))] += 1
        assert got == {str(i): won[i] for i in range(6)}, seats


def test_warc_members_and_salvage(spark):
    records = [warc.record(i, f"http://x/{i}?q=ü", f"<p>{i}</p>".encode() * 30) for i in range(6)]
    packed = [warc.member(r) for r in records]
    assert all(p[-1] == 0 for p in packed) and gzip.decompress(b"".join(packed)) == b"".join(records)
    data = bytearray(b"".join(packed[:3]) + b"junk" + b"".join(packed[3:]) + records[0] + records[1][:50])
    at = len(packed[0]) + len(packed[1]) // 2
    data[at] ^= 0xFF  # damages the second member
    found = list(warc.salvage(bytes(data)))
    gaps = [(o, n) for o, n, fields, _, _ in found if fields is None]
    good = [fields["warc-record-id"] for _, _, fields, _, _ in found if fields]
    start = sum(map(len, packed[:3]))
    assert gaps == [(len(packed[0]), len(packed[1])), (start, 4), (len(data) - 50, 50)]
    assert good == [f"<urn:page:{i}>" for i in (0, 2, 3, 4, 5, 0)]
    assert sum(n for o, n in {(o, n) for o, n, *_ in found}) == len(data)


def _told(data):
    found = list(warc.salvage(data))
    ids = [int(re.search(r"-?\d+", fields["warc-record-id"])[0]) for _, _, fields, _, _ in found if fields]
    return ids, [(o, n) for o, n, fields, _, _ in found if fields is None]


def test_warc_salvage_inside_a_member():
    noise = np.random.default_rng(5)
    records = [warc.record(i, "u", noise.bytes(40_000)) for i in range(10)]
    last = warc.member(warc.record(99, "u", b"end"))
    bad = bytearray(records[4])
    bad[-100] ^= 0xFF  # the block no longer has its digest; the member's checksum is right
    whole = warc.member(b"".join(records[:4]) + bytes(bad) + b"".join(records[5:]))
    assert _told(whole + last) == ([0, 1, 2, 3, 5, 6, 7, 8, 9, 99], [(0, len(whole))])
    full = warc.member(b"".join(records))
    cut = full[: len(full) // 2]
    ids, gaps = _told(cut)
    assert ids == list(range(len(ids))) and len(ids) >= 4 and gaps == [(0, len(cut))]
    ids, gaps = _told(cut + cut + last)  # two damaged members, then a good one
    assert ids[-1] == 99 and ids.count(0) == 2 and gaps == [(0, len(cut)), (len(cut), len(cut))]
    sums = bytearray(full)
    sums[-6] ^= 0xFF  # a wrong checksum behind right records
    assert _told(bytes(sums) + last) == ([*range(10), 99], [(0, len(sums))])
    assert _told(gzip.compress(b"no archive") + last) == ([99], [(0, len(gzip.compress(b"no archive")))])
    assert _told(gzip.compress(b"") + last) == ([99], []) and _told(b"") == ([], [])


def test_warc_round_trip_of_awkward_pages(spark, tmp_path):
    big = np.random.default_rng(2).bytes(300).hex() * 3
    rows = [(1, "u", big), (2, None, big), (2, "u", big), (None, "u", big), (3, "", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    out = warc.read(spark, warc.write(pages, str(tmp_path / "a"))).collect()
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in out), key=str) == sorted(
        [(1, "response", None, len(big)), (2, "revisit", 1, len(big)), (2, "revisit", 1, len(big)), (None, "revisit", 1, len(big)),
         (3, "response", None, 0), (4, "response", None, 0), (5, "response", None, 5), (6, "response", None, 5)], key=str)
    assert {bytes(r["payload"]) for r in out if r["page_id"] == 1} == {big.encode()}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_repeats_equal_brute_force(spark):
    passage = "This is a passage of more than eight words for sure. Short one. It goes on and on for quite a few words more!"
    rows = [(1, f"Start of one. {passage} End.", "s"), (2, f"Other text, no stop\n{passage}\nshort one.", "s"), (3, f"in the middle {passage}", "s"),
            (4, "All different words stand in this one and nothing is repeated here.", "s")]
    seen, want = {}, set()
    for i, t, _ in rows:
        for start, end, _, digest in substring_dedup.units_of(t):
            if digest in seen:
                want.add((i, start, end, *seen[digest]))
            else:
                seen[digest] = (i, start)
    got = substring_dedup.repeats(docs(spark, rows)).collect()
    assert {(r["doc_id"], r["start"], r["end"], r["first_doc_id"], r["first_start"]) for r in got} == want and len(want) == 5
    left = {r["doc_id"]: r for r in substring_dedup.deduplicated(docs(spark, rows)).collect()}
    assert left[1]["text"] == rows[0][1] and left[4]["text"] == rows[3][1]
    assert left[2]["text"] == "Other text, no stop\n  \nshort one."
    for i, t, _ in rows:
        assert left[i]["text"] == re.sub("\x00", "", "".join("\x00" if any(a <= k < b for a, b in left[i]["removed"]) else c for k, c in enumerate(t)))


def test_passages_inside_longer_sentences_hold_common_units(spark):
    rng = np.random.default_rng(11)

    def some(n):
        return [f"w{k}" for k in rng.integers(0, 10**9, n)]

    rows, passages = [], []
    for i in range(60):
        passage = some(51 + i % 20)
        if i % 3 == 1:
            passage[25] += "."  # the end of one sentence and the start of another
        passages.append(passage)
        for copy in range(2):
            rows.append((2 * i + copy, " ".join(some(rng.integers(0, 40)) + passage + some(rng.integers(0, 40))), "s"))
    rows += [(1000, " ".join(["junk"] * 300), "s"), (1001, " ".join(some(3) + ["junk"] * 100), "s")]
    left = {r["doc_id"]: r["text"] for r in substring_dedup.deduplicated(docs(spark, rows)).collect()}
    for i, passage in enumerate(passages):
        assert left[2 * i] == rows[2 * i][1]
        gone = set(rows[2 * i + 1][1].split()) - set(left[2 * i + 1].split())
        assert gone and gone <= set(passage)
    assert len(left[1001].split()) < 50


def test_boilerplate_counts_distinct_documents(spark):
    line = "Subscribe to our newsletter for more stories like this one today"
    rows = [(i, f"{line}\nshort {i}", "h") for i in range(12)] + [(100 + i, "exact copy " * 6 + "unique", "h") for i in range(40)]
    rows += [(200, f"{line}\n" + " ".join(f"word{k}" for k in range(40)), "h"), (201, f"{line}\nshort 1", "other")]
    got = {r["doc_id"]: r for r in line_frequency.judged(docs(spark, rows)).collect()}
    assert not got[3]["kept"] and got[3]["removed_words"] == 11
    assert got[200]["kept"] and got[201]["kept"]
    left = {r["doc_id"]: r["text"] for r in line_frequency.without_frequent_lines(docs(spark, rows)).collect()}
    assert left[3] == "short 3" and left[201] == rows[-1][1]


def test_items_of_all_lengths_are_found_in_one_pass(spark):
    items = [(n, " ".join(f"v{n}x{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(n))) for n in range(1, 12)]
    rows = [(n, f"before {text} after", "s") for n, text in items] + [(50, "nothing of them", "s"), (51, "", "s"), (52, None, "s")]
    found = decontamination.leaks(docs(spark, rows), bench(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(n, n) for n in range(1, 12)]
    assert decontamination.leaks(docs(spark, rows), bench(spark, [(1, "...")])).count() == 0
