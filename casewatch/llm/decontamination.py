"""Benchmark decontamination by templates (DataFrame functions only).

A text becomes its template: numbers, names and units turn into placeholders, the rest into lower-case
words without punctuation. Windows of template words of documents and benchmark items meet in a hash
join. Windows of one document and item on one diagonal (same shift between the places), or on the diagonals
of a band, form an alignment: a word put in or left out moves the rest to a neighbouring diagonal. A value of
several words is one template word. An item counts as found if an alignment covers enough of its windows and
the slots inside them are consistent: what stands in one slot value's places in the item is one value in the
document too, so a question with changed numbers is caught, while a text that merely has the same frame is
not. Places outside the matched windows are not looked at.

The benchmark is the small side of the join; Spark broadcasts it if its size allows and shuffles
window digests otherwise. Documents' texts are not shuffled.
"""

from pyspark.sql import functions as F

from casewatch.llm.common import SPACE_CLASS, aside, row_key, text_or_empty
from casewatch.sources.workspace import staged

WINDOW = 8
COVERED = 0.6  # share of an item's windows that one alignment must hold
BAND = 4  # diagonals so far apart always share a band
PIECE = 2_048  # words of a document that meet its alignments at once
JOINER = "\u2060"  # between the words of one value
NUMBER, NAME, UNIT = "ⓝ", "ⓐ", "ⓤ"
# Fixed list of units that follow a number.
UNITS = (
    "kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "ft", "in", "mi", "l", "ml", "s", "sec", "min", "h", "hr",
    "hrs", "days", "day", "hours", "hour", "minutes", "minute", "seconds", "second", "weeks", "week", "years", "year",
    "miles", "mile", "meters", "metres", "meter", "metre", "kilometers", "kilometres", "pounds", "dollars", "euros",
    "cents", "percent", "mph", "kmh", "degrees", "liters", "litres", "gallons", "inches", "feet",
)

# A name starts upper-case and goes on lower-case, behind a word that ends no sentence. Expressions look ahead for
# what few places hold before they look back: looking back at every place of a text costs thrice the time.
_NAME = rf"(?=\p{{Lu}})(?<=[\p{{L}}\p{{N}},;)] |{JOINER})\p{{Lu}}\p{{Ll}}++(?!\p{{L}})"
_FURTHER_NAME = r"(?=\p{Lu})(?<=[\p{L}\p{N},;)] )(\p{Lu}\p{Ll}++) (?=\p{Lu}\p{Ll}++(?!\p{L}))"
_FURTHER_NUMBER = r"(?<=\p{N}) (?=\p{N})"
_NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*+"
_UNIT = rf"(?<={NUMBER})( ?)(?:{'|'.join(UNITS)})(?=$|[^\p{{L}}])"
_CLOSE_UNIT = rf"(?<=\p{{N}})(?=(?:{'|'.join(UNITS)})(?:$|[^\p{{L}}]))"
_RUN = rf"([{NUMBER}{NAME}])\1+"
_WORDLESS = r"(?=[^\p{L}\p{N} ])(?<=^| )[^\p{L}\p{N} ]++(?: |$)"
# white space but single blanks, by far the most of it: those are left where they are
_SPACE = rf"{SPACE_CLASS[:-1]}(?:(?<! ){SPACE_CLASS[:-1]}*+|{SPACE_CLASS}+)"
_REST = rf"[^\p{{L}}{NUMBER}{NAME}{UNIT}\x20]++"


def _plain(text):
    """Single spaces; words without a letter or digit go, so that template and text have the same words.

    Units stand apart from their number, and numbers or names that follow each other are one word.
    """
    plain = F.trim(F.regexp_replace(F.regexp_replace(text, _SPACE, " "), _WORDLESS, ""))
    named = F.regexp_replace(plain, _FURTHER_NAME, f"$1{JOINER}")
    return F.regexp_replace(F.regexp_replace(named, _FURTHER_NUMBER, JOINER), _CLOSE_UNIT, " ")


def _split(text):
    return F.filter(F.split(text, " "), lambda w: w != "")


def template(plain):
    """Template words of a _plain text, one for each of its words."""
    named = F.regexp_replace(plain, _NAME, NAME)
    numbered = F.regexp_replace(named, _NUMBER, NUMBER)
    measured = F.regexp_replace(numbered, _UNIT, f"$1{UNIT}")
    return _split(F.lower(F.regexp_replace(F.regexp_replace(measured, _REST, ""), _RUN, "$1")))


def _once(value, use):
    """use(value), with value worked out once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digests(words, size):
    """One digest for every window of `size` words: two digests of half the size make one, an odd word is added."""

    def joined(first, second):  # second is never the longer one
        return F.slice(F.zip_with(first, second, lambda a, b: F.xxhash64(a, b)), 1, F.size(second))

    if size == 1:
        return F.transform(words, lambda w: F.xxhash64(w))
    if size % 2 == 0:
        half = size // 2
        return _once(digests(words, half), lambda h: joined(h, F.slice(h, half + 1, F.greatest(F.size(h) - half, F.lit(0)))))
    last = F.slice(words, size, F.greatest(F.size(words) - size + 1, F.lit(0)))
    return joined(digests(words, size - 1), last)


def _windows(words, sizes):
    """size, place and digest of the windows of all the sizes, as one array."""

    def of(size):
        window = lambda d, i: F.struct(F.lit(size).alias("of"), i.alias("place"), d.alias("digest"))
        return F.transform(digests(words, size), window)

    return F.flatten(F.array(*[of(size) for size in sizes]))


def item_windows(benchmark, window=WINDOW, text="text"):
    """item_id, size, at, digest, windows: every window of every item. Shorter items are one window of their length."""
    words = template(_plain(text_or_empty(text)))
    rows = benchmark.filter(F.col("item_id").isNotNull()).select("item_id", words.alias("words")).filter(F.size("words") > 0)
    sized = rows.withColumn("size", F.least(F.size("words"), F.lit(window)))
    found = F.coalesce(*[F.when(F.col("size") == n, digests(F.col("words"), n)) for n in range(1, window + 1)])
    return sized.select("item_id", "size", F.size(found).alias("windows"), F.posexplode(found).alias("at", "digest")).distinct()


def matches(docs, benchmark, window=WINDOW, text="text"):
    """key, doc_id, item_id, windows, size, shift, hit, parts: windows of an item found in a document, by alignment.

    An alignment is one diagonal or a band of them. parts: its diagonals (negative number of windows, shift, and
    the places in the item where they begin), that with most windows first; shift is that of the first.
    """
    items = item_windows(benchmark, window, text)
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most `window` numbers
    words = docs.select(
        row_key("doc_id", text).alias("key"), "doc_id", template(_plain(text_or_empty(text))).alias("words")
    )
    rows = words.select("key", "doc_id", F.inline(_windows(F.col("words"), sorted(sizes) or [window])))
    wanted = items.select(F.col("digest").alias("_digest"), "item_id", "at", "windows", "size")
    found = rows.join(wanted, (F.col("digest") == F.col("_digest")) & (F.col("of") == F.col("size")))
    # rows that repeat a document count once
    of = ("key", "doc_id", "item_id", "windows", "size")
    diagonals = found.groupBy(*of, (F.col("place") - F.col("at")).alias("shift")).agg(F.collect_set("at").alias("places"))
    band = F.floor(F.col("shift") / BAND).cast("int")
    bands = [(True, band), (True, band - 1), (False, F.col("shift"))]  # two bands, and the diagonal alone
    kinds = F.array(*[F.struct(F.lit(w).alias("wide"), b.alias("band")) for w, b in bands])
    part = F.struct((-F.size("places")).alias("less"), "shift", "places")
    grouped = diagonals.select(*of, part.alias("part"), F.explode(kinds).alias("kind")).groupBy(*of, "kind")
    held = grouped.agg(F.array_sort(F.collect_list("part")).alias("parts"))  # at most 2 * BAND
    hit = F.size(F.array_distinct(F.flatten(F.transform("parts", lambda p: p["places"]))))
    return held.select(*of, F.get("parts", F.lit(0))["shift"].alias("shift"), hit.alias("hit"), "parts").distinct()


def consistent(pairs):
    """Whether every item value of an array of (item, doc) slot values goes with one document value."""
    different = F.array_distinct(F.transform(pairs, lambda p: F.struct(p["item"].alias("item"), p["doc"].alias("doc"))))
    return F.size(different) == F.size(F.array_distinct(F.transform(different, lambda p: p["item"])))


def leaks(docs, benchmark, window=WINDOW, covered=COVERED, text="text", checkpoint=staged):
    """doc_id, item_id, hit, windows, shift, changed: items found in documents, by their best alignment.

    changed counts the slots whose values differ from the item's. Several alignments may pass; the one with
    most windows, then the first, is told. Null and empty texts contain nothing; items without words are
    never found; an empty table on either side gives an empty result.
    """
    near = matches(docs, benchmark, window, text).filter(F.col("hit") >= F.greatest(F.col("windows") * covered, F.lit(1)))
    near = checkpoint(near, "alignments")
    asked = near.select("key", "doc_id").distinct().withColumnsRenamed({"key": "_key", "doc_id": "_id"})
    both = docs.select(row_key("doc_id", text).alias("_row"), "doc_id", text_or_empty(text).alias("_text")).join(
        asked, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"
    )
    document = both.select("_row", F.col("doc_id").alias("_id"), "_text").distinct()
    document = document.select("_row", "_id", _split(_plain(F.col("_text"))).alias("_words"))
    # pieces overlap by as many words as the longest alignment spans, so each lies in the piece it begins in
    reach = near.agg(F.max(F.col("windows") + F.col("size")).alias("reach")).first()["reach"] or 0
    begins = F.explode(F.sequence(F.lit(0), F.floor(F.size("_words") / PIECE))).alias("_piece")
    pieces = document.select("_row", "_id", "_words", begins).select(
        "_row", "_id", "_piece", F.slice("_words", (F.col("_piece") * PIECE + 1).cast("int"), PIECE + reach + 2 * BAND).alias("_words")
    )
    def value(word):
        return F.lower(F.regexp_replace(word, r"[^\p{L}\p{N}.,]|[.,]+$", ""))

    plain = _plain(text_or_empty(text))
    item = benchmark.filter(F.col("item_id").isNotNull()).select(
        F.col("item_id").alias("_item"), _split(plain).alias("item_words"), template(plain).alias("item_template")
    )
    item = item.groupBy("_item").agg(*[F.min(c).alias(c) for c in ("item_words", "item_template")])
    # places of an item's placeholders and what stands there, told once per item
    places = F.filter(
        F.transform(
            "item_template",
            lambda t, i: F.struct(i.alias("i"), (F.translate(t, NUMBER + NAME + UNIT, "") != t).alias("slot"), F.get("item_words", i).alias("word")),
        ),
        lambda s: s["slot"],
    )
    known = F.transform(
        places,
        lambda s: F.struct(
            s["i"].alias("i"), value(s["word"]).alias("item"), ((s["i"] == 0) | (s["i"] == F.size("item_template") - 1)).alias("end")
        ),
    )
    item = checkpoint(item.select("_item", known.alias("known")), "items")

    # of the document's words those beside the item, right behind the join: long texts never travel with alignments
    first = F.greatest(F.array_min(F.transform("parts", lambda p: p["shift"])), F.lit(0))
    last = F.array_max(F.transform("parts", lambda p: p["shift"])) + F.col("windows") + F.col("size") - 1
    told = near.withColumn("first", first).withColumn("length", F.greatest(last - F.col("first"), F.lit(0)))
    told = told.withColumn("piece", F.floor(F.col("first") / PIECE))
    beside = told.join(
        pieces, (F.col("key") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("piece") == F.col("_piece"))
    ).select(
        "key", "doc_id", "item_id", "windows", "size", "hit", "shift",
        F.transform("parts", lambda p: F.struct(p["less"], (p["shift"] - F.col("first")).alias("shift"), p["places"])).alias("parts"),
        F.slice("_words", (F.col("first") - F.col("piece") * PIECE + 1).cast("int"), F.col("length")).alias("doc_words"),
    )
    # a text that repeats itself has many alignments that look alike: the first stands for all
    alike = beside.groupBy("key", "doc_id", "item_id", "windows", "size", "hit", "parts", "doc_words").agg(F.min("shift").alias("shift"))
    joined = alike.join(item, F.col("item_id") == F.col("_item"))

    def shift_of(i):
        """The shift of the first diagonal with a matched window over the item's word i, else null."""
        over = F.filter("parts", lambda p: F.exists(p["places"], lambda at: (at <= i) & (i < at + F.col("size"))))
        return F.get(over, F.lit(0))["shift"]

    placed = joined.withColumn(
        "read", F.transform("known", lambda s: F.struct(s["i"], s["item"], s["end"], F.get("doc_words", s["i"] + shift_of(s["i"])).alias("word")))
    )
    slots = F.filter(
        F.transform(
            "read",
            lambda s: F.struct(
                s["item"].alias("item"),
                value(s["word"]).alias("doc"),
                # at the item's ends a value may have grown together with words around the item
                (s["word"].contains(JOINER) & s["end"]).alias("grown"),
            ),
        ),
        lambda s: s["doc"].isNotNull() & ~s["grown"],
    )
    checked = placed.withColumn("slots", slots).filter(consistent(F.col("slots")))
    changed = F.size(F.filter("slots", lambda s: s["item"] != s["doc"]))
    best = checked.groupBy("key", "doc_id", "item_id", "windows").agg(
        F.max(F.struct("hit", (-F.col("shift")).alias("back"), changed.alias("changed"))).alias("best")
    )
    return best.select(
        "doc_id", "item_id", "best.hit", "windows", (-F.col("best.back")).alias("shift"), "best.changed", "key"
    )


def clean(docs, benchmark, text="text", **options):
    """The rows of docs in which no benchmark item is found, unchanged, whatever their columns are called.

    Rows that repeat stay or go together. Null and empty texts stay; so does everything if there are no items.
    """
    found = leaks(docs, benchmark, text=text, **options).select(F.col("key").alias("_key"), F.col("doc_id").alias("_id")).distinct()
    own = aside(docs, "doc_id", row_key("doc_id", text).alias("_row"))
    same = (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return own.join(found, same, "left_anti").select("_rest.*")
