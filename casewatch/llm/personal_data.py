"""Personal data by patterns, and by contexts that the found data teach (DataFrame functions only).

Base kinds are regular expressions with checks. Their matches seed a bootstrap: the words around
them become lexical patterns, and every identifier-like token becomes an instance. Patterns and
instances form a graph, scored in rounds: a pattern is as reliable as the mean of its instances, an
instance as likely as its patterns together say, seeds stay certain. Tokens that a reliable, well
supported pattern points at are spans of kind `context`.

The expressions are written so that a failing start costs no rescan (possessive loops, starts only
where a run begins or the last match ended), as single words of a text may be very long. Positions
come from running sums over the pieces between matches, in one narrow shuffle by document; texts
without a digit or an at sign skip all of it.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from casewatch.llm.common import aside, row_key, text_or_empty
from casewatch.sources.workspace import staged

_WORD = r"[^\x20\x09-\x0D]"
# Fixed expressions of the base kinds, in their order.
EXPRESSIONS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = rf"(?<!{_WORD})[^\x20\x09-\x0D0-9@]*+[0-9@]{_WORD}*+"
KINDS = (*EXPRESSIONS, "context")
CONTEXT = "context"
CONTEXT_CHARACTERS = 80  # around a token, for the two words before it and the one behind it
LEAST_DIGITS = 4  # of an identifier-like token without an at sign
ROUNDS = 3
RELIABLE = 0.7
SUPPORT = 3  # certain instances of a pattern, at least


def _needs(kind):
    text = F.col("text")
    return {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.contains(".")}.get(kind, F.lit(True))


def _found(kind, expression):
    """Matches of a text in order, each with the length of the piece before it and the words around it."""
    hits = F.regexp_extract_all("text", F.lit(expression), F.lit(0))
    gaps = F.split("text", expression, -1)
    return F.when(_needs(kind) & F.col("text").rlike("[0-9@]"), F.struct(hits.alias("hits"), gaps.alias("gaps")))


def _rows(kind):
    """The matches of _found as an array of rows; empty without any."""
    hits, gaps = F.col(f"{kind}.hits"), F.col(f"{kind}.gaps")

    def row(hit, i):
        before = F.concat(F.coalesce(F.get(hits, i - 1), F.lit("")), F.get(gaps, i))
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(F.get(gaps, i)).alias("gap"),
            hit.alias("value"),
            F.right(before, F.lit(CONTEXT_CHARACTERS)).alias("left"),
            F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARACTERS)).alias("right"),
        )

    return F.coalesce(F.transform(hits, row), F.array())


def occurrences(docs, text="text"):
    """key, doc_id, kind, start, end, value, left, right: all matches of the expressions and all tokens, unchecked.

    Offsets count code points. Rows of equal doc_id and text are one.
    """
    step = docs.select(row_key("doc_id", text).alias("key"), "doc_id", text_or_empty(text).alias("text"))
    step = step.filter(F.col("text").rlike("[0-9@]"))
    expressions = {**EXPRESSIONS, CONTEXT: TOKEN}
    step = step.select("key", "doc_id", *[_found(k, e).alias(k) for k, e in expressions.items()])
    rows = step.select("key", "doc_id", F.inline(F.concat(*[_rows(kind) for kind in expressions]))).distinct()
    upto = Window.partitionBy("key", "doc_id", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    return rows.withColumn("end", end.cast("int")).select(
        "key", "doc_id", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "left", "right"
    )


def _luhn(digits):
    return (
        F.aggregate(
            F.transform(
                F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""),
                lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                    d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
                ),
            ),
            F.lit(0),
            lambda total, d: total + d,
        )
        % 10
        == 0
    )


def valid(kind="kind", value="value"):
    """Whether a match of a base kind passes its check; never null."""
    digits = F.regexp_replace(F.col(value), "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(
        F.split(F.col(value), r"\."),
        lambda p: (F.length(F.ltrim(p, F.lit("0"))) < 3)
        | ((F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255")),
    )
    return (
        F.when(F.col(kind) == "email", True)
        .when(F.col(kind) == "ip", small)
        .when(F.col(kind) == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
        .when(F.col(kind) == "phone", n.between(9, 15))
        .otherwise(False)
    )


def trimmed(tokens):
    """Tokens without the marks at their ends, if they look like identifiers."""
    lead = F.length(F.regexp_extract("value", r"^[^A-Za-z0-9@+\x{80}-\x{10FFFF}]*", 0))
    value = F.regexp_replace("value", r"^[^A-Za-z0-9@+\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}]++$", "")
    cut = tokens.withColumn("start", F.col("start") + lead).withColumn("value", value)
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    named = F.col("value").contains("@") & (F.length("value") > 2)
    return cut.withColumn("end", F.col("start") + F.length("value")).filter((digits >= LEAST_DIGITS) | named)


def _outside(base, tokens):
    """Tokens that overlap no base span of their document, by running maxima instead of pairs."""
    both = base.withColumn("seed", F.lit(True)).unionByName(tokens.withColumn("seed", F.lit(False)))
    document = Window.partitionBy("key", "doc_id").orderBy("start", F.desc("seed"), "end", "kind")
    before = document.rowsBetween(Window.unboundedPreceding, -1)
    behind = document.rowsBetween(1, Window.unboundedFollowing)
    near = both.select(
        "*",
        F.max(F.when(F.col("seed"), F.col("end"))).over(before).alias("last_end"),
        F.min(F.when(F.col("seed"), F.col("start"))).over(behind).alias("next_start"),
    )
    free = (F.coalesce("last_end", F.lit(0)) <= F.col("start")) & (F.coalesce("next_start", F.col("end")) >= F.col("end"))
    return near.filter(F.col("seed") | free).drop("last_end", "next_start")


def patterns(rows):
    """One row per occurrence and pattern: the two words before it, the word before, the words on both sides."""
    plain = lambda c: F.regexp_replace(F.lower(F.regexp_replace(c, "[0-9]", "9")), r"[\x20\x09-\x0D]+", " ")
    left = F.filter(F.split(plain("left"), " "), lambda w: w != "")
    right = F.filter(F.split(plain("right"), " "), lambda w: w != "")
    step = rows.withColumn("_left", left).withColumn("_right", right)
    r1 = F.get("_right", F.lit(0))
    w2 = F.when(F.size("_left") > 1, F.get("_left", F.size("_left") - 2))
    w1 = F.when(F.size("_left") > 0, F.get("_left", F.size("_left") - 1))
    made = F.array(
        F.concat(F.lit("before "), w2, F.lit(" "), w1), F.concat(F.lit("before "), w1), F.concat(F.lit("around "), w1, F.lit(" "), r1)
    )
    return step.withColumn("pattern", F.explode(F.filter(made, lambda p: p.isNotNull()))).drop("_left", "_right")


def reliable_patterns(edges, rounds=ROUNDS, reliable=RELIABLE, support=SUPPORT, checkpoint=staged):
    """Patterns with their reliability, after some rounds over the graph of patterns and instances.

    edges: distinct (pattern, value, seed). A pattern's reliability is the mean score of its instances;
    only patterns with `support` certain ones count. An instance's score is 1 for seeds, else the
    probability that one of its patterns is right. Every round shuffles edges with sums already formed.
    """
    scores = edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for turn in range(rounds):
        known = edges.select("pattern", "value").distinct().join(scores, "value")
        found = known.groupBy("pattern").agg(
            F.avg("score").alias("reliability"), F.sum((F.col("score") >= 0.99).cast("long")).alias("support")
        )
        found = checkpoint(found.filter((F.col("reliability") >= reliable) & (F.col("support") >= support)), "patterns")
        if turn + 1 < rounds:
            doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("reliability"), F.lit(1e-6)))))
            said = edges.join(found, "pattern").groupBy("value").agg((1 - doubt).alias("said"))
            seeds = edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("seed"))
            scores = checkpoint(
                seeds.join(said, "value", "left").select(
                    "value", F.greatest("seed", F.coalesce("said", F.lit(0.0))).alias("score")
                ),
                "scores",
            )
    return found


def spans(docs, text="text", checkpoint=staged, **options):
    """key, doc_id, kind, start, end: valid base spans and discovered ones; key is row_key(doc_id, text)."""
    every = checkpoint(occurrences(docs, text), "occurrences")
    base = every.filter((F.col("kind") != CONTEXT) & valid())
    rows = checkpoint(_outside(base, trimmed(every.filter(F.col("kind") == CONTEXT))), "instances")
    edges = patterns(rows).select("pattern", F.lower("value").alias("value"), "seed").distinct()
    found = reliable_patterns(checkpoint(edges, "edges"), checkpoint=checkpoint, **options)
    pointed = patterns(rows.filter(~F.col("seed"))).join(found.select("pattern"), "pattern", "left_semi")
    columns = ["key", "doc_id", "kind", "start", "end"]
    return rows.filter("seed").select(columns).unionByName(pointed.select(columns).distinct())


def report(docs, text="text", checkpoint=staged, **options):
    """Per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context.

    Spans are kind:start:end in the order of KINDS, then by start. Null and empty texts have none. Rows of
    equal doc_id and text get equal reports.
    """
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    found = spans(docs, text, checkpoint, **options)
    listed = found.groupBy(F.col("key").alias("_key"), F.col("doc_id").alias("_id")).agg(
        F.sort_array(F.collect_list(F.struct(place.alias("place"), "start", "end", "kind"))).alias("all")  # of one document
    )
    keyed = docs.select("doc_id", row_key("doc_id", text).alias("key"))
    joined = keyed.join(listed, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    every = F.coalesce("all", F.array().cast("array<struct<place:int,start:int,end:int,kind:string>>"))
    joined = joined.withColumn("all", every)
    base = F.filter("all", lambda s: s["kind"] != CONTEXT)
    told = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return joined.select(
        "doc_id", *[count(k) for k in EXPRESSIONS], F.sha2(told(base), 256).alias("base_sha256"),
        told("all").alias("spans"), count(CONTEXT),
    )


def redacted(docs, text="text", checkpoint=staged, **options):
    """docs with every span replaced by its kind in brackets; other columns as they are.

    Spans that overlap are replaced together, by the first one's kind. Texts without a digit or an at sign
    hold none and pass without a shuffle; a null text stays null. Rows that repeat are treated alike, and columns may
    have any names. An empty table gives an empty one.
    """
    found = spans(docs, text, checkpoint, **options)
    document = Window.partitionBy("key", "doc_id").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(document.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= F.col("reach"), F.lit(True))
    islands = (
        found.withColumn("reach", reach)
        .withColumn("island", F.sum(opens.cast("int")).over(document))
        .groupBy("key", "doc_id", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", "start").alias("kind"))
    )
    cuts = islands.groupBy(F.col("key").alias("_key"), F.col("doc_id").alias("_id")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("_cuts")  # of one document
    )
    may = F.coalesce(F.col(text).rlike("[0-9@]"), F.lit(False))
    keyed = aside(docs.filter(may), "doc_id", text).withColumn("_row", row_key("doc_id", text))
    joined = keyed.join(cuts, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    pieces = F.transform(
        F.col("_cuts"),
        lambda cut, i: F.concat(
            F.substring(
                F.col(text),
                F.coalesce(F.get(F.col("_cuts"), i - 1)["end"], F.lit(0)) + 1,
                cut["start"] - F.coalesce(F.get(F.col("_cuts"), i - 1)["end"], F.lit(0)),
            ),
            F.lit("["),
            F.upper(cut["kind"]),
            F.lit("]"),
        ),
    )
    rest = F.substring(F.col(text), F.element_at("_cuts", F.lit(-1))["end"] + 1, F.length(text))
    changed = F.when(F.col("_cuts").isNull(), F.col(text)).otherwise(F.concat(F.array_join(pieces, ""), rest))
    cleaned = joined.select(F.col("_rest").withField(text, changed).alias("_rest")).select("_rest.*")
    return docs.filter(~may).unionByName(cleaned)
