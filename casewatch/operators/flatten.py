"""Raw nested case reports to flat rows with a readable summary, as native expressions."""

from pyspark.sql import functions as F

from casewatch import config
from casewatch.functions.text import names_of, tokens_as_phrase


def tracked_drugs_named(products, drugs):
    """Tracked drugs whose name occurs as a word or phrase in a product name, in list order."""
    # "|" keeps a phrase from matching across two products.
    text = F.array_join(F.transform(products, lambda p: tokens_as_phrase(p["medicinalproduct"])), "|")
    named = lambda t: F.array_compact(
        F.array(*[F.when(F.contains(t, tokens_as_phrase(F.lit(d))), F.lit(d)) for d in drugs])
    )
    # Going through a one-element array normalises the text once for all drugs.
    return F.flatten(F.transform(F.array(text), named))


def mentions_drug(products, drug):
    """Case-insensitive word or phrase match of one drug in any product name."""
    wanted = tokens_as_phrase(F.lit(drug))
    return F.coalesce(
        F.exists(products, lambda p: F.contains(tokens_as_phrase(p["medicinalproduct"]), wanted)),
        F.lit(False),
    )


def received_between(start, end):
    """Inclusive range on the yyyyMMdd text; a bound that is None does not limit."""
    received, within = F.col("receivedate"), F.lit(True)
    if start is not None:
        within = within & (received >= start.replace("-", ""))
    if end is not None:
        within = within & (received <= end.replace("-", ""))
    return within


def scan_reports(reports, drugs=config.DRUGS, start=config.START_DATE, end=config.END_DATE):
    """One row per (report in range, tracked drug it names), in one pass for all drugs."""
    return reports.filter(received_between(start, end)).withColumn(
        "drug", F.explode(tracked_drugs_named(F.col("patient.drug"), drugs))
    )


def scan_first_named(reports, drugs=config.DRUGS, start=config.START_DATE, end=config.END_DATE):
    """One row per report in range that names a tracked drug, with the earliest of the list.

    What scan_reports and keeping the first row per id give, without multiplying rows.
    """
    named = F.get(tracked_drugs_named(F.col("patient.drug"), drugs), 0)
    return (
        reports.filter(received_between(start, end)).withColumn("drug", named).filter(F.col("drug").isNotNull())
    )


def decode_sex(column):
    chain = F
    for code, name in config.SEX_CODES.items():
        chain = chain.when(column == code, F.lit(name))
    return chain.otherwise(F.lit("unknown"))


def seriousness_flags():
    """Labels of the flag columns that equal "1", in their fixed order."""
    return F.array_compact(
        F.array(*[F.when(F.col(c) == "1", F.lit(v)) for c, v in config.SERIOUSNESS_LABELS.items()])
    )


def _or_default(text, default):
    return F.coalesce(F.nullif(text, F.lit("")), default)


def summary_text(age, sex, products, reactions, flags, received, drug):
    """The summary sentence, a fixed format; every missing part has its own fallback."""
    joined = lambda array: F.coalesce(F.array_join(array, ", "), F.lit(""))
    return F.concat(
        F.lit("A "),
        _or_default(age, F.lit("unknown-age")),
        F.lit(" year old "),
        sex,
        F.lit(" patient taking "),
        _or_default(joined(products), drug),
        F.lit(" experienced: "),
        _or_default(joined(reactions), F.lit("unspecified reaction(s)")),
        F.lit(". Seriousness: "),
        _or_default(joined(flags), F.lit("non-serious/other")),
        F.lit(". Report received "),
        F.coalesce(received, F.lit("unknown date")),
        F.lit("."),
    )


def flatten_reports(reports, drug="drug", keep=()):
    """Nine flat columns per raw report, plus the kept ones. drug: column with the queried name."""
    parts = reports.select(
        *keep,
        "safetyreportid",
        F.col(drug).alias("drug"),
        "receivedate",
        decode_sex(F.col("patient.patientsex")).alias("patient_sex"),
        F.col("patient.patientonsetage").alias("patient_age"),
        names_of(F.col("patient.reaction"), "reactionmeddrapt").alias("_reactions"),
        names_of(F.col("patient.drug"), "medicinalproduct").alias("_products"),
        seriousness_flags().alias("_flags"),
    )
    text = lambda c: F.coalesce(F.array_join(c, "; "), F.lit(""))
    return parts.select(
        *keep,
        "safetyreportid",
        "drug",
        "receivedate",
        "patient_sex",
        "patient_age",
        text("_reactions").alias("reactions"),
        text("_products").alias("drugs_involved"),
        text("_flags").alias("seriousness_flags"),
        summary_text(
            F.col("patient_age"),
            F.col("patient_sex"),
            F.col("_products"),
            F.col("_reactions"),
            F.col("_flags"),
            F.col("receivedate"),
            F.col("drug"),
        ).alias("patient_summary_text"),
    )
