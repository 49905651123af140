"""String, array and JSON helpers, all as native column expressions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def stripped(column):
    """Without white space of any kind at both ends."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+\z", "")


def normalized(column):
    return F.lower(stripped(column))


def blank_if_missing(column):
    return F.coalesce(column.cast("string"), F.lit(""))


def non_blank(column):
    return stripped(column) != ""


def names_of(array, field):
    """Field values of an array of structs without the missing and empty ones."""
    return F.filter(
        F.transform(array, lambda item: item[field]), lambda v: v.isNotNull() & (v != F.lit(""))
    )


def join_tags(array, separator="; "):
    return F.coalesce(F.array_join(array, separator), F.lit(""))


def normalize_array(array):
    return F.transform(array, normalized)


def tokens_as_phrase(column):
    """' a b ' for 'A-b': lower-case words between single blanks, ready for phrase search."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(column), "[^a-z0-9]+", " ")), F.lit(" "))


def parse_list_text(column):
    """'[..]' text to an array; anything that is not a list becomes a one-element array."""
    alone = F.array(column)
    parsed = F.from_json(column, T.ArrayType(T.StringType()))
    return F.when(F.startswith(column, F.lit("[")), F.coalesce(parsed, alone)).otherwise(alone)


def numbered_lines(items):
    """['a', 'b'] to '1. a\\n2. b'."""
    return F.array_join(
        F.transform(items, lambda v, i: F.concat((i + 1).cast("string"), F.lit(". "), v)), "\n"
    )


def yyyymmdd(column):
    return F.date_format(column, "yyyyMMdd")


def parse_yyyymmdd(column):
    return F.try_to_date(column, "yyyyMMdd")
