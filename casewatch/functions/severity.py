"""The two severity normalisers. They differ on purpose; keep both."""

from pyspark.sql import functions as F

from casewatch.config import SEVERITY_ALIASES
from casewatch.functions.text import normalized

# Checked in this order, the first one contained in the text decides.
LADDER = (
    (("fatal", "death"), "fatal"),
    (("life-threatening", "life threatening"), "life-threatening"),
    (("hospitalization", "disabling", "severe"), "severe"),
    (("non-serious", "non serious"), "mild"),
    (("serious",), "moderate"),
    (("mild",), "mild"),
)
LADDER_DEFAULT = "moderate"


def severity_by_lookup(column, aliases=None):
    """Exact match after trimming and lower-casing; unknown values pass through."""
    aliases = SEVERITY_ALIASES if aliases is None else aliases
    pairs = [F.lit(x) for pair in aliases.items() for x in pair]
    value = normalized(column)
    return F.coalesce(F.element_at(F.create_map(*pairs), value), value)


def severity_by_ladder(column):
    """Ordered substring rules; null and anything unmatched become the default."""
    value = normalized(column)
    chain = F
    for words, label in LADDER:
        hit = F.contains(value, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(value, F.lit(word))
        chain = chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(LADDER_DEFAULT))


def ladder_of(value):
    """severity_by_ladder() of one text, for models in Python."""
    value = value.strip().lower()
    return next((label for words, label in LADDER if any(word in value for word in words)), LADDER_DEFAULT)


def changed_by(column, normal):
    """True where normalising altered more than case and outer blanks, or filled in a missing value."""
    return ~normalized(column).eqNullSafe(normal)
