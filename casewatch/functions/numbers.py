"""Rounding, number formatting."""

from pyspark.sql import functions as F


def round_half_even(column, digits=2):
    """rint(x * 10^d) / 10^d, with a negative zero written as zero."""
    scale = float(10**digits)
    scaled = F.rint(column * F.lit(scale))
    return F.when(scaled == 0, F.lit(0.0)).otherwise(scaled / F.lit(scale))


def percent(column, digits=1):
    """0.6979 to '69.8%', ties to even."""
    scale = float(10**digits)
    return F.format_string(f"%.{digits}f%%", F.rint(column * (100 * scale)) / scale)


def thousands(column):
    return F.format_number(column, 0)
