from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(part: Column, whole: Column) -> Column:
    """part/whole to four places; 0 where there is nothing to divide by.

    Twenty digits, as the counts of one click and many views may well give a ratio beyond a million.
    """
    quotient = F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)
    return F.round(quotient, 4).cast("decimal(20,4)")


def whole_minutes(start: Column, end: Column) -> Column:
    """Minutes from start to end, cut toward zero; NULL if either is missing."""
    return ((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60).cast("int")


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def percent_text(ratio: Column) -> Column:
    return F.format_string("%.2f%%", number_or_zero(ratio) * 100)


def grouped_integer(value: Column) -> Column:
    return F.format_number(value, 0)


def rate_tier(ratio: Column) -> Column:
    # Lower bounds of the tiers.
    return F.when(ratio >= 0.5, "high").when(ratio >= 0.2, "mid").otherwise("low")
