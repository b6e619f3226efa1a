"""Column expressions over texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

#: What separates words: space, and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words in order; a null text has none. Plain replacements and a one-character split: no regex runs."""
    spaced = reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit(" ")), BLANKS[1:], F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(spaced, " "), "")


def count_of(text: Column, characters: str) -> Column:
    """How often single-byte characters occur in a text."""
    left = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)
    return (F.octet_length(text) - F.octet_length(left)).cast("long")
