from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what stands in for a missing display value.
UNKNOWN = "(unknown)"

# Whitespace stripped from envelope fields, which come from outside.
_WHITESPACE = " \t\n\r\x0b\x0c"


def is_blank(text: Column) -> Column:
    """NULL and '' are the same to every "required" test. Never NULL itself."""
    return F.coalesce(text, F.lit("")) == ""


def has_text(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def null_if_blank(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def or_unknown(text: Column) -> Column:
    return F.coalesce(null_if_blank(text), F.lit(UNKNOWN))


def stripped(text: Column) -> Column:
    """Strip all whitespace, not only spaces; NULL stays NULL."""
    return F.btrim(text, F.lit(_WHITESPACE))
