"""Turns of conversations: their order, and a digest that stands for a turn's role and text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a role and a text, neither null. Turns of equal number are ordered by it."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def checksum(text: Column) -> Column:
    """The unsigned CRC-32 of a text."""
    return F.crc32(text.cast("binary"))
