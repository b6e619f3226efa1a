"""Labelled rows to learn from: a fold that is left out, and a bounded sample of the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: The most labelled rows that a classifier is fitted to.
SAMPLE = 20_000


def remainder(of: int) -> Column:
    """crc32 of the doc_id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % of


def held_out(folds: int, held: int) -> Column:
    return F.coalesce(remainder(folds) == held, F.lit(False))


def sample(labels: DataFrame, label: str, folds: int, held: int, most: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of ``most`` labelled rows outside the held-out fold, the first in hash order.

    Rows without an id or a label are left out. The result has a fixed bound, so it may be broadcast.
    """
    usable = labels.where(remainder(folds) != held).select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
    return usable.where("label IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
