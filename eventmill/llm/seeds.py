"""From documents to classes of equal anchor contexts: the part that both repeat finders share.

A class is (anchor, context): equal runs of windows. It is summed before the shuffle, so a passage in a
third of all documents costs each task one row. Where an anchor has a single class, every occurrence is
settled by the class alone; only anchors with several contexts (the edges of a repeat) need a closer look,
and of those one representative a class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import anchors
from .arrow import batch, bytes_of, longs_of, signed
from .hashing import groups, mix
from .workspace import ship
from ..session import scratch_path

#: The order of a missing id: after all others.
_LAST = (1 << 63) - 1

Units = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def keyed(documents: DataFrame, *carried: str) -> DataFrame:
    """doc_id, text, the order of its id, an id of the row by which rows are joined, and what is only carried along.

    A row is known by a hash of its doc_id and text, so rows that share a doc_id, or have none, are not gathered.
    Copies of a row share its id, and get equal results.
    """
    ship(documents.sparkSession)
    order, text = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), F.coalesce("text", F.lit(""))
    along = [F.struct(*carried).alias("carried")] if carried else []
    return documents.select("doc_id", text.alias("text"), order.alias("order"), F.xxhash64(order, text).alias("id"), *along)


def shared_orders(docs: DataFrame) -> DataFrame | None:
    """The orders that rows of different texts share, if there are any: of repeated ids, and of no id."""
    path = scratch_path(docs.sparkSession, "shared-ids")
    counted = docs.select("order", "id").distinct().groupBy("order").agg(F.count("*").alias("n"))
    counted.where("n > 1").select("order").write.parquet(path)
    found = docs.sparkSession.read.schema("order long").parquet(path)
    return None if found.isEmpty() else found


def _ordinal(keys: np.ndarray) -> np.ndarray:
    """How many equal keys stand before each."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    head = np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]
    place = np.arange(len(keys))
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = place - np.maximum.accumulate(np.where(head, place, 0))
    return out


def occurrences(docs: DataFrame, units: Units, length: int, gram: int, apart: bool) -> DataFrame:
    """A row for each anchor of each document. ``apart``: equal contexts of one document are told apart."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, orders, texts = longs_of(rows, "id"), longs_of(rows, "order"), bytes_of(rows, "text")
            for low, high in groups([len(t) for t in texts]):
                part = texts[low:high]
                tags = np.array([anchors.tag_of(t) for t in part])
                pieces = anchors.scan(*units(part), length, gram)
                if apart:  # ordinals count through all pieces of a text
                    whole = [np.concatenate(column) for column in zip(*pieces)]
                    pieces = [anchors.Anchors(*whole)] if whole else []
                for found in pieces:
                    context = found.context
                    if apart:
                        again = _ordinal(mix(found.gram ^ mix(context + found.text.astype(np.uint64))))
                        context = np.where(again > 0, mix(context + again.astype(np.uint64)), context)
                    spot = anchors.pack(found.first, found.offset, found.count, tags[found.text])
                    yield batch(
                        gram=signed(found.gram), context=signed(context), id=ids[low:high][found.text],
                        order=orders[low:high][found.text], spot=spot)

    return docs.select("id", "order", "text").mapInArrow(scan, "gram long, context long, id long, order long, spot long")


def classes(occurrences: DataFrame, hot: int, by: str = "id") -> DataFrame:
    """A row for each class: its first occurrence by a column, that column's value, the number of occurrences,
    and whether its anchor is shared by other classes (0 no, 1 yes, 2 by more than ``hot``)."""
    spark = occurrences.sparkSession
    path = scratch_path(spark, "anchor-classes")
    occurrences.groupBy("gram", "context").agg(
        F.min(by).alias("least"), F.min_by("id", by).alias("id"), F.min_by("spot", by).alias("spot"),
        F.count("*").alias("copies")).write.parquet(path)
    found = spark.read.schema("gram long, context long, least long, id long, spot long, copies long").parquet(path)  # read twice
    shared = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    level: Column = F.when(F.col("n").isNull(), 0).when(F.col("n") <= hot, 1).otherwise(2)
    return found.join(shared, "gram", "left").select("gram", "context", "least", "id", "spot", "copies", level.alias("shared"))


def flags(spots: np.ndarray, windows: int, tag: int) -> np.ndarray:
    """Marks the windows that a document's spots stand for."""
    change = np.zeros(windows + 1, dtype=np.int32)
    at = anchors.unpack(spots)
    own = at.tag == tag
    np.add.at(change, at.first[own], 1)
    np.add.at(change, at.first[own] + at.count[own], -1)
    return np.cumsum(change[:windows]) > 0
