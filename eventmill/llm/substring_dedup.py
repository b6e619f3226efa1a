"""Substring dedup over words: cut what repeats a long word sequence of an earlier document.

Seed: every window of ``length`` words has an anchor, its least k-gram (winnowing), and documents meet on
equal anchors. Extend: from an anchor that several documents share, the match is carried on both ways, as
far as the windows around it stay equal; the first document to have a window keeps it. Maximal repeats:
neighbouring repeated windows join into stretches of at least ``length`` words, which are cut.

No pairs are formed. Whole contexts are compared first (see ``seeds``), then, where an anchor has several,
the windows of one representative each; both by a grouped minimum that is reduced before it is shuffled.
A window that no smaller document has is kept, so the plan only carries the windows that are *not* repeats.

Decided cases: a null text has no words. A null doc_id comes after all others. Rows that share an id and
the text get equal results, and neither repeats the other. Rows that share an id, or have none, are rows of
their own, none of which comes before another: an earlier document's words go from all of them. Other columns are ignored, so their names cannot clash. An empty table gives no rows.
A task needs memory for some ten arrays as long as the longest text has words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from . import anchors, arrow, seeds
from .hashing import BASES, Rolling, Words, groups

LENGTH, GRAM = 50, 20
_TAGGED = 12


def _word_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts)
    return words.hashes, words.text_ends


def _windows(docs: DataFrame, entries: DataFrame, length: int) -> DataFrame:
    """The windows around the anchors that several contexts share, as 128-bit hashes, once a document."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, orders = arrow.longs_of(rows, "id"), arrow.longs_of(rows, "order")
            texts, edges = arrow.bytes_of(rows, "text"), arrow.Lists(rows.column("edges"))
            for low, high in groups([len(t) for t in texts]):
                units, ends = _word_units(texts[low:high])
                hashes = [Rolling(units, base) for base in BASES]
                places, owners, tags = [], [], []
                for at in range(low, high):
                    begin, end = (ends[at - low - 1] if at > low else 0), ends[at - low]
                    tag = anchors.tag_of(texts[at])
                    near = np.flatnonzero(seeds.flags(edges.of(at), max(0, end - begin - length + 1), tag))
                    places.append(near)
                    owners.append(np.full(len(near), begin))
                    tags.append(np.full(len(near), (at << _TAGGED) | tag))
                place, begin, tag = (np.concatenate(x) for x in (places, owners, tags))
                start = place + begin
                first, second = (h.of(start, start + length) for h in hashes)
                _, once = np.unique(np.stack([first, (tag >> _TAGGED).astype(np.uint64)]), axis=1, return_index=True) if len(first) else (0, [])
                row = (tag >> _TAGGED)[once]
                yield arrow.batch(
                    first=arrow.signed(first[once]), second=arrow.signed(second[once]), id=ids[row], order=orders[row],
                    spot=(place[once] << _TAGGED) | (tag[once] & ((1 << _TAGGED) - 1)))

    # The same columns as in the last join, so that Spark shuffles the texts once for both.
    joined = docs.join(entries, "id").where("size(edges) > 0").select("doc_id", "id", "order", "text", "alone", "edges")
    return joined.mapInArrow(windows, "first long, second long, id long, order long, spot long")


def _cut(joined: DataFrame, length: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            doc_ids, texts = rows.column("doc_id"), arrow.bytes_of(rows, "text")
            alone, firsts = arrow.Lists(rows.column("alone")), arrow.Lists(rows.column("firsts"))
            for low, high in groups([len(t) for t in texts]):
                units, ends = _word_units(texts[low:high])
                rolling = Rolling(units, BASES[0])
                counts, removed, stretches, kept = [], [], [], []
                for at in range(low, high):
                    begin, end = int(ends[at - low - 1]) if at > low else 0, int(ends[at - low])
                    n, windows, tag = end - begin, max(0, end - begin - length + 1), anchors.tag_of(texts[at])
                    new = seeds.flags(alone.of(at), windows, tag)
                    spots = firsts.of(at)
                    own = spots[(spots & ((1 << _TAGGED) - 1)) == tag] >> _TAGGED
                    if len(own):
                        starts = begin + np.arange(windows)
                        hashes = rolling.of(starts, starts + length)
                        new |= np.isin(hashes, hashes[own])
                    gone = anchors.covered(~new, length) if windows else np.zeros(n, dtype=bool)
                    words = texts[at].split()
                    edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                    counts.append(n)
                    removed.append(int(gone.sum()))
                    stretches.append((edge[0::2], edge[1::2]))
                    kept.append(b" ".join(compress(words, ~gone) if len(edge) else words))
                yield arrow.batch(
                    doc_id=doc_ids.slice(low, high - low), n_words=counts, n_removed=removed, spans=arrow.spans(stretches),
                    kept_text=pa.array(kept, pa.binary()).cast(pa.string()))

    return joined.mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept_text string")


def _firsts(found: DataFrame, least: DataFrame, keys: list[str], twins: DataFrame | None) -> DataFrame:
    """The first occurrences (id, spot) of each key, and with them those of other rows that share the first's doc_id."""
    firsts = least.select("id", "spot")
    if twins is None:
        return firsts
    first = least.select(*keys, F.col("least").alias("order"), F.col("id").alias("first_id"))
    others = found.join(twins, "order", "left_semi").join(first, [*keys, "order"]).where("id <> first_id")
    return firsts.unionByName(others.select("id", "spot").distinct())


def substring_dedup(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, the removed word spans, and the kept words joined by one space."""
    spark = documents.sparkSession
    docs = seeds.keyed(documents)
    twins = seeds.shared_orders(docs)
    spots = seeds.occurrences(docs, _word_units, length, gram, apart=True)
    found = seeds.classes(spots, hot=1, by="order")
    path = scratch_path(spark, "substring-entries")
    keys = ["gram", "context"]
    alone, edges = (_firsts(spots, found.where(of), keys, twins).withColumn("alone", F.lit(i == 0)) for i, of in enumerate(("shared = 0", "shared > 0")))
    alone.unionByName(edges).groupBy("id").agg(
        F.collect_list(F.when(F.col("alone"), F.col("spot"))).alias("alone"),
        F.collect_list(F.when(~F.col("alone"), F.col("spot"))).alias("edges"),
    ).write.parquet(path)
    entries = spark.read.schema("id long, alone array<long>, edges array<long>").parquet(path)
    windows = _windows(docs, entries, length)
    least = windows.groupBy("first", "second").agg(
        F.min("order").alias("least"), F.min_by("id", "order").alias("id"), F.min_by("spot", "order").alias("spot"))
    firsts = _firsts(windows, least, ["first", "second"], twins).groupBy("id").agg(F.collect_list("spot").alias("firsts"))
    joined = docs.join(entries, "id", "left").join(firsts, "id", "left")
    return _cut(joined.select("doc_id", "id", "order", "text", "alone", "edges", "firsts"), length)
