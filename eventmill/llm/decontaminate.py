"""Benchmark decontamination: windows of documents that are near copies of benchmark items.

Texts are lower-cased (A-Z) words and their five-word shingles; shorter sequences are one shingle. A shingle
weighs 1 + ln(items / items that have it), one that no item has 1 + ln(items). Similarity of a window and an
item is the weighted Jaccard of their shingles with repeats; ``threshold`` and above is contamination.

Windows have the item's number of words (a shorter document is one window). Only windows that share a
shingle with the item are looked at, as all others have similarity 0. Of each, the weighted SimHash of its
shingles is compared with the benchmark's by a multi-index: the 64 bits are four blocks, and fingerprints
at most RADIUS apart agree in some block up to a quarter of that, so a table that lists, for each value of
a block, the items close to it, yields every fingerprint within the radius. At similarity 0.8 a bit differs
with a chance of 0.15; all but 1 in 2,000 such windows lie within the radius, and a copy has several windows. The exact similarity then decides.

Documents are read once per ``slice_of`` items, in one narrow pass; an index has that fixed size. Nothing
is shuffled.

Decided cases: null and wordless texts, of either side, match nothing. Repeated items count as items of
their own; repeated documents are reported each. Other columns are ignored. An empty benchmark or table
gives no rows. A row without a doc_id is reported with a null one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import arrow
from .hashing import BASES, Rolling, Words, groups, mix
from .workspace import ship

SHINGLE, THRESHOLD, RADIUS, SLICE = 5, 0.8, 19, 1000
_BLOCKS, _BITS = 4, 16
_SIEVE = 1 << 20
_BIT = np.arange(64, dtype=np.uint64)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """A row of 64 signs for each hash."""
    return ((mix(hashes)[:, None] >> _BIT) & np.uint64(1)).astype(np.float64) * 2 - 1


def _print(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BIT).sum(axis=-1, dtype=np.uint64)


@dataclass
class Item:
    item_id: int
    n_words: int
    size: int
    """Words in a shingle: SHINGLE, or all of a shorter item."""
    grams: np.ndarray
    """Distinct shingles, ascending."""
    counts: np.ndarray
    weights: np.ndarray
    fingerprint: np.uint64 = np.uint64(0)

    @property
    def total(self) -> float:
        return float(self.counts @ self.weights)


@dataclass
class Match:
    row: int
    item_id: int
    start: int
    n_words: int
    similarity: float


class Index:
    """A slice of the benchmark: its shingles, and the multi-index over its fingerprints."""

    def __init__(self, items: list[Item], weight: dict[int, float], unknown: float, radius: int, threshold: float):
        self.items, self.radius, self.threshold, self.unknown = items, radius, threshold, unknown
        self.weight = np.array(list(weight.values()))
        self.known = np.array(list(weight), dtype=np.uint64)
        order = np.argsort(self.known)
        self.known, self.weight = self.known[order], self.weight[order]
        for item in items:
            item.weights = self.weights_of(item.grams)
            item.fingerprint = _print((item.counts * item.weights) @ _signs(item.grams))
        # Shingles of this slice, and who has them.
        pairs = [(int(g), i) for i, item in enumerate(items) for g in item.grams]
        pairs.sort()
        self.grams, self.first = np.unique(np.array([g for g, _ in pairs], dtype=np.uint64), return_index=True)
        self.owner = np.array([i for _, i in pairs], dtype=np.int64)
        self.first = np.r_[self.first, len(pairs)]
        self.sieve = np.zeros(_SIEVE, dtype=bool)
        self.sieve[(self.grams & np.uint64(_SIEVE - 1)).astype(np.int64)] = True
        self.sizes = sorted({item.size for item in items})
        prints = np.array([item.fingerprint for item in items], dtype=np.uint64)
        values = np.arange(1 << _BITS, dtype=np.uint16)
        #: Of each block, a row an item: which values of the block are close to the item's.
        self.near = []
        for block in range(_BLOCKS):
            own = (prints >> np.uint64(block * _BITS)).astype(np.uint16)  # the lowest sixteen bits of it
            self.near.append(np.packbits(np.bitwise_count(own[:, None] ^ values) <= radius // _BLOCKS, axis=1))

    def weights_of(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(grams), self.unknown)
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        return np.where(self.known[at] == grams, self.weight[at], self.unknown)

    def _close(self, item: int, prints: np.ndarray) -> np.ndarray:
        """Which fingerprints are within the radius of an item's: candidates from the blocks, then all bits."""
        found = np.zeros(len(prints), dtype=bool)
        for block in range(_BLOCKS):
            value = ((prints >> np.uint64(block * _BITS)) & np.uint64((1 << _BITS) - 1)).astype(np.int64)
            found |= (self.near[block][item, value >> 3] >> (7 - (value & 7)).astype(np.uint8) & 1).astype(bool)
        found[found] = np.bitwise_count(prints[found] ^ self.items[item].fingerprint) <= self.radius
        return found

    def _similarity(self, item: Item, grams: np.ndarray) -> float:
        names, counts = np.unique(grams, return_counts=True)
        at = np.minimum(np.searchsorted(item.grams, names), len(item.grams) - 1)
        both = np.where(item.grams[at] == names, np.minimum(item.counts[at], counts), 0)
        common = float(both @ item.weights[at])
        every = item.total + float(counts @ self.weights_of(names)) - common
        return round(common / every, 9)  # so that ties are ties whatever the order of the sums

    def _verify(self, item: int, grams: np.ndarray, hits: np.ndarray, n: int) -> tuple[float, int]:
        """The most similar window of a document, its shingles given, and where it starts; 0 if none will do.

        ``hits``: the places of the item's shingles; ``n``: the document's words.
        """
        it = self.items[item]
        wide = max(1, min(it.n_words, n) - it.size + 1)  # shingles in a window
        last = max(0, len(grams) - wide)
        low, high = max(0, int(hits[0]) - wide + 1), min(int(hits[-1]), last)
        near = np.zeros(high - low + 2, dtype=np.int64)  # starts of windows that hold a hit
        np.add.at(near, np.maximum(hits - wide + 1, 0) - low, 1)
        np.add.at(near, np.minimum(np.minimum(hits, last) + 1 - low, len(near) - 1), -1)
        starts = low + np.flatnonzero(np.cumsum(near[:-1]) > 0)
        # What a window has in common with the item is at most the weight of its hits.
        held = np.zeros(len(grams) + 1)
        held[hits + 1] = it.weights[np.searchsorted(it.grams, grams[hits])]
        held = np.cumsum(held)
        starts = starts[held[starts + wide] - held[starts] >= self.threshold * it.total * (1 - 1e-9)]
        best = (0.0, 0)
        if not len(starts):
            return best
        base, end = int(starts[0]), int(starts[-1]) + wide
        part = grams[base:end]
        sums = np.concatenate([np.zeros((1, 64)), np.cumsum(self.weights_of(part)[:, None] * _signs(part), axis=0)])
        prints = _print(sums[starts - base + wide] - sums[starts - base])
        for start in starts[self._close(item, prints)]:
            best = max(best, (self._similarity(it, grams[start : start + wide]), -int(start)))
        return best

    def matches(self, texts: list[bytes]) -> Iterator[Match]:
        words = Words([t.lower() for t in texts])
        begins = np.r_[0, words.text_ends[:-1]]
        for size in self.sizes:
            grams = Rolling(words.hashes, BASES[1]).grams(size)
            place = np.flatnonzero(self.sieve[(grams & np.uint64(_SIEVE - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.grams, grams[place]), len(self.grams) - 1)
            real = self.grams[at] == grams[place]
            place, at = place[real], at[real]
            row = np.searchsorted(words.text_ends, place, side="right")
            inside = place + size <= words.text_ends[row]
            place, at, row = place[inside], at[inside], row[inside]
            many = self.first[at + 1] - self.first[at]
            item = self.owner[np.repeat(self.first[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            place, row = np.repeat(place, many), np.repeat(row, many)
            fits = np.array([x.size for x in self.items])[item] == size
            place, row, item = place[fits], row[fits], item[fits]
            order = np.lexsort((place, item, row))
            place, row, item = place[order], row[order], item[order]
            head = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])][: len(row)])
            for a, b in zip(head, np.r_[head[1:], len(row)]):
                begin, end = int(begins[row[a]]), int(words.text_ends[row[a]])
                similarity, start = self._verify(int(item[a]), grams[begin : end - size + 1], place[a:b] - begin, end - begin)
                if similarity >= self.threshold:
                    found = self.items[item[a]]
                    yield Match(int(row[a]), found.item_id, -start, min(found.n_words, end - begin), similarity)


def _read_items(rows: list) -> list[Item]:
    items = []
    for row in rows:
        hashes = Words([(row.text or "").encode().lower()]).hashes
        if len(hashes):
            size = min(SHINGLE, len(hashes))
            grams, counts = np.unique(Rolling(hashes, BASES[1]).grams(size), return_counts=True)
            items.append(Item(row.item_id, len(hashes), size, grams, counts, np.zeros(len(grams))))
    return items


def indexes(benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD, slice_of: int = SLICE) -> list[Index]:
    """The benchmark in slices of about ``slice_of`` items; each is read to the driver by itself."""
    narrow = benchmark.select("item_id", "text")
    n = narrow.count()
    slices = -(-n // slice_of)
    found = []
    for i in range(slices):
        rows = narrow.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i).collect()
        found.append(_read_items(sorted(rows, key=lambda r: (r.item_id is None, r.item_id, r.text or ""))))
    having: dict[int, int] = {}
    for items in found:
        for item in items:
            for gram in item.grams.tolist():
                having[gram] = having.get(gram, 0) + 1
    real = sum(len(items) for items in found)
    unknown = 1 + math.log(max(1, real))
    return [
        Index(items, {g: 1 + math.log(real / having[g]) for x in items for g in x.grams.tolist()}, unknown, radius, threshold)
        for items in found if items]


def _over(documents: DataFrame, index: Index, schema: str, finish: Callable[[pa.RecordBatch, list[Match]], pa.RecordBatch]) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(index)  # of a slice's fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = arrow.bytes_of(rows, "text")
            for low, high in groups([len(t) for t in texts]):
                yield finish(rows.slice(low, high - low), list(shared.value.matches(texts[low:high])))

    return documents.mapInArrow(run, schema)


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """A row for each document and item that match: doc_id, item_id, start and n_words of the most similar
    window (in words, from 0; the first of equal ones), and its similarity."""
    spark: SparkSession = documents.sparkSession
    ship(spark)
    schema = "doc_id long, item_id long, start long, n_words long, similarity double"
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def report(rows: pa.RecordBatch, found: list[Match]) -> pa.RecordBatch:
        return arrow.batch(
            doc_id=rows.column("doc_id").take(pa.array([m.row for m in found], pa.int64())),
            item_id=pa.array([m.item_id for m in found], pa.int64()), start=pa.array([m.start for m in found], pa.int64()),
            n_words=pa.array([m.n_words for m in found], pa.int64()), similarity=pa.array([m.similarity for m in found], pa.float64()))

    parts = [_over(docs, index, schema, report) for index in indexes(benchmark, radius, threshold)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def decontaminate(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The documents, with all their columns, that match no item."""
    ship(documents.sparkSession)

    def drop(rows: pa.RecordBatch, found: list[Match]) -> pa.RecordBatch:
        keep = np.ones(rows.num_rows, dtype=bool)
        keep[[m.row for m in found]] = False
        return rows.filter(pa.array(keep))

    for index in indexes(benchmark, radius, threshold):
        documents = _over(documents, index, documents.schema, drop)
    return documents
