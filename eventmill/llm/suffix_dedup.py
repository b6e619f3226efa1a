"""Suffix-array dedup over bytes: cut every byte that lies in a string found elsewhere.

Sorting all suffixes of a corpus takes many times its size on disk, so only those that may begin a repeat
are sorted. Every window of ``length`` bytes has an anchor, its least k-gram; equal windows have equal
anchors at equal offsets. What surrounds an anchor (its context) settles most windows at once: a context
found twice is a repeat, an anchor found once is none. What is left are anchors with several contexts.

Their contexts, one of each kind, are dealt out by anchor. A task takes a block of them at a time, bounded
in bytes. A block's suffix buckets are (anchor, offset): only strings of one bucket can be equal. Buckets
are sorted with the ranks of a difference cover's suffixes, computed once a block, which settle ties of
any length in a constant number of steps (see ``suffix_order``). Anchors with more than ``most`` contexts
would not fit a block; their windows are compared by 128-bit hashes in a grouped count instead, which is
reduced before it is shuffled, so no anchor's contexts ever meet in one task.

Decided cases: a null text is empty. Rows are separate documents, also when they share an id and a text.
Rows that share an id but not the text: as separate documents. Other columns are ignored. An empty table
gives no rows. A task needs memory for some ten arrays as long as the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from . import anchors, arrow, seeds
from .hashing import BASES, BYTE_UNITS, Rolling, groups
from .suffix_order import Cover, SuffixBlock

LENGTH, GRAM = 200, 50
#: Contexts of an anchor, and bytes of contexts, that are sorted in one block.
MOST_CONTEXTS, BLOCK = 2000, 2 << 20
_EDGE = "array<struct<gram: long, spot: long, twice: long, hot: long>>"


def _byte_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_UNITS[np.frombuffer(b"".join(texts), dtype=np.uint8)], np.cumsum([len(t) for t in texts])


def _own(edges: arrow.Lists, row: int, tag: int) -> tuple[np.ndarray, ...]:
    fields = [edges.of(row, name) for name in ("gram", "spot", "twice", "hot")]
    own = anchors.unpack(fields[1]).tag == tag
    return tuple(f[own] for f in fields)


def _contexts(joined: DataFrame, length: int) -> DataFrame:
    """The bytes around each anchor that several contexts share."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, texts, edges = arrow.longs_of(rows, "id"), arrow.bytes_of(rows, "text"), arrow.Lists(rows.column("edges"))
            for low, high in groups([len(t) for t in texts]):
                columns: tuple[list, ...] = ([], [], [], [], [])
                for at in range(low, high):
                    gram, spot, twice, hot = _own(edges, at, anchors.tag_of(texts[at]))
                    spots = anchors.unpack(spot)
                    for i in np.flatnonzero(hot == 0):
                        first = spots.first[i]
                        for column, value in zip(columns, (gram[i], ids[at], spot[i], twice[i], texts[at][first : first + spots.count[i] + length - 1])):
                            column.append(value)
                yield arrow.batch(
                    **{name: pa.array(column, pa.int64()) for name, column in zip(("gram", "id", "spot", "twice"), columns)},
                    context=pa.array(columns[4], pa.binary()))

    return joined.mapInArrow(contexts, "gram long, id long, spot long, twice long, context binary")


def _unrepeated(gram: np.ndarray, spot: np.ndarray, twice: np.ndarray, texts: list[bytes], length: int, cover: Cover) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's contexts, the stretches of windows found once: the context's number, and the spot."""
    spots = anchors.unpack(spot)
    base = np.cumsum([0, *(len(t) for t in texts)])[:-1]
    context = np.repeat(np.arange(len(texts)), spots.count)
    place = np.arange(len(context)) - np.repeat(np.cumsum(spots.count) - spots.count, spots.count)
    _, number = np.unique(gram, return_inverse=True)
    bucket = number[context] * anchors.MOST_LENGTH + spots.offset[context] - place
    classes = SuffixBlock(b"".join(texts), length, cover).classes(base[context] + place, bucket)
    _, kind = np.unique(classes, return_inverse=True)
    copies = np.bincount(kind, weights=1 + twice[context])[kind]
    once = np.flatnonzero(copies == 1)
    head = np.r_[True, (np.diff(once) != 1) | (np.diff(context[once]) != 0)][: len(once)]
    begin = np.flatnonzero(head)
    first, run = once[begin], np.diff(begin, append=len(once))
    of = context[first]
    return of, anchors.pack(spots.first[of] + place[first], np.zeros(len(of)), run, spots.tag[of])


def _sorted_blocks(contexts: DataFrame, length: int) -> DataFrame:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover, held, size = Cover(length), [], 0

        def settle(upto: int) -> pa.RecordBatch:
            rows = held[:upto]
            del held[:upto]
            gram, ids, spot, twice = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))
            of, found = _unrepeated(gram, spot, twice, [r[4] for r in rows], length, cover)
            return arrow.batch(id=ids[of], spot=found)

        for rows in batches:
            for row in zip(*(rows.column(name).to_pylist() for name in ("gram", "id", "spot", "twice", "context"))):
                if size > BLOCK and held[-1][0] != row[0]:
                    yield settle(len(held))
                    size = 0
                held.append(row)
                size += len(row[4])
        if held:
            yield settle(len(held))

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(blocks, "id long, spot long")


def _hot_windows(joined: DataFrame, length: int) -> DataFrame:
    """The windows found once around anchors that have too many contexts for a block."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, texts, edges = arrow.longs_of(rows, "id"), arrow.bytes_of(rows, "text"), arrow.Lists(rows.column("edges"))
            for at, text in enumerate(texts):
                tag = anchors.tag_of(text)
                _, spot, twice, hot = _own(edges, at, tag)
                spots = anchors.unpack(spot[hot > 0])
                if not len(spots.first):
                    continue
                units, _ = _byte_units([text])
                first = np.repeat(spots.first, spots.count)
                start = first + np.arange(len(first)) - np.repeat(np.cumsum(spots.count) - spots.count, spots.count)
                hashes = [arrow.signed(Rolling(units, base).of(start, start + length)) for base in BASES]
                yield arrow.batch(
                    first=hashes[0], second=hashes[1], id=np.full(len(start), ids[at]),
                    spot=anchors.pack(start, np.zeros(len(start)), np.ones(len(start), np.int64), np.full(len(start), tag)),
                    copies=1 + np.repeat(twice[hot > 0], spots.count))

    found = joined.mapInArrow(windows, "first long, second long, id long, spot long, copies long")
    counted = found.groupBy("first", "second").agg(
        F.min("id").alias("id"), F.min_by("spot", "id").alias("spot"), F.sum("copies").alias("copies"))
    return counted.where("copies = 1").select("id", "spot")


def _whole(text: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shrinks stretches of UTF-8 to whole characters."""
    def start(at: int, step: int) -> int:
        while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
            at += step
        return at

    begin = np.array([start(int(a), 1) for a in begin], dtype=np.int64)
    end = np.array([start(int(b), -1) for b in end], dtype=np.int64)
    real = begin < end
    return begin[real], end[real]


def _cut(joined: DataFrame, length: int, whole: bool) -> DataFrame:
    carried = [f for f in joined.schema if f.name == "carried"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            doc_ids, texts = rows.column("doc_id"), arrow.bytes_of(rows, "text")
            alone, once = arrow.Lists(rows.column("alone")), arrow.Lists(rows.column("once"))
            for low, high in groups([len(t) for t in texts]):
                removed, stretches, kept = [], [], []
                for at in range(low, high):
                    text = texts[at]
                    windows, tag = max(0, len(text) - length + 1), anchors.tag_of(text)
                    new = seeds.flags(np.concatenate([alone.of(at), once.of(at)]), windows, tag)
                    gone = anchors.covered(~new, length) if windows else np.zeros(len(text), dtype=bool)
                    edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                    begin, end = _whole(text, edge[0::2], edge[1::2]) if whole else (edge[0::2], edge[1::2])
                    removed.append(int((end - begin).sum()))
                    stretches.append((begin, end))
                    kept.append(b"".join(text[a:b] for a, b in zip(np.r_[0, end], np.r_[begin, len(text)])) if len(begin) else text)
                yield arrow.batch(
                    doc_id=doc_ids.slice(low, high - low), n_bytes=[len(t) for t in texts[low:high]], n_removed=removed,
                    spans=arrow.spans(stretches), kept=pa.array(kept, pa.binary()),
                    **{f.name: rows.column(f.name).slice(low, high - low) for f in carried})

    schema = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
    return joined.mapInArrow(cut, StructType([*schema, *carried]))


def suffix_dedup(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST_CONTEXTS, carried: tuple[str, ...] = (),
    whole: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, the removed byte spans, and the remaining bytes.

    ``carried``: columns that go along, as a struct of that name. ``whole``: characters that lie only partly
    in a repeat stay, so that the remaining bytes are text.
    """
    spark = documents.sparkSession
    docs = seeds.keyed(documents, *carried)
    found = seeds.classes(seeds.occurrences(docs, _byte_units, length, gram, apart=False), hot=most)
    path = scratch_path(spark, "suffix-entries")
    twice, hot = (F.col("copies") > 1).cast("long"), (F.col("shared") > 1).cast("long")
    found.where("shared > 0 OR copies = 1").groupBy("id").agg(
        F.collect_list(F.when(F.col("shared") == 0, F.col("spot"))).alias("alone"),
        F.collect_list(F.when(F.col("shared") > 0, F.struct("gram", "spot", twice.alias("twice"), hot.alias("hot")))).alias("edges"),
    ).write.parquet(path)
    entries = spark.read.schema(f"id long, alone array<long>, edges {_EDGE}").parquet(path)
    # The same columns as in the last join, so that Spark shuffles the texts once for all.
    near = docs.join(entries, "id").where("size(edges) > 0").select(*docs.columns, "alone", "edges")
    once = _sorted_blocks(_contexts(near, length), length).unionByName(_hot_windows(near, length))
    once = once.groupBy("id").agg(F.collect_list("spot").alias("once"))
    joined = docs.join(entries, "id", "left").join(once, "id", "left")
    return _cut(joined.select(*docs.columns, "alone", "edges", "once"), length, whole)
