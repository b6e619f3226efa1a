"""SimHash fingerprints, and groups of documents whose fingerprints differ in few bits.

Equal fingerprints are one node. Nodes are compared exactly, in tiles: exclusive-or of a tile against a
tile, and bit counts. Tiles lie within blocks so that their pairs stay far fewer than the square of the
nodes: the 64 bits are cut into ``blocks`` parts, and fingerprints at most ``radius`` bits apart are equal
in at least blocks - radius of them, so each choice of that many parts is a table in which such a pair
shares a key. No pair is lost. Within a key, nodes go by population count, and a pair of tiles is skipped
if these counts differ by more than the radius, or if both tiles are already joined through a common node.
A tile pair hands on no more links than join its nodes, so a dense group does not turn into all its pairs.

A key holds distinct fingerprints only, hence copies cannot make it large.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import arrow
from .components import connected
from .hashing import groups
from .workspace import ship
from ..session import scratch_path

SHINGLE, RADIUS, BLOCKS, SEED = 4, 4, 6, 42
TILE = 512
_LAST = (1 << 63) - 1
#: Each byte's bits, spread over the eight bytes of a number, highest bit in the highest byte.
_SPREAD = np.array([int.from_bytes(bytes((x >> (7 - i)) & 1 for i in range(8)), "big") for x in range(256)], dtype=">u8")
_MOST_ADDED = 255


def shingle_hashes(text: bytes, size: int, seed: int) -> list[int]:
    words = text.lower().split()  # of bytes: A-Z, and the six separators of a word
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-size]].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())]


def majorities(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each stretch of hashes, the bits that more than half of them have; 0 for an empty one."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    spread = _SPREAD[hashes.astype(">u8").view(np.uint8).reshape(-1, 8)]
    sizes = sizes[full]
    firsts = np.cumsum(sizes) - sizes
    parts = -(-sizes // _MOST_ADDED)
    owner = np.repeat(np.arange(len(sizes)), parts)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    added = np.add.reduceat(spread.astype(np.uint64), firsts[owner] + part * _MOST_ADDED, axis=0)
    bits = np.ascontiguousarray(added.astype(">u8")).view(np.uint8).reshape(-1, 64)
    counts = np.add.reduceat(bits.astype(np.int64), np.cumsum(parts) - parts, axis=0)
    out[full] = np.packbits(2 * counts > sizes[:, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(documents: DataFrame, size: int = SHINGLE, seed: int = SEED, keep: str = "") -> DataFrame:
    """doc_id and its text's 64-bit SimHash, as a long. A null text has no words; no words give zero.

    ``keep``: a long column that goes along.
    """
    ship(documents.sparkSession)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = arrow.bytes_of(rows, "text")
            for low, high in groups([len(t) for t in texts]):
                hashes = [shingle_hashes(t, size, seed) for t in texts[low:high]]
                every = np.fromiter((h for x in hashes for h in x), dtype=np.uint64)
                found = majorities(every, np.array([len(x) for x in hashes]))
                along = {name: rows.column(name).slice(low, high - low) for name in kept}
                yield arrow.batch(doc_id=along["doc_id"], fingerprint=arrow.signed(found), **{n: along[n] for n in kept[1:]})

    kept = ["doc_id", keep] if keep else ["doc_id"]
    schema = ", ".join(["doc_id long, fingerprint long", *(f"{name} long" for name in kept[1:])])
    return documents.select(*(F.col(name).cast("long").alias(name) for name in kept), "text").mapInArrow(prints, schema)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for ends in (a, b, label[a], label[b]):
            np.minimum.at(new, ends, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def tile_links(keys: np.ndarray, nodes: np.ndarray, radius: int, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Links enough to join what is within ``radius`` among nodes of equal key; sorted by key here."""
    counts = np.bitwise_count(nodes).astype(np.int16)
    order = np.lexsort((nodes, counts, keys))
    keys, nodes, counts = keys[order], nodes[order], counts[order]
    label = np.arange(len(nodes))
    starts = range(0, len(nodes), tile)
    for i in starts:
        end = min(i + tile, len(nodes))
        for j in range(i, len(nodes), tile):
            stop = min(j + tile, len(nodes))
            if j > i:
                if keys[j] != keys[end - 1]:
                    break
                mine, other = counts[i:end][keys[i:end] == keys[j]], counts[j:stop][keys[j:stop] == keys[j]]
                if other[0] - mine[-1] > radius:
                    break  # later tiles of this key have larger counts still
            around = np.r_[label[i:end], label[j:stop]]
            if (around == around[0]).all():
                continue
            a, b = np.nonzero(np.bitwise_count(nodes[i:end, None] ^ nodes[j:stop]) <= radius)
            a, b = a + i, b + j
            apart = label[a] != label[b]
            if apart.any():
                a, b = label[a[apart]], label[b[apart]]
                names, at = np.unique(np.r_[a, b], return_inverse=True)
                least = names[roots(len(names), at[: len(a)], at[len(a) :])]
                new = np.arange(len(label))
                new[names] = least
                label = new[label]
    joined = np.flatnonzero(label != np.arange(len(label)))
    return nodes[joined], nodes[label[joined]]


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(u, v): links that join all distinct fingerprints within ``radius`` bits of each other."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    tables = list(combinations(range(blocks), blocks - radius))
    masks = [sum(((1 << cuts[p + 1]) - (1 << cuts[p])) for p in parts) for parts in tables]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select(F.explode(F.array(*(
        F.struct(F.lit(t).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"), F.col("fingerprint").alias("node"))
        for t, m in enumerate(signed)))).alias("x")).select("x.*")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def settle(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            table, key, node = rows
            _, key = np.unique(np.stack([table, key]), axis=1, return_inverse=True)
            u, v = tile_links(key.ravel(), node.view(np.uint64), radius, tile)
            return arrow.batch(u=arrow.signed(u), v=arrow.signed(v))

        for rows in batches:  # sorted: what may go on in the next batch is the last key
            held.append(tuple(arrow.longs_of(rows, c) for c in ("table", "key", "node")))
            if sum(len(x[0]) for x in held) < 4 * tile:
                continue
            every = tuple(np.concatenate(x) for x in zip(*held))
            new = (every[0] != every[0][-1]) | (every[1] != every[1][-1])
            upto = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
            held = [tuple(x[upto:] for x in every)]
            if upto:
                yield settle(tuple(x[:upto] for x in every))
        if held:
            yield settle(tuple(np.concatenate(x) for x in zip(*held)))

    keyed = keyed.withColumn("table", F.col("table").cast("long"))
    return keyed.repartition("table", "key").sortWithinPartitions("table", "key").mapInArrow(compare, "u long, v long").distinct()


def _members(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """fingerprint, the root of its component, and component_id."""
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    stars = connected(links(nodes.select("fingerprint"), radius, blocks))
    rooted = nodes.join(stars.withColumnRenamed("u", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("v", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "root", "component_id")


def _stored(prints: DataFrame) -> DataFrame:
    path = scratch_path(prints.sparkSession, "simhash")
    prints.write.parquet(path)
    return prints.sparkSession.read.schema(prints.schema).parquet(path)


def near_duplicates(documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the least doc_id that links lead to.

    Decided cases: a null or wordless text has fingerprint zero and is linked like any other. Rows that
    repeat an id or a text are rows of their own, in the same component if their fingerprints link. A null
    doc_id comes last: it is a component's id only if that has no other. Other columns are ignored. An empty
    table gives no rows.
    """
    prints = _stored(fingerprints(documents, size))
    members = _members(prints, radius, blocks)
    return prints.join(members, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """The documents, with all their columns, that come first in their component: one row of each.

    The first has the least doc_id, null last; of rows that share it, the least text hash. The columns
    __id and __text are used on the way.
    """
    order = {"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "__text": F.xxhash64("text")}
    docs = documents.withColumns(order)
    narrow = docs.select(F.col("__id").alias("doc_id"), "text", "__text")
    prints = _stored(fingerprints(narrow, size, keep="__text"))
    members = _members(prints, radius, blocks)
    firsts = prints.join(members, "fingerprint").groupBy("root").agg(F.min(F.struct("doc_id", "__text")).alias("x"))
    firsts = firsts.select(F.col("x.doc_id").alias("__id"), F.col("x.__text").alias("__text"))
    return docs.join(firsts, ["__id", "__text"], "left_semi").dropDuplicates(["__id", "__text"]).select(*documents.columns)
