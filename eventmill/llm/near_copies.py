"""Groups of documents whose five-word shingles are the same for at least four in five (Jaccard similarity).

A text's SimHash fingerprint has as many 64-bit words as its keys need: the first word takes the shingles' hashes, each
other one these hashes mixed anew. The bits are cut into keys of a few bits, and texts meet where a key is equal. Two
sets of similarity 0.8 differ in 9.7 of 64 bits on average, and at worst, sets of four and five, in 12. There are
as many keys as it takes for such a pair to share none at most MISSED times. With more documents keys have more bits,
so that of unrelated texts some BUCKET at most meet on one, and there are more of them.

The nodes of a key are compared by size, exclusive-or and bit counts: the first word within RADIUS bits (a pair of
similarity 0.8 lies beyond it about once in a million; sets of four and five shingles once in some 7000), the first
NEAR_WORDS within NEAR. A task hands on links that join what is near, not all near pairs; a key of more than BUCKET nodes
is cut into tiles, and each pair of tiles is a task. Equal texts are one node.

These links are compared exactly, on the whole sets. Where one of them does not hold, the components that it would have
joined are pooled, and the nodes of a pool are compared in tiles: each brings its shingle set along once for a
pool of one tile, and once for each tile of a larger one. A task takes a pair of tiles, goes through them by the
bit counts of the fingerprints, passes over what is already joined, and hands on the links that join components.
What is near but lies in different components always shares a pool. So pairs are never rows; the comparisons of a
pool, and its sets that are sent, grow with the square of its tiles only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import arrow
from .components import connected
from .hashing import groups, mix
from .simhash import SEED, majorities, shingle_hashes
from .workspace import Scratch, ship

SHINGLE, RADIUS = 5, 24
#: Words of the fingerprint that go along with a key, and the bits in which those of near texts differ at most: similar
#: sets of four and five differ in 48 on average and in more than that once in a million, unrelated texts in 128.
NEAR_WORDS, NEAR = 4, 78
#: How often similar sets may share no key, at the share of equal bits of the worst of them (sets of four and five).
MISSED, EQUAL_BITS = 4e-6, 0.8125
#: Nodes of a key that one task compares; keys have LEAST_BITS at least.
BUCKET, LEAST_BITS = 1 << 16, 4
#: The least similarity, as a fraction.
SAME, OF = 4, 5
#: Shingles of a tile; a node counts as NODE more. It bounds a task's memory, not what is compared.
TILE, NODE = 1 << 20, 64
#: Fingerprints compared at once with all that follow them.
BLOCK = 256
#: Of a key's nodes, those that a block is compared with at once.
SPAN = 1 << 12
_LAST = (1 << 63) - 1


def key_layout(documents: int, bucket: int = BUCKET) -> tuple[int, int]:
    """How many keys a fingerprint is cut into, and of how many bits each."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, documents) / bucket)))
    return math.ceil(math.log(MISSED) / math.log1p(-(EQUAL_BITS**bits))), bits


def wide_prints(hashes: np.ndarray, sizes: np.ndarray, words: int) -> np.ndarray:
    """A row of that many SimHash words for each stretch of hashes."""
    salts = mix(np.arange(1, words, dtype=np.uint64))
    return np.stack([majorities(hashes, sizes), *(majorities(mix(hashes ^ s), sizes) for s in salts)], axis=1)


def bit_keys(prints: np.ndarray, keys: int, bits: int) -> np.ndarray:
    """The fingerprints' bits, that many a key, in a row of keys each; the key's number stands above its bits."""
    flat = np.unpackbits(np.ascontiguousarray(prints.astype(">u8")).view(np.uint8).reshape(len(prints), -1), axis=1)
    cut = flat[:, : keys * bits].reshape(len(prints), keys, bits)
    return cut @ (1 << np.arange(bits, dtype=np.int64)) + (np.arange(keys, dtype=np.int64) << bits)


def _shingles(text: bytes) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, SHINGLE, SEED), dtype=np.uint64))


def _prints(documents: DataFrame, keys: int, bits: int) -> DataFrame:
    """(node, print, more, size, keys) of each text: its set's fingerprint (the first word, those after it that go along
    with a key), number of shingles, and keys."""
    ship(documents.sparkSession)
    words = max(NEAR_WORDS, -(-keys * bits // 64))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, nodes = arrow.bytes_of(rows, "text"), arrow.longs_of(rows, "node")
            for low, high in groups([len(t) for t in texts]):
                sets = [_shingles(t) for t in texts[low:high]]
                sizes = np.array([len(x) for x in sets])
                wide = wide_prints(np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]), sizes, words)
                more = pa.array(arrow.signed(wide[:, 1:NEAR_WORDS].copy()).ravel())
                cut = pa.array(bit_keys(wide, keys, bits).ravel())
                yield arrow.batch(node=nodes[low:high], print=arrow.signed(wide[:, 0].copy()), more=_rows(more, len(sets), NEAR_WORDS - 1),
                                  size=sizes.astype(np.int64), keys=_rows(cut, len(sets), keys))

    schema = "node long, print long, more array<long>, size long, keys array<long>"
    return documents.select("node", "text").mapInArrow(prints, schema)


def _rows(values: pa.Array, rows: int, width: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), values)


def _sets(documents: DataFrame) -> DataFrame:
    """(node, shingles) of each text."""
    ship(documents.sparkSession)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, nodes = arrow.bytes_of(rows, "text"), rows.column("node")
            for low, high in groups([len(t) for t in texts]):
                found = [_shingles(t).view(np.int64) for t in texts[low:high]]
                yield arrow.batch(node=nodes.slice(low, high - low), shingles=pa.array(found, pa.list_(pa.int64())))

    return documents.select("node", "text").mapInArrow(sets, "node long, shingles array<long>")


def _enough(same: Column, a: Column, b: Column) -> Column:
    """Whether sets of a and b shingles, ``same`` of them shared, are similar enough; empty ones are."""
    return same * OF >= (a + b - same) * SAME


def near_links(nodes: np.ndarray, prints: np.ndarray, sizes: np.ndarray, tiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all components of near fingerprints (rows of NEAR_WORDS) of one tile, or of two tiles across."""
    order = np.lexsort((nodes, sizes))
    nodes, prints, sizes, tiles = nodes[order], prints[order], sizes[order], tiles[order]
    first = np.ascontiguousarray(prints[:, 0])
    ends = np.searchsorted(sizes * SAME, sizes * OF, side="right")
    across = (tiles != tiles[:1]).any()
    label = np.arange(len(nodes))
    members = {}  # of the labels that have several
    u, v = [], []
    for low in range(0, len(nodes), BLOCK):
        high = min(low + BLOCK, len(nodes))
        for start in range(low, int(ends[high - 1]), SPAN):
            stop = min(start + SPAN, int(ends[high - 1]))
            joined = label[start:stop]
            if label[low] == joined[0] and (label[low:high] == label[low]).all() and (joined == label[low]).all():
                continue
            close = np.bitwise_count(first[low:high, None] ^ first[start:stop]) <= RADIUS
            a, b = np.divmod(np.flatnonzero(close), stop - start)
            a, b = a + low, b + start
            fit = (a < b) & (b < ends[a]) & (label[a] != label[b])
            if across:
                fit &= tiles[a] != tiles[b]
            a, b = a[fit], b[fit]
            fit = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1) <= NEAR
            a, b = a[fit], b[fit]
            while len(a):  # the first node that has one to join joins all of its own
                row = a[0]
                own = b[: np.searchsorted(a, row, side="right")]
                names, at = np.unique(label[own], return_index=True)
                u += [row] * len(names)
                v += own[at].tolist()
                parts = [members.pop(x, [x]) for x in (int(label[row]), *names.tolist())]
                root = max(range(len(parts)), key=lambda x: len(parts[x]))
                name, whole = int((label[row], *names)[root]), parts.pop(root)
                for group in parts:
                    label[group] = name
                    whole += group
                members[name] = whole
                apart = label[a] != label[b]
                a, b = a[apart], b[apart]
    return nodes[np.array(u, dtype=np.int64)], nodes[np.array(v, dtype=np.int64)]


def _near(prints: DataFrame, bucket: int) -> DataFrame:
    """(u, v): links that join all that is near on a key."""
    ship(prints.sparkSession)
    keyed = prints.select("node", "print", "more", "size", F.explode("keys").alias("key"))
    large = keyed.groupBy("key").count().where(F.col("count") > bucket)  # few rows: nodes times keys, over bucket, at most
    large = large.select("key", F.ceil(F.col("count") / bucket).alias("tiles"))
    dealt = keyed.join(F.broadcast(large), "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1).cast("long")))
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "node", "print", "more", "size")

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        nodes, first, sizes, tiles = (rows.column(c).to_numpy() for c in ("node", "print", "size", "tile"))
        more = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in rows.column("more").chunks])
        wide = np.column_stack([first, more.reshape(len(first), -1)]).view(np.uint64)
        u, v = near_links(nodes, wide, sizes, tiles)
        return pa.table({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "u long, v long").distinct()


def _similar(near: DataFrame, documents: DataFrame, scratch: Scratch) -> DataFrame:
    """Of the near (u, v), those similar enough; stored."""
    nodes = near.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = scratch.store(_sets(documents.join(nodes, "node", "left_semi").dropDuplicates(["node"])), "near-copy-sets")
    mine, other = (sets.select(F.col("node").alias(end), F.col("shingles").alias(name)) for end, name in (("u", "a"), ("v", "b")))
    met = near.join(mine, "u").join(other, "v")
    links = met.where(_enough(F.size(F.array_intersect("a", "b")), F.size("a"), F.size("b"))).select("u", "v")
    links = scratch.store(links, "near-copy-links")
    scratch.remove("near-copy-sets")
    return links


def tile_links(
    nodes: np.ndarray, roots: np.ndarray, prints: np.ndarray, tiles: np.ndarray, values: np.ndarray, sizes: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all components of similar nodes of one tile, or of two tiles across.

    ``values``: the shingles of all nodes, one node after the other, ``sizes`` of them each.
    """
    _, names, often = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    names, owner = names[often[names] > 1], owner[often[names] > 1]  # what nobody shares links nobody
    shared = np.bincount(owner, minlength=len(sizes))
    starts = np.cumsum(shared) - shared
    counts = np.bitwise_count(prints).astype(np.int16)
    able = np.flatnonzero(shared * OF >= sizes * SAME)
    order = able[np.lexsort((nodes[able], counts[able]))]
    _, label = np.unique(roots, return_inverse=True)
    members = {x: [] for x in range(label.max(initial=-1) + 1)}
    for at, x in enumerate(label.tolist()):
        members[x].append(at)
    ends = np.searchsorted(counts[order], counts[order] + RADIUS, side="right")
    across = (tiles != tiles[:1]).any()
    mark = np.zeros(len(often), dtype=bool)
    u, v = [], []
    for low in range(0, len(order), BLOCK):
        rows = order[low : low + BLOCK]
        others = order[low : ends[min(low + BLOCK, len(order)) - 1]]
        close = np.bitwise_count(prints[rows, None] ^ prints[others]) <= RADIUS
        close &= np.minimum(sizes[rows, None], sizes[others]) * OF >= np.maximum(sizes[rows, None], sizes[others]) * SAME
        if across:
            close &= tiles[rows, None] != tiles[others]
        for k, row in enumerate(rows.tolist()):
            met = others[k + 1 :][close[k, k + 1 :]]
            met = met[label[met] != label[row]]
            if not len(met):
                continue
            mark[names[starts[row] : starts[row] + shared[row]]] = True
            runs = np.cumsum(shared[met]) - shared[met]
            places = np.arange(shared[met].sum()) + np.repeat(starts[met] - runs, shared[met])
            same = np.bincount(np.repeat(np.arange(len(met)), shared[met]), mark[names[places]], len(met)).astype(np.int64)
            mark[names[starts[row] : starts[row] + shared[row]]] = False
            for other in met[same * OF >= (sizes[row] + sizes[met] - same) * SAME].tolist():
                a, b = sorted((int(label[row]), int(label[other])), key=lambda x: len(members[x]))
                if a != b:
                    u.append(row), v.append(other)
                    label[members[a]] = b
                    members[b] += members.pop(a)
    return nodes[np.array(u, dtype=np.int64)], nodes[np.array(v, dtype=np.int64)]


def _across(near: DataFrame, rooted: DataFrame, prints: DataFrame, documents: DataFrame, tile: int, scratch: Scratch) -> DataFrame:
    """Links among the nodes of components that near (u, v) would join; stored."""
    ship(near.sparkSession)
    ends = near.join(rooted.toDF("u", "u_root"), "u", "left").join(rooted.toDF("v", "v_root"), "v", "left")
    ends = ends.select(F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v"))
    joined = connected(ends)
    pools = joined.unionByName(joined.select(F.col("v").alias("u"), "v").distinct()).toDF("root", "pool")
    nodes = near.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(rooted, "node", "left")
    pools = nodes.select("node", F.coalesce("root", "node").alias("root")).join(pools, "root").join(prints.select("node", "print", "size"), "node")
    pools = scratch.store(pools, "near-copy-pools")
    wide = pools.groupBy("pool").agg(F.ceil(F.sum(F.col("size") + NODE) / tile).alias("tiles"))
    dealt = pools.join(wide, "pool").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.select("*", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    sets = _sets(documents.join(pools.select("node"), "node", "left_semi").dropDuplicates(["node"]))

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        nodes, roots, prints, tiles = (rows.column(c).to_numpy() for c in ("node", "root", "print", "tile"))
        sets = rows.column("shingles")
        values = [x.flatten().to_numpy(zero_copy_only=False) for x in sets.chunks]
        sizes = np.concatenate([np.diff(x.offsets.to_numpy()) for x in sets.chunks]).astype(np.int64)
        u, v = tile_links(nodes, roots, prints.view(np.uint64), tiles, np.concatenate(values), sizes)
        return pa.table({"u": u, "v": v})

    found = dealt.join(sets, "node").groupBy("pool", "i", "j").applyInArrow(compare, "u long, v long")
    found = scratch.store(found, "near-copy-more")
    scratch.remove("near-copy-pools")
    return found


def _components(documents: DataFrame, tile: int, bucket: int) -> DataFrame:
    """(node, root) of each node that is similar to another."""
    scratch = Scratch(documents.sparkSession)
    keys, bits = key_layout(documents.count(), bucket)
    prints = scratch.store(_prints(documents, keys, bits).dropDuplicates(["node"]), "near-copy-prints")
    near = scratch.store(_near(prints, bucket), "near-copy-pairs")
    links = _similar(near, documents, scratch)
    rooted = connected(links).toDF("node", "root")
    more = _across(near, rooted, prints, documents, tile, scratch)
    found = connected(links.unionByName(more))
    scratch.remove("near-copy-prints", "near-copy-pairs", "near-copy-links", "near-copy-more")
    return found.toDF("node", "root")


def keep_one(documents: DataFrame, tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """The documents, with all their columns, that come first in their component: one row of each.

    The first has the least doc_id, null last; of rows that share it, the least text hash. A null text is
    wordless, and wordless texts are similar to each other. A text of fewer words than a shingle is a
    shingle by itself. Columns may have any names: they are carried along as one.
    """
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    docs = documents.select(F.struct("*").alias("row"), order.alias("__id"), F.xxhash64("text").alias("__text"))
    narrow = docs.select("__id", F.col("__text").alias("node"), F.col("row.text").alias("text"))
    rooted = _components(narrow, tile, bucket)
    members = narrow.groupBy("node").agg(F.min("__id").alias("__id"))
    members = members.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = members.groupBy("root").agg(F.min(F.struct("__id", "node")).alias("x"))
    firsts = firsts.select(F.col("x.__id").alias("__id"), F.col("x.node").alias("__text"))
    return docs.join(firsts, ["__id", "__text"], "left_semi").dropDuplicates(["__id", "__text"]).select("row.*")
