"""Near duplicates among embeddings: small-world graphs per shard, every shard queried, links verified.

Equal vectors are one node with a count. Nodes are dealt over shards by a hash, a graph is built per shard by
one task, and each pair of shards is one task that searches either shard's nodes in the other's graph. A search
starts with a narrow beam. Nodes whose whole beam is linked are compared with the shard outright, since more
links may lie beyond it; for the rest, an evenly spread audit set is compared with the shard too, and the beam
is doubled until the links found by the searches reach the wanted share of the audited ones.

Every link is verified by its cosine in double precision. A task doesn't hand links on but what follows from
them: how many each node has, and a star for each group that they join. So a group of n near copies costs 2n
rows a task instead of n x n, and components come from the union of the stars.

The number of shards stays the same until shards would outgrow their size in bytes, so a node is compared along
few graphs whatever their size, and a task holds two shards at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from .components import connected
from .hnsw import Graph, levels_of
from .simhash import roots
from .workspace import ship

COSINE = 0.9
SHARDS, SHARD_BYTES = 4, 64 << 20
BEAM, AUDITED, RECALL = 32, 512, 0.99
#: What single precision may take from a cosine.
_SLACK = 1e-4
#: Cosines that a comparison holds at once.
_TILE = 1 << 22


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; none of them is zero."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no square over- or underflows
    return rows / np.sqrt(np.einsum("id,id->i", rows, rows))[:, None]


@dataclass
class Shard:
    """A part of the nodes: their names, copies, vectors of length one, and graph."""

    node: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    graph: Graph

    @classmethod
    def unpacked(cls, row: dict) -> Shard:
        node, copies = (np.frombuffer(row[c], dtype=np.int64) for c in ("node", "copies"))
        vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(node), -1)
        return cls(node, copies, vectors, Graph.unpacked(row["graph"], vectors.astype(np.float32)))


# Search


def _blocks(rows: np.ndarray, against: int) -> Iterator[np.ndarray]:
    step = max(1, _TILE // max(1, against))
    for at in range(0, len(rows), step):
        yield rows[at : at + step]


def _scan(of: Shard, to: Shard, rows: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All links of some rows of one shard to the rows of another, a block at a time."""
    for some in _blocks(rows, len(to.node)):
        a, b = np.nonzero(of.vectors[some] @ to.vectors.T >= cosine)
        a = some[a]
        apart = of.node[a] != to.node[b]
        yield a[apart], b[apart]


def _looked_up(of: Shard, to: Shard, wide: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links found within beams of that width, verified; and the rows that may have more."""
    a, b, full = [], [], []
    queries = of.vectors.astype(np.float32)
    for low in range(0, len(queries), 1 << 14):  # nothing grows with the shard but what is found
        ids, near = to.graph.search(queries[low : low + (1 << 14)], wide)
        full.append(low + np.flatnonzero(near[:, -1] >= cosine - _SLACK))
        r, c = np.nonzero(near >= cosine - _SLACK)
        a.append(low + r)
        b.append(ids[r, c])
    a, b = np.concatenate(a), np.concatenate(b)
    sure = np.concatenate([np.zeros(0, bool), *(
        np.einsum("id,id->i", of.vectors[a[x]], to.vectors[b[x]]) >= cosine for x in _blocks(np.arange(len(a)), 64))])
    apart = sure & (of.node[a] != to.node[b])
    return a[apart], b[apart], np.concatenate(full)


def search(of: Shard, to: Shard, cosine: float = COSINE, beam: int = BEAM, audited: int = AUDITED, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Links (row, row) found from one shard in another's graph; rows still to be scanned; the beam it took.

    No link of a row to be scanned is handed out. The beam ends at a quarter of the shard: then all are scanned.
    """
    sample = np.unique(np.linspace(0, len(of.node) - 1, min(audited, len(of.node))).astype(np.int64))
    truth = [np.concatenate(x) for x in zip(*_scan(of, to, sample, cosine))]
    wide = beam
    while 4 * wide <= len(to.node):
        a, b, full = _looked_up(of, to, wide, cosine)
        scanned = np.zeros(len(of.node), bool)
        scanned[full] = True
        a, b = a[~scanned[a]], b[~scanned[a]]
        known = truth[0][~scanned[truth[0]]]
        hit = np.isin(a, sample).sum()
        if hit >= recall * len(known):
            return a, b, np.flatnonzero(scanned), wide
        wide *= 2
    none = np.zeros(0, np.int64)
    return none, none, np.arange(len(of.node)), wide


class Found:
    """Links among the rows of one or two shards, summed up as they come: how many a row has, what they join."""

    def __init__(self, one: Shard, two: Shard | None, cosine: float):
        self.one, self.two, self.cosine = one, two or one, cosine
        self.inner = two is None
        self.shift = 0 if self.inner else len(one.node)
        n = len(one.node) + (0 if self.inner else len(two.node))
        self.links, self.label = np.zeros(n, np.int64), np.arange(n)

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        apart = a != b
        if apart.any():
            names, at = np.unique(np.r_[a[apart], b[apart]], return_inverse=True)
            half = len(at) // 2
            new = np.arange(len(self.label))
            new[names] = names[roots(len(names), at[:half], at[half:])]
            self.label = new[self.label]

    def _count(self, a: np.ndarray, copies: np.ndarray) -> None:
        np.add.at(self.links, a, copies)

    def add(self, **tuning) -> None:
        one, two, shift = self.one, self.two, self.shift
        a, b, all_one, _ = search(one, two, self.cosine, **tuning)
        pairs = [a * len(two.node) + b]
        if self.inner:
            pairs.append(b * len(two.node) + a)
            all_two = all_one
        else:
            b, a, all_two, _ = search(two, one, self.cosine, **tuning)
            pairs.append(a * len(two.node) + b)
        whole_one, whole_two = np.zeros(len(one.node), bool), np.zeros(len(two.node), bool)
        whole_one[all_one], whole_two[all_two] = True, True
        a, b = np.divmod(np.unique(np.concatenate(pairs)), len(two.node))
        sparse = ~(whole_one[a] | whole_two[b])
        a, b = a[sparse], b[sparse]
        if not self.inner:
            self._count(b + shift, one.copies[a])
        self._count(a, two.copies[b])
        self._join(a, b + shift)
        for a, b in _scan(one, two, all_one, self.cosine):
            self._count(a, two.copies[b])
            rest = ~whole_two[b]  # the others scan for themselves
            self._count(b[rest] + shift, one.copies[a[rest]])
            self._join(a, b + shift)
        if not self.inner:
            for b, a in _scan(two, one, all_two, self.cosine):
                self._count(b + shift, one.copies[a])
                rest = ~whole_one[a]
                self._count(a[rest], two.copies[b[rest]])
                self._join(a, b + shift)

    def rows(self) -> pa.Table:
        """(u, null, n): u has n links here; (u, v, 0): u and v belong together."""
        node = self.one.node if self.inner else np.r_[self.one.node, self.two.node]
        linked, joined = np.flatnonzero(self.links), np.flatnonzero(self.label != np.arange(len(self.label)))
        return pa.table({
            "u": pa.array(np.r_[node[linked], node[joined]]),
            "v": pa.concat_arrays([pa.nulls(len(linked), pa.int64()), pa.array(node[self.label[joined]])]),
            "n": pa.array(np.r_[self.links[linked], np.zeros(len(joined), np.int64)])})


# Spark


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _classes(rows: DataFrame) -> DataFrame:
    """A row for each different vector: node, hashes, copies, least id, vector."""
    return rows.where("usable").groupBy("h1", "h2").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"),
    ).withColumn("node", F.monotonically_increasing_id())


def _graphs(classes: DataFrame, shards: int) -> DataFrame:
    def build(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("h1").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        node, copies, h1 = (rows.column(c).to_numpy() for c in ("node", "copies", "h1"))
        vectors = unit_rows(rows.column("vector").combine_chunks().flatten().to_numpy().reshape(len(node), -1))
        graph = Graph.build(vectors.astype(np.float32), levels_of(np.ascontiguousarray(rows.column("h2").to_numpy())))
        return pa.table({
            "wide": rows.column("wide")[:1], "shard": rows.column("shard")[:1],
            **{k: pa.array([v], pa.binary()) for k, v in (("node", node.tobytes()), ("copies", copies.tobytes()), ("vectors", vectors.tobytes()), ("graph", graph.packed()))}})

    dealt = classes.select("node", "copies", "h1", "h2", "vector", F.size("vector").alias("wide"), F.pmod("h1", F.lit(shards)).cast("int").alias("shard"))
    return dealt.groupBy("wide", "shard").applyInArrow(
        build, "wide int, shard int, node binary, copies binary, vectors binary, graph binary")


def _links(graphs: DataFrame, shards: int, cosine: float, tuning: dict) -> DataFrame:
    def compare(rows: pa.Table) -> pa.Table:
        parts = [Shard.unpacked(row) for row in sorted(rows.to_pylist(), key=lambda r: r["shard"])]
        first, second = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
        if first != second and len(parts) < 2:  # the other shard holds no vector
            return pa.table({c: pa.array([], pa.int64()) for c in "uvn"})
        found = Found(parts[0], parts[1] if first != second else None, cosine)
        found.add(**tuning)
        return found.rows()

    pairs = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumns(
        {"a": F.least("shard", "other"), "b": F.greatest("shard", "other")})
    return pairs.groupBy("wide", "a", "b").applyInArrow(compare, "u long, v long, n long")


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, shards: int = SHARDS, shard_bytes: int = SHARD_BYTES, **tuning
) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of (vec_id, embedding).

    Rows link if their cosine is at least ``cosine``. n_links: other rows linked directly; component_id: the
    least vec_id that links lead to; kept: whether that is the row's own. ``tuning``: see ``search``.

    Decided cases: a vector that is null, empty or zero, or holds a null or a value that isn't finite, links
    with nothing, and so do vectors of different lengths. Rows that repeat an id or a vector are rows of their
    own. A null vec_id comes last: it is a component's id only if that has no other, and its row is kept only
    then. Other columns are ignored. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    ship(spark)
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"), usable.alias("usable"))
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    classes = _stored(_classes(rows), "vectors")
    size = classes.agg(F.sum(8 * F.size("vector"))).first()[0] or 0
    shards = max(shards, math.ceil(size / shard_bytes))
    graphs = _stored(_graphs(classes, shards), "graphs")
    links = _stored(_links(graphs, shards, cosine, tuning), "vector-links")
    counts = links.where("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    stars = connected(links.where("v is not null").select("u", "v"))
    nodes = classes.select("node", "h1", "h2", "copies", "least").join(counts.withColumnRenamed("u", "node"), "node", "left")
    nodes = nodes.join(stars.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    known = nodes.join(least, "root").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where("usable").select("vec_id", "h1", "h2").join(known, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
