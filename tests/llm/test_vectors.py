"""Small-world graphs and embedding near-dedup, against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from eventmill.llm import embedding_dedup
from eventmill.llm.embedding_dedup import Shard, near_duplicates, search, unit_rows
from eventmill.llm.hnsw import Graph, levels_of

SCHEMA = "vec_id long, embedding array<float>"
CLASHES = ("h1", "h2", "vector", "usable", "node", "copies", "least", "root", "n_links", "component_id", "kept", "label")


def table(spark, rows):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.select("*", *(F.lit(1).alias(c) for c in CLASHES))


def planted(n, wide=24, groups=12, dense=60, seed=5):
    """Random vectors, small groups of near copies, exact and scaled copies, one dense group, a chain."""
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=wide) for _ in range(n)]
    for g in range(groups):
        rows += [rows[g] + rng.normal(size=wide) * 0.05 for _ in range(3)]
    rows += [rows[3].copy(), rows[3].copy(), rows[4] * 2]
    centre = rng.normal(size=wide)
    rows += [centre + rng.normal(size=wide) * 0.1 for _ in range(dense)]
    turn = math.acos(0.93)
    rows += [np.r_[math.cos(turn * i), math.sin(turn * i), np.zeros(wide - 2)] for i in range(6)]
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(rows)]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, cosine=0.9):
    good = [i for i, (_, v) in enumerate(rows) if usable(v)]
    links = {i: set() for i in range(len(rows))}
    unit = {i: np.array(rows[i][1], dtype=np.float64) for i in good}
    unit = {i: v / np.abs(v).max() for i, v in unit.items()}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    for a in good:
        links[a] = {b for b in good if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine}
    out = []
    for i, (name, _) in enumerate(rows):
        seen, left = {i}, [i]
        while left:
            for b in links[left.pop()] - seen:
                seen.add(b)
                left.append(b)
        least = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((name, len(links[i]), least, name == least))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def shard(vectors, first=0):
    vectors = unit_rows(np.asarray(vectors, dtype=np.float64))
    hashes = np.random.default_rng(9).integers(0, 1 << 63, len(vectors), dtype=np.int64) * 2
    graph = Graph.build(vectors.astype(np.float32), levels_of(hashes))
    return Shard(np.arange(first, first + len(vectors)), np.ones(len(vectors), np.int64), vectors, graph)


def test_graph_finds_nearest_nodes():
    rng = np.random.default_rng(1)
    one = shard(rng.normal(size=(3000, 16)))
    ids, near = one.graph.search(one.vectors[:300].astype(np.float32), 64)
    exact = np.argsort(-(one.vectors[:300] @ one.vectors.T), axis=1)[:, :10]
    recall = np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids, exact)])
    assert recall >= 0.9
    assert (ids[:, 0] == np.arange(300)).mean() > 0.99 and (np.diff(near, axis=1) <= 0).all()
    assert all(len(set(row)) == len(row) for row in ids.tolist())
    assert len(one.graph.layers) >= 3 and all((links >= 0).sum(axis=1).max() <= links.shape[1] for _, links in one.graph.layers)


def test_graph_is_the_same_after_packing():
    one = shard(np.random.default_rng(2).normal(size=(700, 8)))
    again = Graph.unpacked(one.graph.packed(), one.graph.vectors)
    queries = one.vectors[:50].astype(np.float32)
    assert all((a == b).all() for a, b in zip(one.graph.search(queries, 32), again.search(queries, 32)))


def test_tiny_graphs():
    for n in (1, 2, 5):
        one = shard(np.eye(8)[:n])
        ids, _ = one.graph.search(one.vectors.astype(np.float32), 4)
        assert (ids[:, 0] == np.arange(n)).all()


def test_beam_widens_until_the_audit_passes():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4000, 96))
    near = base + rng.normal(size=base.shape) * 0.35
    one, two = shard(base), shard(near, first=4000)
    a, b, scanned, wide = search(one, two, beam=2, audited=500)
    truth = set(zip(*(x.tolist() for x in np.nonzero(one.vectors @ two.vectors.T >= 0.9))))
    assert wide > 2 and len(truth) > 1000
    got = set(zip(a.tolist(), b.tolist())) | {(x, y) for x, y in truth if x in set(scanned.tolist())}
    assert got <= truth and len(got) >= 0.97 * len(truth)


def test_full_beams_are_scanned():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    one = shard(np.r_[centre + rng.normal(size=(300, 32)) * 0.05, rng.normal(size=(1500, 32))])
    a, _, scanned, _ = search(one, one, beam=32)
    assert set(range(300)) <= set(scanned.tolist()) and not set(a.tolist()) & set(scanned.tolist())


@pytest.mark.parametrize("shards", [1, 3])
def test_rows_equal_brute_force(spark, shards):
    rows = planted(500)
    assert found(near_duplicates(table(spark, rows), shards=shards)) == brute(rows)


def test_dense_group_over_tasks(spark, monkeypatch):
    rows = planted(300, groups=4, dense=250)
    assert found(near_duplicates(table(spark, rows), shards=2, beam=8)) == brute(rows)


def test_shards_are_bounded_in_bytes(spark):
    rows = planted(200)
    made = []
    plain = embedding_dedup._graphs
    try:
        embedding_dedup._graphs = lambda classes, shards: made.append(shards) or plain(classes, shards)
        assert found(near_duplicates(table(spark, rows), shards=1, shard_bytes=10_000)) == brute(rows)
    finally:
        embedding_dedup._graphs = plain
    assert made == [math.ceil(8 * 24 * len({tuple(v) for _, v in rows}) / 10_000)]


def test_odd_vectors(spark):
    one, big = [1.0, 0.0, 0.0], [3e38, 3e38, 0.0]
    rows = [
        (1, one), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]), (6, [float("nan"), 1.0, 0.0]),
        (7, [float("inf"), 0.0, 0.0]), (8, [2.0, 0.0, 0.0]), (8, [2.0, 0.0, 0.0]), (9, [1.0, 0.0]), (10, [-1.0, 0.0, 0.0]),
        (None, one), (None, None), (None, [0.0, 0.0, 1.0]), (11, big), (12, [1e-38, 1e-38, 0.0]), (13, [2.0, 0.0, 0.0]), (13, [0.0, 1.0, 0.0]),
    ]
    assert found(near_duplicates(table(spark, rows))) == brute(rows)


def test_no_rows(spark):
    assert near_duplicates(table(spark, [])).collect() == []
