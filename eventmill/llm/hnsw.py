"""Hierarchical navigable small-world graphs over unit vectors, in numpy.

Each layer holds the nodes whose level reaches it and links every node to near ones in differing directions. A
search starts in the top layer, goes down through the nearest nodes found, and in the lowest layer widens to a
beam. Many queries are searched side by side, a few steps of each at a time, so the work is done by arrays.
Nodes are inserted in batches no larger than the graph so far: each finds its neighbours in the graph and among
its batch, and is linked both ways. Layers are laid from the top, so a node's way down exists when it is inserted.
"""

from __future__ import annotations

import io

import numpy as np

LINKS, BUILD_BEAM, DOWN_BEAM, STARTS = 16, 64, 8, 4
_BATCH, _FIRST, _EXPAND = 1024, 512, 4
#: Marks of visited nodes that a search holds at once.
_MARKS = 1 << 25
_FAR = np.float32(-np.inf)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("id,id->i", a, b)


def _beam(vectors: np.ndarray, layer: tuple[np.ndarray, np.ndarray], queries: np.ndarray, starts: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the nodes found and their cosines, best first; -1 where there are no more."""
    row, links = layer
    n, k = len(queries), starts.shape[1]
    wide = max(wide, k)
    ids, near, done = np.full((n, wide), -1, np.int32), np.full((n, wide), _FAR), np.ones((n, wide), bool)
    mark = np.zeros((n, len(vectors)), np.int16)
    every = np.arange(n)
    for c in range(k):  # a start given twice counts once
        new = (mark[every, starts[:, c]] == 0) & (starts[:, c] >= 0)
        at = every[new]
        mark[at, starts[at, c]] = 1
        ids[at, c], near[at, c], done[at, c] = starts[at, c], _dots(queries[at], vectors[starts[at, c]]), False
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near, done = (np.take_along_axis(x, order, 1) for x in (ids, near, done))
    active = every
    while len(active):
        left = ~done[active]
        pick = left & (np.cumsum(left, axis=1) <= _EXPAND)
        done[active] |= pick
        columns = np.argsort(~pick, axis=1, kind="stable")[:, :_EXPAND]
        chosen = np.where(np.take_along_axis(pick, columns, 1), np.take_along_axis(ids[active], columns, 1), -1)
        around = links[row[chosen]].reshape(len(active), -1)
        around[np.repeat(chosen < 0, links.shape[1], axis=1)] = -1
        r, c = np.nonzero(around >= 0)
        new = mark[active[r], around[r, c]] == 0
        r, c = r[new], c[new]
        found = around[r, c]
        mark[active[r], found] = c + 1
        last = mark[active[r], found] == c + 1  # of a node met twice in this step, one
        r, c, found = r[last], c[last], found[last]
        cosines = np.full(around.shape, _FAR)
        cosines[r, c] = _dots(queries[active[r]], vectors[found])
        every_near = np.concatenate([near[active], cosines], axis=1)
        order = np.argsort(-every_near, axis=1, kind="stable")[:, :wide]
        ids[active] = np.take_along_axis(np.concatenate([ids[active], around], axis=1), order, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], np.zeros(around.shape, bool)], axis=1), order, 1)
        near[active] = np.take_along_axis(every_near, order, 1)
        empty = near[active] == _FAR
        ids[active] = np.where(empty, -1, ids[active])
        done[active] |= empty
        active = active[~done[active].all(axis=1)]
    return ids, near


def _spread(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, best first, up to ``most``: those nearer to it than to any taken, then the rest."""
    out = np.full((len(ids), most), -1, np.int32)
    for low in range(0, len(ids), 512):
        some, cosines = ids[low : low + 512], near[low : low + 512]
        at = vectors[some]
        between = at @ at.transpose(0, 2, 1)
        taken, closest, count = np.zeros(some.shape, bool), np.full(some.shape, _FAR), np.zeros(len(some), int)
        for c in range(some.shape[1]):
            ok = (some[:, c] >= 0) & (cosines[:, c] > closest[:, c]) & (count < most)
            taken[:, c] = ok
            count += ok
            closest = np.where(ok[:, None], np.maximum(closest, between[:, c]), closest)
        order = np.argsort(np.where(taken, 0, np.where(some >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        picked = np.take_along_axis(some, order, 1)
        out[low : low + 512, : picked.shape[1]] = picked
    return out


def _best(ids: np.ndarray, near: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-near, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def _link_back(vectors: np.ndarray, row: np.ndarray, links: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Links from the chosen neighbours to the new nodes; a node with too many keeps the best spread."""
    most = links.shape[1]
    r, c = np.nonzero(chosen >= 0)
    sources, targets = new[r], chosen[r, c]
    cosines = _dots(vectors[sources], vectors[targets])
    order = np.lexsort((-cosines, targets))
    sources, targets, cosines = sources[order], targets[order], cosines[order]
    nodes, first = np.unique(targets, return_index=True)
    rank = np.arange(len(targets)) - np.repeat(first, np.diff(np.r_[first, len(targets)]))
    group = np.searchsorted(nodes, targets)
    kept = rank < most
    more = np.full((len(nodes), int(rank[kept].max(initial=0)) + 1), -1, np.int32)
    more[group[kept], rank[kept]] = sources[kept]
    ids = np.concatenate([links[row[nodes]], more], axis=1)
    for low in range(0, len(nodes), 2048):
        some, own = ids[low : low + 2048], vectors[nodes[low : low + 2048]]
        near = np.where(some >= 0, np.einsum("id,icd->ic", own, vectors[some]), _FAR)
        some, near = _best(some, near, some.shape[1])
        over = (some >= 0).sum(axis=1) > most
        result = np.full((len(some), most), -1, np.int32)
        result[:, : min(most, some.shape[1])] = some[:, :most]
        if over.any():
            result[over] = _spread(vectors, some[over], near[over], most)
        links[row[nodes[low : low + 2048]]] = result


class Graph:
    """A graph over the rows of ``vectors`` (unit length, single precision); ``levels``: each row's top layer."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], entry: np.ndarray):
        self.vectors, self.layers, self.entry = vectors, layers, entry

    @classmethod
    def build(cls, vectors: np.ndarray, levels: np.ndarray) -> Graph:
        top = int(levels.max())
        graph = cls(vectors, [], np.flatnonzero(levels == top)[:STARTS].astype(np.int32))
        for level in range(top, -1, -1):
            graph._lay(np.flatnonzero(levels >= level).astype(np.int32))
        return graph

    def _lay(self, nodes: np.ndarray) -> None:
        row = np.full(len(self.vectors), -1, np.int32)
        row[nodes] = np.arange(len(nodes))
        links = np.full((len(nodes), 2 * LINKS), -1, np.int32)
        begin = 0
        while begin < len(nodes):
            new = nodes[begin : begin + (_FIRST if not begin else min(_BATCH, begin))]
            among = self.vectors[new] @ self.vectors[new].T
            among[np.arange(len(new)), np.arange(len(new))] = _FAR
            ids, near = np.broadcast_to(new, among.shape), among
            ids, near = _best(ids, near, BUILD_BEAM)
            if begin:
                starts = self._down(self.vectors[new], nodes[:1])
                starts = np.where(row[starts] < begin, starts, nodes[0])  # upper nodes may not be in yet
                older, nearer = self._wide((row, links), self.vectors[new], starts, BUILD_BEAM)
                ids, near = _best(np.concatenate([older, ids], axis=1), np.concatenate([nearer, near], axis=1), BUILD_BEAM)
            ids = np.where(near == _FAR, -1, ids)
            chosen = _spread(self.vectors, ids, near, LINKS)
            links[row[new], :LINKS] = chosen
            _link_back(self.vectors, row, links, new, chosen)
            begin += len(new)
        self.layers.append((row, links))

    def _wide(self, layer: tuple[np.ndarray, np.ndarray], queries: np.ndarray, starts: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
        step = max(16, min(512, _MARKS // len(self.vectors)))
        found = [_beam(self.vectors, layer, queries[at : at + step], starts[at : at + step], wide) for at in range(0, len(queries), step)]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _down(self, queries: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Where to start in the next layer."""
        starts = np.tile(self.entry if self.layers else entry, (len(queries), 1))
        for layer in self.layers:
            ids, _ = self._wide(layer, queries, starts, DOWN_BEAM)
            starts = np.where(ids[:, :STARTS] < 0, ids[:, :1], ids[:, :STARTS])
        return starts

    def search(self, queries: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes within a beam of that width, best first, and their cosines."""
        lowest, self.layers = self.layers[-1], self.layers[:-1]
        try:
            starts = self._down(queries, self.entry)
        finally:
            self.layers = [*self.layers, lowest]
        return self._wide(lowest, queries, starts, wide)

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, entry=self.entry, **{f"{kind}{i}": x for i, layer in enumerate(self.layers) for kind, x in zip(("row", "links"), layer)})
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes, vectors: np.ndarray) -> Graph:
        with np.load(io.BytesIO(data)) as kept:
            layers = [(kept[f"row{i}"], kept[f"links{i}"]) for i in range((len(kept.files) - 1) // 2)]
            return cls(vectors, layers, kept["entry"])


def levels_of(hashes: np.ndarray) -> np.ndarray:
    """Each node's top layer, from a random-looking number of its own: a layer holds a LINKS-th of the one below."""
    chance = (hashes.view(np.uint64) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.floor(-np.log(np.maximum(chance, 2.0**-53)) / np.log(LINKS)).astype(np.int64)
