"""A hierarchical navigable small-world graph over one shard of unit vectors, in numpy.

Layer 0 holds all vectors, each higher layer about one in ``M`` of the one
below. A search goes down greedily from the top and keeps a beam of the best
``ef`` on layer 0. Many searches run side by side: each step takes the best
unexpanded vectors of every beam at once. Vectors enter the graph in batches
that at most double it; those of a batch see what stands already by such
searches, and one another directly.

Levels come from a hash of the vectors' numbers, so the same shard gives the
same graph on every machine.
"""

from __future__ import annotations

import numpy as np

from lectern.llm import kit

#: Edges of a vector on the upper layers and on layer 0; width of the beam while building.
M, M0, BUILD = 16, 32, 48
BATCH = 512
#: Beam entries that one step expands.
STEP = 4


def _selected(x: np.ndarray, cand: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (best first, -1: none) those nearer to the row than to a chosen one, filled up with the best others."""
    rows, width = cand.shape
    near = np.einsum("rid,rjd->rij", v := x[np.maximum(cand, 0)], v)
    chosen, count = np.zeros((rows, width), bool), np.zeros(rows, np.int64)
    for j in range(width):
        crowded = np.where(chosen, near[:, j, :], -2.0).max(axis=1) > sims[:, j]
        take = (cand[:, j] >= 0) & ~crowded & (count < most)
        chosen[:, j] = take
        count += take
    rank = np.where(chosen, 0, np.where(cand >= 0, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :most]
    out = np.take_along_axis(cand, order, 1)
    if width < most:
        out = np.pad(out, ((0, 0), (0, most - width)), constant_values=-1)
    return out


class Graph:
    """x: unit vectors as 32-bit floats; layers[l]: edges of each vector of layer l, -1 for none."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], entry: int):
        self.x, self.layers, self.entry = x, layers, entry

    @classmethod
    def built(cls, x: np.ndarray, numbers: np.ndarray) -> Graph:
        n = len(x)
        u = (kit.mixed(numbers.astype(np.uint64) + np.uint64(11)) >> np.uint64(11)).astype(np.float64) / 2**53
        level = np.minimum(np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(M)).astype(np.int64), 8)
        order = np.lexsort((numbers, -level))
        graph = cls(x, [np.full((n, M0 if at == 0 else M), -1, np.int32) for at in range(int(level[order[0]]) + 1)], int(order[0]))
        at = 1
        while at < n:
            # A batch is of one level, and no larger than the graph.
            same = int(np.searchsorted(-level[order], -level[order[at]], "right"))
            stop = min(at + max(1, min(at, BATCH)), same)
            graph._insert(order[at:stop], int(level[order[at]]))
            at = stop
        return graph

    def _insert(self, new: np.ndarray, level: int) -> None:
        q = self.x[new]
        own = q @ q.T
        np.fill_diagonal(own, -2)
        entry = self._descend(q, level)
        for layer in range(level, -1, -1):
            ids, sims = self._beam(q, entry, BUILD, layer)
            entry = ids[:, 0].astype(np.int64)
            k = min(BUILD, len(new) - 1)
            if k:
                best = np.argpartition(-own, k - 1, axis=1)[:, :k]
                ids, sims = np.concatenate([ids, new[best]], axis=1), np.concatenate([sims, np.take_along_axis(own, best, 1)], axis=1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD]
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            edges = _selected(self.x, np.where(sims > -2, ids, -1), sims, M)
            self.layers[layer][new, :M] = edges
            self._link_back(layer, new, edges)

    def _link_back(self, layer: int, new: np.ndarray, edges: np.ndarray) -> None:
        """Adds the new vectors to the edges of those they point to."""
        adjacent = self.layers[layer]
        most = adjacent.shape[1]
        to, by = edges.ravel().astype(np.int64), np.repeat(new, edges.shape[1])
        to, by = to[to >= 0], by[to >= 0]
        sim = np.einsum("nd,nd->n", self.x[to], self.x[by])
        order = np.lexsort((-sim, to))
        to, by = to[order], by[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        # The best `most` new ones compete with the edges that stand.
        wide = min(int(count.max(initial=1)), most)
        for lo in range(0, len(targets), 256):
            t = targets[lo : lo + 256]
            a, b = first[lo], (first[lo + 256] if lo + 256 < len(targets) else len(to))
            fresh = np.full((len(t), wide), -1, np.int64)
            fits = place[a:b] < wide
            fresh[np.repeat(np.arange(len(t)), count[lo : lo + 256])[fits], place[a:b][fits]] = by[a:b][fits]
            both = np.concatenate([adjacent[t].astype(np.int64), fresh], axis=1)
            # The two may point to one another already.
            twice = (both[:, most:, None] == both[:, None, :most]).any(axis=2) & (fresh >= 0)
            both[:, most:][twice] = -1
            sims = np.where(both >= 0, np.einsum("td,tcd->tc", self.x[t], self.x[np.maximum(both, 0)]), -3)
            order = np.argsort(-sims, axis=1, kind="stable")
            both, sims = np.take_along_axis(both, order, 1), np.take_along_axis(sims, order, 1)
            full = (both >= 0).sum(axis=1) > most
            adjacent[t[~full]] = both[~full, :most]
            if full.any():
                adjacent[t[full]] = _selected(self.x, both[full], sims[full], most)

    def _descend(self, q: np.ndarray, level: int) -> np.ndarray:
        """The vector nearest to each query on the layers above level, by greedy search."""
        entry = np.full(len(q), self.entry, np.int64)
        for layer in range(len(self.layers) - 1, level, -1):
            entry = self._beam(q, entry, 1, layer)[0][:, 0].astype(np.int64)
        return entry

    def _beam(self, q: np.ndarray, entry: np.ndarray, ef: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sims) of the best ef of each search, best first; -1 and -2 where there are fewer."""
        n, rows = len(self.x), len(q)
        adjacent = self.layers[layer]
        seen = np.zeros(rows * n, bool)
        seen[np.arange(rows) * n + entry] = True
        ids, sims, done = np.full((rows, ef), -1, np.int64), np.full((rows, ef), -2, np.float32), np.ones((rows, ef), bool)
        ids[:, 0], done[:, 0] = entry, False
        sims[:, 0] = np.einsum("nd,nd->n", q, self.x[entry])
        live = np.arange(rows)
        step = min(STEP, ef)
        while len(live):
            # The first unexpanded entries of each beam.
            turn = np.cumsum(~done[live], axis=1)
            take = ~done[live] & (turn <= step)
            r, c = np.nonzero(take)
            done[live[r], c] = True
            found = adjacent[ids[live[r], c]].astype(np.int64)
            key = (live[r][:, None] * n + found)[found >= 0]
            key = np.unique(key[~seen[key]])
            seen[key] = True
            row, new = np.divmod(key, n)
            sim = np.einsum("nd,nd->n", q[row], self.x[new])
            better = sim > sims[row, -1]
            row, new, sim = row[better], new[better], sim[better]
            if len(row):
                rows_of, first, count = np.unique(row, return_index=True, return_counts=True)
                at = np.arange(len(row)) - np.repeat(first, count)
                width = int(count.max())
                more, score = np.full((len(rows_of), width), -1, np.int64), np.full((len(rows_of), width), -2, np.float32)
                local = np.repeat(np.arange(len(rows_of)), count)
                more[local, at], score[local, at] = new, sim
                score = np.concatenate([sims[rows_of], score], axis=1)
                order = np.argsort(-score, axis=1, kind="stable")[:, :ef]
                sims[rows_of] = np.take_along_axis(score, order, 1)
                ids[rows_of] = np.take_along_axis(np.concatenate([ids[rows_of], more], axis=1), order, 1)
                done[rows_of] = np.take_along_axis(np.concatenate([done[rows_of], more < 0], axis=1), order, 1)
            live = live[~done[live].all(axis=1)]
        return ids, sims

    def search(self, q: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sims) of each query's beam on layer 0."""
        return self._beam(q, self._descend(q, 0), min(ef, len(self.x)), 0)
