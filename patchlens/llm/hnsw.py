"""Hierarchical navigable small-world graph over the unit vectors of one shard, in numpy.

Insertion and search run for a block of vectors at a time.  A search descends
the upper layers greedily, keeps a beam of ``beam`` nodes on the ground layer, and then
floods from the beam's nodes through every node whose similarity is at least
``threshold - slack``, so a group of near copies larger than the beam is
still found whole.
"""

from __future__ import annotations

import io

import numpy as np

BLOCK = 256


def _select(x: np.ndarray, owners: np.ndarray, cand: np.ndarray, degree: int) -> np.ndarray:
    """For each owner (row) the ``degree`` neighbours to keep of ``cand`` (-1: none): nearest first,
    those nearer to a kept one than to the owner only if there is room."""
    sim = np.where(cand >= 0, np.einsum("bkd,bd->bk", x[cand], owners), -np.inf)
    order = np.argsort(-sim, axis=1, kind="stable")
    cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
    again = np.zeros(cand.shape, bool)
    for k in range(1, cand.shape[1]):
        again[:, k] = (cand[:, :k] == cand[:, k:k + 1]).any(axis=1)
    cand = np.where(again, -1, cand)
    mutual = np.einsum("bkd,bjd->bkj", x[cand], x[cand])
    kept = np.zeros(cand.shape, bool)
    for k in range(cand.shape[1]):
        near = np.where(kept, mutual[:, k, :], -np.inf).max(axis=1)
        kept[:, k] = (cand[:, k] >= 0) & (sim[:, k] > near) & (kept.sum(axis=1) < degree)
    rank = np.where(kept, 0, np.where(cand >= 0, 1, 2))
    order = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    out = np.full((len(cand), degree), -1, np.int32)
    out[:, :order.shape[1]] = np.take_along_axis(cand, order, 1)
    return out


class Hnsw:
    def __init__(self, x: np.ndarray, degree: int = 12, beam: int = 32, seed: int = 7):
        """``x``: unit vectors (float32), one a row."""
        self.x, self.degree = np.ascontiguousarray(x, dtype=np.float32), degree
        rng = np.random.default_rng(seed)
        level = np.floor(-np.log(rng.random(len(x)) + 1e-12) / np.log(degree)).astype(int) if len(x) else np.empty(0, int)
        # nodes of each upper layer, top first; a layer of one block or less is searched as a whole
        self.top = np.flatnonzero(level >= 2) if (level >= 2).sum() >= 2 else np.arange(min(len(x), 1))
        self.mid = np.union1d(np.flatnonzero(level >= 1), self.top)
        self.layers = {"mid": self._build(self.mid, degree, beam, self.top)}
        self.layers["ground"] = self._build(np.arange(len(x)), 2 * degree, beam, self.mid)
        self._reverse()

    def _reverse(self) -> None:
        """Links of the ground layer both ways, by node: the flood may follow a link backwards,
        so a node that its neighbours have dropped is still reached from those it chose."""
        row, col = np.nonzero(self.layers["ground"] >= 0)
        to = self.layers["ground"][row, col].astype(np.int64)
        both = np.unique(np.concatenate([row * np.int64(len(self.x)) + to, to * np.int64(len(self.x)) + row]))
        node, self.links = np.divmod(both, max(1, len(self.x)))
        self.links_at = np.searchsorted(node, np.arange(len(self.x) + 1))

    def _build(self, nodes: np.ndarray, degree: int, beam: int, entry: np.ndarray) -> np.ndarray:
        graph = np.full((len(self.x), degree), -1, np.int32)
        rest = np.setdiff1d(nodes, entry)
        for at in range(0, len(entry), BLOCK):
            self._insert(graph, entry[at:at + BLOCK], entry[:at], degree, beam, None)
        for at in range(0, len(rest), BLOCK):
            block = rest[at:at + BLOCK]
            starts = self._starts(self.x[block], entry, graph)
            self._insert(graph, block, None, degree, beam, starts)
        return graph

    def _starts(self, queries: np.ndarray, entry: np.ndarray, graph: np.ndarray) -> np.ndarray:
        """A node to start from for each query: nearest of the top, walked down the middle layer."""
        if len(self.top) == 0:
            return np.zeros(len(queries), np.int64)
        top = entry if "mid" not in getattr(self, "layers", {}) else self.top
        at = top[(queries @ self.x[top].T).argmax(axis=1)]
        if "mid" in getattr(self, "layers", {}):
            at = self._walk(queries, at, self.layers["mid"])
        return at

    def _walk(self, queries: np.ndarray, at: np.ndarray, graph: np.ndarray) -> np.ndarray:
        sim = np.einsum("bd,bd->b", self.x[at], queries)
        while True:
            near = graph[at]
            s = np.where(near >= 0, np.einsum("bkd,bd->bk", self.x[near], queries), -np.inf)
            best = s.argmax(axis=1)
            s = s[np.arange(len(at)), best]
            better = s > sim
            if not better.any():
                return at
            at = np.where(better, near[np.arange(len(at)), best], at)
            sim = np.where(better, s, sim)

    def _insert(self, graph: np.ndarray, block: np.ndarray, seen: np.ndarray | None, degree: int, beam: int,
                starts: np.ndarray | None) -> None:
        q = self.x[block]
        own = q @ q.T
        np.fill_diagonal(own, -np.inf)
        k = min(degree, len(block) - 1)
        beside = block[np.argpartition(-own, k - 1, axis=1)[:, :k]] if k > 0 else np.empty((len(block), 0), np.int64)
        if starts is not None:
            found = self._beam(q, starts, graph, beam)[0]
        elif len(seen):
            s = q @ self.x[seen].T
            k = min(beam, len(seen))
            found = seen[np.argpartition(-s, k - 1, axis=1)[:, :k]]
        else:
            found = np.empty((len(block), 0), np.int64)
        near = np.concatenate([found, beside], axis=1).astype(np.int64)
        chosen = _select(self.x, q, near, degree) if near.shape[1] else np.full((len(block), degree), -1, np.int32)
        graph[block] = chosen
        # links back; a node with too many neighbours selects anew
        row, col = np.nonzero(chosen >= 0)
        to, frm = chosen[row, col], block[row]
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        for at in range(0, len(nodes), BLOCK):
            n, f, c = nodes[at:at + BLOCK], first[at:at + BLOCK], count[at:at + BLOCK]
            width = int(c.max())
            extra = np.full((len(n), width), -1, np.int64)
            inner = np.arange(width)[None, :]
            mask = inner < c[:, None]
            extra[mask] = frm[(f[:, None] + inner)[mask]]
            for lo in range(0, width, 4 * degree):  # a node that many choose takes them in parts
                cand = np.concatenate([graph[n].astype(np.int64), extra[:, lo:lo + 4 * degree]], axis=1)
                graph[n] = _select(self.x, self.x[n], cand, degree)

    def _beam(self, q: np.ndarray, starts: np.ndarray, graph: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(q)
        rows = np.arange(n)
        ids = np.full((n, beam), -1, np.int64)
        sim = np.full((n, beam), -np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        seen = np.zeros((n, len(self.x)), bool)
        ids[:, 0], sim[:, 0], open_[:, 0] = starts, np.einsum("bd,bd->b", self.x[starts], q), True
        seen[rows, starts] = True
        while True:
            best = np.where(open_, sim, -np.inf).argmax(axis=1)
            live = np.flatnonzero(open_[rows, best])
            if not len(live):
                return ids, sim
            at = ids[live, best[live]]
            open_[live, best[live]] = False
            near = graph[at].astype(np.int64)
            fresh = (near >= 0) & ~seen[live[:, None], near]
            r, c = np.nonzero(fresh)
            seen[live[r], near[r, c]] = True
            s = np.full(near.shape, -np.inf, np.float32)
            s[r, c] = np.einsum("pd,pd->p", self.x[near[r, c]], q[live[r]])
            all_s = np.concatenate([sim[live], s], axis=1)
            order = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sim[live] = np.take_along_axis(all_s, order, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1), order, 1)
            open_[live] = np.take_along_axis(np.concatenate([open_[live], fresh], axis=1), order, 1)

    def within(self, q: np.ndarray, threshold: float, beam: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs with a similarity of at least ``threshold`` that a search finds."""
        ground = self.layers["ground"]
        ids, sim = self._beam(q, self._starts(q, self.top, ground), ground, beam)
        seen = np.zeros((len(q), len(self.x)), bool)
        row, col = np.nonzero(sim >= threshold - slack)
        node, s = ids[row, col], sim[row, col]
        seen[row, node] = True
        hits = [(row[s >= threshold], node[s >= threshold])]
        while len(row):
            many = self.links_at[node + 1] - self.links_at[node]
            r = np.repeat(row, many)
            upto = np.cumsum(many)
            c = self.links[np.repeat(self.links_at[node] - (upto - many), many) + np.arange(len(r))]
            ok = ~seen[r, c]
            key = np.unique(r[ok] * np.int64(len(self.x)) + c[ok])
            row, node = np.divmod(key, len(self.x))
            seen[row, node] = True
            s = np.concatenate([np.einsum("pd,pd->p", self.x[node[i:i + 65536]], q[row[i:i + 65536]])
                                for i in range(0, len(row), 65536)] or [np.empty(0, np.float32)])
            hits.append((row[s >= threshold], node[s >= threshold]))
            go = s >= threshold - slack
            row, node = row[go], node[go]
        return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, top=self.top, **self.layers)
        return out.getvalue()

    @classmethod
    def load(cls, x: np.ndarray, data: bytes) -> Hnsw:
        self = cls.__new__(cls)
        held = np.load(io.BytesIO(data))
        self.x, self.top = np.ascontiguousarray(x, dtype=np.float32), held["top"]
        self.layers = {"mid": held["mid"], "ground": held["ground"]}
        self._reverse()
        return self
