"""HNSW links against brute force."""

import numpy as np
import pytest

from patchlens.llm import embedding_links as el
from patchlens.llm.common import table
from patchlens.llm.hnsw import Hnsw


def clustered(n, seed, dim=16):
    rng = np.random.default_rng(seed)
    out = rng.normal(size=(n, dim))
    out[: n // 3] = rng.normal(size=dim) + 0.08 * rng.normal(size=(n // 3, dim))  # one large near group
    out[n // 3: n // 2] = out[n // 2: n // 2 + (n // 2 - n // 3)] + 0.05 * rng.normal(size=(n // 2 - n // 3, dim))
    return out


@pytest.mark.parametrize("n", [1, 2, 30, 900])
def test_graph_recall(n):
    x = clustered(n, n) if n > 2 else np.eye(16)[:n]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = Hnsw(x.astype(np.float32))
    again = Hnsw.load(x.astype(np.float32), index.dump())
    true = set(zip(*map(np.ndarray.tolist, np.nonzero(x @ x.T >= 0.93))))
    for g in (index, again):
        found = set(zip(*map(np.ndarray.tolist, g.within(x.astype(np.float32), 0.93, 16, 0.05))))
        assert len(found & true) >= 0.9 * len(true)


def plain(rows):
    ok = []
    for i, (v, e, lab) in enumerate(rows):
        good = lab is not None and v is not None and e and all(c is not None and np.isfinite(c) for c in e) and any(e)
        ok.append(good)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unit = [np.array(e, float) / np.linalg.norm(np.array(e, float)) if g else None for (_, e, _), g in zip(rows, ok)]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if ok[i]:
            least[find(i)] = min(v, least.get(find(i), v))
    comp = [least[find(i)] if ok[i] else rows[i][0] for i in range(len(rows))]
    return sorted(((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, comp)), key=repr)


@pytest.mark.parametrize("shard_size", [40, 8192])
def test_against_brute_force(spark, shard_size):
    x = clustered(240, 5).astype(np.float32)
    rows = [(1000 - i, [float(c) for c in v], i % 2) for i, v in enumerate(x)]
    rows += [(2000, rows[0][1], 0), (2001, rows[0][1], 0), (2001, rows[0][1], 0), (2002, rows[0][1], 1),
             (3000, None, 0), (3001, [0.0] * 16, 0), (3002, [float("nan")] * 16, 0), (3003, [None] + [1.0] * 15, 0),
             (3004, [float("inf")] * 16, 0), (3005, rows[0][1], None), (3006, [], 0), (3007, [1.0, 2.0], 0),
             (3008, [2.0, 4.0], 0)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, rep int")
    got = sorted(map(tuple, el.near_vectors(frame, shard_size=shard_size, audit=64, min_recall=1.0).collect()), key=repr)
    assert got == plain(rows)


class Blind:
    """A search that finds no link but a vector itself."""

    def __init__(self, x):
        self.x = x.astype(np.float32)

    def within(self, q, threshold, beam, slack):
        return np.nonzero(q @ self.x.T >= 0.9999999)


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("pairs", [0, 3, 100])
def test_sparse_links_are_not_left_to_an_unaudited_search(same, pairs):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1000, 64))
    q = x if same else rng.normal(size=(1000, 64))
    for k in range(pairs):  # rows 1, 8, 15 ... of the queries
        q[7 * k + 1] = x[999 - k] + 0.01 * rng.normal(size=64)
    x, q = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, q))
    r, c = np.nonzero(q @ x.T >= 0.93)
    true = {(a, b) for a, b in zip(r.tolist(), c.tolist()) if a < b or not same}
    assert len(true) >= pairs
    for audit in (128, 40):
        blocks = list(el.link_shards(Blind(x), x, q, same, 0.93, audit, 0.98))
        assert sorted((int(a), int(b)) for r, c in blocks for a, b in zip(r, c)) == sorted(true)


@pytest.mark.parametrize("same", [True, False])
def test_sparse_links_come_from_the_graph(same, monkeypatch):
    """Fifty links among 3,000 vectors: the graph is searched for every query and finds them."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    q = x if same else rng.normal(size=(3000, 64))
    for k in range(50):
        q[7 * k + 1] = x[2999 - k] + 0.03 * rng.normal(size=64)
    x, q = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, q))
    true = {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(q @ x.T >= 0.93))) if a < b or not same}
    searched, scanned = [], []
    within, scan = Hnsw.within, el._scan
    monkeypatch.setattr(Hnsw, "within", lambda g, v, *a: searched.append(len(v)) or within(g, v, *a))
    monkeypatch.setattr(el, "_scan", lambda a, v, t: scanned.append(len(v)) or scan(a, v, t))
    blocks = list(el.link_shards(Hnsw(x.astype(np.float32)), x, q, same, 0.93, 128, 0.98))
    found = {(int(a), int(b)) for r, c in blocks for a, b in zip(r, c)}
    assert found <= true and len(found) >= 0.98 * len(true) and len(true) >= 50
    assert sum(searched) >= len(q) and sum(scanned) <= 128 + 512


def test_probes_lie_at_the_threshold():
    x = np.random.default_rng(1).normal(size=(700, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    moved = el._probes(x, 0.93, 512)
    assert np.allclose(np.linalg.norm(moved, axis=1), 1) and np.allclose((moved @ x.T >= 0.93).sum(axis=1).min(), 1)
    assert (el._probes(np.ones((3, 1)), 0.93, 512) == 1).all()


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert el.near_vectors(frame).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "embeddings").select("vec_id", "embedding", "label").collect()]
    # the table has no link: a near copy of every fifth vector gives it some
    rng = np.random.default_rng(2)
    rows += [(10_000_000 + v, [float(np.float32(c + 0.02 * d)) for c, d in zip(e, rng.normal(size=len(e)))], lab)
             for v, e, lab in rows if v % 5 == 0]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got, want = sorted(map(tuple, el.near_vectors(frame).collect()), key=repr), plain(rows)
    assert sum(r[1] for r in want) > 0 and sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want)
    rows = [tuple(r) for r in table(spark, sf, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, el.op9_hnsw_embeddings(spark, sf).collect()), key=repr)
    want = plain(rows)
    assert sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want)
    assert [(r[0], r[2]) for r in got] == [(r[0], r[2]) for r in want]
