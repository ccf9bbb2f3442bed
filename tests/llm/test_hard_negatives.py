"""Hard negatives by shared lists against brute force."""

import math

import numpy as np
import pytest
from support import SF_SMALL

from patchlens.llm import hard_negatives as hn
from patchlens.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, anchor boolean, score string"


def plain(rows, scale=256, positives=5, negatives=3, low=50, high=95):
    """All scores, row by row."""
    ok = {}
    for v, e, lab, anchor, _ in rows:
        if v is None or lab is None or e is None or any(c is None or not math.isfinite(c) for c in e):
            continue
        q = tuple(math.floor(scale * float(np.float32(c))) for c in e)
        ok[v, lab, q] = ok.get((v, lab, q), False) or bool(anchor)
    out = []
    for (v, lab, q), anchor in ok.items():
        if not anchor:
            continue
        near = sorted((-sum(map(int.__mul__, q, x)), w, m, x) for w, m, x in ok if len(x) == len(q) and (w, m, x) != (v, lab, q))
        for s, w, *_ in [n for n in near if n[2] == lab][:positives]:
            hard = [n for n in near if n[2] != lab and low * -s <= 100 * -n[0] <= high * -s][:negatives]
            out += [(v, w, i + 1, n[1], -s, -n[0]) for i, n in enumerate(hard)]
    return sorted(out)


def found(spark, rows, **how):
    return sorted(map(tuple, hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), **how).collect()))


def vectors(n, dim=8, labels=4, seed=3, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    lab = rng.integers(0, labels, n)
    x = (centres[lab] + centres.mean(axis=0) + spread * rng.normal(size=(n, dim))).round(2)
    return [(i, x[i].tolist(), int(lab[i]), i % 9 == 0, "x") for i in range(n)]


@pytest.mark.parametrize("unit_size,shard_size", [(7, 25), (1024, 8192)])
def test_against_brute_force(spark, unit_size, shard_size):
    rows = vectors(260)
    want = plain(rows)
    assert len(want) > 50
    assert found(spark, rows, unit_size=unit_size, shard_size=shard_size) == want


def test_hot_label_and_one_common_vector(spark):
    rows = [(i, e if i % 3 else [1.0, 0.5] * 4, 0 if i % 2 else lab, a, s) for i, e, lab, a, s in vectors(200)]
    assert found(spark, rows, unit_size=10, shard_size=30) == plain(rows)


def test_defined_cases(spark):
    rows = vectors(60, dim=3) + [
        (None, [1.0, 1.0, 1.0], 0, True, ""), (900, None, 0, True, ""), (901, [1.0, 1.0, 1.0], None, True, ""),
        (902, [1.0, None, 1.0], 0, True, ""), (903, [1.0, float("nan"), 1.0], 0, True, ""),
        (904, [1.0, float("-inf"), 1.0], 1, True, ""), (905, [0.0, 0.0, 0.0], 0, True, ""),
        (906, [0.0, 0.0, 0.0], 1, True, ""), (907, [], 0, True, ""), (908, [], 1, True, ""), (909, [], 0, None, ""),
        (910, [2.0, 1.0], 0, True, ""), (911, [2.0, 1.1], 0, False, ""), (912, [1.5, 0.9], 1, False, ""),
        (5, [9.0, 9.0, 9.0], 2, True, ""), (5, [9.0, 9.0, 9.0], 2, True, "")]
    got = found(spark, rows, unit_size=4, shard_size=8)
    assert got == plain(rows)
    assert {907, 909} <= {r[0] for r in got} | {r[1] for r in got}
    assert any(r[0] == 910 and r[3] == 912 for r in got)


def test_too_large_components_and_empty_tables(spark):
    assert found(spark, [(1, [1e30, 1.0], 0, True, ""), (2, [1e30, 1.0], 0, True, "")]) == []
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0, True, "")]) == []


def test_walk_ends_early_where_the_bound_allows():
    rng = np.random.default_rng(1)
    x = np.floor(256 * np.concatenate([rng.normal(size=(3000, 8)) * 0.01 + np.eye(8)[k] for k in range(2)]))
    best = hn.Best(np.full(4, hn.NO_SCORE), 3)
    members = x[:4]

    def take(active, some, scores):
        r, c = np.nonzero(scores >= best.floor[active][:, None])
        best.add(active[r], scores[r, c], some[c], some[c])

    done = hn.walk(members, np.eye(8)[0], x, np.linalg.norm(x, axis=1), best, 1, take)
    assert done < 4 * len(x) * 0.8
    scores = (members @ x.T).astype(np.int64)
    for m in range(4):
        want = sorted(zip(-scores[m], range(len(x))))[:3]
        mine = [(-s, i) for slot, s, i, _ in zip(*best.kept) if slot == m]
        assert mine == want


def test_query_has_rows(spark):
    rows = hn.op12_hard_negatives(spark, SF_SMALL)
    assert rows.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert rows.count() > 0 and table(spark, SF_SMALL, "embeddings").count() == 500
