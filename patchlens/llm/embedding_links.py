"""Operator 9: near-duplicate embeddings by HNSW graphs, one per shard.

Vectors are compared within their label (and length).  Equal vectors become
one class.  The classes of a label are dealt over shards of about
``shard_size``; a shard's graph is built once and written.  Every shard is
queried with its own vectors and those of every later shard of its label, so
each pair of shards meets once; one task holds two shards at a time.

Before a pair is searched, the search is audited on two sets of queries, ``audit``
of the pair's own, spread evenly, and ``4 * audit`` probes: vectors of the shard moved
to the cosine of the threshold in a random direction.  Near pairs may be so rare that no query of
the first set has one; each probe has a link for certain, at the greatest distance a link may have.  Both sets are
scanned by brute force, and beam and slack are doubled until a query's mean recall
reaches ``min_recall`` in both; only a beam as wide as the shard, after audits that failed, is
an exact scan.  Found pairs are verified in double precision.  A pair of shards gives back a link count per class and a star
of every linked group, not the links themselves; components unites the stars.

Defined cases: null, zero and empty vectors, vectors with null or non-finite
components, and null labels link with nothing and stay; repeated rows are
separate vectors that link with each other; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table
from patchlens.llm.components import components
from patchlens.llm.hnsw import BLOCK, Hnsw

SHARD = "label int, dim int, shard int, n_shards int, reps binary, copies binary, vectors binary, graph binary"


def build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep", kind="stable")
    x = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    first = rows.iloc[0]
    return pd.DataFrame([{
        "label": first["label"], "dim": first["dim"], "shard": first["shard"], "n_shards": first["n_shards"],
        "reps": rows["rep"].to_numpy(np.int64).tobytes(), "copies": rows["copies"].to_numpy(np.int64).tobytes(),
        "vectors": x.tobytes(), "graph": Hnsw(x.astype(np.float32)).dump()}])


def _scan(x: np.ndarray, q: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(q @ x.T >= threshold)


def _probes(x: np.ndarray, threshold: float, n: int) -> np.ndarray:
    """Vectors of ``x``, spread evenly, each moved at random to just within the threshold of where it was."""
    at = np.unique(np.linspace(0, len(x) - 1, min(n, len(x))).astype(int))
    aside = np.random.default_rng(11).normal(size=(len(at), x.shape[1]))
    aside -= np.einsum("pd,pd->p", aside, x[at])[:, None] * x[at]
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    cos = min(1.0, threshold + 1e-6)
    moved = cos * x[at] + np.sqrt(1 - cos * cos) * aside / np.maximum(length, 1e-9)
    return np.where(length > 1e-9, moved, x[at])  # one dimension has no other direction


def _scan_audit(x: np.ndarray, queries: np.ndarray, near: float, self_: np.ndarray) -> np.ndarray:
    """The links (query * len(x) + row) of an audit's queries, but those of a vector with itself."""
    r, c = _scan(x, queries, near)
    other = c != self_[r]
    return r[other] * np.int64(len(x)) + c[other]


def _recall(index: Hnsw, queries: np.ndarray, near: float, beam: int, slack: float, true: np.ndarray) -> float:
    """The mean share of its links that a query with links finds; 1 if there is none."""
    n, got = np.int64(len(index.x)), [np.empty(0, np.int64)]
    for at in range(0, len(queries), BLOCK):
        r, c = index.within(queries[at:at + BLOCK].astype(np.float32), near, beam, slack)
        got.append((r + at) * n + c)
    hit = np.isin(true, np.concatenate(got))
    all_, found = (np.bincount(true[k] // n, minlength=len(queries)) for k in (slice(None), hit))
    return float((found[all_ > 0] / all_[all_ > 0]).mean()) if len(true) else 1.0


class Union:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))

    def roots(self, a: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[a]
            if (up == a).all():
                return a
            self.parent[a] = self.parent[up]
            a = up


def link_shards(index: Hnsw, x: np.ndarray, q: np.ndarray, same: bool, threshold: float, audit: int,
                min_recall: float):
    """Yields blocks of verified links (query row, index row); for a shard with itself query < index."""
    near = threshold - 1e-4  # the search compares in single precision

    def verified(r: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cos = np.concatenate([np.einsum("pd,pd->p", q[r[i:i + 65536]], x[c[i:i + 65536]])
                              for i in range(0, len(r), 65536)] or [np.empty(0)])
        return r[cos >= threshold], c[cos >= threshold]

    q32 = q.astype(np.float32)
    sample = np.unique(np.linspace(0, len(q) - 1, min(audit, len(q))).astype(int))
    own = sample if same else np.full(len(sample), -1)  # a vector finds itself in any search
    moved = _probes(x, threshold, 4 * audit)
    sets = [(q[sample], own), (moved, np.full(len(moved), -1))]
    wanted = [_scan_audit(x, queries, near, self_) for queries, self_ in sets]
    beam, slack = 16, 0.05
    while beam < len(x) and not all(_recall(index, queries, near, beam, slack, true) >= min_recall
                                    for (queries, _), true in zip(sets, wanted)):
        beam, slack = 2 * beam, 2 * slack
    for at in range(0, len(q), BLOCK):
        if beam < len(x):
            r, c = index.within(q32[at:at + BLOCK], near, beam, slack)
        else:
            r, c = _scan(x, q[at:at + BLOCK], near)
        r = r + at
        if same:
            r, c = r[r < c], c[r < c]
        yield verified(r, c)


def near_vectors(vectors: DataFrame, threshold: float = 0.93, *, shard_size: int = 8192, audit: int = 128,
                 min_recall: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    value = F.col("embedding")
    bad = F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & value.isNotNull() & (F.size(value) > 0) & ~bad
              & F.exists(value, lambda v: v != 0))
    rows = vectors.select("vec_id", "label", "embedding", F.coalesce(usable, F.lit(False)).alias("usable"))
    valid = rows.filter("usable").select("vec_id", F.col("label").cast("int").alias("label"),
                                         F.transform("embedding", lambda v: v.cast("double")).alias("vector"))
    # one class for each distinct vector of a label, named by its smallest vec_id
    classes = stored(valid.groupBy("label", "vector").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")).withColumn("dim", F.size("vector")),
        "vector-classes")
    sizes = classes.groupBy("label", "dim").agg(
        F.ceil(F.count(F.lit(1)) / shard_size).cast("int").alias("n_shards"))
    dealt = classes.join(sizes, ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64("rep"), F.col("n_shards")).cast("int"))
    shards = stored(dealt.groupBy("label", "dim", "shard").applyInPandas(build_shard, SHARD), "vector-shards")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = left.iloc[0], right.iloc[0]
        dim, same = int(a["dim"]), a["shard"] == b["shard"]
        x, q = (np.frombuffer(s["vectors"]).reshape(-1, dim) for s in (a, b))
        reps, copies = ([np.frombuffer(s[k], np.int64) for s in (a, b)] for k in ("reps", "copies"))
        index = Hnsw.load(x.astype(np.float32), a["graph"])
        links_a, links_b = np.zeros(len(x), np.int64), np.zeros(len(q), np.int64)
        union = Union(len(x) + (0 if same else len(q)))
        for r, c in link_shards(index, x, q, same, threshold, audit, min_recall):
            links_b += np.bincount(r, weights=copies[0][c], minlength=len(q)).astype(np.int64)
            links_a += np.bincount(c, weights=copies[1][r], minlength=len(x)).astype(np.int64)
            union.add(c, r + (0 if same else len(x)))
        if same:
            names, links = reps[0], links_a + links_b
        else:
            names, links = np.concatenate(reps), np.concatenate([links_a, links_b])
        some = np.flatnonzero(links)
        return pd.DataFrame({"rep": names[some], "links": links[some], "hub": names[union.roots(some)]})

    one = shards.withColumn("other", F.explode(F.sequence("shard", F.col("n_shards") - 1)))
    two = shards.withColumn("other", F.col("shard")).withColumn("shard", F.explode(F.sequence(F.lit(0), "other")))
    keys = ["label", "dim", "shard", "other"]
    two = two.select("label", "dim", "shard", "other", "reps", "copies", "vectors")
    two_named = two.withColumn("own", F.col("other"))
    links = stored(one.groupBy(*keys).cogroup(two_named.groupBy(*keys)).applyInPandas(
        lambda a, b: search(a, b.assign(shard=b["own"])), "rep long, links long, hub long"), "vector-links")

    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(links.select("rep", "hub"))
    named = (classes.select("label", "vector", "rep", "copies").join(counts, "rep", "left")
             .join(groups, F.col("rep") == F.col("node"), "left")
             .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    linked = valid.join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                 F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_hnsw_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
