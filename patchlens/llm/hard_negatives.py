"""Operator 12: hard negatives by anchor-clustered shared lists (MAXIMUS).

Scores are integer inner products of quantised vectors.  Anchors are packed into
units of at most ``unit_size`` and clustered there (spherical k-means on all of
them); candidates are packed into shards of about ``shard_size``, each label's rows in few shards.
Where a unit meets a shard, every cluster sorts the shard once by an upper bound:
for a member u within angle b of its centroid and a candidate x at angle t from it,
u.x <= |u| |x| cos(max(0, t - b)).  All members of the cluster walk that one list, in
blocks; a member leaves it when the bound ahead of it is below what could still
change its result, so the result is exact whatever the clusters look like.

Two walks: the first, over the shards that hold the anchor's label, finds the
positives (best ``positives`` other rows of that label); the second, over all shards,
the best ``negatives`` rows of other labels for every positive within the two score
limits.  Partial lists of the shards are ranked together by a window whose groups
hold at most that many rows of each shard.

Defined cases: a row with a null vec_id, label, vector or component, a non-finite component
or one too large for exact scores (scale |x| sqrt(length) >= 2^26) takes no part; a row
repeated with the same vec_id, label and vector counts once, rows that share only a
vec_id are rows of their own; zero vectors score 0; vectors of different length are not
compared (empty ones only with each other); ties go to the smaller vec_id; an anchor
without positives or a positive without negatives gives no rows; an empty table gives
none; other columns are ignored; there are no texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table

SHARD = "dim int, part int, shard int, ids binary, rows binary, labels binary, vectors binary"
UNIT = ("dim int, part int, unit int, rows binary, labels binary, vectors binary, positives binary, "
        "scores binary, sizes binary, centres binary")
FOUND = "anchor_row long, positive_id long, positive_row long, positive_score long, id long, row long, score long"
NO_SCORE = np.int64(-1) << np.int64(62)


def usable(scale: float) -> Column:
    limit = 2.0 ** 26
    size = F.sqrt(F.size("embedding").cast("double"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) * scale * size >= limit))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad


def _stack(rows: pd.DataFrame) -> np.ndarray:
    return np.stack(rows["vector"].to_numpy()).astype(np.int32)


def build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    first = rows.iloc[0]
    return pd.DataFrame([{
        "dim": first["dim"], "part": first["part"], "shard": first["shard"],
        "ids": rows["vec_id"].to_numpy(np.int64).tobytes(), "rows": rows["row"].to_numpy(np.int64).tobytes(),
        "labels": rows["label"].to_numpy(np.int64).tobytes(), "vectors": _stack(rows).tobytes()}])


def _unit_length(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def cluster(x: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """(cluster of each row, unit centres) by spherical k-means with about sqrt(rows) centres."""
    u = _unit_length(x.astype(np.float64))
    k = int(np.ceil(np.sqrt(len(u))))
    centres = u[np.linspace(0, len(u) - 1, k).astype(int)]
    for _ in range(rounds):
        mine = (u @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, mine, u)
        used = np.linalg.norm(sums, axis=1) > 0
        centres = np.where(used[:, None], _unit_length(sums), centres)
    return (u @ centres.T).argmax(axis=1), centres


def build_unit(rows: pd.DataFrame) -> pd.DataFrame:
    first, x = rows.iloc[0], _stack(rows)
    mine, centres = cluster(x)
    order = np.argsort(mine, kind="stable")
    names, sizes = np.unique(mine, return_counts=True)
    lists = [np.concatenate([np.asarray(v, np.int64) for v in rows[c].iloc[order]]) if c in rows else np.empty(0, np.int64)
             for c in ("positives", "scores")]
    return pd.DataFrame([{
        "dim": first["dim"], "part": first["part"], "unit": first["unit"],
        "rows": rows["row"].to_numpy(np.int64)[order].tobytes(),
        "labels": rows["label"].to_numpy(np.int64)[order].tobytes(), "vectors": x[order].tobytes(),
        "positives": lists[0].tobytes(), "scores": lists[1].tobytes(),
        "sizes": sizes.astype(np.int64).tobytes(), "centres": centres[names].tobytes()}])


class Best:
    """The first ``k`` entries of every slot by score descending, then id."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floor = k, floors.copy()  # an entry below its slot's floor cannot be among them
        self.kept = tuple(np.empty(0, np.int64) for _ in range(4))  # slot, score, id, row

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids, rows = (np.concatenate(v) for v in zip(self.kept, (slot, score, ids, rows)))
        order = np.lexsort((rows, ids, -score, slot))
        slot = slot[order]
        at = np.arange(len(slot)) - np.searchsorted(slot, slot)
        first = order[at < self.k]
        last = slot[at == self.k - 1]
        self.floor[last] = score[order][at == self.k - 1]
        self.kept = slot[at < self.k], score[first], ids[first], rows[first]


def walk(members: np.ndarray, centre: np.ndarray, x: np.ndarray, norms: np.ndarray, best: Best, slots: int, take,
         step: int = 128) -> int:
    """One cluster's members walk the candidates ``x`` by falling bound; returns the scores computed.

    ``slots`` lists of each member are kept in ``best``; ``take`` picks from a block's scores.
    """
    size = np.linalg.norm(members, axis=1)
    u, cos = members[size > 0] / size[size > 0, None], x @ centre / np.maximum(norms, 1e-300)
    spread = np.arccos(np.clip(u @ centre, -1, 1)).max(initial=0.0) + 1e-7
    bound = norms * np.cos(np.clip(np.arccos(np.clip(cos, -1, 1)) - spread, 0, np.pi))
    order = np.argsort(-bound, kind="stable")
    at, active, done = 0, np.arange(len(members)), 0
    while at < len(order) and len(active):
        some = order[at:at + step]
        scores = members[active] @ x[some].T
        done += scores.size
        take(active, some, scores.astype(np.int64))
        at, step = at + step, min(2 * step, 1024)
        if at < len(order):
            ahead = size[active] * bound[order[at]]
            low = best.floor.reshape(-1, slots)[active].min(axis=1)
            active = active[ahead + 1e-9 * np.abs(ahead) + 1e-6 >= low]
    return done


def meet(unit: pd.Series, shard: pd.Series, dim: int, k: int, low: int, high: int, positives: int) -> pd.DataFrame:
    """What the anchors of a unit find in a shard: positives, or negatives if the unit holds positives."""
    dim = max(dim, 1)
    whole = {c: np.frombuffer(unit[c], np.int64) for c in ("rows", "labels", "positives", "scores", "sizes")}
    m = np.frombuffer(unit["vectors"], np.int32).reshape(-1, dim).astype(np.float64)
    x = np.frombuffer(shard["vectors"], np.int32).reshape(-1, dim).astype(np.float64)
    ids, rows, labels = (np.frombuffer(shard[c], np.int64) for c in ("ids", "rows", "labels"))
    norms, centres = np.linalg.norm(x, axis=1), np.frombuffer(unit["centres"]).reshape(-1, dim)
    second = len(whole["scores"]) > 0
    slots = positives if second else 1
    goal = whole["scores"].reshape(-1, slots) if second else None
    parts, at = [], 0
    for centre, n in zip(centres, whole["sizes"]):
        own = slice(at, at + n)
        at += n
        mine, my_rows = whole["labels"][own], whole["rows"][own]
        if second:
            goals = goal[own]
            never = goals < 0  # also the places of positives that are not there
            floors = np.where(never, np.iinfo(np.int64).max, -(-goals * low // 100)).reshape(-1)
            ceilings = np.where(never, NO_SCORE, goals * high // 100)
        else:
            floors = np.full(n, NO_SCORE)
        best = Best(floors, k)

        def take(active, some, scores):
            same = mine[active][:, None] == labels[some]
            if not second:
                fits = same & (my_rows[active][:, None] != rows[some]) & (scores >= best.floor[active][:, None])
                r, c = np.nonzero(fits)
                best.add(active[r], scores[r, c], ids[some[c]], rows[some[c]])
                return
            found = []
            for j in range(slots):
                slot = active * slots + j
                fits = ~same & (scores >= best.floor[slot][:, None]) & (scores <= ceilings[active, j][:, None])
                r, c = np.nonzero(fits)
                found.append((slot[r], scores[r, c], ids[some[c]], rows[some[c]]))
            best.add(*(np.concatenate(v) for v in zip(*found)))

        walk(m[own], centre, x, norms, best, slots, take)
        slot, score, found_ids, found_rows = best.kept
        part = {"anchor_row": my_rows[slot // slots], "id": found_ids, "row": found_rows, "score": score}
        if second:
            part["positive_row"] = whole["positives"].reshape(-1, slots)[own].reshape(-1)[slot]
            part["positive_score"] = goals.reshape(-1)[slot]
        parts.append(pd.DataFrame(part))
    out = pd.concat(parts, ignore_index=True).assign(positive_id=0)
    for c in ("positive_row", "positive_score"):
        out[c] = out[c] if second else 0
    return out[[f.split()[0] for f in FOUND.split(", ")]]


def _dealt(rows: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """``rows`` with a number ``name`` that deals each group of ``keys`` into parts of about ``size`` rows."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("_n"))
    return rows.join(sizes, keys).withColumn(name, F.pmod(F.xxhash64("row"), "_n").cast("int")).drop("_n")


def _met(units: DataFrame, shards: DataFrame, keys: list[str], **how) -> DataFrame:
    """Every unit against every shard of the same ``keys``: the query set against all rows, in blocks."""
    shard = ["dim", "part", "shard"]
    inside = [c for c in units.columns if c not in shard]
    unit_names, shard_names = units.select(*keys, "unit"), shards.select(*shard)
    left = units.select(*keys, *inside).join(shard_names, keys).select(*shard, *inside)
    right = shards.join(unit_names, keys).select(*shard, "unit", *[c for c in shards.columns if c not in shard])
    on = [*shard, "unit"]
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)

    def search(u: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        return meet(u.iloc[0], s.iloc[0], int(s["dim"].iloc[0]), **how)

    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(search, FOUND)


def hard_negatives(vectors: DataFrame, *, scale: float = 256, positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95, unit_size: int = 1024, shard_size: int = 8192) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, embedding, an integer label and a boolean ``anchor``; a component x becomes
    floor(scale * x).  ``low`` and ``high`` are the limits of a negative's score in hundredths of the positive's.
    """
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("int"))
    rows = vectors.filter(usable(scale)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.size("embedding").alias("dim"), F.coalesce("anchor", F.lit(False)).alias("anchor"),
        F.when(F.size("embedding") > 0, whole).otherwise(F.array(F.lit(0))).alias("vector"))
    rows = rows.groupBy("vec_id", "label", "dim", "vector").agg(F.max("anchor").alias("anchor"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "negative-rows")
    # labels are dealt over parts, so that a small label lies in one part and a large one in shards of its own part
    parts = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_size).cast("int").alias("_parts"))
    rows = rows.join(parts, "dim").withColumn("part", F.pmod(F.xxhash64("label"), "_parts").cast("int")).drop("_parts")
    shards = stored(_dealt(rows, ["dim", "part"], shard_size, "shard").groupBy("dim", "part", "shard").applyInPandas(
        build_shard, SHARD), "negative-shards")
    anchors = rows.filter("anchor")
    how = {"low": low, "high": high, "positives": positives}

    units = stored(_dealt(anchors, ["dim", "part"], unit_size, "unit").groupBy("dim", "part", "unit").applyInPandas(
        build_unit, UNIT), "negative-units")
    first = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "id", "row")
    found = stored(_met(units, shards, ["dim", "part"], k=positives, **how)
                   .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
                   .select("anchor_row", "id", "row", "score"), "negative-positives")

    # the positives of an anchor, at most ``positives`` of them, filled up with scores that nothing fits
    lists = found.groupBy("anchor_row").agg(F.collect_list("row").alias("r"), F.collect_list("score").alias("s"))
    fill = F.array_repeat(F.lit(-1).cast("long"), positives)
    lists = lists.select(F.col("anchor_row").alias("row"), F.slice(F.concat("r", fill), 1, positives).alias("positives"),
                         F.slice(F.concat("s", fill), 1, positives).alias("scores"))
    units = stored(_dealt(anchors.join(lists, "row"), ["dim"], unit_size, "unit").groupBy("dim", "unit").applyInPandas(
        build_unit, UNIT), "negative-goals")
    best = Window.partitionBy("anchor_row", "positive_row").orderBy(F.desc("score"), "id", "row")
    hard = (_met(units, shards, ["dim"], k=negatives, **how)
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
            .select("anchor_row", "positive_row", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
    names = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    named = found.select("anchor_row", F.col("row").alias("positive_row"), F.col("id").alias("positive_id"))
    return hard.join(named, ["anchor_row", "positive_row"]).join(names, "anchor_row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label"),
                                      (F.col("vec_id") % 50 == 0).alias("anchor")))


SQL = """
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       (row_number() OVER w)::INTEGER AS rank, n.other_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)
QUALIFY row_number() OVER w <= 3"""
