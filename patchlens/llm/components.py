"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    joined = edges.join(_least(edges), "u")
    return (joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(joined.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``links`` (two columns); component is its smallest node.

    Each round writes its links to the checkpoint folder; the number of rounds
    grows with the logarithm of the longest path.  Links of a node with itself
    and repeated links do no harm; an empty table gives no rows.
    """
    a, b = links.columns
    edges = (links.filter(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint())

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    last = mark(edges)
    for _ in range(rounds):
        edges = _small_star(_large_star(edges)).checkpoint()
        now = mark(edges)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select("v", "v").distinct()))
