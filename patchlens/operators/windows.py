"""Top-N per group by ``row_number`` (planned as partial + final
``WindowGroupLimit``, so each map task already keeps only N rows per key
before the shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
                    n: int = 1, rank_col: str = "_rn") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= n)
              .drop(rank_col))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep-last-per-key table: the row with the greatest ``newest_first``
    tuple (e.g. timestamp, load sequence) for every key."""
    return top_n_per_group(df, keys, [F.col(c).desc() for c in newest_first], 1)


def distinct_in_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct rows of ``df``, for rows placed by ``keys``: no exchange, and sorted with ``keys`` first, which is the
    order of a merge join on them, so that nothing is held beyond the sort of that join."""
    cols = [*keys, *[c for c in df.columns if c not in keys]]
    return top_n_per_group(df, cols, [F.col(keys[0])])
