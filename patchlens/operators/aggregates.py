"""Grouped aggregates used by the marts and the exposure report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchlens.functions.dates import month_label, parse_month_label
from patchlens.operators.joins import left_join_with_defaults


def collect_distinct(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Per group, the distinct non-null values of each column, sorted
    (``arrayDistinct(groupArray(c))``).  ``collect_set`` combines map-side,
    so only distinct values per group cross the shuffle."""
    return df.groupBy(*keys).agg(*[F.array_sort(F.collect_set(src)).alias(out)
                                   for out, src in cols.items()])


def independent_max_match(df: DataFrame, key: str | Sequence[str], date_col: str, number_col: str,
                          carry: Sequence[str], number_type: str = "float") -> DataFrame:
    """Max of ``date_col`` and, independently, max of ``number_col`` read as
    ``number_type``, per ``key``; then every row holding both maxima brings
    its ``carry`` columns.  Groups where no row holds both keep one row with
    '' in ``carry`` (a right join onto the maxima, defaults filled)."""
    keys = [key] if isinstance(key, str) else list(key)
    num = F.col(number_col).try_cast(number_type)
    maxima = df.groupBy(*keys).agg(F.max(date_col).alias(date_col),
                                   F.max(num).alias(number_col))
    rows = df.select(*keys, date_col, num.alias(number_col), *carry)
    return left_join_with_defaults(maxima, rows, [*keys, date_col, number_col])


def independent_max_in_place(df: DataFrame, keys: Sequence[str], date_col: str, number_col: str,
                             carry: Sequence[str], number_type: str = "float") -> DataFrame:
    """The rows of :func:`independent_max_match` (text ``carry`` columns) by windows over ``keys``.
    The join there is on the maxima too and needs the rows placed by them; this takes rows that lie
    together by ``keys`` (buckets) as they are."""
    group = Window.partitionBy(*keys)
    number = F.col(number_col).try_cast(number_type)
    rows = df.select(*keys, F.col(date_col).alias("_date"), number.alias("_number"), *carry,
                     F.max(date_col).over(group).alias(date_col), F.max(number).over(group).alias("_top"))
    hit = F.coalesce((F.col("_date") == F.col(date_col)) & (F.col("_number") == F.col("_top")), F.lit(False))
    rows = rows.select(*keys, date_col, F.col("_top").alias(number_col), hit.alias("_hit"),
                       *[F.when(hit, F.coalesce(F.col(c), F.lit(""))).otherwise("").alias(c) for c in carry])
    rank = F.row_number().over(group.orderBy(F.col("_hit").desc(), *carry))
    return rows.withColumn("_rank", rank).where("_hit OR _rank = 1").drop("_hit", "_rank")


def max_per_pair(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Last-wins per key: the greatest ``value`` for every ``keys`` tuple."""
    return df.groupBy(*keys).agg(F.max(value).alias(out or value))


def latest_value_per_item(df: DataFrame, item: str, label: str, out: str = "label") -> DataFrame:
    """Newest month label (``yyyy-MMM``) per item: parse, max, format back.
    (Distinct (item, label) pairs first would add a shuffle; the partial
    max already collapses duplicates map-side.)"""
    return (df.groupBy(item).agg(F.max(parse_month_label(label)).alias("_d"))
              .select(item, month_label("_d").alias(out)))
