"""Joins: default-filling left join, equi + range join."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def type_default(dt: T.DataType) -> Column:
    """The value a non-nullable column of this type takes when an outer join
    finds no partner: '' for text, 0 for numbers, [] for arrays, epoch for
    dates and timestamps, false for booleans."""
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                       T.FloatType, T.DoubleType, T.DecimalType)):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.DateType):
        return F.lit(_dt.date(1970, 1, 1))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(_dt.datetime(1970, 1, 1)).cast(dt)
    if isinstance(dt, T.ArrayType):
        return F.array().cast(dt)
    if isinstance(dt, T.MapType):
        return F.create_map().cast(dt)
    raise TypeError(f"no default for {dt.simpleString()}")


def left_join_with_defaults(left: DataFrame, right: DataFrame, on: Sequence[str],
                            keep_null: Iterable[str] = (),
                            defaults: Mapping[str, object] | None = None,
                            null_safe: bool = False) -> DataFrame:
    """``left LEFT JOIN right USING (on)``; right-side columns of unmatched
    rows get their type default instead of NULL, except those in
    ``keep_null`` (the nullable ones).  ``defaults`` overrides per column.
    ``null_safe`` makes NULL keys match each other (``<=>``), as a pandas
    merge does; by default a NULL key matches nothing."""
    keep = set(keep_null)
    defaults = dict(defaults or {})
    if null_safe:
        r = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
        cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in on]
        joined = left.join(r, cond, "left").drop(*[f"_r_{c}" for c in on])
    else:
        joined = left.join(right, list(on), "left")
    out = []
    right_cols = {f.name: f.dataType for f in right.schema.fields if f.name not in on}
    for name in joined.columns:
        if name in right_cols and name not in keep:
            fill = F.lit(defaults[name]).cast(right_cols[name]) if name in defaults \
                else type_default(right_cols[name])
            out.append(F.coalesce(F.col(name), fill).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*out)


def filled_with_defaults(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """``df`` as :func:`left_join_with_defaults` on ``on`` shows its rows: type defaults instead of NULL but in ``on``."""
    return df.select(*[F.col(f.name) if f.name in on else F.coalesce(F.col(f.name), type_default(f.dataType)).alias(f.name)
                       for f in df.schema.fields])


def range_join(left: DataFrame, right: DataFrame, eq: Sequence[tuple[str, str]],
               right_greater: tuple[str, str] | None = None,
               right_at_least: tuple[str, str] | None = None,
               how: str = "inner", salt: int = 1) -> DataFrame:
    """Equi join on ``eq`` (left, right) column pairs plus
    ``right.r > left.l`` (``right_greater``) or ``>=`` (``right_at_least``).

    The equality keys give Spark a hash or sort-merge join; the range test
    is a residual filter inside it, so no nested loop or Cartesian product
    is planned.  ``salt > 1`` splits every left key group into ``salt``
    parts and copies the right side that many times, for when one equality
    key holds a large share of the left rows (AQE's skew split covers the
    rest).  Result: all left columns, then the right columns whose names
    the left side does not have.
    """
    if salt > 1:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]),
                                               F.lit(salt)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        eq = [*eq, ("_salt", "_salt")]
    lt, rt = left.alias("_lt"), right.alias("_rt")
    cond = [F.col(f"_lt.{lc}") == F.col(f"_rt.{rc}") for lc, rc in eq]
    if right_greater:
        cond.append(F.col(f"_rt.{right_greater[1]}") > F.col(f"_lt.{right_greater[0]}"))
    if right_at_least:
        cond.append(F.col(f"_rt.{right_at_least[1]}") >= F.col(f"_lt.{right_at_least[0]}"))
    joined = lt.join(rt, cond, how)
    cols = [F.col(f"_lt.{c}") for c in left.columns if c != "_salt"]
    cols += [F.col(f"_rt.{c}") for c in right.columns if c not in left.columns and c != "_salt"]
    return joined.select(*cols)
