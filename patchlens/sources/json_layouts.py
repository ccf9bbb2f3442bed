"""JSON layouts: column layout (``{"col": [v1, v2, ..], ...}``) and records
(one object per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_to_columns_json(df: DataFrame, group_by: Sequence[str], columns: Sequence[str],
                         out: str = "doc") -> DataFrame:
    """Per group, one JSON object holding one array per column, in row
    order.  Rows are collected as one struct list so the arrays stay
    aligned; use it on groups of bounded size."""
    rows = F.array_sort(F.collect_list(F.struct(*columns)))
    g = df.groupBy(*group_by).agg(rows.alias("_rows"))
    def field(name):
        return lambda r: r[name]
    obj = F.struct(*[F.transform("_rows", field(c)).alias(c) for c in columns])
    return g.select(*group_by, F.to_json(obj).alias(out))


def columns_json_to_rows(df: DataFrame, json_col: str, row_schema: T.StructType) -> DataFrame:
    """Column-layout JSON -> rows: parse with an explicit schema (one array
    per column), zip the arrays, one row per position."""
    layout = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType), True) for f in row_schema.fields])
    others = [c for c in df.columns if c != json_col]
    parsed = df.select(*others, F.from_json(json_col, layout).alias("_j"))
    zipped = F.arrays_zip(*[F.col(f"_j.{f.name}").alias(f.name) for f in row_schema.fields])
    return parsed.select(*others, F.inline(zipped))


# timestamps keep their microseconds through the text form
TS_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_records(df: DataFrame, path: str) -> None:
    """Records JSON, one object per line, UTF-8 text kept as is."""
    df.write.mode("overwrite").options(**TS_OPTIONS).json(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Explicit schema: an all-digit text column stays text."""
    return spark.read.schema(schema).options(**TS_OPTIONS).json(path)
