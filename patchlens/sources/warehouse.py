"""Warehouse tables: typed creation, positional-rename appends, idempotent
monthly partition overwrite, already-loaded probes and the month spine."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens.functions.dates import month_label

LABEL_COL = "doc_xml_date"


def month_spine(bounds: DataFrame, first_year: str, last_year: str, label: str = "label") -> DataFrame:
    """Every month label from January of ``first_year`` to December of
    ``last_year`` (12 labels a year).  ``bounds`` has one row; the spine is
    bounded by the calendar, never by the data volume."""
    start = F.make_date(F.col(first_year), F.lit(1), F.lit(1))
    end = F.make_date(F.col(last_year), F.lit(12), F.lit(1))
    months = bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 month"))).alias("month_start"))
    return months.select(month_label("month_start").alias(label), "month_start")


def months_between_years(spark: SparkSession, first_year: int, last_year: int,
                         label: str = "label") -> DataFrame:
    bounds = spark.range(1).select(F.lit(first_year).alias("y0"), F.lit(last_year).alias("y1"))
    return month_spine(bounds, "y0", "y1", label)


def missing_labels(spine: DataFrame, loaded: DataFrame, label: str = "label",
                   loaded_label: str = LABEL_COL) -> DataFrame:
    """Months of the spine that have no loaded rows yet (``left_anti``)."""
    have = loaded.select(F.col(loaded_label).alias(label)).distinct()
    return spine.join(have, label, "left_anti")


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Bind columns by position to the target table's names."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns for {len(names)} names")
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in zip(df.columns, names)])


def with_load_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Columns the target table fills by default when the load omits them
    (e.g. ``timestamp`` = the run's as-of time, ``title`` = '')."""
    for name, value in defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType, path: str,
                           partition_by: Sequence[str] = (LABEL_COL,)) -> None:
    if spark.catalog.tableExists(name):
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts} LOCATION '{path}'")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = (LABEL_COL,),
                         sort_within: Sequence[str] = ()) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic partition
    overwrite): loading a month twice leaves the same rows as loading it
    once.  Rows are rebalanced on ``partition_by``: small partitions meet in
    few files, a large one is split over many tasks.  Files are sorted by
    ``partition_by``, then ``sort_within``, for row-group pruning."""
    out = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_within)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path))


def overwrite_folder(df: DataFrame, path: str, sort_within: Sequence[str] = ()) -> None:
    """Replace one folder (a run, a batch) by ``df``, over as many tasks as its size asks for."""
    out = df.hint("rebalance")
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    out.write.mode("overwrite").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    if not path_exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def as_of_timestamp(as_of: str | _dt.datetime) -> _dt.datetime:
    return as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
