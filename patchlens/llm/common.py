"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, so
    an executor lost later costs a re-read and not the work before it."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (a stored table: counting it is cheap) to be broadcast if it has at most ``rows`` rows;
    beyond that Spark shuffles both sides of its join."""
    return F.broadcast(df) if df.count() <= rows else df


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows round over ``spark.sql.shuffle.partitions`` tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def text_slices(texts, limit: int = 16 << 20):
    """(from, to) row ranges of an Arrow string array of about ``limit`` bytes each."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, to
        at = to
