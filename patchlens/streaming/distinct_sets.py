"""Distinct values over all months, kept up to date month by month.

A month's distinct values are its state; an update writes the state of the months it delivers and, as its
difference from their last one, how many months more or fewer hold a value.  The distinct values of all
months are those whose differences sum to more than none, so a new, late or corrected month reads its own
rows and its own last state, and no other month.  Sums merge in any order: ``compact`` folds them into one.

Updates have numbers; an update that is retried looks at the states before its number and so writes the
same folders again.  An update replaces its months whole; ``months`` names those that may have no row left.
Null values are not counted, null months are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.sources.warehouse import overwrite_folder, path_exists, subfolders

NUMBER, MONTH = "_update", "month"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The finished folders ``_update=n`` of ``folder``, ascending."""
    found = sorted(int(n.partition("=")[2]) for n in subfolders(spark, folder) if n.startswith(NUMBER + "="))
    return [n for n in found if path_exists(spark, f"{folder}/{NUMBER}={n}/_SUCCESS")]


def _last_states(spark: SparkSession, path: str, months: Sequence[str], before: int) -> list[str]:
    """The folders of the last state of each of ``months`` before an update (a folder per month)."""
    left, out = set(months), []
    for n in reversed([x for x in _numbers(spark, f"{path}/states") if x < before]):
        if not left:
            break
        here = {f"{MONTH}={m}" for m in left} & set(subfolders(spark, f"{path}/states/{NUMBER}={n}"))
        out += [f"{path}/states/{NUMBER}={n}/{x}" for x in sorted(here)]
        left -= {x.partition("=")[2] for x in here}
    return out


def update(spark: SparkSession, path: str, rows: DataFrame, month: str, value: str, number: int,
           months: Sequence[str] = ()) -> None:
    """Replace the months of ``rows`` (and ``months``) by the distinct values that ``rows`` hold of them."""
    new = rows.select(F.col(month).alias(MONTH), F.col(value).alias("value")).where(F.col(MONTH).isNotNull()).distinct()
    labels = sorted({r[0] for r in new.select(MONTH).distinct().collect()} | set(months))  # twelve a year
    # a row without a value stands for the month itself, so that an emptied month has a state too
    marks = spark.createDataFrame([(m,) for m in labels], f"{MONTH} string").withColumn(
        "value", F.lit(None).cast(new.schema["value"].dataType))
    (new.where("value IS NOT NULL").union(marks).hint("rebalance", MONTH).sortWithinPartitions(MONTH, "value")
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH)
        .parquet(f"{path}/states/{NUMBER}={number}"))
    states = f"{path}/states/{NUMBER}={number}"
    now = spark.read.option("basePath", states).parquet(states).select("value", F.lit(1).cast("long").alias("months"))
    before = _last_states(spark, path, labels, number)
    if before:
        now = now.union(spark.read.option("recursiveFileLookup", "true").parquet(*before).select("value", F.lit(-1).cast("long")))
    change = now.where("value IS NOT NULL").groupBy("value").agg(F.sum("months").alias("months")).where("months <> 0")
    overwrite_folder(change, f"{path}/changes/{NUMBER}={number}", sort_within=["value"])


def months_by_value(spark: SparkSession, path: str) -> DataFrame:
    """(value, months): every value that some month holds now, and how many months do."""
    snapshots = _numbers(spark, f"{path}/snapshots")
    folders = [f"{path}/snapshots/{NUMBER}={snapshots[-1]}"] if snapshots else []
    folders += [f"{path}/changes/{NUMBER}={n}" for n in _numbers(spark, f"{path}/changes") if not snapshots or n > snapshots[-1]]
    if not folders:
        raise FileNotFoundError(f"no update of {path} yet")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*folders)
    return rows.groupBy("value").agg(F.sum("months").alias("months")).where("months > 0")


def compact(spark: SparkSession, path: str) -> None:
    """Fold all changes so far into one snapshot."""
    done = _numbers(spark, f"{path}/changes")
    if done:
        overwrite_folder(months_by_value(spark, path), f"{path}/snapshots/{NUMBER}={done[-1]}", sort_within=["value"])
