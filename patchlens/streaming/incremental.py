"""Incremental maintenance with Structured Streaming.

The source's insert-triggered views become file streams processed with
``foreachBatch``:

* bulletins landing as ``{YYYY}-{Mon}.xml`` in any sub-folder -> shred, build
  both marts for the months in the micro-batch, replace those months (a month
  delivered again under a new path replaces its rows; the source reads a path
  once, so a file rewritten in place is left to ``backfill``);
* any row stream whose result is defined per month -> recompute the touched
  months from the full input and replace them (month-exact even when a
  micro-batch carries only part of a month);
* host report rows -> keep-latest-per-key table: a log of batches, each
  reduced to its latest row per key, and snapshots that ``compact_latest``
  makes of it; readers take the latest row per key over the newest snapshot
  and the batches after it (nothing is ever read and overwritten at once).

``trigger(availableNow=True)`` processes everything that has landed and
stops, which is how a daily schedule runs it; the checkpoint makes reruns
skip files already done.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens import schemas
from patchlens.operators.windows import latest_per_key
from patchlens.plans.bulletin_warehouse import load_documents
from patchlens.sources.warehouse import overwrite_folder, overwrite_partitions, path_exists, subfolders
from patchlens.sources.xml_bulletins import XML_OPTIONS, with_label

VERSION_COL = "_batch_id"


def bulletin_stream(spark: SparkSession, landing: str, max_files: int = 120) -> DataFrame:
    src = (spark.readStream.format("xml").options(**XML_OPTIONS).schema(schemas.DOCUMENT)
           .option("maxFilesPerTrigger", max_files).load(landing))
    return with_label(src)


def run_available_now(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None],
                      checkpoint: str) -> None:
    """Process all input that has landed, then stop."""
    q = (stream.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def load_bulletin_stream(spark: SparkSession, landing: str, root: str, checkpoint: str,
                         as_of: _dt.datetime | str) -> None:
    """Insert-triggered marts: every landed document is loaded once."""
    run_available_now(bulletin_stream(spark, landing),
                      lambda df, _epoch: load_documents(spark, df, root, as_of), checkpoint)


def month_replacing_batch(recompute: Callable[[list[str]], DataFrame], path: str,
                          label_of: Callable[[DataFrame], DataFrame],
                          partition_by: Sequence[str] = ("doc_xml_date",)) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: find the month labels a micro-batch touches
    (a calendar-bounded list), recompute those months from the full input
    and replace their partitions."""
    def run(batch: DataFrame, _epoch: int) -> None:
        labels = [r[0] for r in label_of(batch).distinct().collect()]
        if labels:
            overwrite_partitions(recompute(labels), path, partition_by)
    return run


def latest_log_batch(path: str, keys: Sequence[str], newest_first: Sequence[str],
                     columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """foreachBatch body of a keep-latest-per-key table kept as a log: the
    batch, reduced to its latest row per key, is written as folder
    ``_batch_id=<epoch>`` (a retried epoch rewrites only its own folder, so the
    sink is exactly-once).  Readers take the latest row per key over them
    (:func:`read_latest`), like a replacing merge on read."""
    def run(batch: DataFrame, epoch: int) -> None:
        rows = latest_per_key(batch.select(*columns), keys, newest_first)
        overwrite_folder(rows, f"{path}/log/{VERSION_COL}={epoch}")
    return run


def _parts(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """(batch up to which the newest snapshot goes, batches after it)."""
    number = lambda names: sorted(int(n.partition("=")[2]) for n in names if "=" in n)
    snapshots = [n for n in number(subfolders(spark, f"{path}/snapshots"))
                 if path_exists(spark, f"{path}/snapshots/upto={n}/_SUCCESS")]
    last = snapshots[-1] if snapshots else None
    return last, [n for n in number(subfolders(spark, f"{path}/log")) if last is None or n > last]


def read_latest(spark: SparkSession, path: str, keys: Sequence[str],
                newest_first: Sequence[str]) -> DataFrame:
    """Latest row per key over the newest snapshot and the batches after it (later batches win ties)."""
    last, batches = _parts(spark, path)
    parts = [(-1 if last is None else last, f"{path}/snapshots/upto={last}")] if last is not None else []
    parts += [(n, f"{path}/log/{VERSION_COL}={n}") for n in batches]
    if not parts:
        raise FileNotFoundError(f"no batch of {path} yet")
    rows = None
    for n, folder in parts:
        part = spark.read.parquet(folder).withColumn(VERSION_COL, F.lit(n).cast("long"))
        rows = part if rows is None else rows.unionByName(part)
    return latest_per_key(rows, keys, [*newest_first, VERSION_COL]).drop(VERSION_COL)


def compact_latest(spark: SparkSession, path: str, keys: Sequence[str], newest_first: Sequence[str]) -> None:
    """Write the latest row per key as a new snapshot, so that later reads rank only it and the
    batches after it."""
    last, batches = _parts(spark, path)
    if batches:
        overwrite_folder(read_latest(spark, path, keys, newest_first), f"{path}/snapshots/upto={batches[-1]}",
                         sort_within=keys)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)
