"""A keep-latest-per-key table in key-range parts, compacted part by part.

Beside the log of batches (:func:`patchlens.streaming.incremental.latest_log_batch`) lie the parts: sorted files
with one row per key, whose key ranges do not overlap, named with their least and greatest key in a numbered
manifest.  Compaction finds the parts that the batches after the manifest touch, merges those with the
batches, splits what has grown beyond ``rows_per_part``, and commits a manifest in which all other parts stand
as they were: its work follows the batches and not the table.  Readers merge the touched parts in the same
way and take the others as they lie, without a shuffle.

The manifest (a row per part) passes through the driver: a part holds a million rows, so 10^10 keys are
10,000 rows.  Batch rows may be late (an older row loses against the part's), tie (the later batch wins) and
have null key columns (nulls come first).  Of two compactions at once the second commit fails and its files
are named nowhere.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens.operators.windows import latest_per_key
from patchlens.sources import commit_log
from patchlens.sources.warehouse import subfolders
from patchlens.streaming.incremental import VERSION_COL

PART = "_part"
MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in ("file", "least", "greatest")]
                        + [T.StructField(n, T.LongType()) for n in ("n", "upto", "version")])


def manifest(spark: SparkSession, path: str) -> list[dict]:
    """The parts of the newest manifest in key order; empty before the first compaction."""
    folder = f"{path}/manifests"
    taken = commit_log.numbers(spark, folder)
    if not taken:
        return []
    rows = commit_log.read(spark, folder, MANIFEST).where(F.col("version") == taken[-1]).collect()
    return [r.asDict() for r in rows]


def _key_type(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(k, schema[k].dataType) for k in keys])


def part_of(key: Column, least: Sequence[str], key_type: T.StructType) -> Column:
    """The number (from 0) of the part whose range holds ``key``: the last with a least key not above it.  The least
    keys, as JSON in key order, are cut into lists of about the root of their number: one comparison list
    finds the list, a second one the place in it."""
    if len(least) < 2:
        return F.lit(0)
    step = math.isqrt(len(least)) + 1
    lists = [least[i:i + step] for i in range(0, len(least), step)]
    parse = lambda text, dt: F.from_json(F.lit(text), T.ArrayType(dt), {"mode": "FAILFAST"})
    heads = parse("[" + ",".join(x[0] for x in lists) + "]", key_type)
    body = parse("[" + ",".join("[" + ",".join(x) + "]" for x in lists) + "]", T.ArrayType(key_type))
    which = F.greatest(F.size(F.filter(heads, lambda b: b <= key)) - 1, F.lit(0))
    place = F.greatest(F.size(F.filter(F.get(body, which), lambda b: b <= key)) - 1, F.lit(0))
    return which * step + place


def _pending(spark: SparkSession, path: str, parts: Sequence[dict], keys: Sequence[str],
             newest_first: Sequence[str]) -> tuple[DataFrame | None, int]:
    """(latest row per key over the batches after the manifest, with its part; the last batch)."""
    upto = parts[0]["upto"] if parts else -1
    batches = sorted(n for n in (int(x.partition("=")[2]) for x in subfolders(spark, f"{path}/log") if "=" in x) if n > upto)
    if not batches:
        return None, upto
    rows = None
    for n in batches:
        part = spark.read.parquet(f"{path}/log/{VERSION_COL}={n}").withColumn(VERSION_COL, F.lit(n).cast("long"))
        rows = part if rows is None else rows.unionByName(part)
    newest = latest_per_key(rows, keys, [*newest_first, VERSION_COL])
    key = F.struct(*keys)
    return newest.withColumn(PART, part_of(key, [p["least"] for p in parts], _key_type(newest.schema, keys))), batches[-1]


def _merged(spark: SparkSession, parts: Sequence[dict], touched: Sequence[int], pending: DataFrame, keys: Sequence[str],
            newest_first: Sequence[str]) -> DataFrame:
    """The touched parts with the pending rows: latest row per key, with its part."""
    rows = pending
    if touched:
        old = spark.read.parquet(*[parts[i]["file"] for i in touched])
        key_type = _key_type(old.schema, keys)
        old = old.withColumn(VERSION_COL, F.lit(-1).cast("long")).withColumn(
            PART, part_of(F.struct(*keys), [p["least"] for p in parts], key_type))
        rows = old.unionByName(pending)
    return latest_per_key(rows, keys, [*newest_first, VERSION_COL]).drop(VERSION_COL)


def _touched(pending: DataFrame) -> list[int]:
    return sorted(r[0] for r in pending.select(PART).distinct().collect())


def compact_parts(spark: SparkSession, path: str, keys: Sequence[str], newest_first: Sequence[str],
                  rows_per_part: int = 1_000_000) -> bool:
    """Merge the batches after the manifest into the parts they touch.  False when another compaction took
    the manifest's number first, or when there is nothing to merge."""
    parts = manifest(spark, path)
    pending, upto = _pending(spark, path, parts, keys, newest_first)
    if pending is None:
        return False
    touched = _touched(pending)
    if not touched:  # the batches are empty
        return False
    touched = touched if parts else []
    rows = _merged(spark, parts, touched, pending, keys, newest_first)
    size = sum(parts[i]["n"] for i in touched) + pending.count()
    folder = f"{path}/parts/{uuid.uuid4().hex}"
    # a file per task and touched part, so that no new range reaches into a part that stays
    (rows.repartitionByRange(max(1, math.ceil(size / rows_per_part)), PART, *keys).sortWithinPartitions(PART, *keys)
         .write.partitionBy(PART).parquet(folder))
    written = spark.read.parquet(folder).drop(PART)
    key = F.struct(*keys)
    text = {"ignoreNullFields": "false"}
    new = written.groupBy(F.input_file_name().alias("file")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("lo").select(
        "file", F.to_json("lo", text).alias("least"), F.to_json("hi", text).alias("greatest"), "n",
        F.regexp_extract("file", f"/{PART}=(\\d+)/", 1).cast("int").alias("of")).collect()
    split: dict[int, list[dict]] = {}
    for r in new:
        split.setdefault(r["of"], []).append({k: r[k] for k in ("file", "least", "greatest", "n")})
    number = (parts[0]["version"] if parts else 0) + 1
    listed = [x for i, p in enumerate(parts or [{}]) for x in (split[i] if i in split else [p])]
    return commit_log.commit(spark, f"{path}/manifests", number, [
        {**{k: x[k] for k in ("file", "least", "greatest", "n")}, "upto": upto, "version": number} for x in listed])


def read_parts(spark: SparkSession, path: str, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The latest row per key: touched parts merged with the batches after the manifest, the others as they lie."""
    parts = manifest(spark, path)
    pending, _ = _pending(spark, path, parts, keys, newest_first)
    if pending is None:
        if not parts:
            raise FileNotFoundError(f"no batch of {path} yet")
        return spark.read.parquet(*[p["file"] for p in parts])
    touched = _touched(pending) if parts else []
    merged = _merged(spark, parts, touched, pending, keys, newest_first).drop(PART)
    rest = [p["file"] for i, p in enumerate(parts) if i not in set(touched)]
    return spark.read.parquet(*rest).select(*merged.columns).unionByName(merged) if rest else merged
