"""Registered queries that go through storage: JSON layouts, positional
loads with defaults, idempotent month overwrite, and Structured Streaming
(insert-triggered marts and a keep-latest table), each checked against the
batch result.

Files go to a fresh folder under the session's shared checkpoint location
(``spark.checkpoint.dir``), never to a machine-local temp folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.functions.dates import TS_FORMAT, month_label
from patchlens.queries import AS_OF, mart_catalog_top_build, mart_wide_star
from patchlens.session import checkpoint_dir
from patchlens.sources import json_layouts
from patchlens.sources.warehouse import (overwrite_partitions, rename_by_position,
                                         with_load_defaults)
from patchlens.streaming import distinct_sets, incremental, key_parts
from patchlens.tables import table


def scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "patchlens-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def json_columns_to_rows(spark: SparkSession, d: str) -> DataFrame:
    """Column-layout JSON (``{"col": [..], ...}``) read back to rows.  One
    object per (order, line number) group of lineitem - groups of one or a
    few rows, so no object grows with the table while the work does."""
    li = table(spark, d, "lineitem")
    cols = ["l_partkey", "l_suppkey", "l_quantity"]
    layout = json_layouts.rows_to_columns_json(li, ["l_orderkey", "l_linenumber"], cols, "doc")
    return json_layouts.columns_json_to_rows(layout, "doc", li.select(*cols).schema)


def json_records_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    path = scratch(spark, "events-json")
    json_layouts.write_records(ev, path)
    back = json_layouts.read_records(spark, path, ev.schema)
    return back.select("event_id", "user_id", "event_type", "value", "props",
                       F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"))


def rename_and_default_load(spark: SparkSession, d: str) -> DataFrame:
    sup = table(spark, d, "supplier").drop("s_acctbal")
    loaded = rename_by_position(sup, ["id", "name", "nation_id"])
    loaded = with_load_defaults(loaded, {"title": "", "timestamp": F.lit(AS_OF).cast("timestamp")})
    path = scratch(spark, "supplier-load")
    loaded.write.mode("append").parquet(path)
    back = spark.read.parquet(path)
    return back.select("id", "name", "nation_id", "title",
                       F.date_format("timestamp", TS_FORMAT).alias("loaded_at"))


def overwrite_month_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """Load every month, then load one month again: same rows as once."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey",
                                         month_label("o_orderdate").alias("doc_xml_date"))
    path = scratch(spark, "orders-by-month")
    overwrite_partitions(o, path, ["doc_xml_date"], sort_within=["o_orderkey"])
    again = o.where(F.col("doc_xml_date") == month_label(F.lit(AS_OF).cast("date")))
    overwrite_partitions(again, path, ["doc_xml_date"], sort_within=["o_orderkey"])
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "doc_xml_date")


def _table_glob(d: str, name: str) -> str:
    # a file stream watches a folder or a glob; the driver tables are single
    # files, so name the file through a one-file glob
    return f"{d.rstrip('/')}/[{name[0]}]{name[1:]}.parquet"


def _orders_stream(spark, d):
    o = table(spark, d, "orders")
    return incremental.file_stream(spark, _table_glob(d, "orders"), o.schema, max_files=1)


def _stream_months(spark, d, build, name) -> DataFrame:
    out = scratch(spark, name)
    body = incremental.month_replacing_batch(lambda labels: build(spark, d, labels), out,
                                             lambda b: b.select(month_label("o_orderdate")))
    incremental.run_available_now(_orders_stream(spark, d), body, os.path.join(out + "-ckpt"))
    return spark.read.parquet(out)


def stream_star_mart(spark: SparkSession, d: str) -> DataFrame:
    df = _stream_months(spark, d, mart_wide_star, "stream-star")
    return df.select("doc_xml_date", "cve", "vul_title", "cwe", "status_type", "status_product_id",
                     "base_score", "temporal_score", "score_set_product_id",
                     "doc_initial_relise_date", "doc_current_relise_date")


def stream_catalog(spark: SparkSession, d: str) -> DataFrame:
    df = _stream_months(spark, d, mart_catalog_top_build, "stream-catalog")
    return df.select("doc_xml_date", "cve", "kb", "kb_product_id", "product_names", "fixed_build",
                     "base_score", "temporal_score", "cwe", "vul_title")


def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    out = scratch(spark, "stream-latest")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    body = incremental.latest_log_batch(out, keys, order, ["user_id", "event_type", "ts", "event_id", "value"])
    stream = incremental.file_stream(spark, _table_glob(d, "events"), ev.schema, max_files=1)
    incremental.run_available_now(stream, body, out + "-ckpt")
    return incremental.read_latest(spark, out, keys, order).select("user_id", "event_type", "event_id", "value")


def distinct_sets_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (part, quantity) values over all order months and how many months hold each, after three updates: the months
    before 1997, those of 1995 again without flag N, and the rest; the first two are folded into a snapshot."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        month_label("o_orderdate").alias("m"), F.year("o_orderdate").alias("y"), "l_returnflag",
        F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_quantity").cast("int").cast("string")).alias("v"))
    out = scratch(spark, "distinct-sets")
    distinct_sets.update(spark, out, lines.where("y < 1997"), "m", "v", 0)
    again = lines.where("y = 1995")
    months = [r[0] for r in again.select("m").distinct().collect()]
    distinct_sets.update(spark, out, again.where("l_returnflag <> 'N'"), "m", "v", 1, months)
    distinct_sets.compact(spark, out)
    distinct_sets.update(spark, out, lines.where("y >= 1997"), "m", "v", 2)
    return distinct_sets.months_by_value(spark, out)


def stream_key_parts(spark: SparkSession, d: str) -> DataFrame:
    """The keep-latest table in key-range parts: all events in four batches by time, compacted after each but the last."""
    ev = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    out = scratch(spark, "stream-parts")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    log = incremental.latest_log_batch(out, keys, order, ev.columns)
    ev.repartitionByRange(4, "ts").write.parquet(out + "-landing")

    def body(batch: DataFrame, epoch: int) -> None:
        if epoch:
            key_parts.compact_parts(spark, out, keys, order, rows_per_part=10_000)
        log(batch, epoch)

    incremental.run_available_now(incremental.file_stream(spark, out + "-landing", ev.schema, max_files=1), body, out + "-ckpt")
    return key_parts.read_parts(spark, out, keys, order).select("user_id", "event_type", "event_id", "value")


QUERIES = {
    "json_columns_to_rows": json_columns_to_rows,
    "json_records_roundtrip": json_records_roundtrip,
    "rename_and_default_load": rename_and_default_load,
    "overwrite_month_idempotent": overwrite_month_idempotent,
    "stream_star_mart": stream_star_mart,
    "stream_catalog": stream_catalog,
    "stream_latest": stream_latest,
    "stream_key_parts": stream_key_parts,
    "distinct_sets_by_month": distinct_sets_by_month,
}
