"""Registered queries over warehouse tables of the session catalog: defaults of the DDL, co-located staging."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.functions.dates import TS_FORMAT, month_label
from patchlens.plans import bulletin_warehouse as bw
from patchlens.plans.marts import cve_mart
from patchlens.queries import AS_OF
from patchlens.queries_io import scratch
from patchlens.queries_xml import _s
from patchlens.tables import table

DOC = "doc_xml_date"
BUCKETS = 16
ROWS_PER_BUCKET = 250_000  # of the largest table, which a task reads and sorts beside the others


def _catalog(spark: SparkSession, rows: int = 0):
    buckets = max(BUCKETS, -(-rows // ROWS_PER_BUCKET))
    return bw.catalog(spark, f"patchlens_{uuid.uuid4().hex[:12]}", scratch(spark, "catalog"), buckets)


def _loads(spark: SparkSession, d: str, load_id: int) -> DataFrame:
    """Every month of the orders as loaded by ``load_id`` (a list of month labels, twelve a year)."""
    months = table(spark, d, "orders").select(month_label("o_orderdate")).distinct().collect()
    return spark.createDataFrame([(m[0], load_id) for m in months], f"{DOC} string, load_id long")


def catalog_load_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Loads that leave out ``title``, ``timestamp`` and never-null columns read back with the defaults of the DDL."""
    tables = _catalog(spark)
    tables.create()
    o = table(spark, d, "orders").withColumn(DOC, month_label("o_orderdate"))
    tables.write("vulnerability_notes", o.select(F.col("o_orderkey").alias("vulnerability_fk"), DOC,
                                                 F.col("o_orderpriority").alias("note")), 1, AS_OF)
    tables.write("cve_data", o.select(DOC, _s("o_orderkey").alias("cve")), 1, AS_OF)
    loads = _loads(spark, d, 1)
    notes = tables.read("vulnerability_notes", loads).select(
        "vulnerability_fk", F.col("title").alias("note_title"), "notes_type", "note")
    cve = tables.read("cve_data", loads).select(
        DOC, F.col("cve").cast("long").alias("vulnerability_fk"), F.date_format("timestamp", TS_FORMAT).alias("timestamp"), "cwe",
        "kb", F.col("rev_number").cast("double").alias("rev_number"), F.size("kb_product_id").alias("products"),
        F.date_format("doc_initial_relise_date", TS_FORMAT).alias("released"))
    return cve.join(notes, "vulnerability_fk")


def line_staging(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Staging rows of one vulnerability per order, its children taken from the order's lines."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate",
                                         month_label("o_orderdate").alias(DOC))
    li = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    fk = F.col("o_orderkey").alias("vulnerability_fk")
    return {
        "vulnerability": o.select(F.col("o_orderkey").alias("id"), DOC, F.concat(F.lit("CVE-"), _s("o_orderkey")).alias("cve"),
                                  F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("cwe"),
                                  F.lit("").alias("cwe_text")),
        "vulnerability_status": li.select(fk, DOC, F.col("l_linestatus").alias("status_type"), _s("l_partkey").alias("product_id")),
        "vulnerability_notes": li.select(fk, DOC, F.lit("Description").alias("notes_type"), F.col("l_returnflag").alias("note")),
        "vulnerability_threats": o.where("o_orderkey % 3 <> 0").select(
            fk, DOC, F.lit("Severity").alias("threats_type"), F.col("o_orderpriority").alias("description"),
            F.lit("").alias("product_id")),
        "vulnerability_score_set": li.select(
            fk, DOC, F.format_string("%.2f", "l_discount").alias("base_score"), F.lit("").alias("temporal_score"),
            F.lit("").alias("vector"), _s("l_suppkey").alias("product_id")),
        "vulnerability_revision": li.select(fk, DOC, _s("l_linenumber").alias("number"),
                                            F.date_format("l_shipdate", "yyyy-MM-dd").alias("revision_date"),
                                            F.concat("l_returnflag", "l_linestatus").alias("description")),
        "vulnerability_remediation": li.where("l_returnflag = 'R'").select(
            fk, DOC, _s("l_suppkey").alias("kb"), F.array(_s("l_partkey")).alias("product_id"),
            F.concat(F.lit("10.0."), _s(F.col("l_quantity").cast("int"))).alias("fixed_build")),
        "document_info": o.groupBy(DOC).agg(F.max("o_orderdate").cast("timestamp").alias("current_relise_date")).select(
            F.col(DOC).alias("id"), DOC, "current_relise_date", F.concat(F.lit("Month "), DOC).alias("document_title")),
    }


def write_line_staging(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The rows of :func:`line_staging`, written to bucketed tables and read from their buckets."""
    tables = _catalog(spark, table(spark, d, "lineitem").count())
    tables.create()
    staging = line_staging(spark, d)
    for name, rows in staging.items():
        tables.write(name, rows, 1, AS_OF)
    loads = _loads(spark, d, 1)
    return {name: tables.read(name, loads) for name in staging}


def catalog_co_located_star(spark: SparkSession, d: str) -> DataFrame:
    """The six-child star of one vulnerability per order, joined bucket by bucket."""
    arrays = ["status_product_id", "note", "threats_type", "treat_description", "score_set_product_id", "kb_product_id"]
    cve = cve_mart(write_line_staging(spark, d), AS_OF, co_located=True, apart=True)
    return cve.select(DOC, "cve", "vul_title", "cwe", "status_type", "base_score", F.col("rev_number").cast("double").alias("rev_number"),
                      "rev_date", "rev_description", "fixed_build", "kb", "doc_document_title",
                      F.date_format("doc_current_relise_date", TS_FORMAT).alias("doc_current_relise_date"),
                      *[F.array_join(c, ",").alias(c) for c in arrays])


QUERIES = {f.__name__: f for f in (catalog_load_defaults, catalog_co_located_star)}

SQL = {
    "catalog_load_defaults": """
SELECT o_orderkey AS vulnerability_fk, strftime(o_orderdate, '%Y-%b') AS doc_xml_date, '1998-03-10 00:00:00' AS timestamp,
       CAST(NULL AS VARCHAR) AS cwe, '' AS kb, CAST(0 AS DOUBLE) AS rev_number, CAST(0 AS INTEGER) AS products,
       '1970-01-01 00:00:00' AS released, '' AS note_title, CAST(NULL AS VARCHAR) AS notes_type, o_orderpriority AS note
FROM orders
""",
    "catalog_co_located_star": """
WITH b AS (SELECT strftime(o_orderdate, '%Y-%b') AS label, l.* FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
st AS (SELECT l_orderkey AS k, l_linestatus AS status_type,
              string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS products FROM b GROUP BY ALL),
nt AS (SELECT l_orderkey AS k, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS note FROM b GROUP BY ALL),
sc AS (SELECT l_orderkey AS k, printf('%.2f', l_discount) AS base,
              string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS products FROM b GROUP BY ALL),
mx AS (SELECT l_orderkey AS k, strftime(max(l_shipdate), '%Y-%m-%d') AS d, max(l_linenumber) AS n FROM b GROUP BY ALL),
rv AS (SELECT mx.*, coalesce(l_returnflag || l_linestatus, '') AS text FROM mx LEFT JOIN b ON k = l_orderkey AND n = l_linenumber
       AND strftime(l_shipdate, '%Y-%m-%d') = d),
rem AS (SELECT l_orderkey AS k, CAST(l_suppkey AS VARCHAR) AS kb, CAST(l_partkey AS VARCHAR) AS part,
               '10.0.' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS build FROM b WHERE l_returnflag = 'R'),
doc AS (SELECT strftime(o_orderdate, '%Y-%b') AS label, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last FROM orders GROUP BY ALL)
SELECT DISTINCT label AS doc_xml_date, 'CVE-' || o_orderkey AS cve, o_orderpriority AS vul_title, o_orderstatus AS cwe,
       coalesce(status_type, '') AS status_type, coalesce(base, '') AS base_score, CAST(coalesce(n, 0) AS DOUBLE) AS rev_number,
       coalesce(d, '') AS rev_date, coalesce(text, '') AS rev_description, coalesce(build, '') AS fixed_build,
       coalesce(kb, '') AS kb, 'Month ' || label AS doc_document_title, last AS doc_current_relise_date,
       coalesce(st.products, '') AS status_product_id, coalesce(note, '') AS note,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'Severity' ELSE '' END AS threats_type,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE '' END AS treat_description,
       coalesce(sc.products, '') AS score_set_product_id, coalesce(part, '') AS kb_product_id
FROM orders JOIN doc ON label = strftime(o_orderdate, '%Y-%b') LEFT JOIN st ON st.k = o_orderkey LEFT JOIN nt ON nt.k = o_orderkey
LEFT JOIN sc ON sc.k = o_orderkey LEFT JOIN rv ON rv.k = o_orderkey LEFT JOIN rem ON rem.k = o_orderkey
""",
}
