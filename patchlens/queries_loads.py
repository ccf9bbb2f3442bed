"""Registered queries over bulletins read by byte ranges, trees of any depth, loads at the same time and
the counts that a load takes of odd rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.functions.dates import month_label
from patchlens.plans import bulletin_warehouse as bw
from patchlens.plans import element_walk
from patchlens.queries import AS_OF
from patchlens.queries_bulletins import AGAIN, BARE, deliver, month_facts
from patchlens.queries_io import scratch
from patchlens.queries_xml import _s
from patchlens.sources.xml_bulletins import read_bulletins
from patchlens.sources.xml_split import split_shred
from patchlens.tables import table


def xml_split_scan(spark: SparkSession, d: str) -> DataFrame:
    """Vulnerabilities and statuses of month files that hold one vulnerability for every order, read by byte ranges."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    ordinal = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.concat(F.lit(' Ordinal="'), _s("o_orderkey"), F.lit('"')))
    title = F.concat("o_orderpriority", F.when(F.col("o_orderkey") % 5 == 0, " of a Vulnerability> here").otherwise(""))
    one = F.concat(F.lit("<vuln:Vulnerability"), ordinal, F.lit("><vuln:Title>"), title, F.lit("</vuln:Title><vuln:CVE>CVE-"),
                   _s("o_orderkey"), F.lit('</vuln:CVE><vuln:ProductStatuses><vuln:Status Type="'), "o_orderstatus",
                   F.lit('"><vuln:ProductID>p'), _s(F.col("o_orderkey") % 100),
                   F.lit("</vuln:ProductID></vuln:Status></vuln:ProductStatuses></vuln:Vulnerability>\n"))
    month = o.select(month_label("o_orderdate").alias("label"), F.struct("o_orderkey", one.alias("x")).alias("v")).groupBy(
        "label").agg(F.array_join(F.transform(F.array_sort(F.collect_list("v")), lambda v: v["x"]), "").alias("vs"))
    folder = scratch(spark, "split")
    month.select("label", F.concat(F.lit('<cvrfdoc xmlns:vuln="v"><DocumentTitle>m</DocumentTitle>\n'), "vs",
                                   F.lit("</cvrfdoc>")).alias("xml")).write.partitionBy("label").text(folder)
    tables = split_shred(spark, folder)
    status = tables["vulnerability_status"].select("doc_xml_date", F.col("vulnerability_fk").alias("id"), "status_type", "product_id")
    return tables["vulnerability"].select("doc_xml_date", "id", "cve", "title").join(status, ["doc_xml_date", "id"])


def xml_any_depth(spark: SparkSession, d: str) -> DataFrame:
    """Products below up to 12 branches and the first Title of a vulnerability, two levels down, from texts."""
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    levels = F.sequence(F.lit(1), (F.col("c_custkey") % 12 + 1).cast("int"))
    opened = F.array_join(F.transform(levels, lambda i: F.concat(F.lit('<p:Branch Type="T'), i.cast("string"),
                                                               F.lit('" Name="N'), i.cast("string"), F.lit('">'))), "")
    closed = F.array_join(F.transform(levels, lambda i: F.lit("</p:Branch>")), "")
    text = F.concat(F.lit('<cvrfdoc xmlns:p="p"><p:ProductTree>'), opened, F.lit('<p:FullProductName ProductID="0'),
                    _s("c_custkey"), F.lit('">Part 1.10 &amp; more</p:FullProductName>'), closed,
                    F.lit('</p:ProductTree><Vulnerability Ordinal="1"><Meta><Inner><Title> '), "c_name",
                    F.lit("</Title></Inner></Meta><Title>flat</Title></Vulnerability></cvrfdoc>"))
    texts = c.select(_s("c_custkey").alias("doc"), text.alias("xml"))
    walked = element_walk.elements(texts, ["doc"], "xml")
    titles = element_walk.find(walked, ["doc"], "Vulnerability", "Title").select(
        "doc", F.lit("find").alias("kind"), F.lit("").alias("id"), F.col("text").alias("value"), F.lit("").alias("branch"))
    products = element_walk.walked_products(texts, "doc", "xml").select(
        F.col("doc_xml_date").alias("doc"), F.lit("product").alias("kind"), "id", F.col("product_name").alias("value"),
        F.concat_ws("/", "product_type", "branch_name").alias("branch"))
    return titles.unionByName(products)


def bulletin_loads_at_once(spark: SparkSession, d: str) -> DataFrame:
    """The documents readers see after both deliveries were loaded at the same time: the newer of each month,
    whichever load committed first."""
    base = scratch(spark, "bulletins")
    facts = month_facts(spark, d)
    for number, second in enumerate((False, True)):
        deliver(facts, f"{base}/landing/delivery-{number}", second)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda n: bw.load_documents(spark, read_bulletins(spark, f"{base}/landing/delivery-{n}"), f"{base}/wh",
                                                  AS_OF), range(2)))
    return bw.read_table(spark, f"{base}/wh", "document_info").select("id", "document_title")


def bulletin_quality(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of a load had missing or odd parts, by reason."""
    base = scratch(spark, "bulletins")
    deliver(month_facts(spark, d), f"{base}/landing", False)
    bw.load_documents(spark, read_bulletins(spark, f"{base}/landing"), f"{base}/wh", AS_OF)
    return bw.quality(spark, f"{base}/wh").where("n > 0").select("reason", "n")


QUERIES = {f.__name__: f for f in (xml_split_scan, xml_any_depth, bulletin_loads_at_once, bulletin_quality)}

SQL = {
    "xml_split_scan": """
SELECT strftime(o_orderdate, '%Y-%b') AS doc_xml_date,
       row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%b') ORDER BY o_orderkey) - 1 AS id,
       'CVE-' || o_orderkey AS cve,
       o_orderpriority || CASE WHEN o_orderkey % 5 = 0 THEN ' of a Vulnerability> here' ELSE '' END AS title,
       o_orderstatus AS status_type, 'p' || (o_orderkey % 100) AS product_id
FROM orders WHERE o_orderkey % 7 <> 0
""",
    "xml_any_depth": """
SELECT CAST(c_custkey AS VARCHAR) AS doc, 'find' AS kind, '' AS id, c_name AS value, '' AS branch FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'product', '0' || c_custkey, 'Part 1.10 & more',
                 'T' || (c_custkey % 12 + 1) || '/N' || (c_custkey % 12 + 1) FROM customer
""",
    "bulletin_loads_at_once": f"""
SELECT DISTINCT strftime(o_orderdate, '%Y-%b') AS id,
       CASE WHEN year(o_orderdate) = {AGAIN} THEN 'Corrected ' ELSE 'Month ' END || strftime(o_orderdate, '%Y-%b') AS document_title
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""",
    "bulletin_quality": f"""
WITH b AS (SELECT strftime(o_orderdate, '%Y-%b') AS label, o_orderpriority AS pri, l.* FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
v AS (SELECT DISTINCT label, pri FROM b WHERE NOT (starts_with(label, '{BARE}') AND pri = '5-LOW')),
fix AS (SELECT label, pri, min(l_suppkey) AS kb, CAST(min(l_partkey) AS VARCHAR) AS part FROM b JOIN v USING (label, pri)
        GROUP BY label, pri, l_returnflag),
p AS (SELECT DISTINCT label, kb, unnest([part, 'x' || part]) AS id FROM fix),
known AS (SELECT CAST(min(l_partkey) AS VARCHAR) AS part FROM b GROUP BY label, pri, l_returnflag)
SELECT 'kb that is no number' AS reason, count(*) AS n FROM v
UNION ALL SELECT 'remediation without product', count(*) FROM v
UNION ALL SELECT 'catalog row of an unknown product', count(*) FROM (SELECT DISTINCT label, pri, kb FROM fix) JOIN p USING (label, kb)
          WHERE id NOT IN (SELECT part FROM known)
""",
}
