"""Registered queries for the host side, the remaining bulletin children, the
null-safe join and the ordered sink."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens import schemas
from patchlens.functions.dates import day_text, month_label
from patchlens.operators.joins import left_join_with_defaults
from patchlens.operators.ranges import blocked
from patchlens.plans import bulletin_warehouse as bw
from patchlens.plans import analog, exposure, shred
from patchlens.queries import AS_OF
from patchlens.queries_io import scratch
from patchlens.queries_xml import _render, _s, _typed, order_documents
from patchlens.sources.xml_bulletins import parse_bulletin_text
from patchlens.tables import table

LINES = {0: "Windows 10", 1: "Windows Server 2019", 2: "Windows 7"}  # by nation key modulo 4; 3: another system


def _line(nation: str, suffix: str):
    out = F.lit("Plan 9")
    for k, v in LINES.items():
        out = F.when(F.col(nation) % 4 == k, F.lit(v)).otherwise(out)
    return F.concat(out, F.lit(suffix))


def host_report_arrays(spark: SparkSession, d: str) -> DataFrame:
    """The host report from catalog, patch and system tables: advisories dropped, product and
    system names normalised, recent rows only, the recommended list as the array it is stored as."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    msrc = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        _line("s_nationkey", " for x64").alias("product_names"), month_label("o_orderdate").alias("doc_xml_date"),
        F.col("l_shipdate").cast("timestamp").alias("doc_initial_relise_date"), _s("l_partkey").alias("kb"),
        F.concat(F.when(F.col("s_suppkey") % 5 == 0, "ADV").otherwise("CVE-"), _s("s_suppkey")).alias("cve"))
    patches = lines.select(_s("o_custkey").alias("hostname"), F.concat(F.lit("KB"), _s("l_partkey")).alias("hotfix_id"),
                           day_text("l_shipdate").alias("installed_on"),
                           F.col("o_orderdate").cast("timestamp").alias("timestamp"))
    system = table(spark, d, "customer").select(
        _s("c_custkey").alias("hostname"), F.concat(F.lit("Microsoft "), _line("c_nationkey", " Pro")).alias("os_name"),
        F.col("c_name").alias("codename"), F.col("c_mktsegment").alias("version"),
        (F.col("c_custkey") * 1000).alias("install_date"), F.lit(_dt.datetime.fromisoformat(AS_OF)).alias("timestamp"))
    rep = bw.host_report(msrc, patches, system, AS_OF, recency="calendar", form=exposure.ENTRIES_AS_JSON)
    return rep.select("hostname", "os_name", "os_version", "last_kb", "last_kb_date", "last_update_date",
                      F.col("rec_kb_arr").alias("rec_kb_json"), "cve")


def exposure_one_line(spark: SparkSession, d: str) -> DataFrame:
    """All hosts and the whole catalog on one product line: how many cves are open and how many patches
    recommended, and where the recommended list begins in the line's whole list."""
    c, line, kb = exposure.CatalogCols(), ["_line"], F.col("last_kb").alias("_hkb")
    catalog = analog.catalog(spark, d).withColumn("product", F.lit("all"))
    hosts = analog.installed(spark, d)
    pairs = blocked(hosts.select(F.lit("all").alias("_line"), kb).distinct(), line, "_hkb", 256)
    n_open = exposure.pair_cve_blocks(pairs, catalog, c, 256, listed=False).select("_hkb", F.col("_n").alias("n_open"))
    entries = blocked(exposure.kb_release_dates(catalog, c), line, "kb", 256)
    starts = exposure._list_starts(pairs, entries, 256)
    whole = entries.groupBy("_line").agg(F.count(F.lit(1)).alias("_all"))
    tails = exposure.list_tails(starts, entries).join(whole, "_line").select(
        "_start", F.col("_rank").alias("list_rank"), (F.col("_all") - F.col("_rank")).alias("n_recommended"))
    of_pair = starts.join(tails, "_start").select("_hkb", "list_rank", "n_recommended").join(n_open, "_hkb", "full")
    return hosts.join(of_pair, hosts["last_kb"] == of_pair["_hkb"], "left").select(
        "hostname", "last_kb", F.coalesce("n_open", F.lit(0)).alias("n_open"), F.coalesce("list_rank", F.lit(-1)).alias("list_rank"),
        F.coalesce("n_recommended", F.lit(0)).alias("n_recommended"))


def xml_remaining_children(spark: SparkSession, d: str) -> DataFrame:
    """Acknowledgments, vulnerability notes and revisions (first of repeated children), and the
    namespace declarations, one document per customer."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    V = {f.name: f.dataType for f in schemas.VULNERABILITY.fields}
    thanks = F.struct(F.array(F.struct(F.array("c_name", "c_mktsegment").alias("Name"),
                                       F.array(F.lit("u1"), F.lit("u2")).alias("URL"))).alias("Acknowledgment"))
    revision = F.struct(F.array(F.struct(F.array(F.lit("1.0"), F.lit("9.9")).alias("Number"),
                                         F.array(F.lit("2024-01-09"), F.lit("x")).alias("Date"),
                                         F.array("c_mktsegment", "c_name").alias("Description"))).alias("Revision"))
    note = F.struct(F.array(F.struct(F.lit("Name").alias("_Title"), F.lit("Details").alias("_Type"), F.lit("1").alias("_Ordinal"),
                                     F.col("c_name").alias("_VALUE"))).alias("Note"))
    v = _typed(schemas.VULNERABILITY, _Ordinal=F.lit("1"), CVE=F.concat(F.lit("CVE-"), _s("c_custkey")),
               Acknowledgments=thanks.cast(V["Acknowledgments"]), RevisionHistory=revision.cast(V["RevisionHistory"]),
               Notes=note.cast(V["Notes"]))
    doc = F.struct(*[F.concat(F.lit(f"urn:{i}:"), _s("c_nationkey")).alias(a)
                     for i, a in enumerate(schemas.NAMESPACE_ATTRS)], F.array(v).alias("Vulnerability"))
    docs = parse_bulletin_text(c.select(_s("c_custkey").alias("doc_key"), _render(doc).alias("xml")), "xml", "doc_key")
    vs = shred.vulnerabilities(docs)
    kinds = {
        "acknowledgment": shred.vulnerability_acknowledgment(vs).select("doc_xml_date", "name", "url"),
        "revision": shred.vulnerability_revision(vs).select("doc_xml_date", "description", F.concat_ws("|", "number", "revision_date")),
        "note": shred.vulnerability_notes(vs).select("doc_xml_date", "note", F.concat_ws("|", "title", "notes_type")),
        "namespace": shred.document_info(docs).select("id", F.concat_ws(",", "vlun", "dc", "cvrf_common", "prod", "scap_core",
                                                                       "cvssv2", "cpe_lang", "sch", "cvrf"), F.lit("")),
    }
    out = None
    for kind, df in kinds.items():
        one = df.toDF("doc_xml_date", "value", "detail").withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


def xml_document_notes(spark: SparkSession, d: str) -> DataFrame:
    """The notes and all revisions of order documents."""
    docs = parse_bulletin_text(order_documents(spark, d), "xml", "doc_key")
    notes = shred.document_notes(docs).select("doc_xml_date", F.col("note_id").alias("n"), "title", "audience", "notes_type")
    revisions = shred.document_revision(docs).select(
        "doc_xml_date", F.lit(-1).cast("long").alias("n"), F.col("number").alias("title"),
        F.col("revision_date").alias("audience"), F.col("description").alias("notes_type"))
    return notes.unionByName(revisions)


def null_safe_join(spark: SparkSession, d: str) -> DataFrame:
    """A left join on a nullable key that matches NULL with NULL, defaults filled."""
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("k")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", key)
    sizes = o.where("o_orderstatus = 'F' AND (k IS NULL OR k <> '1-URGENT')").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return left_join_with_defaults(o, sizes, ["k"], null_safe=True).select("o_orderkey", "k", "n")


def ordered_sink(spark: SparkSession, d: str) -> DataFrame:
    """Rows written in one global order (ranges over tasks, sorted files) and read back with their
    place in it: the rows of the files before plus the row's index in its file."""
    path = scratch(spark, "ordered")
    o = table(spark, d, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    o.repartitionByRange("o_orderdate", "o_orderkey").sortWithinPartitions("o_orderdate", "o_orderkey").write.parquet(path)
    back = spark.read.parquet(path).select("o_orderkey", "o_custkey", F.col("_metadata.file_name").alias("f"),
                                           F.col("_metadata.row_index").alias("i"))
    files = back.groupBy("f").agg(F.count(F.lit(1)).alias("n"))  # one row per file
    before = F.sum("n").over(Window.orderBy("f").rowsBetween(Window.unboundedPreceding, -1))
    base = files.select("f", F.coalesce(before, F.lit(0)).alias("base"))
    return back.join(base, "f").select("o_orderkey", "o_custkey", (F.col("base") + F.col("i") + 1).alias("place"))


QUERIES = {f.__name__: f for f in (host_report_arrays, exposure_one_line, xml_remaining_children, xml_document_notes, null_safe_join,
                                   ordered_sink)}

_NAME = " ".join(f"WHEN {k} THEN '{v}'" for k, v in LINES.items())
SQL = {
    "host_report_arrays": f"""
WITH cat AS (SELECT DISTINCT CASE s_nationkey % 4 {_NAME} END AS line, l_partkey AS kb, 'CVE-' || s_suppkey AS cve,
                    CAST(l_shipdate AS DATE) AS d, date_trunc('month', o_orderdate) AS m
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
             WHERE s_nationkey % 4 < 3 AND s_suppkey % 5 <> 0),
dates AS (SELECT line, kb, max(d) AS d FROM cat GROUP BY ALL),
last AS (SELECT line, date_trunc('month', arg_max(d, kb)) AS m FROM dates GROUP BY line),
inst AS (SELECT o_custkey, max(l_partkey) AS kb FROM orders JOIN lineitem ON o_orderkey = l_orderkey
         WHERE o_orderdate >= TIMESTAMP '1998-02-01' GROUP BY o_custkey),
host AS (SELECT c.*, CASE c_nationkey % 4 {_NAME} ELSE 'none' END AS line, kb FROM customer c
         LEFT JOIN inst ON c_custkey = o_custkey),
pair AS (SELECT DISTINCT line, kb FROM host WHERE kb IS NOT NULL),
st AS (SELECT p.line, p.kb, min(x.kb) AS s FROM pair p JOIN dates x ON x.line = p.line AND x.kb > p.kb
       JOIN last l ON l.line = p.line AND date_trunc('month', x.d) = l.m GROUP BY ALL),
rec AS (SELECT st.line, st.kb, CAST(to_json(list([CAST(x.kb AS VARCHAR), strftime(x.d, '%Y-%m-%d')] ORDER BY x.kb)) AS VARCHAR)
        AS arr FROM st JOIN dates x ON x.line = st.line AND x.kb >= s GROUP BY ALL),
cv AS (SELECT DISTINCT st.line, st.kb, cve FROM st JOIN cat ON cat.line = st.line AND cat.kb > st.kb),
lab AS (SELECT kb, strftime(max(m), '%Y-%b') AS label FROM cat GROUP BY kb)
SELECT CAST(c_custkey AS VARCHAR) AS hostname, c_name AS os_name, c_mktsegment AS os_version,
       coalesce(CAST(h.kb AS VARCHAR), '') AS last_kb, coalesce(label, '') AS last_kb_date,
       strftime(make_timestamp(c_custkey * 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS last_update_date,
       coalesce(arr, '[]') AS rec_kb_json, coalesce(cve, '') AS cve
FROM host h LEFT JOIN rec ON rec.line = h.line AND rec.kb = h.kb LEFT JOIN cv ON cv.line = h.line AND cv.kb = h.kb
LEFT JOIN lab ON lab.kb = h.kb
""",
    "exposure_one_line": """
WITH host AS (SELECT o_custkey AS hostname, max(l_partkey) AS kb FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
top AS (SELECT s_name, max(l_partkey) AS kb FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
dates AS (SELECT l_partkey AS kb, max(CAST(l_shipdate AS DATE)) AS d FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
ranked AS (SELECT kb, d, row_number() OVER (ORDER BY kb) - 1 AS r, count(*) OVER () AS n FROM dates),
late AS (SELECT kb, r, n FROM ranked WHERE date_trunc('month', d) = (SELECT date_trunc('month', arg_max(d, kb)) FROM dates)),
pair AS (SELECT DISTINCT kb FROM host),
opened AS (SELECT p.kb, count(*) AS n_open FROM pair p JOIN top t ON t.kb > p.kb GROUP BY 1),
begun AS (SELECT p.kb, min(l.r) AS r, any_value(n) - min(l.r) AS n FROM pair p JOIN late l ON l.kb > p.kb GROUP BY 1)
SELECT hostname, h.kb AS last_kb, coalesce(n_open, 0) AS n_open, coalesce(r, -1) AS list_rank, coalesce(n, 0) AS n_recommended
FROM host h LEFT JOIN opened o ON o.kb = h.kb LEFT JOIN begun b ON b.kb = h.kb
""",
    "xml_remaining_children": """
WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_name, c_mktsegment, c_nationkey FROM customer)
SELECT k AS doc_xml_date, c_name AS value, 'u1' AS detail, 'acknowledgment' AS kind FROM c
UNION ALL SELECT k, c_mktsegment, '1.0|2024-01-09', 'revision' FROM c
UNION ALL SELECT k, c_name, 'Name|Details', 'note' FROM c
UNION ALL SELECT k, array_to_string(list_transform(range(9), lambda i: 'urn:' || i || ':' || c_nationkey), ','), '', 'namespace'
FROM c
""",
    "xml_document_notes": """
WITH o AS (SELECT strftime(o_orderdate, '%Y-%b') || '#' || o_orderkey AS k, * FROM orders)
SELECT k AS doc_xml_date, CAST(0 AS BIGINT) AS n, 'Status' AS title, 'Public' AS audience, 'Summary' AS notes_type FROM o
UNION ALL SELECT k, 1, 'Priority', 'Internal', 'Details' FROM o
UNION ALL SELECT k, -1, '1.0', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 'Placed' FROM o
UNION ALL SELECT k, -1, '2.0', strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER), '%Y-%m-%dT%H:%M:%S'),
                 o_orderpriority FROM o
""",
    "null_safe_join": """
WITH o AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS k FROM orders),
n AS (SELECT k, count(*) AS n FROM o WHERE o_orderstatus = 'F' AND (k IS NULL OR k <> '1-URGENT') GROUP BY k)
SELECT o_orderkey, o.k, coalesce(n, 0) AS n FROM o LEFT JOIN n ON o.k IS NOT DISTINCT FROM n.k
""",
    "ordered_sink": """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS place FROM orders
""",
}
