"""Registered queries over the whole bulletin path: documents built from orders
and lineitem are written as files, loaded by stream or backfill, delivered
again with changed and removed children, and read back from the warehouse.

One document per order month; one vulnerability per order priority, its
children aggregated from the month's lines (so documents stay small while the
work grows with the tables).  The second delivery covers the months of one
year: returned flag ``N`` has no remediation any more, the notes are gone and
the title is new.  In the year after it one priority lacks its Ordinal.
Products sit eight branches deep, and every remediation names one product
that no tree holds.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens import schemas
from patchlens.functions.dates import TS_FORMAT, month_label
from patchlens.operators.ranges import materialised
from patchlens.plans import bulletin_warehouse as bw
from patchlens.queries import AS_OF
from patchlens.queries_io import scratch
from patchlens.queries_xml import ISO_TS, _render, _s, _typed
from patchlens.streaming import incremental
from patchlens.sources.xml_bulletins import read_bulletins
from patchlens.tables import table

AGAIN, BARE = "1995", "1996"  # year delivered twice; year with a vulnerability without Ordinal
DEPTH = 8


def _child(parent: str, child: str):
    return schemas.VULNERABILITY[parent].dataType[child].dataType.elementType


def _listed(parent: str, child: str, column: Column) -> Column:
    return F.struct(column.alias(child)).cast(schemas.VULNERABILITY[parent].dataType)


#: what documents say of the lines of a month, priority, status and flag; each can be taken again over several such groups
FACTS = {"part_lo": ("min", "l_partkey"), "part_hi": ("max", "l_partkey"), "supp_lo": ("min", "l_suppkey"),
         "disc_hi": ("max", "l_discount"), "tax_hi": ("max", "l_tax"), "qty_hi": ("max", "l_quantity"),
         "ship_lo": ("min", "l_shipdate"), "ship_hi": ("max", "l_shipdate"), "placed_lo": ("min", "o_orderdate"),
         "placed_hi": ("max", "o_orderdate")}


def month_facts(spark: SparkSession, d: str) -> DataFrame:
    """The lines of every month, priority, line status and return flag in one row (a few dozen a month): the lines meet
    their orders once, and whatever documents are made of them reads these rows."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = (table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .withColumn("label", month_label("o_orderdate")))
    return materialised(lines.groupBy("label", "o_orderpriority", "l_linestatus", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), *[getattr(F, how)(c).alias(name) for name, (how, c) in FACTS.items()]), "month-facts")


def month_documents(facts: DataFrame, second: bool) -> DataFrame:
    """(label, xml): one document per month of :func:`month_facts`, of the second delivery's months only if ``second``."""
    lines = facts.where(F.year("placed_lo") == int(AGAIN)) if second else facts
    key = ["label", "o_orderpriority"]

    def children(extra: list[str], name: str, value: Column, *aggregates: Column) -> DataFrame:
        grouped = lines.groupBy(*key, *extra).agg(*aggregates)
        return grouped.groupBy(*key).agg(F.array_sort(F.collect_list(value)).alias(name))

    status = children(["l_linestatus"], "statuses", _typed(
        _child("ProductStatuses", "Status"), _Type=F.col("l_linestatus"), ProductID=F.array(_s("lo"), _s("hi"))),
        F.min("part_lo").alias("lo"), F.max("part_hi").alias("hi"))
    scores = children(["l_returnflag"], "scores", _typed(
        _child("CVSSScoreSets", "ScoreSet"), BaseScore=F.format_string("%.2f", "disc"),
        TemporalScore=F.format_string("%.2f", "tax"), Vector=F.col("l_returnflag"), ProductID=F.array(_s("supp"))),
        F.max("disc_hi").alias("disc"), F.max("tax_hi").alias("tax"), F.min("supp_lo").alias("supp"))
    fix_type = _child("Remediations", "Remediation")
    fixed = children(["l_returnflag"], "fixes", _typed(
        fix_type, _Type=F.lit("Vendor Fix"), Description=_s("supp"), SubType=F.col("l_returnflag"),
        ProductID=F.array(_s("part"), F.concat(F.lit("x"), _s("part"))),
        FixedBuild=F.concat(F.lit("10.0."), _s(F.col("qty").cast("int")))),
        F.min("supp_lo").alias("supp"), F.min("part_lo").alias("part"), F.max("qty_hi").alias("qty"))
    whole = lines.groupBy(*key).agg(
        F.sum("n").alias("n"), F.date_format(F.min("ship_lo"), ISO_TS).alias("first_ship"),
        F.date_format(F.max("ship_hi"), ISO_TS).alias("last_ship"), F.min("placed_lo").alias("placed"),
        F.max("placed_hi").alias("last_placed"))
    g = whole.join(status, key).join(scores, key).join(fixed, key)
    keep = F.filter("fixes", lambda x: F.get(x["SubType"], 0) != "N") if second else F.col("fixes")
    workaround = _typed(fix_type, _Type=F.lit("Workaround"), Description=F.lit("Apply the update"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    rev = lambda n, day, text: _typed(schemas.REVISION, Number=F.lit(n), Date=day, Description=F.lit(text))
    revisions = F.array(rev("1.0", F.when(urgent, F.col("first_ship")).otherwise(F.col("last_ship")), "First"),
                        rev("2.0", F.when(urgent, F.col("last_ship")).otherwise(F.col("first_ship")), "Second"))
    note = _typed(_child("Notes", "Note"), _Title=F.lit("Lines"), _Type=F.lit("Description"), _VALUE=_s("n"))
    threats = F.array(*[_typed(_child("Threats", "Threat"), _Type=F.lit(t), Description=text)
                        for t, text in (("Impact", F.col("o_orderpriority")), ("Severity", F.lit("High")))])
    bare = F.col("label").startswith(BARE) & (F.col("o_orderpriority") == "5-LOW")
    vulnerability = _typed(
        schemas.VULNERABILITY, _Ordinal=F.when(~bare, F.col("o_orderpriority")), Title=F.lit("Lines of a month"),
        CVE=F.concat(F.lit("CVE-"), F.col("label"), F.lit("-"), F.substring("o_orderpriority", 1, 1)),
        Notes=F.lit(None) if second else _listed("Notes", "Note", F.array(note)),
        ProductStatuses=_listed("ProductStatuses", "Status", F.col("statuses")),
        Threats=_listed("Threats", "Threat", threats),
        CVSSScoreSets=_listed("CVSSScoreSets", "ScoreSet", F.col("scores")),
        RevisionHistory=_listed("RevisionHistory", "Revision", revisions),
        Remediations=_listed("Remediations", "Remediation", F.concat(keep, F.array(workaround))))
    months = g.select("label", "o_orderpriority", "placed", "last_placed", vulnerability.alias("v"),
                      F.transform(keep, lambda x: x["ProductID"][0]).alias("parts"))
    whole = months.groupBy("label").agg(
        F.array_sort(F.collect_list(F.struct("o_orderpriority", "v"))).alias("vs"),  # five at most
        F.array_distinct(F.flatten(F.collect_list("parts"))).alias("parts"),
        F.date_format(F.min("placed"), ISO_TS).alias("placed"),
        F.date_format(F.max("last_placed"), ISO_TS).alias("last_placed"))
    document = schemas.document_type(DEPTH + 1)
    branch = document["ProductTree"].dataType["Branch"].dataType
    kinds = []
    for _ in range(DEPTH):
        kinds.append(branch.elementType)
        branch = branch.elementType["Branch"].dataType
    names = F.transform("parts", lambda p: F.struct(p.alias("_ProductID"), F.concat(F.lit("Part "), p).alias("_VALUE")))
    tree = _typed(kinds[-1], _Type=F.lit("Level"), _Name=F.lit(str(DEPTH)), FullProductName=names)
    for level in range(DEPTH - 1, 0, -1):
        tree = _typed(kinds[level - 1], _Type=F.lit("Level"), _Name=F.lit(str(level)), Branch=F.array(tree))
    tracking = _typed(
        document["DocumentTracking"].dataType, InitialReleaseDate=F.col("placed"), CurrentReleaseDate=F.col("last_placed"),
        RevisionHistory=F.struct(F.array(_typed(schemas.REVISION, Number=F.lit("1"), Date=F.col("placed"),
                                                Description=F.lit("Issued"))).alias("Revision")))
    doc = F.struct(F.array(F.concat(F.lit("Corrected " if second else "Month "), F.col("label"))).alias("DocumentTitle"),
                   tracking.alias("DocumentTracking"), F.struct(F.array(tree).alias("Branch")).alias("ProductTree"),
                   F.transform("vs", lambda x: x["v"]).alias("Vulnerability"))
    return whole.select("label", _render(doc).alias("xml"))


def deliver(facts: DataFrame, folder: str, second: bool) -> None:
    """Write the documents of a delivery, one file per month in a folder named after it."""
    month_documents(facts, second).write.partitionBy("label").text(folder)


def _twice(spark: SparkSession, d: str) -> str:
    """The warehouse after both deliveries came by stream."""
    base = scratch(spark, "bulletins")
    facts = month_facts(spark, d)
    for number, second in enumerate((False, True)):
        deliver(facts, f"{base}/landing/delivery-{number}", second)
        incremental.load_bulletin_stream(spark, f"{base}/landing", f"{base}/wh", f"{base}/ckpt", AS_OF)
    return f"{base}/wh"


def bulletin_redelivery(spark: SparkSession, d: str) -> DataFrame:
    """``cve_data`` (six-child star) after a redelivery with changed and removed children."""
    cve = bw.read_table(spark, _twice(spark, d), "cve_data")
    arrays = ["status_product_id", "note", "threats_type", "treat_description", "score_set_product_id", "kb_product_id"]
    stamps = ["timestamp", "doc_revision_history_date", "doc_initial_relise_date", "doc_current_relise_date"]
    return cve.select(*[F.array_join(c, ",").alias(c) if c in arrays else
                        F.date_format(c, TS_FORMAT).alias(c) if c in stamps else
                        F.col(c).cast("double").alias(c) if c == "rev_number" else F.col(c) for c in cve.columns])


def bulletin_catalog_chain(spark: SparkSession, d: str) -> DataFrame:
    """``msrc_data`` chained from the redelivered ``cve_data``; products no tree holds are named ''."""
    msrc = bw.read_table(spark, _twice(spark, d), "msrc_data")
    return msrc.select("doc_xml_date", "cve", "kb", "kb_product_id", "product_names", "fixed_build", "base_score",
                       "temporal_score", "cwe", "vul_title", "doc_document_title",
                       F.date_format("doc_initial_relise_date", TS_FORMAT).alias("doc_initial_relise_date"))


def bulletin_backfill(spark: SparkSession, d: str) -> DataFrame:
    """The load that each month comes from, after a backfill, a redelivery and a second backfill."""
    base = scratch(spark, "bulletins")
    facts = month_facts(spark, d)
    for number, second in enumerate((False, True)):
        deliver(facts, f"{base}/landing/delivery-{number}", second)
        bw.backfill(spark, f"{base}/landing", f"{base}/wh", 1990, 2010, AS_OF)
    return bw.current_loads(spark, f"{base}/wh").select("doc_xml_date", "load_id")


def bulletin_rejects(spark: SparkSession, d: str) -> DataFrame:
    """What a load of sound, malformed, unlabelled and outdated documents left out, with the reason."""
    base, facts = scratch(spark, "bulletins"), month_facts(spark, d)
    deliver(facts, f"{base}/landing/delivery-0", False)
    years = table(spark, d, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    years.select(F.concat("y", F.lit("-Abc")).alias("label"), F.lit("<cvrfdoc><DocumentTitle>open").alias("xml")
                 ).write.partitionBy("label").text(f"{base}/landing/broken")
    years.select(F.concat(F.lit("year"), "y").alias("label"), F.lit("<cvrfdoc><DocumentTitle>x</DocumentTitle></cvrfdoc>")
                 .alias("xml")).write.partitionBy("label").text(f"{base}/landing/nameless")
    deliver(facts, f"{base}/landing/delivery-1", True)
    bw.load_documents(spark, read_bulletins(spark, f"{base}/landing"), f"{base}/wh", AS_OF)
    return bw.rejects(spark, f"{base}/wh").groupBy("doc_xml_date", "reason").agg(F.sum("n").alias("n"))


QUERIES = {f.__name__: f for f in (bulletin_redelivery, bulletin_catalog_chain, bulletin_backfill, bulletin_rejects)}

_BASE = f"""
b AS (SELECT strftime(o_orderdate, '%Y-%b') AS label, o_orderpriority AS pri, o_orderdate, l.*
      FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
v AS (SELECT label, pri, 'CVE-' || label || '-' || pri[1] AS cve, count(*) AS n, min(l_shipdate) AS lo, max(l_shipdate) AS hi,
             starts_with(label, '{AGAIN}') AS again
      FROM b GROUP BY ALL HAVING NOT (starts_with(label, '{BARE}') AND pri = '5-LOW')),
doc AS (SELECT label, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS placed,
               strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_placed FROM b GROUP BY label),
fix AS (SELECT label, pri, CAST(min(l_suppkey) AS VARCHAR) AS kb, CAST(min(l_partkey) AS VARCHAR) AS part,
               '10.0.' || CAST(CAST(max(l_quantity) AS INTEGER) AS VARCHAR) AS build FROM b
        WHERE NOT (starts_with(label, '{AGAIN}') AND l_returnflag = 'N') GROUP BY label, pri, l_returnflag),
sc AS (SELECT label, pri, base, tax, string_agg(DISTINCT supp, ',' ORDER BY supp) AS products FROM (
         SELECT label, pri, printf('%.2f', max(l_discount)) AS base, printf('%.2f', max(l_tax)) AS tax,
                CAST(min(l_suppkey) AS VARCHAR) AS supp FROM b GROUP BY label, pri, l_returnflag) GROUP BY ALL)"""
SQL = {
    "bulletin_redelivery": f"""
WITH {_BASE},
st AS (SELECT label, pri, l_linestatus, array_to_string(list_sort(list_distinct(
         [CAST(min(l_partkey) AS VARCHAR), CAST(max(l_partkey) AS VARCHAR)])), ',') AS products FROM b GROUP BY ALL),
rem AS (SELECT label, pri, kb, part || ',x' || part AS products, build FROM fix
        UNION ALL SELECT DISTINCT label, pri, '', '', '' FROM b)
SELECT DISTINCT '1998-03-10 00:00:00' AS timestamp, label AS doc_xml_date, cve, 'Lines of a month' AS vul_title,
       '' AS cwe, '' AS cwe_text, l_linestatus AS status_type, st.products AS status_product_id,
       CASE WHEN again THEN '' ELSE CAST(n AS VARCHAR) END AS note, 'Impact,Severity' AS threats_type,
       pri || ',High' AS treat_description, base AS base_score, tax AS temporal_score,
       sc.products AS score_set_product_id, CAST(2 AS DOUBLE) AS rev_number,
       strftime(hi, '%Y-%m-%dT%H:%M:%S') AS rev_date,
       CASE WHEN pri = '1-URGENT' OR lo = hi THEN 'Second' ELSE '' END AS rev_description, build AS fixed_build, kb,
       rem.products AS kb_product_id, 1 AS doc_revision_history_number, placed AS doc_revision_history_date,
       'Issued' AS doc_revision_history_description, placed AS doc_initial_relise_date,
       last_placed AS doc_current_relise_date,
       CASE WHEN again THEN 'Corrected ' ELSE 'Month ' END || label AS doc_document_title
FROM v JOIN doc USING (label) JOIN st USING (label, pri) JOIN sc USING (label, pri) JOIN rem USING (label, pri)
""",
    "bulletin_catalog_chain": f"""
WITH {_BASE},
known AS (SELECT DISTINCT part FROM fix),
rem AS (SELECT f.* FROM fix f JOIN v USING (label, pri)),
p AS (SELECT label, kb, id, CASE WHEN id IN (SELECT part FROM known) THEN 'Part ' || id ELSE '' END AS name,
             max(build) AS build FROM (SELECT label, kb, build, unnest([part, 'x' || part]) AS id FROM rem) GROUP BY ALL),
top AS (SELECT cve, label, kb, again, max({{'base': base, 'tax': tax}}) AS t
        FROM v JOIN rem USING (label, pri) JOIN sc USING (label, pri) GROUP BY ALL)
SELECT label AS doc_xml_date, cve, kb, id AS kb_product_id, name AS product_names, build AS fixed_build,
       t.base AS base_score, t.tax AS temporal_score, '' AS cwe, 'Lines of a month' AS vul_title,
       CASE WHEN again THEN 'Corrected ' ELSE 'Month ' END || label AS doc_document_title,
       placed AS doc_initial_relise_date
FROM top JOIN p USING (label, kb) JOIN doc USING (label)
""",
    "bulletin_backfill": f"""
SELECT DISTINCT strftime(o_orderdate, '%Y-%b') AS doc_xml_date,
       CAST(CASE WHEN year(o_orderdate) = {AGAIN} THEN 2 ELSE 1 END AS BIGINT) AS load_id
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""",
    "bulletin_rejects": f"""
WITH b AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%b') AS label, o_orderpriority AS pri
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
SELECT label AS doc_xml_date, 'vulnerability without Ordinal' AS reason, CAST(1 AS BIGINT) AS n FROM b
WHERE starts_with(label, '{BARE}') AND pri = '5-LOW'
UNION ALL SELECT DISTINCT label, 'superseded', CAST(1 AS BIGINT) FROM b WHERE starts_with(label, '{AGAIN}')
UNION ALL SELECT y || '-Abc', 'malformed', CAST(1 AS BIGINT) FROM y
UNION ALL SELECT '', 'unlabelled', count(*) FROM y
""",
}
