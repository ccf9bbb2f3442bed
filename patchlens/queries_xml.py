"""XML queries over the driver's tables.

Rows are rendered as bulletin-shaped XML (``to_xml``), parsed back with the
bulletin schema (``from_xml``, namespace prefixes ignored) and shredded by
the same functions that shred real bulletins.  One document per source row
(no grouping), so a hot key never builds one huge document.

Document key (used as ``doc_xml_date``): for line documents the month and
every line value the document holds (order, line number, part, supplier,
quantity, discount, tax, flags), so equal keys mean identical documents;
``yyyy-MMM#orderkey`` for order documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens import schemas
from patchlens.functions.dates import month_label
from patchlens.operators.partitioning import spread_rows
from patchlens.plans import shred
from patchlens.sources.xml_bulletins import parse_bulletin_text
from patchlens.tables import table

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss"


def _typed(struct_type, **fields: Column) -> Column:
    """A struct of ``struct_type`` with the given fields, NULL elsewhere."""
    unknown = set(fields) - set(struct_type.fieldNames())
    if unknown:
        raise KeyError(unknown)

    def value(f) -> Column:
        if f.name not in fields:
            return F.lit(None)
        # a child that should occur once is given as one value
        one = f.dataType == schemas.ONE and f.name != "ProductID"
        return F.array(fields[f.name]) if one else fields[f.name]

    return F.struct(*[value(f).cast(f.dataType).alias(f.name) for f in struct_type.fields])


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _render(doc: Column) -> Column:
    return F.to_xml(doc, {"rowTag": "cvrfdoc", "indent": ""})


def line_documents(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = spread_rows(li.join(orders, li["l_orderkey"] == orders["o_orderkey"]),
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    # the key covers every line value the document holds: equal keys mean equal documents
    key = F.concat_ws("#", month_label("o_orderdate"), _s("l_orderkey"), _s("l_linenumber"),
                      _s("l_partkey"), _s("l_suppkey"), _s(F.col("l_quantity").cast("int")),
                      F.format_string("%.2f", "l_discount"), F.format_string("%.2f", "l_tax"),
                      F.col("l_returnflag"), F.col("l_linestatus"))
    V = schemas.VULNERABILITY
    sub = {f.name: f.dataType for f in V.fields}
    part = _typed(
        V,
        _Ordinal=_s("l_linenumber"), Title=F.col("o_orderpriority"),
        CVE=F.concat(F.lit("CVE-"), _s("l_orderkey")),
        CWE=F.array(F.struct(F.col("l_returnflag").alias("_ID"), F.col("l_linestatus").alias("_VALUE"))),
        ProductStatuses=F.struct(F.array(F.struct(F.col("l_linestatus").alias("_Type"),
                                                  F.array(_s("l_partkey"), _s("l_suppkey")).alias("ProductID")))
                                 .alias("Status")).cast(sub["ProductStatuses"]),
        Threats=F.struct(F.array(_typed(
            sub["Threats"]["Threat"].dataType.elementType, _Type=F.lit("Impact"), Description=F.col("l_returnflag"),
            ProductID=F.array(_s("l_suppkey")))).alias("Threat")),
        CVSSScoreSets=F.struct(F.array(_typed(
            sub["CVSSScoreSets"]["ScoreSet"].dataType.elementType,
            BaseScore=F.format_string("%.2f", "l_discount"), TemporalScore=F.format_string("%.2f", "l_tax"),
            Vector=F.concat_ws("/", "l_returnflag", "l_linestatus"),
            ProductID=F.array(_s("l_suppkey"), _s("l_partkey")))).alias("ScoreSet")),
        Remediations=F.struct(F.array(
            _typed(sub["Remediations"]["Remediation"].dataType.elementType,
                   _Type=F.lit("Vendor Fix"), Description=_s("l_partkey"),
                   URL=F.concat(F.lit("https://example.com/kb/"), _s("l_partkey")),
                   ProductID=F.array(_s("l_partkey"), _s("l_suppkey")), SubType=F.lit("Security Update"),
                   FixedBuild=F.concat(F.lit("10.0."), _s(F.col("l_quantity").cast("int")))),
            _typed(sub["Remediations"]["Remediation"].dataType.elementType,
                   _Type=F.lit("Workaround"), Description=F.concat(F.lit("Apply "), F.col("l_returnflag")),
                   ProductID=F.array(_s("l_partkey"))),
        ).alias("Remediation")).cast(sub["Remediations"]),
    )
    supp = _typed(
        V,
        _Ordinal=F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.lit("2")),
        Title=F.concat(F.lit("Supplier "), _s("l_suppkey")), CVE=F.concat(F.lit("CVE-S-"), _s("l_suppkey")),
        ProductStatuses=F.struct(F.array(F.struct(F.lit("Supplier").alias("_Type"),
                                                  F.array(_s("l_suppkey")).alias("ProductID")))
                                 .alias("Status")).cast(sub["ProductStatuses"]),
    )
    doc = F.struct(F.lit("Line document").alias("DocumentTitle"), F.array(part, supp).alias("Vulnerability"))
    return j.select(key.alias("doc_key"), _render(doc).alias("xml"))


def _parsed_lines(spark, d, *tables: str):
    """The line documents, parsed for ``tables`` (none named: whole)."""
    schema = shred.schema_for(*tables) if tables else schemas.DOCUMENT
    return parse_bulletin_text(line_documents(spark, d), "xml", "doc_key", schema)


def xml_roundtrip_lines(spark: SparkSession, d: str) -> DataFrame:
    return shred.vulnerability(shred.vulnerabilities(_parsed_lines(spark, d, "vulnerability")))


def xml_position_key(spark: SparkSession, d: str) -> DataFrame:
    return shred.vulnerability_status(shred.vulnerabilities(_parsed_lines(spark, d, "vulnerability_status")))


def xml_first_child(spark: SparkSession, d: str) -> DataFrame:
    """Score sets: text children and the first ProductID of each."""
    return shred.vulnerability_score_set(shred.vulnerabilities(_parsed_lines(spark, d, "vulnerability_score_set")))


def xml_threats(spark: SparkSession, d: str) -> DataFrame:
    """Threats: type attribute, Description child, first ProductID."""
    return shred.vulnerability_threats(shred.vulnerabilities(_parsed_lines(spark, d, "vulnerability_threats")))


def xml_all_children(spark: SparkSession, d: str) -> DataFrame:
    rem = shred.vulnerability_remediation(shred.vulnerabilities(_parsed_lines(spark, d, "vulnerability_remediation")))
    return rem.select("vulnerability_fk", "doc_xml_date", "kb", "remediation_type", "url",
                      F.array_join("product_id", ",").alias("product_id"), "subtype", "fixed_build")


def customer_documents(spark: SparkSession, d: str) -> DataFrame:
    """One product-tree document per customer: Region branch > Nation
    branch > product (the customer), plus a top-level product."""
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    j = spread_rows(cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"])
                    .join(region, F.col("n_regionkey") == region["r_regionkey"]), ["c_custkey"])
    branch = schemas.branch_type()
    pname = schemas.PRODUCT_NAME
    nation_branch = _typed(branch["Branch"].dataType.elementType, _Type=F.lit("Nation"), _Name=F.col("n_name"),
                           FullProductName=F.array(_typed(pname, _ProductID=_s("c_custkey"), _VALUE=F.col("c_name"))))
    region_branch = _typed(branch, _Type=F.lit("Region"), _Name=F.col("r_name"),
                           Branch=F.array(nation_branch))
    tree = F.struct(F.array(region_branch).alias("Branch"),
                    F.array(_typed(pname, _ProductID=F.concat(F.lit("acct-"), _s("c_custkey")),
                                   _VALUE=F.col("c_name"))).alias("FullProductName"))
    doc = F.struct(F.lit("Customer tree").alias("DocumentTitle"), tree.alias("ProductTree"))
    return j.select(_s("c_custkey").alias("doc_key"), _render(doc).alias("xml"))


def xml_nested_flatten(spark: SparkSession, d: str) -> DataFrame:
    docs = parse_bulletin_text(customer_documents(spark, d), "xml", "doc_key")
    return shred.product(docs)


def order_documents(spark: SparkSession, d: str) -> DataFrame:
    o = spread_rows(table(spark, d, "orders"), ["o_orderkey"])
    later = F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 3).cast("int"))
    later_ts = F.date_format(later, ISO_TS)
    first_ts = F.date_format("o_orderdate", ISO_TS)
    DT = schemas.DOCUMENT
    rev = schemas.REVISION
    tracking = _typed(
        DT["DocumentTracking"].dataType,
        Identification=_typed(DT["DocumentTracking"].dataType["Identification"].dataType, ID=_s("o_orderkey")),
        Status=F.col("o_orderstatus"), Version=F.lit("2.0"),
        RevisionHistory=F.struct(F.array(
            _typed(rev, Number=F.lit("1.0"), Date=first_ts, Description=F.lit("Placed")),
            _typed(rev, Number=F.lit("2.0"), Date=later_ts, Description=F.col("o_orderpriority")),
        ).alias("Revision")),
        InitialReleaseDate=first_ts, CurrentReleaseDate=later_ts)
    publisher = _typed(DT["DocumentPublisher"].dataType, _Type=F.lit("Vendor"), ContactDetails=_s("o_custkey"),
                       IssuingAuthority=F.lit("Order desk"))
    notes = F.struct(F.array(
        _typed(DT["DocumentNotes"].dataType["Note"].dataType.elementType, _Title=F.lit("Status"),
               _Audience=F.lit("Public"), _Type=F.lit("Summary"), _Ordinal=F.lit("1"), _VALUE=F.col("o_orderstatus")),
        _typed(DT["DocumentNotes"].dataType["Note"].dataType.elementType, _Title=F.lit("Priority"),
               _Audience=F.lit("Internal"), _Type=F.lit("Details"), _Ordinal=F.lit("2"),
               _VALUE=F.col("o_orderpriority")),
    ).alias("Note"))
    doc = F.struct(F.concat(F.lit("Order "), _s("o_orderkey")).alias("DocumentTitle"),
                   F.lit("Order Record").alias("DocumentType"), publisher.alias("DocumentPublisher"),
                   tracking.alias("DocumentTracking"), notes.alias("DocumentNotes"))
    key = F.concat_ws("#", month_label("o_orderdate"), _s("o_orderkey"))
    return o.select(key.alias("doc_key"), _render(doc).alias("xml"))


def xml_document_attrs(spark: SparkSession, d: str) -> DataFrame:
    """Document-level fields (X11-X15): tracking with its latest revision,
    publisher, title, type, namespace declarations, and the notes list.
    Every value is read inside the document row, so each is parsed once."""
    docs = parse_bulletin_text(order_documents(spark, d), "xml", "doc_key")
    notes = F.coalesce(F.col("DocumentNotes.Note"),
                       F.array().cast(schemas.DOCUMENT["DocumentNotes"].dataType["Note"].dataType))
    info = shred.document_info(docs, extra=[
        F.size(notes).cast("long").alias("note_count"),
        F.try_element_at(notes, F.lit(-1))["_Audience"].alias("last_note_audience")])
    return info.select(
        "id", "status", "version", "revision_history_number",
        F.date_format("revision_history_date", "yyyy-MM-dd HH:mm:ss").alias("revision_history_date"),
        "revision_history_description",
        F.date_format("initial_relise_date", "yyyy-MM-dd HH:mm:ss").alias("initial_relise_date"),
        F.date_format("current_relise_date", "yyyy-MM-dd HH:mm:ss").alias("current_relise_date"),
        "publisher_type", "contact_details", "issuring_authority", "document_title", "document_type",
        "vlun", "cvrf", "note_count", "last_note_audience")


def xml_cve_mart(spark: SparkSession, d: str) -> DataFrame:
    """The bulletin star mart (``cve_data``) over the line documents, built
    inside each parsed document (``marts.cve_mart_in_document``: one pass,
    one DISTINCT shuffle, no joins; equal to the staging star join - see
    tests).  Arrays are reported as joined text."""
    from patchlens.plans.marts import IN_DOCUMENT, cve_mart_in_document
    from patchlens.queries import AS_OF
    docs = parse_bulletin_text(line_documents(spark, d), "xml", "doc_key", schemas.selected(schemas.DOCUMENT, IN_DOCUMENT))
    cve = cve_mart_in_document(docs, AS_OF)
    ts = "yyyy-MM-dd HH:mm:ss"
    return cve.select(
        F.date_format("timestamp", ts).alias("timestamp"), "doc_xml_date", "cve", "vul_title", "cwe",
        "cwe_text", "status_type", F.array_join("status_product_id", ",").alias("status_product_id"),
        F.array_join("note", "|").alias("note"), F.array_join("threats_type", ",").alias("threats_type"),
        F.array_join("treat_description", ",").alias("treat_description"), "base_score", "temporal_score",
        F.array_join("score_set_product_id", ",").alias("score_set_product_id"),
        F.col("rev_number").cast("double").alias("rev_number"), "rev_date", "rev_description",
        "fixed_build", "kb", F.array_join("kb_product_id", ",").alias("kb_product_id"),
        "doc_revision_history_number",
        F.date_format("doc_revision_history_date", ts).alias("doc_revision_history_date"),
        "doc_revision_history_description",
        F.date_format("doc_initial_relise_date", ts).alias("doc_initial_relise_date"),
        F.date_format("doc_current_relise_date", ts).alias("doc_current_relise_date"),
        "doc_document_title")


QUERIES = {
    "xml_roundtrip_lines": xml_roundtrip_lines,
    "xml_position_key": xml_position_key,
    "xml_first_child": xml_first_child,
    "xml_threats": xml_threats,
    "xml_all_children": xml_all_children,
    "xml_nested_flatten": xml_nested_flatten,
    "xml_document_attrs": xml_document_attrs,
    "xml_cve_mart": xml_cve_mart,
}
