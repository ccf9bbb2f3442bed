"""Bulletin document -> staging tables.

Every staging row carries the month label ``doc_xml_date``; a vulnerability
is keyed by ``(doc_xml_date, id)`` where ``id`` is its 0-based position
among the document's ``Vulnerability`` elements that have an ``Ordinal``
(an element without one is rejected and counted, not attached to its
neighbour).  Children reference it through ``vulnerability_fk``.

Each table is a fixed path into the nested document followed by
``explode``; text that is absent or empty becomes '' where the target
column is non-nullable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens import schemas
from patchlens.functions.strings import digits_or_empty

DOC = "doc_xml_date"


def _e(c) -> Column:
    """'' for NULL."""
    return F.coalesce(c, F.lit(""))


def first(c) -> Column:
    """The first of a repeated child element; NULL when there is none."""
    return F.get(c, 0)


#: the parts of a vulnerability that each table of its children is made from
CHILDREN = {
    "vulnerability": ["Title", "CVE", "CWE"], "vulnerability_status": ["ProductStatuses"], "vulnerability_notes": ["Notes"],
    "vulnerability_threats": ["Threats"], "vulnerability_score_set": ["CVSSScoreSets"],
    "vulnerability_revision": ["RevisionHistory"], "vulnerability_remediation": ["Remediations"],
    "vulnerability_acknowledgment": ["Acknowledgments"],
}


def schema_for(*tables: str) -> T.StructType:
    """The document schema cut to what ``tables`` are made from: a parser walks the whole text either way, but
    builds values only for what the schema names."""
    paths = ["_Ordinal", *[c for name in tables for c in CHILDREN[name]]]
    return schemas.selected(schemas.DOCUMENT, [*[f"Vulnerability.{c}" for c in paths], schemas.CORRUPT])


def vulnerabilities(docs: DataFrame) -> DataFrame:
    """(doc_xml_date, id, v): one row per vulnerability with an Ordinal."""
    kept = F.filter("Vulnerability", lambda v: v["_Ordinal"].isNotNull())
    return docs.select(DOC, F.posexplode(kept).alias("id", "v")) \
               .withColumn("id", F.col("id").cast("long"))


def rejected_vulnerabilities(docs: DataFrame) -> DataFrame:
    """Per document, how many Vulnerability elements lack an Ordinal."""
    return docs.select(DOC, F.size(F.filter(F.coalesce("Vulnerability", F.array()),
                                            lambda v: v["_Ordinal"].isNull())).alias("rejected"))


def vulnerability(vs: DataFrame) -> DataFrame:
    v = F.col("v")
    cwe = first(v["CWE"])
    return vs.select("id", DOC, first(v["CVE"]).alias("cve"), _e(first(v["Title"])).alias("title"),
                     _e(cwe["_ID"]).alias("cwe"), _e(cwe["_VALUE"]).alias("cwe_text"))


def _children(vs: DataFrame, path: list[str]) -> DataFrame:
    arr = F.col("v")
    for p in path:
        arr = arr[p]
    return vs.select(F.col("id").alias("vulnerability_fk"), DOC, F.explode(arr).alias("c"))


def vulnerability_status(vs: DataFrame) -> DataFrame:
    st = _children(vs, ["ProductStatuses", "Status"])
    return st.select("vulnerability_fk", DOC, _e(F.col("c._Type")).alias("status_type"),
                     F.explode("c.ProductID").alias("product_id"))


def vulnerability_notes(vs: DataFrame) -> DataFrame:
    n = _children(vs, ["Notes", "Note"])
    return n.select("vulnerability_fk", DOC, F.col("c._Title").alias("title"),
                    F.col("c._Type").alias("notes_type"), F.col("c._VALUE").alias("note"))


def vulnerability_threats(vs: DataFrame) -> DataFrame:
    t = _children(vs, ["Threats", "Threat"])
    return t.select("vulnerability_fk", DOC, F.lit("").alias("title"),
                    _e(F.col("c._Type")).alias("threats_type"),
                    _e(first(F.col("c.Description"))).alias("description"),
                    _e(F.get(F.col("c.ProductID"), 0)).alias("product_id"))


def vulnerability_score_set(vs: DataFrame) -> DataFrame:
    s = _children(vs, ["CVSSScoreSets", "ScoreSet"])
    return s.select("vulnerability_fk", DOC, first(F.col("c.BaseScore")).alias("base_score"),
                    first(F.col("c.TemporalScore")).alias("temporal_score"),
                    first(F.col("c.Vector")).alias("vector"),
                    F.get(F.col("c.ProductID"), 0).alias("product_id"))


def vulnerability_revision(vs: DataFrame) -> DataFrame:
    r = _children(vs, ["RevisionHistory", "Revision"])
    return r.select("vulnerability_fk", DOC, _e(first(F.col("c.Number"))).alias("number"),
                    _e(first(F.col("c.Date"))).alias("revision_date"),
                    _e(first(F.col("c.Description"))).alias("description"))


def vulnerability_remediation(vs: DataFrame) -> DataFrame:
    r = _children(vs, ["Remediations", "Remediation"])
    return r.select("vulnerability_fk", DOC,
                    digits_or_empty(_e(first(F.col("c.Description")))).alias("kb"),
                    _e(first(F.col("c.Description"))).alias("_kb_text"),
                    _e(F.col("c._Type")).alias("remediation_type"), _e(first(F.col("c.URL"))).alias("url"),
                    F.coalesce(F.col("c.ProductID"), F.array().cast("array<string>")).alias("product_id"),
                    _e(first(F.col("c.SubType"))).alias("subtype"),
                    _e(first(F.col("c.FixedBuild"))).alias("fixed_build"))


def vulnerability_acknowledgment(vs: DataFrame) -> DataFrame:
    a = _children(vs, ["Acknowledgments", "Acknowledgment"])
    return a.select("vulnerability_fk", DOC, _e(F.get(F.col("c.Name"), 0)).alias("name"),
                    _e(F.get(F.col("c.URL"), 0)).alias("url"))


def _product_entries(products, typ, name) -> Column:
    return F.transform(F.coalesce(products, F.array().cast(f"array<{schemas.PRODUCT_NAME.simpleString()}>")),
                       lambda p: F.struct(_e(p["_ProductID"]).alias("id"), _e(p["_VALUE"]).alias("product_name"),
                                          _e(typ).alias("product_type"), _e(name).alias("branch_name")))


def _children_of(child_type):
    # NULL child lists become empty ones, so flatten never turns NULL
    return lambda b: F.coalesce(b["Branch"], F.array().cast(child_type))


def _tree_type(docs: DataFrame):
    return docs.schema["ProductTree"].dataType["Branch"].dataType


def _tree_depth(docs: DataFrame) -> int:
    """Branch levels of the schema that are structures (the deepest one is text)."""
    level, n = _tree_type(docs), 0
    while "Branch" in getattr(level.elementType, "names", ()):
        level, n = level.elementType["Branch"].dataType, n + 1
    return n


def product(docs: DataFrame) -> DataFrame:
    """Flatten the product tree: one row per element carrying a ProductID,
    with the Type and Name of the branch directly above it ('' at the top).
    Each level's branches are the concatenated child branches of the level
    above (``flatten(transform(...))``), all inside the document row; one
    ``explode`` at the end, so every document is read once.  The levels are
    those of the schema ``docs`` was parsed with."""
    level_type, depth = _tree_type(docs), _tree_depth(docs)
    entries = [_product_entries(F.col("ProductTree.FullProductName"), F.lit(""), F.lit(""))]
    level = F.coalesce(F.col("ProductTree.Branch"), F.array().cast(level_type))
    for k in range(depth):
        entries.append(F.flatten(F.transform(level, lambda b: _product_entries(
            b["FullProductName"], b["_Type"], b["_Name"]))))
        if k < depth - 1:
            child_type = level_type.elementType["Branch"].dataType
            level = F.flatten(F.transform(level, _children_of(child_type)))
            level_type = child_type
    return docs.select(DOC, F.explode(F.concat(*entries)).alias("p")) \
               .select("p.id", "p.product_name", "p.product_type", "p.branch_name", DOC)


def branches_left(docs: DataFrame) -> Column:
    """How many branches of a document sit deeper than the schema of ``docs``
    models; 0 means :func:`product` saw the whole tree."""
    level_type = _tree_type(docs)
    level = F.coalesce(F.col("ProductTree.Branch"), F.array().cast(level_type))
    for _ in range(_tree_depth(docs)):
        child_type = level_type.elementType["Branch"].dataType
        level = F.flatten(F.transform(level, _children_of(child_type)))
        level_type = child_type
    return F.size(level)


def product_tree_overflow(docs: DataFrame) -> DataFrame:
    """(doc_xml_date, overflow) of documents with branches the schema does not reach."""
    left = branches_left(docs)
    return docs.select(DOC, left.alias("overflow")).where("overflow > 0")


def _revision_rows(docs: DataFrame) -> DataFrame:
    return docs.select(DOC, F.explode("DocumentTracking.RevisionHistory.Revision").alias("r")) \
               .select(DOC, _e(first(F.col("r.Number"))).alias("number"),
                       _e(first(F.col("r.Date"))).alias("revision_date"),
                       _e(first(F.col("r.Description"))).alias("description"))


def document_revision(docs: DataFrame) -> DataFrame:
    """Every revision of every document (the document row keeps the latest)."""
    return _revision_rows(docs)


def latest_revision(revisions) -> Column:
    """The latest entry of a revision array (greatest date, then greatest
    number read as a number, then description), computed inside the row:
    no explode, shuffle or join."""
    arr = F.coalesce(revisions, F.array().cast(f"array<{schemas.REVISION.simpleString()}>"))
    return F.array_max(F.transform(arr, lambda r: F.struct(
        _e(first(r["Date"])).alias("date"), _e(first(r["Number"])).try_cast("double").alias("num"),
        _e(first(r["Description"])).alias("description"), _e(first(r["Number"])).alias("number"))))


def document_info(docs: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per document; its revision fields are those of the latest
    revision (greatest date, then greatest number).  ``extra`` columns
    (expressions over the document row) are appended."""
    t = F.col("DocumentTracking")
    latest = latest_revision(t["RevisionHistory"]["Revision"])
    out = docs.select(
        F.col(DOC).alias("id"), _e(first(t["Status"])).alias("status"),
        _e(first(t["Version"])).alias("version"),
        latest["num"].cast("int").alias("revision_history_number"),
        latest["date"].try_cast("timestamp").alias("revision_history_date"),
        _e(latest["description"]).alias("revision_history_description"),
        first(t["InitialReleaseDate"]).try_cast("timestamp").alias("initial_relise_date"),
        first(t["CurrentReleaseDate"]).try_cast("timestamp").alias("current_relise_date"),
        _e(F.col("DocumentPublisher._Type")).alias("publisher_type"),
        _e(first(F.col("DocumentPublisher.ContactDetails"))).alias("contact_details"),
        _e(first(F.col("DocumentPublisher.IssuingAuthority"))).alias("issuring_authority"),
        _e(first(F.col("DocumentTitle"))).alias("document_title"),
        _e(first(F.col("DocumentType"))).alias("document_type"),
        *[_e(F.col(f"`{a}`")).alias(n) for a, n in zip(
            schemas.NAMESPACE_ATTRS,
            ["vlun", "dc", "cvrf_common", "prod", "scap_core", "cvssv2", "cpe_lang", "sch", "cvrf"])],
        F.col(DOC), *extra)
    return out.select(*[f.name for f in schemas.STAGING["document_info"].fields],
                      *out.columns[len(schemas.STAGING["document_info"].fields):])


def document_notes(docs: DataFrame) -> DataFrame:
    n = docs.select(DOC, F.posexplode("DocumentNotes.Note").alias("note_id", "n"))
    return n.select(DOC, F.col("note_id").cast("long").alias("note_id"), F.col("n._Title").alias("title"),
                    F.col("n._Audience").alias("audience"), F.col("n._Type").alias("notes_type"),
                    F.col("n._Ordinal").alias("ordinal"))


#: what is counted while a table is written: reason -> SQL condition on its rows (``_kb_text`` is not stored)
QUALITY = {
    "vulnerability": {"vulnerability without CVE": "cve IS NULL OR cve = ''"},
    "vulnerability_threats": {"threat without Description": "description = ''"},
    "vulnerability_score_set": {"score set without BaseScore": "base_score IS NULL",
                                "score set without TemporalScore": "temporal_score IS NULL",
                                "score set without Vector": "vector IS NULL"},
    "vulnerability_remediation": {"kb that is no number": "_kb_text <> '' AND kb = ''",
                                  "remediation without product": "size(product_id) = 0"},
    "msrc_data": {"catalog row of an unknown product": "product_names = ''"},
}


def shred(docs: DataFrame, vs: DataFrame | None = None, counted: bool = False) -> dict[str, DataFrame]:
    """Every staging table of the documents in ``docs``; ``vs`` has their vulnerabilities if these were read apart.
    ``counted`` keeps the columns that only :data:`QUALITY` looks at."""
    vs = vulnerabilities(docs) if vs is None else vs
    out = {
        "vulnerability": vulnerability(vs),
        "vulnerability_status": vulnerability_status(vs),
        "vulnerability_notes": vulnerability_notes(vs),
        "vulnerability_threats": vulnerability_threats(vs),
        "vulnerability_score_set": vulnerability_score_set(vs),
        "vulnerability_revision": vulnerability_revision(vs),
        "vulnerability_remediation": vulnerability_remediation(vs),
        "vulnerability_acknowledgment": vulnerability_acknowledgment(vs),
        "product": product(docs),
        "document_info": document_info(docs),
        "document_revision": document_revision(docs),
        "document_notes": document_notes(docs),
    }
    return {k: df.select(*[f.name for f in schemas.STAGING[k].fields], *[c for c in df.columns if c.startswith("_")])
            if counted else df.select(*[f.name for f in schemas.STAGING[k].fields]) for k, df in out.items()}


def distinct_cwes(vuln: DataFrame) -> DataFrame:
    return vuln.select("cwe").distinct()
