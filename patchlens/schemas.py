"""Explicit schemas: the nested bulletin document and every table we write.

Nothing is inferred.  The document schema follows the CVRF element tree
with namespace prefixes ignored (``ignoreNamespace``): attributes are
``_Name``, element text next to attributes is ``_VALUE``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()
TS = T.TimestampType()


def _arr(t: T.DataType) -> T.ArrayType:
    return T.ArrayType(t, True)


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# a child element that may repeat although one is meant: typed as a list, its first entry counts
ONE = _arr(S)

REVISION = _st(("Number", ONE), ("Date", ONE), ("Description", ONE))
PRODUCT_NAME = _st(("_ProductID", S), ("_VALUE", S))

# Branch levels of the parse, the deepest level being text; deeper trees are
# walked as texts (``bulletin_warehouse.deep_products``)
BRANCH_DEPTH = 6


def branch_type(depth: int = BRANCH_DEPTH) -> T.DataType:
    inner: T.DataType = S
    for _ in range(depth):
        inner = _st(("_Type", S), ("_Name", S), ("FullProductName", _arr(PRODUCT_NAME)),
                    ("Branch", _arr(inner)))
    return inner


VULNERABILITY = _st(
    ("_Ordinal", S),
    ("Title", ONE),
    ("CVE", ONE),
    ("CWE", _arr(_st(("_ID", S), ("_VALUE", S)))),
    ("Notes", _st(("Note", _arr(_st(("_Title", S), ("_Type", S), ("_Ordinal", S), ("_VALUE", S)))))),
    ("ProductStatuses", _st(("Status", _arr(_st(("_Type", S), ("ProductID", _arr(S))))))),
    ("Threats", _st(("Threat", _arr(_st(("_Type", S), ("Description", ONE), ("ProductID", _arr(S))))))),
    ("CVSSScoreSets", _st(("ScoreSet", _arr(_st(("BaseScore", ONE), ("TemporalScore", ONE), ("Vector", ONE),
                                               ("ProductID", _arr(S))))))),
    ("Acknowledgments", _st(("Acknowledgment", _arr(_st(("Name", _arr(S)), ("URL", _arr(S))))))),
    ("RevisionHistory", _st(("Revision", _arr(REVISION)))),
    ("Remediations", _st(("Remediation", _arr(_st(
        ("_Type", S), ("Description", ONE), ("URL", ONE), ("ProductID", _arr(S)), ("SubType", ONE),
        ("FixedBuild", ONE)))))),
)

# namespace declarations of the root element, as they arrive under ignoreNamespace
NAMESPACE_ATTRS = ["_vuln", "_dc", "_cvrf-common", "_prod", "_scap-core", "_cvssv2", "_cpe-lang",
                   "_sch", "_cvrf"]

CORRUPT = "_corrupt_record"


def selected(t: T.DataType, paths: list[str]) -> T.DataType:
    """The parts of ``t`` that dotted ``paths`` name, each whole below its end, in the order of ``t`` (lists are passed through)."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(selected(t.elementType, paths), t.containsNull)
    if unknown := {p.partition(".")[0] for p in paths} - set(t.fieldNames()):
        raise KeyError(unknown)
    below = {f.name: [p.partition(".")[2] for p in paths if p.partition(".")[0] == f.name] for f in t.fields}
    return T.StructType([T.StructField(f.name, f.dataType if "" in below[f.name] else selected(f.dataType, below[f.name]),
                                       f.nullable) for f in t.fields if below[f.name]])


def document_type(depth: int = BRANCH_DEPTH) -> T.StructType:
    """The document schema with ``depth`` levels of product branches."""
    return T.StructType(
        [T.StructField(a, S, True) for a in NAMESPACE_ATTRS]
        + [
            T.StructField("DocumentTitle", ONE, True),
            T.StructField("DocumentType", ONE, True),
            T.StructField("DocumentPublisher", _st(("_Type", S), ("ContactDetails", ONE),
                                                   ("IssuingAuthority", ONE)), True),
            T.StructField("DocumentTracking", _st(
                ("Identification", _st(("ID", ONE), ("Alias", ONE))), ("Status", ONE), ("Version", ONE),
                ("RevisionHistory", _st(("Revision", _arr(REVISION)))),
                ("InitialReleaseDate", ONE), ("CurrentReleaseDate", ONE)), True),
            T.StructField("DocumentNotes", _st(("Note", _arr(_st(
                ("_Title", S), ("_Audience", S), ("_Type", S), ("_Ordinal", S), ("_VALUE", S))))), True),
            T.StructField("ProductTree", _st(("Branch", _arr(branch_type(depth))),
                                             ("FullProductName", _arr(PRODUCT_NAME))), True),
            T.StructField("Vulnerability", _arr(VULNERABILITY), True),
            T.StructField(CORRUPT, S, True),
        ])


DOCUMENT = document_type()


def _table(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# ---- staging tables (every one carries doc_xml_date, the month label) ----
STAGING = {
    "vulnerability": _table(("id", L, False), ("doc_xml_date", S, True), ("cve", S, True),
                            ("title", S, True), ("cwe", S, True), ("cwe_text", S, True)),
    "vulnerability_status": _table(("vulnerability_fk", L, False), ("doc_xml_date", S, True),
                                   ("status_type", S, False), ("product_id", S, True)),
    "vulnerability_notes": _table(("vulnerability_fk", L, False), ("doc_xml_date", S, True),
                                  ("title", S, True), ("notes_type", S, True), ("note", S, True)),
    "vulnerability_threats": _table(("vulnerability_fk", L, False), ("doc_xml_date", S, True),
                                    ("title", S, False), ("threats_type", S, False),
                                    ("description", S, False), ("product_id", S, True)),
    "vulnerability_score_set": _table(("vulnerability_fk", L, False), ("doc_xml_date", S, True),
                                      ("base_score", S, False), ("temporal_score", S, False),
                                      ("vector", S, False), ("product_id", S, True)),
    "vulnerability_revision": _table(("vulnerability_fk", L, False), ("doc_xml_date", S, True),
                                     ("number", S, False), ("revision_date", S, False),
                                     ("description", S, False)),
    "vulnerability_remediation": _table(("vulnerability_fk", L, False), ("doc_xml_date", S, True),
                                        ("kb", S, False), ("remediation_type", S, False),
                                        ("url", S, False), ("product_id", _arr(S), False),
                                        ("subtype", S, False), ("fixed_build", S, False)),
    "vulnerability_acknowledgment": _table(("vulnerability_fk", L, False), ("doc_xml_date", S, True),
                                           ("name", S, False), ("url", S, False)),
    "product": _table(("id", S, False), ("product_name", S, False), ("product_type", S, False),
                      ("branch_name", S, False), ("doc_xml_date", S, True)),
    "document_info": _table(
        ("id", S, False), ("status", S, False), ("version", S, False),
        ("revision_history_number", I, True), ("revision_history_date", TS, True),
        ("revision_history_description", S, False), ("initial_relise_date", TS, True),
        ("current_relise_date", TS, True), ("publisher_type", S, False), ("contact_details", S, False),
        ("issuring_authority", S, False), ("document_title", S, False), ("document_type", S, False),
        ("vlun", S, False), ("dc", S, False), ("cvrf_common", S, False), ("prod", S, False),
        ("scap_core", S, False), ("cvssv2", S, False), ("cpe_lang", S, False), ("sch", S, False),
        ("cvrf", S, False), ("doc_xml_date", S, True)),
    "document_revision": _table(("doc_xml_date", S, True), ("number", S, False), ("revision_date", S, False),
                                ("description", S, False)),
    "document_notes": _table(("doc_xml_date", S, True), ("note_id", L, False), ("title", S, True),
                             ("audience", S, True), ("notes_type", S, True), ("ordinal", S, True)),
}

# ---- mart tables ----
MARTS = {
    "cve_data": _table(
        ("timestamp", TS, True), ("doc_xml_date", S, True), ("cve", S, True), ("vul_title", S, True),
        ("cwe", S, True), ("cwe_text", S, True), ("status_type", S, False), ("status_product_id", _arr(S), False),
        ("note", _arr(S), False), ("threats_type", _arr(S), False), ("treat_description", _arr(S), False),
        ("base_score", S, False), ("temporal_score", S, False), ("score_set_product_id", _arr(S), False),
        ("rev_number", T.FloatType(), False), ("rev_date", S, False), ("rev_description", S, False),
        ("fixed_build", S, False), ("kb", S, False), ("kb_product_id", _arr(S), False),
        ("doc_revision_history_number", I, False), ("doc_revision_history_date", TS, False),
        ("doc_revision_history_description", S, False), ("doc_initial_relise_date", TS, False),
        ("doc_current_relise_date", TS, False), ("doc_document_title", S, False)),
    "msrc_data": _table(
        ("timestamp", TS, True), ("doc_xml_date", S, True), ("doc_initial_relise_date", TS, False),
        ("cve", S, True), ("base_score", S, False), ("temporal_score", S, False), ("kb", S, False),
        ("kb_product_id", S, True), ("product_names", S, False), ("cwe", S, True), ("vul_title", S, True),
        ("fixed_build", S, False), ("doc_document_title", S, False)),
}

# ---- the log of loads: the last committed load of a month is the one that readers see ----
LOAD_ID, COMMIT_ID = "load_id", "commit_id"
LOAD_COMMITS = _table((COMMIT_ID, L, False), ("doc_xml_date", S, False), (LOAD_ID, L, False), ("as_of_us", L, True),
                      ("path", S, True), ("delivered_us", L, True))
LOADS = _table((COMMIT_ID, L, False), ("doc_xml_date", S, False), (LOAD_ID, L, False), ("as_of", TS, True),
               ("path", S, True), ("delivered", TS, True))
QUALITY = _table((LOAD_ID, L, False), ("reason", S, False), ("n", L, False))
REJECTS = _table((LOAD_ID, L, False), ("doc_xml_date", S, True), ("path", S, True), ("reason", S, False),
                 ("n", L, False), ("detail", S, True))

# ---- host tables ----
HOST_PATCHES = _table(("hostname", S, True), ("hotfix_id", S, True), ("installed_on", S, True),
                      ("timestamp", TS, True))
HOST_OS = _table(("hostname", S, True), ("os_name", S, True), ("codename", S, True),
                 ("version", S, True), ("install_date", L, True), ("timestamp", TS, True))
HOSTS_KB = _table(("timestamp", TS, True), ("hostname", S, False), ("os_name", S, False),
                  ("os_version", S, False), ("last_kb", S, False), ("last_kb_date", S, False),
                  ("last_update_date", S, False), ("rec_kb_arr", _arr(_arr(S)), False),
                  ("cve", S, False))
