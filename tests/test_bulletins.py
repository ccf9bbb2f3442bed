"""Hand-written bulletins: shredding, marts and their quirks."""

import datetime as dt
import os

from pyspark.sql import functions as F

from support import FIXTURES
from patchlens import schemas
from patchlens.plans import bulletin_warehouse as bw
from patchlens.plans import shred as S
from patchlens.plans.marts import cve_mart, msrc_catalog
from patchlens.sources.xml_bulletins import corrupt_documents, parse_bulletin_text, read_bulletins

AS_OF = "2024-04-20 00:00:00"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_labels_and_prefix_handling(bulletins):
    assert rows(bulletins, "doc_xml_date") == [("2024-Apr",), ("2024-Feb",), ("2024-Jan",), ("2024-Mar",)]
    # prefixed (Jan, Mar) and unprefixed (Feb, Apr) documents read alike
    titles = dict(rows(bulletins, "doc_xml_date", "DocumentTitle"))
    assert titles["2024-Jan"] == ["January 2024 Security Updates"]
    assert titles["2024-Feb"] == ["February 2024 Security Updates"]


def test_staging_schemas(staging):
    for name, df in staging.items():
        assert df.columns == schemas.STAGING[name].fieldNames(), name


def test_vulnerability_rows_and_positions(staging):
    v = staging["vulnerability"]
    got = rows(v, "doc_xml_date", "id", "cve", "title", "cwe", "cwe_text")
    assert ("2024-Jan", 0, "CVE-2024-0001", "Windows Kernel Elevation of Privilege Vulnerability",
            "CWE-416", "Use After Free") in got
    # empty Title and missing CWE become ''
    assert ("2024-Feb", 0, "CVE-2024-0101", "", "", "") in got
    # an element without Ordinal is rejected; the next one takes position 1
    apr = [r for r in got if r[0] == "2024-Apr"]
    assert [(r[1], r[2]) for r in apr] == [(0, "CVE-2024-0301"), (1, "CVE-2024-0302")]


def test_rejected_vulnerabilities_counted(bulletins):
    got = dict(rows(S.rejected_vulnerabilities(bulletins), "doc_xml_date", "rejected"))
    assert got == {"2024-Apr": 1, "2024-Feb": 0, "2024-Jan": 0, "2024-Mar": 0}


def test_status_one_row_per_product(staging):
    got = rows(staging["vulnerability_status"].where("doc_xml_date = '2024-Jan'"),
               "vulnerability_fk", "status_type", "product_id")
    assert got == [(0, "Known Affected", "11568"), (0, "Known Affected", "11569"),
                   (1, "Known Affected", "12085")]


def test_threat_without_product(staging):
    got = rows(staging["vulnerability_threats"].where("doc_xml_date = '2024-Feb'"),
               "title", "threats_type", "description", "product_id")
    assert got == [("", "Impact", "Denial of Service", "")]


def test_remediation_kb_digits_only(staging):
    got = rows(staging["vulnerability_remediation"].where("doc_xml_date = '2024-Jan'"),
               "vulnerability_fk", "kb", "remediation_type", "url", "subtype", "fixed_build")
    assert (0, "", "Workaround", "", "", "") in got
    assert (0, "5034122", "Vendor Fix", "https://support.example.com/5034122", "Security Update",
            "10.0.17763.5329") in got
    arr = staging["vulnerability_remediation"].where("kb = '5034122' AND doc_xml_date = '2024-Jan'") \
        .select("product_id").first()[0]
    assert arr == ["11568", "11569"]


def test_acknowledgment_first_name(staging):
    assert rows(staging["vulnerability_acknowledgment"], "name", "url") == \
        [("Jane Researcher", "https://example.org/jane")]


def test_product_tree_levels(staging, bulletins):
    p = rows(staging["product"], "doc_xml_date", "id", "product_type", "branch_name")
    assert ("2024-Jan", "9999", "", "") in p                         # top-level product
    assert ("2024-Jan", "10051", "Product Family", "ESU") in p       # second level
    assert ("2024-Apr", "20001", "Edition", "Enterprise") in p       # fifth level
    assert S.product_tree_overflow(bulletins).where("overflow > 0").count() == 0


def test_document_info_latest_revision(staging):
    d = {r.id: r for r in staging["document_info"].collect()}
    apr = d["2024-Apr"]
    assert apr.revision_history_number == 2
    assert apr.revision_history_description == "Corrected product list"
    assert apr.revision_history_date == dt.datetime(2024, 4, 16, 7, 0)
    jan = d["2024-Jan"]
    assert jan.vlun == "http://www.icasi.org/CVRF/schema/vuln/1.1"
    assert jan.cvrf_common == "http://www.icasi.org/CVRF/schema/common/1.1"
    assert d["2024-Feb"].vlun == ""
    assert staging["document_revision"].where("doc_xml_date = '2024-Apr'").count() == 2


def test_document_notes(staging):
    got = rows(staging["document_notes"], "doc_xml_date", "note_id", "title", "audience")
    assert got == [("2024-Jan", 0, "Release Notes", "Public"), ("2024-Jan", 1, "Legal Disclaimer", "Public")]


def test_corrupt_document_isolated(spark):
    docs = read_bulletins(spark, os.path.join(FIXTURES, "bad", "*.xml"))
    bad = corrupt_documents(docs).collect()
    assert len(bad) == 1 and bad[0].doc_xml_date == "2023-Dec"


def test_cve_mart_revision_quirk(staging):
    cve = cve_mart(staging, AS_OF)
    r = cve.where("cve = 'CVE-2024-0201'").select("rev_number", "rev_date", "rev_description").distinct().collect()
    # max date (03-20, number 1.1) and max number (1.2) sit on different rows: description ''
    assert [(round(x.rev_number, 3), x.rev_date, x.rev_description) for x in r] == \
        [(1.2, "2024-03-20T07:00:00", "")]
    r2 = cve.where("cve = 'CVE-2024-0202'").select("rev_number", "rev_description").distinct().collect()
    # 1.10 and 1.1 are the same float: both rows match
    assert sorted(x.rev_description for x in r2) == ["First.", "Second."]


def test_cve_mart_defaults_for_missing_children(staging):
    cve = cve_mart(staging, AS_OF)
    adv = cve.where("cve = 'ADV240001'").collect()
    assert len(adv) == 1
    a = adv[0]
    assert a.status_type == "" and a.status_product_id == [] and a.base_score == ""
    assert a.rev_number == 0.0 and a.note == []
    assert a.timestamp == dt.datetime(2024, 4, 20)


def test_msrc_top_build_is_text_order(staging):
    cve = cve_mart(staging, AS_OF)
    products = bw.latest_products(staging["product"])
    msrc = msrc_catalog(cve, staging["vulnerability_remediation"], products, AS_OF)
    got = rows(msrc.where("cve = 'CVE-2024-0201'"), "kb", "kb_product_id", "fixed_build")
    # '10.0.9' > '10.0.10' as text
    assert got == [("5035845", "11568", "10.0.9"), ("5035845", "11569", "10.0.9")]
    # the text remediation (kb '') never reaches the catalog
    assert msrc.where("kb = ''").count() == 0
    # one row per (cve, month, kb, product id, product name)
    keys = ["cve", "doc_xml_date", "kb", "kb_product_id", "product_names"]
    assert msrc.groupBy(*keys).count().where("count > 1").count() == 0


def test_load_is_idempotent(spark, bulletins, scratch):
    root = os.path.join(scratch, "wh")
    assert bw.load_documents(spark, bulletins, root, AS_OF) == ["2024-Apr", "2024-Feb", "2024-Jan", "2024-Mar"]
    first = {t: bw.read_table(spark, root, t).count() for t in ("cve_data", "msrc_data", "vulnerability")}
    # the current month is re-delivered: same rows afterwards
    again = bulletins.where(F.col("doc_xml_date") == "2024-Apr")
    assert bw.load_documents(spark, again, root, AS_OF) == ["2024-Apr"]
    second = {t: bw.read_table(spark, root, t).count() for t in ("cve_data", "msrc_data", "vulnerability")}
    assert first == second
    batch = cve_mart(bw_staging(spark, root), AS_OF)
    assert batch.exceptAll(bw.read_table(spark, root, "cve_data").select(*batch.columns)).count() == 0


def bw_staging(spark, root):
    return {k: bw.read_table(spark, root, k) for k in schemas.STAGING}


def test_in_document_mart_equals_star_join(bulletins, staging):
    from patchlens.plans.marts import cve_mart_in_document
    a = cve_mart(staging, AS_OF)
    b = cve_mart_in_document(bulletins.where(F.col("_corrupt_record").isNull()), AS_OF)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_load_with_in_document_mart(spark, bulletins, scratch):
    a_root, b_root = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    bw.load_documents(spark, bulletins, a_root, AS_OF)
    bw.load_documents(spark, bulletins, b_root, AS_OF, mart="in_document")
    for t in ("cve_data", "msrc_data"):
        a, b = bw.read_table(spark, a_root, t), bw.read_table(spark, b_root, t)
        assert a.exceptAll(b.select(*a.columns)).count() == 0, t
        assert b.exceptAll(a.select(*b.columns)).count() == 0, t


def test_rejected_text_is_kept_whole(spark, scratch):
    text = "<cvrfdoc><DocumentTitle>" + "open " * 2000
    docs = parse_bulletin_text(spark.createDataFrame([("2023-Nov", text)], "label string, xml string"), "xml", "label")
    bw.load_documents(spark, docs, os.path.join(scratch, "text"), AS_OF)
    assert rows(bw.rejects(spark, os.path.join(scratch, "text")), "reason", "path", "detail") == [("malformed", None, text)]
    os.makedirs(os.path.join(scratch, "landing"))
    with open(os.path.join(scratch, "landing", "2023-Nov.xml"), "w") as f:
        f.write(text)
    bw.load_documents(spark, read_bulletins(spark, os.path.join(scratch, "landing")), os.path.join(scratch, "file"), AS_OF)
    (row,) = bw.rejects(spark, os.path.join(scratch, "file")).collect()
    assert row["path"].endswith("2023-Nov.xml") and row["detail"] == text


def test_documents_of_both_deliveries_come_from_one_pass_over_the_lines(spark):
    from patchlens import queries_bulletins as qb
    from support import SF_SMALL
    facts = qb.month_facts(spark, SF_SMALL)
    for second in (False, True):
        docs = qb.month_documents(facts, second)
        plan = docs._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan and "Relation" in plan
        labels = [r[0] for r in docs.select("label").collect()]
        assert labels and (all(x.startswith(qb.AGAIN) for x in labels) if second else len(set(x[:4] for x in labels)) > 1)
