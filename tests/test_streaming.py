"""Streams equal batch; re-delivery is idempotent."""

import os
import shutil

from support import FIXTURES
from patchlens import schemas
from patchlens.plans import bulletin_warehouse as bw
from patchlens.streaming import incremental

AS_OF = "2024-04-20 00:00:00"


def test_bulletin_stream_equals_batch(spark, bulletins, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    for name in ("2024-Jan.xml", "2024-Feb.xml"):
        shutil.copy(os.path.join(FIXTURES, "bulletins", name), landing)
    root, ckpt = os.path.join(scratch, "wh"), os.path.join(scratch, "ckpt")
    incremental.load_bulletin_stream(spark, landing, root, ckpt, AS_OF)
    # two more months land later; the same stream picks up only those
    for name in ("2024-Mar.xml", "2024-Apr.xml"):
        shutil.copy(os.path.join(FIXTURES, "bulletins", name), landing)
    incremental.load_bulletin_stream(spark, landing, root, ckpt, AS_OF)
    batch_root = os.path.join(scratch, "batch")
    bw.load_documents(spark, bulletins, batch_root, AS_OF)
    for t in ("cve_data", "msrc_data", "product", "vulnerability_remediation"):
        a, b = bw.read_table(spark, root, t), bw.read_table(spark, batch_root, t)
        assert a.exceptAll(b.select(*a.columns)).count() == 0, t
        assert b.exceptAll(a.select(*b.columns)).count() == 0, t


def test_latest_log_survives_retried_epoch(spark, scratch):
    path = os.path.join(scratch, "latest")
    df = spark.createDataFrame([("h", "c", 1, "a"), ("h", "c", 2, "b"), ("k", "c", 1, "z")],
                               "hostname string, cve string, ts int, v string")
    run = incremental.latest_log_batch(path, ["hostname", "cve"], ["ts"], df.columns)
    run(df, 0)
    run(df, 0)  # a retried epoch rewrites only its own partition
    run(spark.createDataFrame([("h", "c", 0, "old")], df.schema), 1)
    got = sorted(tuple(r) for r in incremental.read_latest(spark, path, ["hostname", "cve"], ["ts"]).collect())
    assert got == [("h", "c", 2, "b"), ("k", "c", 1, "z")]
    assert schemas.CORRUPT == "_corrupt_record"


def test_backfill_loads_only_missing_months(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    for name in ("2024-Jan.xml", "2024-Feb.xml"):
        shutil.copy(os.path.join(FIXTURES, "bulletins", name), landing)
    root = os.path.join(scratch, "wh")
    assert bw.backfill(spark, os.path.join(landing, "*.xml"), root, 2024, 2024, AS_OF) == ["2024-Feb", "2024-Jan"]
    for name in ("2024-Mar.xml", "2024-Apr.xml"):
        shutil.copy(os.path.join(FIXTURES, "bulletins", name), landing)
    # only the two new months are loaded on the next run
    assert bw.backfill(spark, os.path.join(landing, "*.xml"), root, 2024, 2024, AS_OF) == ["2024-Apr", "2024-Mar"]
    assert bw.backfill(spark, os.path.join(landing, "*.xml"), root, 2024, 2024, AS_OF) == []
    labels = sorted(r[0] for r in bw.loaded_labels(spark, root).collect())
    assert labels == ["2024-Apr", "2024-Feb", "2024-Jan", "2024-Mar"]


def test_redelivery_of_a_month(spark, scratch):
    """A corrected document under a new path replaces its month, also where rows are gone; an
    older delivery that arrives late changes nothing; a rewritten file is seen by a backfill."""
    landing = os.path.join(scratch, "landing")
    root, ckpt = os.path.join(scratch, "wh"), os.path.join(scratch, "ckpt")
    head = '<cvrfdoc><DocumentTitle>{t}</DocumentTitle><DocumentTitle>second</DocumentTitle><Vulnerability Ordinal="1">'
    body = ("<CVE>CVE-1</CVE><CWE ID='first'>a</CWE><CWE ID='last'>b</CWE><Remediations><Remediation Type='Vendor Fix'>"
            "<Description>555</Description><URL>u1</URL><URL>u2</URL><ProductID>p2</ProductID></Remediation></Remediations>")
    end = "</Vulnerability></cvrfdoc>"

    def put(folder, title, text, at):
        os.makedirs(os.path.join(landing, folder), exist_ok=True)
        path = os.path.join(landing, folder, "2024-Jan.xml")
        with open(path, "w") as f:
            f.write(head.format(t=title) + text + end)
        os.utime(path, (at, at))

    put("a", "old", body, 1_700_000_000)
    incremental.load_bulletin_stream(spark, landing, root, ckpt, AS_OF)  # no acknowledgment, no note: empty tables
    cve = bw.read_table(spark, root, "cve_data").collect()
    assert [(r.kb, r.cwe, r.doc_document_title) for r in cve] == [("555", "first", "old")]
    assert bw.read_table(spark, root, "vulnerability_remediation").first().url == "u1"
    assert bw.read_table(spark, root, "msrc_data").first().product_names == ""
    put("b", "new", "<CVE>CVE-1</CVE>", 1_700_000_100)
    put("c", "late", body, 1_699_999_000)
    incremental.load_bulletin_stream(spark, landing, root, ckpt, AS_OF)
    assert [(r.kb, r.doc_document_title) for r in bw.read_table(spark, root, "cve_data").collect()] == [("", "new")]
    for t in ("vulnerability_remediation", "msrc_data", "vulnerability_acknowledgment"):
        assert bw.read_table(spark, root, t).count() == 0
    assert [r.reason for r in bw.rejects(spark, root).collect()] == ["superseded"]
    assert bw.backfill(spark, landing, root, 2024, 2024, AS_OF) == []
    put("a", "rewritten", body, 1_700_000_200)
    assert bw.backfill(spark, landing, root, 2024, 2024, AS_OF) == ["2024-Jan"]
    assert bw.read_table(spark, root, "cve_data").first().doc_document_title == "rewritten"
    put("d", "x", body, 1_700_000_300)
    with open(os.path.join(landing, "d", "2024-MAR.xml"), "w") as f:
        f.write(head + end)
    with open(os.path.join(landing, "d", "2024-Apr.xml"), "w") as f:
        f.write("<cvrfdoc><open>")
    from patchlens.sources.xml_bulletins import read_bulletins
    assert bw.load_documents(spark, read_bulletins(spark, landing), root, AS_OF) == ["2024-Jan"]
    reasons = sorted(r.reason for r in bw.rejects(spark, root).where("load_id = 4").collect())
    assert reasons == ["malformed", "superseded", "superseded", "superseded", "unlabelled"]


def test_latest_snapshot(spark, scratch):
    path = os.path.join(scratch, "latest")
    keys, order = ["k"], ["ts"]
    run = incremental.latest_log_batch(path, keys, order, ["k", "ts", "v"])
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, ts int, v string")
    run(frame(("a", 1, "x"), ("b", 1, "y")), 0)
    run(frame(("a", 2, "z")), 1)
    incremental.compact_latest(spark, path, keys, order)
    run(frame(("b", 1, "tie"), ("c", 1, "w")), 2)
    got = sorted(map(tuple, incremental.read_latest(spark, path, keys, order).collect()))
    assert got == [("a", 2, "z"), ("b", 1, "tie"), ("c", 1, "w")]
    assert incremental._parts(spark, path) == (1, [2])
