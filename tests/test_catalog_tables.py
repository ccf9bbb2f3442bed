"""Warehouse tables of the session catalog: same rows as plain folders, defaults, buckets, loads at once."""

import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest

from patchlens.operators.aggregates import independent_max_in_place, independent_max_match
from patchlens.plans import bulletin_warehouse as bw
from patchlens.plans.marts import cve_mart
from patchlens.queries_catalog import write_line_staging
from patchlens.sources.xml_bulletins import read_bulletins
from support import FIXTURES, SF_SMALL
from test_commit_log import AS_OF, landed
from test_plans import plan


def tables_of(spark, root, database=None):
    return bw.catalog(spark, database or f"wh_{uuid.uuid4().hex[:10]}", root, buckets=4)


def rows(spark, root, name, tables=None):
    return sorted(map(repr, bw.read_table(spark, root, name, tables=tables).collect()))


def test_load_equals_plain_folders(spark, scratch, bulletins):
    tables = tables_of(spark, f"{scratch}/catalog")
    labels = bw.load_documents(spark, bulletins, f"{scratch}/catalog", AS_OF, tables=tables)
    assert labels == bw.load_documents(spark, bulletins, f"{scratch}/plain", AS_OF)
    for name in bw.TABLES:
        assert rows(spark, f"{scratch}/catalog", name, tables) == rows(spark, f"{scratch}/plain", name), name
    counted = [sorted((r.reason, r.n) for r in bw.quality(spark, f"{scratch}/{x}").collect()) for x in ("catalog", "plain")]
    assert counted[0] == counted[1]
    # another session's catalog finds the partitions by their folders
    again = tables_of(spark, f"{scratch}/catalog")
    again.create()
    assert rows(spark, f"{scratch}/catalog", "cve_data", again) == rows(spark, f"{scratch}/plain", "cve_data")
    assert not [t.name for t in spark.catalog.listTables(tables.database) if "__load_" in t.name]


@pytest.mark.parametrize("months", [("2024-Jan", "2024-Feb"), ("2024-Jan", "2024-Jan")])
def test_loads_at_once(spark, scratch, months):
    paths = [landed(f"{scratch}/{x}", m, x.upper(), kb, p, s) for x, m, kb, p, s in
             (("a", months[0], 100, 1, 2_000), ("b", months[1], 200, 2, 3_000))]
    root = f"{scratch}/wh"
    tables = tables_of(spark, root)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda p: bw.load_documents(spark, read_bulletins(spark, p), root, AS_OF, tables=tables), paths))
    got = {(r.doc_xml_date, r.cve) for r in bw.read_table(spark, root, "cve_data", tables=tables).collect()}
    assert got == ({("2024-Jan", "CVE-100"), ("2024-Feb", "CVE-200")} if months[0] != months[1] else {("2024-Jan", "CVE-200")})


def test_the_star_has_no_exchange_below_its_distinct(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    staging = write_line_staging(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no child is small
    try:
        joined = cve_mart({**staging, "document_info": staging["document_info"].hint("broadcast")}, AS_OF, co_located=True)
        p = plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = p[:p.index("(1) ")]
    assert p.count("Bucketed: true") == 7 and "SortMergeJoin" in tree
    exchanges = re.findall(r"(?<!Broadcast)(?<!Reused)Exchange", tree)
    assert len(exchanges) == 1, tree  # of the DISTINCT


def test_newest_revision_in_place(spark):
    data = [(1, "2024-01", "1.0", "a"), (1, "2024-02", "2.0", "b"), (2, "2024-02", "1.0", "c"), (2, "2024-01", "2.0", "d"),
            (3, None, None, "e"), (3, None, None, "f"), (4, "2024-01", "1.10", "g"), (4, "2024-01", "1.1", "h"), (5, "2024-01", "x", "i")]
    df = spark.createDataFrame(data, "id int, day string, number string, text string")
    plain = independent_max_match(df, ["id"], "day", "number", ["text"])
    here = independent_max_in_place(df, ["id"], "day", "number", ["text"])
    assert sorted(map(repr, here.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_empty_rows_and_missing_columns(spark, scratch):
    tables = tables_of(spark, f"{scratch}/wh")
    tables.create()
    loads = spark.createDataFrame([("2024-Jan", 1)], "doc_xml_date string, load_id long")
    tables.write("vulnerability_score_set", spark.createDataFrame([], "vulnerability_fk long, doc_xml_date string"), 1, AS_OF)
    assert tables.read("vulnerability_score_set", loads).count() == 0
    tables.write("vulnerability_score_set", spark.createDataFrame(
        [(1, "2024-Jan", "extra")], "vulnerability_fk long, doc_xml_date string, load_note string"), 1, AS_OF)
    assert [tuple(r) for r in tables.read("vulnerability_score_set", loads).collect()] == [(1, "2024-Jan", "", "", "", None)]
    assert os.path.isdir(f"{scratch}/wh/vulnerability_score_set/load_id=1") and os.path.isdir(FIXTURES)
