"""Bulletins read by byte ranges against whole documents."""

import os

import pytest
from pyspark.sql import functions as F
from support import FIXTURES

from patchlens.plans.shred import shred
from patchlens.sources.xml_bulletins import read_bulletins, valid_documents
from patchlens.sources.xml_split import read_split_bulletins, split_shred

ODD = """<?xml version="1.0"?>
<cvrfdoc xmlns:vuln="http://v"><DocumentTitle>Odd</DocumentTitle>
<Vulnerability><Title>bare, no Ordinal</Title></Vulnerability>
<Vulnerability Ordinal="1"><Title>about Vulnerability> and &lt;Vulnerability></Title><CVE>C1</CVE>
 <Notes><Note Title="n" Type="t" Ordinal="0">the word Vulnerability &amp; more</Note></Notes></Vulnerability>
<!-- a comment on some Vulnerability> -->
<vuln:Vulnerability
   Ordinal = '7'><vuln:CVE>C2</vuln:CVE></vuln:Vulnerability>
<Vulnerability Ordinal="8"><CVE>C3</CVE></Vulnerability>
<DocumentNotes><Note Title="after" Audience="a" Type="b" Ordinal="1">x</Note></DocumentNotes>
</cvrfdoc>
"""


@pytest.fixture()
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def test_fixture_tables_equal_the_whole_document_shred(spark, staging, small_ranges):
    split = split_shred(spark, os.path.join(FIXTURES, "bulletins", "*.xml"))
    assert set(split) == set(staging)
    for name, want in staging.items():
        assert same(want, split[name]), name


def test_odd_texts_and_a_large_file_in_many_tasks(spark, scratch, small_ranges):
    with open(f"{scratch}/2024-May.xml", "w") as f:
        f.write(ODD)
    many = "".join(f'<Vulnerability{f" Ordinal=\"{i}\"" if i % 5 else ""}><Title>t{i}</Title><CVE>C{i}</CVE><ProductStatuses>'
                   f'<Status Type="x"><ProductID>{i}</ProductID></Status></ProductStatuses></Vulnerability>\n'
                   for i in range(3000))
    with open(f"{scratch}/2024-Jun.xml", "w") as f:
        f.write(f"<cvrfdoc><DocumentTitle>Many</DocumentTitle>{many}</cvrfdoc>")
    whole = shred(valid_documents(read_bulletins(spark, scratch)))
    split = split_shred(spark, scratch)
    for name, want in whole.items():
        assert same(want, split[name]), name
    assert whole["vulnerability"].count() == 3 + 2400
    _, vulnerabilities = read_split_bulletins(spark, f"{scratch}/2024-Jun.xml")
    scanned = vulnerabilities.sparkSession.read.option("lineSep", "Vulnerability>").text(f"{scratch}/2024-Jun.xml")
    assert scanned.select(F.spark_partition_id()).distinct().count() > 100


def test_documents_without_vulnerabilities(spark, scratch):
    with open(f"{scratch}/2024-Jul.xml", "w") as f:
        f.write("<cvrfdoc><DocumentTitle>Empty</DocumentTitle></cvrfdoc>")
    docs, vulnerabilities = read_split_bulletins(spark, scratch)
    assert [(r.doc_xml_date, r.DocumentTitle) for r in docs.collect()] == [("2024-Jul", ["Empty"])]
    assert vulnerabilities.count() == 0
