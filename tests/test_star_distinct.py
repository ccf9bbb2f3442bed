"""The whole-row DISTINCT of the star marts, made before the joins."""

import datetime as dt

from pyspark.sql import functions as F

from patchlens.operators.joins import filled_with_defaults
from patchlens.operators.windows import distinct_in_groups
from patchlens.queries import mart_wide_star
from support import SF_SMALL
from test_plans import plan


def rows(df):
    return sorted(map(repr, df.collect()))


def odd_tables(spark, folder):
    """Orders and lines with repeated and null keys, and groups that NULL and '' make equal."""
    day = dt.datetime(1996, 3, 1)
    orders = [(1, day, "HIGH", "O"), (1, day, "HIGH", "O"), (1, day, "LOW", "O"), (2, day, None, "F"), (2, day, None, "F"),
              (None, day, "HIGH", "O"), (None, day, "HIGH", "O"), (3, None, "HIGH", None), (4, day, "HIGH", "O")]
    lines = [(1, "O", 7, 5, "R", 0.1), (1, "O", 7, 5, "R", 0.1), (1, "F", 8, 6, "N", 0.1), (2, None, 7, 5, None, 0.2),
             (2, "", 7, 5, "", 0.2), (2, "", 9, 5, "", None), (3, "O", None, None, "R", 0.1), (None, "O", 1, 1, "R", 0.1)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string") \
        .write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linestatus string, l_partkey long, l_suppkey long, l_returnflag string, "
                                 "l_tax double").write.parquet(f"{folder}/lineitem.parquet")


def test_wide_star_rows_are_distinct(spark, scratch):
    odd_tables(spark, scratch)
    got = mart_wide_star(spark, scratch)
    assert rows(got) == rows(got.distinct())
    by_cve = {c: [r for r in got.collect() if r.cve == c] for c in ("CVE-1", "CVE-2", "CVE-3", "CVE-4", None)}
    # two priorities x two status groups x two score groups
    assert len(by_cve["CVE-1"]) == 8 and {r.vul_title for r in by_cve["CVE-1"]} == {"HIGH", "LOW"}
    # the status groups NULL {7} and '' {7, 9} stay apart, the three score groups of supplier 5 too but for NULL and ''
    assert {(r.status_type, r.status_product_id) for r in by_cve["CVE-2"]} == {("", "7"), ("", "7,9")}
    assert len({(r.base_score, r.temporal_score, r.score_set_product_id) for r in by_cve["CVE-2"]}) * 2 == len(by_cve["CVE-2"])
    assert len(by_cve["CVE-3"]) == len(by_cve["CVE-4"]) == len(by_cve[None]) == 1


def test_wide_star_neither_hashes_nor_shuffles_its_rows(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(mart_wide_star(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = p[:p.index("(1) ")]
    above = tree[:tree.index("SortMergeJoin")]
    assert "Aggregate" not in above and "Exchange" not in above, tree


def test_distinct_in_groups(spark):
    df = spark.createDataFrame([(1, None, ["a"]), (1, "", ["a"]), (1, None, ["a"]), (None, "x", []), (None, "x", []), (2, "x", None)],
                               "k int, s string, a array<string>")
    assert rows(distinct_in_groups(df, ["k"])) == rows(df.distinct())
    filled = distinct_in_groups(filled_with_defaults(df, ["k"]), ["k"])
    assert rows(filled) == rows(df.select("k", F.coalesce("s", F.lit("")).alias("s"),
                                          F.coalesce("a", F.array().cast("array<string>")).alias("a")).distinct())
    tree = plan(distinct_in_groups(df.repartition("k"), ["k"]))
    assert tree[:tree.index("(1) ")].count("Exchange") == 1


def test_vulnerabilities_apart_have_the_star_of_all(spark, staging):
    """The DISTINCT before the joins: repeated rows, keys of two vulnerabilities, shared fields, null keys."""
    from pyspark.sql import functions as F

    from patchlens.plans.marts import cve_mart
    v = staging["vulnerability"]
    again = v.limit(3)
    st = dict(staging)
    st["vulnerability"] = (v.unionByName(again)                                        # repeated
                           .unionByName(again.withColumn("id", F.col("id") + 1))       # the fields of another id, under a key in use
                           .unionByName(again.withColumn("id", F.col("id") + 1_000))   # ... under a key without children
                           .unionByName(again.withColumn("id", F.lit(None).cast(v.schema["id"].dataType)))
                           .unionByName(again.withColumn("cve", F.lit("CVE-X"))))      # a key with two sets of fields
    rem, status = staging["vulnerability_remediation"], staging["vulnerability_status"]
    st["vulnerability_remediation"] = rem.unionByName(rem).unionByName(rem.withColumn("kb", F.lit(None).cast("string"))) \
        .unionByName(rem.withColumn("kb", F.lit("")))
    st["vulnerability_status"] = status.unionByName(status.withColumn("status_type", F.lit(None).cast("string"))) \
        .unionByName(status.withColumn("status_type", F.lit("")))
    st["document_info"] = staging["document_info"].unionByName(staging["document_info"])
    for tables in (staging, st):
        for co_located in (False, True):
            want = rows(cve_mart(tables, "2024-04-20", co_located=co_located))
            got = cve_mart(tables, "2024-04-20", co_located=co_located, apart=True)
            assert want and rows(got) == want


def test_co_located_star_shuffles_no_row_of_vulnerabilities_apart(spark):
    """Only the DISTINCT of those that share their fields is an exchange of star rows."""
    from patchlens.plans.marts import cve_mart
    from patchlens.queries_catalog import write_line_staging
    star = cve_mart(write_line_staging(spark, SF_SMALL), "1998-03-10", co_located=True, apart=True)
    tree = plan(star)
    tree = tree[:tree.index("(1) ")]
    first, second = tree.index("Union"), tree.rindex("HashAggregate")
    branch = tree[first:].split("\n")
    top = next(i for i, line in enumerate(branch[1:], 1) if "Join" in line)
    assert "Aggregate" not in "".join(branch[:top]) and "Exchange" not in "".join(branch[:top]) and second > first, tree


def test_catalog_sides_meet_where_they_are_reduced(spark):
    """One exchange for each side by (month, kb), and no sort between reducing and joining them."""
    from patchlens.plans.marts import catalog_top_build
    cve = spark.createDataFrame([("m", "k", "c", "1", "t")], "doc_xml_date string, kb string, cve string, base string, title string")
    rem = spark.createDataFrame([("m", "k", ["p"], "b")], "doc_xml_date string, kb string, product_id array<string>, fixed_build string")
    product = spark.createDataFrame([("p", "n")], "id string, product_name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = catalog_top_build(cve, rem, product.hint("broadcast"), carry=("base", "title"))
        p = plan(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = p[:p.index("(1) ")]
    assert tree.replace("BroadcastExchange", "").count("Exchange") == 2, tree
    assert tree.replace("SortMergeJoin", "").replace("SortAggregate", "").count("Sort") == 2, tree
    assert [tuple(r) for r in got.collect()] == [("m", "c", "k", "p", "n", "b", "1", "t")]
