"""Physical plan checks: the shapes that matter at scale."""

import io
import contextlib

import __spark_entry__ as E
from support import SF_SMALL
from patchlens.registry import all_queries


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top1_uses_window_group_limit(spark):
    for key in ("latest_per_key", "argmax_per_group"):
        p = plan(E.queries()[key](spark, SF_SMALL))
        assert "WindowGroupLimit" in p, key


def test_range_lookups_never_nested_loop(spark):
    for key in ("exposure_open_items", "exposure_recommended_list", "exposure_full_report"):
        p = plan(E.queries()[key](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_no_python_udfs(spark):
    for key, q in all_queries().items():
        if key.startswith(("stream_", "bulletin_")) or key in ("json_records_roundtrip", "rename_and_default_load",
                                                  "overwrite_month_idempotent"):
            continue
        p = plan(q(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_filters_and_columns_pushed_to_scan(spark):
    p = plan(E.queries()["recent_month_filter_calendar"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_in_document_mart_is_join_free(spark, bulletins):
    from patchlens.plans.marts import cve_mart_in_document
    p = plan(cve_mart_in_document(bulletins, "2024-04-20"))
    assert "Join" not in p
    assert p.count("Exchange hashpartitioning") <= 1      # the DISTINCT only


def test_spread_rows_uses_the_whole_cluster(spark):
    from patchlens.operators.partitioning import spread_rows
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    one = spark.range(100).coalesce(1)
    assert spread_rows(one, ["id"]).rdd.getNumPartitions() == n


def test_building_a_query_starts_no_shuffle(spark):
    """Schema reads aside, no job runs before the caller's action."""
    sc = spark.sparkContext
    for key in ("xml_position_key", "xml_cve_mart", "xml_nested_flatten", "xml_document_attrs"):
        sc.setJobGroup(f"build-{key}", key)
        E.queries()[key](spark, SF_SMALL)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{key}")
        stages = [s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
        assert len(stages) == len(jobs), key  # a shuffle would make a second stage
    sc.setJobGroup("tests", "tests")


def test_month_writes_split_and_sort(spark, scratch):
    """A big month is written by several tasks, and every file is sorted by label, then key."""
    import os

    import pyarrow.parquet as pq

    from patchlens.sources.warehouse import overwrite_folder, overwrite_partitions
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    was = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr("concat('2024-', if(id % 50 = 0, 'Feb', 'Jan')) AS doc_xml_date",
                                                       "uuid() AS cve")
        overwrite_partitions(rows, f"{scratch}/t", ["doc_xml_date"], sort_within=["cve"])
        overwrite_folder(rows, f"{scratch}/run", sort_within=["cve"])
    finally:
        spark.conf.set(size, was)
    for folder in (f"{scratch}/t/doc_xml_date=2024-Jan", f"{scratch}/run"):
        files = [os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")]
        assert len(files) > 3
        for f in files:
            cves = pq.ParquetFile(f).read(columns=["cve"]).column("cve").to_pylist()
            assert cves == sorted(cves)


def test_incremental_rebuild_reads_its_months_only(spark):
    from patchlens.queries import mart_catalog_top_build, mart_wide_star
    for build in (mart_wide_star, mart_catalog_top_build):
        p = plan(build(spark, SF_SMALL, ["1995-Dec", "1996-Jan", "1997-Mar"]))
        assert "GreaterThanOrEqual(o_orderdate,1995-12-01" in p and "LessThan(o_orderdate,1996-02-01" in p


def test_report_has_no_exchange_above_the_cves(spark):
    p = plan(E.queries()["exposure_full_report"](spark, SF_SMALL))
    tree = p[:p.index("(1) ")]
    assert tree.index("Generate") < tree.index("Exchange")
