"""Generic operators on small frames."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens.operators.joins import left_join_with_defaults, range_join
from patchlens.operators.windows import top_n_per_group
from patchlens.sources.warehouse import (create_table_if_absent, missing_labels, months_between_years,
                                         rename_by_position)


def test_defaults_per_type(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a", 3, ["x"], None)],
                                  "k int, s string, n long, arr array<string>, keep string")
    got = {r.k: r for r in left_join_with_defaults(left, right, ["k"], keep_null=["keep"]).collect()}
    assert (got[2].s, got[2].n, got[2].arr, got[2].keep) == ("", 0, [], None)
    assert (got[1].s, got[1].n, got[1].arr) == ("a", 3, ["x"])


def test_null_keys(spark):
    left = spark.createDataFrame([(None,), ("h",)], "k string")
    right = spark.createDataFrame([(None, "n"), ("h", "y")], "k string, v string")
    plain = {(r.k, r.v) for r in left_join_with_defaults(left, right, ["k"]).collect()}
    safe = {(r.k, r.v) for r in left_join_with_defaults(left, right, ["k"], null_safe=True).collect()}
    assert plain == {(None, ""), ("h", "y")}      # a NULL key matches nothing
    assert safe == {(None, "n"), ("h", "y")}      # pandas-style: NULL meets NULL


def test_salted_range_join_equals_plain(spark):
    left = spark.range(200).select((F.col("id") % 3).alias("line"), (F.col("id") * 7 % 101).alias("x"))
    right = spark.range(300).select((F.col("id") % 3).alias("line2"), (F.col("id") * 13 % 97).alias("y"))
    plain = range_join(left, right, [("line", "line2")], right_greater=("x", "y"))
    salted = range_join(left, right, [("line", "line2")], right_greater=("x", "y"), salt=8)
    assert plain.count() > 0
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    assert salted.columns == plain.columns == ["line", "x", "line2", "y"]


def test_top_n_keeps_n(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (1, 6), (2, 1)], "k int, v int")
    got = sorted(tuple(r) for r in top_n_per_group(df, ["k"], [F.col("v").desc()], 2).collect())
    assert got == [(1, 6), (1, 7), (2, 1)]


def _plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_positional_rename(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert rename_by_position(df, ["id", "name"]).columns == ["id", "name"]


def test_missing_months(spark):
    spine = months_between_years(spark, 2020, 2021)
    assert spine.count() == 24
    loaded = spark.createDataFrame([("2020-Jan",), ("2021-Dec",)], "doc_xml_date string")
    miss = [r.label for r in missing_labels(spine, loaded).collect()]
    assert len(miss) == 22 and "2020-Jan" not in miss and "2020-Feb" in miss


def test_create_table_if_absent(spark, scratch):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("doc_xml_date", T.StringType())])
    path = os.path.join(scratch, "t")
    create_table_if_absent(spark, "patchlens_test_t", schema, path)
    create_table_if_absent(spark, "patchlens_test_t", schema, path)  # second call is a no-op
    assert spark.table("patchlens_test_t").columns == ["id", "doc_xml_date"]
