"""Scalar rules: character-set strip, rule lists, digits, labels, slice."""

import datetime as dt

from pyspark.sql import functions as F

from patchlens.functions.arrays import suffix_slice
from patchlens.functions.dates import month_label, parse_month_label, recent_filter
from patchlens.functions.rules import OS_CONTAINS_RULES, PRODUCT_PREFIX_RULES
from patchlens.functions.strings import (digits_or_empty, normalise_contains, normalise_prefix,
                                         strip_chars_to_int)


def _one(spark, rows, expr, schema="v string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("o")).collect()]


def test_strip_is_a_character_set(spark):
    out = _one(spark, [("KB5034122",), ("BK42",), ("KBKB7",), ("KB",), ("X1",), (None,)],
               strip_chars_to_int("v", "KB"))
    assert out == [5034122, 42, 7, None, None, None]


def test_product_prefix_rules(spark):
    names = ["Windows 10 Version 1809 for x64-based Systems", "Windows Server 2012 R2",
             "Windows Server, version 23H2 (Server Core installation)", "Windows Server 2022",
             "Windows 11 Version 23H2", "Office 2019", "Windows 8.1 for x64"]
    out = _one(spark, [(n,) for n in names], normalise_prefix("v", PRODUCT_PREFIX_RULES))
    assert out == ["Windows 10", "Windows Server 2012", "Windows Server", "Windows Server 2022",
                   "Windows 11", "Office 2019", "Windows 8"]


def test_os_contains_rules_lack_server_2022(spark):
    names = ["Microsoft Windows 10 Enterprise", "Microsoft Windows Server 2022 Datacenter",
             "Microsoft Windows Server 2019 Standard", "Ubuntu"]
    out = _one(spark, [(n,) for n in names], normalise_contains("v", OS_CONTAINS_RULES))
    assert out == ["Windows 10", "Microsoft Windows Server 2022 Datacenter", "Windows Server 2019", "Ubuntu"]


def test_rules_apply_sequentially(spark):
    # the first rule's target matches the second rule: sequential application chains
    rules = [("a", "bx"), ("b", "c")]
    out = _one(spark, [("ay",), ("bz",), ("q",)], normalise_prefix("v", rules))
    assert out == ["c", "c", "q"]


def test_digits_or_empty_ascii_only(spark):
    out = _one(spark, [("5034122",), ("12a",), ("",), ("٣٤",), (None,)], digits_or_empty("v"))
    assert out == ["5034122", "", "", "", ""]


def test_month_labels_round_trip(spark):
    out = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2023, 12, 31),)], "d date") \
        .select(month_label("d").alias("l")).select("l", parse_month_label("l").alias("p")).collect()
    assert [(r.l, r.p) for r in out] == [("2024-Jan", dt.date(2024, 1, 1)), ("2023-Dec", dt.date(2023, 12, 1))]


def test_recent_month_quirk_in_january(spark):
    rows = [(dt.datetime(2023, 12, 5),), (dt.datetime(2023, 6, 1),), (dt.datetime(2024, 1, 2),)]
    df = spark.createDataFrame(rows, "ts timestamp")
    month = df.where(recent_filter("ts", "2024-01-15", "month_number")).count()
    cal = df.where(recent_filter("ts", "2024-01-15", "calendar")).count()
    assert month == 3        # month(ts) >= 0: the year is ignored
    assert cal == 2          # December 2023 and January 2024


def test_suffix_slice_edge_cases(spark):
    s = "arr array<struct<kb:bigint,release_date:date>>, k bigint"
    e = lambda kb, d: {"kb": kb, "release_date": d}
    jan, feb, feb2 = dt.date(2024, 1, 5), dt.date(2024, 2, 1), dt.date(2024, 2, 9)
    rows = [([e(1, jan), e(3, feb), e(5, feb2)], 2),   # starts at first Feb kb above 2
            ([e(1, jan), e(3, feb), e(5, feb2)], 3),   # 5 is the first above 3
            ([e(1, jan), e(3, feb)], 4),               # nothing above
            ([e(5, jan), e(3, feb)], 1),               # qualifying must be in the last month
            ([], 1), (None, 1), ([e(1, jan)], None)]
    out = spark.createDataFrame(rows, s).select(suffix_slice("arr", F.col("k")).alias("o")).collect()
    kbs = [[x.kb for x in r.o] for r in out]
    assert kbs == [[3, 5], [5], [], [3], [], [], []]
