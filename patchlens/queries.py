"""Registered queries over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names equal those of the matching SQL in :mod:`patchlens.oracles`.
Arrays are reported as sorted, comma-joined text so both engines compare.
The bulletin model is mapped onto the tables in :mod:`patchlens.plans.analog`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.functions.arrays import pairs_to_text
from patchlens.functions.dates import (DAY_FORMAT, TS_FORMAT, day_text, epoch_to_timestamp,
                                       in_months, month_label, parse_month_label, recent_filter,
                                       same_month)
from patchlens.functions.strings import (digits_or_empty, empty_if_null, normalise_contains,
                                         normalise_prefix, strip_chars_to_int)
from patchlens.operators.aggregates import (collect_distinct, independent_max_match,
                                            latest_value_per_item)
from patchlens.operators.joins import filled_with_defaults, left_join_with_defaults
from patchlens.operators.windows import distinct_in_groups, latest_per_key, top_n_per_group
from patchlens.plans import analog, exposure
from patchlens.tables import table

# Parameters of the driver-table queries (not values of the bulletin model).
AS_OF = "1998-03-10"
ANALOG_PREFIX_RULES = [("small", "small items"), ("large", "large items"), ("red", "red items"),
                       ("blue", "blue items"), ("hot", "hot items"), ("cold", "cold items")]
ANALOG_ALLOWED_LINES = ["small items", "large items", "red items", "blue items", "hot items"]
ANALOG_CONTAINS_RULES = [("bolt", "fasteners"), ("rod", "fasteners"), ("gear", "drive parts"),
                         ("ring", "drive parts"), ("widget", "gadgets"), ("gizmo", "gadgets")]


# ---------------------------------------------------------------- exposure
def exposure_open_items(spark: SparkSession, d: str) -> DataFrame:
    out = exposure.open_items(analog.hosts(spark, d), analog.installed(spark, d),
                              analog.catalog(spark, d))
    return out.select("hostname", "os_line", empty_if_null("last_kb").alias("last_kb"), "cve")


def exposure_recommended_list(spark: SparkSession, d: str) -> DataFrame:
    hi = analog.hosts(spark, d).join(analog.installed(spark, d), "hostname", "left")
    rows = hi.select("hostname", "os_line", "last_kb", F.col("os_line").alias("_line"), F.col("last_kb").alias("_hkb"))

    def text(x):
        return pairs_to_text(F.array(F.struct(x["kb"].alias("kb"), F.date_format(x["release_date"], DAY_FORMAT).alias("d"))), "kb", "d")

    out = exposure.recommended_lists(rows, analog.catalog(spark, d), exposure.CatalogCols(),
                                     form=exposure.ListForm(text, ","), every=True)
    return out.select("hostname", "os_line", empty_if_null("last_kb").alias("last_kb"),
                      empty_if_null("rec_kb_arr").alias("rec_kb_text"))


def exposure_full_report(spark: SparkSession, d: str) -> DataFrame:
    rep = exposure.full_report(analog.hosts(spark, d, with_install=True), analog.installed(spark, d),
                               analog.catalog(spark, d, with_label=True), form=exposure.ENTRIES_AS_TEXT)
    return rep.withColumnRenamed("rec_kb_arr", "rec_kb_text")


def exposure_salted_report(spark: SparkSession, d: str) -> DataFrame:
    """The report with small blocks: the line-keyed lookups in many parts, as for a line with most of a large catalog."""
    rep = exposure.full_report(analog.hosts(spark, d, with_install=True), analog.installed(spark, d),
                               analog.catalog(spark, d, with_label=True), block_rows=64,
                               form=exposure.ENTRIES_AS_TEXT)
    return rep.withColumnRenamed("rec_kb_arr", "rec_kb_text")


def newest_label_per_item(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    pairs = li.join(orders, li["l_orderkey"] == orders["o_orderkey"]) \
              .select("l_partkey", month_label("o_orderdate").alias("label"))
    newest = latest_value_per_item(pairs, "l_partkey", "label", "newest_label")
    part = table(spark, d, "part").select("p_partkey")
    return part.join(newest, part["p_partkey"] == newest["l_partkey"], "left") \
               .select("p_partkey", empty_if_null("newest_label").alias("newest_label"))


# ------------------------------------------------------------------- marts
def _orders_of(spark, d, labels):
    o = table(spark, d, "orders")
    return o if labels is None else o.where(in_months("o_orderdate", labels))


def _orders_as_vulnerabilities(spark, d, labels=None):
    return _orders_of(spark, d, labels).select(
        F.col("o_orderkey").alias("id"), month_label("o_orderdate").alias("doc_xml_date"),
        F.concat(F.lit("CVE-"), F.col("o_orderkey").cast("string")).alias("cve"),
        F.col("o_orderpriority").alias("vul_title"), F.col("o_orderstatus").alias("cwe"))


def mart_wide_star(spark: SparkSession, d: str, labels: list[str] | None = None) -> DataFrame:
    """``labels`` restricts the mart to those months (incremental rebuild).

    Rows of two orders differ, as the cve is the order key.  So the whole-row DISTINCT is made before the joins, on
    each side: distinct rows of an order joined to distinct groups of it are distinct, and the wide rows of
    the star are neither hashed nor shuffled."""
    v = _orders_as_vulnerabilities(spark, d, labels)
    li = table(spark, d, "lineitem")
    if labels is not None:
        li = li.join(v.select(F.col("id").alias("l_orderkey")), "l_orderkey", "left_semi")
    status = collect_distinct(li.select(F.col("l_orderkey").alias("id"),
                                        F.col("l_linestatus").alias("status_type"), "l_partkey"),
                              ["id", "status_type"], {"status_product_id": "l_partkey"})
    scores = collect_distinct(li.select(F.col("l_orderkey").alias("id"),
                                        F.col("l_returnflag").alias("base_score"),
                                        F.format_string("%.2f", "l_tax").alias("temporal_score"),
                                        "l_suppkey"),
                              ["id", "base_score", "temporal_score"],
                              {"score_set_product_id": "l_suppkey"})
    o = _orders_of(spark, d, labels).select(month_label("o_orderdate").alias("doc_xml_date"), "o_orderdate")
    docs = (o.groupBy("doc_xml_date")
            .agg(day_text(F.min("o_orderdate")).alias("doc_initial_relise_date"),
                 day_text(F.max("o_orderdate")).alias("doc_current_relise_date")))
    status = status.withColumn("status_product_id", F.array_join("status_product_id", ","))
    scores = scores.withColumn("score_set_product_id", F.array_join("score_set_product_id", ","))
    star = distinct_in_groups(v.repartition("id"), ["id"])
    for child in (status, scores):
        # NULL and '' are one value in the star
        child = distinct_in_groups(filled_with_defaults(child, ["id"]).repartition("id"), ["id"])
        star = left_join_with_defaults(star, child, ["id"])
    star = left_join_with_defaults(star, docs, ["doc_xml_date"])
    return star.select(
        "doc_xml_date", "cve", "vul_title", "cwe", "status_type",
        "status_product_id", "base_score", "temporal_score", "score_set_product_id",
        "doc_initial_relise_date", "doc_current_relise_date")


def mart_revision_right_join(spark: SparkSession, d: str) -> DataFrame:
    rev = table(spark, d, "orders").select(
        F.col("o_custkey").alias("fk"), day_text("o_orderdate").alias("rev_date"),
        F.col("o_totalprice").cast("string").alias("number"),
        F.col("o_orderpriority").alias("rev_description"))
    out = independent_max_match(rev, "fk", "rev_date", "number", ["rev_description"])
    return out.select("fk", "rev_date", F.col("number").cast("double").alias("rev_number"),
                      "rev_description")


def mart_catalog_top_build(spark: SparkSession, d: str, labels: list[str] | None = None) -> DataFrame:
    li = table(spark, d, "lineitem")
    orders = _orders_of(spark, d, labels).select("o_orderkey", "o_orderdate", "o_orderpriority")
    rem = li.join(orders, li["l_orderkey"] == orders["o_orderkey"]).select(
        month_label("o_orderdate").alias("doc_xml_date"),
        F.concat(F.lit("CVE-"), F.col("l_orderkey").cast("string")).alias("cve"),
        F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(F.col("l_suppkey").cast("string")).alias("kb"),
        F.array(F.col("l_partkey").cast("string")).alias("product_id"),
        F.concat(F.lit("10.0."), F.col("l_quantity").cast("int").cast("string")).alias("fixed_build"),
        F.format_string("%.2f", "l_discount").alias("base_score"),
        F.format_string("%.2f", "l_tax").alias("temporal_score"),
        F.col("l_linestatus").alias("cwe"), F.col("o_orderpriority").alias("vul_title"))
    from patchlens.plans.marts import catalog_top_build
    product = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"),
                                             F.col("p_name").alias("product_name"))
    return catalog_top_build(rem, rem, product, carry=("base_score", "temporal_score", "cwe", "vul_title"))


# ------------------------------------------------------------ aggregates
def collect_distinct_1key(spark: SparkSession, d: str) -> DataFrame:
    out = collect_distinct(table(spark, d, "lineitem"), ["l_orderkey"],
                           {"threats_type": "l_returnflag", "treat_description": "l_linestatus"})
    return out.select("l_orderkey", F.array_join("threats_type", ",").alias("threats_type"),
                      F.array_join("treat_description", ",").alias("treat_description"))


def collect_distinct_2key(spark: SparkSession, d: str) -> DataFrame:
    out = collect_distinct(table(spark, d, "lineitem"), ["l_orderkey", "l_linestatus"],
                           {"product_id": "l_partkey"})
    return out.select("l_orderkey", "l_linestatus", F.array_join("product_id", ",").alias("product_id"))


def collect_distinct_3key(spark: SparkSession, d: str) -> DataFrame:
    out = collect_distinct(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag", "l_linestatus"],
                           {"product_id": "l_suppkey"})
    return out.select("l_orderkey", "l_returnflag", "l_linestatus",
                      F.array_join("product_id", ",").alias("product_id"))


def latest_per_key_events(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"]) \
        .select("user_id", "event_type", "event_id", "value")


def argmax_per_group(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    top = top_n_per_group(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()])
    return top.select("o_custkey", "o_orderkey", "o_totalprice", day_text("o_orderdate").alias("order_day"))


# --------------------------------------------------------------- scalars
def normalise_prefix_q(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_name")
    p = p.withColumn("product_line", normalise_prefix("p_name", ANALOG_PREFIX_RULES))
    return p.where(F.col("product_line").isin(ANALOG_ALLOWED_LINES))


def normalise_contains_q(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return p.withColumn("product_line", normalise_contains("p_name", ANALOG_CONTAINS_RULES))


def strip_chars_to_int_q(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return c.select("c_custkey", strip_chars_to_int("c_name", "Customer#").alias("key_from_name"))


def digits_or_empty_q(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events").select("event_id", "event_type", "props")
    return ev.select("event_id",
                     digits_or_empty(F.get_json_object("props", "$.k")).alias("kb"),
                     digits_or_empty("event_type").alias("type_digits"))


def like_anti_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", "p_name").where(~F.col("p_name").like("small%"))


def recent_month_filter(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return o.where(recent_filter("o_orderdate", AS_OF, "month_number")) \
            .select("o_orderkey", day_text("o_orderdate").alias("order_day"))


def recent_month_filter_calendar(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return o.where(recent_filter("o_orderdate", AS_OF, "calendar")) \
            .select("o_orderkey", day_text("o_orderdate").alias("order_day"))


def label_format_parse(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lab = month_label("o_orderdate")
    return o.select("o_orderkey", lab.alias("label"),
                    day_text(parse_month_label(lab)).alias("label_first_day"),
                    day_text("o_orderdate").alias("order_day"),
                    same_month(parse_month_label(lab), "o_orderdate").alias("same_month"))


def epoch_to_ts(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events").select("event_id", "ts")
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    return ev.select("event_id", epoch.alias("epoch"),
                     F.date_format(epoch_to_timestamp(epoch), TS_FORMAT).alias("ts_text"))


def missing_months(spark: SparkSession, d: str) -> DataFrame:
    from patchlens.sources.warehouse import month_spine
    o = table(spark, d, "orders").select("o_orderdate")
    loaded = o.select(month_label("o_orderdate").alias("label")).distinct()
    bounds = o.agg(F.year(F.min("o_orderdate")).alias("y0"), F.year(F.max("o_orderdate")).alias("y1"))
    spine = month_spine(bounds, "y0", "y1")
    return spine.join(loaded, "label", "left_anti").select("label", day_text("month_start").alias("month_start"))


# ------------------------------------------------------------------ arrays
def _line_arrays(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
    arr = F.when(F.col("l_orderkey").isNull(), F.lit(None)).otherwise(
        F.filter(F.array("l_partkey", "l_suppkey"), lambda x: x % 3 != 0))
    return j.select("o_orderkey", "l_linenumber", arr.alias("arr")) \
            .withColumn("arr_size", F.size("arr")) \
            .withColumn("last_item", F.try_element_at("arr", F.lit(-1)))


def explode_inner_q(spark: SparkSession, d: str) -> DataFrame:
    a = _line_arrays(spark, d)
    return a.select("o_orderkey", "l_linenumber", F.posexplode("arr").alias("pos", "item"),
                    "arr_size", "last_item")


def explode_outer_q(spark: SparkSession, d: str) -> DataFrame:
    a = _line_arrays(spark, d)
    return a.select("o_orderkey", "l_linenumber", F.posexplode_outer("arr").alias("pos", "item"),
                    "arr_size", "last_item")


def distinct_codes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_brand").distinct()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "exposure_open_items": exposure_open_items,
    "exposure_recommended_list": exposure_recommended_list,
    "exposure_full_report": exposure_full_report,
    "exposure_salted_report": exposure_salted_report,
    "newest_label_per_item": newest_label_per_item,
    "mart_wide_star": mart_wide_star,
    "mart_revision_right_join": mart_revision_right_join,
    "mart_catalog_top_build": mart_catalog_top_build,
    "collect_distinct_1key": collect_distinct_1key,
    "collect_distinct_2key": collect_distinct_2key,
    "collect_distinct_3key": collect_distinct_3key,
    "latest_per_key": latest_per_key_events,
    "argmax_per_group": argmax_per_group,
    "normalise_prefix": normalise_prefix_q,
    "normalise_contains": normalise_contains_q,
    "strip_chars_to_int": strip_chars_to_int_q,
    "digits_or_empty": digits_or_empty_q,
    "like_anti_filter": like_anti_filter,
    "recent_month_filter": recent_month_filter,
    "recent_month_filter_calendar": recent_month_filter_calendar,
    "label_format_parse": label_format_parse,
    "epoch_to_ts": epoch_to_ts,
    "missing_months": missing_months,
    "explode_inner": explode_inner_q,
    "explode_outer": explode_outer_q,
    "distinct_codes": distinct_codes,
}

