"""Keep-latest tables in key-range parts: only touched parts are rewritten and merged."""

import pytest

from patchlens.streaming import key_parts as kp
from patchlens.streaming.incremental import VERSION_COL, read_latest
from test_plans import plan

KEYS, ORDER = ["k", "name"], ["at"]
SCHEMA = "k long, name string, at long, value string"


def put(spark, path, number, rows):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    df.write.mode("overwrite").parquet(f"{path}/log/{VERSION_COL}={number}")


def both(spark, path):
    got = sorted(map(repr, kp.read_parts(spark, path, KEYS, ORDER).select("k", "name", "at", "value").collect()))
    assert got == sorted(map(repr, read_latest(spark, path, KEYS, ORDER).select("k", "name", "at", "value").collect()))
    return got


def compact(spark, path):
    return kp.compact_parts(spark, path, KEYS, ORDER, rows_per_part=500)


def test_parts_equal_the_log(spark, scratch):
    path = f"{scratch}/t"
    with pytest.raises(FileNotFoundError):
        kp.read_parts(spark, path, KEYS, ORDER)
    put(spark, path, 0, spark.range(5000).selectExpr("id AS k", "concat('n', id % 3) AS name", "10L AS at", "'first' AS value"))
    both(spark, path)
    assert compact(spark, path) and not compact(spark, path)  # nothing is left to merge
    first = kp.manifest(spark, path)
    assert len(first) == 10 and sum(p["n"] for p in first) == 5000
    both(spark, path)
    # updates, an older row, a tie (the later batch wins), keys below and above all, a null key
    late = [(2600, "n2", 11, "new"), (2601, "n0", 9, "older"), (2602, "n1", 10, "tie"), (-5, "x", 1, "below"), (9999, "x", 1, "above"),
            (None, None, 1, "null"), (2603, "other", 1, "another name")]
    put(spark, path, 1, late)
    rows = "\n".join(both(spark, path))
    assert all(f"value='{v}'" in rows for v in ("new", "tie", "below", "above", "null", "another name")) and "older" not in rows
    assert compact(spark, path)
    second = kp.manifest(spark, path)
    kept = {p["file"] for p in first} & {p["file"] for p in second}
    assert len(kept) >= 6 and sum(p["n"] for p in second) == 5004  # only parts with late rows were written again
    assert both(spark, path) and [p["upto"] for p in second] == [1] * len(second)
    put(spark, path, 2, [(None, None, 2, "null again"), (None, "n", 1, "half null")])
    compact(spark, path)
    assert sum(p["n"] for p in kp.manifest(spark, path)) == 5005 and both(spark, path)


def test_a_hot_range_is_split(spark, scratch):
    path = f"{scratch}/t"
    put(spark, path, 0, spark.range(1000).selectExpr("id * 1000 AS k", "'a' AS name", "1L AS at", "'x' AS value"))
    compact(spark, path)
    put(spark, path, 1, spark.range(3000).selectExpr("500000 + id AS k", "'a' AS name", "2L AS at", "'y' AS value"))
    compact(spark, path)
    parts = kp.manifest(spark, path)
    assert len(parts) > 4 and max(p["n"] for p in parts) < 1500 and sum(p["n"] for p in parts) == 3997
    spans = [(p["least"], p["greatest"]) for p in parts]
    ks = [tuple(int(x.split('"k":')[1].split(",")[0]) for x in s) for s in spans]
    assert all(a[1] < b[0] for a, b in zip(ks, ks[1:]))  # in order, without overlap
    both(spark, path)


def test_untouched_parts_are_not_ranked(spark, scratch):
    path = f"{scratch}/t"
    put(spark, path, 0, spark.range(4000).selectExpr("id AS k", "'a' AS name", "1L AS at", "'x' AS value"))
    compact(spark, path)
    put(spark, path, 1, [(7, "a", 2, "y")])
    p = plan(kp.read_parts(spark, path, KEYS, ORDER))
    tree = p[:p.index("(1) ")]
    assert tree.index("Union") < tree.index("Scan parquet") < tree.index("Window")
    first = tree[tree.index("Union"):].splitlines()
    assert "Scan parquet" in "\n".join(first[:4])  # the first branch is files as they lie


def test_empty_batches(spark, scratch):
    path = f"{scratch}/t"
    put(spark, path, 0, [])
    assert not compact(spark, path) and both(spark, path) == []
    put(spark, path, 1, [(1, "a", 1, "x")])
    assert compact(spark, path)
    put(spark, path, 2, [])
    assert not compact(spark, path) and len(both(spark, path)) == 1
    assert kp.read_parts(spark, path, KEYS, ORDER).columns == ["k", "name", "at", "value"]


def test_two_compactions_at_once(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    put(spark, path, 0, [(1, "a", 1, "x")])
    compact(spark, path)
    put(spark, path, 1, [(2, "a", 1, "y")])
    real, seen = kp.commit_log.commit, []

    def between(spark_, folder, number, rows):
        if not seen:
            seen.append(number)
            assert compact(spark, path)
        return real(spark_, folder, number, rows)

    monkeypatch.setattr(kp.commit_log, "commit", between)
    assert not compact(spark, path)
    assert len(both(spark, path)) == 2


def test_part_of_finds_every_place(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    key = T.StructType([T.StructField("k", T.LongType())])
    for n in (1, 2, 3, 10, 17):
        least = [f'{{"k":{10 * i}}}' for i in range(n)]
        got = spark.range(-15, 10 * n + 15).select("id", kp.part_of(F.struct(F.col("id").alias("k")), least, key).alias("p")).collect()
        assert all(r.p == min(max(r.id // 10, 0), n - 1) for r in got)
