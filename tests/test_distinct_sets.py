"""Distinct values kept month by month equal a full distinct after new, late, corrected and emptied months."""

import pytest

from patchlens.streaming import distinct_sets as ds


def held(spark, path):
    return {r.value: r.months for r in ds.months_by_value(spark, path).collect()}


def full(months):
    out = {}
    for values in months.values():
        for v in set(values) - {None}:
            out[v] = out.get(v, 0) + 1
    return out


def put(spark, path, number, delivered, months, named=()):
    months.update({m: [] for m in named})
    months.update(delivered)
    rows = [(m, v) for m, vs in delivered.items() for v in vs] + [(None, "lost")]
    ds.update(spark, path, spark.createDataFrame(rows, "m string, v string"), "m", "v", number, named)


def test_updates_equal_the_full_distinct(spark, scratch):
    path, months = f"{scratch}/t", {}
    with pytest.raises(FileNotFoundError):
        ds.months_by_value(spark, path)
    put(spark, path, 0, {"2024-Feb": ["a", "a", "b", None], "2024-Mar": ["b", "c"]}, months)
    assert held(spark, path) == full(months) == {"a": 1, "b": 2, "c": 1}
    put(spark, path, 1, {"2024-Jan": ["a", "d"]}, months)  # late
    put(spark, path, 2, {"2024-Mar": ["c", "e"]}, months)  # corrected
    assert held(spark, path) == full(months)
    ds.compact(spark, path)
    assert held(spark, path) == full(months)
    put(spark, path, 3, {}, months, ["2024-Feb"])  # emptied
    assert held(spark, path) == full(months) == {"a": 1, "c": 1, "d": 1, "e": 1}
    put(spark, path, 3, {}, months, ["2024-Feb"])  # the same update again
    assert held(spark, path) == full(months)
    put(spark, path, 4, {"2024-Feb": ["z"]}, months)
    ds.compact(spark, path)
    assert held(spark, path) == full(months)


def test_an_update_reads_its_months_only(spark, scratch):
    path, months = f"{scratch}/t", {}
    put(spark, path, 0, {f"2024-{m}": ["a"] for m in ("Jan", "Feb", "Mar")}, months)
    put(spark, path, 1, {"2024-Feb": ["b"]}, months)
    assert ds._last_states(spark, path, ["2024-Feb", "2024-Apr"], 2) == [f"{path}/states/_update=1/month=2024-Feb"]
    assert ds._last_states(spark, path, ["2024-Feb"], 1) == [f"{path}/states/_update=0/month=2024-Feb"]
