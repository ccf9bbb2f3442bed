"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from support import SF_SMALL
from patchlens.tables import TABLES

KEYS = sorted(E.oracle_sql())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v) if not isinstance(v, (int, bool)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    from patchlens.registry import all_oracles, all_queries
    assert set(all_oracles()) == set(all_queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hostname", "os_line", "last_kb", "cve"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    srows = sorted((tuple(_norm(r[c]) for c in sorted(sdf.columns)) for r in sdf.collect()), key=repr)
    idx = [dcols.index(c) for c in sorted(sdf.columns)]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert len(srows) == len(drows)
    assert srows == drows
