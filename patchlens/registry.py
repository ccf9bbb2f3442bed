"""All registered queries and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _in_utc(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Bulletin times are zone-less wall-clock times; the package computes in
    UTC (epoch seconds, day text).  A caller's session in another zone stays as
    it is: the query is built in a new session beside it."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            folder = spark.conf.get("spark.checkpoint.dir", None)
            spark = spark.newSession()
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            if folder:
                spark.conf.set("spark.checkpoint.dir", folder)
        return fn(spark, sf_dir)
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from patchlens import (queries, queries_bulletins, queries_catalog, queries_hosts, queries_io, queries_loads,
                           queries_xml)
    out = {**queries.QUERIES, **queries_hosts.QUERIES, **queries_bulletins.QUERIES, **queries_loads.QUERIES}
    out.update(queries_catalog.QUERIES)
    out.update(queries_xml.QUERIES)
    out.update(queries_io.QUERIES)
    return {k: _in_utc(v) for k, v in out.items()}


def all_oracles() -> dict[str, str]:
    from patchlens.oracles import ORACLES
    from patchlens import queries_bulletins, queries_catalog, queries_hosts, queries_loads
    return {**ORACLES, **queries_hosts.SQL, **queries_bulletins.SQL, **queries_loads.SQL, **queries_catalog.SQL}
