"""Warehouse tables of the session catalog: made by DDL, with column defaults, partitioned by load and
bucketed by the vulnerability they belong to.

Every table that carries a vulnerability key is ``CLUSTERED BY (doc_xml_date, key)`` into the same number
of buckets and sorted by it, so the joins and groupings of the six-child star find their rows where they
lie: no exchange below the last DISTINCT.  A load shuffles each table once, when it writes it.

A load writes through a table of its own over the folder of its partition (two loads at once share no
commit folder), then drops that table, which keeps the files, and adds the partition.  A column that
the rows do not have takes the DEFAULT of the DDL: the type's default, '' for titles, and the load's as-of
time for ``timestamp``.  Which load of a month counts is told by the log, as for plain folders; a partition
without a commit is not read.

``buckets`` is fixed when a root is made, for the size its largest table will have (about 256 MB of a
full backfill per bucket); readers use one task per bucket and table.  A root is written either
through the catalog or as plain folders: files without bucket numbers cannot be read as buckets.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens.sources.warehouse import path_exists

DOC, LOAD_ID = "doc_xml_date", "load_id"
MAX_BROADCAST_LOADS = 100_000  # rows (month, load); a month has one, so a warehouse has twelve a year


def sql_default(dt: T.DataType) -> str | None:
    """The SQL literal that a column of this type takes when an insert leaves it out."""
    if isinstance(dt, T.StringType):
        return "''"
    if isinstance(dt, T.NumericType):
        return f"CAST(0 AS {dt.simpleString()})"
    if isinstance(dt, T.ArrayType):
        return f"CAST(array() AS {dt.simpleString()})"
    if isinstance(dt, T.TimestampType):
        return "timestamp'1970-01-01 00:00:00'"
    return None


def column_ddl(schema: T.StructType, defaults: Mapping[str, str]) -> str:
    """Columns with their defaults: of ``defaults``, else the type's for a column that is never null."""
    out = []
    for f in schema.fields:
        value = defaults.get(f.name) or (None if f.nullable else sql_default(f.dataType))
        out.append(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {value}" if value else ""))
    return ", ".join(out)


class CatalogTables:
    """The tables ``schemas`` (name -> schema) as tables of ``database``, their files under ``root``."""

    def __init__(self, spark: SparkSession, database: str, root: str, schemas: Mapping[str, T.StructType],
                 buckets: int = 64, key: Sequence[str] = ("vulnerability_fk",), key_tables: Sequence[str] = ("vulnerability",),
                 sort: Mapping[str, Sequence[str]] | None = None):
        self.spark, self.database, self.root, self.schemas, self.buckets = spark, database, root, schemas, buckets
        self.sort = dict(sort or {})
        self.keys = {}
        for name, schema in schemas.items():
            own = [k for k in key if k in schema.fieldNames()] or (["id"] if name in key_tables else [])
            self.keys[name] = [DOC, *own] if own else []

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def _clustered(self, name: str) -> str:
        cols = ", ".join(self.keys[name])
        return f"CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {self.buckets} BUCKETS" if cols else ""

    def create(self) -> None:
        """The database and its tables, where they are not; partitions of an earlier session are found again."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}'")
        for name, schema in self.schemas.items():
            if self.spark.catalog.tableExists(f"{self.database}.{name}"):
                continue
            titles = {f.name: "''" for f in schema.fields if f.name == "title"}
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name(name)} ({column_ddl(schema, titles)}, {LOAD_ID} BIGINT) USING parquet "
                f"PARTITIONED BY ({LOAD_ID}) {self._clustered(name)} LOCATION '{os.path.join(self.root, name)}'")
            if path_exists(self.spark, os.path.join(self.root, name)):
                self.spark.sql(f"ALTER TABLE {self._name(name)} RECOVER PARTITIONS")

    def write(self, name: str, rows: DataFrame, load_id: int, as_of: _dt.datetime | str) -> None:
        """Replace the load's partition of a table by ``rows``; columns they lack take their defaults."""
        schema, keys = self.schemas[name], self.keys[name]
        cols = [c for c in schema.fieldNames() if c in rows.columns]
        folder = os.path.join(self.root, name, f"{LOAD_ID}={load_id}")
        own, view = f"{name}__load_{load_id}", f"rows_{uuid.uuid4().hex}"
        as_of = self.spark.range(1).select(F.lit(as_of).cast("timestamp").cast("string")).first()[0]
        defaults = {f.name: "''" if f.name == "title" else f"timestamp'{as_of}'" for f in schema.fields
                    if f.name in ("title", "timestamp")}
        # one task a bucket, one file a bucket; the write sorts within it
        rows = rows.repartition(self.buckets, *keys) if keys else rows.hint("rebalance", DOC).sortWithinPartitions(
            DOC, *self.sort.get(name, ()))
        rows.select(*cols).createOrReplaceTempView(view)
        names = ", ".join(f"`{c}`" for c in cols)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._name(own)} ({column_ddl(schema, defaults)}) USING parquet "
                       f"{self._clustered(name)} LOCATION '{folder}'")
        try:
            self.spark.sql(f"INSERT OVERWRITE {self._name(own)} ({names}) SELECT {names} FROM {view}")
        finally:
            self.spark.sql(f"DROP TABLE {self._name(own)}")  # the files stay: it has a location
            self.spark.catalog.dropTempView(view)
        self.spark.sql(f"ALTER TABLE {self._name(name)} ADD IF NOT EXISTS PARTITION ({LOAD_ID}={load_id}) LOCATION '{folder}'")
        self.spark.catalog.refreshTable(f"{self.database}.{name}")

    def read(self, name: str, loads: DataFrame) -> DataFrame:
        """The rows of ``loads`` (month, load), as they lie in their buckets.  The loads are counted, and sent to
        the buckets up to a bound."""
        wanted = loads.select(DOC, LOAD_ID)
        if wanted.count() <= MAX_BROADCAST_LOADS:
            wanted = F.broadcast(wanted)
        stored = self.spark.table(f"{self.database}.{name}")
        return stored.join(wanted, [DOC, LOAD_ID], "left_semi").select(*self.schemas[name].fieldNames())
