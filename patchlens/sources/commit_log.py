"""Numbers and commits that writers at the same time cannot take twice.

A log is a folder of numbered files, each made whole under another name and then put in its
place only if that is free: by a hard link on a local file system, elsewhere by a rename,
which does not replace a file on HDFS and its like (an object store without such a
rename needs its conditional writes).  A commit says which number it follows; if another
writer took that number first it fails, and the writer looks at the log again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` as the file ``path``, unless there is one; False if there was."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(part.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return not fs.exists(target) and fs.rename(part, target)
    finally:
        if fs.exists(part):
            fs.delete(part, False)


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers taken in a log, ascending."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n[:1].isdigit())


def _file(folder: str, number: int) -> str:
    return os.path.join(folder, f"{number:010d}.json")


def reserve(spark: SparkSession, folder: str) -> int:
    """A number that no other writer has or will get."""
    taken = numbers(spark, folder)
    number = taken[-1] + 1 if taken else 1
    while not put_if_absent(spark, _file(folder, number), "{}\n"):
        number += 1
    return number


def commit(spark: SparkSession, folder: str, number: int, rows: Sequence[dict]) -> bool:
    """Add ``rows`` as commit ``number``; False if that number is taken."""
    return put_if_absent(spark, _file(folder, number), "".join(json.dumps(r) + "\n" for r in rows))


def read(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of all commits."""
    if not numbers(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)
