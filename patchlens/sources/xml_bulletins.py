"""Monthly bulletin documents: one XML file per month in a landing folder,
named ``{YYYY}-{Mon}.xml``, or written by Spark into a folder whose name ends
with the label (``.../2024-Jan/part-...``); the month label comes from there.

A missing month is simply a missing file.  A corrected month is delivered as
a new file of the same name in another sub-folder (or rewritten in place,
which a backfill sees by its time; a stream reads a path once).  The whole
folder, sub-folders included, is read in one scan, one row per document;
malformed files give a row whose fields are NULL and whose ``_corrupt_record``
holds the text, so one bad month never fails the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens import schemas

LABEL_RE = r"(\d{4}-[A-Z][a-z]{2})(?:\.xml|/part-[^/]*)$"
PATH, DELIVERED, TEXT = "_path", "_delivered", "_xml"
XML_OPTIONS = {"rowTag": "cvrfdoc", "ignoreNamespace": "true", "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": schemas.CORRUPT, "recursiveFileLookup": "true"}


def label_from_path(path: Column) -> Column:
    return F.regexp_extract(path, LABEL_RE, 1)


def read_bulletins(spark: SparkSession, path: str | list[str],
                   schema: T.StructType = schemas.DOCUMENT) -> DataFrame:
    """All bulletins under ``path`` (folders, globs or files), with ``doc_xml_date``, path and delivery time."""
    df = spark.read.format("xml").options(**XML_OPTIONS).schema(schema).load(path)
    return with_label(df)


def with_label(df: DataFrame) -> DataFrame:
    return (df.withColumn(PATH, F.col("_metadata.file_path"))
            .withColumn(DELIVERED, F.col("_metadata.file_modification_time"))
            .withColumn("doc_xml_date", label_from_path(F.col(PATH))))


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_xml_date, path, delivered) of every landed file; a listing, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(label_from_path(F.col("path")).alias("doc_xml_date"), "path",
                        F.col("modificationTime").alias("delivered"))


def bulletin_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(doc_xml_date, _xml) of whole files."""
    whole = spark.read.option("wholetext", "true").text(paths)
    return whole.select(label_from_path(F.col("_metadata.file_path")).alias("doc_xml_date"), F.col("value").alias(TEXT))


def parse_bulletin_text(df: DataFrame, xml_col: str, label_col: str,
                        schema: T.StructType = schemas.DOCUMENT) -> DataFrame:
    """Documents held as text in a column (e.g. a table of raw documents); ``_xml`` keeps the text."""
    parsed = F.from_xml(F.col(xml_col), schema, {"ignoreNamespace": "true", "mode": "PERMISSIVE",
                                                 "columnNameOfCorruptRecord": schemas.CORRUPT})
    return (df.select(F.col(label_col).alias("doc_xml_date"), F.col(xml_col).alias(TEXT), parsed.alias("_d"))
            .select("doc_xml_date", "_d.*", TEXT))


def valid_documents(docs: DataFrame) -> DataFrame:
    return docs.where(F.col(schemas.CORRUPT).isNull() & (F.col("doc_xml_date") != ""))


def corrupt_documents(docs: DataFrame) -> DataFrame:
    # Spark refuses a scan that reads only the corrupt-record column, so a
    # parsed field is carried along
    return docs.where(F.col(schemas.CORRUPT).isNotNull()) \
               .select("doc_xml_date", "DocumentTitle", schemas.CORRUPT)
