"""Large bulletins read by many tasks.

A document is cut at the closing tags of one element (``Vulnerability``): the text source splits a
file by byte ranges and hands out the text up to each ``Vulnerability>``, whatever range that ends in.
The place of an element in its file is the number of closing tags before it: the
tags of the ranges before (prefix sums over a few rows per file) and those before it in its own range.
From the places follow the position keys, so rows equal those of a document parsed
as a whole, and no task reads a whole file.  What lies outside the elements
(title, tracking, product tree, notes) is put together per file and parsed as the rest of the document.

``Vulnerability>`` inside text or a comment does not end an element; in a CDATA section the whole
closing tag would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens import schemas
from patchlens.sources.xml_bulletins import DELIVERED, PATH, label_from_path, valid_documents

ELEMENT = "Vulnerability"
OPENS = rf"<(?:[\w.-]+:)?{ELEMENT}(?:\s[^>]*)?>"
BLOCK_BITS = 10  # places that are numbered together
XML = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, delivered, start, place, piece, closed, n): the texts between the ends of elements; ``n`` closing tags
    lie before a piece in its file."""
    text = (spark.read.option("lineSep", f"{ELEMENT}>").option("recursiveFileLookup", "true").text(path)
            .select(F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_modification_time").alias(DELIVERED),
                    F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"),
                    F.col("value").alias("_piece")))
    text = text.withColumn("_closed", F.col("_piece").rlike(r"</(?:[\w.-]+:)?$").cast("int"))
    before = Window.partitionBy(PATH).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = text.groupBy(PATH, "_start").agg(F.sum("_closed").alias("_n")).select(  # a row for each byte range
        F.col(PATH).alias("_p"), F.col("_start").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(PATH, "_start").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (text.withColumn("_n", F.coalesce(F.sum("_closed").over(inside), F.lit(0)))
            .join(ranges, (F.col(PATH) == F.col("_p")) & (F.col("_start") == F.col("_s")))
            .withColumn("_n", F.col("_base") + F.col("_n")).drop("_p", "_s", "_base"))


def _elements(pieces: DataFrame) -> DataFrame:
    """(path, delivered, block, n, gap, element): the n-th element of a file and the text before it."""
    whole = (pieces.withColumn("_block", F.shiftright("_n", BLOCK_BITS)).repartition(PATH, "_block")
             .groupBy(PATH, "_block", "_n").agg(
                 F.first(DELIVERED).alias(DELIVERED), F.max("_closed").alias("_closed"),
                 F.array_sort(F.collect_list(F.struct("_start", "_at", "_piece"))).alias("_pieces")))  # one but for odd texts
    # the last piece of a file has lost no tag; others have lost what they were cut at
    text = F.concat(F.array_join(F.transform("_pieces", lambda p: p["_piece"]), f"{ELEMENT}>"),
                    F.when(F.col("_closed") == 1, f"{ELEMENT}>").otherwise(""))
    whole = whole.withColumn("_text", text)
    opened = F.when(F.col("_closed") == 1, F.regexp_instr("_text", F.lit(f"(?s){OPENS}"))).otherwise(0)
    return whole.withColumn("_opened", opened).select(
        PATH, DELIVERED, "_block", "_n",
        F.expr("if(_opened = 0, _text, substring(_text, 1, _opened - 1))").alias("_gap"),
        F.expr("if(_opened = 0, null, substring(_text, _opened))").alias("_element"))


def _has_ordinal(text: Column) -> Column:
    return F.regexp_extract(text, f"(?s){OPENS}", 0).rlike(r"\sOrdinal\s*=")


def read_split_bulletins(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(documents without their vulnerabilities, (doc_xml_date, id, v) of all vulnerabilities with an Ordinal)."""
    label = label_from_path(F.col(PATH)).alias("doc_xml_date")
    pieces = _pieces(spark, path)
    elements = _elements(pieces)

    # position keys: elements with an Ordinal before this one, by blocks of places
    numbered = elements.where(F.col("_element").isNotNull()).withColumn("_has", _has_ordinal(F.col("_element")).cast("int"))
    blocks = numbered.groupBy(PATH, "_block").agg(F.sum("_has").alias("_has"))
    earlier = Window.partitionBy(PATH).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select(F.col(PATH).alias("_p"), F.col("_block").alias("_b"),
                         F.coalesce(F.sum("_has").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(PATH, "_block").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    keyed = (numbered.withColumn("_id", F.coalesce(F.sum("_has").over(inside), F.lit(0))).where("_has = 1")
             .join(base, (F.col(PATH) == F.col("_p")) & (F.col("_block") == F.col("_b"))))
    vulnerabilities = keyed.select(label, (F.col("_base") + F.col("_id")).cast("long").alias("id"),
                                   F.from_xml("_element", schemas.VULNERABILITY, XML).alias("v"))

    gaps = elements.where(F.trim(F.col("_gap"), F.lit(" \t\r\n")) != "").groupBy(PATH).agg(
        F.first(DELIVERED).alias(DELIVERED), F.array_sort(F.collect_list(F.struct("_n", "_gap"))).alias("_gaps"))
    rest = F.array_join(F.transform("_gaps", lambda g: g["_gap"]), "")
    docs = gaps.select(label, PATH, DELIVERED, F.from_xml(rest, schemas.document_type(), XML).alias("_d"))
    return docs.select("doc_xml_date", PATH, DELIVERED, "_d.*"), vulnerabilities


def split_shred(spark: SparkSession, path: str | list[str]) -> dict[str, DataFrame]:
    """Every staging table of the bulletins under ``path``, read by byte ranges."""
    from patchlens.plans.shred import shred

    docs, vulnerabilities = read_split_bulletins(spark, path)
    return shred(valid_documents(docs), vulnerabilities)
