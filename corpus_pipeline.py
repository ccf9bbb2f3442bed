"""The training-data pipeline over ``documents``: five stages, each on all its predecessor kept.

1. ``language``: documents without a letter, whose language is no clearer than ``MIN_SCORE`` or, a word,
   ``MIN_MARGIN``, or of whose words the model knows less than ``MIN_KNOWN``, go.
2. ``near_duplicates``: one document of each SimHash group stays, the one with the smallest doc_id.
3. ``decontamination``: documents that hold or quote a benchmark item, re-parameterised or not, go.
4. ``secrets``: reported spans become a mark; every document stays, and n_chars follows the text.
5. ``packing``: token ids in sequences of 2048, one row per piece, ids included.

All stages but the last return the columns of their input.  A stage's rows
are written to the shared checkpoint folder and reread by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table, tokenizer_path
from patchlens.llm.language_id import hash_remainder, identify_languages
from patchlens.llm.packing import pack_documents
from patchlens.llm.secret_links import redact_secrets
from patchlens.llm.simhash_golay import keep_one_of_each
from patchlens.llm.template_leaks import drop_leaks

MIN_SCORE = 0.5
#: other scripts have 0 known, random letters and Polish about 0.1, the labelled languages 0.88 and more (check_s)
MIN_KNOWN = 0.25
MIN_MARGIN = 0.01
#: tokens of a benchmark item in a row that make a leak
QUOTE = 13


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    read = ("doc_id", "text", "lang")
    others = [c for c in docs.columns if c not in read]
    packed = docs.select(*read, F.struct(*(others or [F.lit(0).alias("_")])).alias("_others"))
    found = identify_languages(packed, hash_remainder("doc_id", 3) == 1, evidence=True)
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)
                        & (F.col("known") >= MIN_KNOWN) & (F.col("margin") >= MIN_MARGIN))
    return kept.select(*[c if c in read else F.col("_others")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"), run=QUOTE)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the executors come here with a heap that the stages before have filled
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), slice_bytes=4 << 20)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]
#: language identification, SimHash and packing have no SQL; the tests hold run() against a plain version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
