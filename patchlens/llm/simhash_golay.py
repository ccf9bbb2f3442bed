"""Operator 7: SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprint: the text's words in lower-case ASCII, ``shingle`` words a
shingle, XXH64 of each, repeats included; a bit is 1 if it is set in over
half of the hashes.

Candidates: 64 bits are cut into three segments.  Fingerprints at two or
fewer differing bits agree wholly in at least one segment (pigeonhole), and
in every other segment they differ in at most two bits.  The binary Golay code
of length 23 is perfect: each word decodes to one codeword.  A segment's keys
are the codeword indices of the word and of all words one bit away, six
at most; two words at distance two have a word in the middle, so they share
a key.  A fingerprint is filed under (exact segment, a Golay key of the next
segment), eighteen keys at most, and fingerprints that share a key are
joined and verified by their bit distance.

Only distinct fingerprints are joined.  A key under which more than
``bucket`` fingerprints meet (a large group of near copies) is not paired:
each of its fingerprints is filed under itself and its 64 one-bit neighbours.
Those that meet there are within two bits of each other, 65 at most, and are
linked as a star, so no link is lost and rows stay in proportion.

Defined cases: null and empty text have fingerprint zero, linked like any
other; fewer words than a shingle hash as one sequence; repeated rows keep
their own rows; rows without doc_id take part but name no component (a group
with no doc_id at all has a null component_id); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table, whole_text
from patchlens.llm.components import components

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    import xxhash

    words = b" ".join(text.lower().split())
    if not words:
        return 0
    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.append(blanks, len(words))
    n = max(1, len(starts) - shingle + 1)
    to = ends[shingle - 1:] if len(ends) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(words[a:b], SEED) for a, b in zip(starts[:n].tolist(), to.tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = hashes[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


@functools.cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """(remainder of the upper twelve bits, error pattern by syndrome)."""
    upper = np.zeros(1 << 12, np.int64)
    for word in range(1 << 12):
        r = word << 11
        for bit in range(22, 10, -1):
            if r >> bit & 1:
                r ^= GENERATOR << (bit - 11)
        upper[word] = r
    pattern = np.zeros(1 << 11, np.int64)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            pattern[upper[e >> 11] ^ (e & 0x7FF)] = e
    return upper, pattern


def decode(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    upper, pattern = _golay()
    return (words ^ pattern[upper[words >> 11] ^ (words & 0x7FF)]) >> 11


def segment_keys(words: np.ndarray, width: int) -> np.ndarray:
    """Rows of codeword indices, -1 where one repeats."""
    flips = np.concatenate([[0], 1 << np.arange(width)])
    found = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def _file_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint64)
        parts = [((values >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
        for i in range(3):
            j = (i + 1) % 3
            keys = segment_keys(parts[j], SEGMENTS[j][1])
            row, col = np.nonzero(keys >= 0)
            key = (i << 34) | (parts[i][row] << 12) | keys[row, col]
            yield pa.RecordBatch.from_arrays([pa.array(values[row].view(np.int64)), pa.array(key)], ["fp", "key"])


def simhash_links(prints: DataFrame, bucket: int = 64) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``prints`` (fp) whose union joins all
    fingerprints at two or fewer differing bits."""
    filed = prints.select("fp").mapInArrow(_file_keys, "fp long, key long")
    met = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(filed.join(met, "key"), "simhash-keys")
    few = shared.filter(F.col("n") <= bucket).select("key", "fp")
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key")
             .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
             .select("a", "b").distinct())
    many = shared.filter(F.col("n") > bucket).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(np.int64(np.uint64(1 << b)).item()) for b in range(64)])
    stars = (many.select("fp", F.explode(flips).alias("flip"))
             .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
             .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)  # 65 at most
             .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a != b").distinct())
    return pairs.union(stars)


def simhash_groups(docs: DataFrame, *, shingle: int = 3, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """(doc_id, text_hash, fingerprint, group, component_id) of every row of ``docs`` (doc_id, text);
    ``group`` is the smallest fingerprint of the component and ``text_hash`` tells rows of one doc_id apart."""
    if max_bits != 2:
        raise ValueError("the Golay keys cover two differing bits")

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(values, np.uint64).view(np.int64))],
                ["doc_id", "text_hash", "fp"])

    rows = stored(docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                              whole_text().cast("binary").alias("text"))
                  .mapInArrow(prints, "doc_id long, text_hash long, fp long"), "simhash-rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    joined = components(simhash_links(distinct, bucket))
    grouped = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group"))
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = grouped.select("fp", "group").join(least, "group")
    return rows.join(named, "fp").select("doc_id", "text_hash", _hex("fp").alias("fingerprint"),
                                         _hex("group").alias("group"), "component_id")


def _hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one_of_each(docs: DataFrame, *, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest doc_id (of
    several rows with that doc_id, the one with the smallest text hash; of repeated rows, one).
    A group without any doc_id keeps one of its rows too."""
    groups = simhash_groups(docs, shingle=shingle, max_bits=max_bits)
    chosen = (groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
              .groupBy("group").agg(F.min(F.struct("text_hash", "doc_id")).alias("best"))
              .select(F.col("best.text_hash").alias("_hash"),
                      F.col("best.doc_id").alias("_id")))
    both = ("_hash", "_key")
    key = F.coalesce(F.col("_id"), F.lit(0)) * 2 + F.col("_id").isNull().cast("int")
    keyed = docs.withColumn("_id", F.col("doc_id")).withColumn("_hash", F.xxhash64("text")).withColumn("_key", key)
    wanted = chosen.withColumn("_key", key).select(*both)
    return keyed.join(wanted, list(both), "left_semi").dropDuplicates(list(both)).select(*docs.columns)


def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2).select(
        "doc_id", "fingerprint", "component_id")
