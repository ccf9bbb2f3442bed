"""Operator 11: repeated passages by relative Lempel-Ziv parsing against reference blocks.

The documents, in order of doc_id, are cut into reference blocks of about ``block_bytes``
of text, kept as a table bucketed by block, so that every later pass reads a block's
texts in one task without shuffling them.  A block's index lists its phrases, the runs
of ``window`` words, by a 96-bit fingerprint with the first place of each.

A document is parsed against every indexed block at once: the indexes are dealt out by
fingerprint, and each block is told, for each of its own phrases, the first place that
holds it in any earlier block.  From these places, and from earlier places of its own,
a document is factored greedily: a factor is copied from one place for as long as the
text goes on there, so only factors of ``window`` words and more arise.  Where a factor ends, the phrases
that straddle its boundary have places of their own and begin the next factor, which may overlap.
The words under the factors are the duplicate spans.

Most phrases need not be looked up: every phrase holds one seed, the ``seed`` words of least
hash in it, and equal phrases hold equal seeds.  Seeds, one in six words, are dealt out
first, and only phrases whose seed occurs again in the corpus are indexed.  Indexes
travel as packed rows per (block, range of fingerprints) and answers as bits in the order of the question.

Hot cases: a passage in a third of all documents is one index entry per block; a doc_id or
text with a third of all rows is cut over blocks by a row number.

Defined cases: a null text has no words; null doc_ids come first, rows of one doc_id
follow each other by a hash of their text and count as documents of their own (which of two
equal rows comes first makes no difference to the rows returned); texts are never cut, a
document of any length lies in one block; fewer than ``window`` words are never removed;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import scratch_folder, stored, table

WINDOW, SEED = 20, 8
SLICE = 2 << 20
ENTRY = "bucket int, block int, entries binary"
ANSWER = "block int, bucket int, kind int, flags binary, places binary"
RESULT = ("doc_id long, n_words long, n_removed long, kept string, "
          "factors array<struct<start: long, length: long, block: long, place: long>>")
RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
    ("factors", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "block", "place")])))])
#: odd multipliers of the rolling hashes
P_BYTE, P_SEED, P_ONE, P_TWO = (np.uint64(v) for v in (
    0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * P_BYTE)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers, or more, of the byte multiplier and of its inverse modulo 2^64."""
    size = max(n, SLICE)
    made = _POWERS.get(size)
    if made is None:
        inverse = np.uint64(pow(int(P_BYTE), -1, 1 << 64))
        made = tuple(np.concatenate([[np.uint64(1)], np.full(size, p, np.uint64)]).cumprod(dtype=np.uint64)
                     for p in (P_BYTE, inverse))
        if size == SLICE:  # only a word longer than a slice needs more, and that is not kept
            _POWERS[size] = made
    return made


class Words:
    """The words of a block's texts: hash and byte range of each, and the documents' places."""

    def __init__(self, texts: pa.ChunkedArray):
        column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        column = column.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        self.offsets = offsets - offsets[0]
        buffer = column.buffers()[2]
        self.data = (np.frombuffer(buffer, np.uint8)[offsets[0]:offsets[-1]] if buffer is not None
                     else np.empty(0, np.uint8))
        edge = np.zeros(len(self.data) + 1, bool)  # a document begins here
        edge[self.offsets] = True
        space = SPACE[self.data]
        parts, at = [], 0
        while at < len(self.data):
            to = min(at + SLICE, len(self.data))
            if to < len(self.data):  # end after a separator or a document
                cuts = np.flatnonzero(space[at:to] | edge[at + 1:to + 1])
                if not len(cuts):
                    cuts = np.flatnonzero(space[at:] | edge[at + 1:])[:1]
                to = at + int(cuts[-1]) + 1
            parts.append(self._slice(space[at:to], edge[at:to + 1], at, to))
            at = to
        self.starts, self.ends, self.hashes = (
            np.concatenate(v) for v in zip(*parts)) if parts else (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
        self.firsts = np.searchsorted(self.starts, self.offsets)  # of each document, and the end
        self.doc = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.firsts))

    def _slice(self, space: np.ndarray, edge: np.ndarray, at: int, to: int):
        word = ~space
        s = np.flatnonzero(word & (np.concatenate([[True], space[:-1]]) | edge[:-1]))
        e = np.flatnonzero(word & (np.concatenate([space[1:], [True]]) | edge[1:])) + 1
        up, down = powers(to - at)
        sums = np.concatenate([[np.uint64(0)], (BYTE[self.data[at:to]] * up[:to - at]).cumsum(dtype=np.uint64)])
        h = (sums[e] - sums[s]) * down[s]
        return s + at, e + at, mix(h + (e - s).astype(np.uint64) * P_SEED)


def rolled(h: np.ndarray, k: int, p: np.uint64) -> np.ndarray:
    """A hash of every ``k`` values in a row."""
    n = len(h) - k + 1
    out = h[:n].copy()
    for j in range(1, k):
        out *= p
        out += h[j:n + j]
    return mix(out)


class Phrases:
    """Every run of ``WINDOW`` words inside a document, and the seed it holds."""

    def __init__(self, words: Words, buckets: int):
        h, self.buckets, width = words.hashes, buckets, WINDOW - SEED + 1
        n = len(h) - WINDOW + 1
        if n <= 0:
            self.at = np.empty(0, np.int64)
            self.seed_of = np.empty(0, np.int64)
            self.seeds, self.seed_counts = np.empty(0, np.uint64), np.empty(0, np.int64)
            return
        whole = words.doc[:n] == words.doc[WINDOW - 1:]
        grams = rolled(h, SEED, P_SEED)
        least = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
        self.at = np.flatnonzero(whole)
        places = least[self.at] + self.at
        seed_places, inverse = np.unique(places, return_inverse=True)
        self.seeds, which, self.seed_counts = np.unique(grams[seed_places], return_inverse=True, return_counts=True)
        self.seed_of = which[inverse]

    def index(self, words: Words, again: np.ndarray) -> None:
        """The phrases whose seed occurs again: all of them, and the distinct ones in fingerprint order."""
        self.at = self.at[(again | (self.seed_counts > 1))[self.seed_of]]
        if not len(self.at):
            self.one, self.two = np.empty(0, np.uint64), np.empty(0, np.uint32)
            self.first, self.entry_of = np.empty(0, np.int64), np.empty(0, np.int64)
            return
        one = rolled(words.hashes, WINDOW, P_ONE)[self.at]
        two = (rolled(words.hashes, WINDOW, P_TWO)[self.at] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((self.at, two, one))
        one, two = one[order], two[order]
        new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        self.one, self.two, self.first = one[new], two[new], self.at[order][new]
        self.entry_of = np.empty(len(order), np.int64)
        self.entry_of[order] = np.cumsum(new) - 1


def cuts(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, a range of hashes, begins and ends in the sorted ``values``."""
    edges = [min(-(-(b << 64) // buckets), (1 << 64) - 1) for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(values, np.array(edges, np.uint64)), [len(values)]]).astype(np.int64)


def questions(block: int, values: np.ndarray, buckets: int, *more: np.ndarray) -> pa.Table:
    """One packed row for each bucket that has values of this block."""
    at = cuts(values, buckets)
    some = np.flatnonzero(np.diff(at))
    return pa.table({
        "bucket": pa.array(some, pa.int32()), "block": pa.array(np.full(len(some), block), pa.int32()),
        "entries": pa.array([b"".join(v[at[b]:at[b + 1]].tobytes() for v in (values, *more)) for b in some], pa.binary())})


def answers(rows: pa.Table, kind: int, flags: np.ndarray, sizes: list[int], places: np.ndarray | None = None) -> pa.Table:
    """Bits in the order of each question's entries, and the places of those that are set."""
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    ranges = list(zip(at[:-1], at[1:]))
    return pa.table({
        "block": rows.column("block"), "bucket": rows.column("bucket"),
        "kind": pa.array(np.full(len(rows), kind), pa.int32()),
        "flags": pa.array([np.packbits(flags[a:b]).tobytes() for a, b in ranges], pa.binary()),
        "places": pa.array([b"" if places is None else places[a:b][flags[a:b]].tobytes() for a, b in ranges], pa.binary())})


def repeated_seeds(rows: pa.Table) -> pa.Table:
    """Which seeds of a bucket lie in more than one block."""
    entries = [np.frombuffer(e, np.uint64) for e in rows.column("entries").to_pylist()]
    _, inverse, counts = np.unique(np.concatenate(entries), return_inverse=True, return_counts=True)
    return answers(rows, 0, counts[inverse] > 1, [len(e) for e in entries])


def first_places(rows: pa.Table) -> pa.Table:
    """For every phrase of a bucket that an earlier block holds too: the first such block and the place there."""
    raw = rows.column("entries").to_pylist()
    sizes = [len(e) // 16 for e in raw]
    one, two, at = (np.concatenate(v) for v in zip(*(
        (np.frombuffer(e, np.uint64, n), np.frombuffer(e, np.uint32, n, 8 * n), np.frombuffer(e, np.uint32, n, 12 * n))
        for e, n in zip(raw, sizes))))
    block = np.repeat(rows.column("block").to_numpy().astype(np.int64), sizes)
    order = np.lexsort((block, two, one))
    one, two, at, block = one[order], two[order], at[order].astype(np.int64), block[order]
    new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    places, flags = np.empty(len(order), np.int64), np.empty(len(order), bool)
    places[order] = block[first] << 32 | at[first]
    flags[order] = ~new
    return answers(rows, 1, flags, sizes, places)


def told(rows: pa.Table, kind: int, values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's answers of one kind, in the order of its ``values``: (flags, places or -1)."""
    at, flags, places = cuts(values, buckets), np.zeros(len(values), bool), np.full(len(values), -1, np.int64)
    for row in rows.select(["bucket", "kind", "flags", "places"]).to_pylist():
        if row["kind"] == kind:
            a, b = at[row["bucket"]], at[row["bucket"] + 1]
            flags[a:b] = np.unpackbits(np.frombuffer(row["flags"], np.uint8), count=b - a).astype(bool)
            if row["places"]:
                places[a:b][flags[a:b]] = np.frombuffer(row["places"], np.int64)
    return flags, places


def factors(phrases: Phrases, places: np.ndarray, block: int, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, length, block, place) of the greedy factors, starts and places in words of their blocks.

    ``places`` has the first place of each distinct phrase in an earlier block, or -1.
    """
    place = places[phrases.entry_of]
    own = phrases.first[phrases.entry_of]
    place = np.where((place < 0) & (own < phrases.at), np.int64(block) << 32 | own, place)
    start, place = phrases.at[place >= 0], place[place >= 0]
    if not len(start):
        return (np.empty(0, np.int64),) * 4
    goes_on = (start[1:] == start[:-1] + 1) & (place[1:] == place[:-1] + 1) & (doc[start[1:]] == doc[start[:-1]])
    begins = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    length = np.diff(np.append(begins, len(start))) + WINDOW - 1
    return start[begins], length, place[begins] >> 32, place[begins] & 0xFFFFFFFF


def without(words: Words, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(removed, kept texts): a mark for each word under a span, the other words joined by one space."""
    depth = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, start + length, -1)
    removed = depth.cumsum()[:-1] > 0
    kept = np.flatnonzero(~removed)
    not_first = np.concatenate([[False], words.doc[kept[1:]] == words.doc[kept[:-1]]])[:len(kept)]
    # a kept word takes the separator just before it, unless it is its document's first
    change = np.zeros(len(words.data) + 1, np.int8)
    np.add.at(change, words.starts[kept] - not_first, 1)
    np.add.at(change, words.ends[kept], -1)
    take = change.cumsum(dtype=np.int8)[:-1] > 0
    data = words.data.copy()
    data[SPACE[data]] = 0x20
    offsets = np.concatenate([[0], take.cumsum(dtype=np.int64)])[words.offsets]
    # one block's texts are far below the 2 GB of 32-bit offsets, but for a single text, which Spark bounds alike
    texts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                        pa.py_buffer(data[take].tobytes()))
    return removed, texts


def reference_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, row, doc_id, text) in a table bucketed by block; blocks and rows follow the order of the documents."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-total // block_bytes), min(tasks, total >> 20))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_t").asc(), F.col("_r").asc()]
    ranged = (rows.withColumn("_t", F.xxhash64("text")).withColumn("_r", F.monotonically_increasing_id())
              .repartitionByRange(blocks, *order).sortWithinPartitions(*order)
              .select(F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("row"),
                      "doc_id", "text"))
    name = f"reference_blocks_{uuid.uuid4().hex}"
    (ranged.write.option("compression", "zstd").option("path", scratch_folder(spark, "reference-blocks"))
     .bucketBy(min(max(blocks, tasks), 100_000), "block").sortBy("block", "row").saveAsTable(name))
    return spark.table(name)


def remove_repeated_passages(docs: DataFrame, *, block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, factors) of every row of ``docs`` (doc_id, text)."""
    blocks = reference_blocks(docs, block_bytes)
    buckets = max(1, blocks.agg(F.max("block")).first()[0] or 0)

    def read(rows: pa.Table) -> tuple[int, pa.Table, Words, Phrases]:
        rows = rows.sort_by("row")
        pa.default_memory_pool().release_unused()  # what the block before this one left in the worker
        words = Words(rows.column("text"))
        return rows.column("block")[0].as_py(), rows, words, Phrases(words, buckets)

    def ask_seeds(rows: pa.Table) -> pa.Table:
        block, _, _, phrases = read(rows)
        return questions(block, phrases.seeds, buckets)

    def ask_phrases(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block, _, words, phrases = read(rows)
        phrases.index(words, told(replies, 0, phrases.seeds, buckets)[0])
        return questions(block, phrases.one, buckets, phrases.two, phrases.first.astype(np.uint32))

    def parse(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block, rows, words, phrases = read(rows)
        phrases.index(words, told(replies, 0, phrases.seeds, buckets)[0])
        _, places = told(replies, 1, phrases.one, buckets)
        start, length, source, place = factors(phrases, places, block, words.doc)
        removed, kept = without(words, start, length)
        counts = np.diff(np.concatenate([[0], removed.cumsum()])[words.firsts])
        lists = np.searchsorted(start, words.firsts).astype(np.int32)
        first_word = words.firsts[words.doc[start]]
        inner = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (start - first_word, length, source, place)],
                                           ["start", "length", "block", "place"])
        return pa.table([rows.column("doc_id"), pa.array(np.diff(words.firsts), pa.int64()), pa.array(counts, pa.int64()),
                         kept, pa.ListArray.from_arrays(lists, inner)], schema=RESULT_ARROW)

    seeds = blocks.groupBy("block").applyInArrow(ask_seeds, ENTRY)
    again = stored(seeds.groupBy("bucket").applyInArrow(repeated_seeds, ANSWER), "repeated-seeds")
    asked = blocks.groupBy("block").cogroup(again.groupBy("block")).applyInArrow(ask_phrases, ENTRY)
    places = asked.groupBy("bucket").applyInArrow(first_places, ANSWER)
    replies = again.unionByName(places)
    texts = blocks.toDF(*blocks.columns)
    return texts.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(parse, RESULT)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
later AS (
  SELECT r, i FROM (SELECT r, i, array_to_string(w[i:i + 19], ' ') AS p
                    FROM (SELECT r, w, unnest(range(1, len(w) - 18)) AS i FROM d))
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY r, i) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS i FROM later),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
