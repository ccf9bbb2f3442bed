"""Operator 1: token-id files of compressed planes.

``write_token_planes`` encodes every document, orders documents by id and
cuts the run of ids into *shards* of whole documents (about ``shard_ids`` ids;
a longer document makes a longer shard).  A shard is one self-contained
binary file image::

    fixed head | document table | chunk index | planes

The ids of a shard are cut into blocks of ``block_ids``; a block is
transposed into planes (``byte``: plane k holds byte k of every id, ``bit``:
plane k holds bit k, eight ids a byte), each plane is compressed with
zstandard, and the chunk index has per block its id count, the compressed size of
each plane and the crc32 of its ids.  Spark's own writer commits the shards
to a folder of any store, so lost executors leave no half files.

``read_token_planes`` gives documents back with their ids, verifying every
block, and ``start``: the number of ids of all documents before it.

Defined cases: null text is empty (the end id alone); null doc_id sorts
first; rows with equal doc_id follow by text; an empty table gives an empty
folder that reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens.llm.common import scratch_folder, table, text_slices, tokenizer_path, whole_text

MAGIC = b"TPL1"
HEAD = struct.Struct("<4sBBIQQQ")  # magic, bit planes?, planes, block ids, documents, ids, blocks
SHARD_SCHEMA = "segment int, shard int, n_docs long, n_ids long, image binary"
DOC_SCHEMA = "segment int, shard int, place long, doc_id long, local_start long, n_tokens long, ids binary"


def to_planes(ids: np.ndarray, bits: bool) -> list[np.ndarray]:
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(raw[:, k]) for k in range(4)]
    spread = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(spread[:, k]) for k in range(32)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        return np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1).copy().view("<u4").ravel()
    spread = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
    return np.packbits(spread, axis=1, bitorder="little").view("<u4").ravel()


def pack_shard(doc_ids: np.ndarray, known: np.ndarray, lens: np.ndarray, ids: np.ndarray,
               block_ids: int, bits: bool, level: int) -> bytes:
    import zstandard

    press = zstandard.ZstdCompressor(level=level)
    n_planes = 32 if bits else 4
    index, body = [], []
    for at in range(0, len(ids), block_ids):
        block = np.ascontiguousarray(ids[at:at + block_ids], dtype="<u4")
        packed = [press.compress(p.tobytes()) for p in to_planes(block, bits)]
        index.append([len(block), zlib.crc32(block.tobytes()), *map(len, packed)])
        body += packed
    docs = press.compress(doc_ids.astype("<i8").tobytes() + known.astype(np.uint8).tobytes()
                          + lens.astype("<i8").tobytes())
    chunk_index = np.array(index, dtype="<u4").reshape(-1, 2 + n_planes).tobytes()
    head = HEAD.pack(MAGIC, bits, n_planes, block_ids, len(doc_ids), len(ids), len(index))
    return b"".join([head, struct.pack("<Q", len(docs)), docs, chunk_index, *body])


def unpack_shard(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, doc_id is known, ids per document, all ids); raises on a damaged block."""
    import zstandard

    magic, bits, n_planes, _, n_docs, n_ids, n_blocks = HEAD.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a token plane shard")
    at = HEAD.size
    (size,) = struct.unpack_from("<Q", image, at)
    at += 8
    open_ = zstandard.ZstdDecompressor().decompress
    docs = open_(image[at:at + size])
    at += size
    index = np.frombuffer(image, "<u4", n_blocks * (2 + n_planes), at).reshape(-1, 2 + n_planes)
    at += index.nbytes
    out = np.empty(n_ids, "<u4")
    done = 0
    for n, crc, *sizes in index.tolist():
        planes = []
        for s in sizes:
            planes.append(open_(image[at:at + s]))
            at += s
        block = from_planes(planes, n, bool(bits))
        if zlib.crc32(block.tobytes()) != crc:
            raise ValueError("damaged block in a token plane shard")
        out[done:done + n] = block
        done += n
    return (np.frombuffer(docs, "<i8", n_docs), np.frombuffer(docs, np.uint8, n_docs, 8 * n_docs).astype(bool),
            np.frombuffer(docs, "<i8", n_docs, 9 * n_docs), out)


def write_token_planes(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, *, planes: str = "byte",
                       block_ids: int = 1 << 16, shard_ids: int = 1 << 20, level: int = 3) -> None:
    """Encode ``docs`` (doc_id, text) and write the shards under ``path``."""
    bits = {"byte": False, "bit": True}[planes]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from patchlens.llm.word_tokens import encoder

        enc, segment, shard = encoder(tokenizer), TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        n_held = 0

        def image() -> pa.RecordBatch:
            doc_ids, known, lens, ids = (np.concatenate(x) for x in zip(*held))
            data = pack_shard(doc_ids, known, lens, ids, block_ids, bits, level)
            return pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(doc_ids)], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())],
                ["segment", "shard", "n_docs", "n_ids", "image"])

        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                ids, n = enc.encode(batch.column(1).slice(lo, hi - lo))
                ids = np.insert(ids, np.cumsum(n), end_id)
                n = n + 1
                key = batch.column(0).slice(lo, hi - lo)
                doc_ids, known = key.fill_null(0).to_numpy(), key.is_valid().to_numpy(zero_copy_only=False)
                ends, row = np.cumsum(n), 0
                while row < len(n):
                    base = ends[row - 1] if row else 0
                    to = int(np.searchsorted(ends, base + max(1, shard_ids - n_held), side="left")) + 1
                    to = min(to, len(n))
                    held.append((doc_ids[row:to], known[row:to], n[row:to], ids[base:ends[to - 1]]))
                    n_held += int(ends[to - 1] - base)
                    row = to
                    if n_held >= shard_ids:
                        yield image()
                        held, n_held, shard = [], 0, shard + 1
        if held:
            yield image()

    (docs.select("doc_id", whole_text().alias("text"))
         .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
         .mapInArrow(shards, SHARD_SCHEMA)
         .write.option("compression", "none").parquet(path))


def read_token_planes(spark: SparkSession, path: str, *wanted: Column) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids are little-endian unsigned 32-bit integers.

    ``wanted``: columns over ``ids`` to return in its place; they are computed where the
    file is read, so the ids themselves are not shuffled for ``start``.
    """
    wanted = wanted or (F.col("ids"),)
    files = spark.read.schema(SHARD_SCHEMA).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, shard, image in zip(*(batch.column(i).to_pylist() for i in range(3))):
                doc_ids, known, lens, ids = unpack_shard(image)
                starts = np.cumsum(lens) - lens
                bounds = np.concatenate([starts, [len(ids)]]) * 4
                raw = pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(bounds.astype(np.int32)),
                                                                     pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lens), segment, np.int32)), pa.array(np.full(len(lens), shard, np.int32)),
                     pa.array(np.arange(len(lens))), pa.array(doc_ids, mask=~known), pa.array(starts),
                     pa.array(lens), raw],
                    ["segment", "shard", "place", "doc_id", "local_start", "n_tokens", "ids"])

    # sizes of the shards of a segment, then of the segments (one row for each write task)
    sizes = files.select("segment", "shard", "n_ids")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    in_segment = sizes.withColumn("s", F.coalesce(F.sum("n_ids").over(
        before.partitionBy("segment").orderBy("shard")), F.lit(0)))
    segments = sizes.groupBy("segment").agg(F.sum("n_ids").alias("n")).select(
        "segment", F.coalesce(F.sum("n").over(before.orderBy("segment")), F.lit(0)).alias("b"))
    starts = in_segment.join(segments, "segment").select("segment", "shard", (F.col("s") + F.col("b")).alias("base"))
    read = files.select("segment", "shard", "image").mapInArrow(documents, DOC_SCHEMA).select(
        "segment", "shard", "doc_id", "local_start", "n_tokens", *wanted)
    rest = read.columns[5:]
    return read.join(starts, ["segment", "shard"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", *rest)


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "token-planes")
    write_token_planes(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return read_token_planes(spark, path, F.crc32("ids").alias("ids_crc32"))
