"""Operator 2: packing documents into windows by non-negative least squares.

Every document becomes its ids and an end id.  Whole windows are cut off its
front; what is left (shorter than a window) is kept in one piece where the
plan allows:

1. the lengths left are counted (a histogram of ``window - 1`` bins at most);
2. shallow combinations (two lengths, or three of which two are among the
   ``heavy`` lengths with the most tokens) that fill a window exactly are enumerated, and
   repeat counts are solved by non-negative least squares against the
   histogram (coordinate descent on the driver: its input is bounded by the
   window, not by the corpus);
3. the counts are rounded down, cut to what the histogram holds, and pairs
   that still fit are added greedily;
4. the pieces that remain are laid end to end by length and cut at window
   ends; the last, shorter window is cut into power-of-two sequences.  So
   every sequence is full or a power of two: no padding.

The plan speaks of the k-th piece of a length.  A piece's rank is its rank
inside its write task plus the pieces of that length in the tasks before, so
no length, however common, meets in one task.

Defined cases: null text is empty (the end id alone); rows with equal or
null doc_id are packed one by one; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table, text_slices, tokenizer_path, whole_text

PIECE_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
                "sequence_id long, offset long")


def combinations(counts: np.ndarray, window: int, heavy: int) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to ``window``; every length occurs in ``counts``."""
    have = np.flatnonzero(counts)
    have = have[have > 0]
    pairs = [(window - a, a, 0) for a in have.tolist() if a <= window - a and counts[window - a]]
    top = have[np.argsort(-(counts[have] * have), kind="stable")[:heavy]].tolist()
    triples = {tuple(sorted((a, b, window - a - b), reverse=True))
               for a, b in combinations_with_replacement(top, 2) if window - a - b > 0 and counts[window - a - b]}
    return np.array(sorted(pairs) + sorted(triples), dtype=np.int64).reshape(-1, 3)


def solve(combos: np.ndarray, counts: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """min |A x - counts| with x >= 0, by coordinate descent on the sparse columns of A."""
    columns = []
    for row in combos.tolist():
        lens = [v for v in row if v]
        columns.append([(v, lens.count(v)) for v in sorted(set(lens))])
    left = counts.astype(float).tolist()
    x = [0.0] * len(columns)
    norm = [float(sum(m * m for _, m in col)) for col in columns]
    for _ in range(sweeps):
        moved = 0.0
        for j, col in enumerate(columns):
            step = 0.0
            for v, m in col:
                step += m * left[v]
            step = max(step / norm[j], -x[j])
            if step:
                x[j] += step
                for v, m in col:
                    left[v] -= m * step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return np.array(x)


class Plan:
    """Where the k-th piece of each length goes; built from the histogram alone."""

    def __init__(self, counts: np.ndarray, window: int, heavy: int):
        self.window = window
        left = counts.astype(np.int64).copy()
        left[0] = 0
        self.slots: dict[int, list[tuple[int, int, int, tuple[int, ...]]]] = {}  # length: [first rank, end, sequence, offsets]
        used = np.zeros_like(left)
        self.sequences = 0
        combos = combinations(left, window, heavy)
        order = []
        if len(combos):
            x = np.floor(solve(combos, left) + 1e-9).astype(np.int64)
            order = [(combos[j].tolist(), int(x[j])) for j in np.argsort(-x, kind="stable") if x[j]]
            order += [(combos[j].tolist(), int(left.max())) for j in range(len(combos))]  # greedy: whatever still fits
        for row, times in order:
            lens = [v for v in row if v]
            at = {v: tuple(sum(lens[:i]) for i in range(len(lens)) if lens[i] == v) for v in lens}
            times = min([times, *(int(left[v]) // len(o) for v, o in at.items())])
            if times <= 0:
                continue
            for v, offsets in at.items():
                n = times * len(offsets)
                self.slots.setdefault(v, []).append((int(used[v]), int(used[v]) + n, self.sequences, offsets))
                used[v] += n
                left[v] -= n
            self.sequences += times
        self.used = used
        tokens = left * np.arange(len(left))
        self.rest_at = np.cumsum(tokens) - tokens
        self.rest = int(tokens.sum())
        tail, at = self.rest % window, self.rest - self.rest % window
        self.tail_at = [at]
        for bit in reversed(range(window.bit_length())):
            if tail >> bit & 1:
                at += 1 << bit
                self.tail_at.append(at)
        self.first_full = self.sequences + self.rest // window + len(self.tail_at) - 1
        self.ends = {v: np.array([s[1] for s in rows]) for v, rows in self.slots.items()}

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, tokens) of the parts of the piece."""
        if rank < self.used[length]:
            first, _, sequence, offsets = self.slots[length][int(np.searchsorted(self.ends[length], rank, "right"))]
            again, which = divmod(rank - first, len(offsets))
            return [(sequence + again, offsets[which], length)]
        at = int(self.rest_at[length]) + (rank - int(self.used[length])) * length
        out, end = [], at + length
        while at < end:
            if at < self.tail_at[0]:
                row, begin = at // self.window, at - at % self.window
                stop = begin + self.window
            else:
                k = int(np.searchsorted(self.tail_at, at, "right")) - 1
                row, begin, stop = self.tail_at[0] // self.window + k, self.tail_at[k], self.tail_at[k + 1]
            n = min(stop, end) - at
            out.append((self.sequences + row, at - begin, n))
            at += n
        return out


def encode_rows(docs: DataFrame, tokenizer: str, end_id: int, window: int, slice_bytes: int = 16 << 20) -> DataFrame:
    """(task, place, doc_id, n_tokens, tail, tail_rank, full_before, ids): ``tail`` is the length
    left after whole windows; ranks and counts run inside the write task, over ``slice_bytes`` of text at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from patchlens.llm.word_tokens import encoder

        enc, task = encoder(tokenizer), TaskContext.get().partitionId()
        seen, full = np.zeros(window, np.int64), 0
        kind = f"<u{enc.width}"
        for batch in batches:
            for lo, hi in text_slices(batch.column(1), slice_bytes):
                ids, n = enc.encode(batch.column(1).slice(lo, hi - lo))
                ids = np.insert(ids, np.cumsum(n), end_id).astype(kind)
                n = n + 1
                tail, whole = n % window, n // window
                order = np.argsort(tail, kind="stable")
                ranked = tail[order]
                rank = np.empty(len(n), np.int64)
                rank[order] = np.arange(len(n)) - np.searchsorted(ranked, ranked) + seen[ranked]
                seen += np.bincount(tail, minlength=window)
                before = full + np.cumsum(whole) - whole
                full += int(whole.sum())
                bounds = np.concatenate([[0], np.cumsum(n)]) * ids.itemsize
                data = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds.astype(np.int32)),
                                                                   pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), task, np.int32)), batch.column(0).slice(lo, hi - lo), pa.array(n),
                     pa.array(tail.astype(np.int32)), pa.array(rank), pa.array(whole), pa.array(before),
                     pa.array(np.full(len(n), enc.width, np.int32)), data],
                    ["task", "doc_id", "n_tokens", "tail", "tail_rank", "full", "full_before", "width", "ids"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        rows, "task int, doc_id long, n_tokens long, tail int, tail_rank long, full long, full_before long, "
              "width int, ids binary")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, *, window: int = 2048,
                   heavy: int = 96, slice_bytes: int = 16 << 20) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset.  A worker encodes ``slice_bytes`` of text at a time: less takes less memory and more time."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    spark = docs.sparkSession
    rows = stored(encode_rows(docs, tokenizer, end_id, window, slice_bytes), "packing-ids")

    counts = rows.groupBy("task", "tail").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full")).checkpoint()
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n")).collect():  # at most ``window`` rows
        histogram[r["tail"]] = r["n"]
    plan = Plan(histogram, window, heavy)
    shared = spark.sparkContext.broadcast(plan)

    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    full = counts.groupBy("task").agg(F.sum("full").alias("full")).select(
        "task", F.coalesce(F.sum("full").over(before.orderBy("task")), F.lit(0)).alias("full_base"))
    base = counts.select("task", "tail", F.coalesce(F.sum("n").over(
        before.partitionBy("tail").orderBy("task")), F.lit(0)).alias("base")).join(full, "task")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            held = 0

            def flush(out=out):
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3)],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

            for doc_id, n, tail, rank, fulls, sequence, width, data in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()
                parts = [(plan.first_full + sequence + k, 0, plan.window) for k in range(fulls)]
                if tail:
                    parts += plan.place(tail, rank)
                at = 0
                for seq, offset, length in parts:
                    for column, v in zip(out, (doc_id, at, length, ids[4 * at:4 * (at + length)], n, seq, offset)):
                        column.append(v)
                    at += length
                held += len(ids)
                if held > 8 << 20:
                    yield flush()
                    for column in out:
                        column.clear()
                    held = 0
            yield flush()

    return (rows.join(base, ["task", "tail"])
            .select("doc_id", "n_tokens", "tail", (F.col("base") + F.col("tail_rank")).alias("rank"), "full",
                    (F.col("full_base") + F.col("full_before")).alias("sequence"), "width", "ids")
            .mapInArrow(pieces, PIECE_SCHEMA))


def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
