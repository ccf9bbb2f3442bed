"""Operator 5: token counts without token ids.

A byte-level tokenizer cuts a text into pre-tokens and then encodes every
pre-token by itself, so a text's token count is the sum over its pre-tokens
of frequency x pieces.  Pre-tokens are counted over the whole corpus, every
distinct one is encoded once, and the counts are joined to the per-document
frequencies.  The commonest pre-tokens (``head``, a bound on their number)
would be hot join keys: their counts go to the tasks as one bounded
broadcast and are folded where the text is read; all others are joined by
shuffle, where no key is common.

Pre-tokens are found for a whole batch at once with numpy over the UTF-8
bytes.

Defined cases: null text is empty (no tokens); texts are counted whole, the arrays of a
task growing with its longest text; pre-tokens as common as the last of the head are all
in it or all joined, which gives the same sums; rows with equal or null
doc_id each keep their own row; a special token's string inside a text is
that token (the library's default); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table, text_slices, tokenizer_path, whole_text

OTHER, LETTER, NUMBER, SPACE, EDGE = 0, 1, 2, 3, 4
#: bytes of text that are worked on at once, at about 25 bytes of arrays a character
SLICE = 2 << 20
#: fixed values: Unicode White_Space
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def char_classes() -> np.ndarray:
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = SPACE
    return out


def pre_token_starts(data: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Byte offsets at which pre-tokens start in texts laid end to end (empty texts left out)."""
    pos = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[pos]
    code = lead.astype(np.int32)
    for width, least, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        at = np.flatnonzero((lead >= least) & (lead < (least | mask) + 1))
        if len(at):
            value = code[at] & mask
            for k in range(1, width):
                value = (value << 6) | (data[pos[at] + k] & 0x3F)
            code[at] = value
    kind = char_classes()[code]
    n = len(pos)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(pos, doc_starts)] = True
    first[n] = True
    before = np.empty(n, np.uint8)
    before[1:] = kind[:-1]
    before[first[:-1]] = EDGE
    after = np.empty(n, np.uint8)
    after[:-1] = kind[1:]
    after[first[1:]] = EDGE
    start = kind != before
    # the last white space before other text stands apart from the run before it ...
    white = kind == SPACE
    start |= white & (after != SPACE) & (after != EDGE)
    # ... and a blank joins the text that follows
    joined = np.zeros(n, bool)
    joined[1:] = code[:-1] == 32
    joined[first[:-1]] = False
    start &= white | ~joined
    # 's 't 'm 'd 're 've 'll at the start of a match
    quote = np.flatnonzero((code == 39) & start & (after == LETTER))
    if len(quote):
        nxt = code[quote + 1]
        two = np.where(quote + 2 < n, code[np.minimum(quote + 2, n - 1)], 0)
        two = np.where(first[np.minimum(quote + 2, n)], 0, two)
        one_letter = np.isin(nxt, [ord(c) for c in "stmd"])
        two_letters = (((nxt == ord("r")) | (nxt == ord("v"))) & (two == ord("e"))) | (
            (nxt == ord("l")) & (two == ord("l")))
        for hit, size in ((one_letter, 2), (two_letters, 3)):
            start[quote[hit] + 1] = False
            end = quote[hit] + size
            start[end[end < n]] = True
    return pos[start]


class PreTokens:
    """Pre-tokens of a batch: dictionary, code of each, and the document each lies in."""

    def __init__(self, texts: pa.Array, special: list[str]):
        extra = np.zeros(len(texts), np.int64)
        owner = np.arange(len(texts))
        mask = np.zeros(len(texts), bool)
        for s in special:
            mask |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if mask.any():  # a special token's string is one token and parts the text
            cut, whose = [], []
            for i, t in enumerate(texts.to_pylist()):
                parts = [t]
                for s in special if mask[i] else ():
                    parts = [q for p in parts for q in p.split(s)]
                extra[i] = len(parts) - 1
                cut += parts
                whose += [i] * len(parts)
            texts, owner = pa.array(cut, pa.string()), np.array(whose)
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        full = size > 0
        begin = (np.cumsum(size) - size)[full]
        joined = pa.concat_arrays([texts.cast(pa.large_binary())])  # offsets start anew
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        starts = pre_token_starts(data, begin) if len(data) else np.empty(0, np.int64)
        bounds = np.append(starts, len(data)).astype(np.int64)
        tokens = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds),
                                                                        pa.py_buffer(np.ascontiguousarray(data))])
        coded = tokens.dictionary_encode()
        self.extra, self.values, self.codes = extra, coded.dictionary, coded.indices.to_numpy()
        self.doc = owner[full][np.searchsorted(begin, starts, side="right") - 1]


def _special(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or spec.get(
            "normalizer"):
        raise ValueError("count_tokens needs a byte-level tokenizer with its own word rule")
    return [t["content"] for t in spec.get("added_tokens", [])]


def count_tokens(docs: DataFrame, tokenizer: str, *, head: int = 1 << 17) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    special = _special(tokenizer)
    texts = docs.select("doc_id", whole_text().alias("text"))

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column(0), SLICE):
                found = PreTokens(batch.column(0).slice(lo, hi - lo), special)
                n = np.bincount(found.codes, minlength=len(found.values)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([found.values.cast(pa.string()), pa.array(n)], ["piece", "n"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer)
        tok.no_truncation()
        tok.no_padding()
        for batch in batches:
            got = tok.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)
            n = pa.array([len(e.ids) for e in got], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["piece", "n", "n_pieces"])

    counted = stored(texts.select("text").mapInArrow(vocabulary, "piece string, n long")
                     .groupBy("piece").agg(F.sum("n").alias("n"))
                     .mapInArrow(pieces, "piece string, n long, n_pieces int"), "piece-counts")

    # the least frequency (a power of two) which at most ``head`` pre-tokens reach: 64 rows at most
    steps = sorted((r[0], r[1]) for r in counted.groupBy(
        F.floor(F.log2("n")).cast("int").alias("step")).count().collect())
    least, total = 62, 0
    for step, n in reversed(steps):
        total += n
        if total > head:
            break
        least = step
    common = counted.filter(F.col("n") >= F.lit(1 << least)).select("piece", "n_pieces").toArrow()
    known = spark.sparkContext.broadcast((common.column(0).combine_chunks().cast(pa.large_string()),
                                          common.column(1).to_numpy().astype(np.int64)))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, sizes = known.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, hi in text_slices(batch.column(1), SLICE):
                text = batch.column(1).slice(lo, hi - lo)
                found = PreTokens(text, special)
                place = pc.index_in(found.values, value_set=words).fill_null(-1).to_numpy()
                size = np.append(sizes, 0)[place]
                sums = found.extra + np.bincount(found.doc, weights=size[found.codes],
                                                 minlength=hi - lo).astype(np.int64)
                rare = np.flatnonzero((place < 0)[found.codes])
                key, times = np.unique(found.doc[rare] * np.int64(len(place) + 1) + found.codes[rare],
                                       return_counts=True)
                doc, code = np.divmod(key, len(place) + 1)
                ends = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                rest = pa.StructArray.from_arrays(
                    [found.values.take(pa.array(code)).cast(pa.string()), pa.array(times.astype(np.int32))],
                    ["piece", "times"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(hi - lo)), batch.column(0).slice(lo, hi - lo),
                     pc.binary_length(text).cast(pa.int64()), pa.array(sums),
                     pa.ListArray.from_arrays(pa.array(ends), rest)],
                    ["row", "doc_id", "n_bytes", "head_tokens", "rest"])
                row += hi - lo

    rows = stored(texts.mapInArrow(frequencies, "row long, doc_id long, n_bytes long, head_tokens long, "
                                                "rest array<struct<piece:string,times:int>>"), "piece-frequencies")
    tail = (rows.select("row", F.inline("rest")).join(counted.select("piece", "n_pieces"), "piece")
            .groupBy("row").agg(F.sum(F.col("times") * F.col("n_pieces")).alias("tail_tokens")))
    return (rows.select("row", "doc_id", "n_bytes", "head_tokens").join(tail, "row", "left")
            .select("doc_id", "n_bytes",
                    (F.col("head_tokens") + F.coalesce("tail_tokens", F.lit(0))).alias("n_tokens")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
