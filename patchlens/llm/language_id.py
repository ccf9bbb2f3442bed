"""Operator 10: language identification by word-first backoff.

Learning: words (runs of letters, lower-cased) are counted per language over
a bounded sample of labelled documents (``sample_docs`` documents of each
language, chosen by a hash of doc_id), and the 1- to 4-grams of those
words with a mark at either end.  The ``words`` commonest words and ``grams``
commonest n-grams of each language and order make the model; its size is
bounded by these parameters and it is broadcast.

Scoring: a known word adds its log frequency in each language; an unseen
word adds the mean log frequency of its known 4-grams, or of its 3-grams if
none is known, and so on down.  The language of the highest sum is predicted
and ``score`` is its share after a softmax over the sums.  On demand,
``known`` is the mean known part of a text's words (all of a known word, of another the
known part of its n-grams), and ``margin`` the lead of the highest sum over the next, a word.

Defined cases: ``und`` with score 0 for null text, text without a letter and
when nothing could be learned; text of which no n-gram is known gets the
commonest language of the sample and its share; ties go to the language first in
alphabetical order; a null doc_id counts as the empty string; repeated rows
keep their own rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table, text_slices, whole_text
from patchlens.llm.token_counts import LETTER, char_classes

ORDERS = (4, 3, 2, 1)
SMOOTH = 0.5
MEMORY = 100_000  # unseen words remembered by a worker
SLICE = 1 << 20  # bytes of text worked on at once; the arrays over its characters take some twenty times as much
TERMS = 2_500  # words whose n-grams are counted at once


def hash_remainder(column: str, divisor: int) -> Column:
    """crc32 of an id's decimal text, modulo ``divisor``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


class Words:
    """Letter runs of a batch of texts: dictionary, code of each run, and its document."""

    def __init__(self, texts: pa.Array):
        joined = pa.concat_arrays([pc.utf8_lower(texts).cast(pa.large_binary())])
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            self.values, self.codes, self.doc = [], np.empty(0, np.int64), np.empty(0, np.int64)
            return
        pos = np.flatnonzero((data & 0xC0) != 0x80)
        code = data[pos].astype(np.int32)
        for width, least, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
            at = np.flatnonzero((data[pos] >= least) & (data[pos] <= (least | mask)))
            value = code[at] & mask
            for k in range(1, width):
                value = (value << 6) | (data[pos[at] + k] & 0x3F)
            code[at] = value
        letter = char_classes()[code] == LETTER
        start = np.ones(len(pos), bool)
        start[1:] = letter[1:] != letter[:-1]
        full = np.diff(offsets) > 0
        start[np.searchsorted(pos, offsets[:-1][full])] = True
        begin = pos[start]
        runs = pa.Array.from_buffers(pa.large_string(), len(begin), [
            None, pa.py_buffer(np.append(begin, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        word = letter[start]
        coded = runs.filter(pa.array(word)).dictionary_encode()
        self.values, self.codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.doc = np.flatnonzero(full)[np.searchsorted(offsets[:-1][full], begin[word], side="right") - 1]


def grams(word: str, order: int) -> list[str]:
    marked = f"_{word}_" if order > 1 else word
    return [marked[i:i + order] for i in range(len(marked) - order + 1)]


class Model:
    """Per-language log frequencies of words and n-grams."""

    def __init__(self, langs: list[str], shares: list[float], words: dict, by_order: dict):
        self.langs, self.shares = langs, shares
        self.words = self._logs(words)
        self.grams = [self._logs(by_order.get(n, {})) for n in ORDERS]
        self.seen: dict[str, tuple] = {}
        self.parts: dict[str, float] = {}

    def _logs(self, counts: dict[str, Counter]) -> dict[str, tuple]:
        keys = sorted({k for c in counts.values() for k in c})
        total = {g: sum(counts.get(g, {}).values()) + SMOOTH * (len(keys) + 1) for g in self.langs}
        return {k: tuple(math.log((counts.get(g, {}).get(k, 0) + SMOOTH) / total[g]) for g in self.langs) for k in keys}

    def vector(self, word: str) -> tuple:
        got = self.words.get(word) or self.seen.get(word)
        if got is None:
            got = (0.0,) * len(self.langs)
            for order, known in zip(ORDERS, self.grams):
                found = [known[g] for g in grams(word, order) if g in known]
                if found:
                    got = tuple(sum(v) / len(found) for v in zip(*found))
                    break
            if len(self.seen) >= MEMORY:
                self.seen.clear()
            self.seen[word] = got
        return got

    def known(self, word: str) -> float:
        """1 for a known word, else the known part of its 4-grams; of its 2-grams for letters from
        U+0E00 on, among them those that stand for syllables or are written without spaces."""
        if word in self.words:
            return 1.0
        got = self.parts.get(word)
        if got is None:
            order = 2 if max(word) >= "\u0e00" else 4
            of, model = grams(word, order), self.grams[ORDERS.index(order)]
            got = sum(g in model for g in of) / max(1, len(of))
            if len(self.parts) >= MEMORY:
                self.parts.clear()
            self.parts[word] = got
        return got

    def predict(self, texts: pa.Array, evidence: bool = False) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, known, margin) of each text; the last two are zeros without ``evidence``."""
        found = Words(texts)
        n, width = len(texts), len(self.langs)
        known, margin = np.zeros(n), np.zeros(n)
        if not width:
            return ["und"] * n, np.zeros(n), known, margin
        vectors = np.array([self.vector(w) for w in found.values]).reshape(-1, width)
        sums = np.stack([np.bincount(found.doc, weights=vectors[found.codes, k] if len(found.codes) else None,
                                     minlength=n) for k in range(width)], axis=1)
        n_words = np.bincount(found.doc, minlength=n)
        worded = n_words > 0
        if evidence and len(found.codes):
            parts = np.array([self.known(w) for w in found.values])
            known = np.bincount(found.doc, weights=parts[found.codes], minlength=n) / np.maximum(n_words, 1)
            two = np.sort(sums, axis=1)[:, -2:]
            margin = (two[:, 1] - two[:, 0]) / np.maximum(n_words, 1) if width > 1 else np.full(n, np.inf)
            margin = np.where(worded, margin, 0.0)
        best = sums.argmax(axis=1)
        odds = np.exp(sums - sums.max(axis=1, keepdims=True))
        score = odds.max(axis=1) / odds.sum(axis=1)
        blank = ~sums.any(axis=1)
        best[blank] = int(np.argmax(self.shares))
        score[blank] = max(self.shares)
        return ([self.langs[b] if w else "und" for b, w in zip(best.tolist(), worded.tolist())],
                np.where(worded, score, 0.0), known, margin)


def learn(labelled: DataFrame, *, sample_docs: int, words: int, n_grams: int) -> Model:
    """A model from ``labelled`` (doc_id, text, lang; no nulls in text and lang)."""
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    langs = sorted(sizes)
    if not langs:
        return Model([], [], {}, {})
    share = F.create_map(*[x for g in langs for x in (F.lit(g), F.lit(min(1.0, sample_docs / sizes[g])))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = labelled.filter(place < share[F.col("lang")])

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column(1), SLICE):
                found = Words(batch.column(1).slice(lo, hi - lo))
                names, lang = np.unique(batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(str),
                                        return_inverse=True)
                key, n = np.unique(lang[found.doc] * (len(found.values) + 1) + found.codes, return_counts=True)
                which, code = np.divmod(key, len(found.values) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[which], pa.string()), pa.array([found.values[c] for c in code], pa.string()),
                     pa.array(n.astype(np.int64))], ["lang", "term", "n"])

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # by ``TERMS`` words: each may bring some thirty n-grams of its own
        for batch in (b.slice(at, TERMS) for b in batches for at in range(0, b.num_rows, TERMS)):
            counts: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for order in ORDERS:
                    for g in grams(word, order):
                        counts[lang, order, g] += n
            rows = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["lang", "len", "term", "n"])

    counted = stored(sample.select("lang", "text").mapInArrow(count_words, "lang string, term string, n long")
                     .groupBy("lang", "term").agg(F.sum("n").alias("n")), "language-words")
    gram_counts = counted.mapInArrow(count_grams, "lang string, len int, term string, n long").groupBy(
        "lang", "len", "term").agg(F.sum("n").alias("n"))

    def top(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("n"), "term")
        return df.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= limit).drop("at")

    by_word: dict[str, Counter] = {}
    for r in top(counted.filter("n > 1"), ["lang"], words).toLocalIterator():
        by_word.setdefault(r["lang"], Counter())[r["term"]] = r["n"]
    by_order: dict[int, dict[str, Counter]] = {}
    for r in top(gram_counts, ["lang", "len"], n_grams).toLocalIterator():
        by_order.setdefault(r["len"], {}).setdefault(r["lang"], Counter())[r["term"]] = r["n"]
    return Model(langs, [sizes[g] / total for g in langs], by_word, by_order)


def identify_languages(docs: DataFrame, held_out: Column, *, sample_docs: int = 6_000, words: int = 30_000,
                       n_grams: int = 10_000, evidence: bool = False) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, lang) with held_out, lang_pred and score; rows of
    ``held_out`` are not learned from.  With ``evidence`` also known and margin."""
    spark = docs.sparkSession
    labelled = docs.filter(~held_out & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = spark.sparkContext.broadcast(
        learn(labelled.select("doc_id", "text", "lang"), sample_docs=sample_docs, words=words, n_grams=n_grams))
    added = ["lang_pred", "score", *(["known", "margin"] if evidence else [])]
    rest = [c for c in docs.columns if c not in ("held_out", "_whole", *added)]
    source = docs.select(*rest, held_out.alias("held_out"), whole_text().alias("_whole"))
    schema = source.drop("_whole").schema
    for name in added:
        schema = schema.add(name, "string" if name == "lang_pred" else "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for lo, hi in text_slices(text, SLICE):
                langs, *numbers = model.value.predict(text.slice(lo, hi - lo), evidence)
                kept = [c.slice(lo, hi - lo) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(langs, pa.string()), *map(pa.array, numbers[:len(added) - 1])],
                    [*batch.schema.names[:-1], *added])

    return source.mapInArrow(predict, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_languages(docs, hash_remainder("doc_id", 3) == 1).select(
        "doc_id", "held_out", "lang_pred", "score")
