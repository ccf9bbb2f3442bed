"""Operator 6: log-likelihood of whole documents by a gated recurrent language model.

Words are counted over all training texts.  The commonest ``n_words - 1``
words and the text end are the model's output vocabulary, in classes; all
other words share one class, inside which a word's probability is its
smoothed share of the training counts, so every word has a probability.

Training runs where the data lies: in each round every task trains from the
same parameters on its own texts of that round (truncated backpropagation in
numpy, state carried across windows), and the parameters are averaged by
tokens with a grouped sum.  Over the rounds every training text is used once;
parameters have a fixed size.

Scoring reads each whole text with its state carried from its first to its
last token.  The counts of the commonest words (``head``, a bound on their
number) go to the tasks; the other words of a document are joined with the
counts by shuffle, where no key is common.

Defined cases: null text is empty (its end is its one token); rows with equal
or null doc_id keep their own rows (a null doc_id hashes as the empty string, held out); without any
training text all words are unseen; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table, text_slices, whole_text
from patchlens.llm.gru import ClassGru, start_parameters
from patchlens.llm.language_id import hash_remainder

SMOOTH = 0.1


def batch_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each word, words per text): runs without ASCII white space, A-Z lowered."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    at = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy()
    at = at - at[0]
    none = pc.index(words, pa.scalar("", words.type)).as_py()  # the empty runs around white space
    if none < 0:
        return words, codes, np.diff(at)
    full = codes != none
    upto = np.concatenate([[0], np.cumsum(full)])
    codes = codes[full]
    return (pa.concat_arrays([words.slice(0, none), words.slice(none + 1)]), codes - (codes > none),
            upto[at[1:]] - upto[at[:-1]])


class Lexicon:
    """The commonest words with their counts, and what a model needs of them."""

    def __init__(self, words: list[str], counts: list[int], n_texts: int, total: int, distinct: int,
                 n_words: int, buckets: int, size: int):
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = pa.array([words[i] for i in order], pa.string())
        self.counts = np.array([counts[i] for i in order], dtype=np.int64)
        self.n_model = min(n_words - 1, len(order))
        self.n_texts, self.buckets = n_texts, buckets
        self.first_bucket = -(-(self.n_model + 1) // size) * size
        own = int(self.counts[:self.n_model].sum()) + n_texts
        self.rest = total - own
        self.base_log = np.log10(total + SMOOTH * (distinct + 1))
        self.rest_log = np.log10(self.rest + SMOOTH * (distinct - self.n_model - (n_texts > 0) + 1))

    def model_counts(self) -> np.ndarray:
        return np.concatenate([[self.n_texts], self.counts[:self.n_model]])

    def places(self, words: pa.Array, model_only: bool = False) -> np.ndarray:
        """Place of each word, -1 if it has none; ``model_only``: of the words of the model's vocabulary alone."""
        known = self.words.slice(0, self.n_model) if model_only else self.words
        return pc.index_in(words, value_set=known).fill_null(-1).to_numpy()

    def tokens(self, words: pa.Array, codes: np.ndarray, lens: np.ndarray, places: np.ndarray):
        """(inputs, targets, tokens per text), the end of each text added."""
        own = (places >= 0) & (places < self.n_model)
        last = pc.binary_slice(words.cast(pa.binary()), -3).dictionary_encode()
        ending = np.array([zlib.crc32(w) % self.buckets for w in last.dictionary.to_pylist()], np.int64)
        inputs = np.where(own, places + 1, self.first_bucket + ending[last.indices.to_numpy()])
        targets = np.where(own, places + 1, self.first_bucket)
        ends = np.cumsum(lens)
        return np.insert(inputs[codes], ends, 0), np.insert(targets[codes], ends, 0), lens + 1


def _flat(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[k].ravel() for k in sorted(parameters)])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def train(texts: DataFrame, lexicon, start: dict[str, np.ndarray], *, rounds: int, width: int, steps: int,
          rate: float) -> dict[str, np.ndarray]:
    """Parameters after ``rounds`` rounds over ``texts`` (round, text); ``lexicon`` is a broadcast."""
    spark = texts.sparkSession
    parameters = start
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(parameters)

        def local(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model, seen = ClassGru(shared.value), 0
            for batch in batches:
                for lo, hi in text_slices(batch.column(0), 8 << 20):
                    words, codes, lens = batch_words(batch.column(0).slice(lo, hi - lo))
                    x, y, lens = lexicon.value.tokens(words, codes, lens, lexicon.value.places(words, model_only=True))
                    # fewer streams for little data, so that there are some steps at least
                    lanes = int(min(width, max(8, len(x) // (64 * steps))))
                    model.texts(x, y, lens, width=lanes, steps=steps, learn=rate)
                    seen += len(x)
            if seen:
                flat = _flat(model.p).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat),
                     pa.array(np.full(len(flat), seen, np.int64))], ["i", "v", "n"])

        mean = (texts.filter(F.col("round") == number).select("text").mapInArrow(local, "i int, v double, n long")
                .groupBy("i").agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v")).toArrow())
        if mean.num_rows:
            flat = np.empty(mean.num_rows)
            flat[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
            parameters = _shaped(flat, start)
    return parameters


def score_texts(docs: DataFrame, held_out: Column, *, n_words: int = 1024, size: int = 32, buckets: int = 64,
                hidden: int = 16, embed: int = 16, rounds: int = 2, width: int = 256, steps: int = 16,
                rate: float = 0.01, head: int = 1 << 17) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of
    ``docs`` (doc_id, text); scores are log10 probabilities."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", held_out.alias("held_out"), whole_text().alias("text"))
    training = texts.filter(~F.col("held_out")).select(
        F.pmod(F.xxhash64("doc_id"), F.lit(rounds)).alias("round"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column(0)):
                words, codes, lens = batch_words(batch.column(0).slice(lo, hi - lo))
                n = np.bincount(codes, minlength=len(words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(  # one row without a word counts the texts
                    [pa.concat_arrays([words.cast(pa.string()), pa.nulls(1, pa.string())]),
                     pa.array(np.append(n, hi - lo))], ["word", "n"])

    counts = stored(training.select("text").mapInArrow(count, "word string, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    total, distinct, n_texts = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)),
        F.coalesce(F.max(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0))).first()
    words = counts.filter("word IS NOT NULL")
    steps_of = sorted((r[0], r[1]) for r in words.groupBy(F.floor(F.log2("n")).cast("int")).count().collect())
    least, reached = 62, 0
    for step, n in reversed(steps_of):
        reached += n
        if reached > head:
            break
        least = step
    common = words.filter(F.col("n") >= F.lit(1 << least)).toArrow()
    lexicon = spark.sparkContext.broadcast(Lexicon(
        common.column("word").to_pylist(), common.column("n").to_pylist(), n_texts, total, distinct,
        n_words, buckets, size))
    lex = lexicon.value
    start = start_parameters(lex.model_counts(), lex.rest, size=size, buckets=buckets, hidden=hidden, embed=embed)
    model = spark.sparkContext.broadcast(train(training, lexicon, start, rounds=rounds, width=width, steps=steps,
                                               rate=rate))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lex, gru = lexicon.value, ClassGru(model.value)
        row = TaskContext.get().partitionId() << 33
        logs = np.append(np.log10(lex.counts + SMOOTH), 0.0)  # the last: unknown here
        for batch in batches:
            for lo, hi in text_slices(batch.column(2)):
                n = hi - lo
                words, codes, lens = batch_words(batch.column(2).slice(lo, n))
                places = lex.places(words)
                doc = np.repeat(np.arange(n), lens)
                x, y, size_of = lex.tokens(words, codes, lens, places)
                lm = gru.texts(x, y, size_of, width=width, steps=4 * steps) / np.log(10)  # windows only bound the memory
                known = logs[places]
                of_rest = np.where((places >= lex.n_model) | (places < 0), known - lex.rest_log, 0.0)
                add = lambda v: np.bincount(doc, weights=v[codes], minlength=n)
                rare = np.flatnonzero((places < 0)[codes])
                key, times = np.unique(doc[rare] * np.int64(len(words) + 1) + codes[rare], return_counts=True)
                of, code = np.divmod(key, len(words) + 1)
                rest = pa.StructArray.from_arrays([words.take(pa.array(code)).cast(pa.string()),
                                                   pa.array(times.astype(np.int32))], ["word", "times"])
                ends = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), batch.column(0).slice(lo, n), batch.column(1).slice(lo, n),
                     pa.array(size_of), pa.array(add((places >= 0).astype(float)).astype(np.int64) + (lex.n_texts > 0)),
                     pa.array(add(known) + np.log10(lex.n_texts + SMOOTH) - size_of * lex.base_log),
                     pa.array(lm + add(of_rest)), pa.ListArray.from_arrays(pa.array(ends), rest)],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "lm", "rest"])
                row += n

    rows = stored(texts.mapInArrow(
        score, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, lm double, "
               "rest array<struct<word:string,times:int>>"), "lm-rows")
    tail = (rows.select("row", F.inline("rest")).join(words, "word", "left")
            .groupBy("row").agg(
                F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("logs"),
                F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known")))
    none = F.lit(0.0)
    return (rows.drop("rest").join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("logs", none)).alias("base_score"),
        (F.col("lm") + F.coalesce("logs", none)).alias("score")))


def op6_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), hash_remainder("doc_id", 10) == 0)
