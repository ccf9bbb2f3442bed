"""Packing: every id in exactly one piece, sequences gapless, full or a power of two."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from patchlens.llm import packing
from patchlens.llm.common import table, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def library(texts):
    from tokenizers import Tokenizer
    return [[*e.ids, 1] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def checked(rows, pieces, window):
    """rows: (doc_id, text) with distinct doc_ids."""
    ids = {d: x for (d, _), x in zip(rows, library([t or "" for _, t in rows]))}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        d = p.asDict()
        part = ids[d["doc_id"]][d["start"]:d["start"] + d["length"]]
        assert len(part) == d["length"] > 0 and d["doc_tokens"] == len(ids[d["doc_id"]])
        assert d["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        by_doc[d["doc_id"]].append((d["start"], d["length"]))
        by_seq[d["sequence_id"]].append((d["offset"], d["length"]))
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(ids[d])
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == window or (at < window and at & (at - 1) == 0)
    return by_seq


@pytest.mark.parametrize("window,heavy", [(16, 4), (64, 0), (2048, 96)])
def test_random_texts(spark, window, heavy):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(window)
    rows = [(i, " ".join(["the"] * int(n))) for i, n in enumerate(rng.integers(0, 3 * min(window, 100), 300))]
    rows += [(400, None), (401, ""), (402, "a b " * 3000)] + [(i, "same five words are here") for i in range(500, 600)]
    docs = spark.createDataFrame([(*r, 3, 4) for r in rows], "doc_id long, text string, task int, ids int")
    got = packing.pack_documents(docs.repartition(7), PATH, window=window, heavy=heavy).select(
        "*", F.crc32("ids").alias("ids_crc32")).collect()
    checked(rows, got, window)


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "d"), (None, None)], "doc_id long, text string")
    got = packing.pack_documents(docs, PATH, window=8).collect()
    assert sum(r["length"] for r in got) == 4 + 4 + 2 + 1
    assert sum(r["length"] for r in got if r["doc_id"] is None) == 3


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_solver_finds_the_exact_repeats():
    counts = np.zeros(64, np.int64)
    counts[[40, 24, 30, 4]] = [10, 10, 6, 3]
    plan = packing.Plan(counts, 64, 8)
    assert plan.sequences == 13 and plan.rest == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    checked(rows, packing.op2_nnls_packing(spark, sf).collect(), 2048)


def test_small_slices_pack_the_same(spark):
    rng = np.random.default_rng(5)
    words = ["sun", "Moon", "x" * 30, "straße", "12", "it's"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    whole, cut = (sorted(map(tuple, packing.pack_documents(docs, PATH, window=64, slice_bytes=n).collect()))
                  for n in (16 << 20, 200))
    assert whole == cut and len(whole) >= 120


def test_encoding_takes_little_memory():
    import tracemalloc

    import pyarrow as pa

    from patchlens.llm.word_tokens import WordEncoder
    enc = WordEncoder(PATH)
    texts = pa.array(["the cat sat on the mat " * 200] * 300)
    enc.encode(texts.slice(0, 1))
    tracemalloc.start()
    ids, n = enc.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.sum() == len(ids) and n.tolist() == [n[0]] * 300
    assert peak < 36 * len(ids)  # bytes an id, of one-id words; 40 before
