"""Relative Lempel-Ziv factors against all windows of the corpus."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patchlens.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, block int, row long, kept string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window=20):
    """rows: (doc_id, text) in order; every word under a window that starts earlier too goes."""
    seen, out = set(), []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone[i:i + window] = [True] * window
            seen.add(w)
        out.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=repr)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(d, t, 7, 7, "x") for d, t in rows], SCHEMA)
    got = sd.remove_repeated_passages(docs.repartition(3), **how)
    return sorted((tuple(r)[:4] for r in got.collect()), key=repr)


def corpus(n, seed, words=400):
    """Documents of a small vocabulary with passages, copies and near copies between them."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["é́", "　x", "\x00"]
    passages = [[rng.choice(vocabulary) for _ in range(k)] for k in (19, 20, 21, 40, 75)]
    out = []
    for d in range(n):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, max(0, len(p) - 22))
            at = rng.randint(0, len(text))
            text[at:at] = p[a:a + rng.randint(20, 75)]
        if out and rng.random() < 0.25:
            text = WORD.findall(rng.choice(out)[1])
            if text and rng.random() < 0.6:
                text[rng.randrange(len(text))] = "changed"
        out.append((3 * d, rng.choice(["", " ", "\n"]) + "".join(w + rng.choice([" ", "  ", "\n", "\t\x0b", "\r\n", "\x0c"]) for w in text)))
    return out


@pytest.mark.parametrize("block_bytes", [900, 16 << 20])
def test_against_all_windows(spark, block_bytes):
    rows = corpus(160, 1)
    want = plain(rows)
    assert sum(r[2] for r in want) > 1000
    assert found(spark, rows, block_bytes=block_bytes) == want


def test_factors_name_their_places(spark):
    a, b = ([f"{c}{i}" for i in range(30)] for c in "ab")
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(["x"] + a[4:26] + b[3:30] + ["y"]))]
    docs = spark.createDataFrame([(d, t, 7, 7, "x") for d, t in rows], SCHEMA)
    for block_bytes in (80, 1 << 20):
        got = {r.doc_id: r for r in sd.remove_repeated_passages(docs, block_bytes=block_bytes).collect()}
        assert [tuple(f)[:2] for f in got[3].factors] == [(1, 22), (23, 27)]
        assert got[3].kept == "x y" and got[1].factors == [] and got[2].n_removed == 0
    assert [tuple(f) for f in got[3].factors] == [(1, 22, 0, 4), (23, 27, 0, 33)]


def test_windows_over_a_factor_boundary(spark):
    """The middle of the last text lies half in each source, and once in a third one."""
    a, b = ([f"{c}{i}" for i in range(25)] for c in "ab")
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(["s"] + a[13:] + b[:12] + ["t"])), (4, " ".join(a + b))]
    assert found(spark, rows, block_bytes=60) == plain(rows)


def test_a_passage_in_a_third_and_a_document_in_a_third_of_all(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(24))
    rows = [(d, " ".join(f"u{rng.random()}" for _ in range(5)) + " " + (passage if d % 3 == 0 else "") + " tail")
            for d in range(150)] + [(1000 + d, " ".join(f"c{i}" for i in range(45))) for d in range(75)]
    assert found(spark, rows, block_bytes=700) == plain(rows)


def test_repeats_inside_a_document(spark):
    rows = [(1, "a " * 19), (2, "a " * 20), (3, "a " * 57), (4, "a b " * 40), (5, "b a " * 10 + "c")]
    assert found(spark, rows, block_bytes=50) == plain(rows)


def test_defined_cases(spark):
    long = " ".join(f"l{i}" for i in range(60_000))
    text = " ".join(f"n{i}" for i in range(30))
    rows = [(None, text), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, text), (5, long), (6, "z " + long),
            (7, "x" * 300_000), (7, "x" * 300_000)]
    assert found(spark, rows, block_bytes=1000) == plain(rows)
    same = [(9, text)] * 40  # one doc_id with every row: all but one go whole
    got = found(spark, same, block_bytes=300)
    assert got == plain(same) and sum(r[2] for r in got) == 39 * 30
    assert found(spark, []) == []


def test_words_of_any_slices(monkeypatch):
    texts = [t for _, t in corpus(40, 5)] + ["", "x" * 99, "é" * 40, " a", "b "]
    whole = sd.Words(pa.chunked_array([texts[:7], texts[7:]]))
    monkeypatch.setattr(sd, "SLICE", 16)
    monkeypatch.setattr(sd, "_POWERS", {})
    sliced = sd.Words(pa.array(texts))
    for name in ("starts", "ends", "hashes", "firsts", "doc"):
        assert (getattr(whole, name) == getattr(sliced, name)).all()
    data = "".join(texts).encode()
    words = [w for t in texts for w in t.encode().split()]
    assert [data[s:e] for s, e in zip(whole.starts, whole.ends)] == words
    assert len(set(zip(words, whole.hashes.tolist()))) == len(set(words)) == len(set(whole.hashes.tolist()))


def test_texts_are_not_shuffled_again(spark):
    docs = spark.createDataFrame([(d, t, 7, 7, "x") for d, t in corpus(30, 6)], SCHEMA)
    plan = sd.remove_repeated_passages(docs, block_bytes=500)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2
    for line in plan.splitlines():
        assert "Exchange" not in line or "text#" not in line


def test_every_phrase_holds_its_seed():
    words = sd.Words(pa.array([" ".join(np.random.default_rng(0).integers(0, 50, 300).astype(str))] * 2))
    phrases = sd.Phrases(words, 3)
    assert len(phrases.at) == 2 * 281 and (phrases.seed_of[:281] == phrases.seed_of[281:]).all()
    assert sd.cuts(np.array([0, 5, 1 << 63, (1 << 64) - 1], np.uint64), 2).tolist() == [0, 2, 4]


def test_query_digest(spark):
    docs = spark.createDataFrame([(d, t, 7, 7, "x") for d, t in corpus(20, 8)], SCHEMA)
    row = sd.remove_repeated_passages(docs).select("kept", F.sha2("kept", 256).alias("h")).first()
    import hashlib
    assert row.h == hashlib.sha256(row.kept.encode()).hexdigest()
