"""The pipeline, stage by stage, against plain versions."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline as cp  # noqa: E402
from patchlens.llm.common import table  # noqa: E402
from test_packing import PATH, library  # noqa: E402
from test_secret_links import plain as plain_secrets  # noqa: E402
from test_simhash_golay import plain_groups, plain_print  # noqa: E402

SF = "/root/testdata/sf0.001"


def redacted(text):
    out, end = "", 0
    merged = []
    for _, a, b in sorted(plain_secrets(text)[1], key=lambda f: (f[1], f[2])):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out, end = out + text[end:a] + "[SECRET]", b
    return out + text[end:]


def test_run_equals_plain_version(spark):
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = cp.language(spark, docs, SF)
    assert first.columns == docs.columns
    rows = {d: t for d, t in rows.items() if any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in first.collect()} == set(rows)
    ids = sorted(rows)
    group = plain_groups(ids, [plain_print(rows[d]) for d in ids])
    rows = {d: rows[d] for d, g in zip(ids, group) if d == g}
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    rows = {d: t for d, t in rows.items() if not any(x in t for x in items)}
    rows = {d: redacted(t) for d, t in rows.items()}
    want = dict(zip(rows, library(list(rows.values()))))
    got: dict = {}
    for p in cp.run(spark, SF).collect():
        got.setdefault(p["doc_id"], []).append((p["start"], np.frombuffer(p["ids"], "<u4").tolist()))
    assert {d: [i for _, part in sorted(parts) for i in part] for d, parts in got.items()} == want


def test_odd_rows(spark):
    rows = [(1, None, "en", "s", 0, 1.0), (2, "", "en", "s", 0, 1.0), (3, "the cat and a dog", "en", "s", 17, 1.0),
            (3, "the cat and a dog", "en", "s", 17, 1.0), (None, "password = hunter2222 and words", None, None, None, None)]
    rows += [(i, f"learn these plain words from row {'abcdefgh'[i - 10] * 3} now and then", "en", "s", 0, 1.0) for i in range(10, 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    assert sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in docs.collect() if (r["doc_id"] or 0) < 10), key=repr) == [
        (3, "the cat and a dog", 17), (None, "[SECRET] and words", 18)]


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
