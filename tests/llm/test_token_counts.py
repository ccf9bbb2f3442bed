"""Token counts against the library on whole texts."""

import numpy as np
import pyarrow as pa
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from patchlens.llm import token_counts as tc
from patchlens.llm.common import table, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
RULE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ODD = ["", " ", "  ", "\n\n a", "a  b", "a \n b\n", "don't I'll 's 'sx --'s we've've a's's 'l 'll'", "x<|endoftext|>y <|endoftext|>",
       "<|endoftext|>", "é à ß 日本 語１２", "🙂 🙂🙂'd", "tab\t\tx ", " lead", "1a2b 33 ½²", "a b　c", "'", "''s"]


def library(texts):
    from tokenizers import Tokenizer
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def cut(texts):
    full = [t.encode() for t in texts if t]
    data = np.frombuffer(b"".join(full), np.uint8)
    sizes = np.array([len(b) for b in full])
    if not full:
        return []
    at = [*tc.pre_token_starts(data, np.cumsum(sizes) - sizes), len(data)]
    return [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="a bs'tréLl \n\tvem1½-.🙂日", max_size=14), max_size=4))
def test_pre_tokens_follow_the_rule(texts):
    assert cut(texts) == [m for t in texts for m in RULE.findall(t)]


def test_counts_equal_library(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(0, "twice"), (0, "twice"), (None, "n"), (7, None)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, row int, piece string")
    want = sorted(((d, len((t or "").encode()), n) for (d, t), n in zip(rows, library([t or "" for _, t in rows]))),
                  key=repr)
    for head in (0, 5, 1 << 17):
        got = sorted(map(tuple, tc.count_tokens(docs, PATH, head=head).collect()), key=repr)
        assert got == want


def test_empty_table(spark):
    assert tc.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_query_equals_library(spark):
    sf = "/root/testdata/sf0.001"
    rows = table(spark, sf, "documents").select("doc_id", "text").collect()
    want = {(r[0], len((r[1] or "").encode()), n, n > 512) for r, n in zip(rows, library([r[1] or "" for r in rows]))}
    got = tc.op5_token_counts(spark, sf).collect()
    assert len(got) == len(rows) and set(map(tuple, got)) == want


def test_texts_longer_than_a_slice(spark):
    texts = ["ab cd 12, " * 300_000, "", "x" * 5_000, "ab cd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(texts[0]) > tc.SLICE
    got = [r.n_tokens for r in tc.count_tokens(docs, PATH).orderBy("doc_id").collect()]
    assert got == library(texts)
