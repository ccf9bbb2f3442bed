"""Token planes: exact round trip against the library on whole texts."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from patchlens.llm import token_planes as tp
from patchlens.llm.common import scratch_folder, table, tokenizer_path
from patchlens.llm.word_tokens import WordEncoder

PATH = tokenizer_path("word_bpe_49k.json")
ODD = ["", " ", "\n\t ", "Hello, World's don't I'LL 'TIS", "a\x1cb c\x1f", "x y z", "<|endoftext|> b<|startoftext|>",
       "<|ENDOFTEXT|> q", "ÀÉß straße ΣΟΦΟΣ ὈΔΥΣΣΕΎΣ", "é ́x", "1234 ½ ² 3.14%", "日本語 テキスト", "🙂🙂 ok", "a" * 5000,
       "'s't're--'s x''s", "İstanbul ǅ ŉ", "Ω Å K", "tab\tsep\vvt\fff\rcr"]


def library(texts):
    from tokenizers import Tokenizer
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_library():
    enc = WordEncoder(PATH)
    for texts in (ODD, ODD[::-1], [t for t in ODD if "<|" not in t]):
        ids, n = enc.encode(pa.array(texts, pa.string()))
        assert [p.tolist() for p in np.split(ids, np.cumsum(n)[:-1])] == library(texts)


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1003, dtype=np.uint64).astype(np.uint32)
    lens = np.array([0, 1, 1000, 2])
    image = tp.pack_shard(np.array([5, 0, -3, 9]), np.array([1, 0, 1, 1], bool), lens, ids, 64, bits, 3)
    doc_ids, known, got, back = tp.unpack_shard(image)
    assert doc_ids.tolist() == [5, 0, -3, 9] and known.tolist() == [True, False, True, True]
    assert got.tolist() == lens.tolist() and (back == ids).all()
    damaged = bytearray(image)
    damaged[-3] ^= 1
    with pytest.raises(Exception):
        tp.unpack_shard(bytes(damaged))


def expected(rows, end_id=2):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at, out = 0, []
    for (doc_id, _), ids in zip(rows, library([t or "" for _, t in rows])):
        ids = [*ids, end_id]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_write_and_read(spark, planes):
    rows = [(i * 7 % 40, t) for i, t in enumerate(ODD)] + [(3, None), (None, "no id"), (3, "same"), (3, "same")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, segment int")
    path = scratch_folder(spark, "t")
    tp.write_token_planes(docs, path, PATH, planes=planes, block_ids=16, shard_ids=64)
    from pyspark.sql import functions as F
    got = tp.read_token_planes(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)


def test_empty_table(spark):
    path = scratch_folder(spark, "t")
    tp.write_token_planes(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert tp.read_token_planes(spark, path).collect() == []


def test_query_equals_library(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = tp.op1_token_planes(spark, sf).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)
