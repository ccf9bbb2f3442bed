"""Language ID: held-out accuracy, the backoff rule, and odd rows."""

import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patchlens.llm import language_id as li
from patchlens.llm.common import table


def test_words_are_letter_runs():
    found = li.Words(pa.array(["", "Ab-c1Éß", "ab", " . ", "日本x"]))
    assert [(int(d), found.values[c]) for d, c in zip(found.doc, found.codes)] == [
        (1, "ab"), (1, "c"), (1, "éß"), (2, "ab"), (4, "日本x")]


def test_backoff_order():
    model = li.Model(["a", "b"], [0.5, 0.5], {"a": {"known": 3}}, {
        4: {"a": {"_kno": 2}}, 3: {"b": {"_zz": 5}}, 1: {"b": {"q": 1}}})
    assert model.vector("known") == model.words["known"]
    assert model.vector("knots") == model.grams[0]["_kno"]
    assert model.vector("zz") == model.grams[1]["_zz"]
    assert model.vector("xq") == model.grams[3]["q"]
    assert model.vector("xx") == (0.0, 0.0)


def test_odd_rows(spark):
    rows = [(i, w, g) for i in range(30) for w, g in (("the cat and the dog", "en"), ("der hund und die katze", "de"))]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 !?", "de"), (None, "the dog", None), (103, "ЖЖЖ", None),
             (104, "der die " * 20000, None), (105, "the", None), (105, "the", None)]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = li.identify_languages(docs, F.lit(False)).collect()
    assert len(got) == len(rows)
    pred = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in got}
    assert pred[100, None] == pred[101, ""] == pred[102, "12 !?"] == ("und", 0.0)
    assert pred[None, "the dog"][0] == pred[105, "the"][0] == "en"
    assert pred[104, "der die " * 20000][0] == "de" and pred[103, "ЖЖЖ"][0] in ("de", "en")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert li.identify_languages(docs.limit(0), F.lit(False)).collect() == []
    assert {r["lang_pred"] for r in li.identify_languages(docs, F.lit(True)).collect()} == {"und"}


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_held_out_accuracy(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents").select("doc_id", "lang")
    got = li.op10_language_id(spark, f"/root/testdata/{sf}").join(docs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97


@pytest.mark.parametrize("english", [12, 60])  # below and above half of the labelled rows
def test_rejection_does_not_depend_on_label_shares(spark, english):
    import corpus_pipeline as cp

    rows = [(i, "the cat and the dog sat on the mat", "en") for i in range(english)]
    rows += [(100 + i, "der hund und die katze sassen auf der matte", "de") for i in range(12)]
    rows += [(200 + i, "le chat et le chien sont assis sur le tapis", "fr") for i in range(12)]
    rows += [(900, "все люди рождаются свободными", None), (901, "xqz vkwj zzgf qpxw jjkv", None), (902, "12 !?", None),
             (903, "日本語の文章", None), (904, "the dog and a cat", None), (905, "der hund", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = cp.language(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {900, 901, 902, 903}
    got = li.identify_languages(docs, F.lit(False), evidence=True).collect()
    assert all(r["known"] == r["margin"] == 0 for r in got if r["doc_id"] in (900, 902, 903))


def test_known_part_of_words():
    model = li.Model(["a"], [1.0], {"a": {"word": 3}}, {4: {"a": {"_kno": 2}}, 2: {"a": {"日本": 1, "_日": 1}}})
    assert [model.known(w) for w in ("word", "kno", "x", "日本語", "ж")] == [1.0, 0.5, 0.0, 0.5, 0.0]


def test_ngrams_are_counted_in_parts(spark, monkeypatch):
    rows = [(i, f"{'abcdefgh'[i % 8]}a tree by the {'xyz'[i % 3]}ea {i}", "en" if i % 2 else "pl") for i in range(60)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = []
    for terms in (2_500, 2):
        monkeypatch.setattr(li, "TERMS", terms)
        models.append(li.learn(labelled, sample_docs=100, words=50, n_grams=40))
    assert models[0].words == models[1].words and models[0].grams == models[1].grams
