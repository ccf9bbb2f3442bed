"""Recurrent language model: gradients, probabilities, base scores, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchlens.llm import language_model as lm
from patchlens.llm.common import table
from patchlens.llm.gru import ClassGru, start_parameters, streams


def small():
    p = start_parameters(np.array([5, 9, 4, 3, 2, 1, 1]), 6, size=3, buckets=2, hidden=4, embed=3)
    rng = np.random.default_rng(0)
    return {k: (v + 0.3 * rng.normal(size=v.shape) if k != "word_b" else v).astype(np.float32) for k, v in p.items()}


def test_probabilities_sum_to_one():
    model = ClassGru(small())
    x = np.array([[0], [3], [10]])
    total = 0.0
    for target in range(10):  # six words and the end in classes of three; two empty places; the other class
        total += np.exp(model.window(x, np.array([[-1], [-1], [target]]), np.zeros((1, 4), np.float32))[0][2, 0])
    assert total == pytest.approx(1, abs=1e-5)


def test_gradients():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 11, (5, 3)), rng.integers(0, 7, (5, 3))
    y[rng.random((5, 3)) < 0.3] = 9
    y[4, 2] = -1
    start = {k: v.astype(np.float64) for k, v in small().items()}
    h = rng.normal(size=(3, 4))
    caught = {}
    model = ClassGru(start)
    model._step = lambda grad, rate: caught.update(grad)
    model.window(x, y, h, learn=1.0)

    def loss(p):
        return -ClassGru(p).window(x, y, h)[0].sum() / (y >= 0).sum()

    for k, v in start.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in v.shape)
            if v[at] < -1e8:
                continue
            up, down = ({**start, k: v.copy()} for _ in range(2))
            up[k][at] += 1e-3
            down[k][at] -= 1e-3
            assert caught[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-3, abs=3e-4)


def test_streams_that_ended_are_left_out():
    """One long text beside short ones: its windows hold its stream alone, in training too."""
    rng = np.random.default_rng(2)
    lens = np.array([400, *[5] * 60])
    ids = rng.integers(1, 7, lens.sum())
    ids[np.cumsum(lens) - 1] = 0
    model = ClassGru(small())
    cells, window = [], model.window
    model.window = lambda x, *rest: cells.append(x.size) or window(x, *rest)
    got = model.texts(ids, ids, lens, width=31, steps=8)
    assert sum(cells) < 2 * lens.sum()  # 401 x 31 before
    alone = [ClassGru(small()).texts(part, part, np.array([len(part)]), width=1, steps=8)[0]
             for part in np.split(ids, np.cumsum(lens)[:-1])]
    assert got == pytest.approx(alone, rel=1e-5)
    cells.clear()
    model.texts(ids, ids, lens, width=31, steps=8, learn=0.01)
    assert sum(cells) < 2 * lens.sum()


def test_ended_streams_change_no_gradient():
    rng = np.random.default_rng(3)
    x, y = rng.integers(1, 9, (6, 4)), rng.integers(0, 10, (6, 4))
    x[:, [0, 2]], y[:, [0, 2]] = 0, -1
    h = rng.normal(size=(4, 4)).astype(np.float32)
    h[[0, 2]] = 0
    caught, lanes = [], np.array([1, 3])
    for some in (False, True):
        model = ClassGru(small())
        model._step = lambda grad, rate: caught.append({k: v.copy() for k, v in grad.items()})
        if some:
            model.window(x[:, lanes], y[:, lanes], h[lanes], 1.0, lanes, 4)
        else:
            model.window(x, y, h, 1.0)
    for k in caught[0]:
        assert np.allclose(caught[0][k], caught[1][k], atol=1e-7)


def test_streams_keep_texts_whole():
    stream, place, longest = streams(np.array([5, 1, 7, 2, 2]), 3)
    spots = {(s, p + k) for s, p, n in zip(stream, place, [5, 1, 7, 2, 2]) for k in range(n)}
    assert len(spots) == 17 and longest == 7


def test_score_does_not_depend_on_the_batch():
    model = ClassGru(small())
    a, b = np.array([3, 10, 4, 0]), np.array([1, 2, 0])
    both = model.texts(np.concatenate([a, b, a]), np.concatenate([np.minimum(a, 9), b, np.minimum(a, 9)]),
                       np.array([4, 3, 4]), width=2, steps=2)
    alone = model.texts(a, np.minimum(a, 9), np.array([4]), width=1, steps=8)
    assert both[0] == pytest.approx(alone[0], abs=1e-4) and both[2] == pytest.approx(alone[0], abs=1e-4)


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows]
    c = Counter()
    for (_, t), h in zip(rows, held):
        if not h:
            c.update([*split(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for (d, t), h in zip(rows, held):
        tokens = [*split(t), None]
        out.append((d, h, len(tokens), sum(c[w] > 0 for w in tokens), n,
                    sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)))
    return sorted(out, key=repr)


def compare(got, rows):
    mine = sorted((tuple(r)[:6] for r in got), key=lambda r: repr(r[:5]))
    want = sorted(plain(rows), key=lambda r: repr(r[:5]))
    assert [r[:5] for r in mine] == [r[:5] for r in want]
    assert sorted(r[5] for r in mine) == pytest.approx(sorted(r[5] for r in want), abs=1e-6)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


@pytest.mark.parametrize("head", [0, 3, 1 << 17])
def test_cases(spark, head):
    rows = [(i, "The cat\tsat on the mat \x1c é É") for i in range(40)] + [
        (50, None), (51, ""), (52, " \n "), (3, "twice"), (3, "twice"), (None, "the unseen"), (53, "the " * 9000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    compare(lm.score_texts(docs, held, head=head, n_words=8, size=3).collect(), rows)
    assert lm.score_texts(docs.limit(0), held).collect() == []
    assert len(lm.score_texts(docs, F.lit(True)).collect()) == len(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = lm.op6_gru_scores(spark, sf).collect()
    compare(got, rows)
    held = [r for r in got if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    print("held-out gain, log10 a token:", gain)
    assert gain > 0.02


def test_training_looks_up_the_models_words_alone():
    import pyarrow as pa
    lex = lm.Lexicon(["a", "b", "c", "d"], [9, 7, 5, 3], 2, 30, 9, n_words=3, buckets=4, size=2)
    words, codes, lens = lm.batch_words(pa.array(["  b a", "", "d  c a\t", "zz b "]))
    assert [words[int(c)].as_py() for c in codes] == ["b", "a", "d", "c", "a", "zz", "b"] and lens.tolist() == [2, 0, 3, 2]
    few, every = lex.places(words, model_only=True), lex.places(words)
    assert set(few.tolist()) == {-1, 0, 1} and set(every.tolist()) == {-1, 0, 1, 2, 3}
    for a, b in zip(lex.tokens(words, codes, lens, few), lex.tokens(words, codes, lens, every)):
        assert a.tolist() == b.tolist()
