"""Chat windows: reversible escapes, budgets, each target once."""

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from patchlens.llm import chat_windows as cw
from patchlens.llm.common import table


@given(st.text(alphabet="a\\<[lb|>/s\n]é"))
def test_escape_is_reversible(text):
    safe = cw.escape(text)
    assert cw.unescape(safe) == text and "<" not in safe and "[" not in safe
    assert cw.parse_window(f"<|{cw.escape(text)}|></s>\n<|user|>{safe}</s>\n")[1] == ("user", text)


def plain(rows):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    convs = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=key):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


ROWS = [(1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 3, "user", "x" * 900),
        (1, 4, "assistant", "<|user|>y</s>\n\\l" * 40), (2, 0, "user", "same"), (2, 0, "user", "same"),
        (2, 1, "assistant", "z"), (3, 0, "system", "only"), (4, None, None, "a"), (4, 5, "system", "late"),
        (None, 0, "assistant", "no id"), (None, 1, "assistant", "é🙂")]
ROWS += [(9, i, ("user", "assistant")[i % 2], "w" * random.Random(i).randint(0, 90)) for i in range(60)]


@pytest.mark.parametrize("budget,history", [(1, 0), (30, 10), (60, 30), (512, 128)])
def test_windows(spark, budget, history):
    turns = spark.createDataFrame([(*r, 7) for r in ROWS], "conv_id long, turn long, role string, text string, window_id int")
    made = cw.format_chats(turns, budget=budget, history=history)
    got = {r[0]: tuple(r)[1:5] for r in cw.read_back(made).collect()}
    assert got == plain(ROWS)
    for w in made.collect():
        new = [t for t in w["turns"] if not t["repeated"]]
        assert new and [t["repeated"] for t in w["turns"]] == sorted((t["repeated"] for t in w["turns"]), reverse=True) \
            or w["window_id"] == 0
        assert w["n_tokens"] <= budget or len([t for t in new if t["role"] != "system"]) <= 1
        if w["conv_id"] == 1:
            assert w["text"].startswith("<|system|>be kind</s>")


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cw.read_back(cw.format_chats(none)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = cw.op4_chat_windows(spark, sf).collect()
    assert {r[0]: tuple(r)[1:5] for r in got} == plain(rows) and len(got) == len(plain(rows))
    assert all(r["formatted_chars"] > 0 for r in got)
