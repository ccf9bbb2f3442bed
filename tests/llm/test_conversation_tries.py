"""The conversation trie against a dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from patchlens.llm import conversation_tries as ct

SCHEMA = "conv_id long, turn long, role string, text string, codes int, seq string"


def rows_of(convs):
    return [(c, i, r, t, 1, "x") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]


def sequences(rows):
    out = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out[c].append((turn is not None, turn or 0, digest, role, text))
    return {c: [(r, t) for *_, r, t in sorted(v)] for c, v in out.items()}


def borrowed(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain(own):
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * words
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids.get(p, ())), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(own[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def found(spark, rows, borrow=True, **how):
    convs = ct.coded_conversations(spark.createDataFrame(rows, SCHEMA))
    nodes = ct.prefix_trie(ct.with_borrowed_turns(convs) if borrow else convs, **how)
    return sorted(tuple(-1 if v is None else v for v in r) for r in nodes.collect())


def conversations(n, seed, words="a b c", longest=7):
    rng = random.Random(seed)
    out = {}
    for c in rng.sample(range(4 * n), n):
        out[c] = [(rng.choice(["user", "assistant"]), " ".join(rng.choices(words.split(), k=rng.choice([1, 1, 2]))))
                  for _ in range(rng.randint(1, longest))]
    return out


@pytest.mark.parametrize("shard_turns", [20, 1 << 17])
def test_against_a_dictionary_of_prefixes(spark, shard_turns):
    rows = rows_of(conversations(150, 1))
    assert found(spark, rows, shard_turns=shard_turns, least_turns=64) == plain(borrowed(sequences(rows)))


def test_one_sequence_with_a_third_of_all_and_a_common_first_turn(spark):
    convs = conversations(120, 2, longest=4)
    for i, c in enumerate(sorted(convs)):
        convs[c] = [("system", "be brief")] + (convs[c] if i % 3 else [("user", "hello there"), ("assistant", "hi")])
    rows = rows_of(convs)
    got = found(spark, rows, borrow=False, shard_turns=16, id_block=7)
    assert got == plain(sequences(rows))
    assert max(r[3] for r in got if r[1] == 3) >= 40


def test_defined_cases(spark):
    rows = rows_of(conversations(30, 3)) + [
        (None, 0, "user", "gone", 1, "x"), (500, None, "user", "first", 1, "x"), (500, 2, None, None, 1, "x"),
        (500, 2, "user", "tie", 1, "x"), (500, 2, "user", "tie", 1, "x"), (500, -3, "user", "", 1, "x"),
        (501, 0, "user", "  one\x0btwo 　", 1, "x"), (502, 0, "user", "w " * 50_000, 1, "x"),
        (503, 0, "user", "w " * 50_000, 1, "x"), (-40, 0, "user", "a", 1, "x")]
    assert found(spark, rows) == plain(borrowed({c: t for c, t in sequences(rows).items() if c >= 0} | {-40: [("user", "a")]}))


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(20, 400) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    rows = [(c, 0, "user", "a", 1, "x")]  # its source is absent and its own first three turns go
    assert found(spark, rows) == [(c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert found(spark, []) == []


def test_a_long_conversation_over_shard_edges(spark):
    deep = [("user", f"t{i}") for i in range(90)]
    convs = {i: deep[: 90 - i] + [("user", f"end {i}")] for i in range(6)} | {9: deep}
    rows = rows_of(convs)
    assert found(spark, rows, borrow=False, shard_turns=100) == plain(sequences(rows))


def test_tree_finds_what_was_inserted_by_medians():
    rng = random.Random(4)
    seqs = sorted({tuple(rng.choices(range(40), k=rng.randint(0, 5))) for _ in range(300)})
    assert sorted(ct.by_medians(len(seqs))) == list(range(len(seqs)))
    tree = ct.TernaryTree()
    for i in ct.by_medians(len(seqs)):
        tree.insert(seqs[i], [1] * len(seqs[i]), i, 1, str(i))
    for i, s in enumerate(seqs):
        path = tree.path(s)
        assert len(path) == len(s) + 1 and tree.ends[path[-1]] == str(i)
    depth, at = 0, [tree.eq[0]]  # the root's 40 children hang balanced: far from a chain
    while at:
        at, depth = [x for v in at for x in (tree.lo[v], tree.hi[v]) if x], depth + 1
    assert depth <= 16


def test_hash_ends_streams_runs_over_batches():
    import pyarrow as pa

    def batch(*pairs):
        return pa.RecordBatch.from_pydict({"seq": pa.array([p[0] for p in pairs], pa.binary()),
                                           "ids": pa.array([p[1] for p in pairs], pa.string())})

    got = [r for b in ct.hash_ends(iter([batch((b"a", "1,2"), (b"b", "3")), batch((b"b", "4"), (b"b", "5"))])) for r in b.to_pylist()]
    assert [r["ends"] for r in got] == [hashlib.sha256(s).hexdigest() for s in (b"1,2", b"3,4,5")]
