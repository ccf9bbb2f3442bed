"""SimHash groups against a brute-force version."""

import random
import re

import numpy as np
import pytest
import xxhash

from patchlens.llm import simhash_golay as sg
from patchlens.llm.common import table
from patchlens.llm.components import components


def plain_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def plain_groups(ids, prints):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(x for x in (least.get(r), d) if x is not None) if (least.get(r), d) != (None, None) else None
    return [least[find(i)] for i in range(len(ids))]


def check(spark, rows, got):
    prints = [plain_print(t) for _, t in rows]
    want = [(d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, plain_groups([d for d, _ in rows], prints))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("width", [21, 22])
def test_words_two_bits_apart_share_a_key(width):
    rng = np.random.default_rng(width)
    a = rng.integers(0, 1 << width, 4000)
    x, y = rng.integers(0, width, 4000), rng.integers(0, width, 4000)
    b = a ^ (1 << x) ^ (1 << y)
    c = a ^ (1 << x)
    for other in (b, c):
        for p, q in zip(sg.segment_keys(a, width), sg.segment_keys(other, width)):
            assert (set(p) & set(q)) - {-1}
    assert max(len(set(p) - {-1}) for p in sg.segment_keys(a, width)) <= 6


@pytest.mark.parametrize("bucket", [1, 64])
def test_links_join_all_near_prints(spark, bucket):
    rng = random.Random(bucket)
    values = set()
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            values.add(v)
            v ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    values |= {0, 1, 3, (1 << 64) - 1, (1 << 63)}
    values = sorted(values)
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    got = {r["node"] & (1 << 64) - 1: r["component"] & (1 << 64) - 1
           for r in components(sg.simhash_links(frame, bucket)).collect()}
    groups = plain_groups(list(range(len(values))), values)
    mine = [got.get(v, v) for v in values]
    assert len(set(zip(groups, mine))) == len(set(groups)) == len(set(mine))


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (4, "one TWO"), (None, "one two"), (None, "Éa b c d"),
            (6, "éa b c d"), (7, "x " * 9000), (8, "X " * 9000), (9, "a\x1cb c\x1fd e"), (10, "a b  c")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, fp int")
    check(spark, rows, sg.simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect())
    kept = sg.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 10, 4, 6, 7, 9, None]
    assert sg.simhash_groups(docs.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    check(spark, rows, sg.op7_simhash_golay(spark, sf).collect())


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7), (200, 200)],
                                  "a long, b long")
    got = dict(map(tuple, components(links).collect()))
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}
    assert components(links.limit(0)).collect() == []
