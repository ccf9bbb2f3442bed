"""Template leaks: planted and re-parameterised questions, clean texts, SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from patchlens.llm import template_leaks as tl
from patchlens.llm.common import table

ITEM = ("The baker Tom sells 12 loaves at 3.50 euros to his friend Anna every day. "
        "How many loaves does the baker Tom sell in 7 days to his friend Anna?")
CHANGED = ITEM.replace("Tom", "Bob").replace("Anna", "Mia").replace("12", "40").replace("7", "9")
BROKEN = ITEM.replace("Tom", "Bob", 1)
OTHER = "a plain item of twenty or so words that has no slot in it and nothing to count, only words of a plain sort"
HEAD, TAIL = "some words come before it. ", " and more text, with Names and 99 numbers, follows after it"
TABLE = "1 2 3 4 5 6 7 8 9 10 11 12"
DOCS = [(1, HEAD + ITEM + TAIL), (2, HEAD + CHANGED + TAIL), (3, HEAD + BROKEN), (4, HEAD + TAIL), (5, None), (6, ""),
        (7, ITEM), (7, ITEM), (None, OTHER.upper()), (8, " ".join(OTHER.split()[:10])), (9, TABLE * 50),
        (10, (HEAD + OTHER + ". ") * 300), (11, CHANGED + " " + ITEM)]
BENCH = [(0, ITEM), (0, ITEM), (1, OTHER), (2, TABLE), (3, None), (4, "too short"), (5, "")]


def frames(spark, folder):
    spark.createDataFrame([(*r, 1) for r in DOCS], "doc_id long, text string, item_id int").write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return str(folder), con


def test_cases(spark, tmp_path):
    sf, con = frames(spark, tmp_path / "t")
    got = sorted(map(tuple, tl.op8_template_leaks(spark, sf).collect()), key=repr)
    hits = {(r[0], r[1]): r[5] for r in got}
    assert hits[1, 0] and hits[7, 0] and hits[10, 1] and not hits[2, 0]
    assert set(hits) == {(1, 0), (2, 0), (3, 0), (7, 0), (None, 1), (9, 2), (10, 1), (11, 0)} and len(hits) == len(got)
    assert sorted(con.execute(tl.SQL).fetchall(), key=repr) == got
    shuffled = tl.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"), broadcast_rows=0).drop("text_hash")
    assert sorted(map(tuple, shuffled.collect()), key=repr) == got
    left = tl.drop_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    assert sorted(r["doc_id"] for r in left.collect()) == [4, 5, 6, 8] and left.columns == ["doc_id", "text", "item_id"]


def test_slots_by_window(spark, tmp_path):
    equal = ITEM.replace("12", "9").replace("7", "9")  # two item values, one document value
    split = ITEM.replace("Tom", "Bob", 1).replace("Anna", "Mia", 1)  # equal item values, two document values
    docs = spark.createDataFrame([*DOCS, (20, HEAD + equal), (21, split + TAIL)], "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = tl.find_templates(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {
        (1, 0), (2, 0), (3, 0), (7, 0), (None, 1), (10, 1), (11, 0), (20, 0), (21, 0)}
    found = {r["doc_id"]: r for r in rows}
    assert found[3]["n_windows"] == found[1]["n_windows"] - 3 and not found[3]["verbatim"]  # three windows hold the 'Bob'
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    left = cp.decontamination(spark, docs, str(tmp_path))
    assert not {1, 2, 3, 7, 10, 11, 20, 21} & {r["doc_id"] for r in left.collect()}


def test_every_kind_of_leak(spark, tmp_path):
    """One name of two equal ones changed, two numbers become one, a short item, an item of numbers, a quote, a whole item."""
    words = "zero one two three four five six seven eight nine ten eleven twelve".split()
    long = " ".join(f"{a} {b}" for a in words[:4] for b in words[4:12])[:180]
    bench = [(0, ITEM), (1, "What is 12 plus 30 ?"), (2, TABLE), (3, long), (4, OTHER)]
    docs = [(0, HEAD + BROKEN + TAIL), (1, HEAD + ITEM.replace("12", "9").replace("7", "9")), (2, "so what is 12 plus 30? asked one"),
            (3, "count " + TABLE + " up"), (4, "as " + " ".join(long.split()[5:19]) + " said"), (5, HEAD + OTHER + TAIL),
            (6, HEAD + TAIL), (7, "what is 13 plus 30"), (8, "as " + " ".join(long.split()[5:14]) + " said")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, tl.op8_template_leaks(spark, str(tmp_path)).collect()))
    assert {(r[0], r[1]) for r in got} == {(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 4)}
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert sorted(con.execute(tl.SQL).fetchall()) == got


def test_quotes(spark, tmp_path):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    told = "the old man Karl walked 12 miles to the big town near the sea and " + " ".join(w.replace("w", "v") for w in words[:40])
    bench = [*BENCH, (6, " ".join(words)), (7, "Berlin Paris 7 Rome 8 Oslo 9"), (8, told),
             (9, "x Anna Bob 1 2 Carl 3 4 Dora 5 6 Emil 7 8 Fritz 9 then")]
    docs = [(1, "so " + " ".join(words[20:33]) + " on"), (2, "so " + " ".join(words[20:32]) + " on"),
            (3, "is it Too short?"), (4, "short, too"), (5, "see: " + TABLE + " end"), (6, "1 2 3 4 5 6 7 9 8 10 11 12"),
            (7, "go to berlin, Paris 7 Rome 8 Oslo 9 now"), (8, "go to Berlin Paris 7 Rome 8 Oslo 10"),
            (9, "once the old man Paul walked 15 miles to the big town far off"), (10, "x x x Anna Bob 1 2 Carl 3 4 Dora 5 6 y"),
            (11, "once the old man Paul walked 15 miles to the big town near the hills"), (12, None), (13, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    want = {(1, 6), (3, 4), (5, 2), (7, 7), (10, 9)}
    for rows in (0, 1_000_000):
        got = tl.find_quotes(frame, items, broadcast_rows=rows).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    left = cp.decontamination(spark, frame, str(tmp_path))
    assert {r["doc_id"] for r in left.collect()} == {2, 4, 6, 8, 9, 12, 13}  # 11 has 13 tokens with other slots
    empty = spark.createDataFrame([], "item_id long, text string")
    assert tl.find_quotes(frame, empty).collect() == tl.find_quotes(frame.limit(0), items).collect() == []


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert tl.find_leaks(docs.limit(0), bench).collect() == []
    assert tl.find_leaks(docs, bench.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    got = sorted(map(tuple, tl.op8_template_leaks(spark, sf).collect()))
    items = {r[0]: r[1] for r in table(spark, sf, "benchmark").collect()}
    docs = {r[0]: r[1] for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    planted = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert planted <= {(r[0], r[1]) for r in got}
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert sorted(con.execute(tl.SQL).fetchall()) == got


def test_run_hashes_tell_runs_apart(spark):
    """One hash for each run of n tokens, equal where the tokens are; a step costs a hash of two numbers."""
    words = "a b c a b c d a b a a a a a b c a b c d a b a a a".split()
    sizes = list(range(1, 15))
    df = spark.createDataFrame([(1, words), (2, words[:3]), (3, [])], "k int, t array<string>")
    runs = tl._run_hashes(df, "t", sizes)
    for row in runs.collect():
        for n in sizes:
            want = [tuple(row["t"][i:i + n]) for i in range(len(row["t"]) - n + 1)]
            got = row[f"_runs_{n}"]
            assert len(got) == len(want) and len(set(zip(got, want))) == len(set(got)) == len(set(want))
    assert "slice(t#" not in runs._jdf.queryExecution().optimizedPlan().toString()


def test_words_lower_cased_in_the_text_or_each(spark):
    """Every character between letters, alone and at a word's end."""
    chars = [chr(i) for i in range(1, 0x20000) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(f"Ax{c}Yz {c} B{c} C.{c}Q 1{c}2",) for c in chars], "text string")
    each = F.transform(F.filter(F.regexp_extract_all(F.col("text"), F.lit(tl.TOKEN), F.lit(0)),
                                lambda t: ~t.isin(*tl.MARKS)), lambda t: F.lower(t))
    assert df.select("text", tl._raw().alias("a"), each.alias("b")).filter("a <> b OR a IS NULL").collect() == []
