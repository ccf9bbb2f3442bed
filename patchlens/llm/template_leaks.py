"""Operator 8: benchmark decontamination by template canonicalisation, in DataFrame functions only.

A text becomes its tokens; numbers, names (capitalised words inside a
sentence) and units after a number become typed placeholders, other words are
lower-cased.  Windows of ``window`` canonical tokens are hashed and joined
between documents and benchmark items, so a question is found again when only
its numbers, names or units were changed.  Matching windows of one document and item on
one alignment are folded, and the slots they cover are compared.  A slot contradicts if its value was changed
and the same item value stands for another one elsewhere; windows over such a slot are left out,
the others count.  Two item values may stand for one document value.
A document holds an item if the windows left cover at least ``min_cover`` of the item's, or ``run`` tokens in a row.

Only template windows with at least half plain words count, so tables of numbers match
nothing by shape alone.  Beside the templates, ``find_quotes`` finds items by their raw tokens: ``min_cover`` of an
item's raw windows whatever their slots, ``run`` of its tokens in a row, or the whole of an item shorter than
a window.  A leak is what either finds.

The benchmark's windows are broadcast up to ``broadcast_rows`` rows
(counted first); beyond that the join shuffles both sides.  The join itself
carries positions only: the tokens of documents with a match are read again,
found by their text hashes (MD5), which are broadcast up to the same bound.

Defined cases: null and empty texts match nothing, items without a token neither; texts of any length are
worked on whole, a row at a time; ties do not arise, all leaks are returned; repeated rows (same doc_id and text)
give one result, and so do
repeated items; a null doc_id is reported as null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import broadcast_up_to, stored, table

#: fixed values: units that are placeholders when a number stands before them
UNITS = ("mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "s", "min", "h", "percent", "dollars", "euros", "miles",
         "feet", "inches", "meters", "metres", "kilometers", "grams", "kilograms", "liters", "litres", "seconds",
         "minutes", "hours", "days", "weeks", "months", "years")
TOKEN = r"[\p{L}\p{N}]+([.,][0-9]+)*|[.!?\n]"
WORD = TOKEN.removesuffix(r"|[.!?\n]").replace("(", "(?:")
MARKS = (".", "!", "?", "\n")
NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"


def _is_number(token: Column) -> Column:
    return (token >= "0") & (token < ":")


def _held(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df`` with a column that is computed once per row.  A plain column may be put in place of its name
    by the optimiser, also inside a lambda, and then be computed once per element."""
    return df.select("*", F.explode(F.array(column)).alias(name))


def _typed(df: DataFrame) -> DataFrame:
    """``df`` (text) with ``_typed``: the words of the text, and marker + value for slots."""
    def kind(t: Column, i: Column) -> Column:
        # lambdas are interpreted: the tests that settle most tokens stand first.  Digits and marks lie below the letters
        before = F.get(F.col("_tokens"), i - 1)
        return (F.when(t < "A", F.when(_is_number(t), F.concat(F.lit(NUMBER), t)).otherwise(""))
                .when((before < ":") & (before >= "0") & F.lower(t).isin(*UNITS), F.concat(F.lit(UNIT), F.lower(t)))
                .when(((t < "a") | (t >= "{")) & (i > 0) & (t != F.lower(t)) & ~before.isin(*MARKS)
                      & t.rlike(r"^\p{Lu}\p{Ll}+$"), F.concat(F.lit(NAME), t))
                .otherwise(F.lower(t)))

    df = _held(df, "_tokens", F.regexp_extract_all(F.col("text"), F.lit(TOKEN), F.lit(0)))
    return _held(df, "_typed", F.array_remove(F.transform("_tokens", kind), "")).drop("_tokens")


def _canon(t: Column) -> Column:
    return F.when(t < "\u0004", F.substring(t, 1, 1)).otherwise(t)


def _run_hashes(df: DataFrame, tokens: str, sizes: list[int], of: Callable[[Column], Column] = lambda t: t) -> DataFrame:
    """``df`` with ``_runs_<n>`` for each of ``sizes``: the hashes of all runs of ``n`` tokens, in order (none: empty).

    A run's hash is made of those of two shorter runs that cover it, in steps of powers of two, so that a text
    costs a hash of two numbers a token and step, whatever the length of the runs."""
    def joined(hashes: str, by: int) -> Column:
        return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(F.col(hashes), i + by)))

    df, step = _held(df, "_hash_1", F.transform(tokens, lambda t: F.xxhash64(of(t)))), 1
    while 2 * step <= max(sizes):
        df, step = _held(df, f"_hash_{2 * step}", joined(f"_hash_{step}", step)), 2 * step
    for n in sizes:
        part = 1 << (n.bit_length() - 1)
        name = f"_hash_{part}"
        hashes = F.col(name) if part == n else joined(name, n - part)
        df = _held(df, f"_runs_{n}", F.slice(hashes, 1, F.greatest(F.size(tokens) - n + 1, F.lit(0))))
    return df


def _windows(df: DataFrame, keys: list[str], window: int, least_plain: int = 0) -> DataFrame:
    """(*keys, pos, hash) of the windows of ``_typed`` with ``least_plain`` plain words or more; pos counts from 1."""
    df = _run_hashes(df.filter(F.size("_typed") >= window).select(*keys, "_typed"), "_typed", [window], _canon)
    hashes = F.col(f"_runs_{window}")
    if least_plain:
        hashes = F.transform(hashes, lambda h, i: F.when(F.size(F.filter(
            F.slice("_typed", i + 1, window), lambda t: t >= "\u0004")) >= least_plain, h))
    return (df.select(*keys, F.posexplode(hashes).alias("pos", "hash")).filter(F.col("hash").isNotNull())
            .withColumn("pos", F.col("pos") + 1))


def _text_hash() -> Column:
    return F.unhex(F.md5("text"))


def _item() -> Column:
    return F.xxhash64("item_id", "text").alias("item")


def find_templates(docs: DataFrame, benchmark: DataFrame, *, window: int = 8, min_cover: float = 0.4, run: int = 13,
                   broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, text_hash, item, item_id, n_windows, item_windows, verbatim) of documents that hold an item's template."""
    in_a_row = F.exists("places", lambda p: F.size(
        F.array_intersect("places", F.sequence(p, p + (run - window)))) == run - window + 1)
    items = stored(_typed(benchmark.select("item_id", "text").distinct()).select(_item(), "item_id", "_typed"), "leak-items")
    wanted = stored(_windows(items, ["item"], window, -(-window // 2))
                    .groupBy("item", "hash").agg(F.min("pos").alias("item_pos")), "leak-windows")
    sizes = wanted.groupBy("item").agg(F.count(F.lit(1)).alias("item_windows"))
    near = broadcast_up_to(wanted, broadcast_rows)

    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).withColumn("text_hash", _text_hash())
    hits = (_windows(_typed(texts), ["doc_id", "text_hash"], window).join(near, "hash")
            .groupBy("doc_id", "text_hash", "item", (F.col("pos") - F.col("item_pos")).alias("shift"))
            .agg(F.collect_set("item_pos").alias("places")))  # at most the windows of the item
    hits = stored(hits.join(sizes, "item"), "leak-hits")

    # a second look at the documents with enough windows, for their slots
    reach = hits.groupBy("doc_id", "text_hash", "item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"),
        F.first("item_windows").alias("m"), F.bool_or(in_a_row).alias("run")).filter(
            (F.col("n") >= F.col("m") * min_cover) | F.col("run"))
    kept = hits.join(reach.select("doc_id", "text_hash", "item").withColumnRenamed("doc_id", "_doc"),
                     ["text_hash", "item"]).filter(F.col("doc_id").eqNullSafe(F.col("_doc"))).drop("_doc")
    some = broadcast_up_to(stored(reach.select("text_hash").distinct(), "leak-texts"), broadcast_rows)
    tokens = _typed(texts.join(some, "text_hash", "left_semi").dropDuplicates(["text_hash"])).select(
        "text_hash", F.col("_typed").alias("doc_tokens"))
    placed = F.filter(F.transform(
        F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (window - 1))))),
        lambda q: F.struct(q.alias("q"), F.get("item_tokens", q.cast("int") - 1).alias("a"),
                           F.get("doc_tokens", (q + F.col("shift")).cast("int") - 1).alias("b"))),
        lambda x: x["a"] < "\u0004")
    checked = kept.join(tokens, "text_hash").join(items.withColumnRenamed("_typed", "item_tokens"), "item")
    checked = _held(checked, "placed", placed)
    pairs = F.transform("placed", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    checked = _held(checked, "slots", F.array_distinct(pairs))
    # a slot contradicts if its value was changed, and the same item value stands for another one elsewhere
    against = F.transform(F.filter("placed", lambda x: (x["a"] != x["b"]) & F.exists(
        "slots", lambda y: (y["a"] == x["a"]) & (y["b"] != x["b"]))), lambda x: x["q"])
    checked = _held(checked, "against", against).withColumn("places", F.filter(
        "places", lambda p: ~F.exists("against", lambda q: (q >= p) & (q < p + window)))).filter(F.size("places") > 0)
    same = F.forall("slots", lambda x: x["a"] == x["b"])
    found = (checked.groupBy("doc_id", "text_hash", "item", "item_id", "item_windows")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n_windows"),
                  F.bool_and(same).alias("verbatim"), F.bool_or(in_a_row).alias("run"))
             .filter((F.col("n_windows") >= F.col("item_windows") * min_cover) | F.col("run")))
    return found.select("doc_id", "text_hash", "item", "item_id", F.col("n_windows").cast("long").alias("n_windows"),
                        "item_windows", "verbatim")


def _raw() -> Column:
    """The words of ``text`` as they stand, lower-cased.  Lower-casing the text or each word is the same but for the
    letters whose lower case depends on their neighbours or is more than a letter, or that the pattern does not know."""
    each = F.transform(F.filter(F.regexp_extract_all(F.col("text"), F.lit(TOKEN), F.lit(0)),
                                lambda t: ~t.isin(*MARKS)), lambda t: F.lower(t))
    odd = F.col("text").rlike(r"[\u0130\u03a3\p{Cn}]")
    return F.when(odd, each).otherwise(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))


def find_quotes(docs: DataFrame, benchmark: DataFrame, *, window: int = 8, min_cover: float = 0.4, run: int = 13,
                broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, text_hash, item, item_id) of documents that hold the words of an item as they stand (case and marks
    aside): ``min_cover`` of its windows, whatever their slots, ``run`` of its tokens in a row, or the whole of an
    item shorter than a window."""
    raw = _raw()
    known = benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).distinct()
    items = stored(_held(known, "_raw", raw).filter(F.size("_raw") > 0).select(
        _item(), "item_id", "_raw"), "quote-items")
    short = F.size("_raw") < window
    lengths = [r[0] for r in items.filter(short).select(F.size("_raw")).distinct().collect()]  # under ``window`` numbers
    hashes = F.col(f"_runs_{window}")
    for n in lengths:
        hashes = F.when(F.size("_raw") == n, F.col(f"_runs_{n}")).otherwise(hashes)
    wanted = stored(_run_hashes(items, "_raw", [window, *lengths]).select("item", F.explode(F.array_distinct(hashes)).alias("hash")).distinct(), "quote-windows")
    sizes = wanted.groupBy("item").agg(F.count(F.lit(1)).alias("m"))

    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).withColumn("text_hash", _text_hash())
    windows = _run_hashes(_held(texts, "_raw", raw).select("doc_id", "text_hash", "_raw"), "_raw", [window, *lengths]).select(
        "doc_id", "text_hash", F.explode(F.concat(*[f"_runs_{n}" for n in (window, *lengths)])).alias("hash"))
    hits = stored(windows.join(broadcast_up_to(wanted, broadcast_rows), "hash").groupBy("doc_id", "text_hash", "item").agg(
        F.size(F.collect_set("hash")).alias("n"), F.count(F.lit(1)).alias("rows")).join(sizes, "item"), "quote-hits")
    covered = F.col("n") >= F.col("m") * min_cover

    # a run of tokens lies in as many windows as it is longer than one
    maybe = hits.filter(~covered & (F.col("rows") > run - window))
    some = broadcast_up_to(stored(maybe.select("text_hash").distinct(), "quote-texts"), broadcast_rows)
    again = texts.join(some, "text_hash", "left_semi").dropDuplicates(["text_hash"])
    doc_runs = _run_hashes(_held(again, "_raw", raw).select("text_hash", "_raw"), "_raw", [run]).select(
        "text_hash", F.col(f"_runs_{run}").alias("doc_runs"))
    item_runs = _run_hashes(items, "_raw", [run]).select("item", F.col(f"_runs_{run}").alias("item_runs"))
    quoted = maybe.join(doc_runs, "text_hash").join(item_runs, "item").filter(F.arrays_overlap("doc_runs", "item_runs"))
    found = hits.filter(covered).select("doc_id", "text_hash", "item").union(quoted.select("doc_id", "text_hash", "item"))
    return found.join(items.select("item", "item_id"), "item").select("doc_id", "text_hash", "item", "item_id").distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, item_windows, coverage, verbatim, quoted): every document that holds or
    quotes a benchmark item.  The first figures are those of the templates (0 where only the quote was found);
    ``text_hash`` tells rows of one doc_id apart."""
    none = F.lit(0).cast("long")
    templates = find_templates(docs, benchmark, **how).withColumn("quoted", F.lit(False))
    quotes = find_quotes(docs, benchmark, **how).select(
        "doc_id", "text_hash", "item", "item_id", none.alias("n_windows"), none.alias("item_windows"),
        F.lit(False).alias("verbatim"), F.lit(True).alias("quoted"))
    both = templates.unionByName(quotes).groupBy("doc_id", "text_hash", "item", "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max("item_windows").alias("item_windows"),
        F.bool_or("verbatim").alias("verbatim"), F.bool_or("quoted").alias("quoted"))
    coverage = F.when(F.col("item_windows") > 0, F.col("n_windows") / F.col("item_windows")).otherwise(0.0)
    return both.select("doc_id", "text_hash", "item_id", "n_windows", "item_windows", coverage.alias("coverage"),
                       "verbatim", "quoted").distinct()


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, broadcast_rows: int = 1_000_000, **how) -> DataFrame:
    """``docs`` without the documents that hold or quote a benchmark item."""
    leaks = find_leaks(docs, benchmark, broadcast_rows=broadcast_rows, **how).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    leaks = broadcast_up_to(stored(leaks, "leak-documents"), broadcast_rows)
    return docs.join(leaks, (F.unhex(F.md5(docs["text"])) == F.col("_hash")) & docs["doc_id"].eqNullSafe(F.col("_id")),
                     "left_anti")


def op8_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash").distinct()


def _sql(window: int = 8, min_cover: float = 0.4, run: int = 13) -> str:
    units = ", ".join(repr(u) for u in UNITS)
    marks = "'.', '!', '?', chr(10)"
    token = TOKEN.replace("'", "''")

    def typed(source: str, keys: str) -> str:
        return f"""
        SELECT {keys}, list_filter(list_transform(range(1, len(t) + 1), lambda i:
            CASE WHEN t[i] IN ({marks}) THEN ''
                 WHEN t[i] >= '0' AND t[i] < ':' THEN chr(1) || t[i]
                 WHEN i > 1 AND t[i-1] >= '0' AND t[i-1] < ':' AND lower(t[i]) IN ({units}) THEN chr(3) || lower(t[i])
                 WHEN i > 1 AND t[i] <> lower(t[i]) AND t[i-1] NOT IN ({marks})
                      AND regexp_matches(t[i], '^\\p{{Lu}}\\p{{Ll}}+$') THEN chr(2) || t[i]
                 ELSE lower(t[i]) END), lambda x: x <> '') AS k,
               list_transform(list_filter(t, lambda x: x NOT IN ({marks})), lambda x: lower(x)) AS raw
        FROM (SELECT DISTINCT {keys}, regexp_extract_all(text, '{token}') AS t FROM {source} WHERE text IS NOT NULL)"""

    windows = f"""list_transform(range(1, len(k) - {window - 2}), lambda i: list_transform(k[i:i+{window - 1}],
                  lambda t: CASE WHEN t < chr(4) THEN t[1] ELSE t END))"""
    return f"""
    WITH i AS MATERIALIZED (SELECT row_number() OVER () AS item, * FROM ({typed('benchmark', 'item_id, text')})),
    d AS MATERIALIZED (SELECT row_number() OVER () AS doc, * FROM ({typed('documents', 'doc_id, text')})),
    iw AS MATERIALIZED (SELECT item, w, min(p) AS p FROM (
            SELECT item, k, unnest({windows}) AS w, unnest(range(1, len(k) - {window - 2})) AS p FROM i)
          WHERE 2 * len(list_filter(k[p:p+{window - 1}], lambda t: t >= chr(4))) >= {window} GROUP BY item, w),
    n AS (SELECT item, count(*) AS item_windows FROM iw GROUP BY item),
    h AS (SELECT doc, item, dw.p - iw.p AS shift, list(DISTINCT iw.p) AS places FROM (
            SELECT doc, unnest({windows}) AS w, unnest(range(1, len(k) - {window - 2})) AS p FROM d) dw
          JOIN iw USING (w) GROUP BY ALL),
    c AS (SELECT doc, item, places, list_filter(list_transform(list_distinct(flatten(list_transform(places,
              lambda p: range(p, p + {window})))), lambda q: {{'q': q, 'a': i.k[q], 'b': d.k[q + shift]}}),
              lambda x: x.a < chr(4)) AS s FROM h JOIN i USING (item) JOIN d USING (doc)),
    a AS (SELECT doc, item, places, s, list_filter(s, lambda x: x.a <> x.b
              AND len(list_filter(s, lambda y: y.a = x.a AND y.b <> x.b)) > 0) AS against FROM c),
    w AS (SELECT doc, item, s, list_filter(places, lambda p: len(list_filter(against,
              lambda x: x.q >= p AND x.q < p + {window})) = 0) AS places FROM a),
    g AS (SELECT doc, item, len(list_distinct(flatten(list(places)))) AS n_windows,
              bool_and(len(list_filter(s, lambda x: x.a <> x.b)) = 0) AS verbatim,
              bool_or(len(list_filter(places, lambda p: len(list_filter(places, lambda o: o >= p AND o <= p + {run - window}))
                  = {run - window + 1})) > 0) AS run FROM w WHERE len(places) > 0 GROUP BY doc, item),
    tm AS (SELECT g.*, item_windows FROM g JOIN n USING (item) WHERE n_windows >= {min_cover} * item_windows OR run),
    qi AS MATERIALIZED (SELECT DISTINCT item, unnest(CASE WHEN len(raw) < {window} THEN [raw] ELSE list_transform(
              range(1, len(raw) - {window - 2}), lambda p: raw[p:p+{window - 1}]) END) AS w FROM i WHERE len(raw) > 0),
    sizes AS (SELECT {window} AS z UNION SELECT DISTINCT len(raw) FROM i WHERE len(raw) > 0 AND len(raw) < {window}),
    qd AS (SELECT DISTINCT doc, unnest(list_transform(range(1, len(raw) - z + 2), lambda p: raw[p:p+z-1])) AS w
           FROM d, sizes WHERE len(raw) >= z),
    covered AS (SELECT doc, item FROM (SELECT doc, item, count(*) AS n FROM qd JOIN qi USING (w) GROUP BY ALL)
                JOIN (SELECT item, count(*) AS m FROM qi GROUP BY item) USING (item) WHERE n >= {min_cover} * m),
    ri AS (SELECT DISTINCT item, unnest(list_transform(range(1, len(raw) - {run - 2}), lambda p: raw[p:p+{run - 1}])) AS w FROM i),
    rd AS (SELECT DISTINCT doc, unnest(list_transform(range(1, len(raw) - {run - 2}), lambda p: raw[p:p+{run - 1}])) AS w FROM d),
    qu AS (SELECT doc, item, true AS quoted FROM (SELECT * FROM covered UNION SELECT doc, item FROM rd JOIN ri USING (w)))
    SELECT DISTINCT doc_id, item_id, coalesce(n_windows, 0) AS n_windows, coalesce(item_windows, 0) AS item_windows,
           coalesce(n_windows / item_windows, 0) AS coverage, coalesce(verbatim, false) AS verbatim,
           coalesce(quoted, false) AS quoted
    FROM tm FULL JOIN qu USING (doc, item) JOIN i USING (item) JOIN d USING (doc)"""

SQL = _sql()
