"""Operator 3: secret scan with multipart credential linking, in DataFrame functions only.

Base spans are found in every whole text, leftmost and non-overlapping per kind.
Besides, weak candidates are looked for: short access identifiers, forty-character
keys of mixed letters and digits, and endpoints.  One of them alone says
little, so it is reported only when a complementary part lies within
``scope`` characters: a key beside an identifier, an identifier beside a
secret, an endpoint beside an identifier or a named secret.  The parts of a
text are joined as intervals: the line is cut into bins of ``scope``
characters, parts are folded per (text, role, bin) to their least start and
greatest end, and a candidate meets the bins its widened interval touches.  So
rows stay in proportion to the parts, however many a text holds.

Positions are code points, ends exclusive.  A text's matches and the pieces
between them give the positions as running sums.

Defined cases: null text is empty; rows with equal or null doc_id are
scanned one by one; texts without a span have zero counts and the digest of
the empty string; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens.llm.common import broadcast_up_to, stored, table, whole_text


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case(
    "api") + "_?" + _either_case("key")
#: kind: (pattern, least length of the match, group whose length counts, conditions on the match)
PATTERNS = {
    "assign": (f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    "access": ("AKIA[A-Z0-9]+", 20, 0),
    "hex": ("[0-9a-f]{24,}", 24, 0),
    "id": ("A[KS]IA[A-Z0-9]{8,}", 12, 0),
    "key": ("[A-Za-z0-9/+]{40,}", 40, 0),
    "endpoint": ("[a-z][a-z0-9+.-]*://[^\\x20\\x09-\\x0D\"'<>]+", 0, 0),
}
BASE, KINDS = ("assign", "access", "hex"), tuple(PATTERNS)
#: complementary roles of a weak candidate
ROLES = {"assign": "named", "access": "identifier", "hex": "secret", "id": "identifier", "key": "secret"}
NEEDS = {"id": ("named", "secret"), "key": ("identifier",), "endpoint": ("identifier", "named")}


def _found(kind: str) -> Column:
    """Array of (piece before, match, counted length, fits) of a kind; null when there is no match."""
    pattern, least, group = PATTERNS[kind]
    text = F.col("text")
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else match
    piece = F.transform(F.split(text, pattern, -1), F.length)

    lens = F.transform(match, F.length)
    sizes = F.transform(counted, F.length)
    if kind == "id":  # what the base kind reports is not a weak candidate
        fits = F.transform(match, lambda m: (F.length(m) >= least) & ~(m.startswith("AKIA") & (F.length(m) >= 20)))
    elif kind == "key":
        fits = F.transform(match, lambda m: (F.length(m) == least) & m.rlike("[0-9]") & m.rlike("[a-z]")
                           & m.rlike("[A-Z]"))
    else:
        fits = F.transform(sizes, lambda n: n >= least)
    return F.when(text.rlike(pattern), F.arrays_zip(piece.alias("gap"), lens.alias("size"), fits.alias("fits")))


def find_spans(docs: DataFrame, *, scope: int = 200) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (row, doc_id), and every reported span (row, kind, start, end, linked)."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    found = stored(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                *[_found(k).alias(k) for k in KINDS]), "secret-matches")
    parts = None
    for kind in KINDS:
        hits = found.select("row", F.posexplode(kind).alias("i", "m"))
        before = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
        hits = hits.select("row", F.lit(kind).alias("kind"), F.col("m.size").alias("size"), F.col("m.fits").alias("fits"),
                           (F.coalesce(F.sum(F.col("m.gap") + F.coalesce("m.size", F.lit(0))).over(before), F.lit(0))
                            + F.col("m.gap")).alias("start")).filter("fits")
        part = hits.select("row", "kind", "start", (F.col("start") + F.col("size")).alias("end"))
        parts = part if parts is None else parts.union(part)
    parts = stored(parts, "secret-parts")

    role = F.element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), F.col("kind"))
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))
    sides = (parts.filter(F.col("kind").isin(list(ROLES)))
             .select("row", role.alias("role"), "start", "end", bins(F.col("start"), F.col("end")).alias("bin"))
             .groupBy("row", "role", "bin").agg(F.min("start").alias("first"), F.max("end").alias("last")))
    needs = F.create_map(*[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    weak = parts.filter(F.col("kind").isin(list(NEEDS))).withColumn("role", F.explode(needs[F.col("kind")]))
    wide = weak.withColumn("bin", bins(F.col("start") - scope, F.col("end") + scope))
    linked = (wide.join(sides, ["row", "role", "bin"])
              .filter((F.col("first") <= F.col("end") + scope) & (F.col("last") >= F.col("start") - scope))
              .select("row", "kind", "start", "end").distinct())
    spans = (parts.filter(F.col("kind").isin(list(BASE))).withColumn("linked", F.lit(False))
             .union(linked.withColumn("linked", F.lit(True))))
    return found.select("row", "doc_id"), spans


def scan_secrets(docs: DataFrame, *, scope: int = 200) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, spans): spans is an array of
    (start, place, kind, end, linked) by start, then kind as listed."""
    rows, spans = find_spans(docs, scope=scope)
    place = F.element_at(F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))]), F.col("kind"))
    per_row = spans.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.array_sort(F.collect_list(F.struct("start", place.alias("place"), "kind", "end", "linked"))).alias("spans"))
    joined = rows.join(per_row, "row", "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in BASE],
                         F.coalesce("spans", F.array()).alias("spans"))


def redact_secrets(docs: DataFrame, *, scope: int = 200, mark: str = "[SECRET]",
                   broadcast_rows: int = 200_000) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark``; texts without one stay as they are.

    Spans that overlap are replaced as one.  The spans of a text go back to it by (doc_id, text),
    so repeated rows are all redacted; they are broadcast up to ``broadcast_rows`` texts, beyond that
    the join shuffles ``docs`` once."""
    key = [F.col("doc_id"), F.xxhash64("text").alias("_hash"), F.length("text").alias("_size")]
    hit = docs.filter(F.col("text").isNotNull())
    texts = hit.select("doc_id", "text").withColumn("_id", F.struct(*key))
    rows, spans = find_spans(texts.select(F.col("_id").alias("doc_id"), "text"), scope=scope)
    w = Window.partitionBy("_id").orderBy("start", "end")
    ids = spans.join(rows, "row").select(F.col("doc_id").alias("_id"), "start", "end").distinct()
    upto = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    blocks = (ids.withColumn("new", (upto.isNull() | (F.col("start") >= upto)).cast("int"))
              .withColumn("block", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("_id", "block").agg(F.min("start").alias("start"), F.max("end").alias("end"))
              .groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cut")))
    blocks = broadcast_up_to(stored(blocks, "secret-blocks"), broadcast_rows)
    n = F.size("_cut")
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_cut.end"), i - 1))
    stop = lambda i: F.when(i == n, F.length("text")).otherwise(F.get(F.col("_cut.start"), i))
    kept = F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(
        F.col("text"), begin(i).cast("int") + 1, (stop(i) - begin(i)).cast("int")))
    joined = docs.withColumn("_id", F.struct(*key)).join(
        blocks.withColumnRenamed("_id", "_cut_id"), F.col("_id").eqNullSafe(F.col("_cut_id")), "left")
    text = F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(kept, mark))
    return joined.withColumn("text", text).select(*docs.columns)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _listed(F.filter("spans", lambda s: ~s["linked"]))
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.col(f"n_{k}").cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(base, 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _sql() -> str:
    quoted = {k: p.replace("'", "''") for k, (p, _, _) in PATTERNS.items()}
    fits = {"assign": "length(g) >= 6", "access": "length(m) >= 20", "hex": "length(m) >= 24",
            "id": "length(m) >= 12 AND NOT (starts_with(m, 'AKIA') AND length(m) >= 20)",
            "key": "length(m) = 40 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') "
                   "AND regexp_matches(m, '[A-Z]')",
            "endpoint": "true"}
    found = " UNION ALL ".join(f"""
      SELECT r, {i} AS place, '{k}' AS kind, m, s AS start, s + length(m) AS stop FROM (
        SELECT r, i, m, g, sum(length(gap)) OVER w + coalesce(sum(length(m)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING), 0) AS s
        FROM (SELECT r, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(gs) AS g, unnest(gaps[:len(ms)]) AS gap
              FROM (SELECT r, regexp_extract_all(t, '{quoted[k]}') AS ms,
                           regexp_extract_all(t, '{quoted[k]}', {PATTERNS[k][2]}) AS gs,
                           regexp_split_to_array(t, '{quoted[k]}') AS gaps FROM d))
        WINDOW w AS (PARTITION BY r ORDER BY i)) WHERE {fits[k]}""" for i, k in enumerate(KINDS))
    need = " OR ".join(f"(a.kind = '{k}' AND b.kind IN ({', '.join(repr(x) for x, role in ROLES.items() if role in v)}))"
                       for k, v in NEEDS.items())
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)"
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    p AS MATERIALIZED ({found}),
    s AS (SELECT r, place, kind, start, stop, false AS linked FROM p WHERE kind IN ('assign', 'access', 'hex')
          UNION ALL
          SELECT DISTINCT a.r, a.place, a.kind, a.start, a.stop, true FROM p a JOIN p b ON a.r = b.r AND ({need})
           AND b.start <= a.stop + 200 AND b.stop >= a.start - 200),
    g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 {listed[:-1]}) FILTER (NOT linked) AS base, {listed} AS spans FROM s GROUP BY r)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)"""


SQL = _sql()
