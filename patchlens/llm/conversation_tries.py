"""Operator 13: prefix trie of conversations, by ternary search trees per range shard.

A turn (role, text) becomes a dense code from a dictionary of the distinct turns, a
conversation a sequence of codes.  Equal sequences become one row with a count, the
smallest conv_id and the digest of all conv_ids.  The distinct sequences are range
partitioned in lexicographic order, so that the conversations under a node lie next to each other
and only the prefixes of a shard's first and last sequence can go on in another shard.

Each shard inserts its sequences into a ternary search tree, the middle one first and
then the middles of both halves, which keeps the siblings balanced.  A traversal with
a stack of its own adds up members, leaves and savings.  Nodes off the two edges of the
shard are final; the nodes on them give partial sums, merged by the digest of
their prefix.  Sums over subtrees of merged nodes come from pointer doubling: after
round k a node holds its descendants less than 2^k below it, so the number of rounds is
the logarithm of the depth.

Defined cases: rows with a null conv_id take no part; a null role or text is empty; turns are
ordered by number, null first, turns of the same number by the SHA-256 of role and text,
and a repeated row is a turn of its own; texts of any length become a digest and a
word count at once; a conversation without turns ends at the root; an empty table has
no nodes; other columns are ignored.  A conversation is one sequence of codes, 16
bytes a turn, in a row.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = ("key binary, parent_key binary, up array<binary>, depth long, conv_id long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved long, words long, ends string")
NODE_ARROW = pa.schema([
    ("key", pa.binary()), ("parent_key", pa.binary()), ("up", pa.list_(pa.binary())),
    *((c, pa.int64()) for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "words")),
    ("ends", pa.string())])


def coded_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns), a turn being (code, words)."""
    text, role = (F.coalesce(c, F.lit("")) for c in ("text", "role"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).alias("words"))
    turns = stored(turns, "trie-turns")
    distinct = turns.groupBy("digest").agg(F.first("words").alias("words"))
    codes = stored(distinct.repartitionByRange("digest").sortWithinPartitions("digest")
                   .withColumn("code", F.monotonically_increasing_id()), "trie-dictionary")
    order = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)), "code", "words")
    listed = turns.select("conv_id", "turn", "digest").join(codes, "digest").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(order)).alias("turns"))
    return listed.withColumn("turns", F.transform("turns", lambda t: F.struct(t["code"], t["words"])))


def hash_ends(batches):
    """One SHA-256 for each run of equal ``seq``, over its parts joined by commas, as they stream by."""
    current, digest = None, None
    for batch in batches:
        seqs, ends = [], []
        for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
            if seq == current:
                digest.update(b"," + ids.encode())
                continue
            if current is not None:
                seqs.append(current)
                ends.append(digest.hexdigest())
            current, digest = seq, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(seqs, pa.binary()), pa.array(ends, pa.string())], ["seq", "ends"])
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([digest.hexdigest()])], ["seq", "ends"])


class TernaryTree:
    """Node 0 is the textless root; the children of a node are a binary tree that starts at ``eq``."""

    def __init__(self):
        self.code, self.lo, self.eq, self.hi, self.parent, self.depth = [-1], [0], [0], [0], [-1], [0]
        self.n, self.first, self.words, self.ends = [0], [None], [0], [None]

    def _new(self, code: int, words: int, parent: int) -> int:
        for values, v in ((self.code, code), (self.lo, 0), (self.eq, 0), (self.hi, 0), (self.parent, parent),
                          (self.depth, self.depth[parent] + 1), (self.n, 0), (self.first, None), (self.words, words),
                          (self.ends, None)):
            values.append(v)
        return len(self.code) - 1

    def insert(self, codes, words, conv: int, n: int, ends: str) -> None:
        at = 0
        self._count(at, conv, n)
        for code, w in zip(codes, words):
            side, parent, at = (self.eq, at), at, self.eq[at]
            while at and self.code[at] != code:
                branch = self.lo if code < self.code[at] else self.hi
                side, at = (branch, at), branch[at]
            if not at:
                at = self._new(code, w, parent)
                side[0][side[1]] = at
            self._count(at, conv, n)
        self.ends[at] = ends

    def _count(self, at: int, conv: int, n: int) -> None:
        self.n[at] += n
        self.first[at] = conv if self.first[at] is None else min(self.first[at], conv)

    def path(self, codes) -> list[int]:
        """The nodes of a sequence that has been inserted, the root first."""
        out = [0]
        for code in codes:
            at = self.eq[out[-1]]
            while self.code[at] != code:
                at = self.lo[at] if code < self.code[at] else self.hi[at]
            out.append(at)
        return out

    def add_up(self, open_nodes: set[int]) -> tuple[list[int], list[int], list[int]]:
        """(children, leaves, savings) of every node; what lies below an open child is left out."""
        children, leaves, saved = ([0] * len(self.code) for _ in range(3))
        stack = [(0, False)]
        while stack:
            at, below_done = stack.pop()
            if not below_done:
                stack.append((at, True))
                stack.extend((x, False) for x in (self.lo[at], self.eq[at], self.hi[at]) if x)
                continue
            if at in open_nodes:
                continue
            leaves[at] += children[at] == 0
            saved[at] += (self.n[at] - 1) * self.words[at]
            up = self.parent[at]
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
        return children, leaves, saved


def by_medians(n: int):
    """0 .. n-1, the middle first, then the middles of both halves, and so on."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            stack += [(mid + 1, b), (a, mid)]


def shard_nodes(batches):
    """The nodes of a shard's sequences, which come sorted."""
    batches = [b for b in batches if len(b)]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    codes, words, convs, counts, ends = (rows.column(c).to_pylist() for c in ("codes", "words", "conv_id", "n", "ends"))
    tree = TernaryTree()
    for i in by_medians(len(codes)):
        tree.insert(codes[i], words[i], convs[i], counts[i], ends[i])
    keys: dict[int, bytes] = {}
    ups: dict[int, list[bytes]] = {}
    for edge in (codes[0], codes[-1]):
        path, digest = tree.path(edge), hashlib.sha256()
        for d, at in enumerate(path):
            if d:
                digest.update(b"%d," % tree.code[at])
            keys[at] = digest.digest()
            ups[at] = [keys[path[d - (1 << k)]] for k in range(d.bit_length())]
    children, leaves, saved = tree.add_up(set(keys))
    parents = tree.parent
    for at in range(0, len(tree.code), 65536):
        part = range(at, min(at + 65536, len(tree.code)))
        yield pa.RecordBatch.from_pydict({
            "key": [keys.get(v) for v in part],
            "parent_key": [keys.get(parents[v]) for v in part], "up": [ups.get(v) for v in part],
            "depth": [tree.depth[v] for v in part], "conv_id": [tree.first[v] for v in part],
            "parent_conv_id": [tree.first[parents[v]] if v and parents[v] not in keys else None for v in part],
            "n_convs": [tree.n[v] for v in part], "n_children": [children[v] for v in part],
            "n_leaves": [leaves[v] for v in part], "saved": [saved[v] for v in part],
            "words": [tree.words[v] for v in part], "ends": [tree.ends[v] for v in part]}, schema=NODE_ARROW)


def _sequences(convs: DataFrame, id_block: int) -> DataFrame:
    """(codes, words, conv_id, n, ends), one row for each distinct sequence."""
    codes = F.transform("turns", lambda t: t["code"])
    keyed = stored(convs.select("conv_id", codes.alias("codes"), F.transform("turns", lambda t: t["words"]).alias("words"))
                   .withColumn("seq", F.unhex(F.sha2(F.array_join(F.col("codes").cast("array<string>"), ","), 256))),
                   "trie-conversations")
    distinct = keyed.groupBy("seq").agg(F.first("codes").alias("codes"), F.first("words").alias("words"),
                                        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    # the conv_ids of a sequence as one text for each block of ids, so that a common sequence is few rows
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    blocks = keyed.groupBy("seq", F.floor(F.col("conv_id") / id_block).alias("block")).agg(ids.alias("ids"))
    ends = (blocks.repartition("seq").sortWithinPartitions("seq", "block").select("seq", "ids")
            .mapInArrow(hash_ends, "seq binary, ends string"))
    return distinct.join(ends, "seq").drop("seq")


def _subtree_sums(merged: DataFrame) -> DataFrame:
    """(key, n_leaves, saved) of the nodes on shard edges, over their whole subtrees."""
    own = merged.select("key", "up", "n_leaves", "saved")
    rounds = merged.agg(F.max(F.size("up"))).first()[0] or 0
    for k in range(rounds):
        below = own.filter(F.size("up") > k).groupBy(F.col("up")[k].alias("key")).agg(
            F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        own = stored(own.join(below, "key", "left").select(
            "key", "up", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "trie-sums")
    return own.drop("up")


def prefix_trie(convs: DataFrame, *, shard_turns: int = 1 << 17, least_turns: int = 1 << 11,
                id_block: int = 4096) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, turns of (code, words)).

    A node is named by its smallest conversation and its depth.  ``shard_turns`` bounds the turns of a
    shard (a whole sequence lies in one); small tables are cut down to ``least_turns`` to use all tasks.
    """
    spark = convs.sparkSession
    sequences = stored(_sequences(convs, id_block), "trie-sequences")
    turns = sequences.agg(F.sum(F.size("codes") + 1)).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-turns // shard_turns), min(tasks, -(-turns // least_turns)))
    nodes = stored(sequences.repartitionByRange(shards, "codes").sortWithinPartitions("codes")
                   .mapInArrow(shard_nodes, NODE), "trie-nodes")

    open_nodes = nodes.filter(F.col("key").isNotNull())
    parts = stored(open_nodes.groupBy("key").agg(
        F.first("up").alias("up"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.max("words").alias("words"),
        F.max("ends").alias("ends")), "trie-edges")
    open_children = parts.filter(F.size("up") > 0).groupBy(F.col("up")[0].alias("key")).agg(
        F.count(F.lit(1)).alias("open_children"))
    merged = stored(parts.join(open_children, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))).withColumn(
        "n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).withColumn(
        "saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words")), "trie-merged")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    on_edges = merged.drop("n_leaves", "saved").join(_subtree_sums(merged), "key").withColumn(
        "parent_key", F.get("up", F.lit(0))).join(parents, "parent_key", "left")
    inside = nodes.filter(F.col("key").isNull())
    below_edge = inside.filter(F.col("parent_key").isNotNull()).join(parents, "parent_key")

    def named(df: DataFrame, parent: Column) -> DataFrame:
        return df.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                         F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))

    return (named(on_edges, F.col("parent")).unionByName(named(below_edge, F.col("parent")))
            .unionByName(named(inside.filter(F.col("parent_key").isNull()), F.col("parent_conv_id"))))


def with_borrowed_turns(convs: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Each conversation with its first crc32(conv_id) % (most + 1) turns taken from conversation
    conv_id - conv_id % every (the remainder has the sign of conv_id)."""
    convs = stored(convs, "trie-originals")
    heads = convs.select(F.col("conv_id").alias("source"), F.slice("turns", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    empty = F.slice("turns", 1, 0)
    return convs.withColumn("source", F.col("conv_id") - F.col("conv_id") % every).join(heads, "source", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", empty), F.lit(1), h),
                            F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = coded_conversations(table(spark, sf_dir, "conversations"))
    return prefix_trie(with_borrowed_turns(convs))


SQL = r"""
WITH t AS MATERIALIZED (
  SELECT conv_id, list({'k': k, 'w': w} ORDER BY turn NULLS FIRST, k) AS turns
  FROM (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
        FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
c AS (
  SELECT conv_id, turns, (xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           string_split(conv_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END),
         4294967295::BIGINT) % 4) AS h
  FROM t),
r AS MATERIALIZED (
  SELECT c.conv_id, list_concat(coalesce(s.turns, [])[:h], c.turns[h + 1:]) AS turns
  FROM c LEFT JOIN t s ON s.conv_id = c.conv_id - c.conv_id % 20),
p AS (
  SELECT conv_id, depth, list_transform(turns[:depth], lambda x: x.k) AS k, len(turns) = depth AS ends,
         coalesce(turns[depth].w, 0) AS w
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM r)),
n AS MATERIALIZED (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved,
         sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY k, depth),
kids AS (SELECT k[:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT k[:d] AS k, sum((n_children IS NULL)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT n.*, n_children, unnest(range(depth + 1)) AS d FROM n LEFT JOIN kids USING (k)) GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN below USING (k) LEFT JOIN kids USING (k) LEFT JOIN n u ON n.depth > 0 AND u.k = n.k[:n.depth - 1]"""
