"""Trie of conversation prefixes, by van Emde Boas recursion over the depth.

Conversations are cut at half depth: the first halves make the upper trie, the
second halves the lower forests under the cut prefixes, and both are cut again,
all pieces of one size in one Spark step, until a piece is one turn. After
log2(depth) steps every distinct (prefix, turn) is a node.

* A piece of a conversation is named by a digest of its two halves (128 bits), a
  cut prefix by the digest of the prefix before it and the piece between: equal
  pieces under equal prefixes are one piece with a weight, held by the smallest
  conversation, so copies shrink to one row before they are cut again.
* Every step joins by (conversation, piece), a key with one row on each side, so
  a conversation with a third of all turns is as many pieces as any other turns.
* Totals are grafted upward over the same cuts: the lower forest's total is added
  at the cut, which gives every cut prefix the total of its own piece; then the
  cuts hand down what lies below their piece, the largest pieces first.

Defined results: rows without a ``conv_id`` belong to no conversation; equal turn
numbers are ordered by role, then text (a repeated row is one more turn); a null
turn stands first; a null role or text is empty; a table without conversations
gives no node, not even a root. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import arrow_map, stored

#: The name of the textless root.
ROOT = bytes(16)
#: Turns of another conversation that a rebuilt one may start with, at most.
MOST_BORROWED = 5


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _root() -> Column:
    return F.lit(ROOT)


def conversation_trie(conversations: DataFrame, every: int = 100) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    A conversation c starts with the first h turns of conversation
    c - c % every, h = crc32(decimal c) % 6, then follow its own turns after its
    first h. Returns conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    turns, sizes = rebuilt_turns(conversations, every)
    longest = sizes.agg(F.max("length")).first()[0]
    if longest is None:
        return turns.sparkSession.createDataFrame([], (
            "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
            "n_leaves bigint, saved_tokens bigint, ends_sha256 string"))
    steps = max(1, int(longest).bit_length())    # 2 ** steps > longest: no conversation fills the first piece
    pieces = [turns, *_pieces(turns, steps)]
    cuts = _cut(pieces, steps)
    nodes = _nodes(cuts[0])
    below = _totals(nodes, cuts, steps)
    ends = _ends(pieces, sizes, steps)
    return _result(nodes, below, ends, sizes)


# ------------------------------------------------------------------ turns in order

def rebuilt_turns(conversations: DataFrame, every: int) -> tuple[DataFrame, DataFrame]:
    """((conv, at, piece, chars, length), (conv, length)): turns of rebuilt conversations, numbered from 0.

    A global sort places the turns; a conversation may lie in many partitions, whose
    counts number its turns, so no task holds a whole conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn"), role.alias("role"), text.alias("text"))
    ordered = stored(
        rows.orderBy("conv", F.col("turn").asc_nulls_first(), "role", "text").select(
            "conv", F.monotonically_increasing_id().alias("place"), F.length("text").cast("bigint").alias("chars"),
            _digest(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).alias("piece")), "turns")
    part = F.shiftright("place", 33).alias("part")      # the partition, as monotonically_increasing_id numbers rows
    runs = ordered.groupBy("conv", part).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "runs")
    own = runs.groupBy("conv").agg(F.sum("n").alias("own"))
    borrowed = F.crc32(F.col("conv").cast("string")) % (MOST_BORROWED + 1)
    base = own.where(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    sizes = own.withColumn("skip", borrowed).withColumn("base", F.col("conv") - F.col("conv") % every).join(base, "base", "left")
    sizes = sizes.withColumn("head", F.least("skip", F.coalesce("base_own", F.lit(0))))
    sizes = stored(sizes.withColumn("length", F.col("head") + F.greatest(F.col("own") - F.col("skip"), F.lit(0))), "sizes")

    spots = runs.join(sizes.select("conv", "skip", "head", "length"), "conv")
    placed = ordered.withColumn("part", part).join(spots, ["conv", "part"])
    placed = placed.withColumn("at", F.col("start") + F.col("place") - F.col("first"))
    tail = placed.where(F.col("at") >= F.col("skip")).select(
        "conv", (F.col("at") - F.col("skip") + F.col("head")).alias("at"), "piece", "chars", "length")
    heads = placed.where((F.col("conv") % every == 0) & (F.col("at") < MOST_BORROWED)).select(
        F.col("conv").alias("base"), "at", "piece", "chars")
    head = heads.join(sizes.select("conv", "base", "head", "length"), "base").where(F.col("at") < F.col("head"))
    turns = stored(tail.unionByName(head.select("conv", "at", "piece", "chars", "length")), "rebuilt")
    return turns, sizes.select("conv", "length")


# ------------------------------------------------------------------ cutting

def _pieces(turns: DataFrame, steps: int) -> list[DataFrame]:
    """For each size 2, 4, ... turns: (conv, at, left, right, piece, length), ``at`` counted in pieces; right may be null."""
    made, smaller = [], turns
    for _ in range(steps):
        half = F.col("at") % 2 == 0
        pairs = smaller.groupBy("conv", F.shiftright("at", 1).alias("at"), "length").agg(
            F.max(F.when(half, F.col("piece"))).alias("left"), F.max(F.when(~half, F.col("piece"))).alias("right"))
        # One half is 16 bytes, two are 32: what a digest stands for is never in doubt.
        smaller = stored(pairs.withColumn("piece", _digest(F.col("left"), F.coalesce("right", F.lit(b"")))), "pieces")
        made.append(smaller)
    return made


def _cut(pieces: list[DataFrame], steps: int) -> list[DataFrame]:
    """For each size 1, 2, 4, ...: the distinct pieces of the trie, (top, end, conv, length, at, n).

    ``top`` names the prefix before the piece, ``end`` the one after it (null if the conversations end inside),
    conv is the smallest of the n conversations that pass through.
    """
    top = pieces[steps].groupBy("piece", "at", "left", "right").agg(
        F.min(F.struct("conv", "length")).alias("held"), F.count(F.lit(1)).alias("n"))
    rows = stored(top.select(_root().alias("top"), F.lit(None).cast("binary").alias("end"), "held.conv", "held.length",
                             "at", "n", "left", "right"), "cut")
    cuts = [rows]
    for size in range(steps - 1, -1, -1):
        cut = _digest(F.col("top"), F.col("left"))
        upper = rows.groupBy("top", "left", (F.col("at") * 2).alias("at")).agg(
            F.min(F.struct("conv", "length")).alias("held"), F.sum("n").alias("n"))
        whole = F.col("held.length") >= (F.col("at") + 1) * (1 << size)
        upper = upper.select("top", F.when(whole, cut).alias("end"), "held.conv", "held.length", "at", "n")
        lower = rows.where(F.col("right").isNotNull()).select(
            cut.alias("top"), "end", "conv", "length", (F.col("at") * 2 + 1).alias("at"), "n")
        both = upper.unionByName(lower)
        inside = ("left", "right") if size else ("chars",)
        rows = stored(both.join(pieces[size].select("conv", "at", *inside), ["conv", "at"]), "cut")
        cuts.append(rows)
    return cuts[::-1]


def _nodes(edges: DataFrame) -> DataFrame:
    """(name, top, conv, depth, n, chars, n_children) of every node but the root."""
    kids = edges.groupBy(F.col("top").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = edges.select(F.col("end").alias("name"), "top", "conv", (F.col("at") + 1).alias("depth"), "n", "chars")
    return stored(nodes.join(kids, "name", "left").fillna(0, ["n_children"]), "nodes")


# ------------------------------------------------------------------ totals

def _totals(nodes: DataFrame, cuts: list[DataFrame], steps: int) -> DataFrame:
    """(name, leaves, saved): sums over the nodes below each node that has children."""
    own = [F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaves"),
           F.sum((F.col("n") - 1) * F.col("chars")).alias("saved")]
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    inside = [stored(nodes.groupBy(F.col("top").alias("name"), (F.col("depth") - 1).alias("depth")).agg(*own), "inside")]
    # Upward: a piece's total is that of its first half, and of the second halves under it.
    for size in range(steps):
        here = inside[-1]
        links = cuts[size].where((F.col("at") % 2 == 0) & F.col("end").isNotNull()).select(
            F.col("end").alias("name"), "top", (F.col("at") * (1 << size)).alias("top_depth"))
        grafted = here.join(links, "name").select(F.col("top").alias("name"), F.col("top_depth").alias("depth"), "leaves", "saved")
        firsts = here.where(F.col("depth") % (2 << size) == 0)
        inside.append(stored(firsts.unionByName(grafted).groupBy("name", "depth").agg(*sums), "inside"))
    # Downward in size: what lies below the end of a piece is known when the piece's top needs it.
    below = inside[steps].select("name", "leaves", "saved")
    for size in range(steps - 1, -1, -1):
        links = cuts[size].where((F.col("at") % 2 == 1) & F.col("end").isNotNull()).select(F.col("end").alias("name"), "top")
        beyond = below.join(links, "name").select(F.col("top").alias("name"), "leaves", "saved")
        odd = inside[size].where(F.shiftright("depth", size) % 2 == 1).select("name", "leaves", "saved")
        below = below.unionByName(stored(odd.unionByName(beyond).groupBy("name").agg(*sums), "below"))
    return below


# ------------------------------------------------------------------ ends and result

def _ends(pieces: list[DataFrame], sizes: DataFrame, steps: int) -> DataFrame:
    """(name, ends_sha256): digest of the conversations that end at a node.

    A conversation's end is named by the pieces that the binary digits of its length give. Ids are joined in
    chunks of a sorted partition; the digest takes a node's chunks one by one.
    """
    parts = None
    for size in range(steps):
        last = F.shiftright("length", size)
        some = pieces[size].where((last % 2 == 1) & (F.col("at") == last - 1)).select("conv", F.lit(size).alias("size"), "piece")
        parts = some if parts is None else parts.unionByName(some)
    chains = parts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("size", "piece")), asc=False).alias("chain"))
    name = F.aggregate(F.coalesce("chain", F.array().cast("array<struct<size:int,piece:binary>>")), _root(),
                       lambda top, x: _digest(top, x["piece"]))
    ends = sizes.select("conv").join(chains, "conv", "left").select(name.alias("name"), "conv")
    chunks = arrow_map(ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv"), _chunks,
                       "name binary, first bigint, ids string")
    return arrow_map(chunks.repartition("name").sortWithinPartitions("name", "first"), _hashes, "name binary, ends_sha256 string")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive ids of one node, joined, within each batch."""
    for b in batches:
        rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        found = [(name, [c for _, c in group]) for name, group in groupby(rows, lambda r: r[0])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in found], pa.binary()), pa.array([c[0] for _, c in found], pa.int64()),
             pa.array([",".join(map(str, c)) for _, c in found], pa.string())], names=["name", "first", "ids"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks in order, without holding them together."""
    now, sha = None, None
    for b in batches:
        names, texts = [], []
        for name, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            if name == now:
                sha.update(b"," + ids.encode())
                continue
            if now is not None:
                names.append(now)
                texts.append(sha.hexdigest())
            now, sha = name, hashlib.sha256(ids.encode())
        yield _named(names, texts)
    if now is not None:
        yield _named([now], [sha.hexdigest()])


def _named(names: list, texts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(texts, pa.string())], names=["name", "ends_sha256"])


def _result(nodes: DataFrame, below: DataFrame, ends: DataFrame, sizes: DataFrame) -> DataFrame:
    kids = nodes.agg(F.count_if(F.col("depth") == 1).alias("n_children"))
    root = sizes.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(kids)).select(
        _root().alias("name"), F.lit(None).cast("binary").alias("top"), "conv", F.lit(0).cast("bigint").alias("depth"), "n",
        F.lit(0).cast("bigint").alias("chars"), "n_children")     # two single rows
    every = stored(nodes.unionByName(root), "all-nodes")
    parents = every.where(F.col("n_children") > 0).select(F.col("name").alias("top"), F.col("conv").alias("parent_conv_id"))
    full = every.join(below, "name", "left").join(ends, "name", "left").join(parents, "top", "left")
    return full.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        "n_children", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
        ((F.col("n") - 1) * F.col("chars") + F.coalesce("saved", F.lit(0))).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


ORACLE = r"""
WITH crc AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
    FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, count(*) AS own, c - c % 100 AS b,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1])), 4294967295) % 6 AS h FROM t, crc GROUP BY c, crc.t),
z AS (SELECT s.c, s.b, s.h, least(s.h, coalesce(o.own, 0)) AS k FROM s LEFT JOIN s o ON o.c = s.b),
r AS (SELECT z.c, t.p, t.role, t.text FROM z JOIN t ON t.c = z.b AND t.p < z.k
    UNION ALL SELECT z.c, t.p - z.h + z.k, t.role, t.text FROM z JOIN t ON t.c = z.c AND t.p >= z.h),
m AS (SELECT c, p + 1 AS d, length(text) AS chars,
    string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY p ROWS UNBOUNDED PRECEDING) AS key FROM r
    UNION ALL SELECT c, 0, 0, '' FROM z),
l AS (SELECT c, max(d) AS last FROM m GROUP BY c),
n AS (SELECT d, key, min(c) AS id, count(*) AS n, any_value(chars) AS chars FROM m GROUP BY d, key),
w AS (SELECT m.c, m.d, n.id FROM m JOIN n USING (d, key)),
e AS (SELECT w.d, w.id, string_agg(w.c::VARCHAR, ',' ORDER BY w.c) AS ids FROM w JOIN l ON l.c = w.c AND l.last = w.d GROUP BY ALL),
u AS (SELECT DISTINCT w.d, w.id, v.id AS parent FROM w LEFT JOIN w v ON v.c = w.c AND v.d = w.d - 1),
k AS (SELECT d - 1 AS d, parent AS id, count(*) AS n_children FROM u WHERE d > 0 GROUP BY ALL),
x AS (SELECT n.d, n.id, n.n, n.chars, u.parent, coalesce(k.n_children, 0) AS n_children
    FROM n JOIN u USING (d, id) LEFT JOIN k USING (d, id)),
a AS (SELECT DISTINCT a.d, a.id, b.d AS d2, b.id AS id2 FROM w a JOIN w b ON a.c = b.c AND b.d >= a.d),
y AS (SELECT a.d, a.id, sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
    sum((x.n - 1) * x.chars)::BIGINT AS saved_tokens FROM a JOIN x ON x.d = a.d2 AND x.id = a.id2 GROUP BY ALL)
SELECT x.id AS conv_id, x.d::BIGINT AS depth, x.parent AS parent_conv_id, x.n AS n_convs, x.n_children, y.n_leaves, y.saved_tokens,
    sha256(coalesce(e.ids, '')) AS ends_sha256
FROM x JOIN y USING (d, id) LEFT JOIN e USING (d, id)
"""
