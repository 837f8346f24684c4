"""MinHash near-dedup by a multi-index Hamming join (operator 3).

Each text becomes the set of its distinct word shingles and a signature of 45
MinHash symbols of 16 bits. Two signatures' distance is the number of symbols
that differ. The signature is split into 9 chunks of 5 symbols: by pigeonhole,
signatures at distance 17 or less have a chunk with at most one error, so each
chunk is indexed under the five keys that leave one symbol out. A pair at
similarity 0.8 has no such chunk with a probability under 1e-5, at 0.85 under
4e-7; nothing else is lost, as every pair that shares a key is either linked
already through others or confirmed on full sets:

1. equal sets fall to one node, so copies cost nothing further;
2. in each bucket all members are compared with the smallest one (a star, not
   all pairs) and confirmed links join to components;
3. a bucket that still holds several components leaves the members outside its
   smallest-labelled component as queries. They are compared with that component
   and with each other in blocks of rows, and only links that connect what was
   apart come out.

Defined cases: texts without words (null, empty, blank) have an empty set and
link with nothing; with fewer words than a shingle the whole sequence is one
shingle; rows that repeat a doc_id are texts of their own that share the id;
null ids take part but are never a component's smallest id unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import arrow_map, fresh, id_text, sliced, spark_python, stored, text_bytes
from tallyspark.llm.components import components
from tallyspark.llm.shingles import mix, shingle_sets

CHUNKS, SPAN = 9, 5
SYMBOLS = CHUNKS * SPAN
MOST_DISTANCE = 22   # a pair at similarity 0.8 lies beyond with a probability of 3e-6
BLOCK = 1000         # rows of a block
SLICE_BYTES = 1 << 18   # of texts whose shingles are made at once: their arrays take some 20 times as much
BROADCAST_IDS = 2_000_000   # of 8 bytes: the most that are sent to every executor

_U = np.uint64
_MULTS = mix(np.arange(1, SYMBOLS + 1, dtype=_U)) | _U(1)
_XORS = mix(np.arange(1001, 1001 + SYMBOLS, dtype=_U))


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, SYMBOLS) 16-bit symbols of non-empty sets."""
    out = np.empty((len(at) - 1, SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        low = np.minimum.reduceat((sets ^ _XORS[k]) * _MULTS[k], at[:-1])
        out[:, k] = mix(low) >> _U(48)
    return out


def _set_names(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128-bit names of non-empty sets, as 16 bytes each."""
    size = np.diff(at).astype(_U)
    halves = [mix(np.add.reduceat(mix(sets + c), at[:-1]) + size * c) for c in (_U(0x9E3779B97F4A7C15), _U(0x2545F4914F6CDD1D))]
    return np.stack(halves, 1).astype(">u8").view("S16")


def _names(names: np.ndarray) -> list[bytes]:
    raw = names.tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def _digests(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, SLICE_BYTES):
                raw, offsets = text_bytes(part.column(1))
                sets, at = shingle_sets(raw, offsets, words)
                size = np.diff(at)
                full = size > 0
                name, sig = np.full(len(size), None, object), np.full(len(size), None, object)
                if full.any():
                    own = np.append(at[:-1][full], len(sets))
                    name[full] = _names(_set_names(sets, own))
                    flat = signatures(sets, own).tobytes()
                    sig[full] = [flat[i:i + 2 * SYMBOLS] for i in range(0, len(flat), 2 * SYMBOLS)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(size, pa.int64()), pa.array(name, pa.binary()), pa.array(sig, pa.binary())],
                    ["doc_id", "text_hash", "n_shingles", "node", "sig"])
    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chunk of a signature and symbol left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, SYMBOLS).astype(_U)
            out = np.empty((len(sig), SYMBOLS), _U)
            for c in range(CHUNKS):
                for skip in range(SPAN):
                    key = np.zeros(len(sig), _U)
                    for k in range(SPAN):
                        if k != skip:
                            key = key << _U(16) | sig[:, c * SPAN + k]
                    out[:, c * SPAN + skip] = mix(mix(key) + _U(c * SPAN + skip + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out.view(np.int64).ravel()), part.column(0).take(pa.array(np.repeat(np.arange(len(sig)), SYMBOLS)))],
                ["key", "node"])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures are near enough."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, SYMBOLS) for i in (2, 3))
            near = (a != b).sum(1) <= MOST_DISTANCE
            yield batch.select([0, 1]).filter(pa.array(near))


def linked(n_common: int, a: int, b: int, percent: int) -> bool:
    return 100 * n_common >= percent * (a + b - n_common)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) >= percent * len(y):
                    at = np.searchsorted(y, x)
                    ok[i] = linked(int((y[np.minimum(at, len(y) - 1)] == x).sum()), len(x), len(y), percent)
            yield batch.select([0, 1]).filter(pa.array(ok))
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, SLICE_BYTES):
                raw, offsets = text_bytes(part.column(1))
                sets, at = shingle_sets(raw, offsets, words)
                full = np.diff(at) > 0
                if full.any():
                    own = np.append(at[:-1][full], len(sets))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_names(_set_names(sets, own)), pa.binary()),
                         pa.array([sets[a:b].tobytes() for a, b in zip(own[:-1], own[1:])], pa.binary())], ["node", "shingles"])
    return run


def _block_links(percent: int):
    """Links between a block of rows and a chunk of queries of one group, as few as connect the same texts.

    Rows with ``own`` lie in the group's component, so one link to any of them
    does; among the other rows, links that close a circle are left out.
    """
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list] = ([], [])
        if rows.num_rows and queries.num_rows:
            group = queries.column("group")[0].as_py()
            nodes, inside = rows.column("node").to_pylist(), np.array(rows.column("own").to_pylist())
            above: dict[bytes, bytes] = {}

            def top(x: bytes) -> bytes:
                while (y := above.get(x, x)) != x:
                    above[x] = x = above.get(y, y)
                return x

            def link(x: bytes, y: bytes) -> None:
                a, b = top(x), top(y)
                if a != b:
                    above[a] = b
                    out[0].append(x)
                    out[1].append(y)

            own = [np.frombuffer(x.as_buffer(), _U) for x in rows.column("shingles")]
            size = np.array([len(x) for x in own])
            flat, of = np.concatenate(own), np.repeat(np.arange(len(own)), size)
            order = np.argsort(flat, kind="stable")
            flat, of = flat[order], of[order]
            for q, x in zip(queries.column("node").to_pylist(), queries.column("shingles")):
                x = np.frombuffer(x.as_buffer(), _U)
                lo, hi = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
                n = hi - lo
                hits = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                common = np.bincount(of[hits], minlength=len(own))
                near = 100 * common >= percent * (size + len(x) - common)
                if (near & inside).any():
                    link(q, group)
                for i in np.flatnonzero(near & ~inside):
                    if nodes[i] != q:
                        link(q, nodes[i])
        return pa.table({"a": pa.array(out[0], pa.binary()), "b": pa.array(out[1], pa.binary())})
    return run


def labelled_texts(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, label (of the component; null if the text has no words): one row per input row."""
    spark = docs.sparkSession
    texts = id_text(docs)
    digests = stored(arrow_map(texts.withColumn("text_hash", F.xxhash64("text")), _digests(words),
                               "doc_id bigint, text_hash bigint, n_shingles bigint, node binary, sig binary"), "digests")
    nodes = stored(digests.where("node IS NOT NULL").groupBy("node")
                   .agg(F.min("doc_id").alias("low_id"), F.first("sig").alias("sig")), "nodes")

    # Buckets of at least two nodes, and a star of pairs in each.
    keys = stored(arrow_map(nodes.select("node", "sig"), _keys, "key bigint, node binary"), "keys")
    shared = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = stored(keys.join(shared, "key"), "buckets")
    pairs = buckets.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    sig = nodes.select("node", "sig")
    near = stored(arrow_map(
        pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b"),
        _close, "a binary, b binary"), "pairs")

    # Full sets of the nodes that have a partner, from one text of each.
    wanted = stored(buckets.select("node").distinct().join(nodes.select("node", "low_id"), "node"), "wanted")
    ids = wanted.select(F.col("low_id").alias("doc_id")).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    some = texts.join(ids, texts["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("doc_id", "text")
    sets = stored(arrow_map(some, _sets(words), "node binary, shingles binary")
                  .join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")

    full = (near.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a").select("a", "b", "set_a", "set_b"))
    links = stored(arrow_map(full, _confirm(percent), "a binary, b binary"), "links")
    labels = stored(components(links), "labels")

    # Buckets of three or more with several components: what a star can't settle.
    labelled = (buckets.where("members > 2").join(labels, "node", "left")
                .select("key", "node", F.coalesce("label", "node").alias("label")))
    mixed = (labelled.groupBy("key").agg(F.min("label").alias("group"), F.max("label").alias("other"))
             .where("group != other").select("key", "group"))
    queries = stored(labelled.join(mixed, "key").where("label != group").select("group", "node").distinct(), "queries")
    groups = queries.select("group").distinct()
    rows = (labels.select("node", F.col("label").alias("group")).join(groups, "group", "left_semi")
            .unionByName(groups.select(F.col("group").alias("node"), "group")).distinct().withColumn("own", F.lit(True))
            .unionByName(queries.withColumn("own", F.lit(False))))
    # A grid of (block of rows, chunk of queries) for each group; every pair of it meets in one cell.
    spread = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    sizes = stored(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
                   .join(queries.groupBy("group").agg(F.count(F.lit(1)).alias("q")), "group")
                   .select("group", F.ceil(F.col("n") / BLOCK).alias("blocks"), F.ceil(F.col("q") / BLOCK).alias("chunks")), "sizes")
    to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    left = (rows.join(sizes, "group").select("group", "node", "own", spread(F.col("blocks")).alias("block"), to("chunks").alias("chunk"))
            .join(sets, "node"))
    right = (queries.join(sizes, "group").select("group", "node", to("blocks").alias("block"), spread(F.col("chunks")).alias("chunk"))
             .join(sets.toDF("node", "shingles"), "node"))
    spark_python(spark)
    cell = ["group", "block", "chunk"]
    more = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_block_links(percent), "a binary, b binary")
    labels = stored(components(labels.toDF("a", "b").unionByName(more)), "labels")

    found = nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    cols = ["doc_id", "text_hash", "n_shingles", "label"]
    return digests.where("node IS NOT NULL").join(found, "node").select(*cols).unionByName(
        digests.where("node IS NULL").select("doc_id", "text_hash", "n_shingles", F.lit(None).cast("binary").alias("label")))


def near_dedup(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row."""
    rows = stored(labelled_texts(docs, words, percent), "labelled")
    lowest = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    alone = rows.where("label IS NULL").withColumn("component_id", F.col("doc_id")).drop("label")
    done = rows.join(lowest, "label").drop("label").unionByName(alone)
    return done.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The input's rows and columns: one row of each component stays, that of its smallest doc_id (then text hash).

    Texts without words link with nothing, so they all stay.
    """
    rows = stored(labelled_texts(docs, words, percent).where("label IS NOT NULL"), "labelled")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")
    best = rows.groupBy("label").agg(F.min(order).alias("best"))
    ranked = rows.join(best, "label").withColumn("kept", (order == F.col("best")))
    own = stored(ranked.groupBy("doc_id", "text_hash", "kept").agg(F.count(F.lit(1)).alias("n")), "own")
    h, i, j = fresh(docs, "__text_hash"), fresh(docs, "__id"), fresh(docs, "__hash")

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= BROADCAST_IDS else df

    def ids(condition: str) -> DataFrame:
        return small(own.where(condition).select(F.col("doc_id").alias(i), F.col("text_hash").alias(j)))

    keyed = docs.withColumn(h, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = keyed["doc_id"].eqNullSafe(F.col(i)) & (keyed[h] == F.col(j))
    left = keyed.join(ids("NOT kept"), same, "left_anti")
    again = ids("kept AND n > 1")   # rows that repeat the one that stays
    return (left.join(again, same, "left_anti")
            .unionByName(left.join(again, same, "left_semi").dropDuplicates(["doc_id", h])).select(*docs.columns))


#: near_dedup(documents, words=2, percent=80) by comparing all sets that share a shingle.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                             ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
x AS (SELECT r, len(s) AS n, unnest(s) AS sh FROM s),
p AS (SELECT a.r AS a, b.r AS b, a.n AS na, b.n AS nb, count(*) AS k FROM x a JOIN x b ON a.sh = b.sh AND a.r < b.r
      AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * k >= 80 * (na + nb - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t(a, b) AS (SELECT r, r FROM s UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a),
c AS (SELECT t.a AS r, min(s.doc_id) AS component_id FROM t JOIN s ON t.b = s.r GROUP BY t.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM s JOIN c USING (r)
"""
