"""Removal of repeated 200-byte strings by bucket-pointer refinement (operator 6).

Sorting every suffix of the corpus isn't needed to find strings of a fixed
length that occur twice: only the buckets that can still hold such a string are
refined.

* Initial buckets: the 100-grams that are the smallest by hash in some window of
  101 starts (all ties). Each 200-byte string has such an anchor, at the same
  place wherever the string occurs, so equal strings meet in a bucket.
  Buckets with one member fall out at once (their members send 8 bytes each).
* A bucket is split by the 100 bytes on both sides (128-bit digests). Members
  that share their whole context with another are done: all their strings occur
  elsewhere.
* Buckets that keep single members are refined, one member of each context, at
  every offset from the anchor. The buckets of ``Q`` bytes are sorted by the
  bytes themselves; a bucket of twice the length is its bucket's number and the
  number of the bucket that far on, sorted again, whose numbers the next step
  reads: 8, 16, 32, 64, 128, 200 bytes. A bucket with one member is closed and
  its pointer closes whatever holds it. What is open at 200 bytes is repeated,
  byte for byte; no hash takes part.
* Buckets of more than ``TASK_BUCKET`` contexts are counted by Spark instead, one
  row for each string, by 128-bit digests, so no task gets an unbounded bucket.

A Bloom filter (bounded, broadcast) only thins out what is scanned again.

Defined cases: null and empty texts have 0 bytes; texts under 200 bytes lose
nothing; a text that repeats a string within itself loses both places; repeated
rows are places of their own, so texts of 200 bytes or more on two rows go
wholly; texts of any length are read in chunks that overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import bitfilter
from tallyspark.llm.common import arrow_map, stored, text_bytes
from tallyspark.llm.shingles import mix, powers

LENGTH = 200
GRAM = LENGTH // 2
REACH = LENGTH - GRAM      # bytes of context on each side of an anchor
CHUNK = 1 << 19
TASK_BUCKET = 20_000
BROADCAST_IDS = 2_000_000
Q = 8                      # bytes of the first buckets of a refinement: one machine word

_U = np.uint64


def slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """Minimum or maximum of each ``width`` neighbours."""
    n = len(x)
    y = np.full(-(-n // width) * width, np.iinfo(x.dtype).max if op is np.minimum else 0, x.dtype)
    y[:n] = x
    y = y.reshape(-1, width)
    ahead, back = op.accumulate(y, axis=1).ravel(), op.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n - width + 1], ahead[width - 1:n])


def anchors(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """(text, place in it, hash of the anchor, first byte of its context, end of it) chunk by chunk."""
    n, margin = len(raw), 2 * LENGTH
    for c0 in range(0, n, CHUNK):
        c1 = min(n, c0 + CHUNK)
        lo, hi = max(0, c0 - margin), min(n, c1 + margin)
        m = hi - lo
        if m < LENGTH:
            continue
        p, q = powers(m + 1)
        total = np.zeros(m + 1, _U)
        np.cumsum((raw[lo:hi].astype(_U) + _U(1)) * p[:m], out=total[1:])
        gram = mix((total[GRAM:] - total[:-GRAM]) * q[:m - GRAM + 1])
        x = (gram >> _U(32)).astype(np.uint32) | np.uint32(1)
        low = slide(x, REACH + 1, np.minimum)   # one for each string of LENGTH bytes
        cuts = offsets[(offsets > lo) & (offsets < hi)] - lo
        across = np.zeros(m + 1, np.int32)
        np.add.at(across, np.maximum(0, cuts - LENGTH + 1), 1)
        np.add.at(across, cuts, -1)
        low[np.cumsum(across)[:len(low)] > 0] = 0
        padded = np.zeros(len(low) + 2 * REACH, np.uint32)
        padded[REACH:REACH + len(low)] = low
        at = np.flatnonzero(slide(padded, REACH + 1, np.maximum) == x)
        at = at[(at + lo >= c0) & (at + lo < c1)]
        doc = np.searchsorted(offsets, at + lo, "right") - 1
        start = np.maximum(at - REACH, offsets[doc] - lo)
        end = np.minimum(at + LENGTH, offsets[doc + 1] - lo)
        yield doc, at + lo - offsets[doc], gram[at], start + lo, end + lo


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchor hashes; twice if a chunk holds one more than once."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        for _, _, gram, *_ in anchors(raw, offsets):
            own, n = np.unique(gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own, own[n > 1]]).view(np.int64))], ["gram"])


def _digests(raw: memoryview, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """128-bit digests of byte ranges, as two columns."""
    both = b"".join([xxhash.xxh3_128_digest(raw[a:b], s) for a, b, s in zip(start.tolist(), end.tolist(), seed.tolist())])
    h = np.frombuffer(both, np.int64).reshape(-1, 2)
    return pa.array(h[:, 0]), pa.array(h[:, 1])


def _places(repeated):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            rid, view = batch.column(0).to_numpy(), memoryview(raw)
            for doc, place, gram, start, end in anchors(raw, offsets):
                ok = bitfilter.probe(repeated.value, gram)
                doc, place, gram, start, end = doc[ok], place[ok], gram[ok], start[ok], end[ok]
                before = place + offsets[doc] - start
                yield pa.RecordBatch.from_arrays(
                    [*_digests(view, start, end, before * LENGTH + end - start), pa.array(gram.view(np.int64)), pa.array(rid[doc]),
                     pa.array(place, pa.int64())], ["context", "check", "gram", "rid", "place"])
    return run


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes before and from each anchor on."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        lists = batch.column(2)
        each = lists.flatten()
        doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        for at in range(0, len(each), 10_000):
            gram, place = (each.slice(at, 10_000).field(k) for k in range(2))
            d, p = doc[at:at + 10_000], place.to_numpy()
            here, first, last = p + offsets[d], offsets[d], offsets[d + 1]
            yield pa.RecordBatch.from_arrays(
                [gram, batch.column(0).take(pa.array(d)), place,
                 pa.array([raw[a:b].tobytes() for a, b in zip(np.maximum(first, here - REACH), here)], pa.binary()),
                 pa.array([raw[a:b].tobytes() for a, b in zip(here, np.minimum(last, here + LENGTH))], pa.binary())],
                ["gram", "rid", "place", "before", "after"])


def _numbered(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The number of the bucket of each pair of pointers, -1 where a bucket has one member."""
    order = np.lexsort((then, first))
    a, b = first[order], then[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    number = np.cumsum(new) - 1
    out = np.empty(len(order), np.int32)
    out[order] = np.where(np.bincount(number)[number] > 1, number, -1)
    return out


def repeated_around(gram: np.ndarray, before: list[bytes], after: list[bytes]) -> np.ndarray:
    """(rows, REACH + 1): the string that starts k bytes before the row's anchor is that of another row of the bucket."""
    n, wide = len(before), REACH + LENGTH
    flat = np.frombuffer(b"".join(x.rjust(REACH, b"\0") + y.ljust(LENGTH, b"\0") for x, y in zip(before, after)), np.uint8).reshape(n, wide)
    lo = REACH - np.array([len(x) for x in before])
    hi = REACH + np.array([len(y) for y in after])
    bucket = np.full((n, wide), -1, np.int32)
    for p in range(wide - Q + 1):
        rows = np.flatnonzero((lo <= p) & (hi >= p + Q))
        if len(rows):
            bucket[rows, p] = _numbered(gram[rows], np.ascontiguousarray(flat[rows, p:p + Q]).view(_U).ravel())
    size = Q
    while size < LENGTH:
        step = min(size, LENGTH - size)
        for p in range(wide - size - step + 1):   # the pointer at p + step is still that of the last step
            rows = np.flatnonzero((bucket[:, p] >= 0) & (bucket[:, p + step] >= 0))
            there = _numbered(bucket[rows, p], bucket[rows, p + step]) if len(rows) else rows
            bucket[:, p] = -1
            bucket[rows, p] = there
        size += step
    return bucket[:, REACH::-1] >= 0


def _runs(rid: np.ndarray, place: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
    """Byte ranges of the repeated strings: held[row, k] says whether the string that starts k before the place repeats."""
    wide = np.zeros((len(held), REACH + 3), np.int8)
    wide[:, 1:-1] = held
    edge = np.diff(wide, axis=1)
    row, first = np.nonzero(edge > 0)
    _, last = np.nonzero(edge < 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(rid[row]), pa.array(place[row] - (last - 1)), pa.array(place[row] - first + LENGTH)], ["rid", "lo", "hi"])


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Refines whole buckets; rows come sorted by anchor hash."""
    def done(part: pa.RecordBatch) -> pa.RecordBatch:
        held = repeated_around(part.column(0).to_numpy(), part.column(3).to_pylist(), part.column(4).to_pylist())
        return _runs(part.column(1).to_numpy(), part.column(2).to_numpy(), held)

    kept: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        kept.append(batch)
        n += batch.num_rows
        if n >= TASK_BUCKET:
            whole = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            gram = whole.column(0).to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))   # the last bucket may go on
            if cut:
                for at, to in _parts(gram[:cut]):
                    yield done(whole.slice(at, to - at))
            kept, n = [whole.slice(cut)], len(whole) - cut
    if n:
        whole = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
        for at, to in _parts(whole.column(0).to_numpy()):
            yield done(whole.slice(at, to - at))


def _parts(gram: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole buckets, of about TASK_BUCKET rows."""
    ends = np.append(np.flatnonzero(gram[1:] != gram[:-1]) + 1, len(gram))
    at = 0
    while at < len(gram):
        to = int(ends[min(np.searchsorted(ends, at + TASK_BUCKET), len(ends) - 1)])
        yield at, to
        at = to


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each string around the anchors of a large bucket."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            before, after = part.column(3).to_pylist(), part.column(4).to_pylist()
            size = np.array([len(x) for x in before], np.int64)
            raw = b"".join(x + y for x, y in zip(before, after))
            end = np.cumsum(size + [len(y) for y in after])
            start = end - size - [len(y) for y in after]
            n = np.maximum(end - start - LENGTH + 1, 0)
            row = np.repeat(np.arange(len(n)), n)
            back = size[row] - (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))   # bytes before the anchor
            first = start[row] + size[row] - back
            gram = part.column(0).to_numpy().view(_U)[row]   # an occurrence has a row for each anchor, so the anchor and its place take part
            yield pa.RecordBatch.from_arrays(
                [*_digests(memoryview(raw), first, first + LENGTH, mix(gram + back.astype(_U))), part.column(1).take(pa.array(row)),
                 pa.array(part.column(2).to_numpy()[row] - back)], ["pair", "check", "rid", "lo"])


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """rid, lo, hi: byte ranges of ``texts`` (rid, text) that 200-byte strings with another start cover; they may overlap."""
    grams = arrow_map(texts, _grams, "gram bigint").groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram")
    repeated = bitfilter.build(stored(grams, "grams"), "gram")
    whole = ["context", "check"]
    places = stored(arrow_map(texts, _places(repeated), "context bigint, check bigint, gram bigint, rid bigint, place bigint"), "places")
    contexts = stored(places.groupBy(*whole).agg(F.count(F.lit(1)).alias("c"), F.min("gram").alias("gram"),
                                                F.min(F.struct("rid", "place")).alias("one"))
                      .select(*whole, "c", "gram", "one.rid", "one.place"), "contexts")
    done = (places.join(contexts.where("c > 1").select(*whole), whole, "left_semi")
            .select("rid", (F.col("place") - REACH).alias("lo"), (F.col("place") + LENGTH).alias("hi")))

    open_ = stored(contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.min("c").alias("least"))
                   .where("members > 1 AND least = 1").select("gram", "members"), "buckets")
    chosen = stored(contexts.join(open_, "gram", "left_semi")
                    .groupBy("rid").agg(F.collect_list(F.struct("gram", "place")).alias("anchors")), "chosen")   # bounded by the text
    around = stored(arrow_map(_texts_of(texts, chosen), _around, "gram bigint, rid bigint, place bigint, before binary, after binary"), "around")
    large = stored(open_.where(F.col("members") > TASK_BUCKET).select("gram"), "large")   # broadcast as its size in bytes allows
    parts = max(1, texts.sparkSession._jsparkSession.sessionState().conf().numShufflePartitions())
    small = around.join(large, "gram", "left_anti").repartition(parts, "gram").sortWithinPartitions("gram")
    fine = arrow_map(small, _refine, "rid bigint, lo bigint, hi bigint")
    leaves = stored(arrow_map(around.join(large, "gram", "left_semi").dropDuplicates(["rid", "place"]),
                              _leaves, "pair bigint, check bigint, rid bigint, lo bigint"), "leaves")
    pairs = leaves.groupBy("pair", "check").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("pair", "check")
    rest = leaves.join(pairs, ["pair", "check"], "left_semi").select("rid", "lo", (F.col("lo") + LENGTH).alias("hi"))
    return done.unionByName(fine).unionByName(rest)


def _texts_of(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """rid, text, anchors; texts without any aren't shuffled unless BROADCAST_IDS have some."""
    ids = chosen.select("rid")
    if ids.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(ids), "rid", "left_semi")
    return texts.join(chosen, "rid").select("rid", "text", "anchors")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the ranges of each text and cuts them out."""
    for batch in batches:
        out: dict = {"doc_id": batch.column(0), "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        texts = batch.column(1).cast(pa.binary())
        los = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
        his = batch.column(3).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
        for t, lo, hi in zip(texts, los, his):
            t = t.as_py()
            kept, removed, spans, at = [], 0, 0, 0
            if lo:
                lo, hi = np.maximum(np.array(lo), 0), np.minimum(np.array(hi), len(t))
                order = np.argsort(lo, kind="stable")
                lo, reach = lo[order], np.maximum.accumulate(hi[order])
                first = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]]))
                for a, b in zip(lo[first], reach[np.append(first[1:] - 1, len(lo) - 1)]):
                    kept.append(t[at:a])
                    removed, spans, at = removed + int(b - a), spans + 1, int(b)
            kept.append(t[at:])
            out["n_bytes"].append(len(t))
            out["n_removed"].append(removed)
            out["n_spans"].append(spans)
            out["kept"].append(b"".join(kept))
        yield pa.RecordBatch.from_arrays(
            [out["doc_id"], pa.array(out["n_bytes"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
             pa.array(out["n_spans"], pa.int64()), pa.array(out["kept"], pa.binary())], list(out))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay): one row per input row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select("doc_id", F.xxhash64("doc_id", text).alias("rid"), text.alias("text"))
    ranges = stored(repeated_ranges(own.select("rid", "text")).groupBy("rid")
                    .agg(F.collect_list(F.struct("lo", "hi")).alias("r")).select("rid", "r.lo", "r.hi"), "ranges")
    ids = ranges.select("rid")
    out = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    if ids.count() > BROADCAST_IDS:
        return arrow_map(own.join(ranges, "rid", "left").select("doc_id", "text", "lo", "hi"), _cut, out)
    # Texts that keep all their bytes aren't shuffled.
    whole = arrow_map(own.join(F.broadcast(ids), "rid", "left_anti").select("doc_id", "text"), _cut, out)
    cut = arrow_map(own.join(F.broadcast(ids), "rid", "left_semi").join(ranges, "rid").select("doc_id", "text", "lo", "hi"), _cut, out)
    return whole.unionByName(cut)


#: remove_repeats(documents) by counting every 200-byte string.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS s FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400)),
g AS (SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -1000) + 200 AS starts
      FROM (SELECT r, i FROM k QUALIFY count(*) OVER (PARTITION BY s) > 1)),
n AS (SELECT r, i, sum(starts::INT) OVER (PARTITION BY r ORDER BY i) AS span FROM g),
m AS (SELECT r, span, min(i) AS lo, max(i) + 200 AS hi FROM n GROUP BY ALL),
q AS (SELECT r, span, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS before FROM m),
a AS (SELECT q.r, sum(hi - lo) AS cut, count(*) AS spans, max(hi) AS last, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept
      FROM q JOIN d USING (r) GROUP BY q.r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(cut, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN cut IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN a USING (r)
"""
