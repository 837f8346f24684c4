"""LM scoring by logistic context mixing (operator 2).

A text is a sequence of words (A-Z lower-cased) and one end. The model codes a
word bit by bit: each byte, and the space after it, is eight binary decisions,
and an end is a space alone.

* Bit predictors: the last 1 to 5 bytes of the text so far (across words, with one
  space between them), hashed with the bits of the current byte, select a slot of each
  order's table, which holds how often training texts went on with 0 and with 1.
* Mixing: the predictors' log odds are added up with weights; the weights' set
  is gated by the longest context that was seen. Weights are learned online, by
  gradient steps over the training texts' grams (a byte and the ``ORDERS`` before it),
  weighted by how often they occur, each predicted without one occurrence of its own;
  the sets of all tasks are averaged.
* Refinement: a map from (bits of the byte, mixed log odds) to observed odds,
  gathered online beside the weights, corrects each bit's probability. In a text, the word's mixed probability, its
  shares of the training tokens of ``KINDS`` kinds of text and its share of the
  text so far are weighted; the weights follow, at each doubling of the text's
  length, how well each has predicted its earlier tokens. (Kinds are clusters of
  training texts by byte pairs; their centres start from ``SAMPLE`` of them and are
  moved in ``ROUNDS`` rounds over all.)

Work is spread by blocks of texts and by buckets. All that a byte's bits depend on is its
gram, so the training texts' distinct grams are counted first (sorted in tasks, added up in
buckets), and bit tables, weights and refinement are made from them. Then each task codes the
grams of its texts, a distinct one once, and adds them up to the probability of each token, which
is kept in 16 bits, rounded down. Each block lists its distinct words once; buckets count them over
all blocks; blocks get counts and shares back. Counts of words and grams are exact and grow with
the corpus; bit tables have a fixed size (``TABLE_BITS``), so the broadcast does not.

Defined cases: null and empty texts are one end; with no training text all
counts are 0 and bits cost one bit each; a text's score is finite and negative;
words of any length are coded; repeated rows each count and get their own score.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import arrow_map, id_text, spark_python, stored
from tallyspark.llm.langid import fold
from tallyspark.llm.shingles import mix

BLOCK_TOKENS = 2_000_000
BLOCK_BYTES = 24 << 20
TABLE_BITS = (16, 18, 20, 21, 21)   # of the slots of the tables of order 1 to 5
ORDERS = len(TABLE_BITS)
KINDS = 6
PAIRS = 1024                         # hashed byte pairs that tell kinds apart
SAMPLE = 2000                        # texts that the centres of the kinds start from, whatever the input
ROUNDS = 2                           # over all training texts, that move the centres
FIXED = 1 << 24                      # of a share's square root in the sums
BATCH = 1024                         # grams of a gradient step
SCORED = 1 << 14                     # grams scored at once
CHUNK = 1 << 20                      # bytes whose grams are listed at once
GRAMS = 1 << 22                      # grams that a task sorts at once
GRAM_BUCKET = 20_000_000             # characters for each bucket of grams
CACHE_BITS = 21                      # of the slots that keep a task's scored grams
RATE = 0.02
WEIGHTS = (ORDERS + 1) * ORDERS
CELLS = 48                           # of the refinement map, for log odds from -12 to 12
START = b"\0" * ORDERS                # before a text's first word
_U = np.uint64
_C1, _C2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_ORDER_SEEDS = mix(np.arange(1, ORDERS + 1, dtype=_U))
_NODE_SEEDS = mix(np.arange(512, dtype=_U))


def bucket_of(word: bytes, buckets: int) -> int:
    """Bucket of a word, the same in every task."""
    return zlib.crc32(word) % buckets


# --- kinds of text -------------------------------------------------------------

def pairs(raw: np.ndarray) -> np.ndarray:
    """Square roots of the shares of byte pairs."""
    if len(raw) < 2:
        return np.zeros(PAIRS, np.float32)
    h = (raw[:-1].astype(np.uint32) << 8 | raw[1:]) * np.uint32(0x9E3779B1) >> np.uint32(22)
    return np.sqrt(np.bincount(h, minlength=PAIRS) / (len(raw) - 1)).astype(np.float32)


def centres(x: np.ndarray, rounds: int = 15) -> np.ndarray:
    """(KINDS, PAIRS) centres by k-means; each starts at the row farthest from those before."""
    if not len(x):
        return np.zeros((KINDS, PAIRS), np.float32)
    c = [x.mean(0)]
    far = np.full(len(x), np.inf)
    for _ in range(KINDS):
        far = np.minimum(far, ((x - c[-1]) ** 2).sum(1))
        c.append(x[int(far.argmax())])
    c = np.array(c[1:])
    for _ in range(rounds):
        near = kind_of(x, c)
        for k in range(KINDS):
            if (near == k).any():
                c[k] = x[near == k].mean(0)
    return c.astype(np.float32)


def kind_of(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T - (c * c).sum(1) / 2).argmax(-1)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [pairs(np.frombuffer(t.encode("utf-8", "surrogatepass").lower(), np.uint8)).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["ord", "pairs"])


def sampled_kinds(texts: DataFrame, n: int) -> np.ndarray:
    """First centres of the kinds, from about SAMPLE of the ``n`` training texts (2 * SAMPLE at most)."""
    order = F.xxhash64("doc_id", F.lit("kinds")).alias("ord")
    some = (texts.where("learn").select(order, "text").where(F.pmod("ord", F.lit(1 << 30)) < F.lit(min(1.0, SAMPLE / max(n, 1)) * (1 << 30)))
            .limit(2 * SAMPLE))
    rows = arrow_map(some, _pairs, "ord bigint, pairs binary").collect()
    return centres(np.array([np.frombuffer(r["pairs"], np.float32) for r in sorted(rows, key=lambda r: (r["ord"], bytes(r["pairs"])))]))


def _kind_sums(centre):
    """Sums of the byte pairs of a task's texts by nearest centre, in chunks; as whole numbers, so their order changes nothing. Chunk -1: the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((KINDS, PAIRS), np.int64), np.zeros(KINDS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                x = pairs(np.frombuffer(text.as_py().encode("utf-8", "surrogatepass").lower(), np.uint8))
                k = int(kind_of(x, centre))
                total[k] += np.rint(x * FIXED).astype(np.int64)
                n[k] += 1
        parts = [(k, c, part.tobytes()) for k in np.flatnonzero(n).tolist()
                 for c, part in [(-1, n[k:k + 1]), *enumerate(total[k].reshape(-1, 128))]]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts), (pa.int32(), pa.int32(), pa.binary()))], ["k", "c", "part"])
    return run


def _add_sums(rows: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x.as_buffer(), np.int64) for x in rows.column("part")], axis=0)
    return pa.table({"k": rows.column("k").slice(0, 1), "c": rows.column("c").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})


def kinds(texts: DataFrame, n: int) -> np.ndarray:
    """Centres of the kinds: those of the sample, moved in ROUNDS rounds over all training texts (one without texts stays)."""
    centre = sampled_kinds(texts, n)
    for _ in range(ROUNDS if n else 0):
        sums = arrow_map(texts.where("learn").select("text"), _kind_sums(centre), "k int, c int, part binary")
        got: dict = {(r["k"], r["c"]): np.frombuffer(r["part"], np.int64) for r in
                     sums.groupBy("k", "c").applyInArrow(_add_sums, "k int, c int, part binary").collect()}   # of a fixed size
        moved = centre.copy()
        for k in {k for k, _ in got}:
            moved[k] = np.concatenate([got[k, c] for c in range(PAIRS // 128)]) / (FIXED * float(got[k, -1][0]))
        if np.array_equal(moved, centre):
            break
        centre = moved
    return centre


# --- blocks ------------------------------------------------------------------

_TOKENS = ("block bigint, doc_id bigint, held_out boolean, n_bytes bigint, ids binary, "
           "logs binary, bucket int, words binary, lids binary, counts binary")
_TOKEN_FIELDS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_bytes", pa.int64()), ("ids", pa.binary()),
                           ("logs", pa.binary()), ("bucket", pa.int32()), ("words", pa.binary()), ("lids", pa.binary()), ("counts", pa.binary())])


def pack(ids: np.ndarray, press: zstandard.ZstdCompressor, kind: str = "<u4") -> bytes:
    """Whole numbers as planes of bytes, compressed (the upper planes are mostly 0)."""
    return press.compress(np.ascontiguousarray(ids.astype(kind).view(np.uint8).reshape(len(ids), -1).T))


def unpack(raw: bytes, open_: zstandard.ZstdDecompressor, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(open_.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def units(words: list[bytes]) -> list[bytes]:
    """Each word of a text, and its end (an empty word), after the ORDERS bytes of the text before it."""
    text = START + b" ".join(words) + b" " * bool(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    return [*[text[a:b] for a, b in zip(start.tolist(), (start + size + ORDERS).tolist())], text[-ORDERS:]]


def flat(words: list[bytes]) -> bytes:
    """A text as the model reads it: after START its words, each with a space, and a space for the end."""
    return START + b" ".join(words) + b"  "[not words:]


def grams(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Each byte of flat texts with the ORDERS bytes before it, as a number, in order; about CHUNK at once."""
    part: list = []
    size = 0
    for text in texts:
        for at in range(0, len(text) - ORDERS, CHUNK):
            part.append(text[at:at + CHUNK + ORDERS])
            size += len(part[-1])
            if size >= CHUNK:
                yield _grams(part)
                part, size = [], 0
    if part:
        yield _grams(part)


def _grams(part: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(part), np.uint8).astype(_U)
    gram = raw[ORDERS:].copy()
    for k in range(1, ORDERS + 1):
        gram |= raw[ORDERS - k:-k] << _U(8 * k)
    keep = np.ones(len(gram), bool)
    first = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))[:-1] - ORDERS
    keep[(first[:, None] + np.arange(ORDERS)).ravel()] = False   # what stands before a text is none of its bytes
    return gram[keep]


def add_up(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts (1 each)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts


def _gram_counts(buckets: int):
    """Distinct grams of a task's texts and their counts, by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        texts: list = []
        raw: list = []
        held = np.zeros(0, _U), np.zeros(0, np.int64)
        size = listed = 0

        def merge() -> tuple[np.ndarray, np.ndarray]:
            if not raw:
                return held
            keys, counts = add_up(np.concatenate(raw))
            raw.clear()
            return add_up(np.append(held[0], keys), np.append(held[1], counts))

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = held
            bucket = (mix(keys) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            full, first = np.unique(bucket[order], return_index=True)
            for b, i in zip(full.tolist(), np.split(order, first[1:])):   # keys stay in order: they are kept as steps
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([pack(np.diff(keys[i], prepend=_U(0)), press, "<u8")], pa.binary()),
                                                  pa.array([pack(counts[i], press, "<i8")], pa.binary())], ["bucket", "grams", "counts"])

        for batch in batches:
            for text in batch.column(0):
                texts.append(flat(text.as_py().encode("utf-8", "surrogatepass").lower().split()))
                size += len(texts[-1])
                if size < CHUNK:
                    continue
                for got in grams(texts):
                    raw.append(got)
                    listed += len(got)
                    if listed >= GRAMS:
                        held, listed = merge(), 0
                        if len(held[0]) >= GRAMS:
                            yield from flush()
                            held = np.zeros(0, _U), np.zeros(0, np.int64)
                texts, size = [], 0
        raw.extend(grams(texts))
        held = merge()
        if len(held[0]):
            yield from flush()
    return run


def _add_grams(rows: pa.Table) -> pa.Table:
    """Distinct grams of a bucket and their counts."""
    open_ = zstandard.ZstdDecompressor()
    press = zstandard.ZstdCompressor(level=1)
    keys, counts = add_up(np.concatenate([np.cumsum(unpack(x.as_buffer(), open_, "<u8"), dtype=_U) for x in rows.column("grams")]),
                          np.concatenate([unpack(x.as_buffer(), open_, "<i8") for x in rows.column("counts")]))
    return pa.table({"bucket": rows.column("bucket").slice(0, 1), "grams": pa.array([pack(np.diff(keys, prepend=_U(0)), press, "<u8")], pa.binary()),
                     "counts": pa.array([pack(counts, press, "<i8")], pa.binary()), "n": pa.array([len(keys)])})


def shrunk(logs: np.ndarray) -> np.ndarray:
    """log10 probabilities in 16 bits, rounded down: steps of 1/1024 bit up to 32 bits, of 1/32 bit beyond."""
    v = logs * -np.log2(10)
    return np.clip(np.ceil(np.where(v <= 32, v * 1024, 32768 + (v - 32) * 32)), 0, 65535).astype(np.uint16)


def grown(codes: np.ndarray) -> np.ndarray:
    """Probabilities of shrunk logs."""
    v = codes.astype(np.float64)
    return np.maximum(np.exp2(-np.where(v <= 32768, v / 1024, 32 + (v - 32768) / 32)), 1e-300)


class GramCoder:
    """log10 probabilities of grams; those scored lately are kept, by slot."""

    def __init__(self, model: dict):
        self.model = model
        self.keys = np.full(1 << CACHE_BITS, ~_U(0))   # no gram has 64 bits
        self.logs = np.zeros(1 << CACHE_BITS, np.float32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys * _C1 >> _U(64 - CACHE_BITS)).astype(np.int64)
        out = self.logs.take(slot)
        new = np.flatnonzero(self.keys.take(slot) != keys)
        if len(new):
            some, of = np.unique(keys[new], return_inverse=True)
            got = gram_log10(some, self.model["logs"], self.model["weights"], self.model["refined"]).astype(np.float32)
            out[new] = got[of]
            at = (some * _C1 >> _U(64 - CACHE_BITS)).astype(np.int64)
            self.keys[at] = some
            last = self.keys.take(at) == some   # of some with the same slot one stays
            self.logs[at[last]] = got[last]
        return out

    def tokens(self, texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Shrunk logs of the tokens of flat texts, from the tokens' numbers of bytes."""
        logs = np.concatenate([self(g) for g in grams(texts)])
        return shrunk(np.add.reduceat(logs, np.cumsum(sizes) - sizes, dtype=np.float64))


def _blocks(buckets: int, centre, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        coder = GramCoder(model.value)
        number = TaskContext.get().partitionId() << 32
        rows: list = []
        texts: list = []
        sizes: list = []
        codes: list = []
        known: defaultdict = defaultdict()
        known.default_factory = known.__len__
        tokens = size = pending = 0

        def code() -> None:
            codes.append(coder.tokens(texts, np.concatenate(sizes)))
            texts.clear()
            sizes.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            if texts:
                code()
            logs = np.split(np.concatenate(codes), np.cumsum([len(r[3]) for r in rows])[:-1])
            codes.clear()
            every = np.bincount(np.concatenate([r[3] for r in rows]), minlength=len(known))
            count = np.zeros((KINDS, len(known)), np.int64)
            for k in range(KINDS):
                train = [r[3] for r in rows if r[4] == k]
                if train:
                    count[k] = np.bincount(np.concatenate(train), minlength=len(known))
            order = np.argsort(-every, kind="stable")   # frequent words get small numbers
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            for at in range(0, len(rows), 1000):
                part = rows[at:at + 1000]
                yield _tokens(block=[number] * len(part), doc_id=[r[0] for r in part], held_out=[r[1] for r in part],
                              n_bytes=[r[2] for r in part], ids=[pack(rank[r[3]], press) for r in part],
                              logs=[pack(x, press, "<u2") for x in logs[at:at + 1000]])
            words = list(known)
            bucket = np.fromiter((bucket_of(w, buckets) for w in words), np.int64, len(words))
            order = order[np.argsort(bucket[order], kind="stable")]   # by bucket, then by number: numbers are kept as steps
            full, first = np.unique(bucket[order], return_index=True)
            by = np.split(order, first[1:])
            yield _tokens(block=[number] * len(full), bucket=full.tolist(), words=[b" ".join([words[i] for i in b.tolist()]) for b in by],
                          lids=[pack(np.diff(rank[b], prepend=0), press) for b in by], counts=[press.compress(count[:, b].tobytes()) for b in by])

        for batch in batches:
            for doc_id, held, learn, text in zip(*(batch.column(i) for i in range(4))):
                raw = text.as_py().encode("utf-8", "surrogatepass").lower()
                kind = int(kind_of(pairs(np.frombuffer(raw, np.uint8)), centre)) if learn.as_py() else -1
                words = raw.split()
                texts.append(flat(words))
                words.append(b"")                   # the end
                ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                sizes.append(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                n = len(texts[-1]) - ORDERS
                rows.append((doc_id.as_py(), held.as_py(), n, ids, kind))
                tokens, size, pending = tokens + len(ids), size + n, pending + n
                if pending >= CHUNK:
                    code()
                    pending = 0
                if tokens >= BLOCK_TOKENS or size >= BLOCK_BYTES or len(known) > 1 << 22:
                    yield from flush()
                    rows, tokens, size, pending, number = [], 0, 0, 0, number + 1
                    known.clear()
                    pa.default_memory_pool().release_unused()
        if rows:
            yield from flush()
    return run


def _tokens(**cols: list) -> pa.RecordBatch:
    n = len(cols["block"])
    return pa.RecordBatch.from_arrays([pa.array(cols.get(f.name, [None] * n), f.type) for f in _TOKEN_FIELDS], schema=_TOKEN_FIELDS)


# --- buckets of words ----------------------------------------------------------

def _count(rows: pa.Table) -> pa.Table:
    """Distinct words of a bucket, in order, and their counts in training texts of each kind."""
    open_ = zstandard.ZstdDecompressor()
    place: defaultdict = defaultdict()
    place.default_factory = place.__len__
    parts = []
    for words, counts in zip(rows.column("words").to_pylist(), rows.column("counts").to_pylist()):
        words = words.split(b" ")
        parts.append((np.fromiter(map(place.__getitem__, words), np.int64, len(words)), np.frombuffer(open_.decompress(counts), np.int64).reshape(KINDS, -1)))
    total = np.zeros((KINDS, len(place)), np.int64)
    for i, c in parts:
        total[:, i] += c   # a block lists a word once
    words = sorted(place)
    total = total[:, np.fromiter(map(place.__getitem__, words), np.int64, len(words))]
    return pa.table({"bucket": rows.column("bucket").slice(0, 1), "words": pa.array([b" ".join(words)], pa.binary()),
                     "by_kind": pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())], pa.binary()),
                     "per_kind": pa.array([total.sum(1).tolist()], pa.list_(pa.int64())), "types": pa.array([int((total.sum(0) > 0).sum())])})


# --- bits ----------------------------------------------------------------------

def positions(words: list[bytes], before: bytes = START) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of words that all follow the same bytes (each ends with a space), as :func:`gram_positions`, and each symbol's word."""
    of = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 1)
    return *gram_positions(np.concatenate([*grams([before + w + b" " for w in words])])), of


def gram_positions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of grams, and (ORDERS, symbols) hashes of the 1 to ORDERS bytes before each."""
    context = np.empty((ORDERS, len(keys)), _U)
    h = np.zeros(len(keys), _U)
    for k in range(ORDERS):
        h = (h ^ (h >> _U(31))) * _C1 + (keys >> _U(8 * (k + 1)) & _U(255)) + _U(1)
        context[k] = mix(h + _ORDER_SEEDS[k])
    return (keys & _U(255)).astype(np.int64), context


def bits(symbols: np.ndarray, context: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each of the eight bits: the node in the byte, the bit, and the slot in each order's table."""
    for j in range(8):
        node = 1 << j | symbols >> 8 - j
        seed = _NODE_SEEDS[node]
        slots = []
        for k in range(ORDERS):
            h = (context[k] ^ seed) * _C2
            slots.append((h >> _U(64 - TABLE_BITS[k])).astype(np.int64))
        yield node, symbols >> 7 - j & 1, slots


def odds(tables: list[np.ndarray], slots: list[np.ndarray], bit: np.ndarray | None = None, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ORDERS, bits) log odds of a 1, and the gate: the longest context that was seen. ``own`` counts are left out."""
    x = np.empty((ORDERS, len(slots[0])), np.float32)
    gate = np.zeros(len(slots[0]), np.int64)
    if own is not None:
        own_one = (own * bit).astype(np.float32)
        own_zero = own.astype(np.float32) - own_one
    for k in range(ORDERS):
        n = tables[k].view(np.complex64).ravel().take(slots[k])   # both counts at once
        zero, one = n.real, n.imag
        if own is not None:
            zero, one = np.maximum(zero - own_zero, 0), np.maximum(one - own_one, 0)
        x[k] = np.log((one + np.float32(0.4)) / (zero + np.float32(0.4)))
        gate[zero + one > 0] = k + 1
    return x, gate


def mixed(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip((weights.T.take(gate, axis=1) * x).sum(0), -11.9, 11.9)


def _cell(node: np.ndarray, s: np.ndarray) -> np.ndarray:
    return node * CELLS + ((s + 12) * (CELLS / 24)).astype(np.int64)


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of training texts and their counts, BATCH at a time, in an order that has nothing to do with their bytes."""
    open_ = zstandard.ZstdDecompressor()
    for batch in batches:
        for keys, counts in zip(batch.column(0), batch.column(1)):
            keys, counts = np.cumsum(unpack(keys.as_buffer(), open_, "<u8"), dtype=_U), unpack(counts.as_buffer(), open_, "<i8")
            order = np.argsort(mix(keys), kind="stable")
            for at in range(0, len(order), BATCH):
                i = order[at:at + BATCH]
                yield keys[i], counts[i]


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bit counts of the grams of a task, in chunks of slots."""
    tables = [np.zeros(2 << b, np.int64) for b in TABLE_BITS]
    for keys, counts in _gram_rows(batches):
        for _, bit, slots in bits(*gram_positions(keys)):
            for t, s in zip(tables, slots):
                np.add.at(t, 2 * s + bit, counts)
    for k, t in enumerate(tables):
        for c, part in enumerate(t.reshape(-1, min(len(t), 1 << 15))):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([c], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                                 ["k", "c", "part"])


def _add_parts(rows: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x.as_buffer(), np.int64) for x in rows.column("part")], axis=0)
    return pa.table({"k": rows.column("k").slice(0, 1), "c": rows.column("c").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})


def _learn(model):
    """Mixing weights learned online from a task's grams, as sums to average; and, online beside them, how often bits
    were 0 and 1 in each cell of the refinement map (cells from WEIGHTS on). A gram weighs as often as it occurs, and
    one occurrence of its own is left out of its counts. Counts of slots are exact; their log odds are of 24 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, w, steps, seen = model.value["tables"], np.full((ORDERS + 1, ORDERS), 0.3), 0, np.zeros((2, 256 * CELLS))
        for keys, counts in _gram_rows(batches):
            own = np.ones(len(keys))
            for node, bit, slots in bits(*gram_positions(keys)):
                x, gate = odds(tables, slots, bit, own)
                s = mixed(x, gate, w)
                error = counts * (bit - 1 / (1 + np.exp(-s)))
                n = np.maximum(np.bincount(gate, counts, ORDERS + 1), 1)
                for k in range(ORDERS):
                    w[:, k] += RATE * np.bincount(gate, error * x[k], ORDERS + 1) / n
                at = (1 << node[0].item().bit_length() - 1) * CELLS   # the bit's nodes are at .. 2 * at
                cell = _cell(node, s) - at
                ones = np.bincount(cell, bit * counts, at)
                seen[1, at:2 * at] += ones
                seen[0, at:2 * at] += np.bincount(cell, counts, at) - ones
            steps += 1
        if steps:
            held = np.flatnonzero(seen.sum(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(np.arange(WEIGHTS), WEIGHTS + held)), pa.array(np.append(w.ravel() * steps, seen[0, held])),
                 pa.array(np.append(np.full(WEIGHTS, float(steps)), seen[1, held]))], ["cell", "a", "b"])
    return run


def log_tables(tables: list[np.ndarray]) -> list[np.ndarray]:
    """Log odds of each slot, NaN for those that weren't seen: all that scoring needs, a half of the counts' size."""
    return [np.where(t.sum(1) > 0, np.log((t[:, 1] + np.float32(0.4)) / (t[:, 0] + np.float32(0.4))), np.float32("nan")) for t in tables]


def word_log10(words: list[bytes], logs: list[np.ndarray], weights: np.ndarray, refined: np.ndarray, before: bytes = START) -> np.ndarray:
    """log10 of the probability that the mixed bit predictors give each word, and the space after it, after the same bytes."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    keys = np.concatenate([*grams([before + w + b" " for w in words])])
    return np.bincount(np.repeat(np.arange(len(words)), size), gram_log10(keys, logs, weights, refined), len(words))


def gram_log10(keys: np.ndarray, logs: list[np.ndarray], weights: np.ndarray, refined: np.ndarray) -> np.ndarray:
    """log10 of the probability that the mixed bit predictors give each gram's last byte after the bytes before it."""
    out = np.zeros(len(keys))
    for at in range(0, len(keys), SCORED):
        part = keys[at:at + SCORED]
        for node, bit, slots in bits(*gram_positions(part)):
            x, gate = np.empty((ORDERS, len(bit)), np.float32), np.zeros(len(bit), np.int64)
            for k, log in enumerate(logs):
                log.take(slots[k], out=x[k], mode="clip")   # a slot is within its table
                gate[x[k] == x[k]] = k + 1
            s = mixed(np.where(x == x, x, np.float32(0)), gate, weights)
            p = (1 / (1 + np.exp(-s)) + refined[_cell(node, s)]) / 2
            out[at:at + len(part)] += np.log10(np.where(bit == 1, p, 1 - p))
    return out


# --- counts back to blocks -----------------------------------------------------

def coarse(share: np.ndarray) -> np.ndarray:
    """Shares as 16-bit logs, rounded down (so they add up to 1 at most); 0 stays 0."""
    with np.errstate(divide="ignore"):
        return np.where(share > 0, np.clip(np.floor((np.log2(share) + 63) * 1024), 1, 65535), 0).astype(np.uint16)


def fine(logs: np.ndarray) -> np.ndarray:
    return np.where(logs > 0, np.exp2(logs / 1024.0 - 63), 0.0)


def _share_words(per_kind: np.ndarray):
    """Counts of a bucket's words, and their shares of each kind, for the blocks that list them."""
    def run(known: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict = {"block": [], "lids": [], "counts": [], "shares": []}
        if known.num_rows:
            words = known.column("words")[0].as_py().split(b" ")
            by = np.frombuffer(zstandard.ZstdDecompressor().decompress(known.column("by_kind")[0].as_py()), np.int64).reshape(KINDS, -1)
            counts, shares = by.sum(0), coarse(by / np.maximum(per_kind, 1)[:, None])
            press = zstandard.ZstdCompressor(level=1)
            place = {w: i for i, w in enumerate(words)}
            for block, own, lids in zip(*(asked.column(c).to_pylist() for c in ("block", "words", "lids"))):
                i = np.fromiter(map(place.__getitem__, own.split(b" ")), np.int64)
                out["block"].append(block)
                out["lids"].append(lids)
                out["counts"].append(pack(counts[i], press, "<i8"))
                out["shares"].append(press.compress(shares[:, i].tobytes()))
        return pa.table({"block": pa.array(out["block"], pa.int64()), **{k: pa.array(out[k], pa.binary()) for k in ("lids", "counts", "shares")}})
    return run


def earlier(ids: np.ndarray) -> np.ndarray:
    """How often each token occurred before in the sequence."""
    order = np.argsort(ids, kind="stable")
    s = ids[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    out = np.empty(len(ids), np.int64)
    out[order] = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    return out


def sequence_log10(shares: np.ndarray, mixed_p: np.ndarray, before: np.ndarray, prior: np.ndarray) -> float:
    """log10 probability of a sequence from predictors whose weights adapt at each doubling of its length.

    ``shares``: (kinds, tokens); ``prior``: of the kinds. ``before`` counts each
    token's earlier occurrences; that predictor's mass is what isn't new.
    """
    n = len(mixed_p)
    p = np.concatenate([shares, [mixed_p, before / (np.arange(n) + 8.0)]])
    v = np.append(prior * 0.75, [0.2, 0.05])
    total, at, step = 0.0, 0, 8
    seen = v * 4
    while at < n:
        to = min(n, at + step)
        both = v @ p[:, at:to]
        total += float(np.log10(both).sum())
        seen = seen + v * (p[:, at:to] @ (1 / both))
        v = seen / seen.sum()
        at, step = to, to
    return total


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint"


def _score_texts(n: int, types: int, prior: np.ndarray):
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        lids = [np.cumsum(unpack(x.as_buffer(), open_)) for x in words.column("lids")]
        size = sum(map(len, lids))
        count, shares = np.zeros(size, np.int64), np.zeros((KINDS, size), np.uint16)
        for i, c, h in zip(lids, words.column("counts"), words.column("shares")):
            count[i] = unpack(c.as_buffer(), open_, "<i8")
            shares[:, i] = np.frombuffer(open_.decompress(h.as_buffer()), np.uint16).reshape(KINDS, -1)
        share = fine(shares).astype(np.float32)   # once for each word of the block
        base = np.log10((count + 1) / (n + types + 1))
        out: dict = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        for raw, logs in zip(texts.column("ids").to_pylist(), texts.column("logs").to_pylist()):
            ids = unpack(raw, open_)
            out["n_tokens"].append(len(ids))
            out["n_known"].append(int((count[ids] > 0).sum()))
            out["base_score"].append(float(base[ids].sum()))
            out["score"].append(sequence_log10(share[:, ids], grown(unpack(logs, open_, "<u2")), earlier(ids), prior))
        return pa.table({"doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), **out, "n_bytes": texts.column("n_bytes")})
    return run


def lm_scores(docs: DataFrame, folds: int = 7, held: int = 2, bucket_words: int = 100_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte: one row per input row.

    Learns from the rows whose crc32(doc_id) mod ``folds`` isn't ``held`` (rows
    without a doc_id aren't learned from); ``bits_per_byte`` is over the words,
    the spaces between them and the end.
    """
    spark = docs.sparkSession
    spark_python(spark)
    out_fold = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    learn = F.coalesce(fold(F.col("doc_id"), folds) != held, F.lit(False))
    texts = id_text(docs).select("doc_id", out_fold.alias("held_out"), learn.alias("learn"), "text")
    bounds = texts.agg(F.sum(F.length("text").cast("long")).alias("n"), F.sum(F.col("learn").cast("long")).alias("ends")).first()
    ends = bounds["ends"] or 0
    size = bounds["n"] or 0
    centred = kinds(texts, ends)
    listed = arrow_map(texts.where("learn").select("text"), _gram_counts(max(16, min(1 << 16, -(-size // GRAM_BUCKET)))), "bucket int, grams binary, counts binary")
    counted = stored(listed.groupBy("bucket").applyInArrow(_add_grams, "bucket int, grams binary, counts binary, n bigint"), "grams")
    distinct = counted.agg(F.sum("n").alias("n")).first()["n"] or 0
    tasks = max(4, min(1024, distinct // 1_000_000 + 1))   # whole buckets in order: however the table lies, each task learns the same
    rows = counted.repartition(tasks, "bucket").sortWithinPartitions("bucket").select("grams", "counts")

    tables = [np.zeros(2 << b, np.int64) for b in TABLE_BITS]
    summed = arrow_map(rows, _tables, "k int, c int, part binary").groupBy("k", "c").applyInArrow(_add_parts, "k int, c int, part binary")
    for r in stored(summed, "tables").toLocalIterator():   # of a fixed size
        part = np.frombuffer(r["part"], np.int64)
        tables[r["k"]][r["c"] * len(part):(r["c"] + 1) * len(part)] = part
    tables = [t.astype(np.float32).reshape(-1, 2) for t in tables]
    share = spark.sparkContext.broadcast
    model = share({"tables": tables})

    weights = np.full(WEIGHTS, 0.3)
    centre = 1 / (1 + np.exp(-((np.arange(CELLS) + 0.5) * (24 / CELLS) - 12)))
    refined = np.tile(centre, 256)
    for r in (arrow_map(rows, _learn(model), "cell bigint, a double, b double").groupBy("cell")
              .agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()):   # of a fixed size
        if r["cell"] < WEIGHTS:
            weights[r["cell"]] = r["a"] / r["b"]
        else:
            i = r["cell"] - WEIGHTS
            refined[i] = (r["b"] + 8 * refined[i]) / (r["a"] + r["b"] + 8)
    final = {"logs": log_tables(tables), "weights": weights.reshape(ORDERS + 1, ORDERS), "refined": np.clip(refined, 1e-6, 1 - 1e-6)}
    model.unpersist()   # the counts; scoring needs the logs only
    model = share(final)

    buckets = max(16, min(1 << 16, -(-size // (60 * bucket_words))))   # about a tenth of the words are new
    tokens = stored(arrow_map(texts, _blocks(buckets, centred, model), _TOKENS), "tokens")
    listed = tokens.where("words IS NOT NULL").select("block", "bucket", "words", "lids", "counts")
    words = stored(listed.select("bucket", "words", "counts").groupBy("bucket")
                   .applyInArrow(_count, "bucket int, words binary, by_kind binary, per_kind array<bigint>, types bigint"), "words")
    total = words.agg(F.sum("types").alias("types"), *[F.sum(F.col("per_kind")[k]).alias(f"n{k}") for k in range(KINDS)]).first()
    per_kind = np.array([total[f"n{k}"] or 0 for k in range(KINDS)], np.int64)
    n, types = int(per_kind.sum()), total["types"] or 0   # ends are tokens
    prior = (per_kind + 1) / (per_kind + 1).sum()
    shared = (words.select("bucket", "words", "by_kind").groupBy("bucket").cogroup(listed.select("block", "bucket", "words", "lids").groupBy("bucket"))
              .applyInArrow(_share_words(per_kind), "block bigint, lids binary, counts binary, shares binary"))
    result = (tokens.where("ids IS NOT NULL").select("block", "doc_id", "held_out", "n_bytes", "ids", "logs").groupBy("block")
              .cogroup(shared.groupBy("block")).applyInArrow(_score_texts(n, types, prior), _SCORES))
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
                         (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))
