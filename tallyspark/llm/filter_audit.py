"""What five text filters remove in every order, with duplicates found by radix text tries.

1. *Adaptive prefixes.* Distinct texts are weighed by their first characters; a prefix
   that is too heavy for one task is weighed again with more characters. Cutting the
   sorted prefixes at even weights gives ranges of texts, one for each trie.
2. *Tries.* Each task reads whole texts, finds the failures of A to D and inserts the
   texts into a compressed trie whose terminals hold the smallest id. Copies in the
   same task are settled there, so a group of copies sends one text per task and
   no range grows with it. The texts that are left go to their range, whose trie holds
   the smallest id of all; a traversal gives the duplicate flags.
3. *Masks.* A document is then five bits, a part and its labels; counts of equal masks
   are all that the 120 orders need.

Defined results: a null text is empty, a null lang is the part ''; a null doc_id is
compared with no other (never fails E, makes none fail); rows that repeat a doc_id
count each, and don't make each other fail; several label rows of a doc_id count as
one that has what any has; an empty table has no parts. Only doc_id, text, lang and
the labels' doc_id, quality, toxic are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import arrow_map, give_back, sliced, stored

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
#: Characters of the first prefix, and how much longer the next one is.
FIRST, LONGER = 8, 8
#: Bytes of distinct texts in a range: at least, at most, and not under total / RANGES (what the driver and a broadcast hold is bounded by it).
LEAST_WEIGHT, WEIGHT, RANGES = 1 << 18, 1 << 24, 1 << 20
#: Bytes of texts in a task's own trie before it is emptied.
HELD = 1 << 24

_CAPITALS, _ODD = bytes(range(65, 91)), b"#$%&*|"
_SCHEMA = "doc_id bigint, part string, mask int, n bigint, dest bigint, text string"


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see the contract of the columns in the README."""
    return _orders(_counts(failure_masks(docs), labels))


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): which filters the documents fail (bit i: letter i), n rows that agree in doc_id and part."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce("lang", F.lit("")).alias("part"))
    starts = range_starts(rows.select("text"))
    local = arrow_map(rows, lambda batches: _settle_copies(batches, starts), _SCHEMA)
    dealt = local.repartition(len(starts), "dest")
    return arrow_map(dealt, _settle_ranges, "doc_id bigint, part string, mask int, n bigint")


# ------------------------------------------------------------------ ranges

def range_starts(texts: DataFrame) -> list[str]:
    """Where the ranges of texts start, in order; the first is ''.

    The prefixes are free of each other: a heavy one is replaced by its longer ones. There are at most
    RANGES heavy prefixes and starts, whatever the input.
    """
    spark = texts.sparkSession
    weight, heavy, chars, light = None, None, FIRST, []
    while True:
        rows = texts.select(F.substring("text", 1, chars).alias("prefix"), F.xxhash64("text").alias("hash"),
                            F.octet_length("text").cast("bigint").alias("bytes"),
                            F.xxhash64(F.substring("text", 1, chars // LONGER)).alias("shorter"))
        if heavy is not None:
            rows = rows.join(F.broadcast(heavy), "shorter", "left_semi")
        census = stored(rows.groupBy("prefix", "hash").agg(F.max("bytes").alias("bytes"))
                        .groupBy("prefix").agg(F.sum("bytes").alias("bytes")), "prefix-census")
        if weight is None:
            total = census.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
            even = total // int(spark.conf.get("spark.sql.shuffle.partitions"))
            weight = max(total // RANGES + 1, min(WEIGHT, max(LEAST_WEIGHT, even)))
        too_heavy = (F.col("bytes") > weight) & (F.length("prefix") == chars)
        light.append(census.where(~too_heavy))
        heavy = stored(census.where(too_heavy).select(F.xxhash64("prefix").alias("shorter")), "heavy-prefixes")
        if heavy.isEmpty():
            break
        chars *= LONGER
    prefixes = light[0]
    for more in light[1:]:
        prefixes = prefixes.unionByName(more)
    ordered = stored(prefixes.orderBy("prefix").withColumn("run", F.spark_partition_id()), "prefixes")
    before, sums = 0, {}
    for r in ordered.groupBy("run").agg(F.sum("bytes").alias("bytes")).orderBy("run").collect():   # a row per task
        sums[r["run"]], before = before, before + r["bytes"]
    if not sums:
        return [""]
    in_run = Window.partitionBy("run").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.create_map(*[F.lit(x) for pair in sums.items() for x in pair])[F.col("run")]
    numbered = ordered.withColumn("range", F.floor((offset + F.coalesce(F.sum("bytes").over(in_run), F.lit(0))) / weight))
    starts = [r["start"] for r in numbered.groupBy("range").agg(F.min("prefix").alias("start")).orderBy("range").collect()]
    return ["", *starts[1:]]


# ------------------------------------------------------------------ tries

class Node:
    __slots__ = ("label", "kids", "least", "rows")

    def __init__(self, label: bytes):
        self.label, self.kids, self.least, self.rows = label, None, None, None


def _shared(label: bytes, text: bytes, at: int) -> int:
    """How many first bytes of the label stand in the text at a place (by halving)."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if text.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Compressed trie of whole texts; a terminal holds the smallest id and the rows that end there."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, text: bytes, doc_id: int, row: tuple) -> None:
        node, at = self.root, 0
        while at < len(text):
            kids = node.kids
            if kids is None:
                kids = node.kids = {}
            kid = kids.get(text[at])
            if kid is None:
                kid = kids[text[at]] = Node(text[at:])
            elif not text.startswith(kid.label, at):
                k = _shared(kid.label, text, at)
                fork = kids[text[at]] = Node(kid.label[:k])
                kid.label = kid.label[k:]
                fork.kids = {kid.label[0]: kid}
                kid = fork
            node, at = kid, at + len(kid.label)
        if node.least is None:
            node.least, node.rows = doc_id, []
        node.least = min(node.least, doc_id)
        node.rows.append(row)

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """(text, terminal) of every text."""
        stack = [(b"", self.root)]
        while stack:
            before, node = stack.pop()
            text = before + node.label
            if node.rows:
                yield text, node
            stack.extend((text, kid) for kid in (node.kids or {}).values())


def text_failures(raw: bytes, points: int) -> int:
    """Bits of the filters A to D for a text in UTF-8 with so many code points."""
    words = raw.split()      # at [\x20\x09-\x0D], as bytes split
    return ((len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1
            | (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 10 * points) << 2
            | (len(raw.translate(None, _ODD)) < len(raw)) << 3)


class _Out:
    """Rows of a schema, given out in batches of a few megabytes."""

    def __init__(self, names: list[str], kinds: list):
        self.schema = pa.schema(list(zip(names, kinds, strict=True)))
        self.rows, self.bytes = [], 0

    def add(self, row: tuple, size: int = 64) -> bool:
        self.rows.append(row)
        self.bytes += size
        return self.bytes >= 1 << 22

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(self.schema)
        out = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.bytes = [], 0
        return out


def _settle_copies(batches: Iterator[pa.RecordBatch], starts: list[str]) -> Iterator[pa.RecordBatch]:
    """Masks of a task's documents. Copies of a text with a smaller id in the task are done; the others carry their text to its range."""
    out = _Out(["doc_id", "part", "mask", "n", "dest", "text"], [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()])
    trie, held, turn = RadixTrie(), 0, 0

    def emptied() -> Iterator[pa.RecordBatch]:
        nonlocal turn
        for text, node in trie.terminals():
            least: dict[tuple, int] = {}
            for doc_id, part, mask in node.rows:
                if doc_id > node.least:
                    turn += 1
                    if out.add((doc_id, part, mask | DUPLICATE, 1, turn % len(starts), None)):
                        yield out.batch()
                else:
                    least[part, mask] = least.get((part, mask), 0) + 1
            whole = text.decode()
            dest = bisect_right(starts, whole) - 1
            for (part, mask), n in least.items():
                if out.add((node.least, part, mask, n, dest, whole), 64 + len(text)):
                    yield out.batch()

    for batch in batches:
        for b in sliced(batch):
            for doc_id, text, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = text.encode()
                mask = text_failures(raw, len(text))
                if doc_id is None:
                    turn += 1
                    if out.add((None, part, mask, 1, turn % len(starts), None)):
                        yield out.batch()
                    continue
                trie.insert(raw, doc_id, (doc_id, part, mask))
                held += len(raw) + 200
            if held >= HELD:
                yield from emptied()
                trie, held = RadixTrie(), 0
    yield from emptied()
    yield out.batch()


def _settle_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Duplicate flags of a range's texts; rows without a text are settled already."""
    out = _Out(["doc_id", "part", "mask", "n"], [pa.int64(), pa.string(), pa.int32(), pa.int64()])
    trie = RadixTrie()
    for b in batches:
        for doc_id, part, mask, n, _, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if text is not None:
                trie.insert(text.encode(), doc_id, (doc_id, part, mask, n))
            elif out.add((doc_id, part, mask, n)):
                yield out.batch()
    for _, node in trie.terminals():
        for doc_id, part, mask, n in node.rows:
            if out.add((doc_id, part, mask | (DUPLICATE if doc_id > node.least else 0), n)):
                yield out.batch()
    yield out.batch()
    give_back()


# ------------------------------------------------------------------ orders

def _counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, all, good, toxic): for each part three arrays with a count for each of the 32 masks."""
    has: Callable[[str], Column] = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", "toxic").where(
        F.col("doc_id").isNotNull()).groupBy("doc_id").agg(has("quality"), has("toxic"))
    marked = masks.join(marks, "doc_id", "left").fillna(0, ["quality", "toxic"])
    equal = marked.groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n"))

    def counts(when: str, name: str) -> Column:
        return F.expr("array(" + ", ".join(f"coalesce(sum(CASE WHEN {when} AND mask = {m} THEN n END), 0)"
                                           for m in range(1 << len(FILTERS))) + ")").alias(name)

    return equal.groupBy("part").agg(counts("true", "every"), counts("quality = 1", "good"), counts("toxic = 1", "toxic"))


def _steps() -> Column:
    """(filter_order, step, bit, before) of every order and step: the step's filter and those before it as bits."""
    rows = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(x) for x in order]
        rows += [f"named_struct('filter_order', '{"".join(order)}', 'step', {i + 1}, 'bit', {b}, 'before', {sum(bits[:i])})"
                 for i, b in enumerate(bits)]
    return F.expr(f"array({', '.join(rows)})")


def _orders(counts: DataFrame) -> DataFrame:
    size = 1 << len(FILTERS)
    rows = counts.select("part", "every", "good", "toxic", F.inline(_steps()))
    bit, before = F.col("bit"), F.col("before")

    def total(name: str, fits: Callable[[Column], Column]) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), F.lit(0).cast("bigint"),
                           lambda a, m: a + F.when(fits(m), F.element_at(F.col(name), m + 1)).otherwise(F.lit(0)))

    def removed(m: Column) -> Column:
        return (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) == 0)

    # Of a document that fails f filters, each removes it in 120 / f of the orders: those where it comes first of them.
    shares = F.array(*[F.lit(0 if not m else 120 // bin(m).count("1")) for m in range(size)])
    shapley = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), F.lit(0).cast("bigint"), lambda a, m: a + F.when(
        m.bitwiseAND(bit) != 0, F.element_at(F.col("every"), m + 1) * F.element_at(shares, m + 1)).otherwise(F.lit(0)))
    return rows.select(
        "part", "filter_order", "step",
        total("every", lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total("every", removed).alias("removed"),
        total("every", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        F.element_at("every", bit + 1).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"), shapley.alias("shapley"))


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
e AS (SELECT text, min(doc_id) AS least FROM w WHERE doc_id IS NOT NULL GROUP BY text),
f AS (SELECT w.part, w.doc_id, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
    100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 10 * length(w.text), regexp_matches(w.text, '[#$%&*|]'),
    coalesce(w.doc_id > e.least, false)] AS fails FROM w LEFT JOIN e USING (text)),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
i AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, 15 - a.i - b.i - c.i - d.i] AS o FROM i a JOIN i b ON b.i <> a.i JOIN i c ON c.i NOT IN (a.i, b.i)
    JOIN i d ON d.i NOT IN (a.i, b.i, c.i)),
s AS (SELECT o, array_to_string(list_transform(o, lambda x: chr((64 + x)::INTEGER)), '') AS filter_order, i AS step, o[i] AS f, o[1:i - 1] AS before FROM o, i),
r AS (SELECT m.part, s.filter_order, s.step::INTEGER AS step, s.f,
    sum(CASE WHEN NOT fails[f] AND len(list_filter(before, lambda x: fails[x])) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails[f] AND len(list_filter(before, lambda x: fails[x])) = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails[f] AND len(list_filter(before, lambda x: fails[x])) > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails[f] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails[f] AND len(list_filter(before, lambda x: fails[x])) = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails[f] AND len(list_filter(before, lambda x: fails[x])) = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""
