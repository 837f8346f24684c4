"""Benchmark decontamination by spaced-seed hashing (operator 5, native).

Texts become lower-cased tokens (runs of letters and digits). Fixed masks look at
5 positions of a window and ignore others, so a substituted token spoils only the
windows whose mask reads it. Mask hashes of every training window meet those of
the benchmark in a join; hits on one diagonal (training position minus item
position) of a document and an item form a candidate, whose overlap is then
verified on the tokens of the whole diagonal, substitutions allowed.

A document is contaminated by an item if, on one diagonal,

* at least 80 % of some 13 or more tokens in a row agree, or
* at least 80 % of the whole item agrees (items of 7 tokens and more), or
* all tokens of an item of 4 to 6 tokens agree, or
* the text is the item, token by token (items of 1 to 3 tokens, which stand by
  chance in many texts).

The masks miss none of these: every pattern of 7 to 25 tokens with 80 % agreeing
holds a window that some mask reads without a substitution (a test enumerates
them all), and longer stretches hold one of 13 to 25 tokens that agrees as well.
The SQL below has the same rule and finds its candidates by other means.

Only candidates need their document's tokens again, found by (doc_id, hash of
the text). A side is broadcast only if its counted bytes are within
``BROADCAST_BYTES``; beyond, the planner joins by shuffle.

Defined cases: null, empty and texts without letters and digits are clean, items
without tokens match nothing, equal items count by their own item_id, rows that
repeat a doc_id are judged by their own text, an empty benchmark leaves
everything clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import fresh, stored

MASKS = ((0, 1, 2, 4, 5), (0, 1, 2, 3, 4), (0, 1, 3, 5, 6), (0, 1, 2, 3, 6))
SHORT_MASK = (0, 1, 2, 3)   # only used if there are items of four tokens
LEAST_TOKENS = 13    # of a stretch
LEAST_ITEM = 7       # tokens of an item that may be quoted with substitutions
LEAST_QUOTED = 4     # tokens of an item that counts wherever it is quoted
PERCENT = 80
BROADCAST_BYTES = 64 << 20


def tokens_of(text: Column) -> Column:
    """Hashes of the lower-cased tokens of a text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda t: F.xxhash64(t))


def windows(df: DataFrame, keys: list[str], masks: tuple, tiny: bool) -> DataFrame:
    """keys, pos, seed: a row for each mask and window of the column ``tokens``; with ``tiny``, texts of 1 to 3 tokens give one seed of them all."""
    least = min(m[-1] for m in masks) + 1
    n = F.size("tokens") - least + 1
    rows = df.where(F.size("tokens") >= least).select(*keys, "tokens", F.explode(F.sequence(F.lit(0), n - 1)).alias("pos"))
    # Tokens are read where they stand: no row or array is made for a window. Null where a mask's window reaches over the end.
    seeds = F.array(*[F.when(F.col("pos") + mask[-1] < F.size("tokens"), F.xxhash64(F.lit(i), *[F.get("tokens", F.col("pos") + k) for k in mask]))
                      for i, mask in enumerate(masks)])
    spaced = (rows.select(*keys, F.col("pos").cast("long").alias("pos"), F.explode(seeds).alias("seed"))
              .where(F.col("seed").isNotNull()))
    if not tiny:
        return spaced
    whole = (df.where((F.size("tokens") > 0) & (F.size("tokens") < LEAST_QUOTED))
             .select(*keys, F.lit(0).cast("long").alias("pos"), F.xxhash64(F.lit(-1), "tokens").alias("seed")))
    return spaced.unionAll(whole)


def small(df: DataFrame, tokens: str | None = None) -> DataFrame:
    """Broadcast a written table if its counted bytes are few; ``tokens`` is a column of token arrays, other columns are of fixed size."""
    width = F.lit(16 * len(df.columns)) + (8 * F.size(tokens) if tokens else F.lit(0))
    total = df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def stretch(same: Column) -> Column:
    """Whether LEAST_TOKENS or more tokens in a row agree by PERCENT.

    ``same``: 1 for each token of a diagonal that agrees, 0 for others. One pass:
    ``run`` holds the last LEAST_TOKENS of them as bits, ``sum`` adds up how far
    they are over PERCENT, ``low`` is the least value it had LEAST_TOKENS or more
    tokens before.
    """
    def shifted(s: Column, x: Column) -> Column:
        run = F.shiftleft(s["run"], 1).bitwiseOR(x).bitwiseAND(F.lit((1 << LEAST_TOKENS) - 1).cast("long"))
        return F.struct(run.alias("run"), (s["n"] + 1).alias("n"), (s["sum"] + 100 * x - PERCENT).alias("sum"), s["low"].alias("low"),
                        s["found"].alias("found"))

    def judged(s: Column) -> Column:
        start = s["sum"] - 100 * F.bit_count(s["run"]).cast("long") + PERCENT * LEAST_TOKENS
        low = F.when(s["n"] >= LEAST_TOKENS, F.least(s["low"], start)).otherwise(s["low"])
        return F.struct(s["run"].alias("run"), s["n"].alias("n"), s["sum"].alias("sum"), low.alias("low"),
                        (s["found"] | (low <= s["sum"])).alias("found"))

    zero = F.lit(0).cast("long")
    none = F.struct(zero.alias("run"), zero.alias("n"), zero.alias("sum"), F.lit(1 << 62).cast("long").alias("low"), F.lit(False).alias("found"))
    # The inner transform names the step's state, so it is worked out once.
    return F.aggregate(same, none, lambda s, x: F.transform(F.array(shifted(s, x)), judged)[0], lambda s: s["found"])


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, matched, item_tokens, overlap: verified overlaps, one row for each pair and diagonal."""
    key = [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]
    train = docs.select(*key, tokens_of(F.col("text")).alias("tokens"))
    items = stored(benchmark.select("item_id", tokens_of(F.col("text")).alias("tokens")).where(F.size("tokens") > 0).distinct(), "items")
    masks = MASKS if items.where(F.size("tokens") == LEAST_QUOTED).isEmpty() else (*MASKS, SHORT_MASK)
    # A second reading of the texts for items of 1 to 3 tokens, only if there are any.
    tiny = not items.where(F.size("tokens") < LEAST_QUOTED).isEmpty()
    seeds = stored(windows(items, ["item_id"], masks, tiny).withColumnRenamed("pos", "item_pos"), "seeds")
    hits = windows(train, ["doc_id", "text_hash"], masks, tiny).join(small(seeds), "seed")
    found = stored(hits.select("doc_id", "text_hash", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct(), "candidates")
    of = stored(found.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct(), "candidate_docs")
    same = lambda d: d["doc_id"].eqNullSafe(F.col("id")) & (d["text_hash"] == F.col("hash"))
    some = (docs.select(*key, "text").join(small(of), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")),
                                           "left_semi").dropDuplicates(["doc_id", "text_hash"]))
    some = some.select("doc_id", "text_hash", tokens_of(F.col("text")).alias("tokens"))
    cand = found.withColumnsRenamed({"doc_id": "id", "text_hash": "hash"})
    item = items.withColumnRenamed("tokens", "item")
    pairs = some.join(cand, same(some)).join(small(item, "item"), "item_id")
    lo = F.greatest(F.lit(0), -F.col("diagonal")).cast("int")
    at = F.greatest(F.lit(0), F.col("diagonal")).cast("int")
    n = F.least(F.size("item") - lo, F.size("tokens") - at)
    agree = F.zip_with(F.slice("item", lo + 1, n), F.slice("tokens", at + 1, n), lambda x, y: (x == y).cast("long"))
    judged = pairs.select("doc_id", "text_hash", "item_id", F.size("item").cast("long").alias("item_tokens"),
                          F.size("tokens").cast("long").alias("text_tokens"), agree.alias("agree"))
    judged = judged.withColumn("matched", F.aggregate("agree", F.lit(0).cast("long"), lambda s, x: s + x))
    size = F.col("item_tokens")
    share = F.when(size >= LEAST_ITEM, 100 * F.col("matched") >= PERCENT * size).otherwise(
        (F.col("matched") == size) & ((size >= LEAST_QUOTED) | (size == F.col("text_tokens"))))
    return (judged.where(share | stretch(F.col("agree")))
            .select("doc_id", "text_hash", "item_id", "matched", "item_tokens", (F.col("matched") / F.col("item_tokens")).alias("overlap")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items (benchmark items found), best_overlap, contaminated: one row per input row."""
    found = overlaps(docs, benchmark).groupBy("doc_id", "text_hash").agg(
        F.countDistinct("item_id").alias("n_items"), F.max("overlap").alias("best_overlap"))
    found = stored(found.withColumnsRenamed({"doc_id": "id", "text_hash": "hash"}), "contaminated")
    key = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    return key.join(small(found), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left").select(
        "doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("best_overlap", F.lit(0.0)).alias("best_overlap"),
        F.col("n_items").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The input's rows and columns without documents that overlap a benchmark item."""
    h, i, j = fresh(docs, "__text_hash"), fresh(docs, "__id"), fresh(docs, "__hash")
    found = stored(overlaps(docs, benchmark).select(F.col("doc_id").alias(i), F.col("text_hash").alias(j)).distinct(), "contaminated")
    keyed = docs.withColumn(h, F.xxhash64(F.coalesce("text", F.lit(""))))
    bad = small(found)
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(F.col(i)) & (keyed[h] == F.col(j)), "left_anti").select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t FROM documents),
b AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t FROM benchmark),
-- 80 % of 7 or more tokens cannot agree without three in a row that do
dg AS (SELECT r, p, t[p] AS t1, t[p + 1] AS t2, t[p + 2] AS t3 FROM (SELECT r, t, unnest(range(1, len(t) - 1)) AS p FROM d WHERE len(t) >= 3)),
bg AS (SELECT item_id, t, p, t[p] AS t1, t[p + 1] AS t2, t[p + 2] AS t3 FROM (SELECT item_id, t, unnest(range(1, len(t) - 1)) AS p FROM b WHERE len(t) >= 3)),
c AS (SELECT DISTINCT dg.r, item_id, bg.t AS item, dg.p - bg.p AS diagonal FROM dg JOIN bg USING (t1, t2, t3)
      UNION ALL SELECT d.r, item_id, b.t, 0 FROM d JOIN b ON d.t = b.t WHERE len(b.t) IN (1, 2)),
v AS (SELECT c.r, item_id, len(item) AS n, len(d.t) AS size,
             list_transform(range(greatest(0, -diagonal), least(len(item), len(d.t) - diagonal)), lambda i: (item[i + 1] = d.t[i + diagonal + 1])::INT) AS s
      FROM c JOIN d USING (r)),
w AS (SELECT r, item_id, n, size, list_sum(s) AS matched, s,
             list_transform(range(0, len(s) + 1), lambda i: 100 * coalesce(list_sum(s[1:i]), 0) - 80 * i) AS sums FROM v),
g AS (SELECT r, count(DISTINCT item_id) AS n_items, max(matched / n) AS best_overlap FROM w
      WHERE CASE WHEN n >= 7 THEN 100 * matched >= 80 * n ELSE matched = n AND (n >= 4 OR n = size) END
         OR len(list_filter(range(13, len(s) + 1), lambda i: sums[i + 1] >= list_min(sums[1:i - 12]))) > 0 GROUP BY r)
SELECT doc_id, coalesce(n_items, 0) AS n_items, coalesce(best_overlap, 0.0)::DOUBLE AS best_overlap, n_items IS NOT NULL AS contaminated
FROM d LEFT JOIN g USING (r)
"""
