"""Line dedup by a log-template tree (operator 9, native).

Lines are parsed to a fixed depth as log lines are: fields with digits become
``<*>``, the first level of the tree is the number of tokens, the next three are
the leading tokens. The lines of a leaf vote for a template: at each position the
token with most votes. A text has one vote in a leaf, shared evenly by its
different lines there. A line belongs to the template if at least 70 % of its
tokens agree, the other positions are its variable fields. Lines that differ more
go one level down, to leaves by their token at the position with the fewest
different tokens (over one), where they vote again; so a leaf gives a template
for each of its messages. What fits none after ``LEVELS`` such levels, or is
shorter than 6 tokens, is a template of its own masked text.

A template that occurs in ``least_texts`` or more different texts is boilerplate,
and its lines are dropped from all of them. A line of ``LONG_TOKENS`` or more that
stands in fewer, but at least two, the same but for fields with digits, is a
repeated passage: it stays in the text of the smallest doc_id and is dropped from
the others. (Copies of a text count once, and all keep or lose the same lines.)

Leaves with too few lines to recur, or with one line only, never have their tokens
counted. Votes are taken on the different masked lines of the others, and lines
travel as hashes; only the final cut joins each document that may lose lines with
the numbers of its own dropped lines.

Defined cases: null and empty texts have one empty line; blank lines have no
template and stay; ties for a position's token go to the smallest, for a level's
position to the first; rows that repeat a doc_id are cut by their own text, and
of different texts with the same smallest doc_id one keeps a repeated passage (a
null doc_id comes last); texts of any length are cut whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import stored
from tallyspark.llm.exact_dedup import possibly_repeated, repeat_filter

DEPTH = 3          # leading tokens that are levels of the tree
LEVELS = 4         # rounds of votes: further levels for lines that differ from their leaf's template
LEAST_TOKENS = 6   # of a line that may have variable fields without digits
LONG_TOKENS = 20   # of a line that is a repeated passage from two texts on
VOTE = 720720      # parts of a text's vote in a leaf
SALTS = 32
PERCENT = 70       # of a line's tokens that agree with its leaf's template


def masked(line: Column) -> Column:
    """Tokens of a line, fields with digits as ``<*>``, with one space between them."""
    plain = F.btrim(line, F.lit(" \t\x0b\x0c\r"))
    free = F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, r"[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*", "<*>")).otherwise(plain)
    wide = reduce(Column.__or__, [line.contains(x) for x in ("  ", "\t", "\x0b", "\x0c", "\r")])
    return F.when(wide, F.regexp_replace(free, r"[\x20\x09-\x0D]+", " ")).otherwise(free)


def times(text: Column, char: str) -> Column:
    """How often an ASCII character stands in a text."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no, masked of every line that isn't blank, each different text once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return (rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
            .select("doc_id", "text_hash", "line_no", masked(F.col("line")).alias("masked")))


def leaf_of(text: Column) -> Column:
    return F.xxhash64(times(text, " "), F.substring_index(text, " ", DEPTH))


def needed(size: Column, least_texts: int) -> Column:
    """Different texts from which on a line of ``size`` tokens recurs."""
    return F.when(size >= LONG_TOKENS, F.lit(min(2, least_texts))).otherwise(F.lit(least_texts))


def vote(lines: DataFrame) -> DataFrame:
    """The columns of ``lines`` (leaf, line, tokens, votes, ...), the leaf's template ``shape`` and the position ``split`` of the next level."""
    counts = lines.select("leaf", "votes", F.posexplode("tokens").alias("pos", "token")).groupBy("leaf", "pos", "token").agg(F.sum("votes").alias("v"))
    most = counts.groupBy("leaf", "pos").agg(F.min(F.struct((-F.col("v")).alias("v"), "token")).alias("m"), F.count(F.lit(1)).alias("k"))
    shape = stored(most.groupBy("leaf").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("m.token").alias("token")))), lambda x: x["token"]).alias("shape"),
        F.min(F.when(F.col("k") > 1, F.struct("k", "pos")))["pos"].alias("split")), "shapes")
    return lines.join(shape, "leaf")


def templates(lines: DataFrame, least_texts: int) -> DataFrame:
    """line, template of different masked lines (leaf, line, tokens, votes, texts)."""
    long = F.size("tokens") >= LEAST_TOKENS
    own = F.xxhash64(F.lit("line"), "line")
    done = [lines.where(~long).select("line", own.alias("template"))]
    left = lines.where(long)
    for level in range(LEVELS):
        agree = F.aggregate(F.zip_with("tokens", "shape", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        judged = stored(vote(left).withColumn("fits", 100 * agree >= PERCENT * F.size("tokens")).drop("shape"), "level")
        done.append(judged.where("fits").select("line", F.xxhash64(F.lit(f"leaf{level}"), "leaf").alias("template")))
        rest = judged.where("NOT fits").withColumn("leaf", F.xxhash64("leaf", F.get("tokens", F.col("split")))).drop("fits", "split")
        # Leaves with too few texts hold nothing that recurs: their lines are their own templates already.
        full = (rest.groupBy("leaf").agg(F.sum("texts").alias("c"), F.min(needed(F.size("tokens"), least_texts)).alias("need"))
                .where("c >= need").select("leaf"))
        rest = stored(rest.join(full, "leaf", "left_semi"), "rest") if level < LEVELS - 1 else rest
        left = rest
        if level < LEVELS - 1 and rest.isEmpty():
            break
    else:
        done.append(left.select("line", own.alias("template")))
    return reduce(DataFrame.unionAll, done)


def recurring_lines(docs: DataFrame, least_texts: int = 5) -> DataFrame:
    """doc_id, text_hash, line_no of the lines to drop."""
    text, n = F.col("masked"), F.col("n")
    parsed = stored(lines_of(docs).select("doc_id", "text_hash", "line_no", leaf_of(text).alias("leaf"), F.xxhash64(text).alias("line"),
                                          (times(text, " ") + 1).alias("n"), "masked"), "parsed")   # lines are masked once
    # Leaves with lines enough, of two texts if it takes two; the others hold nothing that recurs.
    ends = [f(c).alias(f"{a}_{c}") for c in ("text_hash", "line") for f, a in ((F.min, "lo"), (F.max, "hi"))]
    leaves = stored(parsed.groupBy("leaf", needed(n, least_texts).alias("need")).agg(F.count(F.lit(1)).alias("c"), *ends)
                    .where("c >= need AND (need < 2 OR lo_text_hash < hi_text_hash)")
                    .select("leaf", F.expr("lo_line < hi_line").alias("several")), "leaves")
    some = stored(parsed.drop("masked").join(leaves, "leaf"), "lines")
    # Different lines of each different text, on one shuffle with the number of them in a leaf.
    pairs = (some.select("leaf", "line", "n", "several", "text_hash", "doc_id").repartition("leaf", "text_hash")
             .groupBy("leaf", "line", "n", "several", "text_hash").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("leaf", "text_hash"))))
    pairs = stored(pairs, "pairs")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash"))["text_hash"]
    lines = stored(pairs.groupBy("leaf", "line", "n", "several")
                   .agg(F.sum(F.floor(F.lit(VOTE) / F.col("k"))).alias("votes"), F.count(F.lit(1)).alias("texts"), first.alias("first")), "different")
    # Tokens are fetched for leaves with different lines only (a filter keeps most other lines from the shuffle); one line is its leaf's template.
    votes = F.col("several") & (n >= LEAST_TOKENS)
    maps, blocks = repeat_filter(leaves.where("several"), "leaf", least=1)
    texts = possibly_repeated(parsed.where(n >= LEAST_TOKENS).select("leaf", "line", "masked"), "leaf", stored(maps, "filter"), blocks, "maybe")
    voters = stored(texts.where("maybe").select("leaf", "line", "masked").dropDuplicates(["leaf", "line"])
                    .join(lines.where(votes).select("leaf", "line", "votes", "texts"), ["leaf", "line"])
                    .select("leaf", "line", F.split("masked", " ").alias("tokens"), "votes", "texts"), "voters")
    plain = lines.where(~votes).select("line", F.xxhash64(F.lit("line"), "line").alias("template"))
    named = stored(templates(voters, least_texts).unionAll(plain), "templates")
    # Distinct pairs first, then a count with partial sums: no task gets a template's texts.
    recur = (pairs.join(named, "line").select("template", "text_hash").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("c"))
             .where(F.col("c") >= least_texts).select("template"))
    passage = lines.where((n >= LONG_TOKENS) & (F.col("texts") >= 2)).select("line", F.col("first").alias("keeper"))
    gone = (named.join(recur, "template", "left_semi").select("line", F.lit(None).cast("long").alias("keeper")).unionAll(passage)
            # A line that is both goes from all texts.
            .groupBy("line").agg(F.when(F.count(F.lit(1)) == F.count("keeper"), F.min("keeper")).alias("keeper")))
    # Each line that goes once for each salt, so that a common one is split over SALTS tasks.
    gone = gone.select("line", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = some.select("doc_id", "text_hash", "line_no", "line", F.pmod(F.xxhash64("text_hash"), F.lit(SALTS)).cast("int").alias("salt"))
    return (salted.join(gone, ["line", "salt"]).where(~F.col("text_hash").eqNullSafe(F.col("keeper")))
            .select("doc_id", "text_hash", "line_no"))


def line_dedup(docs: DataFrame, least_texts: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines that stay): one row per input row."""
    key = F.xxhash64("doc_id", "text_hash")
    cut = stored(recurring_lines(docs, least_texts).groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("cut"))
                 .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "cut", key.alias("key")), "cut")
    text = F.coalesce(F.col("text"), F.lit(""))
    maps, blocks = repeat_filter(cut, "key", least=1)
    own = possibly_repeated(docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text")).withColumn("key", key),
                            "key", stored(maps, "filter"), blocks, "maybe").drop("key")
    # Texts that the filter rules out lose no line and aren't shuffled.
    some = own.where("maybe").drop("maybe")
    joined = (some.join(cut, some["doc_id"].eqNullSafe(F.col("id")) & (some["text_hash"] == F.col("hash")), "left").select("doc_id", "text", "cut")
              .unionAll(own.where("NOT maybe").select("doc_id", "text", F.lit(None).cast("array<int>").alias("cut"))))
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("cut"))
    kept = F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return joined.select("doc_id", (times(F.col("text"), "\n") + 1).cast("long").alias("n_lines"),
                         F.when(F.col("cut").isNull(), F.lit(0)).otherwise(F.size("cut")).cast("long").alias("n_dropped"), kept.alias("text"))


def _levels() -> str:
    """SQL of the rounds of votes: m{r} has the lines of a level with their leaf's template, l{r} those that go on."""
    out = []
    for r in range(LEVELS):
        out.append(f"""
c{r} AS (SELECT leaf, pos, tokens[pos] AS token, sum(votes) AS v FROM (SELECT *, unnest(range(1, n + 1)) AS pos FROM l{r}) GROUP BY ALL),
k{r} AS (SELECT leaf, pos, arg_min(token, (-v, token)) AS token, count(*) AS k FROM c{r} GROUP BY leaf, pos),
s{r} AS (SELECT leaf, list(token ORDER BY pos) AS shape, arg_min(pos, (k, pos)) FILTER (k > 1) AS split FROM k{r} GROUP BY leaf),
m{r} AS (SELECT l{r}.*, split, 100 * len(list_filter(range(1, n + 1), lambda i: tokens[i] = shape[i])) >= {PERCENT} * n AS fits
         FROM l{r} JOIN s{r} USING (leaf)),
l{r + 1} AS (SELECT leaf || ['{r}', tokens[split]] AS leaf, tokens, n, votes FROM m{r} WHERE NOT fits),""")
    return "".join(out)


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT r, doc_id, text, ls, unnest(range(0, len(ls))) AS line_no FROM d),
l AS (SELECT r, doc_id, text, line_no, ls[line_no + 1] AS line FROM u WHERE regexp_matches(ls[line_no + 1], '[^\x20\x09-\x0D]')),
t AS (SELECT r, doc_id, text, line_no, regexp_split_to_array(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+') AS tokens FROM l),
p AS (SELECT *, len(tokens) AS n, [len(tokens)::VARCHAR] || tokens[1:{DEPTH}] AS leaf FROM t),
q AS (SELECT leaf, tokens, n, text, {VOTE} // count(*) OVER (PARTITION BY leaf, text) AS part FROM (SELECT DISTINCT leaf, tokens, n, text FROM p)),
l0 AS (SELECT leaf, tokens, n, sum(part) AS votes FROM q WHERE n >= {LEAST_TOKENS} GROUP BY ALL),
{_levels()}
f AS ({" UNION ALL ".join(f"SELECT tokens, ['leaf{r}'] || leaf AS template FROM m{r} WHERE fits" for r in range(LEVELS))}),
x AS (SELECT p.r, p.doc_id, p.text, p.line_no, p.n, p.tokens, coalesce(f.template, ['line'] || p.tokens) AS template FROM p LEFT JOIN f USING (tokens)),
g AS (SELECT template FROM x GROUP BY template HAVING count(DISTINCT text) >= 5),
h AS (SELECT tokens, arg_min(text, (doc_id IS NULL, doc_id)) AS keeper FROM x WHERE n >= {LONG_TOKENS} GROUP BY tokens HAVING count(DISTINCT text) >= 2),
y AS (SELECT r, list(line_no) AS cut FROM x LEFT JOIN h USING (tokens) WHERE template IN (SELECT template FROM g) OR text <> keeper GROUP BY r)
SELECT doc_id, len(ls)::BIGINT AS n_lines, coalesce(len(cut), 0)::BIGINT AS n_dropped,
       sha256(array_to_string(list_filter(ls, lambda v, i: cut IS NULL OR NOT list_contains(cut, i - 1)), chr(10))) AS kept_sha256
FROM d LEFT JOIN y USING (r)
"""
