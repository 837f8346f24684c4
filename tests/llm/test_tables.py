"""Conversation trie, top-k search and filter audit, against brute force on small tables with all edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import filter_audit, prefix_trie, topk_search
from tests.llm.fixtures import CLASHES, frame, prose, rows


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def odd(df, *own):
    """The table with columns whose names operators use inside."""
    names = [*CLASHES, "conv", "at", "piece", "length", "name", "top", "part", "place", "base", "own", "skip", "head", "grp", "team",
             "comps", "rank", "prefix", "mask", "n", "dest", "run", "every"]
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(dict.fromkeys(names)) if c.lower() not in own])


# ------------------------------------------------------------------ conversation trie

def turns():
    r, out = random.Random(3), []
    for c in [*range(0, 40), 100, 205, 206, 207, 350, -5, -100, 1003]:
        n = r.choice([1, 2, 3, 4, 6, 9])
        out += [(c, t, r.choice(["user", "assistant"]), r.choice(["hi", "yes", "no", "", "é中"])) for t in range(n)]
    out += [(c, t, "user", f"same {t}") for c in range(400, 430) for t in range(5)]          # copies
    out += [(500, t, "user", "long" if t % 3 else f"x{t}") for t in range(70)]                # a long conversation
    out += [(501, t, "user", "long" if t % 3 else f"x{t}") for t in range(70)]
    out += [(600, None, "user", "first"), (600, 0, None, None), (600, 1, "", ""), (600, 1, "", ""), (600, 1, "a", "tie")]
    out += [(None, 0, "user", "nobody's"), (700, -1, "user", "w" * 5000)]
    return out


def brute_trie(rows):
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - math.fmod(c, 100), [])[:h] + own[c][h:])
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n],
                    sha(",".join(map(str, sorted(ends[n]))))) for n, m in members.items()), key=repr)


TURNS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("batch", [10000, 7])
def test_conversation_trie(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)   # small batches: a node's ids in many chunks
    try:
        data = turns()
        got = prefix_trie.conversation_trie(odd(spark.createDataFrame(data, TURNS).repartition(7), "conv_id", "turn", "role", "text"))
        assert collected(got) == brute_trie(data)
        assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_conversation_trie_small(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(1, 99)}
    turnless = next(c for c in h if h[c] >= 2)      # its own turns are skipped, and there is no conversation 0
    for data in ([(turnless, 0, "user", "gone"), (turnless, 1, "user", "gone")], [(0, 0, "user", "only")],
                 [(None, 0, "user", "nobody's")]):
        assert collected(prefix_trie.conversation_trie(spark.createDataFrame(data, TURNS))) == brute_trie(data) or data[0][0] is None
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x")], TURNS)).collect() == []


# ------------------------------------------------------------------ top-k search

def vectors(n=900, width=16):
    r = random.Random(5)
    out = [(i, [r.gauss(0, 0.2) for _ in range(width)]) for i in range(n)]
    out += [(n + i, out[7][1]) for i in range(300)]                                    # one very common vector
    out += [(20, out[3][1]), (20, out[4][1]), (None, out[5][1]), (None, out[5][1])]     # repeated and null ids
    out += [(4000, None), (4020, [1.0, None] + [0.0] * 14), (4040, [math.nan] * 16), (4060, [math.inf] * 16), (4080, []),
            (4100, [0.5] * 3), (4120, [0.5] * 20), (-40, out[9][1])]
    r.shuffle(out)
    return out


def brute_top_k(rows, k=20):
    fine = [(i, [math.floor(min(max(x * 64, -2.0 ** 62), 2.0 ** 62)) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(fine):
        if i is None or i % 20:
            continue
        scored = sorted((-max(min(sum(x * y for x, y in zip(q, v)), 2 ** 63 - 1), -2 ** 63), j is None, j or 0) for b, (j, v) in enumerate(fine) if b != a)
        out += [(i, rank + 1, None if none else j, -s) for rank, (s, none, j) in enumerate(scored[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shape", [(4096, 512, 4, 8, 64), (50, 8, 2, 2, 2)])
def test_top_k(spark, shape, monkeypatch):
    for name, value in zip(("SHARD", "BLOCK", "SHARDS", "BLOCKS", "FAN"), shape):
        monkeypatch.setattr(topk_search, name, value)
    data = vectors()
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    got = topk_search.top_k(odd(df.repartition(3), "vec_id", "embedding"))
    assert collected(got) == brute_top_k(data)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and dict(got.dtypes)["rank"] == "int"


@pytest.mark.parametrize("size", [1e3, 1e8, 1e17, 1e300])
def test_top_k_of_large_components(spark, size):
    r = random.Random(1)
    data = [(i, [r.uniform(-size, size) for _ in range(5)]) for i in range(60)]
    got = topk_search.top_k(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"))
    assert collected(got) == brute_top_k(data)


def test_top_k_small(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert topk_search.top_k(spark.createDataFrame([], kind)).collect() == []
    assert topk_search.top_k(spark.createDataFrame([(20, [1.0])], kind)).collect() == []
    assert topk_search.top_k(spark.createDataFrame([(21, [1.0]), (22, [1.0])], kind)).collect() == []
    assert collected(topk_search.top_k(spark.createDataFrame([(20, [1.0]), (21, [0.5]), (1, [0.5])], kind))) == [(20, 1, 1, 2048), (20, 2, 21, 2048)]


# ------------------------------------------------------------------ filter audit

def audit_rows():
    many = [(200 + i, prose(77, 130), "en", "src", 1) for i in range(60)]
    starts = [(300 + i, "The same long start of many documents. " * 30 + prose(i, 3 + i % 40), "de", "src", 1) for i in range(80)]
    marks = [(400 + i, t, "fr", "src", 1) for i, t in enumerate(["A B C", "$", "# %", "a|b", "AAAA bbbb " * 60, "word " * 200, "a" * 30000 + "b", "a" * 30000 + "c",
                                                                "a" * 30000, "\x1c \x85 \xa0 x", "É" * 50])]
    return [*rows(), *many, *starts, *marks, (5, prose(2, 150), "en", "src", 1), (90, None, None, "src", 1), (91, "", None, "src", 1)]


def brute_audit(docs, labels):
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    found = []
    for i, t, lang, *_ in docs:
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        fails = {f for f, no in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                                              bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t])) if no}
        found.append((lang or "", fails, i in good, i in toxic))
    out = []
    for part in {x[0] for x in found}:
        mine = [x[1:] for x in found if x[0] == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                shapley[f] += sum(f in x[0] and not x[0] & set(order[:k]) for x in mine)
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [x for x in mine if f in x[0] and not x[0] & before]
                out.append((part, "".join(order), k + 1, sum(not x[0] & {f, *before} for x in mine), len(gone),
                            sum(f in x[0] and bool(x[0] & before) for x in mine), sum(x[0] == {f} for x in mine),
                            sum(x[1] for x in gone), sum(x[2] for x in gone), shapley[f]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(1 << 18, 1 << 24, 1 << 24), (60, 200, 3000)])
def test_filter_audit(spark, sizes, monkeypatch):
    for name, value in zip(("LEAST_WEIGHT", "WEIGHT", "HELD"), sizes):
        monkeypatch.setattr(filter_audit, name, value)
    docs = audit_rows()
    marks = [(i, i % 2, i % 3 % 2) for i in range(0, 420, 2)] + [(200, 1, 0), (200, None, 1), (None, 1, 1), (202, None, None)]
    labels = odd(spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"), "doc_id", "quality", "toxic")
    got = filter_audit.filter_audit(frame(spark, docs).repartition(5), labels)
    assert collected(got) == brute_audit(docs, marks)
    if sizes[0] == 60:
        assert len(filter_audit.range_starts(frame(spark, docs).select(F.coalesce("text", F.lit("")).alias("text")))) > 20
    assert filter_audit.filter_audit(frame(spark, []), labels).count() == 0
    one = filter_audit.filter_audit(frame(spark, docs[:1]), labels.where("false"))
    assert collected(one) == brute_audit(docs[:1], [])


def test_radix_trie():
    r = random.Random(2)
    trie, want = filter_audit.RadixTrie(), {}
    for i in range(3000):
        text = bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))) + r.choice([b"", b"tail" * 50])
        trie.insert(text, -i, (i,))
        want.setdefault(text, []).append(i)
    found = {text: (node.least, [x for x, in node.rows]) for text, node in trie.terminals()}
    assert found == {t: (-max(v), v) for t, v in want.items()}
