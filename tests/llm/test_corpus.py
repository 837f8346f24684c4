"""Operators that compare texts, against brute force on a small table with all edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib

import pyarrow as pa
import pytest

from tallyspark.llm import components, context_mixing, decontaminate, exact_dedup, langid, line_dedup, near_dedup, suffix_dedup
from tests.llm.fixtures import CLASHES, frame, key, prose, rows


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def lowest(ids):
    return min(ids, key=key)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("filter_mb", [64, 0])
def test_exact_dedup(spark, filter_mb, monkeypatch):
    if not filter_mb:   # a full filter sends every row through the shuffle; the result is the same
        monkeypatch.setattr(exact_dedup, "bits_of", lambda k: [exact_dedup.F.lit(0)])
    groups = collections.defaultdict(list)
    for i, t, *_ in rows():
        groups[norm(t)].append(i)
    want = [(i, lowest(g), len(g), i == lowest(g), sha(t)) for t, g in groups.items() for i in g]
    assert collected(exact_dedup.exact_dedup(frame(spark))) == sorted(want, key=repr)
    kept = exact_dedup.drop_copies(frame(spark))
    assert kept.columns == frame(spark).columns
    assert sorted(map(repr, ((r.doc_id, norm(r.text)) for r in kept.collect()))) == sorted(map(repr, ((lowest(g), t) for t, g in groups.items())))


def test_exact_dedup_empty(spark):
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0 and exact_dedup.drop_copies(frame(spark, [])).count() == 0


def shingles(t, n):
    w = (t or "").encode().lower().split()
    return frozenset(zip(*[w[i:] for i in range(n)])) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()


def grouped(sets):
    """Component of each row by comparing all pairs."""
    top = list(range(len(sets)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    return [find(x) for x in range(len(sets))]


def near_rows():
    """A group of many near copies, some linked only through others, and the edge cases."""
    base, out = prose(20, 60).split(), list(rows())
    for i in range(40):
        w = list(base)
        for j in range(i % 9):
            w[(i * 7 + j * 11) % 60] = f"edit{i}x{j}"
        out.append((100 + i, " ".join(w), "en", "src", 1))
    return out


@pytest.mark.parametrize("words,block", [(2, 1000), (5, 3)])
def test_near_dedup(spark, words, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)   # several cells for a group
    data = near_rows()
    sets = [shingles(t, words) for _, t, *_ in data]
    of = grouped(sets)
    ids = collections.defaultdict(list)
    for r, c in zip(data, of):
        ids[c].append(r[0])
    want = [(r[0], len(s), r[0] if not s else lowest(ids[c]), not s or r[0] == lowest(ids[c])) for r, s, c in zip(data, sets, of)]
    assert collected(near_dedup.near_dedup(frame(spark, data), words)) == sorted(want, key=repr)
    kept = near_dedup.drop_near_copies(frame(spark, data), words)
    assert kept.columns == frame(spark).columns
    got = collections.Counter(of[[x[1] for x in data].index(r.text)] for r in kept.collect())
    assert all(got[c] == 1 for c, s in zip(of, sets) if s) and sum(got.values()) == len(set(c for c, s in zip(of, sets) if s)) + sum(not s for s in sets)


def test_near_dedup_makes_shingles_of_small_slices():
    texts = [prose(700 + k, 500) for k in range(400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": texts, "text_hash": [0] * 400})
    assert sum(map(len, texts)) > 3 << 19
    for make in (near_dedup._digests(5), near_dedup._sets(5)):
        n = sum(part.num_rows for part in make(iter([batch])))
        tracemalloc.start()
        assert sum(part.num_rows for part in make(iter([batch]))) == n == 400
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 12e6


def test_near_dedup_empty(spark):
    assert near_dedup.near_dedup(frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 160)}}


def test_decontamination(spark):
    item = prose(30, 30)
    words = item.split()
    swapped = " ".join("odd" if i % 7 == 3 else w for i, w in enumerate(words))
    more = [(50, prose(31, 50) + " " + item.upper().replace(" ", ", ") + ". " + prose(32, 50), "en", "s", 1),
            (51, swapped, "en", "s", 1), (52, prose(33, 20) + " " + " ".join(words[5:25]), "en", "s", 1),
            (53, " ".join(words[::-1]), "en", "s", 1), (54, " ".join(words[:8]) + " " + prose(34, 50), "en", "s", 1), (55, item, "en", "s", 1), (55, prose(35, 9), "en", "s", 1)]
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (4, item), (5, prose(36, 40))], "item_id bigint, text string")
    docs = frame(spark, rows() + more)
    got = collections.Counter((r.doc_id, r.n_items, r.contaminated) for r in decontaminate.decontaminate(docs, bench).collect())
    assert sum(got.values()) == len(rows()) + len(more)
    assert {i for i, _, c in got if c} == {50, 51, 52, 55} and got[55, 0, False] == 1 and got[55, 2, True] == 1
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == len(rows()) + len(more) - 4
    none = decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count()
    assert none == 0 and decontaminate.decontaminate(frame(spark, []), bench).count() == 0


def test_decontamination_of_quotes_in_parts(spark):
    words = [f"w{i}" for i in range(59)]
    other = [f"z{i}" for i in range(59)]
    quotes = {1: range(20), 2: [*range(20), *range(39, 59)], 3: [*range(14), 50, 51, 52, 54, 56], 4: range(10), 5: [*range(10), *range(45, 55)],
              6: [i for i in range(59) if i % 3], 7: [*range(5), *range(30, 43)], 8: [0, 1, 2, 4, 6, 7, 8, 10, 11, 12]}
    rnd = random.Random(5)
    quotes |= {i: [k for k in range(59) if rnd.random() < p] for i, p in enumerate([0.5, 0.6, 0.7, 0.75] * 15, 10)}

    def by_hand(same):
        spans = [(a, b) for a in range(59) for b in range(a + 13, 60)]
        return any(100 * len(same & set(range(a, b))) >= 80 * (b - a) for a, b in spans) or 100 * len(same) >= 80 * 59

    docs = frame(spark, [(i, " ".join(["lead"] * (i % 4) + [words[k] if k in set(q) else other[k] for k in range(59)]), "en", "s", 1) for i, q in quotes.items()])
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    got = {r.doc_id: r.contaminated for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {i: by_hand(set(q)) for i, q in quotes.items()} and 0 < sum(got.values()) < len(got)
    assert got[1] and got[2] and got[3] and not got[4] and not got[5] and got[7]
    assert decontaminate.drop_contaminated(docs, bench).count() == len(got) - sum(got.values())


def test_decontamination_makes_no_array_of_windows(spark):
    """A text's windows read its tokens where they stand: no row for each of them, no filter of seeds element by element."""
    df = spark.createDataFrame([(1, [7, 8, 9, 7, 8]), (2, [7, 8, 9])], "doc_id bigint, tokens array<bigint>")
    got = decontaminate.windows(df, ["doc_id"], ((0, 1, 2), (0, 2, 4)), False)
    assert sorted((r.doc_id, r.pos) for r in got.collect()) == [(1, 0), (1, 0), (1, 1), (1, 2), (2, 0)]
    assert len({r.seed for r in got.collect()}) == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "arrays_zip" not in plan and "lambda" not in plan


def test_masks_read_every_allowed_pattern():
    """Each way to substitute a fifth of 7 to 25 tokens leaves a window that a mask reads whole."""
    masks = [sum(1 << k for k in m) for m in decontaminate.MASKS]
    for n in range(7, 26):
        windows = [m << p for m, read in zip(masks, decontaminate.MASKS) for p in range(n - read[-1])]
        for gone in itertools.combinations(range(n), n * (100 - decontaminate.PERCENT) // 100):
            left = (1 << n) - 1 - sum(1 << k for k in gone)
            assert any(left & w == w for w in windows), (n, gone)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination_of_short_items(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)   # 0: every join shuffles
    item = {n: [f"i{n}x{k}" for k in range(n)] for n in (1, 2, 3, 4, 5, 6, 7, 10, 12)}
    texts, want = [], {}

    def add(n, words, found, around=True):
        i = len(texts)
        texts.append((i, " ".join((["before", "it"] + words + ["after"]) if around else words), "en", "s", 1))
        want[i] = found

    for n, words in item.items():
        add(n, words, n >= 4)                 # in a text
        add(n, words, True, around=False)     # the whole text
        for spoiled in itertools.combinations(range(n), 1 if n < 7 else n // 5):
            add(n, ["odd" if k in spoiled else w for k, w in enumerate(words)], n >= 7)
    for spoiled in itertools.combinations(range(7), 2):
        add(7, ["odd" if k in spoiled else w for k, w in enumerate(item[7])], False)
    docs = frame(spark, texts)
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in item.items()] + [(99, "?!"), (98, "")], "item_id bigint, text string")
    got = {r.doc_id: r.contaminated for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == want
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()} == {i for i, c in want.items() if not c}


def cut_by_hand(texts, size=200):
    starts = collections.Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if starts[t[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        yield len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)


@pytest.mark.parametrize("bucket,chunk,ids", [(20_000, 2 << 20, 2_000_000), (1, 1000, 2_000_000), (20_000, 2 << 20, 0)])
def test_suffix_dedup(spark, bucket, chunk, ids, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_IDS", ids)   # 0: joins shuffle
    monkeypatch.setattr(suffix_dedup, "TASK_BUCKET", bucket)   # 1: every bucket is counted by Spark
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    data = [r for r in rows() if r[0] not in (11, 12)]   # long ones below
    shared = prose(40, 60)
    data += [(60 + i, prose(41 + i, 20) + shared[i:i + 190 + 4 * i] + prose(61 + i, 20), "en", "s", 1) for i in range(8)]
    data += [(80, "é" * 150 + shared + "é" * 150, "en", "s", 1), (81, "z" * 199, "en", "s", 1), (82, "y" * 201, "en", "s", 1), (83, prose(50, 300), "en", "s", 1)]
    want = [(r[0], *x) for r, x in zip(data, cut_by_hand([(r[1] or "").encode() for r in data]))]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, data)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_bucket_refinement_reads_bytes():
    """Refined buckets against all pairs of strings; buckets whose anchors differ (equal hashes) share nothing."""
    import numpy as np
    rng = np.random.default_rng(4)
    pool = [bytes(rng.integers(97, 99, 300).astype(np.uint8)) for _ in range(4)]
    gram, before, after = [], [], []
    for i in range(60):
        whole = bytearray(pool[rng.integers(4)])
        for at in rng.integers(0, 300, rng.integers(0, 3)):
            whole[at] = 120
        whole = bytes(whole)
        gram.append(int(rng.integers(2)))
        before.append(whole[rng.integers(0, 101) if i % 3 else 0:100])
        after.append(whole[100:rng.integers(200, 301) if i % 4 else 300])
    got = suffix_dedup.repeated_around(np.array(gram), before, after)
    for k in range(101):
        own = [(g, x[len(x) - k:] + y[:200 - k]) if len(x) >= k and len(y) >= 200 - k else None for g, x, y in zip(gram, before, after)]
        seen = collections.Counter(x for x in own if x)
        assert got[:, k].tolist() == [x is not None and seen[x] > 1 for x in own]
    assert got.any() and not got.all()


def test_suffix_dedup_empty(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_line_dedup(spark):
    lines = [f"visit page {i} of the big site now please" for i in range(6)] + [f"logged in as user {n} from the main office" for n in "ann bob cid dan eve fay".split()]
    data = [(200 + i, prose(70 + i, 12) + "\n" + lines[i] + "\n\n" + lines[6 + i] + "\nend of it " + prose(90 + i, 3), "en", "s", 1) for i in range(6)]
    got = {(r.doc_id, r.text): r for r in line_dedup.line_dedup(frame(spark, rows() + data), least_texts=5).collect()}
    for i, t, *_ in data:
        a, _, blank, _, z = t.split("\n")
        assert got[i, f"{a}\n{blank}\n{z}"].n_dropped == 2 and got[i, f"{a}\n{blank}\n{z}"].n_lines == 5
    for i, t, *_ in rows():
        assert got[i, t or ""].n_dropped == 0
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def test_line_dedup_fetches_tokens_of_leaves_with_different_lines_only(spark, monkeypatch):
    """Lines of one text, and lines that are alone in their leaf, are never looked at token by token."""
    kept = {}

    def keep(df, name, stored=line_dedup.stored):
        kept[name] = stored(df, name)
        return kept[name]
    monkeypatch.setattr(line_dedup, "stored", keep)
    same = "one line that is the same\t in  all of them"
    data = [(i, f"{same}\nsent by user {'abcdef'[i]} to the main office\n{chr(97 + i)} only in this text {prose(i, 9)}", "en", "s", 0) for i in range(6)]
    got = line_dedup.line_dedup(frame(spark, data), least_texts=5).collect()
    assert {r.n_dropped for r in got} == {2} and {r.n_lines for r in got} == {3} and all(r.text[1:].startswith(" only in this text") for r in got)
    assert {" ".join(r.tokens[:3]) for r in kept["voters"].collect()} == {"sent by user"}


def test_line_dedup_several_templates_in_a_leaf(spark):
    names = [f"{a}{b}" for a in ("ann", "bob", "cid", "dan") for b in ("x", "y", "z")]
    notice = [f"the user named {n} has left the building for today" for n in names]
    other = [f"the user named {n} must never send his password around" for n in names[:6]]
    third = [f"the user named {n} could not open any door here" for n in names[:5]]
    rare = "the user named fay was here but did nothing wrong"
    passage = prose(120, 30)
    edited = " ".join("odd" if i == 9 else w for i, w in enumerate(passage.split()))
    # A list in one text has one vote, whatever its length.
    listed = "\n".join(f"the user named {n} owns some {n}thing that {n} {n}" for n in names)
    body = [prose(130 + i, 12) for i in range(12)]
    data = [(300 + i, "\n".join([body[i], notice[i], *other[i:i + 1], *third[i:i + 1]]), "en", "s", 1) for i in range(12)]
    data += [(320, rare, "en", "s", 1), (321, listed, "en", "s", 1), (331, "a\n" + passage, "en", "s", 1), (330, "b\n" + passage, "en", "s", 1),
             (329, "c\n" + edited, "en", "s", 1), (332, "a\n" + passage, "en", "s", 1)]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(frame(spark, data), least_texts=5).collect()}
    assert [got[300 + i] for i in range(12)] == body
    assert got[320] == rare and got[321] == listed
    # A long line in two texts stays in the first; copies of a text are treated alike.
    assert got[329] == "c\n" + edited and got[330] == "b\n" + passage and got[331] == got[332] == "a"
    two = {r.doc_id: r.text for r in line_dedup.line_dedup(frame(spark, data[-4:]), least_texts=2).collect()}
    assert two == {329: "c", 330: "b", 331: "a", 332: "a"}


def test_language_id(spark):
    langs = {"en": "the of and thing with", "de": "der und nicht schön über", "fr": "le été déjà où ça"}
    data = [(i, " ".join((langs[g].split() * 9)[i % 5:i % 5 + 30]) + (f" {i}" if i % 2 else " !"), g, "s", 1) for i, g in enumerate(["en", "de", "fr"] * 60)]
    got = langid.language_id(frame(spark, data + [(900 + k, t, None, "s", 1) for k, t in enumerate(["", None, "12 ** 7", "ÜBER DER SCHÖN"])])).collect()
    by = {r.doc_id: r for r in got}
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and by[i].lang_pred == g and 0.5 < by[i].score <= 1 for i, _, g, *_ in data)
    assert [(by[i].lang_pred, by[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3 and by[903].lang_pred == "de"
    kept = langid.drop_undetermined(frame(spark, data + [(900, "12 ** 7", None, "s", 1), (901, None, "en", "s", 1)]))
    assert kept.columns == frame(spark).columns and kept.count() == len(data)
    assert {(r.lang_pred, r.score) for r in langid.language_id(frame(spark, [(1, "some words", None, "s", 1)])).collect()} == {("und", 0.0)}
    # Nothing to learn from: only texts without a letter go. Many languages: a score far over a guess's stays.
    bare = [(i, t, None, "s", 1) for i, _, t in [(i, 0, prose(i, 30)) for i in range(20)]] + [(50, "12 ** 7", None, "s", 1), (51, None, None, "s", 1)]
    assert sorted(r.doc_id for r in langid.drop_undetermined(frame(spark, bare)).collect()) == list(range(20))
    many = [(i, " ".join(prose(700 + i % 40, 40).split()[(i // 40) * 3:]), f"l{i % 40}", "s", 1) for i in range(160)]
    assert langid.drop_undetermined(frame(spark, many)).count() == 160
    assert langid.language_id(frame(spark, [])).count() == 0
    assert len(langid.language_id(frame(spark)).collect()) == len(rows())


def test_lm_counts(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "BLOCK_TOKENS", 300)   # several blocks
    data = rows()
    words = [(r[0], (r[1] or "").encode().lower().split() + [None]) for r in data]
    c = collections.Counter(w for i, ws in words if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    got = collections.defaultdict(list)
    for r in context_mixing.lm_scores(frame(spark)).collect():
        got[r.doc_id, r.n_tokens, r.n_known].append(r)
    for i, ws in words:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        same = got[i, len(ws), sum(c[w] > 0 for w in ws)]
        r = same.pop(next(k for k, x in enumerate(same) if math.isclose(x.base_score, base, rel_tol=1e-9)))
        assert r.train_tokens == n
        assert r.score < 0 and math.isfinite(r.score) and r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 7 == 2)
    assert context_mixing.lm_scores(frame(spark, [])).count() == 0


def test_lm_kinds_are_centred_on_all_texts(spark, monkeypatch):
    import numpy as np
    from pyspark.sql import functions as F
    monkeypatch.setattr(context_mixing, "SAMPLE", 12)
    r = random.Random(6)
    alphabets = ["abcdef", "ghijkl", "mnopqr", "stuvwx", "012345", "éèüöäñ"]
    data = [(i, "".join(r.choice(alphabets[i % 6] + " ") for _ in range(60 + i % 50)), "en", "s", 1) for i in range(120)] + [(200, "", "en", "s", 1)]
    texts = frame(spark, data).select("doc_id", "text", (F.col("doc_id") % 7 != 2).alias("learn"))
    x = np.array([context_mixing.pairs(np.frombuffer(t.encode(), np.uint8)) for i, t, *_ in data if i % 7 != 2])
    first = context_mixing.sampled_kinds(texts, len(x))
    want = first.copy()
    for _ in range(context_mixing.ROUNDS):
        near = context_mixing.kind_of(x, want)
        want = np.array([x[near == k].mean(0) if (near == k).any() else want[k] for k in range(context_mixing.KINDS)], np.float32)
    got = context_mixing.kinds(texts, len(x))
    assert np.allclose(got, want, atol=1e-5) and not np.allclose(got, first, atol=1e-3)
    spread = [((x - c[context_mixing.kind_of(x, c)]) ** 2).sum() for c in (first, got)]
    assert spread[1] < spread[0]


def test_lm_counts_and_numbers_beyond_24_bits():
    import numpy as np
    import pyarrow as pa
    import zstandard
    ids = np.array([0, 5, 1 << 24, (1 << 24) + 5, (1 << 31) - 1], np.int32)
    raw = context_mixing.pack(ids, zstandard.ZstdCompressor())
    assert context_mixing.unpack(raw, zstandard.ZstdDecompressor()).tolist() == ids.tolist()
    part = [np.array([n, 1], np.int64).tobytes() for n in (1 << 24, 1, 1, 1, 1, 1)]
    total = context_mixing._add_parts(pa.table({"k": [0] * 6, "c": [0] * 6, "part": pa.array(part, pa.binary())}))
    assert np.frombuffer(total.column("part")[0].as_py(), np.int64).tolist() == [(1 << 24) + 5, 6]


def test_lm_contexts_reach_over_words(spark):
    """What stands before a word tells its bits: the same words in an order that was learned score higher."""
    assert context_mixing.units([b"a", b"bcdefg"]) == [b"\0" * 5 + b"a", b"\0\0\0a bcdefg", b"defg "]
    assert context_mixing.units([]) == [b"\0" * 5]
    one, two = (context_mixing.positions([b"x"], before)[1] for before in (b"abcd ", b"abce "))
    assert (one[0] == two[0]).tolist() == [True, True] and (one[1] == two[1]).tolist() == [False, True]
    words = [f"w{i}q v{i}z" for i in range(40)]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    data = [(i, " ".join(words[(i * 7 + j * 3) % 40] for j in range(30)), "en", "s", 0) for i in range(200) if i not in held]
    pairs = [w.split() for w in words]
    data += [(held[0], " ".join(a + " " + b for a, b in pairs), "en", "s", 0), (held[1], " ".join([a for a, _ in pairs] + [b for _, b in pairs[::-1]]), "en", "s", 0)]
    got = {r.doc_id: r for r in context_mixing.lm_scores(frame(spark, data)).collect()}
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score) and got[held[0]].score > got[held[1]].score


def test_lm_lists_words_once_whatever_stands_before(spark, monkeypatch):
    """What a block lists and gets back grows with its words, not with words after each context."""
    kept = {}

    def keep(df, name, stored=context_mixing.stored):
        kept[name] = stored(df, name)
        return kept[name]
    monkeypatch.setattr(context_mixing, "stored", keep)
    r = random.Random(8)
    data = [(i, " ".join(f"w{r.randrange(60)}x" for _ in range(80)), "en", "s", 0) for i in range(60)]
    assert context_mixing.lm_scores(frame(spark, data).coalesce(1)).count() == 60
    listed = [w for x in kept["tokens"].where("words IS NOT NULL").collect() for w in bytes(x.words).split(b" ")]
    assert sorted(listed) == sorted({w.encode() for d in data for w in d[1].split()} | {b""})


def test_lm_grams_give_the_words_scores(monkeypatch):
    """Tokens' logs from grams, with few slots to keep them and pieces of texts, are those of the words after their contexts."""
    import numpy as np
    rng = np.random.default_rng(1)
    tables = [rng.integers(0, 4, (1 << b, 2)).astype(np.float32) for b in context_mixing.TABLE_BITS]
    model = {"logs": context_mixing.log_tables(tables), "weights": rng.normal(size=(context_mixing.ORDERS + 1, context_mixing.ORDERS)),
             "refined": rng.uniform(0.1, 0.9, 256 * context_mixing.CELLS)}
    texts = [prose(3, 90).encode().lower().split(), [], [b"x" * 700, b"\0\0", "é".encode()], [b"a"] * 50]
    want = [context_mixing.word_log10([u[5:]], **model, before=u[:5])[0] for t in texts for u in context_mixing.units(t)]
    sizes = np.array([len(w) + 1 for t in texts for w in [*t, b""]])
    monkeypatch.setattr(context_mixing, "CHUNK", 64)
    monkeypatch.setattr(context_mixing, "CACHE_BITS", 4)
    got = context_mixing.GramCoder(model).tokens([*map(context_mixing.flat, texts)], sizes)
    p = np.log10(context_mixing.grown(got))
    far = np.array(want) < -290
    assert far.sum() == 1 and (p[~far] <= np.array(want)[~far] + 1e-4).all()
    assert np.allclose(p[~far], np.array(want)[~far], atol=0.011, rtol=1e-4) and np.allclose(p[~far][p[~far] > -9], np.array(want)[~far][p[~far] > -9], atol=5e-4)
    keys = np.concatenate([*context_mixing.grams([context_mixing.flat(t) for t in texts])])
    assert len(keys) == sizes.sum()
    c = collections.Counter(keys.tolist())
    both = context_mixing.add_up(*[np.append(a, b) for a, b in zip(context_mixing.add_up(keys[:99]), context_mixing.add_up(keys[99:]))])
    assert dict(zip(*[x.tolist() for x in both])) == c


def test_lm_scores_do_not_depend_on_the_layout(spark):
    data = [(i, prose(i, 40 + i), "en", "s", 1) for i in range(60)]
    scores = [{r.doc_id: r.score for r in context_mixing.lm_scores(frame(spark, data).repartition(n)).collect()} for n in (1, 5)]
    assert all(math.isclose(scores[0][i], scores[1][i], rel_tol=1e-9) for i in range(60))


def test_lm_is_a_distribution():
    """Bits of all 1-byte continuations add up, and a sequence's three kinds of predictors never exceed 1."""
    import numpy as np
    tables = [np.zeros((1 << b, 2), np.float32) for b in context_mixing.TABLE_BITS]
    rng = np.random.default_rng(0)
    for t in tables:
        t[:] = rng.integers(0, 5, t.shape)
    weights = rng.normal(size=(context_mixing.ORDERS + 1, context_mixing.ORDERS))
    refined = rng.uniform(0.1, 0.9, 256 * context_mixing.CELLS)
    first = context_mixing.positions([b""])   # the end alone
    assert len(first[0]) == 1
    logs = context_mixing.log_tables(tables)
    total = sum(10 ** context_mixing.word_log10([bytes([b])], logs, weights, refined)[0] for b in range(256) if b != 32)
    assert 0 < total < 1
    # One symbol: probabilities of all 256 values sum to 1.
    p = 0.0
    for b in range(256):
        out = 0.0
        for node, bit, slots in context_mixing.bits(np.array([b]), first[1]):
            x, gate = context_mixing.odds(tables, slots)
            s = context_mixing.mixed(x, gate, weights)
            q = (1 / (1 + np.exp(-s)) + refined[context_mixing._cell(node, s)]) / 2
            out += float(np.log(np.where(bit == 1, q, 1 - q))[0])
        p += math.exp(out)
    assert math.isclose(p, 1, rel_tol=1e-6)


def test_clashing_names_are_there(spark):
    assert set(CLASHES) <= set(frame(spark).columns)
