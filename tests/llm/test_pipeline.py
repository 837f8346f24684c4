"""The corpus pipeline on planted documents, and each stage on the edge cases."""

import collections
import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from tallyspark.llm.bpe import load_ranks
from tests.llm.fixtures import frame, prose, rows
from tests.llm.test_corpus import grouped, lowest, norm, shingles


def planted():
    """Documents with copies, near copies, benchmark passages and texts without letters; the rows that must stay."""
    data, stay = [], set()
    for i in range(30):
        data.append((i, prose(300 + i, 60 + i), "en" if i % 2 else "de", "s", 1))
        stay.add(i)
    data += [(100 + i, data[i][1].replace(" ", "\n "), "en", "s", 1) for i in range(5)]            # exact copies
    data += [(200 + i, data[i][1].replace(" ", " extra ", 1), "en", "s", 1) for i in range(5, 9)]   # near copies
    bench = [(k, prose(400 + k, 25)) for k in range(3)]
    data += [(300 + k, prose(500 + k, 30) + " " + t + " " + prose(600 + k, 30), "de", "s", 1) for k, t in bench]
    data += [(400, "12 34 ***", None, "s", 1), (401, None, None, "s", 1), (402, "", "en", "s", 1)]
    return data, bench, stay


def test_run_keeps_what_it_should(spark, tmp_path):
    data, bench, stay = planted()
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = {}
    for i, t, *_ in data:
        if i in stay:
            ids = enc.encode_ordinary(t)
            want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want


def test_stages_on_edge_cases(spark, tmp_path):
    spark.createDataFrame([(1, prose(1, 40))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    data = rows()
    no_letters = [r for r in data if not any(map(str.isalpha, r[1] or ""))]
    groups = collections.defaultdict(list)
    for r in data:
        groups[norm(r[1])].append(r[0])
    sets = [shingles(r[1], 5) for r in data]
    of = grouped(sets)
    left = {"language ID": len(data) - len(no_letters), "exact dedup": len(groups),
            "near dedup": len({c for c, s in zip(of, sets) if s}) + sum(not s for s in sets),
            "decontamination": len([r for r in data if prose(1, 40).split()[:20] != (r[1] or "").split()[:20]]), "BPE": len(data)}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for some, n in ((None, left[name]), ([], 0)):
            docs = frame(spark, some)
            out = stage(spark, docs, str(tmp_path))
            assert out.count() == n, name
            if k + 1 < len(names):
                assert out.columns == docs.columns, name
    assert lowest([3, None, 1]) == 1
