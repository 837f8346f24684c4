"""Raw JSON requests: lenient parse, mixed values, streams with a manifest."""

import os
import tempfile

from tallyspark.operators import requests as RQ
from tallyspark.streaming import scoring as ST


def _errors(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    known = spark.createDataFrame([("m",)], "model_name string")
    parsed = RQ.parse_json_requests(df, ["gp", "model_name"])
    return {r["value"]: r["errors"] for r in RQ.json_request_errors(parsed, ["gp"], ["model_name"], known, "model_name").collect()}


def test_faulty_lines_get_their_errors(spark):
    got = _errors(spark, ['{"gp": 1, "model_name": "m"}', '{"gp": "1.5", "model_name": "m", "more": 2}', '{"gp": null, "model_name": "m"}',
                          '{"gp": "x", "model_name": "zz"}', '{"gp": {"a": 1}, "model_name": "m"}', '{"gp": -1}', '{"gp": 1', '[{"gp": 1}]', "7", "", None, "{}",
                          '{"gp": "NaN", "model_name": "m"}', '{"gp": "Infinity", "model_name": "m"}'])
    assert got['{"gp": 1, "model_name": "m"}'] == [] and got['{"gp": "1.5", "model_name": "m", "more": 2}'] == []
    assert got['{"gp": null, "model_name": "m"}'] == ["gp: missing"]
    assert got['{"gp": "x", "model_name": "zz"}'] == ["gp: not a number", "model_name: unknown"]
    assert got['{"gp": {"a": 1}, "model_name": "m"}'] == ["gp: not a number"]
    assert got['{"gp": -1}'] == ["gp: negative", "model_name: missing"]
    for line in ('{"gp": 1', '[{"gp": 1}]', "7", "", None):
        assert got[line] == [RQ.MALFORMED], line
    assert got["{}"] == ["gp: missing", "model_name: missing"]
    assert got['{"gp": "NaN", "model_name": "m"}'] == got['{"gp": "Infinity", "model_name": "m"}'] == ["gp: not a number"]


def test_mixed_values_keep_their_text(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("",)], "a string")
    assert [tuple(r) for r in RQ.mixed_to_float(df, ["a"]).collect()] == [(1.0, None), (None, "x"), (None, None), (None, "")]


def test_model_registered_between_batches_is_known(spark):
    tmp = tempfile.mkdtemp(prefix="ts-requests-")
    src, names, acc, rej, log, ckpt = (os.path.join(tmp, x) for x in ("in", "names", "acc", "rej", "log", "ckpt"))
    spark.createDataFrame([("a",)], "model_name string").write.parquet(names)
    assert ST.manifest(spark, log).count() == 0

    def prepare(batch):
        parsed = RQ.parse_json_requests(batch, ["gp", "model_name"])
        return RQ.json_request_errors(parsed, ["gp"], ["model_name"], lambda: spark.read.parquet(names), "model_name")

    def run():
        ST.score_stream(spark.readStream.text(src), prepare, acc, rej, ckpt, manifest_path=log).awaitTermination()

    lines = spark.createDataFrame([('{"gp": 1, "model_name": "a"}',), ('{"gp": 1, "model_name": "b"}',), ("{",)], "value string")
    lines.write.mode("append").text(src)
    run()
    assert (ST.committed(spark, acc, log).count(), ST.committed(spark, rej, log).count()) == (1, 2)
    spark.createDataFrame([("b",)], "model_name string").write.mode("append").parquet(names)
    lines.write.mode("append").text(src)
    run()
    assert sorted((r["batch_id"], r["n_accepted"], r["n_rejected"]) for r in ST.manifest(spark, log).collect()) == [(0, 1, 2), (1, 2, 1)]
    # A batch without a line in the manifest, as one that is being written, isn't seen.
    spark.read.parquet(acc).where("batch_id = 0").drop("batch_id").write.parquet(f"{acc}/batch_id=7")
    assert ST.committed(spark, acc, log).count() == 3 and spark.read.parquet(acc).count() == 4
