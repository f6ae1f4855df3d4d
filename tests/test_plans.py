import json

import pytest
from pyspark.sql import functions as F

from claimlake.plans import models, stages
from claimlake.streaming import ingest


def test_stage_resumes_and_refuses_changed_inputs(spark, tmp_path):
    calls = []

    def make(df):
        calls.append(1)
        return df.withColumn("x", F.lit(1))

    run = stages.Run(spark, f"file://{tmp_path}", "r", "t")
    one = spark.range(3)
    assert run.stage("normalize", [one], lambda: make(one)).count() == 3
    assert run.stage("normalize", [spark.range(3)], lambda: make(one)).count() == 3 and len(calls) == 1
    with pytest.raises(stages.ChangedInputs):
        run.stage("normalize", [spark.range(4)], lambda: make(one))
    forced = stages.Run(spark, f"file://{tmp_path}", "r", "t", force=True)
    assert forced.stage("normalize", [spark.range(4)], lambda: make(spark.range(4))).count() == 4
    run.manifest({"units": 3}, {"batch": 35})
    assert run.exists("run_manifest")


def test_per_source_makes_only_what_is_missing(spark, tmp_path):
    run = stages.Run(spark, f"file://{tmp_path}", "r", "t")
    seen = []

    def make(df):
        seen.append(sorted(r.source_id for r in df.collect()))
        return df.withColumn("y", F.lit(1))

    run.per_source("units", spark.createDataFrame([("a",), ("b",)], "source_id string"), make)
    run.per_source("units", spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string"), make)
    assert seen == [["a", "b"], ["c"]]


def test_model_calls_open_and_answered(spark):
    prompts = spark.createDataFrame([("k1", "sys", "one"), ("k2", "sys", "two"), ("k3", "sys", "one")], "key string, system string, user string")
    asked = models.requests(prompts, "m", {"type": "object"}).cache()
    assert asked.select("call_id").distinct().count() == 2
    answered = models.scripted(asked.where("key = 'k1'"), lambda s, u: json.dumps({"n": len(u)}))
    assert [r.user for r in models.frontier(asked, answered).collect()] == ["two"]
    got = {r.key: r.answer and r.answer.n for r in models.answers(models.joined(asked, answered), "n int").collect()}
    assert got == {"k1": 3, "k2": None, "k3": 3}


def test_too_large_requests_are_not_sent(spark):
    big = spark.createDataFrame([("s", "x" * 3_300_000)], "system string, user string")
    asked = models.requests(big, "m", {})
    assert asked.first().too_large and models.frontier(asked, spark.createDataFrame([], models.RESPONSE_SCHEMA)).count() == 0


def test_streaming_intake_registers_once(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    src.mkdir()
    (src / "a.md").write_text("one")
    for name in (None, "b.md"):
        if name:
            (src / name).write_text("two")
            (src / "copy").mkdir()
            (src / "copy" / "a.md").write_text("one")
        q = ingest.register(ingest.new_files(spark, str(src)), str(out), "r", str(ck)).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r.filename for r in spark.read.parquet(str(out)).collect()) == ["a.md", "b.md"]


def test_streaming_outbox_once(spark, tmp_path):
    src = tmp_path / "ev"
    rows = spark.createDataFrame([("k", "2026-01-01 00:00:00"), ("k", "2026-01-01 00:00:01"), ("j", "2026-01-01 00:00:02")], "idempotency_key string, created_at string")
    rows.write.parquet(str(src))
    stream = ingest.deliver_once(spark.readStream.schema(rows.schema).parquet(str(src)))
    q = stream.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 2


def test_jsonl_and_show(spark, tmp_path):
    df = spark.createDataFrame([(2, "é", None)], "b int, a string, c string")
    stages.write_jsonl(df, str(tmp_path / "o"))
    assert [r.value for r in spark.read.text(str(tmp_path / "o")).collect()] == ['{"a":"é","b":2,"c":null}']
    assert len(stages.show(df)) == 1
