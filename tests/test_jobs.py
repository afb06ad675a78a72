"""Batch jobs, progress as state, counters, variants."""

import json

import pytest
from pyspark.sql import functions as F

from polyglotmill.operators import counters, details
from polyglotmill.streaming import jobs, progress

T0 = 1_700_000_000


def answer(name, text="ok"):
    return json.dumps({"custom_id": name, "response": {"body": {"choices": [{"message": {"content": text}}], "usage": {"prompt_tokens": 3, "completion_tokens": 2}}}})


def answers(spark, job, rows):
    spark.createDataFrame(rows, "value string, at long").select("value", F.timestamp_seconds("at").alias("answered_at")).write.mode("append").json(f"{job.at}/answers")


def test_a_job_from_submit_to_close(spark, tmp_path):
    job = jobs.Job(spark, str(tmp_path / "job"))
    lines = spark.createDataFrame([(x, json.dumps({"custom_id": x})) for x in "abcdef"], "custom_id string, line string")
    job.submit(lines, F.timestamp_seconds(F.lit(T0)), 60, 10)
    assert job.poll() == {"requests": 6, "completed": 0, "failed": 0, "open": 6}
    answers(spark, job, [(answer("a"), T0 + 60), (answer("nobody"), T0 + 60), ("broken {", T0 + 60), (answer("c", "  "), T0 + 90), (answer("d"), T0 - 5)])
    job.fetch()
    assert job.poll() == {"requests": 6, "completed": 1, "failed": 1, "open": 4}
    job.fetch()  # nothing new
    answers(spark, job, [(answer("a", "again"), T0 + 70), (answer("b", "late but in time"), T0 + 86_400), (answer("e"), T0 + 86_401)])
    job.submit(lines.limit(0).unionByName(spark.createDataFrame([("g", "{}")], "custom_id string, line string")), F.timestamp_seconds(F.lit(T0 + 3600)))
    job.fetch()
    assert job.poll() == {"requests": 7, "completed": 2, "failed": 1, "open": 4}
    job.close()
    got = {r.custom_id: (r.status, r.text, r.tokens_in) for r in job.outcomes().collect()}
    assert got == {"a": (jobs.COMPLETE, "ok", 3), "b": (jobs.COMPLETE, "late but in time", 3), "c": (jobs.FAILED, "", 3)} | {x: (jobs.FAILED, "", 0) for x in "defg"}
    assert job.outcomes().count() == 7 and job.poll()["open"] == 0


def stream(spark, folder, rows):
    spark.createDataFrame(rows, "id long, lang string, tier int, at long").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("id long, lang string, tier int, at long").option("maxFilesPerTrigger", 1).parquet(folder).withColumn("ts", F.timestamp_seconds("at"))


def test_saves_every_n_rows_over_a_restart(spark, tmp_path):
    at, sink, seen = str(tmp_path / "in"), str(tmp_path / "sink"), 0
    for n in (7, 4, 25):
        rows = [(seen + i, "de" if i % 2 else None, 1, 0) for i in range(n)]
        seen += n
        progress.track(stream(spark, at, rows), F.col("lang"), F.col("tier"), F.lit(0), sink, str(tmp_path / "c"), 5)
        de = sum(1 for r in spark.read.parquet(at).collect() if r.lang == "de")
        got = {r.target_lang: (r.done, r.saves, r.closed) for r in progress.latest(spark, sink).collect()}
        assert got == {"de": (de, de // 5, False), None: (seen - de, (seen - de) // 5, False)}
    saves = [(r.batch, r.save) for r in spark.read.parquet(sink).where("target_lang = 'de'").orderBy("batch").collect()]
    assert saves == [(0, False), (1, True), (2, True)]  # 3, then 5, then 17 rows
    assert progress.latest(spark, str(tmp_path / "none")).count() == 0


def test_a_key_closes_when_it_has_been_idle(spark, tmp_path):
    at, sink = str(tmp_path / "in"), str(tmp_path / "sink")

    def run(rows):
        progress.track(stream(spark, at, rows), F.col("lang"), F.col("tier"), F.col("id") % 2, sink, str(tmp_path / "c"), 10, "ts", 60_000, "0 seconds")
        return {r.target_lang: (r.done, r.closed) for r in progress.latest(spark, sink).collect()}

    assert run([(0, "de", 1, T0), (1, "de", 1, T0 + 30), (2, "fr", 1, T0)]) == {"de": (2, False), "fr": (1, False)}
    assert run([(3, "fr", 1, T0 + 75), (4, "fr", 1, T0 + 70)]) == {"de": (2, False), "fr": (3, False)}  # one shard of de is closed
    assert run([(6, "es", 1, T0 + 500)]) == {"de": (2, True), "fr": (3, True), "es": (1, False)}
    assert run([(8, "de", 1, T0 + 501)]) == {"de": (3, False), "fr": (3, True), "es": (1, False)}


def test_tiers_complete_from_the_first_on(spark):
    done = spark.createDataFrame([("de", 1, 5), ("de", 2, 5), ("de", 3, 4), ("fr", 2, 5), ("ja", 1, 5), ("ja", 3, 5)], "target_lang string, tier int, done long")
    totals = spark.createDataFrame([(x, 5) for x in ("de", "fr", "ja", "zh")], "target_lang string, total long")
    assert {r.target_lang: r.tier_completed for r in progress.tier_completed(done, totals).collect()} == {"de": 2, "fr": 0, "ja": 1, "zh": 0}


def test_counters_of_the_writing_pass(spark, tmp_path):
    rows = spark.range(1000).withColumn("ms", F.col("id") % 10)
    with counters.Counted(rows, n=F.count("*"), mean=counters.mean_or_zero(F.col("ms")), none=counters.mean_or_zero(F.when(F.col("id") < 0, 1))) as run:
        run.df.write.parquet(str(tmp_path / "x"))
    assert run.values == {"n": 1000, "mean": 4.5, "none": 0.0}
    timing = run.timing("n")
    assert 0 < timing["total_seconds"] < 60 and timing["total_minutes"] == timing["total_seconds"] / 60 and timing["records_per_second"] == 1000 / timing["total_seconds"]
    assert counters.rates(5, 0.0)["records_per_second"] == 0.0
    empty = spark.range(0).select(counters.per_record(F.lit(8), F.lit(4)), counters.per_record(F.lit(8), F.lit(0)))
    assert empty.union(spark.range(1).select(counters.per_record(F.lit(8), F.lit(4)), counters.per_record(F.lit(8), F.lit(0)))).first()[:] == (2.0, None)


def test_counters_of_a_stream_by_batch(spark, tmp_path):
    at = str(tmp_path / "in")
    for n in (4, 9):
        source = stream(spark, at, [(i, "de", 1, i) for i in range(n)])
    seen = counters.StreamCounters("run")
    spark.streams.addListener(seen)
    try:
        query = source.observe("run", F.count("*").alias("n"), counters.mean_or_zero(F.col("at")).alias("mean")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        for _ in range(100):
            if seen.ended:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    assert sorted((b["rows"], b["n"], b["mean"]) for b in seen.batches) == [(4, 4, 1.5), (9, 9, 4.0)]
    assert all(b["total_seconds"] > 0 and b["records_per_second"] > 0 for b in seen.batches)


def test_details_with_keys_that_differ(spark):
    rows = spark.createDataFrame([(1, '{"a": {"b": [1, "x"]}}'), (2, '{"a": 5}'), (3, "{broken"), (4, None), (5, '{"a": null}')], "id int, t string")
    v = rows.select("id", details.parsed(F.col("t")).alias("v"))
    got = {r.id: (r.n, r.s, r.a) for r in v.select("id", details.at(F.col("v"), "$.a.b[0]", "int").alias("n"), details.at(F.col("v"), "$.a.b[1]", "string").alias("s"), details.at(F.col("v"), "$.a", "int").alias("a")).collect()}
    assert got == {1: (1, "x", None), 2: (None, None, 5), 3: (None,) * 3, 4: (None,) * 3, 5: (None,) * 3}
    schemas = {r.odd: r.details_schema for r in details.schema(v.withColumn("odd", F.col("id") == 2), "v", ["odd"]).collect()}
    assert schemas[True] == "OBJECT<a: BIGINT>"


def test_score_details_are_one_object(spark):
    rows = [(1, "comet", 0.5, {"model": 'a"b'}), (1, "gemba", -1.0, None), (2, "comet", 0.25, None), (3, "other", 1.0, None)]
    scores = spark.createDataFrame(rows, "id int, metric string, score double, details map<string,string>")
    got = {r.id: json.loads(r.j) for r in details.of_scores(scores, ["id"], ["comet", "gemba"]).select("id", F.to_json("details").alias("j")).collect()}
    assert got == {1: {"comet": {"score": "0.5", "model": 'a"b'}, "gemba": {"score": "-1.0"}}, 2: {"comet": {"score": "0.25"}}}
