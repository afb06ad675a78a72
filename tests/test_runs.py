"""Messages, restored checkpoints, sources of samples, the whole report."""

import json

import pytest
from pyspark.sql import functions as F

from polyglotmill.functions import text as t
from polyglotmill.operators import report, sampling
from polyglotmill.sources import datasets
from polyglotmill.sources.checkpoints import Checkpoint


def test_messages_by_strategy(spark):
    rows = spark.createDataFrame([("slang", "d"), ("misspellings", None), ("normal", "d"), ("normal", " "), ("normal", None)], "s string, d string")
    got = [r.m for r in rows.select(t.message(F.col("s"), F.lit("German"), F.lit("Hi"), F.col("d")).alias("m")).collect()]
    assert [m.system for m in got] == [t.SYSTEM_PROMPTS[x] for x in ("slang", "misspellings", "normal", "normal", "normal")]
    assert "Machine translation to improve: d" in got[2].user and got[3].user == got[4].user and got[3].user.startswith("Translate the following")
    with pytest.raises(Exception, match="put together from a template"):
        rows.select(t.message(F.lit("cipher"), F.lit("German"), F.lit("Hi"), F.col("d"))).collect()


def test_a_checkpoint_is_restored_only_where_nothing_is_saved(spark, tmp_path):
    schema, mirror = "record_id string, target_lang string, status string", str(tmp_path / "mirror")
    rows = spark.createDataFrame([("1", "de", "ok"), ("2", "de", "refused"), ("1", "fr", "ok")], schema)
    one, two = (Checkpoint(spark, str(tmp_path / x), schema) for x in ("one", "two"))
    assert two.restore("r/c", mirror) is False and two.load().count() == 0
    one.save(rows)
    one.publish("r/c", mirror)
    assert two.restore("r/c", mirror, "de") is True and sorted(r.record_id for r in two.load().collect()) == ["1", "2"]
    assert two.restore("r/c", mirror) is False and two.load().count() == 2
    datasets.publish(rows.drop("status"), "r/short", mirror, "target_lang")
    with pytest.raises(ValueError, match="status"):
        Checkpoint(spark, str(tmp_path / "three"), schema).restore("r/short", mirror)


def test_samples_come_from_the_first_source_there_is(spark, tmp_path):
    pool = spark.range(200).select(F.col("id").alias("record_id"), (F.col("id") % 4).alias("category"), (F.col("id") % 3).cast("string").alias("style"))
    at = str(tmp_path / "sample")

    def ids(**how):
        return sorted(r.record_id for r in sampling.chosen(spark, pool, 20, "s", **how).collect())

    stratified = ids(prebuilt=at)
    assert len(stratified) == 20 == len(set(stratified)) and stratified != list(range(20))
    assert ids(prebuilt=at, first=[F.col("record_id")]) == list(range(20))
    pool.where("record_id > 190").write.parquet(at)
    assert ids(prebuilt=at, first=[F.col("record_id")]) == list(range(191, 200))


def test_the_report_of_nothing(spark):
    log = spark.createDataFrame([], "target_lang string, status string, text string, backend string, latency_ms long, tokens_in long, tokens_out long")
    numbers = report.sections(log, log, spark.createDataFrame([], "metric string, score double"), spark.createDataFrame([("a", 1.0)], "family string, usd_per_1k double"), log.select("target_lang"), 0.0)
    got = json.loads(report.document(numbers).first().report)
    assert got["summary"]["all"]["total"] == 0 and got["summary"]["all"]["completion_rate"] == 0 and got["timing"]["all"] == {"total_seconds": 0.0, "total_minutes": 0.0, "records_per_second": 0.0}
    assert set(got) <= {"summary", "timing", "cost_estimate"}
