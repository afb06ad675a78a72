"""Named datasets: versions, subsets and splits, parts, pushed filters, failing jobs, copies."""

import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import datasource as api
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from polyglotmill.sources import datasets

ROWS = [(i, ["de", "fr", "en/x", None][i % 4], f"t{i % 7}", i / 2, i % 3 == 0 if i % 5 else None) for i in range(400)]
SCHEMA = "id long, lang string, text string, half double, third boolean"


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_splits_come_back(spark, frame, tmp_path):
    datasets.publish(frame, "a/b", str(tmp_path), "lang")
    for name, held in (("de", "de"), ("en/x", "en/x"), (datasets.NO_SPLIT, None)):
        assert ids(datasets.read(spark, "a/b", str(tmp_path), split=name)) == [r[0] for r in ROWS if r[1] == held]
    every = datasets.read(spark, "a/b", f"file://{tmp_path}", split="*")
    assert sorted(map(repr, every.collect())) == sorted(map(repr, spark.createDataFrame(ROWS, SCHEMA).collect()))
    with pytest.raises(Exception, match="no split 'xx'; there are .*'de'"):
        datasets.read(spark, "a/b", str(tmp_path), split="xx").collect()
    with pytest.raises(Exception, match="no subset"):
        datasets.read(spark, "a/b", str(tmp_path), subset="other", split="de").collect()
    with pytest.raises(Exception, match="no dataset"):
        datasets.read(spark, "a/c", str(tmp_path)).collect()


def test_filters_are_pushed_and_give_the_same_rows(spark, frame, tmp_path):
    datasets.publish(frame, "a/b", str(tmp_path), "lang")
    plain = spark.createDataFrame(ROWS, SCHEMA)
    for where in ("id > 300", "id >= 3 and id < 9", "lang = 'de'", "lang <> 'de'", "not lang in ('de', 'fr')", "lang in ('de', 'fr') and id <= 50",
                  "lang is null", "lang is not null and text = 't3'", "text like 't1%'", "third", "not third", "half > 100.5 and id < 300", "id = 5 or lang = 'fr'", "lang <=> null"):
        read = datasets.read(spark, "a/b", str(tmp_path), split="*").where(where)
        assert ids(read) == ids(plain.where(where)), where
    df = datasets.read(spark, "a/b", str(tmp_path), split="*").where("id > 300 and lang = 'de'")
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [IsNotNull(id), IsNotNull(lang), GreaterThan(id,300), EqualTo(lang,de)]" in plan and "Filter (" not in plan


def test_parts_read_each_row_group_once_and_skip_those_that_cannot_match(spark, tmp_path):
    os.makedirs(tmp_path / "plain/train")
    frame = spark.createDataFrame(ROWS, SCHEMA).toArrow()
    pq.write_table(frame, tmp_path / "plain/train/x.parquet", row_group_size=50)
    read = spark.read.format("dataset").option("mirror", str(tmp_path)).option("part_bytes", "1000")
    datasets.register(spark)
    df = read.load("plain")
    assert ids(df) == [r[0] for r in ROWS] and df.rdd.getNumPartitions() == -(-os.path.getsize(tmp_path / "plain/train/x.parquet") // 1000) > 3
    reader = datasets.Reader([str(tmp_path / "plain/train/x.parquet")], StructType.fromDDL("id long, text string"), 1 << 30)
    assert list(reader.pushFilters([api.GreaterThan(("id",), 349), api.GreaterThan(("half",), 1.0)])) == [api.GreaterThan(("half",), 1.0)]
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in batches) == 50 and batches[0].schema.names == ["id", "text"]


def test_append_overwrite_and_vacuum(spark, frame, tmp_path):
    at = str(tmp_path)
    datasets.publish(frame.where("id < 10"), "d", at, "lang")
    datasets.publish(frame.where("id >= 10"), "d", at, "lang", mode="append")
    datasets.publish(frame.where("id < 4"), "d", at, "lang", subset="small")
    assert ids(datasets.read(spark, "d", at, split="*")) == list(range(400))
    assert ids(datasets.read(spark, "d", at, subset="small", split="*")) == list(range(4))
    with pytest.raises(Exception, match="published schema"):
        datasets.publish(frame.select("id", "lang"), "d", at, "lang", mode="append")
    datasets.publish(frame.where("lang = 'fr'"), "d", at, "lang")
    assert datasets.latest(f"{at}/d")[0] == 4 and datasets.vacuum(at, "d") > 0 == datasets.vacuum(at, "d")
    assert ids(datasets.read(spark, "d", at, split="*")) == [r[0] for r in ROWS if r[1] == "fr"]
    with pytest.raises(Exception, match="no split 'de'"):
        datasets.read(spark, "d", at, split="de").collect()
    assert ids(datasets.read(spark, "d", at, subset="small", split="*")) == list(range(4))


def test_a_failing_task_leaves_nothing(spark, frame, tmp_path):
    bad = F.when(F.col("id") == 399, F.raise_error(F.lit("broken"))).otherwise(F.col("text"))
    with pytest.raises(Exception, match="broken"):
        datasets.publish(frame.withColumn("text", bad.cast("string")), "d", str(tmp_path), "lang")
    # Tasks that were still running may leave files, but no version names them.
    assert not os.path.exists(tmp_path / "d/_log")
    datasets.vacuum(str(tmp_path), "d")
    assert not [x for _, _, names in os.walk(tmp_path) for x in names]
    datasets.publish(frame.where("id < 8"), "d", str(tmp_path), "lang")
    with pytest.raises(Exception, match="broken"):
        datasets.publish(frame.withColumn("text", bad.cast("string")), "d", str(tmp_path), "lang")
    assert datasets.latest(str(tmp_path / "d"))[0] == 1 and ids(datasets.read(spark, "d", str(tmp_path), split="*")) == list(range(8))


def test_a_version_made_meanwhile_is_kept(tmp_path):
    def change(name):
        return lambda had: {"schema": "s", "subsets": had["subsets"] | {name: {}}}

    def slow(had):
        if not had["subsets"]:
            datasets._publish(str(tmp_path), change("first"))
        return change("second")(had)

    assert datasets._publish(str(tmp_path), slow) == 2
    assert set(datasets.latest(str(tmp_path))[1]["subsets"]) == {"first", "second"}


def test_the_copy_is_read_alone(spark, frame, tmp_path):
    mirror, copy = tmp_path / "mirror", str(tmp_path / "copy")
    with pytest.raises(FileNotFoundError):
        datasets.kept(spark, copy, "d", str(mirror), split="*")
    datasets.publish(frame, "d", str(mirror), "lang")
    assert ids(datasets.kept(spark, copy, "d", str(mirror), split="de")) == [r[0] for r in ROWS if r[1] == "de"]
    shutil.rmtree(mirror)
    assert ids(datasets.kept(spark, copy, "d", str(mirror), split="de")) == [r[0] for r in ROWS if r[1] == "de"]
    os.unlink(f"{copy}/_SUCCESS")  # half a copy is none
    with pytest.raises(FileNotFoundError):
        datasets.kept(spark, copy, "d", str(mirror), split="de")


def test_empty_tables(spark, tmp_path):
    datasets.publish(spark.createDataFrame([], SCHEMA), "d", str(tmp_path), "lang")
    read = datasets.read(spark, "d", str(tmp_path), split="*")
    assert read.columns == ["id", "lang", "text", "half", "third"] and read.count() == 0
