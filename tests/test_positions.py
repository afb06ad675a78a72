"""Positions, running sums and sorted files against the plain computation; logs and templates."""

import random

import pytest
from pyspark.sql import functions as F

from polyglotmill.functions import text as t
from polyglotmill.operators import batch, logs, positions, relational
from polyglotmill.sources import readers

ROWS = [(i, None if i % 17 == 0 else i * 7 % 5, "hot" if i % 3 else f"k{i % 4}") for i in range(2000)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = list(ROWS)
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "id long, v long, k string").repartition(5)


def test_dense_positions(frame):
    got = {r.id: r.position for r in positions.dense(frame, [F.col("k"), F.desc("v"), F.col("id")], partitions=6).collect()}
    want = sorted(ROWS, key=lambda r: (r[2], r[1] is None, -(r[1] or 0), r[0]))
    assert got == {r[0]: i for i, r in enumerate(want)}


def test_running_sums_leave_out_nulls(frame):
    got = {r.id: r.before for r in positions.running(frame, F.col("v"), [F.col("id")], partitions=4).collect()}
    total, want = 0, {}
    for i, v, _ in ROWS:
        want[i] = total
        total += v or 0
    assert got == want


def test_rows_of_one_key_are_spread(spark):
    same = spark.range(4000).select("id", F.lit("x").alias("k")).repartition(4)
    dealt = positions.deal(positions.arrival(same), [F.col("k"), F.col("arrival")], 8)
    sizes = [r["count"] for r in dealt.groupBy("__range").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 1000
    assert sorted(r.position for r in positions.dense_of(dealt).collect()) == list(range(4000))


def test_identical_rows_have_positions_of_their_own(spark):
    rows = spark.createDataFrame([("a",)] * 30 + [(None,)] * 10, "k string").repartition(3)
    got = positions.dense(rows, [F.col("k")]).collect()
    assert sorted(r.position for r in got) == list(range(40)) and all(r.k is None for r in got if r.position < 10)


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, v long")
    assert positions.dense(empty, [F.col("id")]).count() == 0
    assert positions.running(empty, F.col("v"), [F.col("id")]).columns == ["id", "v", "before"]
    assert batch.packed(spark.createDataFrame([], "custom_id string, line string"), 100, 5).count() == 0


def test_ids_are_the_places_in_the_file(spark, tmp_path):
    frame = spark.range(500).select((F.lit(499) - F.col("id")).alias("n"), F.concat(F.lit("t"), "id").alias("text"))
    frame.coalesce(1).write.parquet(f"{tmp_path}/x.parquet")
    got = {r.source_text: r.record_id for r in readers.records(spark.read.parquet(f"{tmp_path}/x.parquet").where("n % 2 = 0"), "text").collect()}
    assert got == {f"t{499 - n}": str(i) for i, n in enumerate(n for n in range(499, -1, -1) if n % 2 == 0)}
    by_order = {r.source_text: r.record_id for r in readers.records(frame, "text", order=["n"]).collect()}
    assert by_order == {f"t{499 - n}": str(n) for n in range(500)}


def test_sorted_files_keep_the_order_and_ties_their_arrival(spark, tmp_path):
    rows = [(str(i), str(i % 23), ["de", "ar"][i % 2], i // 40) for i in range(400)]
    frame = spark.createDataFrame(rows, "record_id string, question_id string, target_lang string, arrival long")
    logs.write_sorted(frame, str(tmp_path), partitions=5)
    files = sorted(tmp_path.glob("part-*.parquet"))
    got = [tuple(r) for f in files for r in spark.read.parquet(str(f)).select("question_id", "target_lang", "arrival").collect()]
    assert len(files) > 1 and got == sorted((r[1], r[2], r[3]) for r in rows)
    placed = positions.read_sorted(spark.read.parquet(str(tmp_path))).orderBy("position").collect()
    assert [(r.question_id, r.target_lang, r.arrival) for r in placed] == got and [r.position for r in placed] == list(range(400))


def test_fanned_logs_are_those_that_are_sorted_whole(spark, tmp_path):
    records = spark.createDataFrame([(str(i), str(i % 23), None if i % 50 == 0 else f"text {i}", i // 40) for i in range(400)], "record_id string, question_id string, text string, arrival long").repartition(3)

    def fan(rows):
        return relational.fan_out(rows, ["de", "ar"]).where("not (target_lang = 'ar' and arrival = 3)")

    def shape(rows):
        return rows.select("record_id", "question_id", "target_lang", F.col("text").alias("source_text"), "text", "arrival")

    logs.write_fanned(records, fan, shape, f"{tmp_path}/fanned", partitions=5)
    logs.write_sorted(shape(fan(records)), f"{tmp_path}/whole", partitions=5)
    files = sorted((tmp_path / "fanned").glob("part-*.parquet"))
    key = ["question_id", "target_lang", "arrival"]
    got, want = ([tuple(r[c] for c in key) for f in sorted((tmp_path / x).glob("part-*.parquet")) for r in spark.read.parquet(str(f)).collect()] for x in ("fanned", "whole"))
    assert len(files) > 1 and got == want == sorted(got) and len(got) == 800 - 40
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/fanned").collect())) == sorted(map(str, spark.read.parquet(f"{tmp_path}/whole").collect()))


def test_places_in_files_come_without_a_shuffle_of_rows(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "x"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = positions.read_sorted(spark.read.parquet(str(tmp_path / "x")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_request_files_stay_within_both_limits(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"{i:04}", "é" * rng.choice([1, 5, 40, 90])) for i in range(500)]
    files = batch.packed(spark.createDataFrame(rows, "custom_id string, line string"), 1000, 12)
    batch.write_files(files, str(tmp_path))
    found = sorted(tmp_path.glob("file=*/*.txt"))
    assert len(found) == len({f.parent for f in found})  # one file each
    lines = {f: f.read_text().splitlines() for f in found}
    assert all(f.stat().st_size <= 1000 and len(x) <= 12 for f, x in lines.items())
    order = sorted(lines, key=lambda f: int(f.parent.name[5:]))
    assert [x for f in order for x in lines[f]] == [x for _, x in rows]
    with pytest.raises(ValueError, match="does not fit"):
        batch.packed(spark.createDataFrame([("a", "x" * 2000)], "custom_id string, line string"), 1000, 12)


MARK = "Following is my request you should respond to (in Morse code):"


def test_a_cipher_without_payload_is_a_normal_record(spark):
    rows = spark.createDataFrame([(1, "morse", f"Learn.\n\n{MARK} .- -...  "), (2, "morse", "no mark"), (3, "caesar", f"{MARK}   "), (4, "slang", f"{MARK} x"), (5, None, None)], "id int, prompt_style string, source_text string")
    got = {r.id: (r.translation_strategy, r.cipher_payload) for r in logs.with_strategy(rows).collect()}
    assert got == {1: ("cipher", ".- -..."), 2: ("normal", ""), 3: ("normal", ""), 4: ("slang", ""), 5: ("normal", "")}


def test_templates_of_the_language_only(spark):
    text = f"Learn.\nExample 0\n.-\nExample 1\n-...\n\n{MARK} -.-."
    rows = spark.createDataFrame([("a", "1", "morse", text, x) for x in ("de", "fr", None)], "record_id string, question_id string, prompt_style string, source_text string, target_lang string")
    templates = spark.createDataFrame([("morse", "de", "Lerne: [MORSE_CODE_PLACEHOLDER], [MORSE_CODE_PLACEHOLDER]; dann"), (None, None, "never")], "prompt_style string, target_lang string, template string")
    routed = logs.routed(logs.with_strategy(rows), templates)
    assert {r.target_lang: r.worked_as for r in routed.collect()} == {"de": "cipher", "fr": "normal", None: "normal"}
    (row,) = logs.assembled(routed).collect()
    assert row.tier1_translation == "Lerne: .-, -...; dann -.-." and (row.tier1_status, row.tier1_backend, row.retries) == ("success", "cipher_template", 0)
    assert logs.assembled(routed).columns == logs.COLUMNS and len(logs.COLUMNS) == 14 and row.category is None


def test_preview_calls_for_the_first_rows_only(spark):
    rows = spark.createDataFrame([(str(i), f"text {i} " * 100, "cipher" if i == 1 else "normal") for i in range(9)], "record_id string, source_text string, translation_strategy string")
    got = logs.preview(rows, ["de", "fr", "ja"], [F.col("record_id")]).collect()
    assert [(r.record_id, r.target_lang) for r in got] == [(i, x) for i in "012" for x in ("de", "fr")]
    assert all(len(r.message) == 300 for r in got if r.record_id != "1") and {r.message for r in got if r.record_id == "1"} == {"[no call: from a template]"}


def test_first_per_group(spark):
    rows = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), (None, 2, "z"), (None, None, "w")], "g string, n int, v string")
    assert {(r.g, r.v) for r in logs.first_per_group(rows, ["g"], [F.asc_nulls_last("n")], ["v"]).collect()} == {("a", "y"), (None, "z")}
