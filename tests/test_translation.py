"""Settings, checkpoints, batch requests and whole translation runs."""

import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from polyglotmill import settings as s
from polyglotmill.functions import text as t
from polyglotmill.operators import batch, models, relational
from polyglotmill.plans import translation
from polyglotmill.plans.registry import ORACLES, QUERIES
from polyglotmill.sources.checkpoints import Checkpoint
from polyglotmill.streaming import incremental


def test_settings_layers(tmp_path):
    (tmp_path / "c.yaml").write_text("target_languages: [fr]\ntiers: {tier2: {backend: x}}\n")
    out = s.resolve(str(tmp_path / "c.yaml"), {"tiers.tier3.enabled": False})
    assert out["target_languages"] == ["fr"] and out["tiers"]["tier2"]["backend"] == "x" and out["tiers"]["tier3"]["enabled"] is False
    assert out["tiers"]["tier1"] == s.DEFAULTS["tiers"]["tier1"] and s.resolve() == s.DEFAULTS
    with pytest.raises(ValueError):
        s.resolve(None, {"tiers.tier1.enabled": False})
    with pytest.raises(ValueError):
        s.resolve(None, {"output.format": "xml"})


def test_fingerprint_follows_what_changes_results():
    base = s.fingerprint(s.resolve())
    assert base == s.fingerprint(s.resolve()) == s.fingerprint(s.resolve(None, {"output.directory": "/elsewhere"})) and len(base) == 16
    assert base != s.fingerprint(s.resolve(None, {"target_languages": ["de"]}))


def test_command_line():
    got, resume, force = s.from_arguments("translate --source a.csv --target-languages ar,,bn --tier2-enabled no --tier2-backend b --tier2-model m --add-language kat_Geor:ka:ka:Georgian:Geor --resume".split())
    assert got["input"]["source"] == "a.csv" and got["target_languages"] == ["ar", "bn"] and got["tiers"]["tier2"]["enabled"] is False
    assert got["tiers"]["tier2"]["model"] == {"b": "m"} and got["custom_languages"][0]["iso"] == "ka" and (resume, force) == (True, False)
    for bad in ("translate --tier2-enabled maybe", "translate --add-language x:y", ""):
        with pytest.raises(SystemExit):
            s.from_arguments(bad.split())


def test_checkpoint(spark, tmp_path):
    ck = Checkpoint(spark, str(tmp_path / "ck"), "record_id string, target_lang string, status string")
    assert ck.load().count() == 0 and ck.latest() is None
    rows = spark.createDataFrame([("1", "de", "ok"), ("2", "de", "pending"), ("1", "fr", "ok")], ck.schema)
    ck.save(rows)
    ck.save(rows.withColumn("status", F.lit("later")))
    assert sorted(map(tuple, ck.load().collect())) == sorted(map(tuple, rows.collect()))
    assert {tuple(r) for r in ck.progress(F.col("status") != "pending").collect()} == {("de", 2, 1), ("fr", 1, 1)}
    ck.sign("r1", "f1")
    ck.sign("r2", "f2")
    assert ck.latest()["run_id"] == "r2"
    ck.guard("f2")
    ck.guard("f3", force=True)
    with pytest.raises(ValueError):
        ck.guard("f3")
    ck.clear(["de"])
    assert [tuple(r) for r in ck.load().collect()] == [("1", "fr", "ok")]
    ck.clear()
    assert ck.load().count() == 0 and ck.latest() is None


def test_batch_requests_and_answers(spark):
    rows = spark.createDataFrame([("1", "de", 'say "hi"\nnow', "d"), ("1", "fr", "say", None), ("2", "de", "x", "y")], "record_id string, target_lang string, source_text string, draft string")
    lines = {r.custom_id: json.loads(r.line) for r in batch.requests(rows, "m", "sys", F.col("target_lang")).collect()}
    assert set(lines) == {"1|de", "1|fr", "2|de"} and 'say "hi"\nnow' in lines["1|de"]["body"]["messages"][1]["content"] and lines["1|de"]["body"]["max_tokens"] == 54
    said = [json.dumps({"custom_id": k, "response": {"body": {"choices": [{"message": {"content": f" {k} "}}], "usage": {"prompt_tokens": 3, "completion_tokens": 2}}}}) for k in ("1|de", "2|de", "2|de")] + ["not json", '{"custom_id": "1|fr"}']
    got = batch.matched(rows, batch.answers(spark.createDataFrame([(x,) for x in said], "value string"))).collect()
    assert {(r.record_id, r.target_lang, r.status, r.text, r.tokens_in) for r in got} == {("1", "de", "TIER2_COMPLETE", "1|de", 3), ("2", "de", "TIER2_COMPLETE", "2|de", 3), ("1", "fr", "TIER2_FAILED", "", 0)}
    assert len(got) == 3


def test_refusals_in_python_follow_the_column(spark):
    texts = [None, "", "  ", "I'm sorry, no.", "Ich kann nicht helfen", "ok", "a source of many characters", "fine answer, long enough", "AS AN AI"]
    source = "a source of many characters"
    frame = spark.createDataFrame([(i, x, lang) for i, x in enumerate(texts) for lang in ("de", "fr-CA", "xx")], "i int, x string, lang string")
    for r in frame.withColumn("refused", t.is_refusal(F.col("x"), F.col("lang"), F.lit(source))).collect():
        assert models.refuses(r.x, source, r.lang) == bool(r.refused), r


def test_run_and_resume(spark, tmp_path):
    rows = [(str(i), "Text number %d" % i + "x" * (i % 3), i % 4) for i in range(12)] + [("n", None, 1)]
    spark.createDataFrame(rows, "id string, turns string, category int").write.parquet(str(tmp_path / "in.parquet"))
    settings = s.resolve(None, {
        "input.source": str(tmp_path / "in.parquet"), "target_languages": ["de", "ja"], "tiers.tier2.backend": "offline:refuser", "tiers.tier2.fallback_order": ["offline:reverse"],
        "tiers.tier3.thresholds": {"length_ratio": 90.0}, "output.directory": str(tmp_path / "out"), "checkpoint.directory": str(tmp_path / "ck"),
    })
    got = translation.run(spark, settings)
    wide = {(r.record_id, r.target_lang): r for r in got["wide"].collect()}
    assert len(wide) == 24
    for (i, lang), r in wide.items():
        even = len(r.source_text) % 2 == 0
        want = r.source_text[::-1] if even or lang == "ja" else "ok " + r.source_text
        assert r.final_translation == want and r.tier1_translation == r.source_text.lower() and r.status == "ok" and r.meta_category is not None
        assert r.flagged == (want.startswith("ok ")) and r.qa_length_ratio == pytest.approx(100 * len(r.source_text) / len(want))
    assert {r.target_lang: r.total for r in got["report"].collect()} == {"de": 12, "ja": 12, "*": 24}
    before = got["attempts"].count()
    spark.createDataFrame(rows[:12] + [("new", "One more", 2)], "id string, turns string, category int").write.mode("overwrite").parquet(str(tmp_path / "in.parquet"))
    again = translation.run(spark, settings, resume=True)
    assert again["wide"].count() == 26 and again["attempts"].where("record_id = 'new'").count() == again["attempts"].count() - before > 0
    with pytest.raises(ValueError):
        translation.run(spark, s.merged(settings, {"target_languages": ["de"]}), resume=True)


def run_and_sql(spark, at, rows, schema="doc_id long, text string, source string"):
    """The rows of translation_run over a table of documents, and those of its SQL."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{at}/documents.parquet/*.parquet'")
    want = con.sql(ORACLES["translation_run"])
    got = QUERIES["translation_run"](spark, str(at)).select(want.columns)
    return sorted(map(str, map(tuple, got.collect()))), sorted(map(str, want.fetchall()))


def test_phrases_of_the_text_are_no_refusals(spark, tmp_path):
    texts = ["pas an ai queen.", "pas an ai queen", "I'm sorry", "Je suis, Es tut mir leid", "yrros m'I", "abba", " abba", "\u00a0abba", "abba\t", "\tabba", "", " ", "a", None]
    got, want = run_and_sql(spark, tmp_path, [(i, x, "s") for i, x in enumerate(texts)])
    assert got == want


def test_records_without_an_id_of_their_own_are_whole(spark, tmp_path):
    rows = [(1, "abc", "s"), (1, "abc", "s"), (1, "abc", "t"), (1, "abcd", "s"), (2, "xy", "s"), (None, "abc", "s"), (None, "abc", "s"), (None, "abcd", "s"), (2, None, "s")]
    got, want = run_and_sql(spark, tmp_path, rows)
    assert got == want


def test_names_of_records_hold(spark):
    one = [("1", "a", "en", {"k": "v"}), ("1", "a", "en", {"k": "v"}), ("1", "a", "en", {"k": None}), (None, "a", "en", {}), ("2", "a", "en", {})]
    schema = "record_id string, source_text string, source_lang string, metadata map<string,string>"
    ids = [sorted(r.record_id for r in translation._keyed(spark.createDataFrame(x, schema)).collect()) for x in (one, one[::-1])]
    assert ids[0] == ids[1] and len(set(ids[0])) == 5 and "2" in ids[0] and "1" not in ids[0]
    alone = spark.createDataFrame(one[3:][1:], schema)
    assert translation._keyed(alone) is alone


def test_texts_travel_once_to_their_fallback(spark):
    """Nothing is dealt by language as well: texts move before languages and attempts multiply them."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["fallback_chain"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert dealt and all(x.startswith("record_id") and "target_lang" not in x for x in dealt)


def test_joins_by_record_are_joins_by_key(spark):
    base = spark.createDataFrame([("1", "de", "b"), ("1", "fr", "b"), ("1", "fr", "twice"), ("2", "de", "b"), (None, "de", "b"), ("3", None, "b")], "record_id string, target_lang string, base_text string")
    attempts = spark.createDataFrame(
        [("1", "de", 2, True, "x", "second"), ("1", "de", 1, False, "x", "no"), ("1", "fr", 3, True, "y", None), ("2", "fr", 1, True, "x", "other"), (None, "de", 1, True, "x", "null"), ("3", None, 1, True, "x", "null")],
        "record_id string, target_lang string, seq int, accepted boolean, backend string, text string",
    )
    plain, dealt = (sorted(map(str, relational.ordered_fallback(a, b, dealt=way).collect())) for way, a, b in ((False, attempts, base), (True, attempts.repartition("record_id"), base.repartition("record_id"))))
    assert plain == dealt and len(plain) == 6 and sum("second" in x for x in plain) == 1 and not any("null" in x or "other" in x for x in plain)


def test_nothing_saved_moves_nothing(spark, tmp_path):
    ck = Checkpoint(spark, str(tmp_path / "ck"), "record_id string, target_lang string, status string")
    rows = spark.createDataFrame([("1", "de", "ok"), ("2", "de", "ok")], ck.schema)
    assert "Join" not in ck.pending(rows)._jdf.queryExecution().executedPlan().toString()
    ck.save(rows.where("record_id = '1'"))
    assert [r.record_id for r in ck.pending(rows).collect()] == ["2"]


def test_keys_that_failed_are_not_kept(spark, tmp_path):
    class Picky(models.Reverse):
        def translate(self, texts, langs, drafts):
            if "bad" in texts[0]:
                raise ValueError("no such text")
            return super().translate(texts, langs, drafts)

    rows = spark.createDataFrame([("1", "de", "good", "d"), ("2", "de", "bad", "d"), ("3", "zh", "good", "d"), (None, "de", "good", "d")], "record_id string, target_lang string, source_text string, draft string")
    saved = Checkpoint(spark, str(tmp_path / "ck"), models.ATTEMPT, ["record_id", "target_lang", "seq"])
    assert [(r.record_id, r.text) for r in translation._attempts(rows, saved, [Picky], models.never, batch_size=1).collect()] == [("1", "doog")]
    again = translation._attempts(rows, saved, [models.Reverse], models.never, batch_size=1).collect()
    assert sorted((r.record_id, r.text) for r in again) == [("1", "doog"), ("2", "dab")]


def test_prompts_are_filled_once(spark):
    row = spark.range(1).select(t.prompt(F.lit("normal"), F.lit("German {source_text}"), F.lit("say {mt_output}"), F.lit("a {source_text} {target_language}")).alias("p")).first().p
    assert row == t.PROMPTS["refine"].replace("{target_language}", "\x01").replace("{source_text}", "\x02").replace("{mt_output}", "a {source_text} {target_language}").replace("\x01", "German {source_text}").replace("\x02", "say {mt_output}")
    empty = spark.range(1).select(t.prompt(F.lit("normal"), F.lit("German"), F.lit("x"), F.lit(None).cast("string")).alias("p")).first().p
    assert empty == t.PROMPTS["direct"].replace("{target_language}", "German").replace("{source_text}", "x")


def test_error_rows_of_a_stream_come_back(spark, tmp_path):
    at, calls = str(tmp_path), []
    schema = "id long, part string"

    def work(failing):
        def run(batch):
            calls.append(sorted((r.id is None, r.id) for r in batch.select("id").collect()))
            return batch.select("id", F.when(F.col("id").isin(failing), "error: timeout").otherwise("ok").alias("status"))

        return run

    def done():
        return sorted(spark.read.parquet(f"{at}/sink").select("id").collect(), key=str)

    spark.createDataFrame([(i, "a") for i in range(6)] + [(None, "a"), (3, "again")], schema).write.parquet(f"{at}/in")
    source = spark.readStream.schema(schema).parquet(f"{at}/in")
    incremental.resume(source, work([1, 4]), f"{at}/sink", f"{at}/ck", ["id"]).awaitTermination()
    assert [r.id for r in done()] == [0, 2, 3, 5, None] and len(calls) == 1
    # Nothing new arrives: no batch runs, and `retry` asks for what waits.
    incremental.resume(source, work([]), f"{at}/sink", f"{at}/ck", ["id"]).awaitTermination()
    incremental.retry(spark, work([4]), f"{at}/sink", spark.createDataFrame([], schema), ["id"])
    assert calls[1:] == [[(False, 1), (False, 4)]] and len(done()) == 6
    # What still fails comes with the next batch; finished keys do not.
    spark.createDataFrame([(6, "b"), (0, "b"), (None, "b")], schema).write.mode("append").parquet(f"{at}/in")
    incremental.resume(source, work([]), f"{at}/sink", f"{at}/ck", ["id"]).awaitTermination()
    assert calls[2:] == [[(False, 4), (False, 6)]] and len(done()) == 8
    assert sorted(r.id for r in done() if r.id is not None) == list(range(7))


def test_who_waits_is_written_once(spark, tmp_path):
    """A row that keeps failing lies in the last two folders at most, and a batch reads one of them."""
    at, schema = str(tmp_path), "id long"

    def work(batch):
        return batch.select("id", F.when(F.col("id") == 0, "error: timeout").otherwise("ok").alias("status"))

    for n in range(5):
        spark.createDataFrame([(2 * n,), (2 * n + 1,), (1,)], schema).write.mode("append").parquet(f"{at}/in")
        incremental.resume(spark.readStream.schema(schema).parquet(f"{at}/in"), work, f"{at}/sink", f"{at}/ck", ["id"]).awaitTermination()
    folders = sorted((tmp_path / "sink-retry").iterdir())
    assert len(folders) == 2 and [spark.read.parquet(str(x)).count() for x in folders] == [1, 1]
    assert sorted(r.id for r in incremental.results(spark, f"{at}/sink").collect()) == list(range(1, 10))


def test_a_lost_checkpoint_repeats_nothing(spark, tmp_path):
    at, schema, seen = str(tmp_path), "id long", []

    def work(batch):
        seen.append(sorted(r.id for r in batch.select("id").collect()))
        return batch.select("id", F.lit("ok").alias("status"))

    spark.range(6).write.parquet(f"{at}/in")
    source = spark.readStream.schema(schema).parquet(f"{at}/in")
    for checkpoint in ("one", "two"):
        incremental.resume(source, work, f"{at}/sink", f"{at}/{checkpoint}", ["id"]).awaitTermination()
        spark.createDataFrame([(6,)], schema).write.mode("append").parquet(f"{at}/in")
    assert seen == [list(range(6)), [6]] and incremental.results(spark, f"{at}/sink").count() == 7
