"""Table-driven cases of text scalars, and properties of sampling."""

import pytest
from pyspark.sql import functions as F

from polyglotmill.functions import text as t
from polyglotmill.functions.unwrap import unwrap
from polyglotmill.operators import models, relational, sampling


@pytest.mark.parametrize(
    ("text", "lang", "source", "refused"),
    [
        ("I'm sorry, I cannot help.", "en", None, True), ("I can't translate this", "fr", None, True), ("As an AI language model, no", "de", None, True),
        ("Bonjour le monde", "fr", "Hello world", False), ("", "fr", None, True), ("   ", "fr", None, True), ("Hello world", "fr", "Hello world", True),
        ("Hi", "fr", "A source text of well over twenty characters", True), ("Je ne peux pas traduire", "fr", None, True), ("翻訳できません", "ja", None, True),
        ("je ne peux pas", "fr", None, False), ("it was an airport", "en", None, True),
    ],
)
def test_refusals(spark, text, lang, source, refused):
    row = spark.createDataFrame([(text, lang, source)], "r string, l string, s string").select(t.is_refusal(F.col("r"), F.col("l"), F.col("s"))).first()
    assert row[0] is refused


@pytest.mark.parametrize(("text", "rest"), [("I'm sorry, I cannot.\nVoici la traduction complète", "Voici la traduction complète"), ("I'm sorry, I cannot.", None), ("Bonjour\nle monde entier", None), ("I'm sorry\nshort", None)])
def test_salvage(spark, text, rest):
    assert spark.createDataFrame([(text,)], "r string").select(t.salvage(F.col("r"))).first()[0] == rest


@pytest.mark.parametrize(("text", "want"), [("['a b']", "a b"), ('["x", "y"]', "x"), ("[['deep'], 1]", "deep"), ("['broken", "broken"), ('say "hi"', 'say "hi'), ("[note] text", "note] text"), ('"', ""), (None, ""), ("plain", "plain")])
def test_unwrap(text, want):
    assert unwrap(text) == want


def test_splice_leaves_missing_and_ignores_surplus(spark):
    df = spark.createDataFrame([("a [X_CODE_PLACEHOLDER] b [Y_CODE_PLACEHOLDER]", ["1$"], "p\\q"), ("[X_CODE_PLACEHOLDER]", ["1", "2"], "")], "t string, e array<string>, p string")
    got = [r[0] for r in df.select(t.splice(F.col("t"), F.col("e"), F.col("p"))).collect()]
    assert got == ["a 1$ b [Y_CODE_PLACEHOLDER] p\\q", "1 "]


def test_sample_properties(spark):
    pool = spark.range(500).select(F.col("id").alias("record_id"), (F.col("id") % 7).alias("category"), (F.col("id") % 5).cast("string").alias("style"))
    a = [r.record_id for r in sampling.stratified(pool, 63, "x").collect()]
    assert len(a) == len(set(a)) == 63
    assert sorted(a) == sorted(r.record_id for r in sampling.stratified(pool.repartition(9), 63, "x").collect())
    assert sampling.stratified(pool.where("false"), 10, "x").count() == 0


def test_resume_twice_leaves_nothing(spark):
    todo = relational.fan_out(spark.range(5).select(F.col("id").cast("string").alias("record_id")), ["de", "fr"])
    assert relational.pending(todo, todo).count() == 0
    assert relational.upsert(todo, todo).count() == 10


def test_retries_and_terminal_errors():
    class Flaky:
        calls = 0

        def translate(self, texts, langs, drafts):
            self.calls += 1
            if self.calls < 3:
                raise TimeoutError("timeout")
            return texts

    waits = []
    assert models.call(Flaky(), ["a"], ["de"], [None], 3, waits.append) == (["a"], "ok", 2) and waits == [2.0, 4.0]

    class Long:
        def translate(self, *a):
            raise ValueError("rate limit exceeds quota")

    assert models.call(Long(), ["a"], ["de"], [None], 3, waits.append)[1] == "too_long"
    with pytest.raises(KeyError):
        models.backend("none")


def test_sources_and_sinks(spark, tmp_path):
    from polyglotmill.sources import readers, sinks

    df = spark.createDataFrame([("1", 'a "q"\nb', "de"), ("2", "", "fr")], "record_id string, text string, target_lang string")
    for kind in ("csv", "tsv", "jsonl", "parquet"):
        path = f"{tmp_path}/out.{kind}"
        sinks.write(df, path, kind, partition=None)
        back = readers.read(spark, path, None if kind == "parquet" else df.schema)
        assert sorted(back.collect()) == sorted(df.collect()), kind
    assert readers.read_or_empty(spark, f"{tmp_path}/none", df.schema).count() == 0
    with pytest.raises(ValueError):
        readers.require(df, ["absent"])
    with pytest.raises(FileNotFoundError):
        readers.read(spark, "some/dataset")
    sinks.save_checkpoint(df, f"{tmp_path}/ck", "f1")
    sinks.save_checkpoint(df.where("target_lang = 'de'"), f"{tmp_path}/ck", "f2")
    assert {(r.target_lang, r.fingerprint) for r in spark.read.parquet(f"{tmp_path}/ck").collect()} == {("de", "f2"), ("fr", "f1")}
    (tmp_path / "c.json").write_text('{"a": {"b": "${HOME}"}}')
    assert readers.load_config(f"{tmp_path}/c.json", {"a.c": 1})["a"]["c"] == 1


def test_entry_module_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_chrf_counts_whole_texts(spark):
    from pyspark.sql import functions as F

    from polyglotmill.functions import similarity

    assert similarity.chrf_pair("a b c", "abc") == 100.0 and similarity.chrf_pair("", "x") == 0.0 and similarity.chrf_pair("abc", "xyz") == 0.0
    # One shared letter of two each side, no shared pair: half of order 1, nothing of order 2.
    assert similarity.chrf_pair("ab", "ac") == pytest.approx(25.0)
    long = "the quick brown fox " * 200
    rows = spark.createDataFrame([(1, long + "x", long + "y"), (2, None, "x")], "i int, a string, b string")
    got = {r.i: r.s for r in rows.select("i", similarity.chrf(F.col("a"), F.col("b")).alias("s")).collect()}
    assert 99 < got[1] < 100 and got[2] == 0.0
