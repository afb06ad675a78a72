"""Calls: failures by row, sizes of batches, calls at once, one rate for all tasks, languages of a run."""

import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from polyglotmill import settings as s
from polyglotmill.functions import similarity
from polyglotmill.operators import models, rate
from polyglotmill.plans import translation

# Workers can't import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Picky:
    """Fails for good on texts with 'bad', and finds 'long' ones too long."""

    name = "picky"

    def __init__(self):
        self.calls = []

    def startup(self):
        pass

    def supports(self, lang):
        return True

    def translate(self, texts, langs, drafts):
        self.calls.append(list(texts))
        if any("long" in x for x in texts):
            raise ValueError("the prompt is too long")
        if any("bad" in x for x in texts):
            raise RuntimeError("invalid input")
        return [x.upper() for x in texts]


def test_one_bad_text_does_not_fail_the_others():
    model, texts = Picky(), ["a", "b", "bad", "c", "long", "d", "e"]
    got = models.each(model, texts, ["de"] * 7, [None] * 7, 3, lambda _: None)
    assert [x for x, _, _ in got] == ["A", "B", None, "C", None, "D", "E"]
    assert [x.split(":")[0] for _, x, _ in got] == ["ok", "ok", "error", "ok", "too_long", "ok", "ok"]
    model.calls.clear()
    assert [x for x, _, _ in models.each(model, ["a", "b"], ["de"] * 2, [None] * 2)] == ["A", "B"] and len(model.calls) == 1


def test_what_passes_by_itself_is_not_divided():
    class Down:
        calls = 0

        def translate(self, *a):
            self.calls += 1
            raise ConnectionError("connection reset")

    down, waits = Down(), []
    got = models.each(down, ["a", "b", "c"], ["de"] * 3, [None] * 3, 3, waits.append)
    assert down.calls == 3 and waits == [2.0, 4.0] and {x for _, x, _ in got} == {"error: connection reset"}

    class Short:
        def translate(self, texts, langs, drafts):
            return texts[1:]

    assert {x for _, x, _ in models.each(Short(), ["a", "b"], ["de"] * 2, [None] * 2)} == {"error: 0 results for 1 texts"}


class Clock:
    """Writes down when it was called, and how large the call was."""

    name = "clock"

    def startup(self):
        self.lock, self.under_way, self.most = threading.Lock(), 0, 0

    def supports(self, lang):
        return True

    def translate(self, texts, langs, drafts):
        with self.lock:
            self.under_way += 1
            self.most = max(self.most, self.under_way)
        at = time.time()
        time.sleep(0.02)
        with self.lock:
            self.under_way -= 1
        return [f"{at} {len(texts)} {self.most} {getattr(self, 'model', '')}"] * len(texts)


def asked(spark, n, partitions=1):
    return spark.range(n, numPartitions=partitions).select(F.col("id").cast("string").alias("record_id"), F.lit("de").alias("target_lang"), F.lit("text").alias("source_text"), F.lit(None).cast("string").alias("draft"))


def test_size_of_calls_and_calls_at_once(spark):
    rows = models.refine(asked(spark, 50), [Clock], models.never, batch_size=8, concurrent=4).collect()
    assert len(rows) == 50 and sorted({int(r.text.split()[1]) for r in rows}) == [2, 8] and 1 < max(int(r.text.split()[2]) for r in rows) <= 4
    assert all(r.backend == "clock" and 0 < r.latency_ms < 1000 for r in rows)
    with pytest.raises(KeyError):
        models.backend("nobody")
    assert models.backend("offline:lower", "m7").name == "offline:lower:m7" and models.backend("offline:lower", "auto").name == "offline:lower"


def test_tasks_share_one_rate(spark):
    """Four tasks, one of them with most of the calls: never faster than the rate, and the last one takes over the shares of the others."""
    per_second, uneven = 20, [90, 4, 4, 4]
    slots = spark.sparkContext.defaultParallelism
    if slots < 4:
        pytest.skip("a barrier stage of four tasks needs four slots")
    rows = spark.createDataFrame([(t, k) for t, n in enumerate(uneven) for k in range(n)], "task int, k int").repartitionByRange(4, "task")

    def run(batches):
        pace, at = rate.in_stage(per_second, 0.1), []
        for batch in batches:
            for t in batch["task"]:
                pace.wait()
                at.append((int(t), time.time()))
        pace.finish()
        yield __import__("pandas").DataFrame(at, columns=["task", "at"])

    times = sorted((r["at"], r["task"]) for r in rows.mapInPandas(run, "task int, at double", barrier=True).collect())
    assert len(times) == sum(uneven)
    whole = times[-1][0] - times[0][0]
    assert (sum(uneven) - 8) / per_second <= whole <= 90 * 4 / per_second * 0.75  # a fixed quarter each would take 90 * 4 / 20 s
    for i, (at, _) in enumerate(times):
        assert sum(1 for other, _ in times[i:] if other < at + 1) <= per_second + 8  # each share may start a call at once in a new period


def test_shares_follow_what_others_have_left():
    now, said = [0.0], iter([["busy"] * 4, ["busy", "done", "done", "done"], ["done"] * 4])
    pace = rate.SharedPace(10, 8, lambda _: next(said), lambda: now[0], lambda x: now.__setitem__(0, now[0] + x))
    at = []

    def calls(n):
        for _ in range(n):
            pace.wait()
            at.append(round(now[0], 3))

    calls(2)  # an eighth
    assert pace.agree()
    calls(2)  # a quarter
    assert pace.agree()
    calls(3)  # all of it
    assert not pace.agree()
    assert at == [0.0, 0.8, 1.2, 1.6, 1.7, 1.8, 1.9]


def test_languages_of_a_run():
    base = s.resolve(None, {"target_languages": ["de", "German", "fra_Latn", "xx", "Neu"]})
    with pytest.raises(ValueError, match=r"\['xx', 'Neu'\]"):
        translation.languages(base)
    own = {"iso": "xx", "nllb_code": "xxx_Latn", "bcp47": "xx-Latn", "display_name": "Neu", "script": "Latn"}
    assert translation.languages(base | {"custom_languages": [own]}) == ["de", "fr", "xx"]


def test_token_match(spark):
    a, b = [[1.0, 0.0], [0.0, 2.0]], [[3.0, 0.0]]
    assert similarity.matched(a, b) == (0.5, 1.0, pytest.approx(2 / 3)) and similarity.matched(b, a) == (1.0, 0.5, pytest.approx(2 / 3))
    assert similarity.matched(a, []) == similarity.matched(None, a) == (0.0, 0.0, 0.0) and similarity.matched([[0.0, 0.0]], b) == (0.0, 0.0, 0.0)
    rows = spark.createDataFrame([(a, b), (None, b), ([], b)], "a array<array<double>>, b array<array<double>>")
    assert [r[0].f1 for r in rows.select(similarity.token_match(F.col("a"), F.col("b"))).collect()] == [pytest.approx(2 / 3), 0.0, 0.0]


def test_profiles(spark):
    from polyglotmill.functions import profiles

    assert profiles.grams("Ab, ab!") == {"a": 2, "b": 2, "_a": 2, "ab": 2, "b_": 2, "_ab": 2, "ab_": 2}
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "the the", None), (4, None, "en"), (5, "123", "de"), (5, "und der", None), (6, "ζζζ", None)]
    docs = spark.createDataFrame(rows, "id int, text string, lang string")
    got = {(r.id, r.text): r.found for r in profiles.predict(docs, "text", profiles.learn(docs, "text", "lang")).collect()}
    assert got == {(1, rows[0][1]): "en", (2, rows[1][1]): "de", (3, "the the"): "en", (4, None): None, (5, "123"): None, (5, "und der"): "de", (6, "ζζζ"): None}
    assert profiles.predict(docs.where("false"), "text", profiles.learn(docs.where("false"), "text", "lang")).count() == 0


class Echo:
    """Answers prompts with a number from them, and translates back to the source's words."""

    name = "echo"

    def startup(self):
        pass

    def supports(self, lang):
        return True

    def translate(self, texts, langs, drafts):
        if any("bad" in x for x in texts):
            raise RuntimeError("invalid")
        return [x.lower() for x in texts]

    def ask(self, prompts):
        return [f"I give {len(p) + 1000} or 73.5 points" if "good" in p else "no idea" for p in prompts]


def test_metrics_over_backends(spark):
    rows = spark.createDataFrame([("1", "de", "the good cat", "THE GOOD DOG"), ("2", "de", "x", "bad"), ("3", "fr", "", "y")], "record_id string, target_lang string, source_text string, final_text string")
    models.METRICS["echo_judge"] = lambda: models.Judge(Echo)
    try:
        assert models.metric("echo_judge").score(["good"], ["x"], ["de"]) == [73.5]
    finally:
        del models.METRICS["echo_judge"]
    made = [lambda: models.SafetyConsistency(Echo), lambda: models.Judge(Echo), "chrf", "safety_consistency:offline:lower"]
    got = {}
    for r in models.judge(rows, made).collect():
        got.setdefault((r.record_id, r.metric), []).append(r.score)
    assert got["1", "safety_consistency"] == [0.5, 0.5] and got["2", "safety_consistency"] == [-1.0, 0.0] and got["3", "safety_consistency"] == [0.0, 0.0]
    assert [got[i, "gemba"] for i in "123"] == [[73.5], [-1.0], [-1.0]]
    assert got["1", "chrf"] == [similarity.chrf_pair("THE GOOD DOG", "the good cat")] and got["3", "chrf"] == [0.0]
    with pytest.raises(KeyError):
        models.metric("nothing:offline:lower")
    assert models.first_score("250 then 42") == 42 and models.first_score("-5") == 5 and models.first_score(None) == -1
