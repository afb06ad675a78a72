"""Model-call operators: backends and metrics behind small contracts, run inside mapInPandas.

A backend is started once in each Python worker. Calls happen in batches of a
size that the run sets, several at a time if it says so; the operator keeps
keys with results, so nothing is joined by position. A batch that fails for
good is divided, down to the rows that are to blame: one bad text does not fail
the others. Put `relational.pending` and a `select` before it: Catalyst does
not move filters or prune columns through Python. Outputs should be written
before they are used twice, so that no call is paid for twice.
"""

from __future__ import annotations

import re
import time
import unicodedata
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from ..functions import dimensions as d
from ..functions import similarity
from ..functions import text as t
from . import rate


class Backend(Protocol):
    name: str

    def startup(self) -> None: ...
    def supports(self, lang: str) -> bool: ...
    def translate(self, texts: list[str], langs: list[str], drafts: list[str | None]) -> list[str]: ...


class Metric(Protocol):
    name: str

    def score(self, sources: list[str], translations: list[str], langs: list[str]) -> list[float]: ...


BACKENDS: dict[str, Callable[[], Backend]] = {}
METRICS: dict[str, Callable[[], Metric]] = {}


def _named(table: dict, name):
    """A registered class by name, or what makes one."""
    if callable(name):
        return name()
    if name not in table:
        raise KeyError(f"unknown name {name!r}; there are {sorted(table)}")
    return table[name]()


def backend(name, model: str | None = None) -> Backend:
    """With a model, that is the backend's `model` and the end of its name."""
    out = _named(BACKENDS, name)
    if model and model != "auto":
        out.model, out.name = model, f"{out.name}:{model}"
    return out


def metric(name) -> Metric:
    """A metric by name; `name:backend` is one that works over a registered backend."""
    kind, _, over = name.partition(":") if isinstance(name, str) else (name, "", "")
    if over and kind in METRICS:
        return METRICS[kind](over)
    return _named(METRICS, name)


def register_backend(cls):
    BACKENDS[cls.name] = cls
    return cls


def register_metric(cls):
    METRICS[cls.name] = cls
    return cls


class RateLimited(Exception):
    status_code = 429


def wait_before(attempt: int, limited: bool) -> float:
    return float(min(30 * attempt, 120) if limited else min(2**attempt, 60))


def call(model: Backend, texts: list[str], langs: list[str], drafts: list[str | None], tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> tuple[list[str | None], str, int]:
    """(results, status, retries): retries transient errors with the fixed waits, never a successful call."""
    for attempt in range(1, tries + 1):
        try:
            return list(model.translate(texts, langs, drafts)), "ok", attempt - 1
        except Exception as e:
            message, limited = str(e).lower(), getattr(e, "status_code", None) == 429
            if any(w in message for w in d.TOO_LONG_WORDS):
                return [None] * len(texts), "too_long", attempt - 1
            transient = limited or getattr(e, "status_code", None) in d.RETRYABLE_STATUSES or any(w in message for w in d.RETRYABLE_WORDS)
            if not transient or attempt == tries:
                return [None] * len(texts), f"error: {str(e)[:200]}", attempt - 1
            sleep(wait_before(attempt, limited))
    raise AssertionError


def each(model: Backend, texts: list[str], langs: list[str], drafts: list[str | None], tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> list[tuple[str | None, str, int]]:
    """(result, status, retries) of every row. A batch whose error is neither transient nor a rate limit is divided in two, until one row has it."""
    said, status, retries = call(model, texts, langs, drafts, tries, sleep)
    if status == "ok" and len(said) != len(texts):
        said, status = [None] * len(texts), f"error: {len(said)} results for {len(texts)} texts"
    if status == "ok" or len(texts) == 1 or retries == tries - 1 > 0:
        return [(x, status, retries) for x in said]
    half = len(texts) // 2
    parts = (slice(0, half), slice(half, None))
    return [row for p in parts for row in each(model, texts[p], langs[p], drafts[p], tries, sleep)]


ATTEMPT = "record_id string, target_lang string, seq int, backend string, text string, status string, retries int, accepted boolean, latency_ms double"
_COLUMNS = [c.split()[0] for c in ATTEMPT.split(", ")]


def never(text: str | None, source: str, lang: str) -> bool:
    return False


_ENGLISH = re.compile("|".join(d.ENGLISH_REFUSALS), re.I)
_NATIVE = {lang: re.compile("|".join(patterns)) for lang, patterns in d.NATIVE_REFUSALS.items()}


def refuses(text: str | None, source: str, lang: str, ratio: float = 0.1) -> bool:
    """The rule of functions.text.is_refusal for a text that is in Python already, between two calls."""
    if not (text or "").strip() or _ENGLISH.search(text) or text.strip() == source.strip():
        return True
    native = _NATIVE.get(lang.split("-")[0])
    return bool(native and native.search(text)) or len(source) > 20 and len(text) / len(source) < ratio


#: What the offline refuser says instead of an answer.
REFUSAL = "I'm sorry, I cannot translate this."
_SPACES = "".join(c for c in map(chr, range(0x3001)) if unicodedata.category(c) == "Zs")


def refuses_offline(text: str | None, source: str, lang: str) -> bool:
    """The rule for the offline stand-ins: their sentence, or the source itself without the spaces around it.

    Their answers repeat the source, so a refusing phrase in one is the source's own ("pas an ai ..." holds "as an AI").
    """
    return text is None or text == REFUSAL or text.strip(_SPACES) == source.strip(_SPACES)


def refine(rows: DataFrame, names: list, refuses: Callable[[str | None, str, str], bool], per_second: float | None = None, batch_size: int | None = None, concurrent: int = 1, models: dict[str, str] | None = None, tasks: int | None = None) -> DataFrame:
    """rows (record_id, target_lang, source_text, draft) -> every attempt; stops at a row's first accepted one.

    Short-circuiting lives in one Python operator, as a plan can't express it:
    a later backend sees only the rows that no earlier one has answered.

    batch_size: rows of a call. concurrent: calls of a task under way at once;
    the backend must allow it. models: the model by backend. per_second: calls
    of all tasks together, which then run side by side in a barrier stage of
    `tasks` (the cluster's slots). Dynamic allocation has no such stage; there
    every task gets a fixed share. The latency of a row is that of its batch
    divided by its rows.
    """
    spark = rows.sparkSession
    tasks = tasks or spark.sparkContext.defaultParallelism
    shared = per_second is not None and spark.conf.get("spark.dynamicAllocation.enabled", "false") != "true"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = rate.in_stage(per_second) if shared else rate.Pace(per_second / tasks if per_second else None)
        made = [backend(n, (models or {}).get(n) if isinstance(n, str) else None) for n in names]
        for m in made:
            m.startup()

        def one(model: Backend, part: pd.DataFrame) -> pd.DataFrame:
            began = time.perf_counter()
            drafts = [None if pd.isna(x) else x for x in part.draft]
            answers = each(model, part.source_text.tolist(), part.target_lang.tolist(), drafts)
            out = part[["record_id", "target_lang"]].copy()
            out["text"], status, out["retries"] = ([x[k] for x in answers] for k in range(3))
            refused = [x == "ok" and refuses(text, source, lang) for x, text, source, lang in zip(status, out.text, part.source_text, part.target_lang)]
            out["status"] = ["refused" if no else x for no, x in zip(refused, status)]
            out["accepted"] = out.status == "ok"
            out["latency_ms"] = (time.perf_counter() - began) * 1000 / len(part)
            return out

        def parts(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            size = batch_size or len(rows)
            for i in range(0, len(rows), size):
                pace.wait()
                yield rows.iloc[i : i + size]

        with ThreadPoolExecutor(concurrent) as pool:
            for batch in batches:
                left, out = batch, []
                for seq, model in enumerate(made, 1):
                    able = left[left.target_lang.map(model.supports).astype(bool)] if len(left) else left
                    if not len(able):
                        continue
                    waiting = [pool.submit(one, model, part) for part in parts(able)]
                    found = pd.concat([w.result() for w in waiting])
                    found["seq"], found["backend"] = seq, model.name
                    out.append(found)
                    left = left.drop(found.index[found.accepted])
                if out:
                    yield pd.concat(out)[_COLUMNS]
        pace.finish()

    asked = rows.select("record_id", "target_lang", "source_text", "draft")
    return asked.repartition(tasks).mapInPandas(run, ATTEMPT, barrier=True) if shared else asked.mapInPandas(run, ATTEMPT)


def judge(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows (record_id, target_lang, source_text, final_text) -> record_id, target_lang, metric, score."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = [metric(n) for n in names]
        for batch in batches:
            for m in models:
                scores = m.score(batch.source_text.tolist(), batch.final_text.tolist(), batch.target_lang.tolist())
                yield pd.DataFrame({"record_id": batch.record_id, "target_lang": batch.target_lang, "metric": m.name, "score": scores})

    return rows.select("record_id", "target_lang", "source_text", "final_text").mapInPandas(run, "record_id string, target_lang string, metric string, score double")


@register_metric
class Chrf:
    """chrF of the translation against the source, which stands in for a reference."""

    name = "chrf"

    def score(self, sources, translations, langs):
        return [similarity.chrf_pair(t or "", s or "") for s, t in zip(sources, translations)]


class _Over:
    """A metric over a backend, started once a worker."""

    def __init__(self, name):
        self.model = backend(name)
        self.model.startup()


@register_metric
class SafetyConsistency(_Over):
    """The share of words that the source and the translation's way back have in common, 0 if either has none; -1 if the way back fails."""

    name = "safety_consistency"

    def score(self, sources, translations, langs):
        said = each(self.model, list(translations), ["en"] * len(translations), [None] * len(translations))
        return [word_overlap(s, back) if status == "ok" else -1.0 for s, (back, status, _) in zip(sources, said)]


@register_metric
class Judge(_Over):
    """The number from 0 to 100 that the backend's `ask` answers to the judge's prompt with; -1 if it gives none."""

    name = "gemba"

    def score(self, sources, translations, langs):
        parts = t.JUDGE_PROMPT.split("{}")
        prompts = []
        for source, said, lang in zip(sources, translations, langs):
            slots = ("English", lang, "English", source, lang, said, "")
            prompts.append("".join(x for pair in zip(parts, slots) for x in pair))
        return [first_score(answer) for answer in self.model.ask(prompts)]


def word_overlap(a: str | None, b: str | None) -> float:
    x, y = set((a or "").lower().split()), set((b or "").lower().split())
    return len(x & y) / len(x | y) if x and y else 0.0


def first_score(answer: str | None) -> float:
    """functions.text.score for an answer that is in Python already."""
    found = (float(x) for x in re.findall(r"\b(\d+(?:\.\d+)?)\b", answer or "", re.ASCII))
    return next((x for x in found if 0 <= x <= 100), -1.0)


@register_backend
class Reverse:
    """Offline stand-in: the text backwards."""

    name = "offline:reverse"

    def startup(self) -> None:
        pass

    def supports(self, lang: str) -> bool:
        return lang != "zh"

    def translate(self, texts, langs, drafts):
        return [t[::-1] for t in texts]


@register_backend
class Lower:
    """Offline stand-in: the text in small letters."""

    name = "offline:lower"

    def startup(self) -> None:
        pass

    def supports(self, lang: str) -> bool:
        return True

    def translate(self, texts, langs, drafts):
        return [t.lower() for t in texts]


@register_backend
class Refuser:
    """Offline stand-in that refuses texts of an even number of characters."""

    name = "offline:refuser"

    def startup(self) -> None:
        pass

    def supports(self, lang: str) -> bool:
        return lang != "ja"

    def translate(self, texts, langs, drafts):
        return [REFUSAL if len(t) % 2 == 0 else "ok " + t for t in texts]


@register_metric
class LengthRatio:
    """Offline stand-in: 100 times the shorter length over the longer one; -1 if both are empty."""

    name = "length_ratio"

    def score(self, sources, translations, langs):
        return [100.0 * min(len(a), len(b)) / max(len(a), len(b)) if a or b else -1.0 for a, b in zip(sources, translations)]
