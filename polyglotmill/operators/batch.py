"""Batch requests: prompts written as JSON lines in files of bounded size, answers read and matched by id in another job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from . import positions

URL = "/v1/chat/completions"
_ANSWER = "custom_id string, response struct<body:struct<choices:array<struct<message:struct<content:string>>>,usage:struct<prompt_tokens:long,completion_tokens:long>>>"


def request_id(record_id: Column, lang: Column) -> Column:
    """Record and language: one record asks in many languages, so its id alone would match the wrong answer."""
    return F.concat_ws("|", record_id, lang)


def requests(rows: DataFrame, model: str, system: str, language: Column, temperature: float = 0.0) -> DataFrame:
    """rows (record_id, target_lang, source_text, draft) -> custom_id, line (one JSON document)."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user = t.prompt(F.lit("normal"), language, F.col("source_text"), F.col("draft"))
    body = F.struct(
        F.lit(model).alias("model"), F.array(message("system", F.lit(system)), message("user", user)).alias("messages"), F.lit(temperature).alias("temperature"), t.token_budget(F.col("source_text")).alias("max_tokens")
    )
    custom = request_id(F.col("record_id"), F.col("target_lang"))
    return rows.select(custom.alias("custom_id"), F.to_json(F.struct(custom.alias("custom_id"), F.lit("POST").alias("method"), F.lit(URL).alias("url"), body.alias("body"))).alias("line"))


def answers(lines: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON lines of answers -> custom_id, text, tokens_in, tokens_out, and the columns to keep; lines that don't parse are left out."""
    parsed = lines.select(*(keep or []), F.from_json(column, _ANSWER).alias("a")).where("a.custom_id is not null")
    said = F.get(F.col("a.response.body.choices"), F.lit(0))["message"]["content"]
    usage = F.col("a.response.body.usage")
    return parsed.select("a.custom_id", t.strip(said).alias("text"), F.coalesce(usage["prompt_tokens"], F.lit(0)).alias("tokens_in"), F.coalesce(usage["completion_tokens"], F.lit(0)).alias("tokens_out"), *(keep or []))


def matched(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Every asked row with its answer; TIER2_FAILED and an empty text where there is none."""
    first = found.groupBy("custom_id").agg(F.min_by(F.struct("text", "tokens_in", "tokens_out"), F.struct("text", "tokens_in", "tokens_out")).alias("a"))
    out = rows.withColumn("custom_id", request_id(F.col("record_id"), F.col("target_lang"))).join(first, "custom_id", "left")
    return out.select(*rows.columns, F.when(F.col("a.text").isNull(), "TIER2_FAILED").otherwise("TIER2_COMPLETE").alias("status"), F.coalesce("a.text", F.lit("")).alias("text"), F.coalesce("a.tokens_in", F.lit(0)).alias("tokens_in"), F.coalesce("a.tokens_out", F.lit(0)).alias("tokens_out"))


def packed(lines: DataFrame, max_bytes: int, max_requests: int) -> DataFrame:
    """custom_id, line -> the same with `file`, from 0: at most max_bytes (line ends counted) and max_requests in each.

    Lines in the order of their ids are laid end to end, and cut at equal
    strides that leave room for the longest line. A line weighs its share of
    either limit, whichever is more. A line of more than max_bytes is an error.
    Repeated ids go by the line; a null line is left out.
    """
    room = -(-max_bytes // max_requests)
    weight = F.greatest(F.octet_length("line") + 1, F.lit(room)).cast("long")
    dealt = positions.deal(lines.where("line is not null").withColumn("__weight", weight), [F.col("custom_id"), F.col("line")])
    longest = dealt.agg(F.coalesce(F.max("__weight"), F.lit(0))).first()[0]
    if longest > max_bytes:
        raise ValueError(f"a request of {longest} bytes does not fit a file of {max_bytes}")
    placed = positions.running_of(dealt, "__weight", "__before")
    return placed.select(*lines.columns, F.floor(F.col("__before") / F.lit(max_bytes - longest + 1)).cast("long").alias("file"))


def write_files(files: DataFrame, path: str) -> None:
    """Each file of requests as one text file under `file=n`. A file is bounded, so one task writes it whole."""
    rows = files.repartition(F.col("file")).sortWithinPartitions("file", "custom_id", "line")
    rows.select("file", F.col("line").alias("value")).write.mode("overwrite").partitionBy("file").text(path)
