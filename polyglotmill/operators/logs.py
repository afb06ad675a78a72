"""The translation log: strategies and payloads of records, cipher rows put together from templates, base rows, sorted files, previews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from . import positions

#: The columns of a row of the log, in their order.
ROW = (
    "record_id string, question_id string, target_lang string, source_text string, category string, category_name string, prompt_style string, "
    "translation_strategy string, cipher_payload string, tier1_translation string, tier1_backend string, tier1_status string, tier1_latency_ms long, retries long"
)
COLUMNS = [c.split()[0] for c in ROW.split(", ")]
TEMPLATE_BACKEND = "cipher_template"


def with_strategy(records: DataFrame) -> DataFrame:
    """translation_strategy and cipher_payload by prompt_style and source_text.

    A cipher record in which no payload is found becomes a normal one with an
    empty payload; all other records have an empty payload.
    """
    found = t.strategy(F.coalesce("prompt_style", F.lit("")))
    _, payload = t.split_payload(F.coalesce("source_text", F.lit("")))
    cipher = (found == "cipher") & (payload != "")
    strategy = F.when((found == "cipher") & ~cipher, "normal").otherwise(found)
    return records.withColumns({"translation_strategy": strategy, "cipher_payload": F.when(cipher, payload).otherwise("")})


def routed(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """rows (records x languages, with_strategy) with `template` (null: none) and the strategy that they are worked by.

    templates: prompt_style, target_lang, template, one row a pair. A cipher
    record without a template in its language is translated as a normal one.
    Null styles and languages match no template.
    """
    joined = rows.join(templates.select("prompt_style", "target_lang", "template"), ["prompt_style", "target_lang"], "left")
    cipher = F.col("translation_strategy") == "cipher"
    return joined.withColumns({
        "template": F.when(cipher, F.col("template")),
        "worked_as": F.when(cipher & F.col("template").isNull(), "normal").otherwise(F.col("translation_strategy")),
    })


def assembled(rows: DataFrame) -> DataFrame:
    """Base rows of the routed rows that have a template: no call is made for them. An empty payload gives an empty translation."""
    text = t.splice(F.col("template"), t.examples(F.col("source_text")), F.col("cipher_payload"))
    made = F.when(F.coalesce("cipher_payload", F.lit("")) != "", text).otherwise("")
    return base_rows(rows.where("template is not null"), made, F.lit(TEMPLATE_BACKEND), F.lit("success"), F.lit(0), F.lit(0))


def base_rows(rows: DataFrame, translation: Column, backend: Column, status: Column, latency_ms: Column, retries: Column) -> DataFrame:
    """The columns of the log: what the record has, and what became of it. Columns that the records lack are null."""
    made = {"tier1_translation": translation, "tier1_backend": backend, "tier1_status": status, "tier1_latency_ms": latency_ms, "retries": retries}
    columns = []
    for part in ROW.split(", "):
        name, kind = part.split()
        value = made[name] if name in made else F.col(name) if name in rows.columns else F.lit(None)
        columns.append(value.cast(kind).alias(name))
    return rows.select(*columns)


def order(arrival: str | None = "arrival") -> list[Column]:
    """Ids as text, so 10 comes before 9; then the language; ties as they arrived."""
    return [F.col("question_id").cast("string"), F.col("target_lang"), *([F.col(arrival)] if arrival else [])]


def write_sorted(log: DataFrame, path: str, arrival: str = "arrival", partitions: int | None = None) -> None:
    """The log in order, over files whose names go up with it. Without a column of that name, rows arrive as they stand in their input."""
    log = log if arrival in log.columns else positions.arrival(log, arrival)
    positions.write_sorted(log, path, order(arrival), partitions)


def write_fanned(records: DataFrame, fan: Callable[[DataFrame], DataFrame], shape: Callable[[DataFrame], DataFrame], path: str, arrival: str = "arrival", partitions: int | None = None) -> None:
    """write_sorted(shape(fan(records))), with each text travelling once, before it is fanned out.

    fan: records to rows with a language, row by row; shape: those to rows of
    the log, row by row. Records are dealt by ranges of question ids, fanned
    out where they lie, sorted, and only then given all columns. There are
    `partitions` ranges, or as many as the session has shuffle partitions if
    those are more, so that the rows to sort in one task don't grow with the
    table. All rows of a question are in one file; a log in which one question
    has most of the rows is better written by `write_sorted`.
    """
    if partitions:
        partitions = max(partitions, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = positions.in_ranges(records, order(arrival)[:1], partitions)
    rows = shape(fan(dealt).sortWithinPartitions(*order(arrival)))
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def preview(rows: DataFrame, languages: list[str], order_by: list[Column], records: int = 3, shown: int = 2, limit: int = 300) -> DataFrame:
    """What a run would do, without a call: the first records in the first languages, and the head of the message.

    Only the records in front are fanned out and joined.
    """
    first = rows.orderBy(*order_by).limit(records)
    some = first.withColumn("target_lang", F.explode(F.array(*[F.lit(x) for x in languages[:shown]])))
    prompt = t.prompt(F.col("translation_strategy"), F.col("target_lang"), F.col("source_text"), F.lit(None).cast("string"))
    message = F.when(F.col("translation_strategy") == "cipher", "[no call: from a template]").otherwise(F.substring(prompt, 1, limit))
    return some.select("record_id", "target_lang", "translation_strategy", message.alias("message"))


def first_per_group(rows: DataFrame, group: list[str], order_by: list[Column], columns: list[str]) -> DataFrame:
    """The first row of each group by an explicit order; one row a group and task is shuffled."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order_by))
    return rows.withColumn("__place", place).where("__place = 1").select(*group, *columns)
