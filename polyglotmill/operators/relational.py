"""Relational operators over records, languages, logs and attempts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dimensions as d
from ..functions import text as t

KEY = ["record_id", "target_lang"]


def fan_out(records: DataFrame, languages: list[str]) -> DataFrame:
    """Each record once per target language: a generator over a fixed list, with no join and no shuffle."""
    return records.withColumn("target_lang", F.explode(F.array(*[F.lit(x) for x in languages])))


def pending(todo: DataFrame, done: DataFrame, key: list[str] = KEY) -> DataFrame:
    """What is not done yet. Put this before any costly operator."""
    return todo.join(done.select(*key), key, "left_anti")


def upsert(existing: DataFrame, new: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Existing rows, and the new rows whose key they do not have."""
    return existing.unionByName(new.join(existing.select(*key), key, "left_anti"))


def lookup(df: DataFrame, dimension: DataFrame, on: list[str], column: str, default: Column | None = None) -> DataFrame:
    """Left lookup in a small dimension; what is missing takes the default."""
    out = df.join(dimension.select(*on, column), on, "left")
    return out if default is None else out.withColumn(column, F.coalesce(column, default))


def language_keys(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    """(lookup_key, priority, spec): ISO code, then model code, then tag, then lower-cased name.

    Registered languages replace built-in ones of the same ISO code entirely.
    """
    base = d.languages(spark)
    if extra is not None:
        base = base.join(extra.select("iso"), "iso", "left_anti").select(*extra.columns).unionByName(extra)
    keys = F.array(*[F.struct(k.alias("lookup_key"), F.lit(i).alias("priority")) for i, k in enumerate((F.col("iso"), F.col("nllb_code"), F.col("bcp47"), F.lower("display_name")))])
    return base.select("*", F.explode(keys).alias("k")).select("k.*", *base.columns)


def find_language(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Left lookup of a language by any of its names; the first kind of name that hits wins.

    The names are made unique before the join, so rows are neither repeated nor shuffled again.
    """
    first = keys.groupBy("lookup_key").agg(F.min_by(F.struct("iso", "nllb_code", "display_name", "priority"), "priority").alias("spec"))
    code = df.join(first, F.col(column) == F.col("lookup_key"), "left").select(*df.columns, "spec")
    name = first.select(F.col("lookup_key").alias("name_key"), F.col("spec").alias("by_name")).where("by_name.priority = 3")
    out = code.join(name, F.lower(F.col(column)) == F.col("name_key"), "left")
    return out.select(*df.columns, F.coalesce("spec", "by_name").alias("spec")).select(*df.columns, "spec.iso", "spec.nllb_code", "spec.display_name")


def together(left: DataFrame, right: DataFrame, how: str = "inner", key: list[str] = KEY) -> DataFrame:
    """left.join(right, key, how) of tables that are dealt by the first column of the key: neither is shuffled again.

    A join on the whole key would deal both anew by all of it. So the other
    columns, such as the language, are compared among the rows of one record.
    """
    first, *rest = key
    named = right.withColumnsRenamed({c: f"__{c}" for c in key})
    on = F.col(first) == F.col(f"__{first}")
    for c in rest:
        on &= ~((F.col(c) < F.col(f"__{c}")) | (F.col(c) > F.col(f"__{c}")))
    return left.join(named, on, how).drop(*[f"__{c}" for c in key])


def ordered_fallback(attempts: DataFrame, base: DataFrame, key: list[str] = KEY, keep: list[str] | None = None, dealt: bool = False) -> DataFrame:
    """The first accepted attempt of each key by `seq`, else the base text. Every attempt stays in `attempts`.

    keep: further columns of base. dealt: both tables are dealt by the first
    column of the key, best before languages and attempts multiply their texts.
    """
    won = attempts.where("accepted").groupBy(*key).agg(F.min_by(F.struct("text", "backend", "seq"), "seq").alias("won"))
    out = together(base, won, "left", key) if dealt else base.join(won, key, "left")
    return out.select(*key, *(keep or []), F.coalesce("won.text", "base_text").alias("final_text"), F.coalesce("won.backend", F.lit("base")).alias("used"), F.coalesce("won.seq", F.lit(0)).alias("seq"))


def supported(df: DataFrame, capabilities: DataFrame) -> DataFrame:
    return df.join(capabilities, ["backend", "target_lang"], "left_semi")


def clean_table(records: DataFrame, log: DataFrame) -> DataFrame:
    """English originals and translations: terminal rows only, text kept where the status is ok or success."""
    said = log.where(F.col("status").isin(*d.TERMINAL_STATUSES)).withColumn("turn_text", F.when(F.col("status").isin("ok", "success"), F.coalesce("text", F.lit(""))).otherwise(""))
    said = said.select("record_id", "target_lang", "turn_text")
    joined = said.join(records.select("record_id", "question_id", "category", "prompt_style"), "record_id")
    shape = ["question_id", "category", "prompt_style", "language", "turn_text"]
    english = records.join(said.select("record_id").distinct(), "record_id", "left_semi").withColumn("language", F.lit("en")).withColumn("turn_text", F.col("source_text"))
    return english.select(*shape).unionByName(joined.withColumnRenamed("target_lang", "language").select(*shape))


def clean_order() -> list[Column]:
    return [F.col("question_id").try_cast("long"), F.col("prompt_style"), F.when(F.col("language") == "en", "0").otherwise(F.col("language"))]


def turns(text: Column) -> Column:
    return F.when(text != "", F.array(text)).otherwise(F.array().cast("array<string>"))


def flags(scores: DataFrame, thresholds: DataFrame, key: list[str] = KEY) -> DataFrame:
    """flagged and flag_reasons of each key; a score of -1 (not parsed) flags as well."""
    low = scores.join(thresholds, "metric").where("score < min_score")
    reason = F.format_string("%s=%.3f < %s", F.col("metric"), F.col("score"), F.col("min_score").cast("string"))
    return low.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_list(reason)), "; ").alias("flag_reasons"))


def route(df: DataFrame) -> DataFrame:
    """Where a logged row goes in refinement: passthrough, its style's prompt, or plain refinement."""
    return df.withColumn("route", F.when(F.col("status") == "success", "passthrough").when(F.col("status") == "needs_llm", t.strategy(F.col("prompt_style"))).otherwise("refine"))


def numbered(df: DataFrame, size: int, order: list[Column], within: list[str]) -> DataFrame:
    """batch_id: every `size` rows in order, inside each value of `within`."""
    return df.withColumn("batch_id", F.floor((F.row_number().over(Window.partitionBy(*within).orderBy(*order)) - 1) / size).cast("long"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
