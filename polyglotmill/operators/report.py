"""Report aggregates: one pass each, conditional counts, guarded rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t


def count_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def status_measures() -> list[Column]:
    status = F.col("status")
    done = status.isin("ok", "success") & (F.coalesce(F.col("text"), F.lit("")) != "")
    return [
        F.count("*").alias("total"), count_if(done, "completed"), count_if(status == "refused", "refused"), count_if(status == "too_long", "too_long"),
        count_if(status.startswith("error"), "failed"), F.round(rate(F.count_if(done), F.count("*")), 6).alias("completion_rate"),
    ]


def by_language(log: DataFrame) -> DataFrame:
    return log.groupBy("target_lang").agg(*status_measures())


def with_total(log: DataFrame) -> DataFrame:
    """Per language and for all (`*`), in one pass: a rollup."""
    return log.rollup("target_lang").agg(*status_measures(), F.grouping("target_lang").alias("is_total")).withColumn("target_lang", F.when(F.col("is_total") == 1, "*").otherwise(F.col("target_lang")))


def by_backend(attempts: DataFrame) -> DataFrame:
    """Every attempt counts, refused ones too."""
    refused = F.col("status") == "refused"
    return attempts.groupBy(t.family(F.col("backend")).alias("family")).agg(
        F.count("*").alias("calls"), count_if(refused, "refusals"), F.round(rate(F.count_if(refused), F.count("*")), 6).alias("refusal_rate"), count_if(F.col("status").startswith("error"), "failures"),
        F.round(F.avg("latency_ms"), 6).alias("avg_latency_ms"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"),
    )


def metric_stats(scores: DataFrame) -> DataFrame:
    """Valid scores only (0 or more); a metric without any is left out."""
    return scores.where("score >= 0").groupBy("metric").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.count("*").alias("n"))


def cost(attempts: DataFrame, rates: DataFrame) -> DataFrame:
    """US dollars by family, and in all (`*`, from unrounded parts); unknown families cost nothing."""
    used = attempts.groupBy(t.family(F.col("backend")).alias("family")).agg(F.sum(F.col("tokens_in") + F.col("tokens_out")).alias("tokens"))
    priced = used.join(rates, "family", "left").withColumn("usd", F.col("tokens") / 1000 * F.coalesce("usd_per_1k", F.lit(0.0)))
    return priced.rollup("family").agg(F.sum("tokens").alias("tokens"), F.round(F.sum("usd"), 4).alias("usd"), F.grouping("family").alias("g")).select(F.when(F.col("g") == 1, "*").otherwise(F.col("family")).alias("family"), "tokens", "usd")


def sections(log: DataFrame, attempts: DataFrame, scores: DataFrame, prices: DataFrame, flagged: DataFrame, seconds: float) -> DataFrame:
    """section, key, measure, value: every number of the report.

    log: target_lang, status, text; attempts: backend, status, latency_ms,
    tokens_in, tokens_out; scores: metric, score; flagged: a row with target_lang
    for each flagged record. Each part is one aggregation to a few rows.
    """

    def numbers(section: str, df: DataFrame, key: Column) -> DataFrame:
        names = [c for c, kind in df.dtypes if kind in ("bigint", "double", "int", "tinyint")]
        rows = df.select(key.alias("key"), *[F.col(c).cast("double").alias(c) for c in names]).unpivot("key", names, "measure", "value")
        return rows.select(F.lit(section).alias("section"), "key", "measure", "value")

    flags = flagged.groupBy("target_lang").agg(F.count("*").alias("flagged"))
    by_lang = by_language(log).join(flags, "target_lang", "left").withColumn("flagged", F.coalesce("flagged", F.lit(0)))
    # Three rows side by side: a sum over nothing is a row, too.
    languages = log.agg(F.count_distinct("target_lang").alias("languages_processed"))
    total = log.agg(*status_measures()).crossJoin(languages).crossJoin(flagged.agg(F.count("*").alias("flagged")))
    timing = total.select(
        F.lit(seconds).alias("total_seconds"), F.lit(seconds / 60).alias("total_minutes"),
        F.round(F.coalesce(F.try_divide(F.col("total"), F.lit(seconds)), F.lit(0.0)), 6).alias("records_per_second"),
    )
    parts = [
        numbers("per_language", by_lang, F.col("target_lang")),
        numbers("summary", total, F.lit("all")),
        numbers("per_backend", by_backend(attempts), F.col("family")),
        numbers("qa_metrics", metric_stats(scores), F.col("metric")),
        numbers("cost_estimate", cost(attempts, prices), F.col("family")),
        numbers("timing", timing, F.lit("all")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def document(numbers: DataFrame) -> DataFrame:
    """The numbers as one JSON document, section -> key -> measure -> value, in the column `report`."""
    by_key = numbers.groupBy("section", "key").agg(F.map_from_entries(F.collect_list(F.struct("measure", "value"))).alias("v"))
    by_section = by_key.groupBy("section").agg(F.map_from_entries(F.collect_list(F.struct("key", "v"))).alias("v"))
    return by_section.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("section", "v")))).alias("report"))
