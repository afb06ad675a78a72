"""Derived inputs, in Spark and as DuckDB CTEs: integer arithmetic that both engines agree on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dimensions as d
from ..operators import relational as r
from ..session import table

LANGS = list(enumerate(d.TARGET_LANGUAGES))
STYLES = ("base", "question", "role_play", "slang", "misspellings", "ascii", "caesar", "translate-fr", "uncommon_dialects", "brand_new")
SQL_LANGS = f"langs as {d.values_sql(LANGS, 'idx, target_lang')}"
_STYLE_SQL = "case doc_id % 10 " + " ".join(f"when {i} then '{s}'" for i, s in enumerate(STYLES)) + " end"

#: Source records from documents: ids, category 1 to 44, style, text.
SQL_SOURCE = f"""source as (
  select doc_id, doc_id::varchar || '_' || ({_STYLE_SQL}) as record_id, doc_id as question_id, doc_id % 44 + 1 as category, {_STYLE_SQL} as prompt_style, text as source_text, lang, source from documents)"""

#: A log of every record in every target language, with all kinds of status.
SQL_LOG = f"""{SQL_SOURCE}, {SQL_LANGS}, logged as (
  select *, (doc_id * 7 + idx * 3) % 20 as m from source cross join langs), log as (
  select doc_id, record_id, target_lang, prompt_style, m, case m when 0 then 'refused' when 1 then 'too_long' when 2 then 'error: timeout' when 3 then 'success' when 4 then 'success' else 'ok' end as status,
    case when m <= 2 or m = 9 then '' else source_text end as text, 100 + (doc_id * 13 + idx * 29) % 900 as latency_ms, m % 3 as retries,
    case m % 4 when 0 then 'cohere:a' when 1 then 'openai:b' when 2 then 'gemini:c' else 'nllb' end as backend, length(source_text) // 4 as tokens_in, case when m <= 2 then 0 else length(source_text) // 5 end as tokens_out from logged)"""

#: Assistant turns as responses: refusals, copies, short ones, salvageable ones and blank ones by conv_id.
SQL_RESPONSES = r"""responses as (
  select a.conv_id, a.turn, u.text as src, case when a.conv_id % 2 = 0 then 'de' else 'fr' end as target_lang,
    case a.conv_id % 7 when 0 then 'I''m sorry, I cannot assist with that.' when 1 then case when a.conv_id % 2 = 0 then 'Ich kann nicht helfen.' else 'Je ne peux pas le faire.' end
      when 2 then u.text when 3 then substr(a.text, 1, 5) when 4 then 'I am unable to help fully.' || chr(10) || a.text when 5 then '   ' else a.text end as response
  from conversations a join conversations u on a.conv_id = u.conv_id and u.turn = a.turn - 1 where a.role = 'assistant')"""


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    style = F.get(F.array(*[F.lit(s) for s in STYLES]), (F.col("doc_id") % 10).cast("int"))
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.concat_ws("_", F.col("doc_id"), style).alias("record_id"), F.col("doc_id").alias("question_id"), (F.col("doc_id") % 44 + 1).alias("category"), style.alias("prompt_style"), F.col("text").alias("source_text"), "lang", "source")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logged(source(spark, sf_dir))


def logged(records: DataFrame) -> DataFrame:
    """The log of the records; where they lie, its rows lie."""
    rows = r.fan_out(records, list(d.TARGET_LANGUAGES))
    idx = (F.array_position(F.array(*[F.lit(x) for x in d.TARGET_LANGUAGES]), F.col("target_lang")) - 1).cast("long")
    m = (F.col("doc_id") * 7 + idx * 3) % 20
    n = F.length("source_text").cast("long")
    status = F.when(m == 0, "refused").when(m == 1, "too_long").when(m == 2, "error: timeout").when(m.isin(3, 4), "success").otherwise("ok")
    backend = F.get(F.array(F.lit("cohere:a"), F.lit("openai:b"), F.lit("gemini:c"), F.lit("nllb")), (m % 4).cast("int"))
    return rows.select(
        "doc_id", "record_id", "target_lang", "prompt_style", m.alias("m"), status.alias("status"), F.when((m <= 2) | (m == 9), "").otherwise(F.col("source_text")).alias("text"),
        (100 + (F.col("doc_id") * 13 + idx * 29) % 900).alias("latency_ms"), (m % 3).alias("retries"), backend.alias("backend"), F.floor(n / 4).alias("tokens_in"), F.when(m <= 2, 0).otherwise(F.floor(n / 5)).cast("long").alias("tokens_out"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations")
    a = said.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("own"))
    u = said.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("src"))
    k, even = F.col("conv_id") % 7, F.col("conv_id") % 2 == 0
    response = (
        F.when(k == 0, "I'm sorry, I cannot assist with that.").when(k == 1, F.when(even, "Ich kann nicht helfen.").otherwise("Je ne peux pas le faire.")).when(k == 2, F.col("src")).when(k == 3, F.substring("own", 1, 5))
        .when(k == 4, F.concat(F.lit("I am unable to help fully.\n"), F.col("own"))).when(k == 5, "   ").otherwise(F.col("own"))
    )
    return a.join(u, ["conv_id", "turn"]).select("conv_id", "turn", "src", F.when(even, "de").otherwise("fr").alias("target_lang"), response.alias("response"))


#: Scores by record and language for four metrics; gemba has failures (-1).
SQL_SCORES = f"""{SQL_LOG}, scores as (
  select record_id, target_lang, metric, case metric when 'comet' then ((doc_id * 17 + m) % 100) / 100.0::double when 'chrf' then ((doc_id * 31 + m) % 80)::double when 'backtranslation' then ((doc_id * 7 + m) % 90) / 90.0::double else case when (doc_id + m) % 11 = 0 then -1.0::double else ((doc_id * 13 + m) % 101)::double end end as score
  from log cross join {d.values_sql([(x,) for x in d.THRESHOLDS], 'metric')} where status in ('ok', 'success') and text <> '')"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log(spark, sf_dir).where("status in ('ok', 'success') and text <> ''").withColumn("metric", F.explode(F.array(*[F.lit(x) for x in d.THRESHOLDS])))
    doc, m = F.col("doc_id"), F.col("m")
    score = (
        F.when(F.col("metric") == "comet", (doc * 17 + m) % 100 / 100.0).when(F.col("metric") == "chrf", ((doc * 31 + m) % 80).cast("double")).when(F.col("metric") == "backtranslation", (doc * 7 + m) % 90 / 90.0)
        .otherwise(F.when((doc + m) % 11 == 0, -1.0).otherwise(((doc * 13 + m) % 101).cast("double")))
    )
    return rows.select("doc_id", "record_id", "target_lang", "metric", score.alias("score"))


#: Prompts with examples, a mark and a payload, by doc_id; a third lacks the mark.
SQL_TEMPLATED = r"""templated as (
  select doc_id, 'Learn the code.' || chr(10) || 'Example 0' || chr(10) || substr(text, 1, 12) || chr(10) || 'Example 1' || chr(10) || substr(text, 13, 9) || chr(10) || chr(10) ||
    case when doc_id % 3 = 0 then 'No mark here: ' else 'Following is my request you should respond to (in code): ' end || replace(text, chr(10), ' ') || 'Z' as prompt,
    'T1 [ASCII_CODE_PLACEHOLDER] T2 [CAESAR_CODE_PLACEHOLDER] T3 [MORSE_CODE_PLACEHOLDER].' as template from documents)"""


def templated(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    mark = F.when(F.col("doc_id") % 3 == 0, "No mark here: ").otherwise("Following is my request you should respond to (in code): ")
    prompt = F.concat(F.lit("Learn the code.\nExample 0\n"), F.substring(t, 1, 12), F.lit("\nExample 1\n"), F.substring(t, 13, 9), F.lit("\n\n"), mark, F.replace(t, F.lit("\n"), F.lit(" ")), F.lit("Z"))
    return table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"), F.lit("T1 [ASCII_CODE_PLACEHOLDER] T2 [CAESAR_CODE_PLACEHOLDER] T3 [MORSE_CODE_PLACEHOLDER].").alias("template"))
