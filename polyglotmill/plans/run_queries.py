"""Batch jobs, progress as state, counters of a pass, details as variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import batch, counters, details
from ..session import table
from ..sources import scratch
from ..streaming import jobs, progress
from . import fixtures as x
from .registry import query

_MAX_BYTES, _MAX_REQUESTS = 60_000, 40


def _lines(spark, sf_dir):
    """A request for each document, as one JSON line."""
    docs = table(spark, sf_dir, "documents")
    name = F.concat(F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit("|de"))
    return docs.select("doc_id", name.alias("custom_id"), F.to_json(F.struct(name.alias("custom_id"), F.substring("text", 1, 20_000).alias("text"))).alias("line"))


@query(f"""with l as (select doc_id, lpad(doc_id::varchar, 9, '0') || '|de' as custom_id, to_json({{'custom_id': lpad(doc_id::varchar, 9, '0') || '|de', 'text': substr(text, 1, 20000)}})::varchar as line from documents),
w as (select custom_id, strlen(line) + 1 as bytes, greatest(strlen(line) + 1, ceil({_MAX_BYTES} / {_MAX_REQUESTS})::bigint) as weight from l),
f as (select custom_id, bytes, ((sum(weight) over (order by custom_id) - weight) // ({_MAX_BYTES} - (select max(weight) from w) + 1))::bigint as file from w)
select file, count(*) as n, sum(bytes)::bigint as bytes, min(custom_id) as first_id, max(custom_id) as last_id from f group by file""")
def request_files(spark, sf_dir):
    """Requests in files of 60,000 bytes and 40 requests at most, read back from the files."""
    at = scratch.folder(spark)
    batch.write_files(batch.packed(_lines(spark, sf_dir).select("custom_id", "line"), _MAX_BYTES, _MAX_REQUESTS), at)
    found = spark.read.schema("value string, file long").text(at)
    name = F.get_json_object("value", "$.custom_id")
    return found.groupBy("file").agg(F.count("*").alias("n"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.min(name).alias("first_id"), F.max(name).alias("last_id"))


#: Of seven requests, one is not answered, one too late, one with a broken line, one with an empty text.
@query("""select lpad(doc_id::varchar, 9, '0') || '|de' as custom_id, case when doc_id % 7 in (0, 1, 2, 3) then 'TIER2_FAILED' else 'TIER2_COMPLETE' end as status,
case when doc_id % 7 in (0, 1, 2, 3) then '' else source end as text, case when doc_id % 7 in (0, 1, 2) then 0 else n_chars end::bigint as tokens_in from documents""")
def batch_job(spark, sf_dir):
    """A batch job over documents: submitted, answered in two lots, fetched after each, and closed."""
    job = jobs.Job(spark, scratch.folder(spark))
    docs, asked = table(spark, sf_dir, "documents"), F.timestamp_seconds(F.lit(1_700_000_000))
    job.submit(_lines(spark, sf_dir), asked, 1 << 20, 200)
    k = F.col("doc_id") % 7
    message = F.array(F.struct(F.struct(F.when(k == 3, " ").otherwise(F.col("source")).alias("content")).alias("message")))
    usage = F.struct(F.col("n_chars").alias("prompt_tokens"), F.lit(1).alias("completion_tokens"))
    name = F.concat(F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit("|de"))
    answer = F.to_json(F.struct(name.alias("custom_id"), F.struct(F.struct(message.alias("choices"), usage.alias("usage")).alias("body")).alias("response")))
    hours = F.when(k == 1, 25).otherwise(k)
    lines = docs.where(k != 0).select("doc_id", F.when(k == 2, "cut off {").otherwise(answer).alias("value"), F.timestamp_seconds(F.lit(1_700_000_000) + hours * 3600).alias("answered_at"))
    for lot in (0, 1):
        lines.where(F.col("doc_id") % 2 == lot).drop("doc_id").write.mode("append").json(f"{job.at}/answers")
        job.fetch()
    job.close()
    return job.outcomes().select("custom_id", "status", "text", "tokens_in")


@query("""with n as (select event_type as target_lang, (event_id % 3 + 1)::int as tier, event_id % 4 as shard, count(*) as n from events group by all)
select target_lang, tier, sum(n)::bigint as done, sum(n // 50)::bigint as saves from n group by target_lang, tier""")
def tier_progress(spark, sf_dir):
    """Events as records of languages and tiers, in micro-batches of one file, with a stop in the middle and a start from the checkpoint."""
    at, events = scratch.folder(spark), table(spark, sf_dir, "events").withColumn("part", F.floor(F.col("event_id") / 7) % 6)
    for half in (0, 1):
        events.where(F.col("part") % 2 == half).repartition(3, "part").write.mode("append").parquet(f"{at}/in")
        source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
        progress.track(source, F.col("event_type"), F.col("event_id") % 3 + 1, F.col("event_id") % 4, f"{at}/sink", f"{at}/checkpoint", 50)
    return progress.latest(spark, f"{at}/sink").select("target_lang", "tier", "done", "saves")


@query(f"""with {x.SQL_LOG} select count(*) as n, count(*) filter (status in ('ok', 'success')) as n_ok, count(*) filter (status = 'refused') as n_refused, sum(retries)::bigint as retries,
round(coalesce(avg(latency_ms), 0), 6) as mean_latency_ms, coalesce(avg(latency_ms) filter (status = 'absent'), 0)::double as mean_of_none, round(sum(latency_ms / 4.0::double), 6) as record_latency_ms, true as timed from log""")
def run_counters(spark, sf_dir):
    """The log written once; its counters come from that pass."""
    status, latency = F.col("status"), F.col("latency_ms")
    measures = {
        "n": F.count("*"), "n_ok": F.count_if(status.isin("ok", "success")), "n_refused": F.count_if(status == "refused"), "retries": F.sum("retries"),
        "mean_latency_ms": F.round(counters.mean_or_zero(latency), 6), "mean_of_none": counters.mean_or_zero(F.when(status == "absent", latency)),
        "record_latency_ms": F.round(F.sum(counters.per_record(latency, F.lit(4))), 6),
    }
    with counters.Counted(x.log(spark, sf_dir), **measures) as run:
        run.df.write.parquet(scratch.folder(spark))
    timed = run.timing("n")["total_seconds"] > 0
    return spark.createDataFrame([(*run.values.values(), timed)], "n long, n_ok long, n_refused long, retries long, mean_latency_ms double, mean_of_none double, record_latency_ms double, timed boolean")


_DETAILS = """'{"event":' || props || case when event_id % 3 = 0 then '' else ',"who":{"user":' || user_id || ',"tags":["' || event_type || '",' || event_id % 5 || ']}' end || case when event_id % 11 = 0 then '' else '}' end"""


@query(f"""with d as (select event_id, case when json_valid(t) then t::json end as j from (select event_id, {_DETAILS} as t from events))
select event_id, (j ->> '$.event.k')::int as k, (j ->> '$.who.user')::bigint as who, j ->> '$.who.tags[0]' as tag, try_cast(j ->> '$.who.tags[1]' as int) as number, case when j is null then null else (j -> '$.who') is not null end as has_who from d""")
def variant_details(spark, sf_dir):
    """Details with missing and nested keys and broken JSON, kept in Parquet as a variant column, and read by path."""
    at = scratch.folder(spark)
    events = table(spark, sf_dir, "events").select("event_id", details.parsed(F.expr(_DETAILS)).alias("details"))
    events.write.parquet(at)
    v = F.col("details")
    return spark.read.parquet(at).select(
        "event_id", details.at(v, "$.event.k", "int").alias("k"), details.at(v, "$.who.user", "bigint").alias("who"), details.at(v, "$.who.tags[0]", "string").alias("tag"),
        details.at(v, "$.who.tags[1]", "int").alias("number"), F.when(v.isNotNull(), details.at(v, "$.who", "variant").isNotNull()).alias("has_who"),
    )


@query(f"""with {x.SQL_SCORES} select record_id, target_lang, max(score) filter (metric = 'comet') as comet, max(score) filter (metric = 'chrf') as chrf,
max(case when metric = 'gemba' and score < 0 then 'not parsed' end) as gemba_note, count(*) as n from scores group by record_id, target_lang""")
def score_details(spark, sf_dir):
    """Scores and details of all metrics of a record in one variant, read by path."""
    scores = x.scores(spark, sf_dir)
    note = F.when((F.col("metric") == "gemba") & (F.col("score") < 0), F.create_map(F.lit("note"), F.lit("not parsed")))
    found = details.of_scores(scores.withColumn("details", note), ["record_id", "target_lang"], ["backtranslation", "chrf", "comet", "gemba"])
    v = F.col("details")
    parts = F.size(F.map_keys(details.at(v, "$", "map<string,variant>")))
    return found.select("record_id", "target_lang", details.at(v, "$.comet.score", "double").alias("comet"), details.at(v, "$.chrf.score", "double").alias("chrf"), details.at(v, "$.gemba.note", "string").alias("gemba_note"), parts.cast("long").alias("n"))
