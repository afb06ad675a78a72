"""Reports, sampling, windows and top-k."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dimensions as d
from ..functions import text as t
from ..operators import relational as r
from ..operators import report
from ..operators import sampling
from ..session import table
from ..sources import sinks
from . import fixtures as x
from .registry import query

_MEASURES = "count(*) as total, count(*) filter (status in ('ok', 'success') and text <> '') as completed, count(*) filter (status = 'refused') as refused, count(*) filter (status = 'too_long') as too_long, count(*) filter (status like 'error%') as failed, round(count(*) filter (status in ('ok', 'success') and text <> '')::double / count(*), 6) as completion_rate"


@query(f"with {x.SQL_LOG} select target_lang, {_MEASURES} from log group by target_lang")
def status_report(spark, sf_dir):
    return report.by_language(x.log(spark, sf_dir))


@query(f"with {x.SQL_LOG} select coalesce(target_lang, '*') as target_lang, {_MEASURES}, grouping(target_lang) as is_total from log group by rollup (target_lang)")
def status_rollup(spark, sf_dir):
    return report.with_total(x.log(spark, sf_dir)).withColumn("is_total", F.col("is_total").cast("long"))


@query(f"""with {x.SQL_LOG} select split_part(backend, ':', 1) as family, count(*) as calls, count(*) filter (status = 'refused') as refusals, round(count(*) filter (status = 'refused')::double / count(*), 6) as refusal_rate,
count(*) filter (status like 'error%') as failures, round(avg(latency_ms), 6) as avg_latency_ms, sum(tokens_in)::bigint as tokens_in, sum(tokens_out)::bigint as tokens_out from log group by 1""")
def backend_stats(spark, sf_dir):
    return report.by_backend(x.log(spark, sf_dir))


@query(f"with {x.SQL_SCORES} select metric, round(avg(score), 6) as mean_score, min(score) as min_score, max(score) as max_score, count(*) as n from scores where score >= 0 group by metric")
def qa_metric_stats(spark, sf_dir):
    return report.metric_stats(x.scores(spark, sf_dir))


_RATES = d.values_sql(list(d.COST_RATES.items()), "family, usd_per_1k")


@query(f"""with {x.SQL_LOG}, u as (select split_part(backend, ':', 1) as family, sum(tokens_in + tokens_out) as tokens from log group by 1), p as (select u.family, tokens, tokens / 1000.0::double * coalesce(usd_per_1k::double, 0) as usd from u left join {_RATES} c on u.family = c.family)
select coalesce(family, '*') as family, sum(tokens)::bigint as tokens, round(sum(usd), 4) as usd from p group by rollup (family)""")
def cost_estimate(spark, sf_dir):
    return report.cost(x.log(spark, sf_dir), spark.createDataFrame(list(d.COST_RATES.items()), "family string, usd_per_1k double"))


_STRATEGY = f"case when prompt_style in {d.CIPHER_STYLES} then 'cipher' when prompt_style in {d.OWN_STYLES} then prompt_style else 'normal' end"


@query(f"with {x.SQL_SOURCE} select {_STRATEGY} as strategy, count(*) as n, count(*) filter (prompt_style in {d.CIPHER_STYLES}) * 9 as calls_saved from source group by 1")
def strategy_distribution(spark, sf_dir):
    style = F.col("prompt_style")
    return x.source(spark, sf_dir).groupBy(t.strategy(style).alias("strategy")).agg(F.count("*").alias("n"), (F.count_if(style.isin(*d.CIPHER_STYLES)) * 9).alias("calls_saved"))


@query("select min(n) as smallest, max(n) as largest, count(*) as groups from (select source, lang, count(*) as n from documents group by source, lang)")
def style_min_max(spark, sf_dir):
    sizes = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return sizes.agg(F.min("n").alias("smallest"), F.max("n").alias("largest"), F.count("*").alias("groups"))


@query(f"with {x.SQL_LOG} select count(distinct prompt_style) as styles, count(distinct target_lang) as languages, count(distinct record_id) as records from log")
def distinct_summary(spark, sf_dir):
    # Distinct keys first: one partial aggregation instead of an expansion of all rows by each distinct column.
    seen = x.log(spark, sf_dir).groupBy("prompt_style", "target_lang", "record_id").agg(F.lit(1).alias("one"))
    return seen.agg(F.count_distinct("prompt_style").alias("styles"), F.count_distinct("target_lang").alias("languages"), F.count_distinct("record_id").alias("records"))


@query("select lang, min(length(text)) as shortest, max(length(text)) as longest, round(avg(length(text)), 6) as mean_chars, count(*) filter (length(text) > 5000) as over_limit from documents group by lang")
def length_stats(spark, sf_dir):
    n = F.length("text")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.min(n).cast("long").alias("shortest"), F.max(n).cast("long").alias("longest"), F.round(F.avg(n), 6).alias("mean_chars"), F.count_if(n > 5000).alias("over_limit"))


@query(f"with {x.SQL_LOG} select count(*) as expected, count(*) filter (status not like 'error%') as saved, count(*) filter (status like 'error%') as errors, sum(retries)::bigint as retries from log")
def error_balance(spark, sf_dir):
    bad = F.col("status").startswith("error")
    return x.log(spark, sf_dir).agg(F.count("*").alias("expected"), F.count_if(~bad).alias("saved"), F.count_if(bad).alias("errors"), F.sum("retries").alias("retries"))


@query(f"with {x.SQL_LOG} select case when status in ('ok', 'success') then 'ok' when status like 'error%' then 'error' else status end as bucket, count(*) as n from log group by 1")
def status_buckets(spark, sf_dir):
    status = F.col("status")
    bucket = F.when(status.isin("ok", "success"), "ok").when(status.startswith("error"), "error").otherwise(status)
    return x.log(spark, sf_dir).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


_LIMITS = d.values_sql(list(d.THRESHOLDS.items()), "metric, min_score")
_REASON = "s.metric || '=' || printf('%.3f', s.score) || ' < ' || case s.metric when 'comet' then '0.7' when 'chrf' then '30.0' when 'backtranslation' then '0.8' else '50.0' end"


@query(f"with {x.SQL_SCORES} select record_id, target_lang, string_agg({_REASON}, '; ' order by {_REASON}) as flag_reasons from scores s join {_LIMITS} l on s.metric = l.metric where s.score < l.min_score::double group by record_id, target_lang")
def flag_reasons(spark, sf_dir):
    return r.flags(x.scores(spark, sf_dir).drop("doc_id"), spark.createDataFrame(list(d.THRESHOLDS.items()), "metric string, min_score double"))


@query(f"""with {x.SQL_SCORES}, flagged as (select distinct record_id, target_lang from scores s join {_LIMITS} l on s.metric = l.metric where s.score < l.min_score::double)
select l.target_lang, count(*) as total, count(f.record_id) as flagged, round(count(f.record_id)::double / count(*), 6) as flag_rate from log l left join flagged f on l.record_id = f.record_id and l.target_lang = f.target_lang group by l.target_lang""")
def qa_flagging(spark, sf_dir):
    # The number of a document is a smaller key than its record id, which is put together from it.
    key = ["doc_id", "target_lang"]
    flags = r.flags(x.scores(spark, sf_dir), spark.createDataFrame(list(d.THRESHOLDS.items()), "metric string, min_score double"), key)
    rows = x.log(spark, sf_dir).select(*key).join(flags, key, "left")
    hit = F.count("flag_reasons")
    return rows.groupBy("target_lang").agg(F.count("*").alias("total"), hit.alias("flagged"), F.round(hit / F.count("*"), 6).alias("flag_rate"))


_QUOTA = """q as (select category, n, least(n, least({size}, sum(n) over ()) // count(*) over () + case when row_number() over (order by n desc, category) <= least({size}, sum(n) over ()) - (least({size}, sum(n) over ()) // count(*) over ()) * count(*) over () then 1 else 0 end)::bigint as quota
  from (select category, count(*) as n from pool group by category))"""


@query("with pool as (select lang as category, source as style, doc_id as record_id from documents), " + _QUOTA.format(size=97) + " select category, n, quota from q")
def category_quota(spark, sf_dir):
    return sampling.quotas(table(spark, sf_dir, "documents").select(F.col("lang").alias("category"), "doc_id"), 97)


def _sample_sql(pool: str, size: int, seed: str) -> str:
    return f"""with pool as ({pool}), {_QUOTA.format(size=size)}, st as (select category, count(distinct style) as n_styles from pool group by category),
ranked as (select p.*, q.quota, greatest(1, q.quota // st.n_styles) as per_style, md5('{seed}|' || p.record_id) as h, row_number() over (partition by p.category, style order by md5('{seed}|' || p.record_id), p.record_id) as sr from pool p join q on p.category = q.category join st on p.category = st.category),
placed as (select *, row_number() over (partition by category order by case when sr <= per_style then 0 else 1 end, case when sr <= per_style then style end, h, record_id) as place from ranked where sr <= quota)
select record_id, category, style, place from placed where place <= quota"""


_POOL = "select lang as category, source as style, doc_id as record_id from documents"


@query(_sample_sql(_POOL, 97, "s1"))
def stratified_sample(spark, sf_dir):
    pool = table(spark, sf_dir, "documents").select(F.col("lang").alias("category"), F.col("source").alias("style"), F.col("doc_id").alias("record_id"))
    return sampling.stratified(pool, 97, "s1").select("record_id", "category", "style", F.col("place").cast("long").alias("place"))


@query(f"with old as ({_sample_sql(_POOL, 97, 's1')}), new as ({_sample_sql(_POOL + ' where doc_id not in (select record_id from (' + _sample_sql(_POOL, 97, 's1') + '))', 60, 's2')}) select record_id, 'old' as origin from old union all select record_id, 'new' from new")
def stratified_extend(spark, sf_dir):
    pool = table(spark, sf_dir, "documents").select(F.col("lang").alias("category"), F.col("source").alias("style"), F.col("doc_id").alias("record_id"))
    old = sampling.stratified(pool, 97, "s1").select("record_id", F.lit("old").alias("origin"))
    rest = pool.join(old.select("record_id"), "record_id", "left_anti")
    return old.unionByName(sampling.stratified(rest, 60, "s2").select("record_id", F.lit("new").alias("origin")))


@query("select doc_id, row_number() over (order by md5('shuffle|' || doc_id), doc_id) as position from documents qualify position <= 100")
def hash_shuffle_topn(spark, sf_dir):
    key = sampling.order_key("shuffle", F.col("doc_id"))
    head = table(spark, sf_dir, "documents").select("doc_id", key.alias("h")).orderBy("h", "doc_id").limit(100)
    return head.select("doc_id", F.row_number().over(Window.orderBy("h", "doc_id")).cast("long").alias("position"))


@query("select source, doc_id, n_chars, row_number() over (partition by source order by n_chars desc, doc_id) as rank from documents qualify rank <= 3")
def group_topk(spark, sf_dir):
    # A window group limit keeps three rows of each source in every task before the shuffle.
    w = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    return table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars").withColumn("rank", F.row_number().over(w)).where("rank <= 3").withColumn("rank", F.col("rank").cast("long"))


@query("select lang, count(*) as n from documents group by lang order by n desc, lang limit 3")
def topk_groups(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(3)


@query("select user_id, event_id, count(*) over (partition by user_id order by ts, event_id rows unbounded preceding) as done, sum(value) over (partition by user_id order by ts, event_id rows unbounded preceding) > 100 as over_100 from events")
def progress_running(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.count("*").over(w).alias("done"), (F.sum("value").over(w) > 100).alias("over_100"))


@query(f"with {x.SQL_LOG} select target_lang, (row_number() over (partition by target_lang order by doc_id) - 1) // 32 as batch_id, doc_id from log")
def batch_ids(spark, sf_dir):
    return r.numbered(x.log(spark, sf_dir), 32, [F.col("doc_id")], ["target_lang"]).select("target_lang", "batch_id", "doc_id")


@query(f"with {x.SQL_LOG} select string_agg(distinct target_lang, ',' order by target_lang) as languages, string_agg(distinct backend, ',' order by backend) as backends from log")
def sorted_distinct(spark, sf_dir):
    return x.log(spark, sf_dir).agg(F.array_join(F.sort_array(F.collect_set("target_lang")), ",").alias("languages"), F.array_join(F.sort_array(F.collect_set("backend")), ",").alias("backends"))


@query(f"""with {x.SQL_SCORES}, q as (select record_id, target_lang, max(score) filter (metric = 'comet') as qa_comet, max(score) filter (metric = 'chrf') as qa_chrf, max(score) filter (metric = 'backtranslation') as qa_backtranslation, max(score) filter (metric = 'gemba') as qa_gemba from scores group by record_id, target_lang)
select l.record_id, l.target_lang, l.status, l.backend, qa_comet, qa_chrf, qa_backtranslation, qa_gemba from log l left join q on l.record_id = q.record_id and l.target_lang = q.target_lang""")
def wide_output(spark, sf_dir):
    rows = x.log(spark, sf_dir).select("doc_id", "record_id", "target_lang", "status", "backend")
    return sinks.wide(rows, x.scores(spark, sf_dir), list(d.THRESHOLDS), ("doc_id", "target_lang")).drop("doc_id")


@query(f"with {x.SQL_LOG}, s as (select target_lang, count(*) as total from log group by target_lang) select '{{\"target_lang\":\"' || target_lang || '\",\"total\":' || total || '}}' as report from s")
def report_row(spark, sf_dir):
    return sinks.report_row(x.log(spark, sf_dir).groupBy("target_lang").agg(F.count("*").alias("total")))


_PRICED = f"(select family, tokens, tokens / 1000.0::double * coalesce(usd_per_1k::double, 0) as usd from (select split_part(backend, ':', 1) as family, sum(tokens_in + tokens_out) as tokens from log group by 1) left join {_RATES} using (family))"


def _flat(section: str, key: str, measures: dict[str, str], source: str, group: str) -> str:
    return " union all ".join(f"select '{section}' as section, {key} as key, '{m}' as measure, ({sql})::double as value from {source} {group}" for m, sql in measures.items())


def _report_sql() -> str:
    done = "status in ('ok', 'success') and text <> ''"
    status = {
        "total": "count(*)", "completed": f"count(*) filter ({done})", "refused": "count(*) filter (status = 'refused')", "too_long": "count(*) filter (status = 'too_long')", "failed": "count(*) filter (status like 'error%')",
        "completion_rate": f"round(count(*) filter ({done})::double / count(*), 6)", "flagged": "count(*) filter (f)",
    }
    backend = {
        "calls": "count(*)", "refusals": status["refused"], "refusal_rate": "round(count(*) filter (status = 'refused')::double / count(*), 6)", "failures": status["failed"],
        "avg_latency_ms": "round(avg(latency_ms), 6)", "tokens_in": "sum(tokens_in)", "tokens_out": "sum(tokens_out)",
    }
    quality = {"mean_score": "round(avg(score), 6)", "min_score": "min(score)", "max_score": "max(score)", "n": "count(*)"}
    timing = {"total_seconds": "count(*) * 0 + 90", "total_minutes": "count(*) * 0 + 1.5", "records_per_second": "round(count(*) / 90.0::double, 6)"}
    parts = [
        _flat("per_language", "target_lang", status, "marked", "group by target_lang"), _flat("summary", "'all'", status | {"languages_processed": "count(distinct target_lang)"}, "marked", ""),
        _flat("per_backend", "split_part(backend, ':', 1)", backend, "log", "group by 2"), _flat("qa_metrics", "metric", quality, "scores where score >= 0", "group by metric"),
        _flat("cost_estimate", "coalesce(family, '*')", {"tokens": "sum(tokens)", "usd": "round(sum(usd), 4)"}, _PRICED, "group by rollup (family)"), _flat("timing", "'all'", timing, "log", ""),
    ]
    return f"with {x.SQL_SCORES}, marked as (select *, m = 7 as f from log) " + " union all ".join(parts)


@query(_report_sql())
def full_report(spark, sf_dir):
    """The whole report as one JSON document, read back number by number."""
    log, scores = x.log(spark, sf_dir), x.scores(spark, sf_dir)
    prices = spark.createDataFrame(list(d.COST_RATES.items()), "family string, usd_per_1k double")
    numbers = report.sections(log, log, scores, prices, log.where("m = 7").select("target_lang"), 90.0)
    parsed = report.document(numbers).select(F.from_json("report", "map<string,map<string,map<string,double>>>").alias("r"))
    rows = parsed.select(F.explode("r").alias("section", "s")).select("section", F.explode("s").alias("key", "k"))
    return rows.select("section", "key", F.explode("k").alias("measure", "value"))


@query(f"with {x.SQL_SOURCE} select record_id, substr(source_text, 1, 200) as source_text from source where doc_id % 6 = 0")
def flagged_export(spark, sf_dir):
    rows = x.source(spark, sf_dir).select("record_id", "source_text", (F.col("doc_id") % 6 == 0).alias("flagged"))
    return sinks.flagged(rows).drop("flagged")


_CLEAN = f"""with {x.SQL_LOG}, said as (select record_id, target_lang, case when status in ('ok', 'success') then text else '' end as tt from log where status in {d.TERMINAL_STATUSES} and prompt_style not in {d.EXCLUDED_STYLES}),
kept as (select * from source where prompt_style not in {d.EXCLUDED_STYLES}), u as (select 'en' as language, prompt_style, source_text as tt from kept where record_id in (select record_id from said) union all select t.target_lang, k.prompt_style, t.tt from said t join kept k on t.record_id = k.record_id)
select language, prompt_style, count(*) as n, count(*) filter (tt <> '') as n_text, sum(length(tt))::bigint as chars from u group by language, prompt_style"""


@query(_CLEAN)
def clean_dataset(spark, sf_dir):
    """Filter, fan-out, selection and assembly end to end, summed by language and style."""
    keep = ~F.col("prompt_style").isin(*d.EXCLUDED_STYLES)
    rows = r.clean_table(x.source(spark, sf_dir).where(keep), x.log(spark, sf_dir).where(keep))
    return rows.groupBy("language", "prompt_style").agg(F.count("*").alias("n"), F.count_if(F.col("turn_text") != "").alias("n_text"), F.sum(F.length("turn_text")).alias("chars"))
