"""Scans, projections, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dimensions as d
from ..functions import text as t
from ..operators import relational as r
from ..session import table
from ..sources import readers, sinks
from . import fixtures as x
from .registry import query

_SAMPLE_LANGS = ("de", "es", "fr")


@query("select doc_id, lang, source, n_chars from documents where n_chars >= 100")
def scan_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").where("n_chars >= 100")


@query(f"with {x.SQL_SOURCE} select record_id, question_id, category from source")
def composite_key(spark, sf_dir):
    return x.source(spark, sf_dir).select("record_id", "question_id", "category")


@query(f"with {x.SQL_SOURCE} select record_id, prompt_style from source where prompt_style not in {d.EXCLUDED_STYLES}")
def exclude_styles(spark, sf_dir):
    return x.source(spark, sf_dir).where(~F.col("prompt_style").isin(*d.EXCLUDED_STYLES)).select("record_id", "prompt_style")


@query("""with n as (select doc_id, case doc_id % 9 when 0 then '' when 1 then 'None' when 2 then '[None]' when 3 then '['''']' when 4 then 'nan' when 5 then null else text end as v from documents)
select doc_id, v from n where v is not null and v not in ('', 'None', '[None]', '['''']', 'nan')""")
def null_text_filter(spark, sf_dir):
    k = F.col("doc_id") % 9
    v = F.when(k == 5, F.lit(None).cast("string"))
    for i, bad in enumerate(d.NULL_TEXTS):
        v = v.when(k == i, bad)
    rows = table(spark, sf_dir, "documents").select("doc_id", v.otherwise(F.col("text")).alias("v"))
    return rows.where(~t.null_text(F.col("v")))


@query("select doc_id, substr(text, 1, 200) as preview from documents")
def truncate_preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1, 200).alias("preview"))


@query("select event_id, try_cast(case when event_id % 3 = 0 then event_type else event_id::varchar end as bigint) as n from events")
def lenient_cast(spark, sf_dir):
    mixed = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", mixed.try_cast("bigint").alias("n"))


@query(f"with {x.SQL_LOG} select record_id, target_lang, case when text <> '' then 1 else 0 end as n_turns, case when text <> '' then text end as first_turn from log")
def turns_to_array(spark, sf_dir):
    turns = r.turns(F.col("text"))
    return x.log(spark, sf_dir).select("record_id", "target_lang", F.size(turns).alias("n_turns"), F.get(turns, F.lit(0)).alias("first_turn"))


@query(f"with {x.SQL_LOG} select split_part(backend, ':', 1) as family, count(*) as n from log group by 1")
def backend_family(spark, sf_dir):
    return x.log(spark, sf_dir).groupBy(t.family(F.col("backend")).alias("family")).agg(F.count("*").alias("n"))


@query("select event_id, (props::json ->> 'k')::bigint as k from events")
def props_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("select doc_id, lang, source from documents where doc_id is not null")
def typed_publish(spark, sf_dir):
    from pyspark.sql.types import LongType, StringType, StructType

    schema = StructType().add("doc_id", LongType()).add("lang", StringType()).add("source", StringType())
    text = table(spark, sf_dir, "documents").select(*[F.col(c).cast("string").alias(c) for c in ("doc_id", "lang", "source")])
    return sinks.typed(readers.require(text, ["doc_id", "lang", "source"]), schema).where("doc_id is not null")


@query("select doc_id::varchar as record_id, length(text) as n, 'en' as source_lang, lang as meta_lang from documents")
def load_records(spark, sf_dir):
    rows = readers.records(table(spark, sf_dir, "documents"), "text", id_column="doc_id", metadata=["lang", "absent"])
    return rows.select("record_id", F.length("source_text").alias("n"), "source_lang", F.col("metadata")["lang"].alias("meta_lang"))


@query(f"with {x.SQL_LANGS} select doc_id, target_lang from documents cross join langs")
def fanout_languages(spark, sf_dir):
    return r.fan_out(table(spark, sf_dir, "documents").select("doc_id"), list(d.TARGET_LANGUAGES))


@query(f"with {x.SQL_LOG} select record_id, target_lang from log where not (status in {d.TERMINAL_STATUSES} and m % 2 = 0)")
def resume_pending(spark, sf_dir):
    todo = r.fan_out(x.source(spark, sf_dir).select("record_id"), list(d.TARGET_LANGUAGES))
    done = x.log(spark, sf_dir).where(F.col("status").isin(*d.TERMINAL_STATUSES) & (F.col("m") % 2 == 0))
    return r.pending(todo, done)


@query("select doc_id, source from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def extend_sample_pool(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("select d.doc_id, d.lang, l.quality, l.toxic from documents d join labels l on d.doc_id = l.doc_id")
def attach_labels(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang", "quality", "toxic")


@query(f"with {x.SQL_SOURCE} select record_id, s.category, c.category_name from source s left join {d.values_sql([(i + 1, n) for i, n in enumerate(d.CATEGORIES)], 'category, category_name')} c on s.category = c.category")
def label_left(spark, sf_dir):
    return r.lookup(x.source(spark, sf_dir), d.categories(spark), ["category"], "category_name").select("record_id", "category", "category_name")


_TEMPLATES = [("ascii", "de", "Vorlage A"), ("ascii", "fr", "Modèle A"), ("caesar", "de", "Vorlage C"), ("morse", "es", "Plantilla M")]


@query(f"""with {x.SQL_LOG} select record_id, l.target_lang, coalesce(t.template, '') as template, case when t.template is null then 'normal' else 'cipher' end as used
from log l left join {d.values_sql(_TEMPLATES, 'prompt_style, target_lang, template')} t on l.prompt_style = t.prompt_style and l.target_lang = t.target_lang""")
def template_lookup_fallback(spark, sf_dir):
    templates = spark.createDataFrame(_TEMPLATES, "prompt_style string, target_lang string, template string")
    rows = r.lookup(x.log(spark, sf_dir), templates, ["prompt_style", "target_lang"], "template")
    return rows.select("record_id", "target_lang", F.coalesce("template", F.lit("")).alias("template"), F.when(F.col("template").isNull(), "normal").otherwise("cipher").alias("used"))


_LANG_SQL = d.values_sql([(n, i, b, s, v, g, name) for n, i, b, s, v, g, name in d.LANGUAGES], "nllb_code, iso, bcp47, script, resource_level, lang_group, display_name")
#: How documents name their language: code, model code, name in either case, a tag, or something unknown.
_SQL_NAMED = f"""named as (select doc_id, case doc_id % 6 when 0 then d.lang when 1 then nllb_code when 2 then lower(display_name) when 3 then upper(display_name) when 4 then bcp47 else d.lang || '-xx' end as name
  from documents d left join (select iso, nllb_code, bcp47, display_name from {_LANG_SQL}) b on b.iso = d.lang)"""


def _named(spark, sf_dir):
    known = d.languages(spark).select(F.col("iso").alias("lang"), "nllb_code", "bcp47", "display_name")
    rows, k = table(spark, sf_dir, "documents").join(known, "lang", "left"), F.col("doc_id") % 6
    name = F.when(k == 0, F.col("lang")).when(k == 1, F.col("nllb_code")).when(k == 2, F.lower("display_name")).when(k == 3, F.upper("display_name")).when(k == 4, F.col("bcp47")).otherwise(F.concat("lang", F.lit("-xx")))
    return rows.select("doc_id", name.alias("name"))


def _find_sql(languages: str) -> str:
    return f"""with l as {languages}, {_SQL_NAMED}, k as (select iso as key, 0 as p, l.* from l union all select nllb_code, 1, l.* from l union all select bcp47, 2, l.* from l union all select lower(display_name), 3, l.* from l),
hits as (select n.doc_id, k.iso, k.nllb_code, k.display_name, row_number() over (partition by n.doc_id order by k.p) as rn from named n join k on k.key = n.name and k.p < 3 or k.p = 3 and k.key = lower(n.name))
select n.doc_id, n.name, iso, nllb_code, display_name from named n left join hits h on n.doc_id = h.doc_id and rn = 1"""


@query(_find_sql(_LANG_SQL))
def language_lookup(spark, sf_dir):
    """Every document's language, however it is named."""
    return r.find_language(_named(spark, sf_dir), "name", r.language_keys(spark))


_NEW = [("kat_Geor", "ka", "ka", "Geor", "low", "europe", "Georgian"), ("deu_Latn", "de", "de", "Latn", "high", "europe", "Standard German"), ("fra_Dial", "fr-xx", "fr-XX", "Latn", "low", "europe", "French Dialect")]


@query(_find_sql(f"(select * from {_LANG_SQL} where iso not in ('ka', 'de', 'fr-xx') union all select * from {d.values_sql(_NEW, 'nllb_code, iso, bcp47, script, resource_level, lang_group, display_name')})"))
def register_language(spark, sf_dir):
    """The same with languages registered: one is new, one replaces a known one, so its old name is not found any more."""
    return r.find_language(_named(spark, sf_dir), "name", r.language_keys(spark, spark.createDataFrame(_NEW, d.LANGUAGE_SCHEMA)))


@query(f"""with {x.SQL_LOG} select lang_group, resource_level, count(*) as n, min(iso) as first_iso, count(distinct script)::bigint as scripts, count(*) filter (status = 'refused') as refused
from log join {_LANG_SQL} on iso = target_lang group by all""")
def language_groups(spark, sf_dir):
    """The log by the groups of its languages."""
    rows = x.log(spark, sf_dir).select(F.col("target_lang").alias("iso"), "status").join(d.languages(spark), "iso")
    return rows.groupBy("lang_group", "resource_level").agg(F.count("*").alias("n"), F.min("iso").alias("first_iso"), F.count_distinct("script").alias("scripts"), F.count_if(F.col("status") == "refused").alias("refused"))


@query("""select d.doc_id, coalesce(case when b.doc_id is null then null else 'TIER2_COMPLETE' end, 'TIER2_FAILED') as status, coalesce(b.body, '') as body
from documents d left join (select doc_id, text as body from documents where doc_id % 5 <> 0) b on d.doc_id = b.doc_id""")
def batch_result_match(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    results = docs.where("doc_id % 5 <> 0").select("doc_id", F.col("text").alias("body"))
    return docs.select("doc_id").join(results, "doc_id", "left").select("doc_id", F.when(F.col("body").isNull(), "TIER2_FAILED").otherwise("TIER2_COMPLETE").alias("status"), F.coalesce("body", F.lit("")).alias("body"))


_CAPABLE = [("cohere:a", "de"), ("cohere:a", "fr"), ("openai:b", "ja"), ("nllb", "zh"), ("nllb", "de")]


@query(f"with {x.SQL_LOG} select record_id, target_lang, backend from log where (backend, target_lang) in (select backend, target_lang from {d.values_sql(_CAPABLE, 'backend, target_lang')})")
def capability_semi(spark, sf_dir):
    return r.supported(x.log(spark, sf_dir), spark.createDataFrame(_CAPABLE, "backend string, target_lang string")).select("record_id", "target_lang", "backend")


@query(f"with {x.SQL_LOG} select record_id, target_lang, case when m < 10 then 'old' else 'new' end as origin from log where m < 10 or m >= 5")
def checkpoint_upsert(spark, sf_dir):
    rows = x.log(spark, sf_dir)
    old = rows.where("m < 10").select("record_id", "target_lang", F.lit("old").alias("origin"))
    return r.upsert(old, rows.where("m >= 5").select("record_id", "target_lang", F.lit("new").alias("origin")))


@query(f"""with {x.SQL_LOG}, attempts as (select record_id, target_lang, seq, (m + seq) % 4 = 0 as accepted, 'b' || seq as backend, text || seq::varchar as text from log cross join (values (1), (2), (3)) s(seq)),
won as (select *, row_number() over (partition by record_id, target_lang order by seq) as rn from attempts where accepted)
select l.record_id, l.target_lang, coalesce(w.text, l.text) as final_text, coalesce(w.backend, 'base') as used, coalesce(w.seq, 0) as seq from log l left join won w on l.record_id = w.record_id and l.target_lang = w.target_lang and rn = 1""")
def fallback_chain(spark, sf_dir):
    """Texts are dealt by record once, before languages and attempts multiply them."""
    rows = x.logged(x.source(spark, sf_dir).repartition("record_id"))
    attempts = rows.withColumn("seq", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)]))).select("record_id", "target_lang", "seq", ((F.col("m") + F.col("seq")) % 4 == 0).alias("accepted"), F.concat(F.lit("b"), "seq").alias("backend"), F.concat("text", "seq").alias("text"))
    return r.ordered_fallback(attempts, rows.select("record_id", "target_lang", F.col("text").alias("base_text")), dealt=True)


_CLEAN_SQL = f"""with {x.SQL_LOG}, said as (select record_id, target_lang, case when status in ('ok', 'success') then text else '' end as turn_text from log where status in {d.TERMINAL_STATUSES})
select question_id, category, prompt_style, 'en' as language, source_text as turn_text from source where record_id in (select record_id from said)
union all select s.question_id, s.category, s.prompt_style, t.target_lang, t.turn_text from said t join source s on t.record_id = s.record_id"""


@query(_CLEAN_SQL)
def clean_union(spark, sf_dir):
    return r.clean_table(x.source(spark, sf_dir), x.log(spark, sf_dir))


@query(f"""with clean as ({_CLEAN_SQL}) select question_id, prompt_style, language, row_number() over (order by question_id, prompt_style, case when language = 'en' then '0' else language end) as position
from clean qualify position <= 500""")
def clean_order_head(spark, sf_dir):
    # limit keeps a bounded head in each task before one task numbers it; the full order is a range-partitioned sort.
    head = r.clean_table(x.source(spark, sf_dir), x.log(spark, sf_dir)).orderBy(*r.clean_order()).limit(500)
    from pyspark.sql import Window

    return head.select("question_id", "prompt_style", "language", F.row_number().over(Window.orderBy(*r.clean_order())).cast("long").alias("position"))


_ROUTED = f"case when doc_id % 3 = 1 then 'needs_llm' else status end"


@query(f"""with {x.SQL_LOG}, r as (select *, {_ROUTED} as st from log)
select record_id, target_lang, case when st = 'success' then 'passthrough' when st = 'needs_llm' then case when prompt_style in {d.CIPHER_STYLES} then 'cipher' when prompt_style in {d.OWN_STYLES} then prompt_style else 'normal' end else 'refine' end as route,
case when target_lang in ('bn', 'hi') then 'alternate' else 'default' end as model from r""")
def refine_routing(spark, sf_dir):
    """A third of the rows still need a model, and go by their style."""
    rows = x.log(spark, sf_dir).withColumn("status", F.when(F.col("doc_id") % 3 == 1, "needs_llm").otherwise(F.col("status")))
    return r.route(rows).select("record_id", "target_lang", "route", F.when(F.col("target_lang").isin("bn", "hi"), "alternate").otherwise("default").alias("model"))


@query(f"with {x.SQL_LOG} select record_id, target_lang, status from log where status not like 'error%'")
def persist_filter(spark, sf_dir):
    return x.log(spark, sf_dir).where(~F.col("status").startswith("error")).select("record_id", "target_lang", "status")


@query(f"""with {x.SQL_LOG} select target_lang, count(*) filter (m in (5, 6)) as pending_tier1, count(*) filter (m not in (5, 6) and m % 2 = 0 and status not in ('refused', 'failed')) as pending_tier2,
count(*) filter (text <> '' and m % 5 <> 0) as pending_tier3 from log group by target_lang""")
def pending_by_tier(spark, sf_dir):
    rows = x.log(spark, sf_dir).select("target_lang", "status", F.when(~F.col("m").isin(5, 6), F.col("text")).alias("t1"), F.when(F.col("m") % 2 != 0, F.col("text")).alias("t2"), "text", F.col("m") % 5 == 0)
    rows = rows.toDF("target_lang", "status", "t1", "t2", "final", "scored")
    waits2 = F.col("t1").isNotNull() & F.col("t2").isNull() & ~F.col("status").isin("refused", "failed")
    return rows.groupBy("target_lang").agg(F.count_if(F.col("t1").isNull()).alias("pending_tier1"), F.count_if(waits2).alias("pending_tier2"), F.count_if((F.col("final") != "") & ~F.col("scored")).alias("pending_tier3"))
