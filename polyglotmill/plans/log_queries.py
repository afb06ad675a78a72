"""Positions, sorted logs, cipher rows from templates, previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dimensions as d
from ..functions import text as t
from ..operators import logs, positions, sampling
from ..operators import relational as r
from ..session import table
from ..sources import readers, scratch
from ..sources.checkpoints import Checkpoint
from . import fixtures as x
from .registry import query


@query("select doc_id, lang, row_number() over (order by lang nulls first, n_chars desc nulls last, doc_id) - 1 as position from documents")
def dense_positions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return positions.dense(docs, [F.col("lang"), F.desc("n_chars"), F.col("doc_id")]).select("doc_id", "lang", "position")


@query("select (row_number() over () - 1)::varchar as record_id, text as source_text, 'en' as source_lang from documents")
def ordinal_records(spark, sf_dir):
    """Records without an id column: their places in the file, as strings."""
    return readers.records(table(spark, sf_dir, "documents").drop("doc_id"), "text").select("record_id", "source_text", "source_lang")


@query("select row_number() over () - 1 as position, doc_id, upper(lang) as answer from documents")
def restored_order(spark, sf_dir):
    """Answers that come back in any order, written in the order of the input; the place is that in the files."""
    at = scratch.folder(spark)
    asked = positions.arrival(table(spark, sf_dir, "documents").select("doc_id", "lang"))
    answers = asked.repartition(13, F.xxhash64("doc_id")).select("doc_id", F.upper("lang").alias("answer"), "arrival")
    positions.write_sorted(answers, at, [F.col("arrival")])
    return positions.read_sorted(spark.read.parquet(at)).select("position", "doc_id", "answer")


@query("select doc_id, n_chars, (sum(n_chars) over (order by source, doc_id) - n_chars)::bigint as chars_before from documents")
def running_sum(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return positions.running(docs, F.col("n_chars"), [F.col("source"), F.col("doc_id")], "chars_before").select("doc_id", "n_chars", "chars_before")


#: Four of ten documents are in a cipher style; of those a third lack the mark, or a template in their language.
_STYLE = f"case doc_id % 5 when 0 then 'base' when 1 then 'ascii' when 2 then 'morse' when 3 then 'slang' else 'caesar' end"
_TEMPLATE_LANGS = ("de", "fr")
_SQL_CIPHER = f"""{x.SQL_TEMPLATED}, recs as (select t.doc_id, {_STYLE} as prompt_style, prompt, category from templated t join (select doc_id, doc_id % 44 + 1 as category from documents) using (doc_id)),
parsed as (select *, trim(regexp_extract(prompt, '(?s)^(.*?{d.REQUEST_MARK})\\s*(.+)$', 2), ' ' || chr(9) || chr(10) || chr(13)) as payload, prompt_style in {d.CIPHER_STYLES} as cipher from recs),
worked as (select *, case when cipher and payload <> '' then 'cipher' when prompt_style = 'slang' then 'slang' else 'normal' end as strategy from parsed),
templates as (select prompt_style, target_lang, item_text || ' [ASCII_CODE_PLACEHOLDER] and [MORSE_CODE_PLACEHOLDER] ' || target_lang || ':' as template
  from (values ('ascii', 0), ('caesar', 1)) s(prompt_style, item_id) join (select item_id, substr(text, 1, 40) as item_text from benchmark) using (item_id) cross join (values ('de'), ('fr')) l(target_lang)),
fanned as (select * from worked cross join (values ('de'), ('fr'), ('ja')) l(target_lang))"""


def _cipher_records(spark, sf_dir):
    k = F.col("doc_id") % 5
    style = F.when(k == 0, "base").when(k == 1, "ascii").when(k == 2, "morse").when(k == 3, "slang").otherwise("caesar")
    records = x.templated(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("record_id"), F.col("doc_id").alias("question_id"), F.col("prompt").alias("source_text"), (F.col("doc_id") % 44 + 1).alias("category"), style.alias("prompt_style")
    )
    return logs.with_strategy(records)


def _templates(spark, sf_dir):
    """Templates of two styles in two languages, from benchmark texts."""
    style = F.when(F.col("item_id") == 0, "ascii").when(F.col("item_id") == 1, "caesar")
    rows = r.fan_out(table(spark, sf_dir, "benchmark").where("item_id < 2"), list(_TEMPLATE_LANGS))
    holders = F.concat(F.substring("text", 1, 40), F.lit(" [ASCII_CODE_PLACEHOLDER] and [MORSE_CODE_PLACEHOLDER] "), F.col("target_lang"), F.lit(":"))
    return rows.select(style.alias("prompt_style"), "target_lang", holders.alias("template"))


@query(f"""with {_SQL_CIPHER} select prompt_style, target_lang, strategy as translation_strategy, case when strategy = 'cipher' and template is null then 'normal' else strategy end as worked_as,
count(*) as n, count(template) filter (strategy = 'cipher') as n_templates, coalesce(sum(length(payload)) filter (strategy = 'cipher'), 0)::bigint as payload_chars
from fanned left join templates using (prompt_style, target_lang) group by all""")
def strategy_routes(spark, sf_dir):
    """Records in three languages: a cipher without a payload, or without a template in the language, is worked as a normal record."""
    rows = logs.routed(r.fan_out(_cipher_records(spark, sf_dir), ["de", "fr", "ja"]), _templates(spark, sf_dir))
    return rows.groupBy("prompt_style", "target_lang", "translation_strategy", "worked_as").agg(
        F.count("*").alias("n"), F.count("template").alias("n_templates"), F.sum(F.length("cipher_payload")).alias("payload_chars")
    )


_E1 = r"regexp_replace(substr(text, 1, 12), '\n+$', '')"
_E2 = r"regexp_replace(substr(text, 13, 9), '\n+$', '')"


@query(f"""with {_SQL_CIPHER}, made as (select f.*, replace(replace(template, '[ASCII_CODE_PLACEHOLDER]', {_E1}), '[MORSE_CODE_PLACEHOLDER]', {_E2}) || ' ' || payload as said
  from fanned f join templates using (prompt_style, target_lang) join documents using (doc_id) where strategy = 'cipher')
select doc_id::varchar as record_id, doc_id::varchar as question_id, target_lang, prompt as source_text, category::varchar as category, null::varchar as category_name, prompt_style, strategy as translation_strategy,
payload as cipher_payload, said as tier1_translation, '{logs.TEMPLATE_BACKEND}' as tier1_backend, 'success' as tier1_status, 0::bigint as tier1_latency_ms, 0::bigint as retries from made""")
def cipher_rows(spark, sf_dir):
    """The rows of the log that templates give: examples and payload of the prompt, put into the template of the language."""
    return logs.assembled(logs.routed(r.fan_out(_cipher_records(spark, sf_dir), ["de", "fr", "ja"]), _templates(spark, sf_dir)))


@query(f"""with {x.SQL_LOG}, rows14 as (select doc_id, record_id, (doc_id // 10)::varchar as question_id, target_lang, prompt_style, text, backend, status, latency_ms, retries from log where m <> 2)
select row_number() over (order by question_id, target_lang, doc_id) - 1 as position, record_id, question_id, target_lang, sha256(text) as text_sha256, prompt_style, backend as tier1_backend, status as tier1_status,
latency_ms::bigint as tier1_latency_ms, retries::bigint as retries from rows14""")
def sorted_log(spark, sf_dir):
    """The log by question id as text and language, ties as they arrived, written over several files and read in their order."""
    at = scratch.folder(spark)

    def fan(records):
        return x.logged(records).where("m <> 2").withColumns({"question_id": question, "arrival": F.col("doc_id")})

    def shape(rows):
        log = logs.base_rows(rows.withColumn("source_text", F.col("text")), F.col("text"), F.col("backend"), F.col("status"), F.col("latency_ms"), F.col("retries"))
        return log.withColumn("arrival", F.split_part("record_id", F.lit("_"), F.lit(1)).cast("long"))

    question = F.floor(F.col("doc_id") / 10)
    logs.write_fanned(x.source(spark, sf_dir).withColumn("question_id", question), fan, shape, at, partitions=7)
    found = positions.read_sorted(spark.read.parquet(at))
    return found.select("position", "record_id", "question_id", "target_lang", F.sha2("tier1_translation", 256).alias("text_sha256"), "prompt_style", "tier1_backend", "tier1_status", "tier1_latency_ms", "retries")


_DIRECT = t.PROMPTS["direct"].replace("'", "''")


@query(f"""with first3 as (select doc_id, text from documents order by n_chars desc, doc_id limit 3)
select doc_id::varchar as record_id, target_lang, case when doc_id % 2 = 0 then 'slang' else 'normal' end as translation_strategy,
substr(replace(replace(case when doc_id % 2 = 0 then '{t.PROMPTS["slang"].replace("'", "''")}' else '{_DIRECT}' end, '{{target_language}}', target_lang), '{{source_text}}', text), 1, 300) as message
from first3 cross join (values ('ar'), ('bn')) l(target_lang)""")
def dry_run(spark, sf_dir):
    """What a run would ask for the three longest documents in the first two languages."""
    docs = table(spark, sf_dir, "documents").withColumn("translation_strategy", F.when(F.col("doc_id") % 2 == 0, "slang").otherwise("normal"))
    rows = docs.select(F.col("doc_id").cast("string").alias("record_id"), "doc_id", "n_chars", F.col("text").alias("source_text"), "translation_strategy")
    return logs.preview(rows, list(d.TARGET_LANGUAGES), [F.desc("n_chars"), F.col("doc_id")])


@query("select lang, source, doc_id, n_chars from documents qualify row_number() over (partition by lang, source order by n_chars, doc_id) = 1")
def first_of_group(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return logs.first_per_group(docs, ["lang", "source"], [F.col("n_chars"), F.col("doc_id")], ["doc_id", "n_chars"])


def _message_sql() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def user(name: str) -> str:
        return f"replace(replace(replace({text(t.PROMPTS[name])}, '{{target_language}}', target_lang), '{{mt_output}}', lower(prompt_style)), '{{source_text}}', prompt)"

    system = " ".join(f"when '{k}' then {text(v)}" for k, v in t.SYSTEM_PROMPTS.items())
    return f"""with {_SQL_CIPHER}, w as (select f.*, case when strategy = 'cipher' and template is null then 'normal' else strategy end as worked_as from fanned f left join templates using (prompt_style, target_lang))
select doc_id::varchar as record_id, target_lang, worked_as, case worked_as {system} end as system, sha256(case worked_as when 'slang' then {user("slang")} else case when doc_id % 2 = 0 then {user("refine")} else {user("direct")} end end) as user_sha256
from w where worked_as <> 'cipher'"""


@query(_message_sql())
def translation_messages(spark, sf_dir):
    """System and user prompts of all records that no template serves, ciphers that are worked as normal ones among them."""
    rows = logs.routed(r.fan_out(_cipher_records(spark, sf_dir), ["de", "fr", "ja"]), _templates(spark, sf_dir)).where("worked_as <> 'cipher'")
    draft = F.when(F.col("question_id") % 2 == 0, F.lower("prompt_style")).otherwise(" ")
    said = t.message(F.col("worked_as"), F.col("target_lang"), F.col("source_text"), draft)
    return rows.select("record_id", "target_lang", "worked_as", said.alias("m")).select("record_id", "target_lang", "worked_as", "m.system", F.sha2("m.user", 256).alias("user_sha256"))


@query(f"with {x.SQL_LOG} select target_lang, count(*) as n_rows, count(*) filter (status in {d.TERMINAL_STATUSES}) as n_done from log group by target_lang")
def restored_checkpoint(spark, sf_dir):
    """A checkpoint published as a dataset, and taken from there where nothing is saved."""
    at, log = scratch.folder(spark), x.log(spark, sf_dir).select("record_id", "target_lang", "status")
    saved = Checkpoint(spark, f"{at}/one", log.schema)
    saved.save(log)
    saved.publish("runs/checkpoint", f"{at}/mirror")
    other = Checkpoint(spark, f"{at}/two", log.schema)
    other.restore("runs/checkpoint", f"{at}/mirror")
    return other.progress(F.col("status").isin(*d.TERMINAL_STATUSES))


@query("""with pool as (select doc_id as record_id, lang as category, source as style from documents)
select 'first' as way, record_id from (select record_id from pool order by record_id desc limit 40) union all select 'prebuilt', record_id from pool where record_id % 9 = 0""")
def sample_source(spark, sf_dir):
    """A sample that was built before, and the first records where there is none."""
    at = scratch.folder(spark)
    pool = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), F.col("lang").alias("category"), F.col("source").alias("style"))
    pool.where("record_id % 9 = 0").write.parquet(f"{at}/sample")
    ways = {"first": sampling.chosen(spark, pool, 40, "s", f"{at}/absent", [F.desc("record_id")]), "prebuilt": sampling.chosen(spark, pool, 40, "s", f"{at}/sample", [F.desc("record_id")])}
    return r.union_all([df.select(F.lit(way).alias("way"), "record_id") for way, df in ways.items()])


_MODELS = " ".join(f"|| case when target_lang in {langs} then ',{m}' else '' end" for m, langs in d.RECOMMENDED.items())


@query(f"with {x.SQL_LOG} select target_lang, '{d.EVERY_LANGUAGE_MODEL}' {_MODELS} as models, count(*) as n, count(*) filter (status = 'refused') as refused from log group by all")
def recommended_models(spark, sf_dir):
    """The log by the models that its languages may ask."""
    rows = x.log(spark, sf_dir).select("target_lang", "status", F.array_join(t.recommended_models(F.col("target_lang")), ",").alias("models"))
    return rows.groupBy("target_lang", "models").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "refused").alias("refused"))


@query("""with s as (select conv_id, list(text order by turn, role, text) as turns from conversations group by conv_id)
select conv_id::varchar as record_id, turns[1] as source_text, 'en' as source_lang, len(turns)::varchar as n_turns from s union all select conv_id || '-nested', turns[1], 'en', len(turns)::varchar from s""")
def turn_records(spark, sf_dir):
    """Records whose text is the first of a list of turns, and the first of a list in a list."""
    said = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x["text"]).alias("turns"))
    said = said.select(F.col("conv_id").cast("string").alias("id"), "turns", F.size("turns").alias("n_turns"))
    nested = said.select(F.concat("id", F.lit("-nested")).alias("id"), F.array("turns", F.array(F.lit("x"))).alias("turns"), "n_turns")
    parts = [readers.records(df, "turns", "id", metadata=["n_turns", "absent"]) for df in (said, nested)]
    return r.union_all(parts).select("record_id", "source_text", "source_lang", F.col("metadata")["n_turns"].alias("n_turns"))
