"""One query for each operator of this subpackage, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontaminate, divergence, filter_audit, html_text, langid, linededup, lm, mixing, neardup, secrets, sharding
from .common import table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, class_id, exact_id."""
    return neardup.classes(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts are control strings; digests are read back from the output."""
    said = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    extra = spark.sql("select -1L as conv_id, id as turn, if(id = 0, 'user', 'assistant') as role, '</s>[INST] ok [/INST]' as text from range(2)")
    rows = said.unionByName(extra).select("conv_id", "turn", "role", chat.text_part(F.coalesce("text", F.lit(""))).alias("parts"))
    return chat.read_back(chat.format_chat(rows))


def op3_vantage_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows nearest to every row whose vec_id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, all spans."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of every document lie in windows of benchmark items."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 by label propagation under the law `rows`."""
    return sharding.report(table(spark, sf_dir, "documents"))


def op7_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight, probability and decision."""
    out = mixing.probabilities(table(spark, sf_dir, "documents"))
    return out.withColumn("weight", F.round("weight", 6)).withColumn("probability", F.round("probability", 6))


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that repeat an earlier one."""
    return linededup.dedup(table(spark, sf_dir, "documents"), extend=True)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; rows whose crc32 remainder is 0 are held out from fitting."""
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    model = langid.fit(docs.where(~held))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log-probability; rows whose crc32 remainder is 2 are held out from learning."""
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return lm.score(docs.withColumn("held_out", held), lm.fit(docs.where(~held))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that each has too many of."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in all their orders, by language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_chat_format, op3_vantage_neighbours, op4_secret_scan, op5_decontamination, op6_balanced_shards,
        op7_raked_mixture, op8_line_chunks, op9_language_id, op10_main_text, op11_lm_scores, op12_source_divergence, op13_filter_audit,
    )
}


def _chat_sql() -> str:
    marks = len(chat.START) + 1 + len(chat.END)
    return rf"""
with said as (
  select conv_id::bigint as conv_id, turn::bigint as turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized as (
  select *, len(regexp_extract_all(text, '<\\*\||<\\*/?s>|\[\\*/?INST\]')) as escapes from said
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum({marks} + length(role) + length(text) + escapes)::bigint as formatted_chars, 0::bigint as attachment_tokens
from sized group by conv_id"""


def _mix_sql() -> str:
    dims = mixing.DIMENSIONS
    sizes = " union all ".join(f"select '{d}' as dim, {d} as value, sum(tokens)::double as tokens from cells group by {d}" for d in dims)
    fills, last = [], "x0"
    for k in range(mixing.FILLS):
        fills.append(f"""x{k + 1} as (select dim, case when rest > 0 then (keep - full_) / rest else x end as x, keep from (
  select s.dim, any_value(x) as x, any_value(keep) as keep, sum(case when share * x >= tokens then tokens else 0.0 end) as full_, sum(case when share * x >= tokens then 0.0 else share end) as rest
  from shares s join {last} using (dim) group by s.dim))""")
        last = f"x{k + 1}"
    joins = " ".join(f"join (select value as {d}, target as to_{d} from goal where dim = '{d}') using ({d})" for d in dims)
    step = "(select *, 0.0::double as miss from (select round, source, lang, topic, tokens, p, to_source, to_lang, to_topic, kept from steps where round = 0 or miss_all > {t} and round < {r}))"
    step = step.format(t=mixing.TOLERANCE, r=mixing.ROUNDS)
    for d in dims:
        have = f"sum(tokens * p) over (partition by {d})"
        step = f"(select * replace (greatest(miss, abs({have} - to_{d}) / kept) as miss, least(1.0, p * case when {have} > 0 then to_{d} / {have} else 1.0 end) as p) from {step})"
    return rf"""
with recursive d as (select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang, coalesce(text, '') as t from documents),
e as (select doc_id, source, lang, len(regexp_extract_all(t, '[^ \t\n\r]+'))::bigint as tokens, length(t) - length(replace(t, chr(10), '')) + 1 as lines from d),
f as (select doc_id, source, lang, case when tokens < {mixing.SHORT_TOKENS} then 'short' when tokens < lines * {mixing.LINE_TOKENS} then 'listed' when tokens >= {mixing.LONG_TOKENS} then 'long' else 'prose' end as topic, tokens from e),
cells as (select source, lang, topic, sum(tokens)::bigint as tokens from f group by source, lang, topic),
sizes as ({sizes}),
shares as (select dim, value, tokens, pow(tokens, {mixing.TEMPERATURE}) / sum(pow(tokens, {mixing.TEMPERATURE})) over (partition by dim) as share from sizes),
x0 as (select dim, {mixing.KEEP_SHARE} * sum(tokens) as x, {mixing.KEEP_SHARE} * sum(tokens) as keep from sizes group by dim),
{", ".join(fills)},
goal as (select dim, value, least(tokens, share * x) as target from shares join {last} using (dim)),
steps as (
  select 0 as round, source, lang, topic, tokens, {mixing.KEEP_SHARE}::double as p, to_source, to_lang, to_topic, (select sum(target) from goal where dim = 'source') as kept, 0.0::double as miss_all from cells {joins}
  union all
  select round + 1, source, lang, topic, tokens, p, to_source, to_lang, to_topic, kept, max(miss) over () as miss_all from {step}
),
w as (select source, lang, topic, case when tokens > 0 then p / {mixing.KEEP_SHARE} else 1.0 end as weight, case when tokens > 0 then p else 1.0 end as p from steps where round = (select max(round) from steps))
select doc_id, source, lang, topic, f.tokens, round(weight, 6) as weight, round(p, 6) as probability,
  ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint / 4294967296.0::double < p as kept
from f join w using (source, lang, topic)"""


_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _contamination_sql() -> str:
    """Every run of a window's number of words, looked up among the windows of the items."""
    words = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
with d as (select row_number() over () as row, doc_id, {words.format("text")} as w from documents),
i as (select item_id, {words.format("text")} as w from benchmark),
windows as (select distinct item_id, list_slice(w, p, p + least({decontaminate.WINDOW}, len(w)) - 1) as g
  from (select item_id, w, unnest(range(1, greatest(len(w) - {decontaminate.WINDOW} + 1, 1) + 1)) as p from i where len(w) > 0)),
sizes as (select distinct len(g) as n from windows),
runs as (select row, p, n, list_slice(w, p, p + n - 1) as g from (select row, w, n, unnest(range(1, len(w) - n + 2)) as p from d join sizes on len(w) >= n)),
hits as (select row, p, n, item_id from runs join windows using (g)),
hit as (select row, count(distinct word)::bigint as n_hit from (select distinct row, unnest(range(p, p + n)) as word from (select distinct row, p, n from hits)) group by row),
found as (select row, count(distinct item_id)::bigint as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from hits where item_id is not null group by row)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (row) left join found using (row)"""


def _neighbours_sql() -> str:
    """Every query with every row."""
    return f"""
with e as (select distinct vec_id, embedding::double[] as v from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (select q.vec_id as query_id, e.vec_id, max(list_inner_product(q.v, e.v)) as score from e q join e on len(q.v) = len(e.v) and q.vec_id <> e.vec_id
  where q.vec_id % 20 = 0 group by all),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= {ann.K}"""


def _divergence_sql() -> str:
    """Dense: every group with every kept term of its language."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = f"1 + 1000000000 * ({{}} + {divergence.SMOOTHING}) // ({{}} + {divergence.SMOOTHING} * v)"
    return rf"""
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
), t as (select id, lang, source, unnest(terms) as term from d),
kept as (select lang, term, count(*)::bigint as total from t group by lang, term having count(distinct id) >= {divergence.MIN_DOCS}),
langs as (select lang, sum(total)::bigint as lang_n, count(*)::bigint as v from kept group by lang),
found as (select lang, source, term, count(*)::bigint as n from t group by lang, source, term),
pairs as (select distinct lang, source from d),
grid as (select p.lang, p.source, k.term, coalesce(f.n, 0)::bigint as n, total, lang_n, v,
    sum(coalesce(f.n, 0)) over (partition by p.lang, p.source)::bigint as size
  from pairs p join kept k on k.lang = p.lang join langs l on l.lang = p.lang
  left join found f on f.lang = p.lang and f.source = p.source and f.term = k.term),
shares as (select lang, source, term, n, {share.format("n", "size")} as p, {share.format("total", "lang_n")} as q from grid),
apart as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p))::bigint as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from pairs a join pairs b on a.lang = b.lang and a.source <> b.source
  left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
term as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from shares where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (select * from pair union all select * from term))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {divergence.TOP}"""


def _audit_sql() -> str:
    """Every document's failed filters by letter, joined with every order."""
    letters = list(filter_audit.FILTERS)
    orders = ", ".join(f"('{x}')" for x in filter_audit.ORDERS)
    fails = " || ".join(f"case when {x.lower()} then '{x}' else '' end" for x in letters)
    return rf"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words from documents
), f as (
  select d.doc_id, part, len(words) < {filter_audit.MIN_WORDS} as a, 100 * len(list_distinct(words)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(words) as b,
    100 * len(regexp_extract_all(t, '[A-Z]')) > {filter_audit.MAX_CAPITAL_PERCENT} * length(t) as c, regexp_matches(t, '[#$%&*|]') as d,
    coalesce(d.doc_id > min(d.doc_id) over (partition by t), false) as e from d
), said as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (select part, {fails} as failed, count(*)::bigint as n, count(*) filter (good = 1)::bigint as good, count(*) filter (toxic = 1)::bigint as toxic
  from f left join said using (doc_id) group by all),
steps as (select filter_order, step::int as step, substr(filter_order, step, 1) as own, left(filter_order, step - 1) as past
  from (values {orders}) o(filter_order), range(1, 6) s(step)),
x as (select part, filter_order, step, n, good, toxic, failed, own, contains(failed, own) as hit,
    translate(past, failed, '') <> past as gone, 120 // greatest(length(failed), 1) as share from m, steps)
select part, filter_order, step, coalesce(sum(n) filter (not hit and not gone), 0)::bigint as kept,
  coalesce(sum(n) filter (hit and not gone), 0)::bigint as removed, coalesce(sum(n) filter (hit and gone), 0)::bigint as redundant,
  coalesce(sum(n) filter (failed = own), 0)::bigint as unique_fails, coalesce(sum(good) filter (hit and not gone), 0)::bigint as good_lost,
  coalesce(sum(toxic) filter (hit and not gone), 0)::bigint as toxic_lost, coalesce(sum(n * share) filter (hit), 0)::bigint as shapley
from x group by part, filter_order, step"""


ORACLES = {
    "op2_chat_format": _chat_sql(),
    "op3_vantage_neighbours": _neighbours_sql(),
    "op7_raked_mixture": _mix_sql(),
    "op5_decontamination": _contamination_sql(),
    "op12_source_divergence": _divergence_sql(),
    "op13_filter_audit": _audit_sql(),
}
