"""Text scalars, similarity, model calls and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dimensions as d
from ..functions import profiles, similarity
from ..functions import text as t
from ..functions.unwrap import unwrap_text as unwrap_column
from ..operators import models
from ..operators import relational as r
from ..session import table
from ..sources.scratch import folder as _folder
from ..streaming import incremental
from . import fixtures as x
from .registry import query

_WORDS = r"len(regexp_extract_all({}, '[^ \t\n\r\f\x0b]+'))"
_STRIP = r"regexp_replace({}, '^[ \t\n\r\f\x0b]+|[ \t\n\r\f\x0b]+$', '', 'g')"


def _q(s: str) -> str:
    return s.replace("'", "''")


@query(f"select doc_id, {_WORDS.format('text')} as words, floor({_WORDS.format('text')} * 1.5 + 50)::bigint as max_tokens from documents")
def word_token_budget(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.word_count(F.col("text")).alias("words"), t.token_budget(F.col("text")).alias("max_tokens"))


@query(f"select doc_id, case when doc_id % 5 = 4 then '' else {_STRIP.format('text')} end as first_turn from documents")
def extract_first_turn(spark, sf_dir):
    """Whole texts as the first turn of a list: between single quotes with escapes, as JSON, bare, and an empty list."""
    k = F.col("doc_id") % 5
    text = F.col("text")
    single = F.concat(F.lit("['"), _escaped(text, "'"), F.lit("']"))
    turns = F.when(k == 0, single).when(k == 1, F.to_json(F.array(text, F.lit("second")))).when(k == 4, "[]").otherwise(text)
    return table(spark, sf_dir, "documents").select("doc_id", t.strip(t.first_of_list(turns)).alias("first_turn"))


def _escaped(text, quote: str):
    """The text as it stands between quotes in a list that was turned into a string."""
    for plain, code in (("\\", "\\\\"), (quote, "\\" + quote), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


#: What the rules of unwrapping leave of a text that no whole list explains.
_HEAD = r"""regexp_replace({}, '^\s*(?:\[[''"‘“«]?\s*)*(?:[''"\\]\s*)*', '')"""
_TAIL = r"""regexp_replace({}, '\s*(?:(?:[''"’”»]?\]|[''"])\s*)*$', '')"""
_EDGES = "trim(replace(replace(" + _TAIL.format(_HEAD) + r""", '\"', '"'), '\''', ''''), ' ' || chr(9) || chr(10) || chr(13))"""


@query(f"""with w as (select doc_id, case doc_id % 7 when 3 then '[''' || text when 4 then text || '’]' when 5 then '["' || text || '''' else text end as t from documents)
select doc_id, {_EDGES.format("t")} as clean_text from w""")
def unwrap_text(spark, sf_dir):
    """Whole texts in whole, nested, repeated and broken lists; bare texts with quotes and brackets of their own."""
    k, text = F.col("doc_id") % 7, F.col("text")
    single = F.concat(F.lit("['"), _escaped(text, "'"), F.lit("']"))
    wrapped = (
        F.when(k == 0, single).when(k == 1, F.concat(F.lit('[["'), _escaped(text, '"'), F.lit("\", 'x'], 'y' ]")))
        .when(k == 2, F.concat(F.lit('[ "'), _escaped(single, '"'), F.lit('"]'))).when(k == 3, F.concat(F.lit("['"), text))
        .when(k == 4, F.concat(text, F.lit("’]"))).when(k == 5, F.concat(F.lit('["'), text, F.lit("'"))).otherwise(text)
    )
    return table(spark, sf_dir, "documents").select("doc_id", unwrap_column(wrapped).alias("clean_text"))


@query(rf"""with {x.SQL_TEMPLATED} select doc_id, regexp_extract(prompt, '(?s)^(.*?{d.REQUEST_MARK})\s*(.+)$', 1) as template, {_STRIP.format(rf"regexp_extract(prompt, '(?s)^(.*?{d.REQUEST_MARK})\s*(.+)$', 2)")} as payload from templated""")
def split_payload(spark, sf_dir):
    template, payload = t.split_payload(F.col("prompt"))
    return x.templated(spark, sf_dir).select("doc_id", template.alias("template"), payload.alias("payload"))


@query("""with p as (select doc_id, split(text, ' ') as w from documents), cut as (select doc_id, [array_to_string(w[i * 40 + 1:i * 40 + 40], ' ') for i in range(0, least(6, (len(w) + 39) // 40))] as parts from p)
select doc_id, len(parts)::int as n_examples, replace(parts[1], '\\n', chr(10)) as first_example, replace(parts[-1], '\\n', chr(10)) as last_example from cut""")
def extract_examples(spark, sf_dir):
    """Up to six examples of forty words of each text, with real and typed line ends between them; how many there are depends on the text."""
    words = F.split("text", " ")
    n = F.least(F.lit(6), F.floor((F.size(words) + 39) / 40).cast("int"))
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_join(F.slice(words, i * 40 + 1, 40), " "))
    end = F.when(F.col("doc_id") % 2 == 0, F.lit("\n")).otherwise(F.lit("\\n"))
    body = F.array_join(F.transform(parts, lambda p, i: F.concat(F.lit("Example "), i, end, p, end)), "")
    prompt = F.concat(F.lit("Learn the code."), end, body, end, F.lit("Following is my request you should respond to (in code): x"))
    found = t.examples(prompt)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(found).alias("n_examples"), F.get(found, F.lit(0)).alias("first_example"), F.element_at(found, F.lit(-1)).alias("last_example"))


@query(r"""with """ + x.SQL_TEMPLATED + r""" select t.doc_id, 'T1 ' || regexp_replace(substr(text, 1, 12), '\n+$', '') || ' T2 ' || case when t.doc_id % 3 = 0 then '[CAESAR_CODE_PLACEHOLDER]' else regexp_replace(substr(text, 13, 9), '\n+$', '') end || ' T3 [MORSE_CODE_PLACEHOLDER]. ' ||
case when t.doc_id % 3 = 0 then '' else """ + _STRIP.format("replace(text, chr(10), ' ') || 'Z'") + r""" end as spliced from templated t join documents d on t.doc_id = d.doc_id""")
def splice_template(spark, sf_dir):
    _, payload = t.split_payload(F.col("prompt"))
    return x.templated(spark, sf_dir).select("doc_id", t.splice(F.col("template"), t.examples(F.col("prompt")), payload).alias("spliced"))


@query(f"with {x.SQL_TEMPLATED}, both_kinds as (select doc_id, case when doc_id % 2 = 0 then template else prompt end as v from templated) select doc_id, regexp_matches(v, '{d.PLACEHOLDER}') as needs_heal from both_kinds")
def placeholder_heal(spark, sf_dir):
    v = F.when(F.col("doc_id") % 2 == 0, F.col("template")).otherwise(F.col("prompt"))
    return x.templated(spark, sf_dir).select("doc_id", v.rlike(d.PLACEHOLDER).alias("needs_heal"))


_BODY = "replace(replace(replace({}, '{{target_language}}', 'German'), '{{mt_output}}', lower(source_text)), '{{source_text}}', source_text)"


def _prompt_sql() -> str:
    def of(name: str) -> str:
        return _BODY.format("'" + _q(t.PROMPTS[name]) + "'").replace("{{", "{").replace("}}", "}")

    return f"with {x.SQL_SOURCE} select record_id, case when prompt_style = 'misspellings' then {of('misspellings')} when prompt_style = 'slang' then {of('slang')} when doc_id % 4 = 0 then {of('direct')} else {of('refine')} end as prompt from source"


@query(_prompt_sql())
def build_prompt(spark, sf_dir):
    draft = F.when(F.col("doc_id") % 4 == 0, " ").otherwise(F.lower("source_text"))
    return x.source(spark, sf_dir).select("record_id", t.prompt(t.strategy(F.col("prompt_style")), F.lit("German"), F.col("source_text"), draft).alias("prompt"))


_BASIC = _q("(?i)" + "|".join(f"(?:{p})" for p in d.BASIC_REFUSALS))
_ENGLISH = _q("(?i)" + "|".join(f"(?:{p})" for p in d.ENGLISH_REFUSALS))
_NATIVE = " ".join(f"when '{k}' then regexp_matches(response, '{_q('|'.join(v))}')" for k, v in d.NATIVE_REFUSALS.items())
_SAME = f"{_STRIP.format('response')} = {_STRIP.format('src')}"


@query(f"with {x.SQL_RESPONSES} select conv_id, turn, {_STRIP.format('response')} = '' or regexp_matches(response, '{_BASIC}') or {_SAME} as refused from responses")
def refusal_basic(spark, sf_dir):
    return x.responses(spark, sf_dir).select("conv_id", "turn", t.is_refusal_basic(F.col("response"), F.col("src")).alias("refused"))


_FULL = f"({_STRIP.format('response')} = '' or regexp_matches(response, '{_ENGLISH}') or case target_lang {_NATIVE} else false end or {_SAME} or (length(src) > 20 and length(response) / length(src)::double < 0.1))"


@query(f"with {x.SQL_RESPONSES} select conv_id, turn, {_FULL} as refused from responses")
def refusal_full(spark, sf_dir):
    return x.responses(spark, sf_dir).select("conv_id", "turn", t.is_refusal(F.col("response"), F.col("target_lang"), F.col("src")).alias("refused"))


@query(f"""with {x.SQL_RESPONSES}, s as (select *, {_STRIP.format('response')} as b from responses), p as (select *, split_part(b, chr(10), 1) as line, {_STRIP.format("substr(b, length(split_part(b, chr(10), 1)) + 2)")} as rest from s)
select conv_id, turn, case when contains(b, chr(10)) and regexp_matches(line, '{_ENGLISH}') and not regexp_matches(rest, '{_ENGLISH}') and length(rest) > 10 then rest end as salvaged from p""")
def salvage_mixed(spark, sf_dir):
    return x.responses(spark, sf_dir).select("conv_id", "turn", t.salvage(F.col("response")).alias("salvaged"))


@query("select doc_id, coalesce(list_filter(list_transform(regexp_extract_all(said, '\\b(\\d+(?:\\.\\d+)?)\\b', 1), lambda v: v::double), lambda v: v between 0 and 100)[1], -1) as score from (select doc_id, case doc_id % 4 when 0 then 'Score: ' || n_chars || ' or ' || n_chars % 130 || '.5 of 100. ' || text when 1 then text when 2 then '(' || n_chars % 90 || '.5)' else '-5 ' || source || ' ' || text end as said from documents)")
def parse_score(spark, sf_dir):
    """Answers of a judge with numbers out of range, without any, and in the midst of whole texts."""
    n, k, text = F.col("n_chars"), F.col("doc_id") % 4, F.col("text")
    said = (
        F.when(k == 0, F.concat(F.lit("Score: "), n, F.lit(" or "), n % 130, F.lit(".5 of 100. "), text)).when(k == 1, text)
        .when(k == 2, F.concat(F.lit("("), n % 90, F.lit(".5)"))).otherwise(F.concat(F.lit("-5 "), F.col("source"), F.lit(" "), text))
    )
    return table(spark, sf_dir, "documents").select("doc_id", t.score(said).alias("score"))


_TAG = "case doc_id % 4 when 0 then lang when 1 then lang || '-' || upper(lang) when 2 then 'zh-TW' else 'nb' end"
_EXPECTED = "case tag when 'zh-TW' then 'zh' when 'nb' then 'no' else split_part(tag, '-', 1) end"


@query(f"with g as (select doc_id, lang, {_TAG} as tag from documents) select doc_id, tag, {_EXPECTED} as expected, case when {_EXPECTED} = lang then 0.9::double else 0.0::double end as score from g")
def expected_lang(spark, sf_dir):
    """What a detector should say for each document's target tag, and the score of one that says the document's language with 0.9."""
    k, lang = F.col("doc_id") % 4, F.col("lang")
    tag = F.when(k == 0, lang).when(k == 1, F.concat_ws("-", lang, F.upper(lang))).when(k == 2, "zh-TW").otherwise("nb")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", tag.alias("tag")).withColumn("expected", t.expected_language(F.col("tag")))
    return rows.select("doc_id", "tag", "expected", F.when(F.col("expected") == F.col("lang"), 0.9).otherwise(0.0).alias("score"))


#: Messages and codes of errors by the numbers of events.
_MESSAGES = ("Request timeout", "rate limit exceeds quota", "Too Many Requests", "bad gateway", "prompt is too long", "invalid key", "connection reset by peer", "generated nothing")
_CODES = (0, 429, 502, 400, 403, 200, 503)
_SQL_ERRORS = f"""errors as (select event_id, event_type || ': ' || {list(_MESSAGES)}[(event_id % {len(_MESSAGES)})::int + 1] || ' ' || props as message, {list(_CODES)}[(user_id % {len(_CODES)})::int + 1] as status, event_id % 8 + 1 as attempt from events)"""


def _errors(spark, sf_dir):
    def pick(values, n):
        return F.get(F.array(*[F.lit(v) for v in values]), (n % len(values)).cast("int"))

    message = F.concat("event_type", F.lit(": "), pick(_MESSAGES, F.col("event_id")), F.lit(" "), "props")
    return table(spark, sf_dir, "events").select("event_id", message.alias("message"), pick(_CODES, F.col("user_id")).alias("status"), (F.col("event_id") % 8 + 1).alias("attempt"))


_CLASS = f"""case when regexp_matches(lower(message), '{"|".join(d.TOO_LONG_WORDS)}') then 'too_long' when status = 429 or regexp_matches(lower(message), '{"|".join(d.RATE_LIMIT_WORDS)}') then 'rate_limit'
when status in {d.RETRYABLE_STATUSES} or regexp_matches(lower(message), '{"|".join(d.RETRYABLE_WORDS)}') then 'retryable' else 'fatal' end"""


@query(f"with {_SQL_ERRORS} select event_id, message, status, {_CLASS} as error_class from errors")
def error_class(spark, sf_dir):
    """Events as errors of calls, by what to do about them."""
    return _errors(spark, sf_dir).select("event_id", "message", "status", t.error_class(F.col("message"), F.col("status")).alias("error_class"))


@query(f"""with {_SQL_ERRORS}, c as (select *, {_CLASS} as class from errors where attempt <= 8)
select class, attempt, count(*) as n, sum(case when class = 'rate_limit' then least(30 * attempt, 120) else least(pow(2, attempt), 60) end)::double as seconds from c where class in ('rate_limit', 'retryable') group by all""")
def backoff_schedule(spark, sf_dir):
    """Seconds that the errors of each class and try wait in all."""
    rows = _errors(spark, sf_dir).withColumn("class", t.error_class(F.col("message"), F.col("status"))).where(F.col("class").isin("rate_limit", "retryable"))
    return rows.groupBy("class", "attempt").agg(F.count("*").alias("n"), F.sum(t.backoff(F.col("attempt"), F.col("class") == "rate_limit")).alias("seconds"))


@query("select doc_id, substr(sha256('{\"id\":' || doc_id || ',\"lang\":\"' || lang || '\"}'), 1, 16) as fingerprint from documents")
def fingerprint(spark, sf_dir):
    canonical = F.to_json(F.struct(F.col("doc_id").alias("id"), "lang"))
    return table(spark, sf_dir, "documents").select("doc_id", F.substring(F.sha2(canonical, 256), 1, 16).alias("fingerprint"))


def _wordset(column: str) -> str:
    return rf"list_distinct(list_filter(regexp_split_to_array(lower({column}), '[ \t\n\r\f\x0b]+'), lambda w: w <> ''))"


#: Each of the few items meets a large part of all documents: both sides are dealt over so many keys more.
_SALTS = 16


def _with_items(spark, sf_dir, ref):
    """Every document with the item whose number its own one leaves; `ref` is made once for each item."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item"), ref.alias("ref"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    docs = table(spark, sf_dir, "documents").withColumns({"item": F.col("doc_id") % 40, "salt": F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int")})
    return docs.join(items, ["item", "salt"])


@query(f"""with p as (select d.doc_id, {_wordset('d.text')} as a, {_wordset('b.text')} as b from documents d join benchmark b on b.item_id = d.doc_id % 40)
select doc_id, round(case when len(a) = 0 or len(b) = 0 then 0 else len(list_intersect(a, b))::double / len(list_distinct(list_concat(a, b))) end, 6) as overlap from p""")
def jaccard_tokens(spark, sf_dir):
    pairs = _with_items(spark, sf_dir, t.word_set(F.col("text")))
    return pairs.select("doc_id", F.round(t.set_jaccard(t.word_set(F.col("text")), F.col("ref")), 6).alias("overlap"))


def _chrf_sql() -> str:
    """Grams are joined from characters and those that follow, so that a long text costs no more a character than a short one."""
    clean = r"regexp_extract_all(regexp_replace({}, '[ \t\n\r\f\x0b]+', '', 'g'), '(?s).')"
    orders = " union all ".join(f"select doc_id, side, {n} as ord, {' || '.join(f'c{k}' for k in range(n))} as gram from follow where c{n - 1} is not null" for n in range(1, 7))
    return f"""with pairs as (select d.doc_id, d.text as cand, b.text as ref from documents d join benchmark b on b.item_id = d.doc_id % 40),
sides as (select doc_id, 0 as side, {clean.format("cand")} as l from pairs union all select doc_id, 1, {clean.format("ref")} from pairs),
chars as (select doc_id, side, unnest(l) as c0, generate_subscripts(l, 1) as place from sides),
follow as (select doc_id, side, c0, {", ".join(f"lead(c0, {k}) over w as c{k}" for k in range(1, 6))} from chars window w as (partition by doc_id, side order by place)),
g as ({orders}), c as (select doc_id, ord, gram, count(*) filter (side = 0) as c, count(*) filter (side = 1) as r from g group by doc_id, ord, gram),
o as (select doc_id, ord, sum(least(c, r))::double as both_n, sum(c)::double as c, sum(r)::double as r from c group by doc_id, ord having sum(c) > 0 and sum(r) > 0), m as (select doc_id, avg(both_n / c) as p, avg(both_n / r) as q from o group by doc_id)
select pairs.doc_id, round(coalesce(case when p + q > 0 then 500 * p * q / (4 * p + q) else 0 end, 0), 6) as chrf from pairs left join m on pairs.doc_id = m.doc_id"""


@query(_chrf_sql())
def chrf_score(spark, sf_dir):
    pairs = _with_items(spark, sf_dir, F.col("text"))
    return pairs.select("doc_id", F.round(similarity.chrf(F.col("text"), F.col("ref")), 6).alias("chrf"))


@query(_chrf_sql().replace("as chrf from pairs", "as score from pairs"))
def chrf_metric(spark, sf_dir):
    """chrF as a run asks for it: a registered metric over rows of a source and a translation."""
    pairs = _with_items(spark, sf_dir, F.col("text"))
    rows = pairs.select(F.col("doc_id").cast("string").alias("record_id"), F.col("lang").alias("target_lang"), F.col("ref").alias("source_text"), F.col("text").alias("final_text"))
    return models.judge(rows, ["chrf"]).select(F.col("record_id").cast("long").alias("doc_id"), F.round("score", 6).alias("score"))


def _lang_sql() -> str:
    clean = "' ' || regexp_replace(lower(text), '[^a-zß-ÿ]+', '  ', 'g') || ' '"
    scores = ", ".join(f"len(regexp_extract_all(c, ' (?:{w}) ')) as s_{k}" for k, w in similarity.FREQUENT.items())
    best = "greatest(" + ", ".join(f"s_{k}" for k in similarity.FREQUENT) + ")"
    return f"with c as (select doc_id, lang, {clean} as c from documents), s as (select doc_id, lang, {scores} from c) select doc_id, lang, case " + " ".join(f"when s_{k} = {best} then '{k}'" for k in sorted(similarity.FREQUENT)) + " end as found from s"


@query(_lang_sql())
def lang_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", similarity.language(F.col("text")).alias("found"))


@query("select a.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as cosine from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
def embedding_cosine(spark, sf_dir):
    a = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("x"))
    b = table(spark, sf_dir, "embeddings").select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    return a.join(b, "vec_id").select("vec_id", F.round(similarity.cosine(F.col("x"), F.col("y")), 6).alias("cosine"))


@query("""with c as (select a.vec_id // 8 as text_id, a.vec_id as one, b.vec_id as two, list_cosine_similarity(a.embedding::double[], b.embedding::double[]) as cosine
  from embeddings a join embeddings b on b.vec_id // 8 = a.vec_id // 8 + 1),
p as (select text_id, avg(best) as p from (select text_id, one, max(cosine) as best from c group by all) group by text_id),
r as (select text_id, avg(best) as r from (select text_id, two, max(cosine) as best from c group by all) group by text_id)
select text_id, round(p, 6) as "precision", round(r, 6) as recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 6) as f1 from p join r using (text_id)""")
def token_f1(spark, sf_dir):
    """Eight vectors are a text's tokens; each text is matched with the next one."""
    tokens = table(spark, sf_dir, "embeddings").groupBy(F.floor(F.col("vec_id") / 8).alias("text_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"]).alias("tokens"))
    other = tokens.select((F.col("text_id") - 1).alias("text_id"), F.col("tokens").alias("other"))
    scored = tokens.join(other, "text_id").select("text_id", similarity.token_match(F.col("tokens"), F.col("other")).alias("s"))
    return scored.select("text_id", *[F.round(f"s.{c}", 6).alias(c) for c in ("precision", "recall", "f1")])


_GRAM_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"


@query(f"""with w as (select doc_id, lang, unnest({_GRAM_WORDS}) as w from documents), c as (select doc_id, lang, '_' || w || '_' as w, count(*) as n from w group by all),
g as (select doc_id, lang, n, unnest(list_concat([w[i:i] for i in range(2, length(w))], [w[i:i + 1] for i in range(1, length(w))], [w[i:i + 2] for i in range(1, length(w) - 1)])) as gram from c),
s as (select doc_id, lang, gram, sum(n) as n from g group by all),
mine as (select doc_id, gram, row_number() over (partition by doc_id order by n desc, gram) as rank from s qualify rank <= {profiles.SIZE}),
learned as (select lang, gram, row_number() over (partition by lang order by sum(n) desc, gram) as rank from s where doc_id % 5 <> 0 and lang is not null group by lang, gram qualify rank <= {profiles.SIZE}),
d as (select doc_id, l.lang, sum(abs(mine.rank - l.rank) - {profiles.SIZE}) as less from mine join learned l using (gram) group by doc_id, l.lang),
best as (select doc_id, arg_min(lang, (less, lang)) as found from d group by doc_id)
select doc_id, doc_id % 5 = 0 as held_out, found from documents left join best using (doc_id)""")
def lang_profiles(spark, sf_dir):
    """Languages by ranked n-gram profiles, learned from the documents whose number is not divisible by five."""
    docs = table(spark, sf_dir, "documents")
    learned = profiles.learn(docs.where("doc_id % 5 <> 0"), "text", "lang")
    return profiles.predict(docs, "text", learned).select("doc_id", (F.col("doc_id") % 5 == 0).alias("held_out"), "found")


def _drafts(spark, sf_dir):
    rows = r.fan_out(x.source(spark, sf_dir).select("record_id", "source_text"), ["de", "ja", "zh"])
    return rows.withColumn("draft", F.lit(None).cast("string"))


_SHORT = f"{x.SQL_SOURCE}, rows as (select record_id, target_lang, source_text as s from source cross join (values ('de'), ('ja'), ('zh')) l(target_lang))"


@query(f"with {_SHORT} select record_id, target_lang, 1 as seq, 'offline:lower' as backend, 'ok' as status, lower(s) as text from rows")
def translate_stub(spark, sf_dir):
    return models.refine(_drafts(spark, sf_dir), ["offline:lower"], models.never).select("record_id", "target_lang", "seq", "backend", "status", "text")


def _refuses(said, source, lang):
    return said is None or said.startswith("I'm sorry")


@query(f"""with {_SHORT}, a as (
select record_id, target_lang, 1 as seq, 'offline:refuser' as backend, case when length(s) % 2 = 0 then 'refused' else 'ok' end as status, length(s) % 2 = 1 as accepted from rows where target_lang <> 'ja'
union all select record_id, target_lang, 2, 'offline:reverse', 'ok', true from rows where target_lang <> 'zh' and (target_lang = 'ja' or length(s) % 2 = 0)
union all select record_id, target_lang, 3, 'offline:lower', 'ok', true from rows where target_lang = 'zh' and length(s) % 2 = 0) select * from a""")
def refine_with_fallback(spark, sf_dir):
    out = models.refine(_drafts(spark, sf_dir), ["offline:refuser", "offline:reverse", "offline:lower"], _refuses)
    return out.select("record_id", "target_lang", "seq", "backend", "status", "accepted")


@query(f"with {_SHORT} select record_id, target_lang, 'length_ratio' as metric, round(100.0::double * least(length(s), 20) / greatest(length(s), 20), 6) as score from rows")
def judge_stub(spark, sf_dir):
    rows = _drafts(spark, sf_dir).withColumn("final_text", F.lit("x" * 20))
    return models.judge(rows, ["length_ratio"]).withColumn("score", F.round("score", 6))


def _events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events*").parquet(sf_dir) if not _is_folder(spark, sf_dir) else spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet")


def _is_folder(spark, sf_dir) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


@query("select event_id, case when event_id % 10 = 0 then 'refused' else 'ok' end as status from events where event_id % 7 <> 0")
def stream_resume(spark, sf_dir):
    """Two runs over one checkpoint: the second adds nothing; error rows are not kept."""
    at = _folder(spark)

    def work(batch):
        status = F.when(F.col("event_id") % 7 == 0, "error: timeout").when(F.col("event_id") % 10 == 0, "refused").otherwise("ok")
        return batch.select("event_id", status.alias("status"))

    for _ in range(2):
        incremental.resume(_events(spark, sf_dir), work, f"{at}/sink", f"{at}/checkpoint", ["event_id"]).awaitTermination()
    return incremental.results(spark, f"{at}/sink")


@query("select event_id, case when event_id % 7 = 0 then 'ok' when event_id % 10 = 0 then 'refused' else 'ok' end as status from events")
def stream_retry(spark, sf_dir):
    """Rows that fail in the stream wait, and end terminal when they are asked again."""
    at, events = _folder(spark), _events(spark, sf_dir)
    later = F.when(F.col("event_id") % 10 == 0, "refused").otherwise("ok")

    def work(fails):
        seventh = F.when(F.col("event_id") % 7 == 0, "error: timeout" if fails else "ok")
        return lambda batch: batch.select("event_id", seventh.otherwise(later).alias("status"))

    incremental.resume(events, work(True), f"{at}/sink", f"{at}/checkpoint", ["event_id"]).awaitTermination()
    incremental.retry(spark, work(False), f"{at}/sink", table(spark, sf_dir, "events"), ["event_id"])
    return incremental.results(spark, f"{at}/sink")


@query("select distinct user_id, event_type from events")
def stream_dedupe(spark, sf_dir):
    at = _folder(spark)
    rows = incremental.first_seen(_events(spark, sf_dir), ["user_id", "event_type"], "ts", "3650 days").select("user_id", "event_type")
    incremental.to_table(rows, f"{at}/sink", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/sink").select("user_id", "event_type")


@query("select case when event_id % 7 = 0 then 'retry' else 'terminal' end as queue, count(*) as n from events group by 1")
def stream_error_retry(spark, sf_dir):
    at = _folder(spark)
    rows = _events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 7 == 0, "error: timeout").otherwise("ok").alias("status"))
    incremental.split_terminal(rows, f"{at}/terminal", f"{at}/retry", f"{at}/checkpoint").awaitTermination()
    both = [spark.read.parquet(f"{at}/{q}").select(F.lit(q).alias("queue")) for q in ("terminal", "retry")]
    return r.union_all(both).groupBy("queue").agg(F.count("*").alias("n"))


@query("with m as (select max(time_bucket(interval 1 hour, ts)) as last from events) select epoch(time_bucket(interval 1 hour, ts))::bigint as hour, event_type, count(*) as n from events where time_bucket(interval 1 hour, ts) + interval 1 hour <= (select max(ts) from events) - interval 10 minutes group by 1, 2")
def stream_hourly(spark, sf_dir):
    at = _folder(spark)
    rows = incremental.tumbling(_events(spark, sf_dir), "ts", "1 hour", ["event_type"], [F.count("*").alias("n")]).select(F.unix_timestamp("window.start").alias("hour"), "event_type", "n")
    incremental.to_table(rows, f"{at}/sink", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/sink").select("hour", "event_type", "n")
