"""Text scalars: Column in, Column out, inside whole-stage code generation.

White space is the class [ \\t\\n\\r\\f\\x0b] everywhere, so that results do not
depend on the regex engine. A null argument gives null unless said otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dimensions as d

SPACE = r"[ \t\n\r\f\x0b]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def word_count(text: Column) -> Column:
    """Runs of characters that are not white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0b]+")), F.lit(0)).cast("long")


def token_budget(text: Column) -> Column:
    return F.floor(word_count(text) * 1.5 + 50).cast("long")


def strategy(style: Column) -> Column:
    """normal, cipher, slang or misspellings; unknown styles are normal."""
    return F.when(style.isin(*d.CIPHER_STYLES), "cipher").when(style.isin(*d.OWN_STYLES), style).otherwise("normal")


def null_text(text: Column) -> Column:
    return text.isNull() | text.isin(*d.NULL_TEXTS)


def first_of_list(text: Column) -> Column:
    """A stringified list's first element, stripped; other text stripped; null as empty."""
    bare = strip(F.coalesce(text, F.lit("")))
    found = F.from_json(bare, "array<string>", {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})
    parsed = F.try_element_at(found, F.lit(1))
    is_list = bare.startswith("[") & found.isNotNull() & bare.endswith("]")
    return F.when(is_list, F.coalesce(parsed, F.lit(""))).otherwise(bare)


def english_refusal(text: Column, patterns=d.ENGLISH_REFUSALS) -> Column:
    return text.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


def native_refusal(text: Column, lang: Column) -> Column:
    out = F.when(F.lit(False), False)
    for code, patterns in d.NATIVE_REFUSALS.items():
        out = out.when(F.split_part(lang, F.lit("-"), F.lit(1)) == code, text.rlike("|".join(patterns)))
    return out.otherwise(False)


def is_refusal_basic(text: Column, source: Column) -> Column:
    return blank(text) | english_refusal(text, d.BASIC_REFUSALS) | (strip(text) == strip(source))


def is_refusal(text: Column, lang: Column, source: Column, ratio: float = 0.1) -> Column:
    """Blank, an English or native refusal, the source itself, or far shorter than a source of over 20 characters."""
    short = (F.length(source) > 20) & (F.length(text) / F.length(source) < ratio)
    return blank(text) | english_refusal(text) | native_refusal(text, lang) | F.coalesce(strip(text) == strip(source), F.lit(False)) | F.coalesce(short, F.lit(False))


def salvage(text: Column) -> Column:
    """What follows a refusing first line, if it does not refuse and has over 10 characters; else null."""
    bare = strip(text)
    line = F.substring_index(bare, "\n", 1)
    rest = strip(F.substr(bare, F.length(line) + F.lit(2)))
    return F.when(bare.contains("\n") & english_refusal(line) & ~english_refusal(rest) & (F.length(rest) > 10), rest)


def split_payload(text: Column) -> tuple[Column, Column]:
    """(template, payload) around the request mark; both empty where it is absent."""
    pattern = rf"(?s)\A(.*?{d.REQUEST_MARK})\s*(.+)\z"
    return F.regexp_extract(text, pattern, 1), strip(F.regexp_extract(text, pattern, 2))


def examples(text: Column) -> Column:
    """Bodies after 'Example <n>' lines, as an array; typed or real newlines. The lines and the mark of the prompts."""
    pattern = r"(?s)Example \d+(?:\\n|\n)(.*?)(?=(?:\\n|\n)Example \d+(?:\\n|\n)|(?:\\n\\n|\n\n)Following is)"
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda e: F.replace(e, F.lit("\\n"), F.lit("\n")))


def splice(template: Column, bodies: Column, payload: Column) -> Column:
    """The template with its placeholders filled in order, then a space and the payload.

    Missing bodies leave their placeholders; surplus ones are not used.
    """
    parts = F.split(template, d.PLACEHOLDER)
    holders = F.regexp_extract_all(template, F.lit(d.PLACEHOLDER), F.lit(0))
    filled = F.transform(parts, lambda p, i: F.concat(F.when(i == 0, "").otherwise(F.coalesce(F.regexp_replace(F.get(bodies, i - 1), r"\n+\z", ""), F.get(holders, i - 1), F.lit(""))), p))
    return F.concat(F.array_join(filled, ""), F.lit(" "), payload)


def score(text: Column) -> Column:
    """The first number from 0 to 100 that stands by itself, else -1. Fixed value: the pattern of a number."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"\b(\d+(?:\.\d+)?)\b"), F.lit(1)), lambda x: x.try_cast("double"))
    return F.coalesce(F.get(F.filter(numbers, lambda x: (x >= 0) & (x <= 100)), F.lit(0)), F.lit(-1.0))


def expected_language(lang: Column) -> Column:
    out = F.when(F.lit(False), "")
    for code, found in d.DETECTOR_CODES.items():
        out = out.when(lang == code, found)
    return out.otherwise(F.split_part(lang, F.lit("-"), F.lit(1)))


def error_class(message: Column, status: Column) -> Column:
    """too_long, rate_limit, retryable or fatal; too_long is decided first, as it is terminal."""

    def any_of(words):
        return F.lower(message).rlike("|".join(words))

    return (
        F.when(any_of(d.TOO_LONG_WORDS), "too_long")
        .when((status == 429) | any_of(d.RATE_LIMIT_WORDS), "rate_limit")
        .when(status.isin(*d.RETRYABLE_STATUSES) | any_of(d.RETRYABLE_WORDS), "retryable")
        .otherwise("fatal")
    )


def backoff(attempt: Column, rate_limited: Column) -> Column:
    """Seconds to wait: 30 more for each try up to 120 if limited, else doubling up to 60."""
    return F.when(rate_limited, F.least(attempt * 30, F.lit(120))).otherwise(F.least(F.pow(F.lit(2.0), attempt), F.lit(60.0))).cast("double")


def family(backend: Column) -> Column:
    return F.split_part(backend, F.lit(":"), F.lit(1))


def word_set(text: Column) -> Column:
    """The distinct words of the lower-cased text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), SPACE + "+"), lambda w: w != ""))


def set_jaccard(x: Column, y: Column) -> Column:
    """Of two arrays of distinct values; 0 if either is empty."""

    def of(pair: Column) -> Column:
        both = F.size(F.array_intersect(pair["x"], pair["y"]))
        some = (F.size(pair["x"]) > 0) & (F.size(pair["y"]) > 0)
        return F.when(some, both / (F.size(pair["x"]) + F.size(pair["y"]) - both)).otherwise(0.0)

    # Named once, so that neither set is made again for each of its uses.
    return F.get(F.transform(F.array(F.struct(x.alias("x"), y.alias("y"))), of), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    """Of lower-cased word sets; 0 if either is empty."""
    return set_jaccard(word_set(a), word_set(b))


def prompt(strategy_: Column, language: Column, source: Column, draft: Column) -> Column:
    """The user prompt by strategy; a blank draft asks for a direct translation."""

    slots = {"target_language": language, "mt_output": F.coalesce(draft, F.lit("")), "source_text": source}

    def fill(template):
        # Odd pieces are placeholders: values are never read as templates themselves.
        pieces = re.split(r"\{(\w+)\}", template)
        return F.concat(*[slots[x] if i % 2 else F.lit(x) for i, x in enumerate(pieces)])

    return (
        F.when(strategy_ == "misspellings", fill(PROMPTS["misspellings"]))
        .when(strategy_ == "slang", fill(PROMPTS["slang"]))
        .when(blank(draft), fill(PROMPTS["direct"]))
        .otherwise(fill(PROMPTS["refine"]))
    )


def message(strategy_: Column, language: Column, source: Column, draft: Column) -> Column:
    """system and user prompt of a translation request. A cipher record has none: asking for it is an error, since templates serve it."""
    own = F.when(strategy_ == "misspellings", SYSTEM_PROMPTS["misspellings"]).when(strategy_ == "slang", SYSTEM_PROMPTS["slang"])
    refused = F.raise_error(F.lit("a cipher record is put together from a template, not translated")).cast("string")
    system = F.when(strategy_ == "cipher", refused).otherwise(own.otherwise(SYSTEM_PROMPTS["normal"]))
    return F.struct(system.alias("system"), prompt(strategy_, language, source, draft).alias("user"))


def service_code(service: str, lang: Column) -> Column:
    """The language code that a service wants; null if it doesn't take the language."""
    out = F.when(F.lit(False), "")
    for iso, code in d.SERVICE_CODES[service].items():
        out = out.when(lang == iso, code)
    return out.when(lang.isin(*d.DEEPL_LANGUAGES), F.upper(lang)) if service == "deepl" else out.otherwise(lang)


def recommended_models(lang: Column) -> Column:
    """The models recommended for a language, in their order; none for an unknown one."""
    known = lang.isin(*[row[1] for row in d.LANGUAGES])
    own = [F.when(lang.isin(*langs), F.lit(model)) for model, langs in d.RECOMMENDED.items()]
    return F.array_compact(F.array(F.when(known, F.lit(d.EVERY_LANGUAGE_MODEL)), *own))


def judge_prompt(source_lang: Column, target_lang: Column, source: Column, translation: Column) -> Column:
    """The prompt of the 0 to 100 judge."""
    parts = JUDGE_PROMPT.split("{}")
    slots = (source_lang, target_lang, source_lang, source, target_lang, translation)
    return F.concat(*[c for part, slot in zip(parts, slots) for c in (F.lit(part), slot)], F.lit(parts[-1]))


#: The judge's prompt.
JUDGE_PROMPT = """Score the following translation from {} to {} on a continuous scale from 0 to 100, where a score of zero means "no meaning preserved" and score of one hundred means "perfect meaning and target language quality".

{} source: "{}"
{} translation: "{}"

Score (0-100):"""

#: System prompts.
SYSTEM_PROMPTS = {
    "misspellings": "You are a professional translator working on an academic AI safety research project. You must translate text exactly and completely, preserving the original meaning and intent. The source text intentionally contains misspellings as a deliberate stylistic choice. Your translation MUST also contain similar deliberate misspellings in the target language. Output ONLY the translation with no commentary.",
    "slang": "You are a professional translator working on an academic AI safety research project. You must translate text exactly and completely, preserving the original meaning and intent. The source text uses heavy English slang and colloquialisms. Your translation must use natural slang and colloquial expressions of the target language. Output ONLY the translation with no commentary.",
    "normal": "You are a professional certified translator working on an academic AI safety research project. Your task is to improve machine translation output. You must translate text exactly and completely, preserving the original meaning, tone, and intent without any alteration. Output ONLY the improved translation with no commentary, explanation, or refusal.",
}

#: User prompts.
PROMPTS = {
    "misspellings": "Translate this English text to {target_language}. The English intentionally contains misspellings — your {target_language} translation must also contain deliberate misspellings.\n\nSource (English): {source_text}\n\nOutput only the {target_language} translation with misspellings:",
    "slang": "Translate this English text to {target_language} using informal slang and colloquial expressions natural to native speakers of {target_language}.\n\nSource (English): {source_text}\n\nOutput only the informal/slang {target_language} translation:",
    "refine": "Improve this machine translation from English to {target_language}.\n\nSource (English): {source_text}\n\nMachine translation to improve: {mt_output}\n\nOutput only the improved {target_language} translation:",
    "direct": "Translate the following text from English to {target_language}.\n\nSource (English): {source_text}\n\nOutput only the {target_language} translation:",
}
