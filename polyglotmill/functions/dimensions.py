"""Dimension tables and patterns that results depend on, stated in natural order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# nllb_code iso bcp47 script resource_level group display name
_LANGUAGES = """
eng_Latn en en Latn high europe English
nld_Latn nl nl Latn high europe Dutch
fra_Latn fr fr Latn high europe French
ita_Latn it it Latn high europe Italian
por_Latn pt pt Latn high europe Portuguese
ron_Latn ro ro Latn medium europe Romanian
spa_Latn es es Latn high europe Spanish
ces_Latn cs cs Latn medium europe Czech
pol_Latn pl pl Latn medium europe Polish
ukr_Cyrl uk uk Cyrl medium europe Ukrainian
rus_Cyrl ru ru Cyrl high europe Russian
ell_Grek el el Grek medium europe Greek
deu_Latn de de Latn high europe German
dan_Latn da da Latn medium europe Danish
swe_Latn sv sv Latn medium europe Swedish
nob_Latn nb nb Latn medium europe Bokmal
cat_Latn ca ca Latn medium europe Catalan
glg_Latn gl gl Latn low europe Galician
cym_Latn cy cy Latn low europe Welsh
gle_Latn ga ga Latn low europe Irish
eus_Latn eu eu Latn low europe Basque
hrv_Latn hr hr Latn medium europe Croatian
lvs_Latn lv lv Latn medium europe Latvian
lit_Latn lt lt Latn medium europe Lithuanian
slk_Latn sk sk Latn medium europe Slovak
slv_Latn sl sl Latn medium europe Slovenian
est_Latn et et Latn medium europe Estonian
fin_Latn fi fi Latn medium europe Finnish
hun_Latn hu hu Latn medium europe Hungarian
srp_Cyrl sr sr Cyrl medium europe Serbian
bul_Cyrl bg bg Cyrl medium europe Bulgarian
arb_Arab ar ar Arab medium west_asia Arabic
pes_Arab fa fa Arab medium west_asia Persian
tur_Latn tr tr Latn medium west_asia Turkish
mlt_Latn mt mt Latn low west_asia Maltese
heb_Hebr he he Hebr medium west_asia Hebrew
hin_Deva hi hi Deva medium south_asia Hindi
mar_Deva mr mr Deva low south_asia Marathi
ben_Beng bn bn Beng medium south_asia Bengali
guj_Gujr gu gu Gujr low south_asia Gujarati
pan_Guru pa pa Guru low south_asia Punjabi
tam_Taml ta ta Taml medium south_asia Tamil
tel_Telu te te Telu low south_asia Telugu
npi_Deva ne ne Deva low south_asia Nepali
urd_Arab ur ur Arab medium south_asia Urdu
tgl_Latn tl tl Latn medium asia_pacific Tagalog
zsm_Latn ms ms Latn medium asia_pacific Malay
ind_Latn id id Latn medium asia_pacific Indonesian
vie_Latn vi vi Latn medium asia_pacific Vietnamese
jav_Latn jv jv Latn low asia_pacific Javanese
khm_Khmr km km Khmr low asia_pacific Khmer
tha_Thai th th Thai medium asia_pacific Thai
lao_Laoo lo lo Laoo low asia_pacific Lao
zho_Hans zh zh-Hans Hans high asia_pacific Chinese Simplified
zho_Hant zh-TW zh-Hant Hant high asia_pacific Chinese Traditional
mya_Mymr my my Mymr low asia_pacific Burmese
jpn_Jpan ja ja Jpan high asia_pacific Japanese
kor_Hang ko ko Hang high asia_pacific Korean
amh_Ethi am am Ethi low african Amharic
hau_Latn ha ha Latn low african Hausa
ibo_Latn ig ig Latn low african Igbo
plt_Latn mg mg Latn low african Malagasy
sna_Latn sn sn Latn low african Shona
swh_Latn sw sw Latn low african Swahili
wol_Latn wo wo Latn low african Wolof
xho_Latn xh xh Latn low african Xhosa
yor_Latn yo yo Latn low african Yoruba
zul_Latn zu zu Latn low african Zulu
"""
LANGUAGES = [tuple(line.split(" ", 6)) for line in _LANGUAGES.strip().splitlines()]
LANGUAGE_SCHEMA = "nllb_code string, iso string, bcp47 string, script string, resource_level string, lang_group string, display_name string"

#: Models recommended for translation, and the languages of each; the first one is recommended for every known language.
EVERY_LANGUAGE_MODEL = "nllb-200-3.3B"
RECOMMENDED = {
    "TowerInstruct-13B": ("en", "nl", "fr", "it", "pt", "es", "ru", "de", "ko"),
    "ALMA-R": ("en", "fr", "pt", "es", "cs", "de", "zh"),
    "GemmaX2-28-9B": ("en", "fr", "es", "ru", "de", "ar", "hi", "bn", "zh", "ja"),
}

TARGET_LANGUAGES = ("ar", "bn", "de", "es", "fr", "hi", "ja", "ru", "zh")

EXCLUDED_STYLES = ("translate-fr", "translate-ml", "translate-mr", "translate-ta", "translate-zh-cn", "uncommon_dialects")
NORMAL_STYLES = ("base", "authority_endorsement", "evidence-based_persuasion", "expert_endorsement", "logical_appeal", "misrepresentation", "question", "role_play", "technical_terms")
CIPHER_STYLES = ("ascii", "atbash", "caesar", "morse")
OWN_STYLES = ("slang", "misspellings")
NULL_TEXTS = ("", "None", "[None]", "['']", "nan")
TERMINAL_STATUSES = ("ok", "success", "refused", "too_long")

#: Refusals in English, matched in either case.
ENGLISH_REFUSALS = (
    r"I('m| am) (sorry|unable|not able)",
    r"I can(not|'t) (translate|provide|assist|help|fulfill|comply)",
    r"I (will not|won't|refuse to)",
    r"as an AI( language model)?",
    r"I('m| am) an AI",
    r"against my (programming|guidelines|policy|ethics)",
    r"(harmful|dangerous|inappropriate|offensive|unethical) content",
    r"I (must|have to) (decline|refuse)",
    r"not (appropriate|comfortable|able) (for me )?(to translate|translating)",
    r"(violates?|against) (my|our|the) (guidelines?|policy|policies|terms)",
    r"I do(n't| not) (feel comfortable|think it('s| is) appropriate)",
    r"content (policy|warning|filter)",
    r"(ethical|safety) (concern|consideration|guideline)",
)
#: The narrower list of the batch scripts.
BASIC_REFUSALS = (
    r"I('m| am) (sorry|unable|not able)",
    r"I can(not|'t) (translate|provide|assist)",
    r"I (will not|won't|refuse to)",
    r"as an AI",
    r"against my (guidelines|policy)",
    r"(harmful|inappropriate|offensive) content",
)
#: Refusals by language, matched in their case.
NATIVE_REFUSALS = {
    "ar": ("لا أستطيع", "أعتذر", "لا يمكنني"),
    "bn": ("আমি পারি না", "দুঃখিত", "আমি অক্ষম"),
    "de": ("Ich kann nicht", "Es tut mir leid", "Ich bin nicht in der Lage"),
    "es": ("No puedo", "Lo siento", "No me es posible"),
    "fr": ("Je ne peux pas", "Je suis désolé", "Il m'est impossible"),
    "hi": ("मैं नहीं कर सकता", "मुझे खेद है", "मैं असमर्थ हूं"),
    "ja": ("翻訳できません", "申し訳ありません", "お断り"),
    "ru": ("Я не могу", "Извините", "Я не в состоянии"),
    "zh": ("我无法", "很抱歉", "我不能"),
}
TOO_LONG_WORDS = ("too long", "context window", "token limit", "max tokens", "context length", "too many tokens", "exceeds", "maximum context")
RETRYABLE_WORDS = ("timeout", "connection", "reset", "eof", "rate")
RETRYABLE_STATUSES = (401, 429, 500, 502, 503, 504)
RATE_LIMIT_WORDS = ("429", "rate limit", "too many requests")
#: Language codes of the detector that differ from the part before the hyphen.
DETECTOR_CODES = {"zh": "zh", "zh-TW": "zh", "nb": "no"}
#: Codes that a service names otherwise than ISO does; for deepl, all languages that it takes, in capitals unless given.
SERVICE_CODES = {
    "google_translate": {"zh": "zh-CN", "zh-TW": "zh-TW"},
    "amazon_translate": {"zh": "zh", "zh-TW": "zh-TW"},
    "azure_translate": {"zh": "zh-Hans", "zh-TW": "zh-Hant", "nb": "nb"},
    "deepl": {"en": "EN-US", "pt": "PT-BR", "zh": "ZH-HANS"},
}
DEEPL_LANGUAGES = tuple("ar bg cs da de el en es et fi fr hu id it ja ko lt lv nb nl pl pt ro ru sk sl sv tr uk zh".split())

#: US dollars per 1,000 tokens.
COST_RATES = {"cohere": 0.002, "openai": 0.00075, "anthropic": 0.003, "gemini": 0.00075}
#: Smallest accepted score by metric.
THRESHOLDS = {"comet": 0.7, "chrf": 30.0, "backtranslation": 0.8, "gemba": 50.0}

PLACEHOLDER = r"\[[A-Z_]+CODE_PLACEHOLDER\]"
REQUEST_MARK = r"Following is my request you should respond to \([^)]+\):"

CATEGORIES = tuple(
    """Personal Insult Words;Social-group Insult Words;Threatening Words;Lewd and Obscene Words;Libelous Words;Self-Harm;Violent Crimes;Harassment;Sexual Crimes;Property Crimes;Public Order Crimes;System Intrusion;Malware;Fraud;Financial Crimes;IP Infringement;PII Violations;Illegal Crafting;Terrorism;Child-related Crimes;Animal-related Crimes;Environmental Crimes;Evasion of Law;Human Elimination;Advice on Adult Content;Sexual Explicit Content;Non-sexual Explicit Content;Fake News;False Advertising;Discrimination;Military Use;Political Belief;Ethical Belief;Religion;Social Stereotypes;Extremist Content;Conspiracy Theories;False Common Knowledge;Unhealthy Behaviors;Medical Advice;Financial Advice;Legal Consulting Advice;Governance Decision Advice;Machinery Operation Advice""".split(";")
)


def languages(spark: SparkSession) -> DataFrame:
    """68 rows: safe to broadcast at any scale."""
    return spark.createDataFrame(LANGUAGES, LANGUAGE_SCHEMA)


def categories(spark: SparkSession) -> DataFrame:
    """44 rows: safe to broadcast at any scale."""
    return spark.createDataFrame([(i + 1, name) for i, name in enumerate(CATEGORIES)], "category long, category_name string")


def values_sql(rows, columns: str) -> str:
    """The rows as a DuckDB subquery."""

    def lit(x):
        return "null" if x is None else str(x) if isinstance(x, int | float) else "'" + str(x).replace("'", "''") + "'"

    return f"(select * from (values {', '.join('(' + ', '.join(lit(x) for x in r) + ')' for r in rows)}) as v({columns}))"
