"""Chat formatting (operator 2): typed content parts, in DataFrame functions only.

A message holds parts of a type: text, image, audio or document. A visitor
(one expression per type) flattens them in order: texts side by side are joined
and escaped, every other part becomes a placeholder, its reference is recorded,
and the number of tokens that the placeholder expands to is counted. Turns read

    <|im_start|>role\\n body <|im_end|>\\n

Text can hold control strings. After the first character of each control
string, and of each control string that already has backslashes there, one
backslash is put in; reading takes one out, so any text comes back as it was.
In roles, percent signs and newlines are percent-encoded.

The loss mask is a list of spans (code points of the formatted text), one for
each assistant turn's body. Offsets are running sums in a window that the
final aggregation shares its partitioning with, so there is one shuffle.

Cases: null text counts as empty, a null role as an empty one, null parts as
none. Null turns come first; turns that tie are ordered by role, then by the
text of their parts as it was before escaping; repeated rows stay, one turn each. A null conversation id is a conversation.
Parts of an unknown type become <|attachment|> with 0 tokens. Empty tables
give no rows. Other columns are not read, so their names can't clash. One
conversation is one output row, so its whole text, of any length, must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: What can follow an opening < or [ in a control string.
_TAIL = r"(?=\||/?s>|/?INST\])"
_OPEN = r"([<\[])"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH_PIXELS = 28
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + r"(\\*)" + _TAIL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + r"\\(\\*)" + _TAIL, "$1$2")


def encode_role(role: Column) -> Column:
    return escape(F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def decode_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def text_part(text: Column) -> Column:
    """One text part, as an array of parts."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))])).cast(f"array<{PART}>")


def part_tokens(part: Column) -> Column:
    """Tokens that the part's placeholder expands to; text has none of these."""
    kind = part["type"]
    image = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH_PIXELS) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH_PIXELS)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND)
    pages = F.coalesce(part["pages"], F.lit(0)) * DOCUMENT_TOKENS_PER_PAGE
    return F.when(kind == "image", image).when(kind == "audio", audio).when(kind == "document", pages).otherwise(0).cast("long")


def placeholder(part: Column) -> Column:
    """What stands in the body for a part that is no text."""
    kind = part["type"]
    return F.when(kind.isin("image", "audio", "document"), F.concat(F.lit("<|"), kind, F.lit("|>"))).otherwise("<|attachment|>")


def visit(parts: Column) -> Column:
    """The body of a message. Texts side by side are one run, escaped as a whole: no control string comes about where they meet."""
    others = F.filter(F.transform(parts, lambda p, i: F.when(~p["type"].eqNullSafe("text"), i)), lambda i: i.isNotNull())
    edges = F.concat(F.array(F.lit(-1)), others, F.array(F.size(parts)))

    def of(edges: Column) -> Column:
        def piece(j: Column) -> Column:
            first, end = F.get(edges, j), F.get(edges, j + 1)
            run = F.transform(F.slice(parts, first + 2, end - first - 1), lambda p: F.coalesce(p["text"], F.lit("")))
            return F.concat(escape(F.array_join(run, "")), F.when(end < F.size(parts), placeholder(F.get(parts, end))).otherwise(""))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(edges) - 2), piece), "")

    return F.get(F.transform(F.array(edges), of), F.lit(0))


def format_chat(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, parts -> conv_id, n_turns, formatted, spans of turns and of loss, attachments, attachment_tokens."""
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    # The one shuffle moves the parts; what is made of them is made after it.
    rows = messages.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), parts.alias("parts")).repartition("conv_id")
    rows = rows.select("conv_id", "turn", "role", F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], F.lit(""))), "").alias("raw"), F.concat(F.lit(START), encode_role(F.col("role")), F.lit("\n")).alias("head"), visit(F.col("parts")).alias("body"),
        F.transform(F.filter("parts", lambda p: ~p["type"].eqNullSafe("text")), lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), part_tokens(p).alias("tokens"))).alias("attached"))
    rows = rows.withColumn("chunk", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "raw", "chunk")
    placed = rows.withColumn("seq", F.row_number().over(order)).withColumn("start", F.sum(F.length("chunk").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("chunk"))
    body = F.struct((F.col("start") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    turn = F.struct("seq", "chunk", F.col("start"), F.when(F.col("role") == "assistant", body).alias("loss"), "attached")
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    attachments = F.flatten(F.transform("turns", lambda t: F.transform(t["attached"], lambda a: F.struct(t["seq"].alias("turn"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return whole.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["chunk"]), "").alias("formatted"), F.transform("turns", lambda t: t["start"]).alias("turn_starts"),
        F.transform("turns", lambda t: t["loss"]).alias("loss"), attachments.alias("attachments"), F.aggregate(attachments, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The digests of what the formatted text says: turns by its markers, loss text by the mask."""
    turns = F.slice(F.split("formatted", r"<\|im_end\|>\n"), 1, F.greatest(F.size(F.split("formatted", r"<\|im_end\|>\n")) - 1, F.lit(0)))
    head = F.lit(len(START) + 1)
    cut = formatted.withColumn("pieces", turns)
    said = F.transform("pieces", lambda p: F.concat(decode_role(F.substring_index(F.substr(p, head), "\n", 1)), F.lit("\n"), unescape(F.regexp_replace(F.substr(p, head), r"\A[^\n]*\n", "")), F.lit("\n")))
    # Each mask span lies in its own turn, so it is read from that turn's piece; the whole text is passed once.
    masked = F.transform("pieces", lambda p, i: F.when(F.get("loss", i).isNotNull(), unescape(F.substr(p, (F.get("loss", i)["start"] - F.get("turn_starts", i) + 1).cast("int"), F.get("loss", i)["length"].cast("int")))).otherwise(""))
    loss = cut.select("conv_id", F.size("pieces").cast("long").alias("n_turns"), F.array_join(said, "").alias("said"), F.array_join(masked, "").alias("masked"), F.length("formatted").cast("long").alias("formatted_chars"), "attachment_tokens")
    return loss.select("conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"), F.length("masked").cast("long").alias("loss_chars"), F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "attachment_tokens")
