"""Filter interaction audit: what each of five filters removes, in every order, from one pass over the texts.

Each document has a mask of the filters that it fails. Per part and label 32
signed parity sums of the masks are aggregated (a Walsh-Hadamard transform);
their inverse gives the exact number of documents of each mask. All orders,
and the Shapley totals, follow from those 32 numbers.

Cases: a null text is empty, a null lang is the part ''. Every row counts,
repeated ones too; rows of one doc_id with one text fail E together or not at
all, and a row without doc_id neither fails E nor makes others fail. A document
has a label if any of its rows in `labels` has it; rows without doc_id have
none. Texts are compared by SHA-256, whole, at any length; a text without words
has no share of distinct words and passes B. Empty tables give no rows. Other
columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The filters, a bit each: A is 1, E is 16.
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MASKS = 1 << len(FILTERS)
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"
#: Rows without doc_id are spread over so many keys of the join with the labels.
SPREAD = 1024


def text_failures(text: Column) -> Column:
    """The bits A to D of a text that is not null."""

    def of(words: Column) -> Column:
        n = F.size(words)
        few = F.when(n < MIN_WORDS, 1).otherwise(0)
        same = F.when(F.size(F.array_distinct(words)) * 100 < n * MIN_DISTINCT_PERCENT, 2).otherwise(0)
        return few + same

    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    by_words = F.get(F.transform(F.array(words), of), F.lit(0))
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100
    loud = F.when(capitals > F.length(text).cast("long") * MAX_CAPITAL_PERCENT, 4).otherwise(0)
    return by_words + loud + F.when(text.rlike(SYMBOLS), 8).otherwise(0)


def _sign(a: Column, b: Column) -> Column:
    """1 if a and b share an even number of bits, else -1."""
    return (F.lit(1) - F.bit_count(a.bitwiseAND(b)) % 2 * 2).cast("long")


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, good, toxic, mask, n: documents by mask and label, one row a text and label at least.

    Copies are counted by (doc_id, text) and then by text before a text's first
    doc_id is looked for, so a text that a third of all rows share is a few rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("__text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("__text", 256)).alias("digest"), text_failures(F.col("__text")).alias("mask"))
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))

    said = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SPREAD))).otherwise(0)
    rows = rows.withColumn("__at", spread).join(said.withColumn("__at", F.lit(0).cast("long")), ["doc_id", "__at"], "left")

    named = F.col("doc_id").isNotNull()
    cell = ["digest", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    cells = rows.groupBy(*cell).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("least"),
    )
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    cells = cells.withColumn("first", first)
    passed = F.col("nameless") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), passed.alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - passed).alias("n")),
    )
    return cells.select("part", "good", "toxic", F.explode(both).alias("c")).select("part", "good", "toxic", "c.mask", "c.n").where("n > 0")


def parity_sums(found: DataFrame) -> DataFrame:
    """part, good, toxic, sums: for each set of filters, documents that fail an even number of them less the others."""
    sums = [F.sum(_sign(F.col("mask"), F.lit(s)) * F.col("n")) for s in range(MASKS)]
    return found.groupBy("part", "good", "toxic").agg(F.array(*sums).alias("sums"))


def cells(parity: DataFrame) -> DataFrame:
    """part, n, good, toxic: arrays of the documents of each mask, by the inverse transform of the summed parities."""
    every = F.sequence(F.lit(0), F.lit(MASKS - 1))

    def summed(which: Column) -> Column:
        return F.array(*[F.sum(F.when(which, F.get("sums", F.lit(s))).otherwise(0)) for s in range(MASKS)])

    def inverse(of: str) -> Column:
        def count(mask: Column) -> Column:
            total = F.aggregate(every, F.lit(0).cast("long"), lambda had, s: had + _sign(mask, s) * F.get(of, s))
            return F.shiftright(total, 5)  # a multiple of 32, and not negative

        return F.transform(every, count).alias(of)

    by_part = parity.groupBy("part").agg(
        summed(F.lit(True)).alias("n"), summed(F.col("good")).alias("good"), summed(F.col("toxic")).alias("toxic")
    )
    return by_part.select("part", inverse("n"), inverse("good"), inverse("toxic"))


def orders(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from the documents of each mask."""
    rows = counts.select("*", F.explode(F.split(F.lit(" ".join(ORDERS)), " ")).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    place = {x: F.instr("filter_order", x) for x in FILTERS}
    bits = {x: 1 << i for i, x in enumerate(FILTERS)}
    before = sum((F.when(place[x] < F.col("step"), b).otherwise(0) for x, b in bits.items()), F.lit(0))
    own = sum((F.when(place[x] == F.col("step"), b).otherwise(0) for x, b in bits.items()), F.lit(0))
    rows = rows.withColumn("before", before).withColumn("own", own)

    def total(of: str, which, times=lambda m: 1) -> Column:
        def add(had: Column, m: Column) -> Column:
            return had + F.when(which(m), F.get(of, m) * times(m)).otherwise(0)

        return F.aggregate(F.sequence(F.lit(0), F.lit(MASKS - 1)), F.lit(0).cast("long"), add)

    def fails(m: Column) -> Column:
        return m.bitwiseAND(F.col("own")) != 0

    def gone(m: Column) -> Column:
        return m.bitwiseAND(F.col("before")) != 0

    def here(m: Column) -> Column:
        return fails(m) & ~gone(m)

    def share(m: Column) -> Column:
        # Of 120 orders, a filter comes first among k failed ones in 120 / k.
        k = F.bit_count(m)
        return F.when(k == 1, 120).when(k == 2, 60).when(k == 3, 40).when(k == 4, 30).otherwise(24)

    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        total("n", fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return orders(cells(parity_sums(masks(docs, labels))))
