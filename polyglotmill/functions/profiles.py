"""Language by ranked n-gram profiles: the out-of-place distance of a text's most frequent grams to those of each language.

Words are runs of letters (A to Z in either case, and all characters beyond
ASCII) with a mark at both ends; grams have one to three characters. A profile
holds the SIZE most frequent grams by rank, ties by the gram. A text's distance
to a language is the sum over its grams of how far the ranks lie apart, SIZE
for a gram that the language's profile lacks.

Cases: a null text, and one without letters, has no grams and no language; a
text none of whose grams is in a profile has none either. Rows of a null
language are not learned from. Equal distances go by the language's name.
Repeated rows are judged each by itself. Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIZE = 300
MARK = b"_"
#: Lower-cases A-Z and turns every ASCII byte that is no letter into a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: A task hands on its counts when it holds so many grams.
_HELD = 200_000


def grams(text: str | None) -> Counter:
    """The grams of a text with their counts; each distinct word is cut once."""
    out: Counter = Counter()
    for word, n in Counter((text or "").encode().translate(_LETTERS).split()).items():
        marked = (MARK + word + MARK).decode()
        for x in marked[1:-1]:
            out[x] += n
        for size in (2, 3):
            for i in range(len(marked) - size + 1):
                out[marked[i : i + size]] += n
    return out


def learn(docs: DataFrame, text: str, lang: str, size: int = SIZE) -> DataFrame:
    """lang, gram, rank: the profile of each language, from the counts of all its texts."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(k, g, n) for k, c in held.items() for g, n in c.items()], columns=["lang", "gram", "n"])

        for batch in batches:
            for k, x in zip(batch["lang"], batch["text"]):
                held.setdefault(k, Counter()).update(grams(x))
            if sum(map(len, held.values())) > _HELD:
                yield rows()
                held.clear()
        yield rows()

    some = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    found = some.mapInPandas(counted, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return found.withColumn("rank", place).where(F.col("rank") <= size).select("lang", "gram", "rank")


def predict(docs: DataFrame, text: str, learned: DataFrame, size: int = SIZE) -> DataFrame:
    """docs with `found`: the language of the nearest profile. docs is read twice and must be the same both times, as a scan is.

    The join is by gram, with a table of `size` rows a language; a text's rows
    stay together up to the sum, so one row a text and language is shuffled.
    """

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for at, x in zip(batch["__at"], batch["text"]):
                first = sorted(grams(x).items(), key=lambda g: (-g[1], g[0]))[:size]
                parts.append(pd.DataFrame({"__at": at, "gram": [g for g, _ in first], "place": range(1, len(first) + 1)}))
            if parts:
                yield pd.concat(parts).astype({"gram": "str"})

    rows = docs.withColumn("__at", F.monotonically_increasing_id())
    mine = rows.select("__at", F.col(text).alias("text")).where("text is not null").mapInPandas(ranked, "__at long, gram string, place long")
    near = mine.join(learned, "gram").groupBy("__at", "lang").agg(F.sum(F.abs(F.col("place") - F.col("rank")) - size).alias("less"))
    best = near.groupBy("__at").agg(F.min(F.struct("less", "lang")).alias("best"))
    return rows.join(best, "__at", "left").select(*[rows[c] for c in docs.columns], F.col("best.lang").alias("found"))
