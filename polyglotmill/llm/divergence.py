"""Source divergence audit: how far the term shares of sources lie apart, without a row for absent terms.

A group is a source within a language; its kept terms have shares
p = 1 + floor(10^9 (count + 5) / (N + 5 V)). The distance of two groups is the
sum over all V kept terms of the difference of their shares. It is put together
from four parts: terms of one group priced against the other's share of an
absent term, from a histogram of counts; the same the other way round; a
constant for each term that neither has; and a correction for each term that
both have, from a join of the sparse postings.

Cases: null text, lang and source are ''. Every row is a document, repeated ones
too. A group without terms takes part; a language without kept terms has
distances of 0 and no rows of part `term`. Texts are read whole, in pieces.
Ties of a value go by the UTF-8 bytes of the item. Empty tables give no rows.
Other columns are not read. Counts are exact up to 9 * 10^15 a group.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_arrow, sized, to_bytes

MIN_DOCS = 30
SMOOTHING = 5
TOP = 50
#: Lower-cases A-Z and turns every ASCII byte that is no letter into a space.
TERM_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: A task counts and hands on when it holds so many terms, or texts of so many bytes.
HELD_TERMS, HELD_BYTES = 4 << 20, 32 << 20
#: Texts are handled in groups of about so many bytes. Longer ones than PIECE are read in pieces of about that, cut between terms.
GROUP_BYTES, PIECE = 1 << 20, 4 << 20
COUNT_BITS = 22
#: A language's histograms are dealt over so many keys.
SPREAD = 32
_COUNTED = "lang string, source string, term string, n long, docs long"


def _pieces(text: bytes) -> Iterator[bytes]:
    clean, at = text.translate(TERM_TABLE), 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE) if len(clean) - at > PIECE else -1
        end = len(clean) if end < 0 else end
        yield clean[at:end]
        at = end


def _terms(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The terms of the texts, in order, and how many each text has."""
    clean = (b" ".join(texts) + b" ").translate(TERM_TABLE)
    inside = np.zeros(len(clean) + 1, bool)
    np.not_equal(np.frombuffer(clean, np.uint8), 32, out=inside[1:])
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # the last byte is a space, so each term has its end
    starts = edges[::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(edges[1::2] - starts, out=offsets[1:])
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(clean.translate(None, b" "))])
    return found, np.diff(np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts])))


def _rows(keys: list[tuple[str, str]], group: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
    lang, source = (pa.array([k[i] for k in keys], pa.string()) for i in (0, 1))
    for i in range(0, len(n), 10_000):
        part = slice(i, i + 10_000)
        at = pa.array(group[part])
        columns = [lang.take(at), source.take(at), terms.slice(i, 10_000).cast(pa.string()), pa.array(n[part]), pa.array(docs[part])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


class _Held:
    """Terms of whole texts, until they are counted by group."""

    def __init__(self) -> None:
        self.keys: dict[tuple[str, str], int] = {}
        self.terms, self.sizes, self.groups, self.bytes, self.n = [], [], [], 0, 0

    def add(self, keys: list[tuple[str, str]], texts: list[bytes]) -> None:
        found, sizes = _terms(texts)
        self.terms.append(found), self.sizes.append(sizes)
        self.groups.append(np.array([self.keys.setdefault(k, len(self.keys)) for k in keys], np.int64))
        self.bytes, self.n = self.bytes + sum(map(len, texts)) + len(texts), self.n + len(found)

    def counted(self) -> Iterator[pa.RecordBatch]:
        """A row for each term of a group; a text and a term, and then a group and a term, are one number each to sort by."""
        if not self.n:
            return
        coded = pa.concat_arrays(self.terms).dictionary_encode()
        self.terms.clear()
        words, group = len(coded.dictionary), np.concatenate(self.groups)
        key = np.repeat(np.arange(len(group)), np.concatenate(self.sizes))
        key *= words
        key += coded.indices.to_numpy()
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times, key = np.diff(np.append(first, len(key))), key[first]
        # A text has fewer than 2^COUNT_BITS terms.
        key = (group[key // words] * words + key % words << COUNT_BITS) | times
        key.sort()
        times, key = key & (1 << COUNT_BITS) - 1, key >> COUNT_BITS
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n, docs, key = np.add.reduceat(times, first), np.diff(np.append(first, len(key))), key[first]
        yield from _rows(list(self.keys), key // words, coded.dictionary.take(pa.array(key % words)), n, docs)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in batches:
        keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for some in sized(zip(keys, to_bytes(batch.column("text"))), lambda r: len(r[1]) + 64, GROUP_BYTES):
            if len(some[0][1]) > PIECE:  # alone, and counted by itself
                counts: Counter = Counter()
                for piece in _pieces(some[0][1]):
                    counts.update(piece.split())
                ones = np.ones(len(counts), np.int64)
                yield from _rows([some[0][0]], ones - 1, pa.array(list(counts), pa.binary()), np.array(list(counts.values()), np.int64), ones)
                continue
            held.add([k for k, _ in some], [t for _, t in some])
            if held.n > HELD_TERMS or held.bytes > HELD_BYTES:
                yield from held.counted()
                held = _Held()
    yield from held.counted()


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def postings(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, total: the kept terms of each group; total is the term's count in its language."""
    found = map_arrow(_plain(docs), _count, _COUNTED)
    # Tasks have counted already: rows travel once, by what both the sums and the window below need.
    found = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    found = found.withColumn("total", F.sum("n").over(same)).withColumn("docs", F.sum("docs").over(same))
    return found.where(F.col("docs") >= min_docs).drop("docs")


def share(count: str, size: str) -> Column:
    """1 + floor(10^9 (count + 5) / size) by long division in base 1,000, so that no product leaves 64 bits."""
    rest, out = f"({count} + {SMOOTHING})", "1"
    for weight in (1_000_000, 1_000, 1):
        out += f" + ({rest} * 1000) div {size} * {weight}"
        rest = f"(({rest} * 1000) % {size})"
    return F.expr(out)


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, k (its kept terms), v (those of the language), size and zero (share of an absent term), lang_size."""
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    by_lang = kept.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    every = _plain(docs).select("lang", "source").distinct().join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    every = every.na.fill(0, ["n", "k", "v", "lang_n"])
    size = F.col("n") + SMOOTHING * F.col("v")
    every = every.withColumn("size", size).withColumn("lang_size", F.col("lang_n") + SMOOTHING * F.col("v"))
    zero = F.when(F.col("v") > 0, share("0L", "if(v > 0, size, 1L)")).otherwise(0)
    return every.select("lang", "source", "k", "v", "size", "lang_size", zero.alias("zero"))


def _side(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    return df.select("lang", *[F.col(c).alias(f"{c}_{name}") for c in columns])


def distances(posted: DataFrame, group: DataFrame) -> DataFrame:
    """lang, a, b, value for a < b."""
    one, two = (_side(group, x, ["source", "k", "zero"]) for x in "ab")
    both = one.join(two.join(group.groupBy("lang").agg(F.max("v").alias("v")), "lang"), "lang").where("source_a < source_b")
    absent = both.select(
        "lang", F.col("source_a").alias("a"), F.col("source_b").alias("b"),
        ((F.col("v") - F.col("k_a") - F.col("k_b")) * F.abs(F.col("zero_a") - F.col("zero_b"))).alias("value"),
    )

    # A histogram row meets every other group of its language; rows of one language are dealt by their count.
    counted = posted.groupBy("lang", "source", "n").agg(F.count("*").alias("terms"), F.first("p").alias("p"))
    counted = counted.withColumn("at", F.pmod(F.col("n"), F.lit(SPREAD)))
    other = _side(group, "b", ["source", "zero"]).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    priced = counted.join(other, ["lang", "at"]).where("source <> source_b").select(
        "lang", F.least("source", "source_b").alias("a"), F.greatest("source", "source_b").alias("b"),
        (F.col("terms") * F.abs(F.col("p") - F.col("zero_b"))).alias("value"),
    )

    columns = ["source", "term", "p", "zero"]
    shared = _side(posted, "a", columns).withColumnRenamed("term_a", "term")
    shared = shared.join(_side(posted, "b", columns).withColumnRenamed("term_b", "term"), ["lang", "term"]).where("source_a < source_b")
    overlap = shared.select(
        "lang", F.col("source_a").alias("a"), F.col("source_b").alias("b"),
        (F.abs(F.col("p_a") - F.col("p_b")) - F.abs(F.col("p_a") - F.col("zero_b"))
         - F.abs(F.col("p_b") - F.col("zero_a")) + F.abs(F.col("zero_a") - F.col("zero_b"))).alias("value"),
    )
    # Summed on their own: the joins' rows shrink to one a pair and task before they are shuffled.
    parts = [x.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")) for x in (priced, overlap)]
    return absent.unionByName(parts[0]).unionByName(parts[1]).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources, and the terms that a group has most too many of."""
    kept = cut(postings(docs, min_docs))
    group = cut(groups(docs, kept))
    posted = kept.join(group, ["lang", "source"]).withColumn("p", share("n", "size"))

    apart = distances(posted, group)
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = apart.select("lang", F.explode(ways).alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    more = posted.withColumn("value", F.col("p") - share("total", "lang_size")).where("value > 0")
    terms = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
