"""MinHash near-dedup (operator 1): ProbMinHash, banding, verification, classes.

1. One pass over the texts gives each document a key of its word sequence and
   a ProbMinHash signature of its weighted five-word shingles. A shingle that
   occurs tf times weighs 1 + ln(tf). Every shingle is a Poisson process whose
   rate is its weight; arrivals go to random registers, the earliest arrival
   of a register names its shingle, and a shingle stops once its next arrival
   is later than all registers of its text (early termination). Two texts
   agree in a register with their probability Jaccard similarity.
2. Documents of equal word sequences collapse to their smallest doc_id, with
   partial aggregation, so thousands of copies cost one signature row.
3. Registers are banded. Two documents that share a bucket are candidates, and
   every candidate is decided by the exact probability Jaccard similarity of
   the whole texts; 0.8 or more links the two. First all members of a bucket
   are compared with its smallest and its largest id, which settles groups of
   copies. What is then still in different classes is compared in full, in
   blocks of BLOCK members, every two of which meet; a class of which a bucket
   holds more than a block only meets the others. A bucket of more than CROWD
   blocks is first split by a prefix filter: similarity of `s` or more means that the shingles
   that two documents share hold at least `s` of the weight of each, so in any
   common order the two prefixes that hold more than 1 - s of the weight meet.
   The order is by frequency, rarest first, so texts that share only a common
   passage part here. Groups that are still larger are compared block by
   block. Nothing is capped or left out, and no pairs are written but links.
4. Classes are the connected components of the links; class_id is the smallest
   doc_id in the class.

A text travels once for each block that it is in, never once for each pair.
Frequencies for the order are counted in CELLS cells, a table of fixed size;
texts that a cell's other shingles make look common are only ordered later.

Cases: a null doc_id is returned with a null class_id and is never compared.
A null, empty or wordless text has no shingles and is a class of its own. A
text of fewer than five words has one shingle of all its words. Rows that
repeat a doc_id are one document. An empty table gives no rows. Only doc_id
and text are read, so other columns cannot clash. A very long text is hashed in
pieces; its shingles, 16 bytes a word, must fit a worker BLOCK times at worst.
Rows that repeat a doc_id with different texts are one document that is linked
if any of its texts is; `keep_one` keeps the row of such an id whose columns
have the smallest hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow, sized, to_bytes
from .words import mix, sequence_keys, shingles, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
#: Texts are handled in groups of about so many bytes.
GROUP_BYTES = 1 << 19
#: Documents compared with each other in one block, and partners of one centre in a group.
BLOCK, STAR = 128, 512
#: A bucket of more blocks than this is split by the prefix filter before it is compared.
CROWD = 16
#: Cells of the frequency table of the prefix filter.
CELLS = 1 << 16
#: Parts that the copies of one word sequence are dealt to when they meet their smallest id.
SALTS = 16


def weights(tf: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(tf)


def prob_minhash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n, m): of each register, the element whose exponential arrival is earliest."""
    earliest, name = np.full(n * m, np.inf), np.zeros(n * m, dtype=np.uint64)
    seed, rate, base, when = mix(element + np.uint64(0x632BE59BD9B4E019)), 1.0 / weight, owner * m, np.zeros(len(element))
    live, turn = np.arange(len(element)), 0
    while len(live):
        turn += 1
        u = mix(seed[live] + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        when[live] -= np.log1p(-(u >> np.uint64(11)).astype(np.float64) * 2.0**-53) * rate[live]
        slot = base[live] + (mix(u ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(earliest, slot, when[live])
        won = when[live] == earliest[slot]
        name[slot[won]] = element[live[won]]
        last = earliest.reshape(n, m).max(axis=1)
        live = live[when[live] < last[owner[live]]]
    return name.reshape(n, m)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows][:, :bands] + np.uint64(r + 1))
    return mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)).view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact: the sum over shared i of 1 / sum_j max(x_j / x_i, y_j / y_i). Sides are (sorted elements, weights)."""
    both, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1][at], b[1][bt]
    ratio = x / y
    if ratio.min() == ratio.max() == 1.0:  # equal weights: what is shared over the larger of each
        return float(np.sum(x) / (a[1].sum() + b[1].sum() - x.sum()))
    # For shared i, j counts x_j / x_i where x_j / y_j >= x_i / y_i and y_j / y_i elsewhere: prefix sums by ratio.
    order = np.argsort(ratio)
    xs, ys = x[order], y[order]
    above = np.cumsum(xs[::-1])[::-1]
    below = np.concatenate([[0.0], np.cumsum(ys)[:-1]])
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    return float(np.sum(1.0 / ((above + only_a) / xs + (below + only_b) / ys)))


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, n: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, the two keys of the word sequence, and the band keys (none for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), to_bytes(batch.column(1)))
            for group in sized(pairs, lambda p: len(p[1]) + 64, GROUP_BYTES):
                hashes, offsets = word_hashes([t for _, t in group])
                k1, k2 = sequence_keys(hashes, offsets)
                owner, element, tf = shingles(hashes, offsets, n)
                keys = band_keys(prob_minhash(owner, element, weights(tf), len(group), bands * rows), bands, rows)
                some = np.diff(offsets) > 0
                flat = pa.array(keys[some].reshape(-1))
                ends = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in group], pa.int64()), pa.array(k1), pa.array(k2), pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "k1", "k2", "bands"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null"), run, "doc_id long, k1 long, k2 long, bands array<long>")


class Block:
    """The documents that a group holds so far, as one index of shingles."""

    def __init__(self):
        self.element, self.weight, self.owner, self.size = np.empty(1 << 12, np.uint64), np.empty(1 << 12), np.empty(1 << 12, np.int64), 0
        self.docs, self.comps, self.starts, self.totals, self.root = [], [], [0], [], {}

    def find(self, comp: int) -> int:
        while (up := self.root.get(comp, comp)) != comp:
            comp = up
        return comp

    def add(self, doc: int, comp: int, element: np.ndarray, weight: np.ndarray) -> None:
        end = self.size + len(element)
        while end > len(self.element):
            self.element, self.weight, self.owner = (np.concatenate([x, np.empty_like(x)]) for x in (self.element, self.weight, self.owner))
        self.element[self.size : end], self.weight[self.size : end], self.owner[self.size : end] = element, weight, len(self.docs)
        self.size = end
        self.docs.append(doc), self.comps.append(comp), self.starts.append(end), self.totals.append(float(weight.sum()))

    def links(self, doc: int, comp: int, element: np.ndarray, weight: np.ndarray, similarity: float) -> list[int]:
        """The held documents of other classes that doc is similar enough to; their classes become one."""
        own = self.find(comp)
        if not len(element) or all(self.find(c) == own for c in self.comps):
            return []
        held = self.element[: self.size]
        at = np.searchsorted(element, held)
        at[at == len(element)] = 0
        hit = np.flatnonzero(element[at] == held)
        of = self.owner[hit]
        # The weight that is shared is a bound of the similarity, on both sides.
        theirs = np.bincount(of, self.weight[hit], len(self.docs)) / np.array(self.totals)
        mine = np.bincount(of, weight[at[hit]], len(self.docs)) / weight.sum()
        out = []
        for j in np.flatnonzero(np.minimum(theirs, mine) >= similarity - 1e-9).tolist():
            if self.docs[j] != doc and self.find(self.comps[j]) != self.find(comp):
                part = slice(self.starts[j], self.starts[j + 1])
                if probability_jaccard((element, weight), (self.element[part], self.weight[part])) >= similarity:
                    out.append(self.docs[j])
                    self.root[self.find(self.comps[j])] = self.find(comp)
        return out


def sets_of(texts: list[bytes], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted shingles and their weights, of each text."""
    owner, element, tf = shingles(*word_hashes(texts), n)
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    weight = weights(tf)
    for a, b in zip(edges[:-1], edges[1:]):
        yield element[a:b], weight[a:b]


def compared(groups: DataFrame, texts: DataFrame, similarity: float, n: int = SHINGLE_WORDS) -> DataFrame:
    """groups (g, kind, doc_id, comp) -> the links (a, b) that are found in each group.

    Kind 0 is held; kind 1 is compared with what is held; kind 2 is compared and
    then held. Only documents of different comp are compared. A group holds at
    most BLOCK documents, the others pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block = None, Block()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(4)), to_bytes(batch.column(4)))
            a, b = [], []
            for part in sized(rows, lambda r: len(r[4]) + 64, GROUP_BYTES):
                for (g, kind, doc, comp, _), (element, weight) in zip(part, sets_of([r[4] for r in part], n)):
                    if g != group:
                        group, block = g, Block()
                    if kind:
                        found = block.links(doc, comp, element, weight, similarity)
                        a += [doc] * len(found)
                        b += found
                    if kind != 1:
                        block.add(doc, comp, element, weight)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # Merge joins at every size: what moves then grows as the input does, and nothing is broadcast.
    rows = groups.join(texts.hint("merge"), "doc_id").select("g", "kind", "doc_id", "comp", "text")
    # The work of a group is not in proportion to its bytes, so partitions must not be put together by size.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(rows.repartition(parts, "g").sortWithinPartitions("g", "kind", "doc_id"), run, "a long, b long").distinct()


def prefixes(docs: DataFrame, similarity: float, n: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, s: of each text, the rarest shingles that hold more than 1 - similarity of its weight."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in sized(to_bytes(batch.column(1)), lambda t: len(t) + 64, GROUP_BYTES):
                total += np.bincount((shingles(*word_hashes(part), n)[1] % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        some = np.flatnonzero(total)
        for at in range(0, len(some), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(some[at : at + 4096]), pa.array(total[some[at : at + 4096]])], ["cell", "n"])

    often = np.zeros(CELLS, np.int64)
    for cell, n_ in map_arrow(docs.select("doc_id", "text"), count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # CELLS rows at most
        often[cell] = n_
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), to_bytes(batch.column(1)))
            for part in sized(rows, lambda r: len(r[1]) + 64, GROUP_BYTES):
                ids, found = [], []
                for (doc, _), (element, weight) in zip(part, sets_of([t for _, t in part], n)):
                    order = np.lexsort((element, shared.value[(element % np.uint64(CELLS)).astype(np.int64)]))
                    mass = np.cumsum(weight[order])
                    stop = int(np.searchsorted(mass, (1 - similarity + 1e-9) * weight.sum(), side="right")) + 1
                    found.append(element[order[:stop]].view(np.int64))
                    ids += [doc] * len(found[-1])
                out = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate(found or [np.zeros(0, np.int64)]))], ["doc_id", "s"])
                yield from (out.slice(i, 8192) for i in range(0, len(ids), 8192))

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, s long")


def undecided(rows: DataFrame, key: str, block: int = BLOCK) -> DataFrame:
    """rows (key, doc_id, comp) -> those of keys with several classes; of keys with the same members, one.

    n members of a key are to meet one another; `many` others, members of the
    class `top`, are to meet those n only. A class stands apart so if it has more than `block` members.
    """
    by = rows.groupBy(key, "comp").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.bit_xor(F.xxhash64("doc_id")).alias("mark"))
    sizes = by.groupBy(key).agg(
        F.sum("n").alias("n"), F.count("*").alias("classes"), F.max_by("comp", F.struct("n", "comp")).alias("top"), F.max("n").alias("many"), F.min("low").alias("low"), F.max("high").alias("high"), F.bit_xor("mark").alias("mark")
    ).where("classes > 1")
    one = sizes.groupBy("n", "classes", "top", "many", "low", "high", "mark").agg(F.min(key).alias(key))
    many = F.when(F.col("many") > block, F.col("many")).otherwise(F.lit(0))
    one = one.select(key, "top", many.alias("many"), (F.col("n") - many).alias("n"))
    return rows.join(one.hint("merge"), key)


def blocks(rows: DataFrame, key: str, block: int = BLOCK) -> DataFrame:
    """What `undecided` gives -> groups in which every two members that are to meet do, at most `block` held in each."""
    apart = (F.col("many") > 0) & (F.col("comp") == F.col("top"))
    m, parts = F.ceil(F.col("n") / block).cast("int"), F.ceil(F.col("many") / STAR).cast("int")
    dealt = rows.select(key, "doc_id", "comp", m.alias("m"), parts.alias("parts"), F.pmod(F.xxhash64("doc_id", key), m).cast("int").alias("i"), apart.alias("apart"))
    # Members of a block meet each other, and members of every other block.
    few = dealt.where("not apart").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    kind = F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1)
    few = few.select(F.xxhash64(key, F.least("i", "j"), F.greatest("i", "j")).alias("g"), kind.alias("kind"), "doc_id", "comp")
    # Each part of the large class meets each block.
    held = dealt.where("not apart and parts > 0").withColumn("section", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = held.select(F.xxhash64(key, F.lit(-1), "i", "section").alias("g"), F.lit(0).alias("kind"), "doc_id", "comp")
    large = dealt.where("apart").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).withColumn("section", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    large = large.select(F.xxhash64(key, F.lit(-1), "j", "section").alias("g"), F.lit(1).alias("kind"), "doc_id", "comp")
    return few.unionByName(held).unionByName(large)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): of each node of the edges, the smallest node that it is connected with.

    Each pass takes the smallest label among the neighbours and then the label
    of that label; stars settle in two passes and paths in a logarithmic
    number. The driver sees counts only.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    labels = cut(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("comp")))
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "comp"), "other").groupBy("node").agg(F.min("comp").alias("near"))
        stepped = labels.join(near, "node", "left").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = cut(stepped.join(jump, "comp", "left").select("node", "was", F.least("comp", F.coalesce("far", "comp")).alias("comp")))
        changed = new.where("was <> comp").limit(1).count()
        labels = new.select("node", "comp")
        if not changed:
            return labels


def joined_classes(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, comp) after further links (a, b): only the classes that these touch are walked."""
    ends = links.select("a", "b")
    for side in ("a", "b"):
        ends = ends.join(labels.select(F.col("node").alias(side), F.col("comp").alias(f"of_{side}")).hint("merge"), side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    ends = cut(ends)
    nodes = labels.unionByName(ends.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("of_a").alias("comp")), F.struct(F.col("b").alias("node"), F.col("of_b").alias("comp")))).alias("x")).select("x.node", "x.comp")).distinct()
    moved = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).where("a <> b").distinct())
    return cut(nodes.join(moved.select(F.col("node").alias("comp"), F.col("comp").alias("to")).hint("merge"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, n: int = SHINGLE_WORDS, block: int = BLOCK, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its class), exact_id (the smallest of equal word sequences)."""
    made = cut(sketch(docs, bands, rows, n))
    worded = made.where(F.size("bands") > 0)
    # Copies meet their smallest id in SALTS parts, so that a sequence of a third of all rows isn't one task's.
    exact = worded.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("k1", "k2", "rep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = worded.select("doc_id", "k1", "k2", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    members = cut(salted.join(exact.hint("merge"), ["k1", "k2", "salt"], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep")).distinct())
    reps = worded.join(members.where("doc_id = rep").select("doc_id").hint("merge"), "doc_id", "left_semi")
    rows_ = reps.select("doc_id", F.explode("bands").alias("bucket")).distinct()
    shared = rows_.groupBy("bucket").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.bit_xor(F.xxhash64("doc_id")).alias("mark")).where("n > 1")
    # Of buckets with the same members, one is enough.
    shared = shared.groupBy("n", "low", "high", "mark").agg(F.min("bucket").alias("bucket")).select("bucket", "n", "low", "high")
    buckets = cut(rows_.join(shared.hint("merge"), "bucket").select("bucket", "doc_id", "n", "low", "high"))
    texts = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(buckets.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"))
    # Stars: each member with the smallest and the largest of its bucket, about STAR partners a group.
    pairs = buckets.select(F.col("doc_id").alias("a"), F.explode(F.array_distinct(F.array("low", "high"))).alias("b"), "n").where("a <> b").groupBy("a", "b").agg(F.max("n").alias("n"))
    pairs = cut(pairs.select("a", "b", F.xxhash64("b", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / STAR))).alias("g")))
    centres = pairs.select("g", F.lit(0).alias("kind"), F.col("b").alias("doc_id"), F.col("b").alias("comp")).distinct()
    links = cut(compared(centres.unionByName(pairs.select("g", F.lit(1).alias("kind"), F.col("a").alias("doc_id"), F.col("a").alias("comp"))), texts, similarity, n))
    labels = components(links)
    # The two centres of a bucket are decided; the other members of different classes are not.
    placed = buckets.where("n > 3 and doc_id not in (low, high)").select("bucket", "doc_id").join(labels.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("comp", "doc_id").alias("comp"))
    apart = cut(undecided(placed, "bucket", block))
    if apart.limit(1).count():
        groups = blocks(apart.where(F.col("n") <= crowd * block), "bucket", block)
        crowded = apart.where(F.col("n") > crowd * block)
        if crowded.limit(1).count():
            rare = prefixes(texts.join(crowded.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"), similarity, n)
            parts = crowded.select("bucket", "doc_id", "comp").join(rare.hint("merge"), "doc_id").select(F.xxhash64("bucket", "s").alias("part"), "doc_id", "comp").distinct()
            groups = groups.unionByName(blocks(undecided(cut(parts), "part", block), "part", block))
        more = cut(compared(groups, texts, similarity, n))
        if more.limit(1).count():
            labels = joined_classes(labels, more)
    named = members.join(labels.withColumnRenamed("node", "rep").hint("merge"), "rep", "left").select("doc_id", F.coalesce("comp", "rep").alias("class_id"), F.col("rep").alias("exact_id"))
    # Rows that share a doc_id but not a text are one document: it takes the smallest class.
    named = named.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.min("exact_id").alias("exact_id"))
    alone = made.where(F.size("bands") == 0).select("doc_id").distinct().join(named, "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("exact_id"))
    nulls = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("exact_id"))
    return named.unionByName(alone).unionByName(nulls)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents of which doc_id is their class's smallest; rows with a null doc_id stay. Columns are unchanged.

    Of rows that share a doc_id, the one with the smallest hash of its columns stays.
    """
    names = docs.columns
    mark = next(f"__row{i}" for i in range(len(names) + 1) if f"__row{i}" not in names)
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    rows = docs.where("doc_id is not null").withColumn(mark, F.xxhash64(*[docs[c] for c in hashed]))
    chosen = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(mark).alias(mark))
    kept = classes(docs.select("doc_id", "text"), **options).where("doc_id = class_id").select("doc_id").join(chosen.hint("merge"), "doc_id")
    # Rows that are left twice under one hash are equal.
    rows = rows.join(kept.hint("merge"), ["doc_id", mark], "left_semi").dropDuplicates(["doc_id", mark])
    return rows.select(*names).unionByName(docs.where("doc_id is null"))
