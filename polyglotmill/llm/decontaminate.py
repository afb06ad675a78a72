"""Benchmark decontamination (operator 5): a generalised suffix automaton of the test items.

The items, normalised to words, form one automaton. A document's words stream
through it while it tracks the longest suffix read that occurs in an item. A
window is `window` consecutive words of an item, or a whole shorter item.
Where the tracked length reaches a window, the words of that window are hit,
and the items of the window are read from the automaton's state. Maximal hit
spans of at least `span_limit` words are cut out of the text; a document whose
hit words exceed `coverage_limit` of its words is dropped.

Only stretches in which every neighbouring pair of words occurs in the items
(a bit table of hashed pairs) enter the automaton; any match lies in one.

The items are broadcast as automata of about MAX_ITEM_WORDS words each, so the
broadcast has a fixed bound: a longer item goes in pieces that overlap by a
window but one word. A larger benchmark takes several passes over the
documents, one after another, so a worker holds one automaton at a time; each
but the last writes its hits (spans, not texts), which the last one unites with
its own. Nothing is dropped.

Cases: null text or a text without words has no hits. Null or wordless items
have no windows. Equal items count under each of their ids; items with a null
id hit words but are not listed. An empty benchmark hits nothing; empty
documents give no rows. Rows that repeat are judged alike. Only doc_id and text
are read by `scan`; `clean` carries all columns, whatever their names. A very
long text is one row in memory, with its words.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, map_arrow, to_bytes
from .words import WORD_TABLE, split_words

WINDOW = 10
SPAN_LIMIT = 10
#: Shorter spans consist of whole short items; those of so many words are cut too, so that no common word or two is.
ITEM_LIMIT = 3
COVERAGE_LIMIT = 0.5
#: Words of test items in one automaton; a bound on what is broadcast at once.
MAX_ITEM_WORDS = 400_000
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Automaton:
    """Generalised suffix automaton over word ids, with the windows of the items marked on its states."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window, self.ids = window, {}
        self.length, self.link, self.next = [0], [-1], [{}]
        self.at_window: dict[int, set] = {}
        self.at_short: dict[int, list] = {}
        self._known: dict[int, list] = {}
        coded = [(name, [self.ids.setdefault(w, len(self.ids) + 1) for w in words]) for name, words in items if words]
        for _, word_ids in coded:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
        self.least = min([window, *(len(w) for _, w in coded)])
        self.pairs = np.zeros(1 << 20, dtype=bool)
        for name, word_ids in coded:
            if len(word_ids) > 1:
                x = np.array(word_ids, dtype=np.int64)
                self.pairs[self.pair(x[:-1], x[1:])] = True
            state = 0
            for i, w in enumerate(word_ids):
                state = self.next[state][w]
                # The state reached is of the longest prefix read; the window's state is an ancestor.
                n = min(window, len(word_ids))
                if i + 1 >= n:
                    of = self.ancestor(state, n)
                    if len(word_ids) < window:
                        self.at_short.setdefault(of, []).append((n, name))
                    else:
                        self.at_window.setdefault(of, set()).add(name)

    @staticmethod
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 0x9E3779B1 + b * 0x85EBCA77 >> 7) & ((1 << 20) - 1)

    def ancestor(self, state: int, n: int) -> int:
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _new(self, length: int, link: int, moves: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _extend(self, last: int, w: int) -> int:
        have = self.next[last].get(w)
        if have is not None:
            return have if self.length[have] == self.length[last] + 1 else self._split(last, w, have)
        new, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _shorts(self, state: int) -> list:
        """Short items that are suffixes of the state's longest word sequence."""
        found = self._known.get(state)
        if found is None:
            found, s = [], state
            while s > 0:
                found += self.at_short.get(s, [])
                s = self.link[s]
            self._known[state] = found
        return found

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """Which words are hit (None: none), and the items with occurring windows."""
        n, items, hit = len(words), set(), None
        if n < self.least or not self.ids:
            return None, items
        get = self.ids.get
        code = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=n)
        if self.least > 1:
            good = (code[:-1] > 0) & (code[1:] > 0)
            at = np.flatnonzero(good)
            good[at] = self.pairs[self.pair(code[at], code[at + 1])]
        else:
            good = code > 0
        edge = np.diff(np.concatenate([[0], good.view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + (self.least > 1)
        long = end - begin >= self.least
        for a, b in zip(begin[long].tolist(), end[long].tolist()):
            state, size = 0, 0
            for i in range(a, b):
                w = int(code[i])
                while state and w not in self.next[state]:
                    state = self.link[state]
                    size = self.length[state]
                if w in self.next[state]:
                    state, size = self.next[state][w], size + 1
                if size >= self.least:
                    found = []
                    if size >= self.window and (owners := self.at_window.get(self.ancestor(state, self.window))):
                        found.append((self.window, owners))
                    found += [(k, (name,)) for k, name in self._shorts(state) if k <= size] if self.at_short else []
                    for k, owners in found:
                        hit = np.zeros(n, dtype=bool) if hit is None else hit
                        hit[i + 1 - k : i + 1] = True
                        items.update(owners)
        return hit, items


#: Buckets in which the words of items are summed up, so that no task sees them all.
_BUCKETS = 64


def item_pieces(benchmark: DataFrame, window: int, most: int) -> DataFrame:
    """item, words (joined by spaces), n, chunk: the items in pieces of at most `most` words, numbered in chunks of about as many."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.filter(F.split(F.col("text").cast("string"), r"[^0-9A-Za-z\x{80}-\x{10ffff}]+"), lambda w: w != "").alias("words")).where(F.size("words") > 0)
    step = max(1, most - window + 1)
    starts = F.when(F.size("words") <= most, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size("words") - window, F.lit(step)))
    pieces = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, F.lit(most)))).alias("words"))
    pieces = pieces.select("item", F.array_join("words", " ").alias("words"), F.size("words").cast("long").alias("n"), F.xxhash64("item", F.array_join("words", " ")).alias("key"))
    pieces = cut(pieces.withColumn("bucket", F.pmod("key", F.lit(_BUCKETS)).cast("int")))
    before = pieces.groupBy("bucket").agg(F.sum("n").alias("sum")).withColumn("before", F.sum("sum").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("sum"))
    inner = F.sum("n").over(Window.partitionBy("bucket").orderBy("key", "item", "words").rowsBetween(Window.unboundedPreceding, 0))
    numbered = pieces.withColumn("inner", inner).join(F.broadcast(before.select("bucket", "before")), "bucket")  # _BUCKETS rows
    return cut(numbered.select("item", "words", F.floor((F.col("before") + F.col("inner") - 1) / most).alias("chunk")))


def automata(benchmark: DataFrame, window: int = WINDOW, most: int = MAX_ITEM_WORDS) -> list:
    """Broadcast variables, one for each chunk of the benchmark; one without items if there are none."""
    pieces = item_pieces(benchmark, window, max(most, window))
    top = pieces.agg(F.max("chunk")).first()[0]
    out = []
    for k in range(int(top if top is not None else 0) + 1):
        items = [(r[0], split_words(r[1].encode())) for r in pieces.where(F.col("chunk") == k).select("item", "words").toLocalIterator()]
        if items or not out:
            out.append(benchmark.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items)))
    return out


_BUILT: dict[str, Automaton] = {}


def _automaton(broadcast, window: int) -> Automaton:
    """Built once in each Python worker; the latest only is kept."""
    name, items = broadcast.value
    if (key := f"{name}:{window}") not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(items, window)
    return _BUILT[key]


def spans_of(hit: np.ndarray | None) -> list[tuple[int, int]]:
    if hit is None:
        return []
    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


_HITS = "text_sha256 binary, spans array<struct<first:int,last:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _pass(docs: DataFrame, shared, window: int) -> DataFrame:
    """The hits of one chunk's items: text_sha256, spans, items of the texts that have some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(shared, window)
        for batch in batches:
            keys, spans, items = [], [], []
            for text in to_bytes(batch.column(0)):
                hit, found = machine.scan(split_words(text))
                if hit is not None:
                    found.discard(None)
                    keys.append(sha256(text).digest())
                    spans.append([{"first": a, "last": b} for a, b in spans_of(hit)])
                    items.append(sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))], ["text_sha256", "spans", "items"])

    return map_arrow(docs.select(F.col("text").cast("string").alias("text")), run, _HITS)


def _earlier(docs: DataFrame, shares: list, window: int) -> DataFrame | None:
    """text_sha256, spans, items of all chunks but the last, one row for each distinct text that has hits; None for one chunk.

    The hits of each chunk are written before the next begins. Spans of several chunks may overlap.
    """
    out = None
    for shared in shares[:-1]:
        found = _pass(docs, shared, window)
        # Copies have the same hits: one row of them leaves a task.
        found = cut(found.groupBy("text_sha256").agg(F.first("spans").alias("spans"), F.first("items").alias("items")))
        shared.unpersist()
        out = found if out is None else out.unionByName(found)
    if out is None or len(shares) == 2:
        return out
    # At most a row for each chunk and text.
    return cut(out.groupBy("text_sha256").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))


def _marked(docs: DataFrame, found: DataFrame | None) -> DataFrame:
    """docs with two more columns at the end: the spans and items that earlier chunks found in their texts."""
    spans, items = (next(f"__{x}{i}" for i in range(len(docs.columns) + 1) if f"__{x}{i}" not in docs.columns) for x in ("spans", "items"))
    if found is None:
        return docs.select("*", F.lit(None).cast("array<struct<first:int,last:int>>").alias(spans), F.lit(None).cast("array<string>").alias(items))
    key = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    held = found.select(F.col("text_sha256").alias("__sha"), F.col("spans").alias(spans), F.col("items").alias(items))
    joined = docs.join(held, key == F.col("__sha"), "left")
    return joined.select(*[docs[c] for c in docs.columns], spans, items)


def _united(words: list[bytes], machine: Automaton, earlier: list | None) -> tuple[np.ndarray | None, set]:
    """Which words are hit, by the machine's items or in earlier spans (None if none is), and the machine's items."""
    hit, found = machine.scan(words)
    found.discard(None)
    if earlier:
        hit = np.zeros(len(words), dtype=bool) if hit is None else hit
        for s in earlier:
            hit[s["first"] : s["last"]] = True
    return hit, found


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_ITEM_WORDS) -> DataFrame:
    """docs (doc_id, text) with n_words, hit spans (word numbers, end exclusive) and the sorted items."""
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = f"{docs.select('doc_id').schema.simpleString()[7:-1].replace(':', ' ')}, text string, n_words long, spans array<struct<first:int,last:int>>, items array<string>"
    shares = automata(benchmark, window, most)
    marked, last = _marked(base, _earlier(base, shares, window)), shares[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(last, window)
        for batch in batches:
            counts, spans, items = [], [], []
            for text, old, named in zip(to_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = split_words(text)
                hit, found = _united(words, machine, old)
                counts.append(len(words))
                spans.append([{"first": a, "last": b} for a, b in spans_of(hit)])
                items.append(sorted(found | set(named or [])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))], ["doc_id", "text", "n_words", "spans", "items"])

    return map_arrow(marked, run, kind)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["last"] - s["first"]).cast("long"))
    return scan(docs, benchmark, window).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans; what is left is joined by one space."""
    places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    out, at = [], 0
    for first, last in spans:
        out.append(text[at : places[first][0]])
        at = places[last - 1][1]
    out.append(text[at:])
    return b" ".join(p for p in (x.strip() for x in out) if p)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, span_limit: int = SPAN_LIMIT, coverage_limit: float = COVERAGE_LIMIT, most: int = MAX_ITEM_WORDS, item_limit: int = ITEM_LIMIT) -> DataFrame:
    """docs without contaminated spans, and without documents that are mostly benchmark; n_chars, if there is one, follows the text.

    All columns stay, in their order. A span is cut if it has span_limit words
    or more, or item_limit words or more and fewer than a window: then it
    consists of whole items that are shorter than a window. A document goes if hit words exceed coverage_limit of its words.
    The hits of all automata are united on the whole text before that.
    """
    names, at = docs.columns, docs.columns.index("text")
    shares = automata(benchmark, window, most)
    marked, last = _marked(docs, _earlier(docs, shares, window)), shares[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(last, window)
        for batch in batches:
            columns, fields = list(batch.columns)[: len(names)], list(batch.schema)[: len(names)]
            keep, changed = [], {}
            for i, (text, old) in enumerate(zip(to_bytes(columns[at]), batch.column(len(names)).to_pylist())):
                words = split_words(text)
                hit, _ = _united(words, machine, old)
                keep.append(hit is None or bool(hit.sum() <= coverage_limit * len(words)))
                if hit is not None and keep[-1]:
                    changed[i] = cut_spans(text, [s for s in spans_of(hit) if s[1] - s[0] >= span_limit or item_limit <= s[1] - s[0] < window]).decode()
            if changed:
                columns[at] = pa.array([changed.get(i, x) for i, x in enumerate(columns[at].to_pylist())], columns[at].type)
                if "n_chars" in names:
                    c = names.index("n_chars")
                    columns[c] = pa.array([len(changed[i]) if i in changed else x for i, x in enumerate(columns[c].to_pylist())], columns[c].type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields)).filter(pa.array(keep, pa.bool_()))

    return map_arrow(marked, run, docs.schema)
