"""Log-bilinear language model: noise-contrastive training in numpy, normalised token log-probabilities, counts of all tokens.

Tokens are the words of a text after A-Z are lower-cased, runs of characters
that are not ASCII white space, and one end. `fit` counts every training token
in Spark, and trains a log-bilinear model of the WORDS most frequent ones: two
previous tokens give a vector, whose product with a token's vector, plus a
bias, is its score. Each task trains on all its rows with noise-contrastive
estimation, from the same start; the tasks' parameters are averaged by tokens,
and that is one pass. `score` normalises over the whole vocabulary: a score is a sum over the places
before, so one matrix product of exponentials gives the sums of all contexts.

A token outside the vocabulary has the probability of that class, times its
own share (c + 1) / (N' + V' + 1) among the N' training tokens of the V'
distinct ones outside; unseen tokens share the last 1. So probabilities of all
tokens of a context, and of one unseen token, sum to 1.

Counts of the HEAD most frequent tokens are sent to the tasks: at most HEAD
tokens of LONG bytes. All others are joined by token, so a joined token has few
rows. A longer token goes by its SHA-256.

Cases: a null or empty text has the end only. Repeated rows count and are
scored each by itself, also under one doc_id or none. Long texts are read in
pieces, and a context goes on from piece to piece. Without training rows all
counts are 0, and the model is its start. Ties of counts go by the token's
bytes. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow, to_bytes

#: The end of a text; no word holds a space.
END = b" "
WORDS, HEAD, LONG = 2048, 1 << 18, 64
CONTEXT, DIM = 2, 24
NOISE, BATCH, RATE, BIAS_RATE, PASSES, SEED = 48, 1024, 0.2, 0.01, 1, 11
#: Tokens that a task trains on, or scores, at a time.
TRAIN_BLOCK, SCORE_BLOCK = 1 << 18, 1 << 20
#: A task hands on its counts when it holds so many tokens.
HELD = 300_000
#: Long texts are read in pieces of about so many bytes, cut between words.
PIECE = 4 << 20
#: Contexts of up to so many tokens are scored by tables of pairs; a sum under LEAST_SUM of its largest term is made anew.
TABLE, LEAST_SUM = 2050, 1e-25
#: Parameters travel in blocks of so many numbers.
BLOCK = 1 << 14


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some megabytes at a time."""
    if len(text) <= PIECE:
        yield text.lower().split()
        return
    spaces, at = text.translate(bytes(32 if 9 <= b <= 13 else b for b in range(256))).lower(), 0
    while at < len(spaces):
        end = spaces.find(b" ", at + PIECE)
        end = len(spaces) if end < 0 else end
        yield spaces[at:end].split()
        at = end


def key(word: bytes) -> bytes:
    """A word as it is counted: one of more than LONG bytes by its digest."""
    return word if len(word) <= LONG else b" " + sha256(word).hexdigest().encode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def handed_on() -> Iterator[pa.RecordBatch]:
        tokens = list(held)
        for i in range(0, len(tokens), 20_000):
            some = tokens[i : i + 20_000]
            columns = [pa.array(some, pa.binary()), pa.array([held[x] for x in some], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "n"])

    for batch in batches:
        for text in to_bytes(batch["text"]):
            for words in pieces(text):
                held.update(map(key, words) if max(map(len, words), default=0) > LONG else words)
            held[END] += 1
            if len(held) > HELD:
                yield from handed_on()
                held.clear()
    yield from handed_on()


def counts(docs: DataFrame) -> DataFrame:
    """token, n: every distinct token and how often it occurs."""
    found = map_arrow(docs.select(F.col("text").cast("string").alias("text")), _count, "token binary, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def head(found: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The end, then the most frequent tokens, `most` at most; those that tie with the next one stay out."""
    by_count = found.groupBy("n").agg(F.count("*").alias("tokens")).orderBy(F.desc("n")).limit(most).collect()
    least, room = None, most - 1
    for row in by_count:  # at most `most` rows, since each count has a token
        room -= row.tokens
        if room < 0:
            break
        least = row.n
    short = F.octet_length("token") <= LONG
    chosen = F.col("token") == F.lit(END)
    chosen = chosen if least is None else chosen | short & (F.col("n") >= least)
    rows = {bytes(r.token): r.n for r in found.where(chosen).collect()}
    ends = rows.pop(END, 0)
    return [(END, ends), *sorted(rows.items(), key=lambda x: (-x[1], x[0]))]


@dataclass
class Parameters:
    """context: vectors of tokens, of the class of others and of the start of a text; place: weights of a place before."""

    context: np.ndarray
    place: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, frequency: np.ndarray) -> Parameters:
        """Vectors of targets are 0, so the model starts as the unigram model of its classes."""
        rng, n = np.random.default_rng(SEED), len(frequency)
        context = rng.normal(0, 0.3, (n + 1, DIM)).astype(np.float32)
        return cls(context, np.full((CONTEXT, DIM), 1 / CONTEXT, np.float32), np.zeros((n, DIM), np.float32), np.log(frequency).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.place, self.target, self.bias)])

    @classmethod
    def of(cls, flat: np.ndarray, n: int) -> Parameters:
        a, b, c = np.cumsum([(n + 1) * DIM, CONTEXT * DIM, n * DIM])
        flat = flat.astype(np.float32)
        return cls(flat[:a].reshape(-1, DIM), flat[a:b].reshape(-1, DIM), flat[b:c].reshape(-1, DIM), flat[c:])

    def predicted(self, before: np.ndarray) -> np.ndarray:
        """Vectors of contexts, rows of CONTEXT ids, the nearest first."""
        return sum(self.context.take(before[:, i], axis=0) * self.place[i] for i in range(CONTEXT))

    def log_z(self, vectors: np.ndarray) -> np.ndarray:
        """Natural logarithms of the sums over the whole vocabulary."""
        # The bias is one more component; few rows at a time stay in the processor's cache.
        out, ones = np.empty(len(vectors)), np.ones(len(self.bias), np.float32)
        rows = np.hstack([vectors, np.ones((len(vectors), 1), np.float32)])
        target = np.ascontiguousarray(np.hstack([self.target, self.bias[:, None]]).T)
        for i in range(0, len(rows), 128):
            scores = rows[i : i + 128] @ target
            most = scores.max(axis=1, keepdims=True)
            np.exp(np.subtract(scores, most, out=scores), out=scores)
            out[i : i + 128] = np.log(scores @ ones) + most[:, 0]
        return out

    def log_probabilities(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Natural logarithms of P(token | context)."""
        if len(self.context) <= TABLE:
            return self.tables.log_probabilities(before, tokens, self.bias)
        return self.direct(before, tokens)

    @cached_property
    def tables(self) -> Tables:
        return Tables(self)

    def __getstate__(self) -> dict:
        """Tables are made where they are used, once in a process."""
        return {k: v for k, v in vars(self).items() if k != "tables"}

    def direct(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The same without tables of pairs. Each distinct context is normalised once."""
        packed = np.zeros(len(before), dtype=np.int64)
        for i in range(CONTEXT):
            packed = packed * (len(self.bias) + 1) + before[:, i]
        _, first, which = np.unique(packed, return_index=True, return_inverse=True)
        vectors = self.predicted(before[first])
        out = self.bias[tokens].astype(np.float64) - self.log_z(vectors)[which]
        for i in range(0, len(out), 1 << 16):
            part = slice(i, i + (1 << 16))
            out[part] += np.einsum("ij,ij->i", vectors[which[part]], self.target[tokens[part]])
        return out


class Tables:
    """What a token at each of the two places adds to the score of each token, and the sums over the vocabulary of all contexts.

    A score is a sum of one number for each place, so exp of it is a product, and
    the sums of all contexts are one matrix product. Each row is scaled by its
    largest number; where the largest of the two rows lie so far apart that a sum
    loses digits, the context is normalised by itself.
    """

    def __init__(self, p: Parameters):
        self.p = p
        self.added = [(p.context * p.place[i]) @ p.target.T for i in range(CONTEXT)]
        shifted = [self.added[0] + p.bias, self.added[1]]
        self.most = [x.max(axis=1) for x in shifted]
        one, two = (np.exp(np.subtract(x, m[:, None], out=x.copy() if x is self.added[1] else x)) for x, m in zip(shifted, self.most))
        self.sums = one @ two.T

    def log_z(self, before: np.ndarray) -> np.ndarray:
        a, b = before[:, 0], before[:, 1]
        found = self.sums[a, b].astype(np.float64)
        with np.errstate(divide="ignore"):
            out = np.log(found) + self.most[0][a] + self.most[1][b]
        apart = np.flatnonzero(found < LEAST_SUM)
        for i in range(0, len(apart), 1 << 14):
            some = apart[i : i + (1 << 14)]
            out[some] = self.p.log_z(self.p.predicted(before[some]))
        return out

    def log_probabilities(self, before: np.ndarray, tokens: np.ndarray, bias: np.ndarray) -> np.ndarray:
        out = np.empty(len(tokens))
        for i in range(0, len(out), 1 << 16):
            part = slice(i, i + (1 << 16))
            near, token = before[part], tokens[part]
            out[part] = self.added[0][near[:, 0], token] + self.added[1][near[:, 1], token] + bias[token].astype(np.float64) - self.log_z(near)
        return out


class Trainer:
    """Noise-contrastive estimation, with one set of noise tokens a batch and AdaGrad steps."""

    def __init__(self, start: Parameters, frequency: np.ndarray, seed: int):
        self.p = Parameters(*(x.copy() for x in (start.context, start.place, start.target, start.bias)))
        self.log_noise = np.log(NOISE * frequency).astype(np.float32)
        self.until = np.cumsum(frequency / frequency.sum())
        self.rng = np.random.default_rng([SEED, seed])
        self.seen = [np.full(len(x), 0.01, np.float32) for x in (self.p.context, self.p.target, self.p.bias)] + [np.full(CONTEXT, 0.01, np.float32)]

    def _step(self, values: np.ndarray, seen: np.ndarray, rows: np.ndarray, change: np.ndarray, rate: float) -> None:
        """Add up the changes of each row and go uphill; the step shrinks with what the row has had."""
        order = np.argsort(rows.astype(np.int16) if len(values) < 1 << 15 else rows, kind="stable")  # short ones by radix
        rows = rows.take(order)
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        change, rows = np.add.reduceat(change.take(order, axis=0), first, axis=0), rows[first]
        seen[rows] += change * change if change.ndim == 1 else np.einsum("ij,ij->i", change, change)
        pace = rate / np.sqrt(seen[rows])
        values[rows] += change * (pace if change.ndim == 1 else pace[:, None])

    def batch(self, before: np.ndarray, tokens: np.ndarray) -> None:
        p, scale = self.p, np.float32(1 / len(tokens) ** 0.5)
        noise = np.searchsorted(self.until, self.rng.random(NOISE)).clip(max=len(p.bias) - 1)
        vectors = p.predicted(before)
        true, false = p.target.take(tokens, axis=0), p.target[noise]
        with np.errstate(over="ignore"):
            up = 1 / (1 + np.exp(np.einsum("ij,ij->i", vectors, true) + p.bias[tokens] - self.log_noise[tokens])) * scale
            down = -scale / (1 + np.exp(-(vectors @ false.T + p.bias[noise] - self.log_noise[noise])))
        pull = up[:, None] * true + down @ false
        place = np.stack([np.einsum("ij,ij->j", pull, p.context.take(before[:, i], axis=0)) for i in range(CONTEXT)])
        by_place = [pull * p.place[i] for i in range(CONTEXT)]
        rows = np.concatenate([tokens, noise])
        self._step(p.target, self.seen[1], rows, np.concatenate([up[:, None] * vectors, down.T @ vectors]), RATE)
        self._step(p.bias, self.seen[2], rows, np.concatenate([up, down.sum(axis=0)]), BIAS_RATE)
        self._step(p.context, self.seen[0], before.T.ravel(), np.concatenate(by_place), RATE)
        self._step(p.place, self.seen[3], np.arange(CONTEXT), place, RATE)

    def block(self, before: np.ndarray, tokens: np.ndarray) -> None:
        order = self.rng.permutation(len(tokens))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            self.batch(before.take(part, axis=0), tokens.take(part))


class Sequences:
    """Ids of texts in a row, and the contexts of their tokens."""

    def __init__(self, ids: dict[bytes, int], words: int):
        self.ids, self.words, self.parts, self.size = ids, words, [], 0
        self.last = np.full(CONTEXT, words + 1)

    def begin(self) -> None:
        self.last = np.full(CONTEXT, self.words + 1)

    def add(self, words: list[bytes]) -> np.ndarray:
        """Places in the head, -1 for others."""
        get = self.ids.get
        found = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        if not len(found):
            return found
        known = np.where((found >= 0) & (found < self.words), found, self.words)
        line = np.concatenate([self.last, known])
        before = np.stack([line[CONTEXT - 1 - i : len(line) - 1 - i] for i in range(CONTEXT)], axis=1)
        self.parts.append((before, known))
        self.last, self.size = line[-CONTEXT:], self.size + len(known)
        return found

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        parts, self.parts, self.size = self.parts, [], 0
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])


@dataclass
class Model:
    found: DataFrame  # token, n
    head: list[tuple[bytes, int]]
    n: int
    v: int
    parameters: Parameters

    @property
    def words(self) -> int:
        """Tokens of the vocabulary; this number is also the id of the class of all others."""
        return len(self.parameters.bias) - 1

    @property
    def others(self) -> tuple[int, int]:
        """Training tokens outside the vocabulary: all, distinct."""
        known = [n for _, n in self.head[: self.words] if n]
        return self.n - sum(known), self.v - len(known)


def _trained(docs: DataFrame, ids, start, frequency: np.ndarray) -> DataFrame:
    words = len(frequency) - 1

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        trainer, held, seen = Trainer(Parameters.of(start.value, words + 1), frequency, task), Sequences(ids.value, words), 0
        for batch in batches:
            for text in to_bytes(batch["text"]):
                held.begin()
                for part in pieces(text):
                    held.add(part)
                held.add([END])
                if held.size >= TRAIN_BLOCK:
                    seen += held.size
                    trainer.block(*held.taken())
        if held.size:
            seen += held.size
            trainer.block(*held.taken())
        if seen:
            flat = trainer.p.flat()
            for i in range(0, len(flat), BLOCK):
                columns = [pa.array([i // BLOCK], pa.int32()), pa.array([task], pa.int32()), pa.array([float(seen)]), pa.array([flat[i : i + BLOCK].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "task", "weight", "numbers"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}  # all blocks of one model at most
        for batch in batches:
            for block, weight, numbers in zip(*(batch.column(c).to_pylist() for c in ("block", "weight", "numbers"))):
                had = sums.setdefault(block, [0.0, 0.0])
                had[0] += weight
                had[1] = had[1] + weight * np.frombuffer(numbers, np.float32).astype(np.float64)
        columns = [pa.array(list(sums), pa.int32()), pa.array([(total / weight).tobytes() for weight, total in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "numbers"])

    parts = map_arrow(docs.select(F.col("text").cast("string").alias("text")), train, "block int, task int, weight double, numbers binary")
    return map_arrow(parts.repartition("block").sortWithinPartitions("block", "task"), average, "block int, numbers binary")


def fit(docs: DataFrame, words: int = WORDS, most: int = HEAD, passes: int = PASSES) -> Model:
    """Counts of all tokens of docs, and parameters trained on all of them."""
    context = docs.sparkSession.sparkContext
    found = cut(counts(docs))
    n, v = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = head(found, most)
    known = np.array([c for _, c in top[:words]], dtype=np.float64)
    frequency = (np.append(known, n - known.sum()) + 1) / (n + len(known) + 1)
    ids = context.broadcast({token: i for i, (token, _) in enumerate(top[:words])})
    at = Parameters.start(frequency).flat()
    for _ in range(passes):
        start = context.broadcast(at)
        rows = _trained(docs, ids, start, frequency).collect()
        if rows:
            at = np.concatenate([np.frombuffer(r.numbers) for r in sorted(rows, key=lambda r: r.block)]).astype(np.float32)
        start.unpersist()
    ids.unpersist()
    return Model(found, top, n, v, Parameters.of(at, len(frequency)))


def _partial(rows: DataFrame, model: Model) -> DataFrame:
    """Sums over each text's tokens of the head, and its other tokens."""
    context = rows.sparkSession.sparkContext
    ids = context.broadcast({token: i for i, (token, _) in enumerate(model.head)})
    parameters, words = context.broadcast(model.parameters), model.words
    head_counts = np.array([n for _, n in model.head], dtype=np.float64)
    size = sum(model.others) + 1.0
    keep = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, log_count = Sequences(ids.value, words), np.log10(head_counts + 1)
        log_share, rest = log_count - np.log10(size), []  # rest: (row of the batch, values), places and other tokens of each piece

        def flushed() -> Iterator[pa.RecordBatch]:
            before, tokens = held.taken()
            place = np.concatenate([x[1] for x in rest])
            starts = np.cumsum([0] + [len(x[1]) for x in rest])
            p = parameters.value.log_probabilities(before, tokens) / np.log(10)
            in_head = place >= 0
            p += np.where(in_head & (place >= words), log_share[place], 0.0)
            sums = [np.add.reduceat(x, starts[:-1]) for x in (in_head & (head_counts[place] > 0), np.where(in_head, log_count[place], 0.0), p)]
            for i in range(0, len(rest), 1000):
                some = rest[i : i + 1000]
                columns = [pa.array([x[0][c] for x in some], kind) for c, kind in enumerate(kinds)]
                part = slice(i, i + 1000)
                columns += [pa.array(np.diff(starts)[part]), pa.array(sums[0][part].astype(np.int64)), pa.array(sums[1][part]), pa.array(sums[2][part]), pa.array([x[2] for x in some], pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in keep), "n_tokens", "n_known", "base", "score", "others"])
            rest.clear()

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.schema.field(f.name).type for f in keep]
            values = zip(*(batch.column(f.name).to_pylist() for f in keep))
            for own, text in zip(values, to_bytes(batch["text"])):
                held.begin()
                for last, part in _marked(pieces(text)):
                    part = [*part, END] if last else part
                    found = held.add(part)
                    if len(found):
                        rest.append((own, found, [key(part[i]) for i in np.flatnonzero(found < 0)]))
                    if held.size >= SCORE_BLOCK:
                        yield from flushed()
        if rest:
            yield from flushed()

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return map_arrow(rows, run, f"{kept}, n_tokens long, n_known long, base double, score double, others array<binary>")


def _marked(parts: Iterator) -> Iterator[tuple[bool, list]]:
    """Each part, and whether it is the last; at least an empty one."""
    had = next(parts, [])
    for part in parts:
        yield False, had
        had = part
    yield True, had


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; held_out is a column of docs."""
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), "doc_id", "held_out", F.col("text").cast("string").alias("text"))
    partial = cut(_partial(rows, model))
    n, v = model.others
    other = partial.select("__row", F.explode("others").alias("token")).join(model.found, "token", "left")
    log_count = F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0))
    other = other.select("__row", F.when(F.col("n") > 0, 1).otherwise(0).cast("long").alias("n_known"), log_count.alias("base"), (log_count - F.log10(F.lit(n + v + 1.0))).alias("score"))
    sums = partial.drop("others").unionByName(other, allowMissingColumns=True).groupBy("__row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score"),
    )
    base = F.col("base") - F.col("n_tokens") * F.log10(F.lit(model.n + model.v + 1.0))
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
