"""Line dedup (operator 8): content-defined chunks of lines, extended to whole passages.

A line ends at a line end or after a sentence, since many texts are one long
line. Each line is hashed, and a hash rolls over every two lines that follow
each other. A chunk ends between two lines whose rolling hash is the smallest
of those within `least` - 1 tokens (runs of bytes other than spaces and line
ends) to both sides. So boundaries depend on the lines beside them only,
whatever comes before, and copies of a passage get the same ones wherever they
stand. Chunks have `least` tokens or more, but for the first and the last of a
text; a chunk of one line counts if it has that many.

Inside a line of more tokens than that, where no boundary is in reach, hashes
of three tokens take the place of the rolling ones, by the same rule. Where
tokens repeat so much that no hash is smallest, a chunk ends after MAX_WORDS
tokens.

Chunks are compared across the whole table by a 96-bit hash. The first
occurrence (smallest doc_id, then position) stays; an other occurrence is
removed if its bytes equal the first one's. With `extend`, chunks are of
ANCHOR_WORDS tokens or more, and a match goes on token by token into the chunks
before and after it, as far as the bytes are equal; it is removed if it then
has MIN_WORDS tokens. A longer passage needs no longer reach: its further
chunks match themselves, and ANCHOR_WORDS is half of MIN_WORDS. Every byte that
goes has an equal one at a smaller place, so something of each passage stays.
Without `extend` chunks have MIN_WORDS tokens, and only whole chunks go.

Hashes travel first, to be counted by themselves; where a chunk lies travels
only with hashes that repeat. Only texts in which a hash repeats are read for
bytes, and only the chunks of such hashes, with their neighbours, travel to be
compared.
Joins are merge joins at every size, but for the one that drops hashes of one
place, which keeps a partition's repeated hashes, each once, in memory instead
of sorting all others; nothing is broadcast. Counts are partial
sums, and the joins on a hash that repeats in a third of all rows are split by
adaptive execution.

A passage within which no two boundaries fall is not found. MIN_WORDS keeps
short repeated phrases in place. Where what is removed held a line end, one
stays.

Cases: null text stays null and has no chunk; empty text has no chunk. Rows
with a null doc_id keep their text. Rows that repeat a doc_id are one document
with the texts of each row; the decisions for a text carry its hash, so they
touch that text only, and equal rows of one id both keep what the first keeps.
Equal chunks tie by doc_id, then by place; of rows of one id and place, none
goes. A very long text is one row in memory, with its tokens. An empty table
gives no rows. Only doc_id and text are read, so extra columns can't clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import cut, map_arrow, settled, sized, to_bytes
from .words import mix

MIN_WORDS = 16
ANCHOR_WORDS = MIN_WORDS // 2
MAX_WORDS = 256
#: Rows and bytes of a batch of chunks on its way out of Python.
OUT_ROWS, OUT_BYTES = 4096, 1 << 20
#: Texts are handled in groups of about so many bytes.
GROUP_BYTES = 1 << 18
_SPACES = bytes(32 if b in b" \t\n\r\f\v" else b for b in range(256))
_TOKEN = re.compile(rb"[^ \t\n\r\f\v]+[ \t\n\r\f\v]*")
_STOP, _CLOSE = (np.isin(np.arange(256), list(marks)) for marks in (b".!?", b"\"')]"))
_LAST = np.uint64((1 << 64) - 1)
#: Texts are hashed in pieces of about so many bytes, cut between tokens.
HASHED = 1 << 16
#: Powers of the base of words._hashes, those of its inverse modulo 2^64, and what a token of so many bytes adds.
_BASE = 0x9E3779B97F4A7C15
_UP = np.cumprod(np.full(HASHED + (1 << 10), _BASE, np.uint64))
_DOWN = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(_UP) - 1, pow(_BASE, -1, 1 << 64), np.uint64)]))
_ONES = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_UP)]) + np.arange(len(_UP) + 1, dtype=np.uint64)


def _least(v: np.ndarray, k: int) -> np.ndarray:
    """The smallest of each k values that follow each other."""
    size = 1
    while size * 2 <= k:
        v, size = np.minimum(v[:-size], v[size:]), size * 2
    return np.minimum(v[: len(v) - (k - size)], v[k - size :]) if k > size else v


def _rolled(hashes: np.ndarray, opening: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """For each line, a hash of it and of the line before it in its text. opening: the first token of each line; heads: the first line of each text."""
    lengths = np.diff(np.append(opening, len(hashes)))
    place = np.arange(len(hashes)) - np.repeat(opening, lengths)
    place = place.view(np.uint64)
    place *= np.uint64(0x9E3779B97F4A7C15)
    place += hashes
    line = mix(np.add.reduceat(_mix(place), opening) + lengths.astype(np.uint64))
    before = np.roll(line, 1)
    before[heads] = 0
    return mix(mix(before) * np.uint64(0xD1B54A32D192ED03) + line)


def _hashes(clean: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The same as words._hashes by differences of running sums, so that bytes are not gathered word by word."""
    raw = np.frombuffer(clean, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=bool)
    np.not_equal(raw, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2].copy(), edges[1::2]
    lengths = ends - starts
    if len(raw) > len(_UP) or len(starts) and lengths.max() > 0xFFFF:
        return words._hashes(clean)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw * _UP[: len(raw)], out=total[1:])
    found = (total[ends] - total[starts]) * _DOWN[starts]
    found += _ONES[lengths]
    return starts, _mix(found)


def _mix(x: np.ndarray) -> np.ndarray:
    """words.mix in place."""
    t = x >> np.uint64(30)
    x ^= t
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=t)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=t)
    return x


def _newlines(raw: np.ndarray) -> np.ndarray:
    """Their places; eight bytes are looked at together first."""
    found = np.zeros(-(-len(raw) // 8) * 8, bool)
    np.equal(raw, 10, out=found[: len(raw)])
    some = np.flatnonzero(found.view(np.uint64))
    row, column = np.nonzero(found.reshape(-1, 8)[some])
    return some[row] * 8 + column


def _bounds(texts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first byte, last byte and tokens of each chunk of the texts, in order."""
    joined = b" ".join(texts) + b" "
    clean = joined.translate(_SPACES)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(clean):  # hashed in pieces, cut between tokens
        end = clean.find(b" ", at + HASHED) if len(clean) - at > HASHED else -1
        end = len(clean) if end < 0 else end
        s, h = _hashes(clean[at:end])
        s += at
        starts.append(s), hashes.append(h)
        at = end
    starts, hashes = np.concatenate(starts), np.concatenate(hashes)
    n, half = len(starts), least - 1
    offsets = np.searchsorted(starts, begin)
    head = offsets[:-1][np.diff(offsets) > 0]
    raw, spaces = np.frombuffer(joined, dtype=np.uint8), np.frombuffer(clean, dtype=np.uint8)
    # The rank of each token as the start of a chunk: inside a line, a hash of it and of the two before it in its text.
    one, rank = np.roll(hashes, 1), np.roll(hashes, 2)
    one[head] = rank[head] = 0
    rank[head[head + 1 < n] + 1] = 0
    rank *= np.uint64(0x9E3779B97F4A7C15)
    one = _mix(one)
    one *= np.uint64(0xD1B54A32D192ED03)
    rank += one
    rank += hashes
    rank = _mix(rank)
    rank >>= np.uint64(1)
    # Lines start after a newline or, over at most two spaces, after the end of a sentence.
    last = np.maximum(starts - 2, 0)
    last -= spaces[last] == 32
    np.maximum(last, 0, out=last)
    x = raw[last]
    opens = _STOP[x]
    closed = np.flatnonzero(_CLOSE[x])
    y, z = (raw[np.maximum(last[closed] - i, 0)] for i in (1, 2))
    opens[closed] |= _STOP[y] | _CLOSE[y] & _STOP[z]
    after = np.searchsorted(starts, _newlines(raw))
    opens[after[after < n]] = True
    opens[head] = True
    opening = np.flatnonzero(opens)
    rank |= np.uint64(1 << 63)  # after all line starts
    if len(opening):
        rolled = _rolled(hashes, opening, np.searchsorted(opening, head))
        rank[opening] = rolled >> np.uint64(1)
    rank[head] = _LAST
    # Texts are set apart by `half` places, so that no window sees two of them.
    place = np.arange(n) + half * np.repeat(np.arange(1, len(texts) + 1), np.diff(offsets))
    wide = np.full(n + half * (len(texts) + 1), _LAST)
    wide[place] = rank
    near = _least(wide, half)
    # wide[i] is a boundary if no rank of the `half` places to its left is as small, and none to its right smaller.
    start = wide[half : len(wide) - half] < near[: len(near) - half - 1]
    start &= wide[half : len(wide) - half] <= near[half + 1 :]
    opening = offsets[:-1] + half * np.arange(len(texts))
    start[opening[np.diff(offsets) > 0]] = True
    marks = np.flatnonzero(start)
    of = np.searchsorted(opening, marks, side="right") - 1
    marks -= half * of
    counts = np.diff(np.append(marks, n))
    if len(counts) and counts.max() > MAX_WORDS + least:
        wide = counts >= MAX_WORDS + least
        more = [m + k for m, c in zip(marks[wide].tolist(), counts[wide].tolist()) for k in range(MAX_WORDS, c - least + 1, MAX_WORDS)]
        marks = np.sort(np.concatenate([marks, np.array(more, np.int64)]))
        counts = np.diff(np.append(marks, n))
        of = np.searchsorted(offsets, marks, side="right") - 1
    first = starts[marks] - begin[of]
    is_head = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
    first[is_head] = 0
    last = np.append(first[1:], 0)
    tail = np.append(is_head[1:], True)[: len(of)]
    last = last[: len(of)]
    last[tail] = (np.diff(begin) - 1)[of[tail]]
    return of, first, last, counts


def chunks(text: bytes, least: int = MIN_WORDS) -> Iterator[tuple[int, int, int]]:
    """(first byte, last byte, tokens) of each chunk, in order; together they cover the text."""
    _, first, last, counts = (x.tolist() for x in _bounds([text], least))
    yield from zip(first, last, counts) if first or not text else [(0, len(text), 0)]


def _keys(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The first 96 bits of a 128-bit hash of each, without the spaces at its end."""
    digests = b"".join([xxhash.xxh3_128_digest(p.rstrip(b" \t\n")) for p in pieces])
    keys = np.frombuffer(digests, [("h1", ">i8"), ("h2", ">i4"), ("rest", ">i4")])
    return keys["h1"].astype(np.int64), keys["h2"].astype(np.int32)


def _body(piece: bytes) -> bytes:
    return piece.rstrip(b" \t\n")


def _eligible(piece: bytes, words: int, least: int = MIN_WORDS) -> bool:
    return words >= least


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")


def chunk_rows(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """A row for each eligible chunk: doc_id, at (first byte), h1, h2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, done = batch.column(0).to_numpy(), 0
            for texts in sized(iter(to_bytes(batch.column(1))), lambda t: len(t) + 64, GROUP_BYTES):
                of, first, last, tokens = _bounds(texts, least)
                long = tokens >= least
                of, first, last = of[long], first[long], last[long]
                columns = [ids[done + of], first, *_keys([texts[i][a:b] for i, a, b in zip(of.tolist(), first.tolist(), last.tolist())])]
                done += len(texts)
                out = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "at", "h1", "h2"])
                # A long text has many chunks: they leave in small batches.
                yield from (out.slice(i, OUT_ROWS) for i in range(0, len(of), OUT_ROWS))

    return map_arrow(_own(docs), run, "doc_id long, at long, h1 long, h2 int")


class Marks:
    """The marks of a batch of rows, a list of structs each, by column; a mark names a chunk by its place `at` and its hash."""

    def __init__(self, column: pa.ListArray):
        given = column.flatten()
        self.columns = {f.name: given.field(i).to_numpy() for i, f in enumerate(given.type)}
        self.offsets = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(column), 0).to_numpy()))
        self.row = np.repeat(np.arange(len(column)), np.diff(self.offsets))

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]

    def found(self, texts: list[bytes], row: int, of: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks of the texts, those of the rows from `row` on, that have a mark, and their marks."""
        mark = np.arange(self.offsets[row], self.offsets[row + len(texts)])
        there, want = (of << 40) + first, (self.row[mark] - row << 40) + self["at"][mark]
        at = np.searchsorted(there, want)
        at[at == len(there)] = 0
        hit = there[at] == want if len(there) else np.zeros(len(at), bool)
        at, mark = at[hit], mark[hit]
        h1, h2 = _keys([texts[i][a:b] for i, a, b in zip(of[at].tolist(), first[at].tolist(), last[at].tolist())])
        same = (h1 == self["h1"][mark]) & (h2 == self["h2"][mark])
        return at[same], mark[same]


_CHUNK = ["doc_id", "at", "last", "h1", "h2", "is_first", "body", "before", "after", "joined"]


def chunk_bytes(marked: DataFrame, least: int, extend: bool) -> DataFrame:
    """doc_id, text, marks -> the marked chunks with their bytes and, to extend, the chunks before and after.

    A neighbour that repeats the chunk that lies beside this one's first
    occurrence goes by itself: it needn't travel, and `joined` says there is one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, done = batch.column(0).to_numpy(), Marks(batch.column(2)), 0
            for texts in sized(iter(to_bytes(batch.column(1))), lambda t: len(t) + 64, GROUP_BYTES):
                of, first, last, _ = _bounds(texts, least)
                at, mark = marks.found(texts, done, of, first, last)
                # For each chunk that is marked, where the same comes first: its doc_id and place.
                is_marked, source, place = np.zeros(len(of), bool), np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
                is_marked[at], source[at], place[at] = True, marks["d"][mark], marks["p"][mark]
                doc = ids[done + of]
                is_first = is_marked & (source == doc) & (place == first)
                done += len(texts)
                chunk, pick = np.unique(at, return_index=True)
                joined, sides = np.zeros(len(chunk), bool), []
                for step in (-1, 1):
                    beside = chunk + step
                    there = extend & (beside >= 0) & (beside < len(of))
                    beside = np.where(there, beside, chunk)
                    there &= of[beside] == of[chunk]
                    goes = there & is_marked[beside] & ~is_first[chunk] & ~is_first[beside] & (source[beside] == source[chunk]) & (place[beside] == place[chunk] + first[beside] - first[chunk])
                    joined |= goes
                    sides.append((first[beside], np.where(there & ~goes, last[beside], first[beside])))
                owner, begin, end = of[chunk].tolist(), first[chunk], last[chunk]
                pieces = [_body(texts[i][a:b]) for i, a, b in zip(owner, begin.tolist(), end.tolist())]
                around = [[texts[i][a:b] for i, a, b in zip(owner, x.tolist(), y.tolist())] for x, y in sides]
                columns = [pa.array(c) for c in (doc[chunk], begin, end, marks["h1"][mark[pick]], marks["h2"][mark[pick]], is_first[chunk])]
                columns += [pa.array(c, pa.binary()) for c in (pieces, *around)] + [pa.array(joined)]
                out = pa.RecordBatch.from_arrays(columns, _CHUNK)
                # A long text has many chunks: they leave in small batches.
                size = np.cumsum(end - begin + sum(y - x for x, y in sides))
                cuts = np.flatnonzero(np.diff(size // OUT_BYTES) + np.diff(np.arange(len(size)) // OUT_ROWS)) + 1
                edges = [0, *cuts.tolist(), len(size)]
                yield from (out.slice(x, y - x) for x, y in zip(edges, edges[1:]))

    return map_arrow(marked, run, "doc_id long, at long, last long, h1 long, h2 int, is_first boolean, body binary, before binary, after binary, joined boolean")


def _reach(own: bytes, other: bytes, back: bool) -> int:
    """Bytes of own that match other token by token, from its end if back."""
    if own == other:
        return len(own.lstrip())
    if (own.rstrip()[-1:] != other.rstrip()[-1:]) if back else (own.lstrip()[:1] != other.lstrip()[:1]):
        return 0
    a, b, n = _TOKEN.findall(own), _TOKEN.findall(other), 0
    for x, y in zip(reversed(a), reversed(b)) if back else zip(a, b):
        if x == y:
            n += len(x)
        else:
            # At the far end of a passage, the spaces after its last token may differ.
            return n if back or _body(x) != _body(y) else n + len(x)
    return n


def _freed(df: DataFrame) -> DataFrame:
    """df, after the driver dropped what it holds of finished plans, so that Spark deletes their shuffle files."""
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def _marks(docs: DataFrame, least: int) -> DataFrame:
    """__id, marks: of each document, where its chunks are that repeat, and where they come first."""
    hashes = cut(chunk_rows(docs, least))
    # Counts alone first: a hash and a number are all that most chunks send. The places of the others follow.
    repeated = _freed(cut(hashes.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")))
    hashes = _freed(cut(hashes.join(repeated.hint("shuffle_hash"), ["h1", "h2"], "left_semi")))
    first = hashes.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "at")).alias("first"))
    marks = hashes.join(first.hint("merge"), ["h1", "h2"]).groupBy(F.col("doc_id").alias("__id"))
    return marks.agg(F.collect_set(F.struct("at", "h1", "h2", F.col("first.doc_id").alias("d"), F.col("first.at").alias("p"))).alias("marks"))


def removals(docs: DataFrame, extend: bool = False) -> DataFrame:
    """doc_id, at, h1, h2 of the chunks that repeat an earlier chunk byte for byte, and first, last: the bytes to remove.

    Scratch tables go as soon as what they were for is written.
    """
    least = ANCHOR_WORDS if extend else MIN_WORDS
    marks = _freed(settled(docs.sparkSession, lambda: _marks(docs, least)))
    marked = _own(docs).join(marks.hint("merge"), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "marks")
    found = _freed(cut(chunk_bytes(marked, least, extend), "zstd"))  # bytes of texts: the largest table here
    original = found.where("is_first").groupBy("h1", "h2").agg(F.min(F.struct("body", "before", "after")).alias("kept"))
    same = found.where("not is_first").join(original.hint("merge"), ["h1", "h2"]).where("body = kept.body").select(*_CHUNK, F.col("kept.before").alias("b"), F.col("kept.after").alias("a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, lasts, keep = [], [], []
            for at, last, body, before, after, joined, b, a in zip(*(batch.column(c).to_pylist() for c in ("at", "last", "body", "before", "after", "joined", "b", "a"))):
                left, right = _reach(before, b, True) if before and b else 0, _reach(after, a, False) if after and a else 0
                firsts.append(at - left), lasts.append(last + right)
                keep.append(joined or sum(len(x.split()) for x in (before[len(before) - left :], body, after[:right])) >= MIN_WORDS)
            columns = [batch.column(c) for c in ("doc_id", "at", "h1", "h2")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(firsts, pa.int64()), pa.array(lasts, pa.int64())], ["doc_id", "at", "h1", "h2", "first", "last"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(same, run, "doc_id long, at long, h1 long, h2 int, first long, last long")


def _without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """raw without the spans, which may overlap; a span that held a line end leaves one."""
    out, at = b"", 0
    for first, last in sorted(spans):
        if last > at:
            out += raw[at : max(at, first)]
            if out and not out.endswith(b"\n") and b"\n" in raw[max(at, first) : last]:
                out += b"\n"
            at = last
    return (out + raw[at:]).rstrip(b" \t\n")


def dedup(docs: DataFrame, extend: bool = False) -> DataFrame:
    """doc_id, text without what is removed, n_chunks_removed, n_chars_removed (code points)."""
    least = ANCHOR_WORDS if extend else MIN_WORDS
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    gone = _freed(settled(docs.sparkSession, lambda: removals(docs, extend).groupBy("doc_id").agg(F.collect_set(F.struct("at", "h1", "h2", "first", "last")).alias("gone"))))
    joined = own.join(gone.withColumnRenamed("doc_id", "__id").hint("merge"), F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column(1), batch.column(2)
            n, chars, new = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), {}
            # Most texts lose nothing, and stay as they are in their Arrow array.
            some = np.flatnonzero(pc.and_(texts.is_valid(), gone.is_valid()).to_numpy(zero_copy_only=False))
            marks, done = Marks(gone.take(pa.array(some))), 0
            for group in sized((to_bytes(texts.slice(i, 1))[0] for i in some.tolist()), lambda t: len(t) + 64, GROUP_BYTES):
                of, first, last, _ = _bounds(group, least)
                at, mark = marks.found(group, done, of, first, last)
                spans: dict[int, list] = {}
                for i, *span in zip(of[at].tolist(), marks["first"][mark].tolist(), marks["last"][mark].tolist()):
                    spans.setdefault(i, []).append(tuple(span))
                chunks_gone = np.bincount(of[np.unique(at)], minlength=len(group))
                for k, ranges in spans.items():
                    i, raw = int(some[done + k]), group[k]
                    n[i], new[i] = chunks_gone[k], _without(raw, ranges).decode()
                    chars[i] = len(raw.decode()) - len(new[i])
                done += len(group)
            if new:
                mask = np.zeros(batch.num_rows, bool)
                mask[list(new)] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([new[i] for i in sorted(new)], texts.type))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts, pa.array(n), pa.array(chars)], ["doc_id", "text", "n_chunks_removed", "n_chars_removed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(joined, run, f"doc_id {kind}, text string, n_chunks_removed long, n_chars_removed long")
