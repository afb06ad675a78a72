"""Secret scans (operator 4): keyword automaton, anchored patterns, embedded checksums.

An Aho-Corasick automaton finds every keyword of every kind in one pass over
the lower-cased bytes. Only at a hit is that kind's pattern tried, anchored at
the keyword, and never inside the previous match of its kind: the result is
that of leftmost non-overlapping search. Hex runs have no keyword; their text
is mapped to a class byte for hex digits, in which 32 such bytes in a row are
the keyword. Kinds with an embedded checksum (github, npm: the last six
characters are the base-62 CRC32 of the random part) are kept only if it holds.

Cases: null text counts as empty. Empty text has no spans. Spans are in code
points of the whole text, end exclusive, ordered by start, then by kind as in
KINDS. Equal rows give equal results, under one doc_id or none, too. A very long
text is scanned whole, in time in proportion to its length, and is one row in
memory. An empty table gives no rows. Only doc_id and text are read, so other
columns can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, to_bytes

#: The kinds in their order, the base ones first.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
#: The keywords, lower-cased, and the kind of each.
KEYWORDS = {
    b"password": "assign", b"passwd": "assign", b"secret": "assign", b"token": "assign", b"apikey": "assign", b"api_key": "assign",
    b"akia": "access",
    b"ghp_": "github", b"gho_": "github", b"ghu_": "github", b"ghs_": "github", b"ghr_": "github",
    b"npm_": "npm",
}
#: The patterns. ASCII letters of assign's keywords match in either case.
PATTERNS = {
    "assign": re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
}
_HEX = re.compile(rb"[0-9a-f]{32,}")
_HEX_CLASS = bytes(104 if 48 <= b <= 57 or 97 <= b <= 102 else 46 for b in range(256))
_HEX_KEY = b"h" * 32
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_holds(body: bytes) -> bool:
    """Whether the last six characters are the CRC32 of those before, in base 62, padded with zeros."""
    n, out = zlib.crc32(body[:-6]), ""
    while n:
        n, r = divmod(n, 62)
        out = _DIGITS[r] + out
    return out.rjust(6, "0").encode() == body[-6:]


def valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return m.end(1) - m.start(1) >= 8
    if kind == "access":
        return m.end() - m.start() >= 16
    return checksum_holds(m[1])


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word.decode(), (kind, len(word)))
    a.make_automaton()
    return a


def find(text: bytes, machine: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) in code points, ordered."""
    found, past = [], dict.fromkeys(KINDS, 0)
    for last, (kind, n) in machine.iter(text.lower().decode("latin-1")):
        start = last + 1 - n
        if start >= past[kind] and (m := PATTERNS[kind].match(text, start)):
            past[kind] = m.end()
            if valid(kind, m):
                found.append((start, kind, m.end()))
    classes = text.translate(_HEX_CLASS)
    at = classes.find(_HEX_KEY)
    while at >= 0:
        end = _HEX.match(text, at).end()
        found.append((at, "hex", end))
        at = classes.find(_HEX_KEY, end)
    found.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    if found and not text.isascii():
        places = sorted({p for s, _, e in found for p in (s, e)})
        points, at, so_far = {}, 0, 0
        for p in places:
            so_far += len(text[at:p].decode())
            points[p], at = so_far, p
        found = [(points[s], kind, points[e]) for s, kind, e in found]
    return found


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans array<struct<kind, first, last>> of every row."""
    span = pa.struct([("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            spans = [[{"kind": k, "first": s, "last": e} for s, k, e in find(t, machine)] for t in to_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), run, f"doc_id {kind}, spans array<struct<kind:string,first:bigint,last:bigint>>")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text)."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["last"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return scan(docs).select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
