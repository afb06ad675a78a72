"""Vectorised words, word hashes and word shingles over UTF-8 bytes.

Words are runs of bytes 0-9, a-z and >= 0x80 after A-Z are lower-cased: in code
points, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
"""

from __future__ import annotations

import numpy as np

#: Lower-cases A-Z and turns every byte that is not part of a word into a space.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, dtype=np.uint64))
#: Long texts are hashed in pieces of about so many bytes, cut between words.
PIECE = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


def _hashes(clean: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of a translated buffer: the start offset and the hash of each word."""
    raw = np.frombuffer(clean, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=bool)
    np.not_equal(raw, 32, out=inside[1:-1])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(~inside[1:] & inside[:-1])
    if not len(starts):
        return starts, np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    where = np.flatnonzero(inside[1:-1])
    first = np.cumsum(lengths) - lengths
    place = (where - np.repeat(starts, lengths)) & 0xFFFF
    terms = (raw[where].astype(np.uint64) + np.uint64(1)) * _POWERS[place]
    return starts, mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the offsets (len(texts) + 1) of each text's words."""
    parts, counts = [], np.zeros(len(texts) + 1, dtype=np.int64)
    if sum(map(len, texts)) <= 2 * PIECE:
        clean = b" ".join(texts).translate(WORD_TABLE)
        starts, found = _hashes(clean)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        return found, np.searchsorted(starts, begin)
    for i, text in enumerate(texts):
        clean, at = text.translate(WORD_TABLE), 0
        while at < len(clean):
            end = len(clean) if len(clean) - at <= PIECE else clean.find(b" ", at + PIECE)
            end = len(clean) if end < 0 else end
            parts.append(_hashes(clean[at:end])[1])
            counts[i + 1] += len(parts[-1])
            at = end
    return np.concatenate(parts or [np.empty(0, dtype=np.uint64)]), np.cumsum(counts)


def sequence_keys(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each text's whole word sequence, as signed integers."""
    counts = np.diff(offsets)
    place = np.arange(len(hashes)) - np.repeat(offsets[:-1], counts)
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        terms = mix(hashes ^ np.uint64(salt)) * mix(place.astype(np.uint64) * np.uint64(salt) + np.uint64(salt))
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)])
        out.append(mix(total[offsets[1:]] - total[offsets[:-1]] + counts.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text: (text index, 48-bit hash, count), sorted by text and hash.

    A text of fewer than n words, but not none, has one shingle of all its words.
    At most 65,536 texts a call.
    """
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    total = np.zeros(max(len(hashes) - n + 1, 0), dtype=np.uint64)
    for j in range(n):
        total += mix(hashes[j : j + len(total)] + np.uint64(j)) * np.uint64(2 * j + 0x51ED2701)
    keep = owner[: len(total)] == owner[n - 1 :][: len(total)] if len(total) else np.empty(0, dtype=bool)
    found, of = mix(total[keep]), owner[: len(total)][keep]
    short = [(i, np.uint64(k)) for i, k in enumerate(counts) if 0 < k < n]
    if short:
        more = [mix(np.cumsum(mix(hashes[offsets[i] : offsets[i + 1]]) * (np.arange(1, int(k) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))[-1:] + k)[0] for i, k in short]
        found, of = np.concatenate([found, np.array(more, dtype=np.uint64)]), np.concatenate([of, np.array([i for i, _ in short])])
    packed = np.sort((of.astype(np.uint64) << np.uint64(48)) | (found >> np.uint64(16)))
    first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else np.empty(0, dtype=np.int64)
    distinct = packed[first]
    tf = np.diff(np.concatenate([first, [len(packed)]]))
    return (distinct >> np.uint64(48)).astype(np.int64), distinct & np.uint64((1 << 48) - 1), tf
