"""Language ID (operator 9): nearest of several TF-IDF n-gram centroids per language.

Texts become bytes with A-Z lower-cased and other ASCII non-letters as spaces;
their 2-, 3- and 4-byte grams are hashed to DIMS features, weighted by
ln(1 + tf) * idf and scaled to length one. Each language has up to CENTROIDS
spherical k-means centroids: they start from equal parts of the bulk of its
rows along the direction in which these differ most, and a cluster of few rows
is given up. The nearest centroid by cosine names the language; the score is
that cosine.

Rejection is by distance, and short texts lie farther away than long ones. So
each language has a floor for each length class (powers of two of the cleaned
text's bytes): REJECT_SHARE of the FLOOR_QUANTILE of the cosines of snippets of
that length (SHORT_SHARE for short classes), cut from rows that the centroids were not fitted on. A text below
the floor of the language it is nearest to is rejected. Floors never fall as
the length grows; texts of a word or a few (32 bytes or less) have none.

Fitting uses at most `fit_rows` labelled rows, an equal bound for each
language, drawn by a hash of doc_id and text; equal draws count once, and each
language gets one at least. This bounds what the driver holds. With no labelled
row, every text is `und`. Prediction reads every whole text and nothing but the
text.

Cases: null text, or text without a letter, is `und` with score 0, rejected.
Rows with a null lang are not learned from; a null doc_id is like any other.
Equal cosines go to the language that sorts first. Rows that repeat are judged
alike. Empty tables give no rows. Very long texts are counted in pieces of
PIECE bytes beside one translated copy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, sized, to_bytes

DIMS = 1 << 12
CENTROIDS = 3
FIT_ROWS = 4_000
#: A text is rejected if its cosine is below this share of that quantile of held-back snippets of its length;
#: classes before LONG_CLASS (256 bytes or less) vary more, and have the smaller share.
REJECT_SHARE, SHORT_SHARE, FLOOR_QUANTILE, LONG_CLASS = 0.6, 0.4, 0.1, 5
#: One row of so many is held back from the centroids, for the floors.
HELD_BACK = 8
#: Length classes: up to 16 bytes, up to 32, and so on; the last has no upper end.
FIRST_CLASS, CLASSES = 16, 9
#: Shorter classes than this one are too short to be judged by distance.
FIRST_JUDGED = 2
#: The least share of a language's rows that a centroid stands for.
LEAST_SHARE = 0.05
PIECE = 1 << 20

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def cleaned(text: bytes) -> Iterator[bytes]:
    """Pieces of the cleaned text; each ends with a space, and the first starts with one."""
    plain, at = text.translate(_LETTERS), 0
    yield b" "
    while at < len(plain):
        end = plain.find(b" ", at + PIECE) if len(plain) - at > PIECE else len(plain)
        end = len(plain) if end < 0 else end
        if words := plain[at:end].split():
            yield b" ".join(words) + b" "
        at = end


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (len(texts), DIMS) of hashed byte grams, each text set between spaces, and the length of each cleaned text."""
    out, sizes = np.zeros((len(texts), DIMS), dtype=np.float32), np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        row, before = np.zeros(DIMS, dtype=np.int64), b""
        for piece in cleaned(text):
            raw = np.frombuffer(before + piece, dtype=np.uint8).astype(np.uint32)
            for n in (2, 3, 4):
                # Grams that end in this piece.
                raw_n = raw[max(0, len(before) - n + 1) :]
                if len(raw_n) >= n:
                    code = raw_n[: len(raw_n) - n + 1].copy()
                    for j in range(1, n):
                        code *= np.uint32(0x01000193)
                        code ^= raw_n[j : len(raw_n) - n + 1 + j]
                    code = (code * np.uint32(0x9E3779B1) + np.uint32(n * 0x05EBCA6B)) >> np.uint32(20)
                    row += np.bincount(code, minlength=DIMS)
            sizes[i] += len(piece)
            before = (before + piece)[-3:]
        out[i] = row
    return out, sizes


def length_class(sizes: np.ndarray) -> np.ndarray:
    return np.clip(np.ceil(np.log2(np.maximum(sizes, 1) / FIRST_CLASS)), 0, CLASSES - 1).astype(np.int64)


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts)
    x *= idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x /= np.where(norm > 0, norm, 1)
    return x


@dataclass
class Model:
    languages: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray  # language, length class

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row, the language's number and the cosine."""
        cosines = unit(counts, self.idf) @ self.centroids.T
        best = np.argmax(cosines, axis=1)
        return self.owner[best], np.clip(cosines[np.arange(len(best)), best].astype(float), 0.0, 1.0)


def _scaled(c: np.ndarray) -> np.ndarray:
    return c / np.maximum(np.linalg.norm(c, axis=-1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int, turns: int = 12) -> np.ndarray:
    """Spherical k-means over unit rows: up to k centroids, each of LEAST_SHARE of the rows or more."""
    mean = _scaled(x.mean(axis=0))
    near = x @ mean
    bulk = x[near >= np.quantile(near, 0.1)]
    centred = bulk - bulk.mean(axis=0)
    axis = np.square(centred).mean(axis=0)
    for _ in range(20):  # the direction in which the bulk differs most
        axis = _scaled(centred.T @ (centred @ axis) + 1e-12)
    order = np.argsort(bulk @ axis, kind="stable")
    c = _scaled(np.array([bulk[part].mean(axis=0) for part in np.array_split(order, min(k, len(bulk)))]))
    for _ in range(turns):
        at = np.argmax(x @ c.T, axis=1)
        enough = [j for j in range(len(c)) if (at == j).sum() >= max(1, LEAST_SHARE * len(x))]
        new = _scaled(np.array([x[at == j].mean(axis=0) for j in enough]))
        if len(new) == len(c) and np.allclose(new, c, atol=1e-5):
            break
        c = new
    return c.astype(np.float32)


def snippets(text: bytes) -> Iterator[bytes]:
    """Starts of the text, cut between words, of about each length class; the text itself if it is longer than all."""
    for k in range(CLASSES - 1):
        size = FIRST_CLASS << k
        if len(text) <= size:
            return
        cut = text.rfind(b" ", size // 2, size)
        yield text[: cut if cut > 0 else size]
    yield text


def _packed(counts: np.ndarray) -> bytes:
    some = np.flatnonzero(counts)
    return some.astype(np.uint16).tobytes() + np.minimum(counts[some], 65535).astype(np.uint16).tobytes()


def _unpacked(rows: list[bytes]) -> np.ndarray:
    out = np.zeros((len(rows), DIMS), dtype=np.float32)
    for i, row in enumerate(rows):
        half = np.frombuffer(row, dtype=np.uint16).reshape(2, -1)
        out[i, half[0]] = half[1]
    return out


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS) -> Model:
    """Fit on labelled rows (doc_id, text, lang); at most fit_rows of them, and snippets of one in HELD_BACK, reach the driver, as counts."""
    labelled = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.xxhash64(F.lit("fit"), F.col("doc_id").cast("string"), F.col("text").cast("string")).alias("hash")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r for r in labelled.groupBy("lang").agg(F.count("*").alias("n"), F.min("hash").alias("low")).orderBy(F.desc("n"), "lang").limit(fit_rows).collect()}
    if not sizes:
        return Model([], np.zeros(0, int), np.zeros((0, DIMS), np.float32), np.ones(DIMS, np.float32), np.zeros((0, CLASSES)))
    each = max(1, fit_rows // len(sizes))
    # Expected size 0.9 of the bound; the limit below makes the bound hold always.
    upto = {lang: max(r["low"], min(int(0.9 * each / r["n"] * 2.0**64) - 2**63, 2**63 - 1)) for lang, r in sizes.items()}
    share = F.create_map(*[x for lang, most in upto.items() for x in (F.lit(lang), F.lit(most).cast("long"))])
    drawn = labelled.where(F.col("hash") <= share[F.col("lang")]).dropDuplicates(["lang", "hash"]).limit(fit_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(to_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist())
            for group in sized(rows, lambda r: len(r[0]) + DIMS, 1 << 21):
                texts, langs, marks, whole = [], [], [], []
                for text, lang, mark in group:
                    for k, piece in enumerate([text, *(snippets(text) if mark % HELD_BACK == 0 else ())]):
                        texts.append(piece), langs.append(lang), marks.append(mark), whole.append(k == 0)
                counts, lengths = gram_counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(marks, pa.int64()), pa.array(whole, pa.bool_()), pa.array(lengths), pa.array([_packed(c) for c in counts], pa.binary())], ["lang", "hash", "whole", "size", "counts"]
                )

    rows = map_arrow(drawn.select("text", "lang", "hash"), count, "lang string, hash long, whole boolean, size long, counts binary").collect()
    # The order of collected rows may differ from run to run; sorting makes the fit repeatable.
    rows = sorted(map(tuple, rows))
    languages = sorted({r[0] for r in rows})
    whole = [r for r in rows if r[2]]
    held = {lang: sum(r[0] == lang and r[1] % HELD_BACK != 0 for r in whole) >= 8 for lang in languages}
    # A language of few rows is fitted on all of them.
    own = [r for r in whole if not held[r[0]] or r[1] % HELD_BACK != 0]
    # One language at a time is unpacked, so the driver holds few dense rows.
    often = np.zeros(DIMS)
    for r in own:
        often[np.frombuffer(r[4], dtype=np.uint16).reshape(2, -1)[0]] += 1
    idf = (np.log((1 + len(own)) / (1 + often)) + 1).astype(np.float32)
    owner, found, floor = [], [], np.zeros((len(languages), CLASSES))
    for k, lang in enumerate(languages):
        c = cluster(unit(_unpacked([r[4] for r in own if r[0] == lang]), idf), centroids)
        owner += [k] * len(c)
        found.append(c)
        tests = [r for r in rows if r[0] == lang and not r[2]] or [r for r in whole if r[0] == lang]
        at = length_class(np.array([r[3] for r in tests]))
        for j in range(FIRST_JUDGED, CLASSES):
            here = [r[4] for r, kind in zip(tests, at) if kind == j]
            last = floor[k, j - 1]
            floor[k, j] = last
            if len(here) >= 5:
                cosines = (unit(_unpacked(here), idf) @ c.T).max(axis=1)
                floor[k, j] = max(last, (REJECT_SHARE if j >= LONG_CLASS else SHORT_SHARE) * float(np.quantile(cosines, FLOOR_QUANTILE)))
    return Model(languages, np.array(owner, int), np.concatenate(found), idf, floor)


def _judge(model: Model, texts: list[str | None], raw: list[bytes]) -> Iterator[tuple[str, float, bool]]:
    for group in sized(zip(texts, raw), lambda p: len(p[1]) + DIMS, 1 << 21):
        if model.languages:
            counts, sizes = gram_counts([b for _, b in group])
            (at, score), kind = model.nearest(counts), length_class(sizes)
        for i, (text, _) in enumerate(group):
            if not model.languages or not has_letter(text):
                yield "und", 0.0, True
            else:
                yield model.languages[at[i]], float(score[i]), bool(score[i] < model.floor[at[i], kind[i]])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_judge(shared.value, batch.column(1).to_pylist(), to_bytes(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model, name: bool = False) -> DataFrame:
    """The documents that are not rejected, with their columns as they are; `name` puts the predicted language into lang."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")
    lang = docs.columns.index("lang") if name else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_judge(shared.value, batch.column(at).to_pylist(), to_bytes(batch.column(at))))
            if lang is not None:
                batch = batch.set_column(lang, batch.schema.field(lang), pa.array([f[0] for f in found], batch.schema.field(lang).type))
            yield batch.filter(pa.array([not f[2] for f in found], pa.bool_()))

    return map_arrow(docs, run, docs.schema)
