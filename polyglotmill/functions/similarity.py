"""Similarity: chrF, cosine of arrays, a stop-word language score."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ORDERS = 6
_SPACES = np.array([9, 10, 11, 12, 13, 32], dtype=np.uint32)


def _codes(text: str) -> np.ndarray:
    """Code points without white space."""
    found = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return found[~np.isin(found, _SPACES)].astype(np.int64)


def _packed(codes: np.ndarray, order: int) -> np.ndarray:
    """Grams of up to three code points in one number each: three times 21 bits."""
    n = max(len(codes) - order + 1, 0)
    out = np.zeros(n, dtype=np.int64)
    for k in range(order):
        out = (out << 21) | codes[k : k + n]
    return out


def _found(numbers: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each number among the sorted known ones, -1 if it is none of them."""
    if not len(known):
        return np.full(len(numbers), -1)
    at = np.searchsorted(known, numbers).clip(max=len(known) - 1)
    return np.where(known[at] == numbers, at, -1)


class Reference:
    """The grams of a reference with their counts. Longer grams are pairs of the numbers of their first and last three characters."""

    def __init__(self, text: str):
        self.codes = _codes(text)
        self.grams, threes = [], None
        for order in range(1, ORDERS + 1):
            numbers = _packed(self.codes, order) if order <= 3 else self._pairs(threes, order)
            self.grams.append(np.unique(numbers, return_counts=True))
            if order == 3:
                threes = _found(numbers, self.grams[2][0])

    def _pairs(self, threes: np.ndarray, order: int) -> np.ndarray:
        """Of the numbers of grams of three; -1 where one is not a gram of the reference."""
        n = max(len(threes) - order + 3, 0)
        first, last = threes[:n], threes[order - 3 :][:n]
        return np.where((first < 0) | (last < 0), -1, first * len(self.grams[2][0]) + last)

    def score(self, candidate: str) -> float:
        codes = _codes(candidate)
        precision = recall = 0.0
        used, threes = 0, None
        for order in range(1, ORDERS + 1):
            mine, other = len(codes) - order + 1, len(self.codes) - order + 1
            if mine < 1 or other < 1:
                break
            known, counts = self.grams[order - 1]
            numbers = _packed(codes, order) if order <= 3 else self._pairs(threes, order)
            at = _found(numbers, known)
            if order == 3:
                threes = at
            both = float(np.minimum(np.bincount(at[at >= 0], minlength=len(known)), counts).sum())
            precision, recall, used = precision + both / mine, recall + both / other, used + 1
        if not used or precision + recall == 0:
            return 0.0
        p, q = precision / used, recall / used
        return 500 * p * q / (4 * p + q)


def chrf_pair(candidate: str, reference: str) -> float:
    """Character n-grams of orders 1 to 6 without white space, beta 2, averaged over orders that both sides have. Grams are compared exactly."""
    return Reference(reference).score(candidate)


#: References that a worker keeps; a pair whose reference is gone is only slower.
KEPT = 1024


def chrf(candidate: Column, reference: Column) -> Column:
    """chrF of two whole texts, null as empty. An Arrow function of one row: grams as rows would shuffle six rows for every character."""

    @F.pandas_udf("double")
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        kept = lru_cache(KEPT)(Reference)
        return pd.Series([kept(y).score(x) for x, y in zip(a, b)], dtype="float64")

    return scored(F.coalesce(candidate, F.lit("")), F.coalesce(reference, F.lit("")))


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    size = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(size > 0, size, 1.0)[:, None]


def matched(candidate, reference) -> tuple[float, float, float]:
    """(precision, recall, F1) of a soft alignment: each vector takes the other side's one of the best cosine."""
    if candidate is None or reference is None or not len(candidate) or not len(reference):
        return 0.0, 0.0, 0.0
    cosines = _unit(candidate) @ _unit(reference).T
    p, r = float(cosines.max(axis=1).mean()), float(cosines.max(axis=0).mean())
    return p, r, 2 * p * r / (p + r) if p + r > 0 else 0.0


def token_match(candidate: Column, reference: Column) -> Column:
    """precision, recall and f1 of two arrays of token vectors. Null or empty arrays score 0, and so does a zero vector with any other."""

    @F.pandas_udf("precision double, recall double, f1 double")
    def scored(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([matched(x, y) for x, y in zip(a, b)], columns=["precision", "recall", "f1"])

    return scored(candidate, reference)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


#: Frequent words by language.
FREQUENT = {
    "de": "der|die|das|und|ist|nicht|mit|für|von|ein|eine|zu|den|auf",
    "en": "the|of|and|to|in|is|that|for|with|was|on|are|this|it",
    "es": "el|la|de|que|los|las|por|con|una|para|del|se|y|en",
    "fr": "le|la|les|de|des|et|est|que|dans|pour|une|sur|qui|du",
}


def language_score(clean: Column, lang: str) -> Column:
    """Frequent words of the language in a text as `cleaned` leaves it."""
    return F.regexp_count(clean, F.lit(f" (?:{FREQUENT[lang]}) ")).cast("long")


def cleaned(text: Column) -> Column:
    """Lower-cased words with two spaces around each."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^a-zß-ÿ]+", "  "), F.lit(" "))


def language(text: Column) -> Column:
    """The language of the largest score; the first by name if scores tie. The text is cleaned once, and each language scored once."""
    langs = sorted(FREQUENT)

    def scores(clean: Column) -> Column:
        # The largest score, and of equal ones the first name: the order of an array of (-score, name).
        return F.array_min(F.array(*[F.struct((-language_score(clean, x)).alias("less"), F.lit(x).alias("lang")) for x in langs]))["lang"]

    return F.get(F.transform(F.array(cleaned(text)), scores), F.lit(0))
