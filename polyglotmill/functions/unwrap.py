"""Removal of list wrappers around a text.

A text may have gone through a list that was turned into a string, several
times over. Two steps take that off again:

1. Layers. A layer is a whole list in brackets; a scanner reads it by the
   grammar below, and its first element is what was wrapped. That may have a
   layer of its own. A list that breaks the grammar only inside its quotes (a
   bare quote or line end) is a loose layer: one quoted string.
2. Edges. What no whole list explains is taken off both ends by token: opening
   tokens and then quotes in front, closing tokens and quotes behind.

    list    = "[" [ element { "," element } [ "," ] ] "]"
    element = string { string } | list | word       (strings side by side are one)
    string  = quote { character | "\\" escape } the same quote, on one line
    word    = a number, true, false or null, in either spelling

An empty list, and an element None or null, stand for an empty text. Texts
without brackets, quotes and backslashes are only stripped, in the JVM; the
others go through a pandas function.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Quotes that may follow an opening bracket or stand before a closing one in a broken wrapper.
OPENING_QUOTES, CLOSING_QUOTES = "'\"‘“«", "'\"’”»"
#: Escapes of one character; \x, \u and \U take digits.
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "a": "\a", "v": "\v", "0": "\0", "\\": "\\", "'": "'", '"': '"', "/": "/", "\n": ""}
_DIGITS = {"x": 2, "u": 4, "U": 8}
_NOTHING = ("None", "null")

_SPACE = re.compile(r"\s*+")
_WORD = re.compile(r"(?:None|null|[Tt]rue|[Ff]alse|[+-]?(?:\d++(?:\.\d*+)?|\.\d++)(?:[eE][+-]?\d++)?)(?![^\s,\]])")
_PLAIN = {q: re.compile(rf"[^{q}\\\n]*+") for q in "'\""}
_HEAD = re.compile(rf"\s*+(?:\[[{OPENING_QUOTES}]?\s*+)*+(?:['\"\\]\s*+)*+")
#: Begins only where no run of its tokens is under way, so that it looks at each character once.
_TAIL = re.compile(rf"(?<![\s'\"\]])\s*+(?:(?:[{CLOSING_QUOTES}]?\]|['\"])\s*+)*+\Z")


class _Broken(ValueError):
    pass


class _Scanner:
    """Reads one list; `list` gives the first element of it, None if there is none."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def _spaces(self) -> str:
        """Skip white space; the character after it, nothing at the end."""
        self.at = _SPACE.match(self.text, self.at).end()
        return self.text[self.at : self.at + 1]

    def _string(self) -> str:
        quote, out = self.text[self.at], []
        self.at += 1
        while True:
            plain = _PLAIN[quote].match(self.text, self.at)
            out.append(plain[0])
            self.at = plain.end()
            mark = self.text[self.at : self.at + 1]
            if mark == quote:
                self.at += 1
                return "".join(out)
            if mark != "\\":
                raise _Broken  # the end of a line or of the text
            out.append(self._escaped())

    def _escaped(self) -> str:
        kind = self.text[self.at + 1 : self.at + 2]
        if kind in _DIGITS:
            digits = self.text[self.at + 2 : self.at + 2 + _DIGITS[kind]]
            self.at += 2 + len(digits)
            try:
                code = int(digits, 16)
                if 0xD800 <= code < 0xDC00 and self.text.startswith("\\u", self.at):  # the first half of a pair
                    code = 0x10000 + (code - 0xD800) * 0x400 + int(self.text[self.at + 2 : self.at + 6], 16) - 0xDC00
                    self.at += 6
                return chr(code)
            except (ValueError, OverflowError):
                raise _Broken from None
        if not kind:
            raise _Broken
        self.at += 2
        return ESCAPES.get(kind, "\\" + kind)

    def _element(self):
        """A string, a list's first element, or a word that stands for itself."""
        mark = self.text[self.at]
        if mark == "[":
            return self.list()
        if mark in "'\"":
            out = self._string()
            while self._spaces() in ("'", '"'):
                out += self._string()
            return out
        word = _WORD.match(self.text, self.at)
        if word is None:
            raise _Broken
        self.at = word.end()
        return "" if word[0] in _NOTHING else word[0]

    def list(self):
        self.at += 1
        first, n = "", 0
        while self._spaces() != "]":
            found = self._element() if self.at < len(self.text) else None
            if found is None:
                raise _Broken
            first, n = (found, 1) if n == 0 else (first, n + 1)
            mark = self._spaces()
            if mark == ",":
                self.at += 1
            elif mark != "]":
                raise _Broken
        self.at += 1
        return first


def inside(text: str) -> str | None:
    """What a layer wraps; None if the text is no layer."""
    if not (text.startswith("[") and text.endswith("]")):
        return None
    scanner = _Scanner(text)
    try:
        found = scanner.list()
        if scanner.at == len(text):
            return found.strip()
    except (_Broken, RecursionError):
        pass
    loose = text[1:-1].strip()
    return loose[1:-1].strip() if len(loose) > 1 and loose[0] == loose[-1] and loose[0] in "'\"" else None


def unwrap(text: str | None) -> str:
    now = (text or "").strip()
    while (found := inside(now)) is not None:  # each layer is shorter than the one around it
        now = found
    now = now[_HEAD.match(now).end() :]
    end = _TAIL.search(now)
    now = now[: end.start()] if end else now
    return now.replace('\\"', '"').replace("\\'", "'").strip()


def unwrap_text(text: Column) -> Column:
    """Null gives an empty text. A text without brackets, quotes and backslashes is only stripped."""

    def texts(batch: pd.Series) -> pd.Series:
        return batch.map(unwrap)

    slow = F.pandas_udf(texts, StringType())
    plain = ~F.coalesce(text, F.lit("")).rlike(r"[\[\]\\]|^\s*[\"']|[\"']\s*$")
    return F.when(plain, F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\A\s+|\s+\z", "")).otherwise(slow(F.when(~plain, text)))
