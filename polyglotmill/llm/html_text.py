"""HTML extraction (operator 10): two passes of block rules.

The page is read once as tags and text and split into blocks at block-level
tags. Pass one classifies every block by stop-word density, length and link
density; where it lies is evidence beside these. Pass two gives each undecided
block the label of its nearest decided neighbours; in an article it goes only
if they are bad on both sides.

Zones. What lies in menus, headers, footers, sidebars, scripts or hidden
elements is bad by tag or role. A name in a class or id only hints at a bad
zone: the name must end with a bad word, but for words of structure
(`site-footer`, `comment-list`; not `no-sidebar`, `comments-open` or
`share-price`). If nothing is left under all hints, those around an article are
dropped, and then all of them. A form is bad unless it holds an article or most
of the page's long blocks. On a page with an article or main element that holds
text, what lies outside is bad.

Density. Dense blocks of some length are good, link lists are bad, and blocks
that are short, or less dense, stay undecided (less dense ones are bad where
there is no article around them). On a page without a dense block the stop
words are not those of its language; then long blocks with few links are good,
and shorter ones undecided.

Good blocks are joined by two newlines in page order. Character references
are decoded once, white space in a block becomes one space, and nothing else
is changed.

Cases: null or empty html gives an empty text. Unclosed or unknown tags,
unclosed comments, quotes and scripts, and a lone '<' are handled, so any
string is a page, in time in proportion to its length: after a quote that
never ends, quotes up to there don't hide the end of a tag. Equal rows give
equal results. Only page_id, url and html are read, so other columns can't
clash. A page of any length is one row in memory. An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a an and are as at be by for from has he in is it its of on or that the this to was were which with you not but have
    aber als am auch auf aus bei das dem den der des die ein eine einer es für hat im in ist mit nicht sich sie sind und von zu zum zur wie
    au aux avec ce dans de des du elle en est et il la le les leur mais ne nous on ou par pas plus pour que qui sa se son sur un une
    al como con del el ella en entre era es esta este ha las lo los más no o para pero por que se sin su sus un una y""".split()
)
LENGTH_LOW, LENGTH_HIGH = 70, 200
STOP_LOW, STOP_HIGH = 0.20, 0.30
LINKS_HIGH = 0.33

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: These end at the next block tag if they aren't closed.
IMPLIED_END = frozenset("p li dd dt td th tr option h1 h2 h3 h4 h5 h6".split())
BAD_TAGS = frozenset("head title nav footer aside menu dialog button select option textarea datalist iframe object canvas svg noscript template audio video".split())
RAW_TAGS = frozenset("script style xmp noembed noframes".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related recommended respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets masthead alert disclaimer login".split()
)
#: Words that may follow a bad one in a name, and words before it that say that it is not the element itself.
STRUCTURE_WORDS = frozenset(
    "area bar block body bottom box button buttons col column container content count form group header heading holder icon icons inner item items label left link links list main message outer overlay panel post posts right row section slot text title top unit wrap wrapper zone".split()
)
MODIFIERS = frozenset("has have hide is no non not show with without".split())
#: Bad outside an article only; an article's own header holds its title.
BAD_OUTSIDE = frozenset(["header", "topbar"])
#: If one of these is left open, the start of an article ends it.
_LEFT_OPEN = frozenset("head title nav header footer menu form".split())

_TAG_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_TAG_STOP = re.compile(r"[>\"']")
_RAW_END = {name: re.compile(rf"</{name}\b", re.I) for name in RAW_TAGS}
_ROLES = frozenset("@" + r for r in BAD_ROLES)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HINT = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")


@lru_cache(1 << 14)
def _hinted(name: str, bad: frozenset) -> bool:
    """Whether a name, such as post-comments-list, ends with a bad word but for words of structure, and without a modifier before it."""
    words = [w.lower() for w in _NAME.findall(name)]
    while words and words[-1] in STRUCTURE_WORDS and words[-1] not in bad:
        words.pop()
    return bool(words) and words[-1] in bad and not (len(words) > 1 and words[-2] in MODIFIERS)


def _hints(attributes: str) -> set[str]:
    """'bad' or 'outside' by the names in class and id, 'hidden' where the element is not shown; roles with a leading '@'."""
    out: set[str] = set()
    if "=" not in attributes and "hidden" not in attributes:
        return out
    for m in _HINT.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            for x in value.split():
                if _hinted(x, BAD_WORDS):
                    out.add("bad")
                elif _hinted(x, BAD_OUTSIDE):
                    out.add("outside")
        elif name == "role":
            out.add("@" + value.strip().lower())
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I) or name == "aria-hidden" and value.lower() == "true":
            out.add("hidden")
    return out


class Zone(NamedTuple):
    """Where a block lies: bad by tag, hinted at around an article, hinted at within one or without any, in an article, in which form."""

    hard: bool = False
    outer: bool = False
    inner: bool = False
    article: bool = False
    form: int = 0


class Block(NamedTuple):
    text: str
    linked: int
    zone: Zone
    heading: bool


class Page:
    """One pass over the page: blocks with their texts, link characters and zones."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, Zone]] = []
        self.forms, self.around_articles = 0, set()
        self.open: dict[str, int] = {}  # how often each tag is on the stack
        self.text, self.linked, self.links, self.heading = [], 0, 0, False
        self.source, self.last_end, self.plain_until = source, source.rfind(">"), 0
        at = 0
        while at < len(source):
            start = source.find("<", at)
            if start < 0 or start > self.last_end:
                break
            end = self._token(start)
            self._text(source[at:start] if end else source[at : start + 1])
            at = self._act(start, end) if end else start + 1
        self._text(source[at:])
        self._flush()

    def _token(self, start: int) -> int:
        """Where the markup that starts here ends, or 0 if it is text."""
        source = self.source
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            return end + 3 if end >= 0 else len(source)
        if source.startswith("<![CDATA[", start):
            end = source.find("]]>", start + 9)
            return end + 3 if end >= 0 else len(source)
        if source.startswith(("<!", "<?"), start) or start < self.plain_until:
            return source.find(">", start) + 1 if source.startswith(("<!", "<?"), start) or _TAG_NAME.match(source, start + 1) else 0
        if not (name := _TAG_NAME.match(source, start + 1)):
            return 0
        at = name.end()
        while m := _TAG_STOP.search(source, at):
            if m[0] == ">":
                return m.end()
            at = source.find(m[0], m.end()) + 1
            if not at:
                break
        # A quote never ends, or no tag does: from here on to there, the next > ends a tag.
        self.plain_until = m.start() + 1 if m else len(source)
        return source.find(">", start) + 1

    def _act(self, start: int, end: int) -> int:
        """Handles the markup in source[start:end]; where to go on."""
        source = self.source
        if source[start + 1] in "!?":
            if source.startswith("<![CDATA[", start):
                self._text(source[start + 9 : end].removesuffix("]]>"))
            return end
        tag = _TAG_NAME.match(source, start + 1)
        name = tag[2].lower()
        if tag[1]:
            self._close(name)
        elif name in RAW_TAGS:
            close = _RAW_END[name].search(source, end)
            last = source.find(">", close.end()) if close else -1
            return last + 1 if last >= 0 else len(source)
        else:
            self._open(name, source[tag.end() : end - 1])
        return end

    def _pop(self) -> None:
        self.open[self.stack.pop()[0]] -= 1

    def _zone(self) -> Zone:
        return self.stack[-1][1] if self.stack else Zone()

    def _text(self, raw: str) -> None:
        if raw:
            self.text.append(raw)
            if self.links:
                self.linked += len(raw.strip())

    def _flush(self) -> None:
        if self.text:
            joined = " ".join(html.unescape("".join(self.text)).split())
            if joined:
                self.blocks.append(Block(joined, self.linked, self._zone(), self.heading))
        self.text, self.linked = [], 0

    def _open(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text.append(" ")
            return
        if name == "a":
            self.links = 1
        block = name in BLOCK_TAGS
        hints = _hints(attributes) if attributes else set()
        if block:
            self._flush()
            while self.stack and self.stack[-1][0] in IMPLIED_END and (self.stack[-1][0] == "p" or self.stack[-1][0] in _HEADINGS or self.stack[-1][0] == name):
                self._pop()
            self.links = 0
        if name in VOID_TAGS or attributes.endswith("/") and name in ("svg", "path"):
            return
        zone = self._zone()
        if name in ("article", "main") or "@main" in hints or "@article" in hints:
            while self.stack and self.stack[-1][0] in _LEFT_OPEN:
                self._pop()
            zone = self._zone()
            self.around_articles.add(zone.form)
            # What was hinted at so far lies around the article.
            zone = zone._replace(outer=zone.outer or zone.inner or "bad" in hints, inner=False, article=True)
            hints = hints - {"bad"}
        elif name == "body":
            self.stack.clear(), self.open.clear()
            zone = Zone()
        hard = hint = False
        form = 0
        if name not in ("html", "body"):
            hard = name in BAD_TAGS or name == "header" and not zone.article
            if hints:
                hard = hard or "hidden" in hints or not hints.isdisjoint(_ROLES)
                hint = "bad" in hints or "outside" in hints and not zone.article
            if name == "form":
                self.forms += 1
                form = self.forms
        if block or hard or hint or form:
            if not block:
                self._flush()
            if hard or hint or form:
                zone = Zone(zone.hard or hard, zone.outer, zone.inner or hint, zone.article, zone.form or form)
            self.stack.append((name, zone))
            self.open[name] = self.open.get(name, 0) + 1
            self.heading = name in _HEADINGS

    def _close(self, name: str) -> None:
        if name == "a":
            self.links = 0
            return
        if name in BLOCK_TAGS or self.open.get(name):
            self._flush()
            self.heading = False
            if self.open.get(name):
                while self.stack[-1][0] != name:
                    self._pop()
                self._pop()


def stop_density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


class Judged(NamedTuple):
    """A block for the two passes."""

    text: str
    linked: int
    bad: bool
    article: bool
    heading: bool


def _label(block: Judged, in_article: bool, covered: bool) -> str:
    """good, bad, or undecided: near (rather good), short, or low (long, but of low density)."""
    text, linked, bad, article, heading = block
    links, long = linked / max(len(text), 1), len(text) >= LENGTH_HIGH
    if bad or in_article and not article:
        return "bad"
    if links > LINKS_HIGH and not (in_article and (long or heading)):
        return "bad"
    if not in_article and not long and "\N{COPYRIGHT SIGN}" in text:
        return "bad"
    if len(text) < LENGTH_LOW:
        return "bad" if linked and not in_article else "short"
    if not covered:
        return "good" if long else "near"
    stops = stop_density(text)
    if stops >= STOP_HIGH:
        return "good" if long or in_article else "near"
    return "near" if stops >= STOP_LOW else "low" if in_article else "bad"


def stop_words_cover(blocks: list[Judged]) -> bool:
    """Whether the stop words are of the page's language: a block of some length is dense."""
    return any(not b.bad and len(b.text) >= LENGTH_LOW and stop_density(b.text) >= STOP_HIGH for b in blocks)


def decide(blocks: list[Judged]) -> list[bool]:
    """Which blocks are main text."""
    in_article = any(b.article and not b.bad for b in blocks)
    covered = stop_words_cover([b for b in blocks if b.article] if in_article else blocks)
    first = [_label(b, in_article, covered) for b in blocks]
    # In an article only its own blocks count as neighbours, so what lies outside says nothing about it.
    counts = [f in ("good", "bad") and (not in_article or b.article and not b.bad) for f, b in zip(first, blocks)]
    n = len(blocks)
    before, after = [-1] * n, [n] * n
    for i in range(1, n):
        before[i] = i - 1 if counts[i - 1] else before[i - 1]
        after[n - 1 - i] = n - i if counts[n - i] else after[n - i]
    out = []
    for i, label in enumerate(first):
        if label in ("near", "short", "low"):
            heading = blocks[i].heading
            left = first[before[i]] if before[i] >= 0 else None
            right = first[after[i]] if after[i] < n else None
            if in_article:
                label = "bad" if left == right == "bad" and label != "near" and not heading else "good"
            elif left is None and right is None:
                label = "good" if label == "near" else "bad"
            elif left is None or right is None or left == right:
                label = left or right
            elif label == "near" or heading and right == "good":
                label = "good"
            else:
                label = left if i - before[i] < after[i] - i else right
        out.append(label == "good")
    return out


def _content_forms(page: Page) -> set[int]:
    """Forms that are no forms to fill in: they hold an article, or most of the page's long blocks of few links."""
    blocks = page.blocks
    chars: dict[int, int] = {}
    for b in blocks:
        if not b.zone.hard and len(b.text) >= LENGTH_HIGH and b.linked <= LINKS_HIGH * len(b.text):
            chars[b.zone.form] = chars.get(b.zone.form, 0) + len(b.text)
    total = sum(chars.values())
    return {f for f, n in chars.items() if 2 * n > total} | page.around_articles | {0}


def main_blocks(page: Page) -> list[bool]:
    """Which blocks are main text: under all hints, or, if that is nothing, without those around articles, or without any."""
    blocks, forms = page.blocks, _content_forms(page)
    kept = [False] * len(blocks)
    for hinted in (lambda z: z.outer or z.inner, lambda z: z.inner, lambda z: False):
        kept = decide([Judged(b.text, b.linked, b.zone.hard or b.zone.form not in forms or hinted(b.zone), b.zone.article, b.heading) for b in blocks])
        if any(kept):
            break
    return kept


def extract(source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    return "\n\n".join(b.text for b, good in zip(page.blocks, main_blocks(page)) if good)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_arrow(pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")), run, f"page_id {kind}, url string, text string, n_chars long")
