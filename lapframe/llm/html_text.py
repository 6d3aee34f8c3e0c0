"""Main text of pages by the maximum-scoring subsequence.

A page is read as a row of words and tags. A word scores one; a tag scores a negative weight that is
learned from labelled pages: how much more often, for a word, the tag stands outside articles
than inside. A linear scan finds the contiguous region with the best sum. The labelled
pages also tell which elements (by name, class, id or role) never hold article text: words in
them score nothing and are left out of the text, unless such an element wraps the article (``has-sidebar``, a
form around the page): if the best region within one, without the furniture inside it, beats that of the rest of the
page, it and what it stands in are shown. The region is then fitted to the smallest
article or main element that holds most of its words, so that short first and last blocks stay.

Text is decoded, white space in a block becomes one space, and blocks are joined by line breaks.
One pass over the pages, no shuffle. A null page counts as empty and has an empty text; equal rows get
equal texts; an empty table gives an empty one. The time of a page grows with its length, also where tags stay open, end tags are
stray, or quotes do not close. Other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.llm.labelled_pages import CLOSE, OPEN, PAGES

#: Fixed values of the HTML standard: elements that hold raw text, that have no content, that start a block.
RAW = "script style textarea title xmp iframe noembed noframes".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: What ends an open paragraph.
ENDS_P = BLOCKS - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "legend", "body", "html", "head"}
WHOLE = frozenset(("article", "main"))
#: What an item or a cell may stand in, so that an open one outside it stays open.
HOLDS_ITEMS = ("ul", "ol", "dl", "menu", "table", "div", "article", "section", "select")

_RAW = re.compile(rf"<({'|'.join(RAW)})\b", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_EDGE = re.compile("[>\"']")
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")

#: An element all of whose names are those of furniture wraps the article if its region is so many times the rest's.
PLAIN_FURNITURE = 9

#: Weight of a tag that no labelled page has, and the bounds of learned ones.
UNKNOWN, LEAST, MOST = -0.5, -0.05, -4.0


def marks(tag: str, rest: str) -> list[str]:
    """An element's name, and the words of its class, id and role after a dot."""
    out = [tag]
    for found in _MARK.findall(rest):
        out += ["." + w for w in _NAME.findall("".join(found).lower())]
    return out


@dataclass
class Weights:
    """Tag weights, and the marks of elements without article text."""

    tags: dict[str, float]
    outside: frozenset[str]


def tokens(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Begin, end, kind (``open``, ``close``, ``raw`` or ``other``), name and attributes of every tag and comment.

    A tag ends at the first ``>`` outside quotes, or at the first of all if quotes stay open. Time grows with the page,
    however broken it is: places from which no tag can end are remembered.
    """
    n, at, edge, mark, dead = len(source), 0, -1, -1, set()

    def ends(p: int) -> int:
        """The first ``>`` outside quotes from ``p`` on, or -1."""
        nonlocal edge
        if edge < p:
            found = _EDGE.search(source, p)
            edge = found.start() if found else n
        q, seen = edge, []
        while q < n and q not in dead:
            if source[q] == ">":
                return q
            seen.append(q)
            closing = source.find(source[q], q + 1)
            found = _EDGE.search(source, closing + 1) if closing >= 0 else None
            q = found.start() if found else n
        dead.update(seen)
        return -1

    while (lt := source.find("<", at)) >= 0:
        at = lt + 1
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = end + 3 if end >= 0 else n
            yield lt, at, "other", "", ""
            continue
        if mark < lt:
            mark = source.find(">", lt)
            if mark < 0:
                mark = n
        if mark == n:  # no tag ends from here on; a comment may still begin
            at = source.find("<!--", lt)
            if at < 0:
                return
            continue
        raw = _RAW.match(source, lt)
        if raw and (gt := ends(raw.end())) >= 0:
            name = raw[1].lower()
            found = _RAW_END[name].search(source, gt + 1)
            at = found.end() if found else n
            yield lt, at, "raw", name, ""
        elif tag := _TAG.match(source, lt):
            gt = ends(tag.end())
            if gt < 0:
                gt = source.find(">", tag.end())
            at = gt + 1
            yield lt, at, "close" if tag[1] else "open", tag[2].lower(), source[tag.end() : gt]
        elif source[lt + 1 : lt + 2] in ("!", "?"):
            at = mark + 1
            yield lt, at, "other", "", ""


_ZEROS, _TOO_LARGE = re.compile("&#0+(?=[0-9])"), re.compile("&#[0-9]{8,};?")


def decoded(raw: str) -> str:
    """Text with its character references decoded; numbers beyond all characters give the replacement character."""
    return html.unescape(_TOO_LARGE.sub("\ufffd", _ZEROS.sub("&#", raw))) if "&" in raw else raw


class Page:
    """A page's tokens: ``texts`` by place, ``score`` of each place, ``block`` of each place."""

    def __init__(self, source: str, weights: Weights | None):
        self.texts: dict[int, str] = {}
        self.dropped: set[int] = set()
        self.scores: list[float] = []
        self.blocks: list[int] = []
        self.tags: list[tuple[int, str]] = []
        self.elements: list[tuple[int, int, list[str]]] = []
        self.labels: list[tuple[int, bool]] = []
        self._weights, self._block = weights, 0
        self._stack: list[tuple[str, int, int, list[str]]] = []
        # Where each name is open in the stack, and the innermost block at or below each place of the stack.
        self._open_at: dict[str, list[int]] = defaultdict(list)
        self._blocks_at: list[int] = []
        # Elements that look like furniture: the one each stands in, how much its region must beat the rest's, and the
        # innermost of each place; 0 is the page.
        self._within, self._factor, self._places, self._owner = [0], [0.0], [], 0
        at = 0
        for begin, end, kind, name, rest in tokens(source):
            if begin > at:
                self._text(source[at:begin])
            at = end
            if kind == "open":
                self._open(name, rest)
            elif kind == "close":
                self._close(name)
            elif kind == "raw":
                self._place(name)
            elif source[begin:end] in (OPEN, CLOSE):
                self.labels.append((len(self.scores), source[begin:end] == OPEN))
        if at < len(source):
            self._text(source[at:])
        while self._stack:
            self._pop()
        shown = self._shown()
        for place in self.texts:
            if self._places[place] not in shown:
                self.dropped.add(place)
                self.scores[place] = 0.0

    def _shown(self) -> set[int]:
        """The page, and the element that wraps the article with all that it stands in."""
        best, total = [0.0] * len(self._within), [0.0] * len(self._within)
        for owner, score in zip(self._places, self.scores):
            total[owner] = max(total[owner], 0.0) + score
            best[owner] = max(best[owner], total[owner])
        found = [(best[k], -k) for k in range(1, len(best)) if best[k] > self._factor[k] * best[0]]
        shown, k = {0}, -max(found)[1] if found else 0
        while k:
            shown.add(k)
            k = self._within[k]
        return shown

    def _place(self, tag: str) -> None:
        if tag in BLOCKS:
            self._block += 1
        self.tags.append((len(self.scores), tag))
        self.scores.append(self._weights.tags.get(tag, UNKNOWN) if self._weights else 0.0)
        self.blocks.append(self._block)
        self._places.append(self._owner)

    def _text(self, raw: str) -> None:
        raw, place = decoded(raw), len(self.scores)
        self.texts[place] = raw
        self.scores.append(float(len(raw.split())))
        self.blocks.append(self._block)
        self._places.append(self._owner)

    def _open(self, tag: str, rest: str) -> None:
        if tag in ENDS_P:
            self._end_paragraph()
        elif tag in ("td", "th", "tr", "option"):
            self._end_sibling(tag)
        if tag in ("li", "dt", "dd"):
            self._end_sibling(tag)
        self._place(tag)
        if tag in VOID or rest.rstrip().endswith("/") and tag not in BLOCKS:
            return
        own = marks(tag, rest)
        self._open_at[tag].append(len(self._stack))
        self._blocks_at.append(len(self._stack) if tag in BLOCKS else self._blocks_at[-1] if self._stack else -1)
        self._stack.append((tag, len(self.scores) - 1, self._owner, own))
        if tag in WHOLE:  # what holds an article may be a wrapper, whatever it is called
            k = self._owner
            while k and self._factor[k] > 1:
                self._factor[k] = 1.0
                k = self._within[k]
        elif self._weights and self._is_outside(tag, own, len(self._stack) - 1):
            self._within.append(self._owner)
            self._factor.append(self._wrapper_factor(tag, own))
            self._owner = len(self._within) - 1

    def _wrapper_factor(self, tag: str, own: list[str]) -> float:
        """How many times the rest's region an element's must be, so that the element is no furniture: never for ``nav`` and the like."""
        if tag != "form" and tag in self._weights.outside or tag == "header":
            return math.inf
        return PLAIN_FURNITURE if own[1:] and self._weights.outside.issuperset(own[1:]) else 1.0

    def _is_outside(self, tag: str, own: list[str], depth: int) -> bool:
        """A page's or an article's own element is never furniture, whatever it is called; a header near the top is."""
        if tag in ("html", "body", *WHOLE):
            return False
        if tag == "header" and depth <= 3 and not any(e[0] in WHOLE for e in self._stack):
            return True
        return not self._weights.outside.isdisjoint(own)

    def _end_paragraph(self) -> None:
        i = self._blocks_at[-1] if self._stack else -1
        if i >= 0 and self._stack[i][0] == "p":
            self._pop_to(i)

    def _end_sibling(self, tag: str) -> None:
        same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
        i = self._innermost(same)
        if i >= 0 and i > self._innermost(HOLDS_ITEMS if tag == "tr" else (*HOLDS_ITEMS, "tr")):
            self._pop_to(i)

    def _innermost(self, names: Iterable[str]) -> int:
        return max((self._open_at[x][-1] for x in names if self._open_at.get(x)), default=-1)

    def _pop_to(self, i: int) -> None:
        while len(self._stack) > i:
            self._pop()

    def _pop(self) -> None:
        tag, place, self._owner, own = self._stack.pop()
        self._open_at[tag].pop()
        self._blocks_at.pop()
        self.elements.append((place, len(self.scores), own))

    def _close(self, tag: str) -> None:
        i = self._innermost((tag,))
        if i >= 0:
            self._pop_to(i + 1)
            self._place(tag)
            self._pop()
        elif tag in BLOCKS:
            self._place(tag)

    def region(self) -> tuple[int, int]:
        """The contiguous places with the best sum of scores, the first and longest of equals."""
        best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
        for i, s in enumerate(self.scores):
            if total <= 0 and s > 0:
                total, start = 0.0, i
            total += s
            if total > best:
                best, begin, end = total, start, i + 1
        return begin, end

    def fitted(self, begin: int, end: int) -> tuple[int, int]:
        """The smallest article or main element with most of the region's words, or the region."""
        words = [0.0]
        for s in self.scores:
            words.append(words[-1] + max(s, 0.0))
        need = 0.8 * (words[end] - words[begin])
        held = [(b - a, a, b) for a, b, own in self.elements if own[0] in WHOLE and words[min(b, end)] - words[max(a, begin)] >= need and min(b, end) > max(a, begin)]
        if held and need > 0:
            _, begin, end = min(held)
        elif need > 0:  # a title right before the region belongs to it
            title = max((a for a, b, own in self.elements if own[0] == "h1" and b <= begin), default=None)
            after = max((b for a, b, _ in self.elements if a == title), default=0)
            if title is not None and all(p in self.dropped or not t.strip() for p, t in self.texts.items() if after <= p < begin):
                begin = title
        return begin, end

    def text(self, begin: int, end: int) -> str:
        parts: list[list[str]] = []
        block, breaks = None, {p for p, t in self.tags if t == "br"}
        for place in range(begin, end):
            if place in self.texts and place not in self.dropped:
                if self.blocks[place] != block:
                    parts.append([])
                    block = self.blocks[place]
                parts[-1].append(self.texts[place])
            elif parts and place in breaks:
                parts[-1].append(" ")
        lines = (" ".join("".join(p).split()) for p in parts)
        return "\n".join(x for x in lines if x)


def learn(pages: Iterable[str] = PAGES) -> Weights:
    """Weights from labelled pages; an article stands between two marks."""
    inside, outside, words = Counter(), Counter(), [0, 0]
    holds, free = Counter(), Counter()
    for source in pages:
        page = Page(source, None)
        begin = next(p for p, opens in page.labels if opens)
        end = next(p for p, opens in page.labels if not opens)
        for place, tag in page.tags:
            (inside if begin <= place < end else outside)[tag] += 1
        for place, text in page.texts.items():
            words[begin <= place < end] += len(text.split())
        for a, b, own in page.elements:
            if b > begin and a < end:
                holds.update(set(own))
            else:
                free.update(set(own))
    tags = {}
    for tag in {*inside, *outside}:
        ratio = math.log((outside[tag] + 0.5) / words[0]) - math.log((inside[tag] + 0.5) / words[1])
        tags[tag] = max(MOST, min(LEAST, -ratio / 2))
    return Weights(tags, frozenset(m for m in free if m not in holds))


def main_text(source: str | None, weights: Weights) -> str:
    if not source:
        return ""
    page = Page(source, weights)
    return page.text(*page.fitted(*page.region()))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: Weights | None = None) -> DataFrame:
    """``page_id, url, text`` of every page."""
    learned = weights or learn()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), learned) for x in batch["html"]]
            yield pa.RecordBatch.from_pydict({"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string())})

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
