"""Operator 13: the main text of web pages, by composite text density.

A page becomes a tree of elements. Elements that never hold the article (menus, forms, scripts, ...) are hidden by their tag, role or
class names. Of the rest, the text density of an element is its characters per tag, adjusted for links; its density sum is
the sum over its children. The subtree with the largest density sum is the main text, together with the parts of the page
that are no less dense than the least dense element on the path from that subtree to the body.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import clear_names

# Element names and what class names, ids and roles say about an element.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot "
    "th thead tr ul".split()
)
HIDDEN_TAGS = set(
    "script style noscript template title textarea xmp iframe noembed noframes nav footer aside form search button select datalist "
    "dialog menu object applet canvas audio video map svg".split()
)
HIDDEN_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
# Words of class names and ids, cut at hyphens, underscores and capitals.
BESIDE = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup paywall nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar widget footer masthead share sharing social toolbar pagination pager login search".split()
)
READERS = set("comment comments disqus reply replies respond related recommended".split())
# Names that begin with one of these tell how a page is laid out, not what an element holds.
LAYOUT = set("has with no without is not".split())
# Closed by a new element of these names: what is closed, and where the search for it ends.
_CELL, _ROWS = {"td", "th"}, {"tbody", "thead", "tfoot"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": (_CELL, {"tr", "table"}),
    "th": (_CELL, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    **{name: (_ROWS, {"table"}) for name in _ROWS},
}
# Deeper elements become siblings, as in browsers.
DEEPEST = 512

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*)"  # a comment, or one that never ends
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^=>]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"  # a tag with its attributes
    r"|</?[a-zA-Z].*"  # a tag that never ends
    r"|<(?:[!?]|/[^a-zA-Z])[^>]*+>?",  # a declaration
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?+")
_WORTH_READING = re.compile(r"class|id|role|hidden|style|itemprop", re.IGNORECASE)
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_CAPITAL = re.compile(r"(?<=[a-z])(?=[A-Z])|[-_:.\s]+")


class Page:
    """The elements of a page in page order: parent, tag and whether it is hidden; and its text as (element, text) pieces.

    A piece without text is the edge of a block. Element 0 is the page itself.
    """

    def __init__(self, source: str):
        self.parent, self.tag, self.hidden = [-1], [""], [False]
        self.beside: set[int] = set()  # hidden by a class name that may also be that of a wrapper
        self.pieces: list[tuple[int, str | None]] = []
        self._open = [0]
        self._read(source)
        self._show_wrappers()

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            token = _TOKEN.search(source, at)
            stop = token.start() if token else end
            if stop > at:
                self.pieces.append((self._open[-1], html.unescape(source[at:stop])))
            if not token:
                break
            at = token.end()
            if token[2]:
                name = token[2].lower()
                if token[1]:
                    self._close(name)
                else:
                    self._start(name, token[3])
                    if name in RAW:
                        closing = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(source, at)
                        at = closing.start() if closing else end

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._implied_end(tag)
        inside = self._open[-1]
        i = len(self.parent)
        self.parent.append(inside)
        self.tag.append(tag)
        hint = self._hint(tag, attributes) if attributes else None
        header = tag == "header" and not any(self.tag[o] in ("article", "main") for o in self._open)
        if hint == "beside":
            self.beside.add(i)
        self.hidden.append(tag in HIDDEN_TAGS or header or hint is not None)
        if tag in BLOCK:
            self.pieces.append((i, None))
        elif tag == "br":
            self.pieces.append((inside, " "))
        if tag not in VOID and len(self._open) < DEEPEST:
            self._open.append(i)

    def _implied_end(self, tag: str) -> None:
        closed, border = IMPLIED.get(tag, ((), ()))
        for depth in range(len(self._open) - 1, 0, -1):
            above = self.tag[self._open[depth]]
            if above == "p" or above in closed:
                self._pop(depth)
                return self._implied_end(tag)
            if above in border or above in BLOCK and not closed:
                return None

    def _close(self, tag: str) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            above = self.tag[self._open[depth]]
            if above == tag:
                return self._pop(depth)
            if above in BLOCK and tag not in BLOCK:
                return None  # an inline end tag does not end the block around it

    def _pop(self, depth: int) -> None:
        for i in reversed(self._open[depth:]):
            if self.tag[i] in BLOCK:
                self.pieces.append((i, None))
        del self._open[depth:]

    def _hint(self, tag: str, attributes: str) -> str | None:
        """`gone` or `beside` if the attributes say that the element is none of the article, else None."""
        if not _WORTH_READING.search(attributes):
            return None
        given = {name.lower(): html.unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(attributes)}
        if "hidden" in given or given.get("aria-hidden") == "true" or _NO_DISPLAY.search(given.get("style", "")):
            return "gone"
        if given.get("role", "").lower() in HIDDEN_ROLES:
            return "gone"
        if tag in ("html", "body"):
            return None
        for name in f"{given.get('class', '')} {given.get('id', '')}".split():
            words = [w.lower() for w in _CAPITAL.split(name) if w]
            if not words or words[0] in LAYOUT or tag in ("article", "main") and len(words) > 1:
                continue
            if not READERS.isdisjoint(words):
                return "gone"
            if not BESIDE.isdisjoint(words) or words == ["header"]:
                return "beside"
        return None

    def _show_wrappers(self) -> None:
        """A wrapper of the article is shown whatever its class name, for example `sidebar-layout`. Then what lies in hidden elements is hidden."""
        for i, tag in enumerate(self.tag):
            if tag in ("article", "main") and not self.hidden[i] and self.beside:
                above, wrappers = self.parent[i], []
                while above > 0 and (not self.hidden[above] or above in self.beside):
                    wrappers.append(above)
                    above = self.parent[above]
                if above <= 0:
                    for wrapper in wrappers:
                        self.hidden[wrapper] = False
                        self.beside.discard(wrapper)
        for i in range(1, len(self.parent)):
            self.hidden[i] = self.hidden[i] or self.hidden[self.parent[i]]


def densities(page: Page) -> tuple[list[float], list[float]]:
    """The composite text density of every element, and the sum of its children's densities. Hidden elements have none."""
    n = len(page.parent)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in page.pieces:
        if text and not page.hidden[i]:
            chars[i] += len("".join(text.split()))
    for i in range(n - 1, -1, -1):  # children come after their parents
        if page.hidden[i]:
            continue
        if page.tag[i] == "a":
            link_chars[i], link_tags[i] = chars[i], link_tags[i] + 1
        if i:
            up = page.parent[i]
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i]
    link_share = link_chars[0] / max(chars[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        if chars[i] and not page.hidden[i]:
            per_tag = chars[i] / max(tags[i], 1)
            linked = max(link_chars[i], 1)
            spread = chars[i] / linked * (max(tags[i], 1) / max(link_tags[i], 1))
            base = math.log(chars[i] / max(chars[i] - link_chars[i], 1) * linked + link_share * chars[i] + math.e)
            density[i] = per_tag * max(math.log(spread), 0.0) / math.log(base) if spread > 1 else 0.0
            if i:
                sums[page.parent[i]] += density[i]
    return density, sums


def main_elements(page: Page) -> set[int]:
    """The elements whose subtrees are the main text.

    An element that holds an `article` or `main` element besides other things is no candidate, and a
    candidate inside of one stands for all of it, since its author marked its extent.
    """
    density, sums = densities(page)
    marked = [i for i, tag in enumerate(page.tag) if tag in ("article", "main") and not page.hidden[i]]
    holders: set[int] = set()
    for i in marked:
        up = page.parent[i]
        while up >= 0 and up not in holders:
            holders.add(up)
            up = page.parent[up]
    best = max((i for i in range(len(sums)) if i not in holders and not page.hidden[i]), key=lambda i: (sums[i], -i), default=0)
    if sums[best] <= 0:
        return {marked[0]} if len(marked) == 1 else {0}
    path = [best]
    while page.parent[path[-1]] >= 0 and page.tag[path[-1]] != "body":
        path.append(page.parent[path[-1]])
    for name in ("article", "main"):
        around = next((i for i in path if page.tag[i] == name), None)
        if around is not None:
            return {around}
    threshold = min(density[i] for i in path)
    # Of each element that reaches the threshold, the element of its subtree with the largest sum.
    top = list(range(len(sums)))
    for i in range(len(sums) - 1, 0, -1):
        up = page.parent[i]
        if not page.hidden[i] and sums[top[i]] > sums[top[up]]:
            top[up] = top[i]
    chosen: set[int] = set()
    reached = [False] * len(sums)
    for i, up in enumerate(page.parent):
        if not page.hidden[i] and density[i] >= threshold and (i == path[-1] or up >= 0 and reached[up]):
            reached[i] = True
            chosen.add(top[i])
    chosen.add(best)
    return chosen


def main_text(source: str | None) -> str:
    """The main text of one page: its blocks in page order, one a line, white space in a block made one space. Empty if there is none."""
    if not source:
        return ""
    page = Page(source)
    chosen = main_elements(page)
    inside = [False] * len(page.parent)
    for i, up in enumerate(page.parent):
        inside[i] = not page.hidden[i] and (i in chosen or up >= 0 and inside[up])
    lines: list[str] = []
    block: list[str] = []
    for i, text in [*page.pieces, (0, None)]:
        if text is None:
            if line := " ".join("".join(block).split()):
                lines.append(line)
            block = []
        elif inside[i]:
            block.append(text)
    return "\n".join(lines)


def extract(pages: DataFrame, html: str = "html", names: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """The rows without `html`, with `text` and its length in code points, or other `names`. One pass, no shuffle.

    Nulls: a null or empty page has empty text; other columns stay as they are. Repeated rows come back as given. Columns that have
    the new names are replaced. Pages of any length are read whole.
    """
    text, n_chars = names

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            yield pd.Series([main_text(source) for source in sources], dtype=object)

    found = clear_names(pages.withColumnRenamed(html, "_source"), names).withColumn(text, extracted("_source")).drop("_source")
    return found.withColumn(n_chars, F.length(text).cast("long"))
