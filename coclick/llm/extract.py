"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks (runs of text between block-level tags) with their
chain of open elements.  A linear classifier over tags, class words, link
density and length gives each block a log-odds for content; it becomes the
block's terminal capacity (to the content side if positive, to the boilerplate
side otherwise).  Neighbouring blocks, and consecutive blocks of one parent, are
tied by smoothness edges that weigh more the more ancestors they share.  The
minimum cut (by maximum flow) is the labelling of least total cost.

Defined cases: null or empty html, or a page without content, gives an empty
text; broken mark-up (unclosed tags, cut-off entities or pages) is read as
browsers do, as far as a tag is complete: script, style, iframe, textarea and
title run to their end tag or the page's end, a head ends at the first tag or
text of the body, an svg or select at a tag that cannot stand in it.  Text in a
noscript, template, svg or select is left out; unlike in browsers one that is
never closed hides nothing, nor does an object; repeated rows are rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.llm.store import shipped

_RAW = re.compile(r"<(script|style|iframe|textarea|title)(?=[\s/>])", re.I)
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in "script style iframe textarea title".split()}
_NAME = re.compile(r"<(/?)[a-z]", re.I)
_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile(r"[>\"']")
_HIDDEN_END = re.compile(r"</(noscript|template|svg|select|object)(?=[\s/>])", re.I)
_ATTR = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td "
            "tfoot th thead tr ul".split())
#: A start tag of the first closes an open one of the others.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}} | \
    {t: {"p"} for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                       "nav ol pre section table ul".split()}
#: Implied ends do not reach beyond these.
SCOPE = set("article aside body div footer form header html main nav ol section table td th ul blockquote dl".split())
#: Text inside these is not shown, if they are closed.
HIDDEN = set("noscript template svg select".split())
#: Implied ends do not leave these.
INNER = HIDDEN | {"object"}
#: Start tags that leave a head open.
HEAD = set("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Start tags that end an open svg (outside its foreignObject) or select.
LEAVES = {"svg": BLOCK | set("b big br code em embed i img s small span strike strong sub sup tt u var".split()),
          "select": set("article aside body footer form h1 h2 h3 h4 h5 h6 header input main nav p section table".split())}

GOOD_TAGS = {"article": 3.5, "main": 2.0}
BAD_TAGS = {"nav": 9.0, "footer": 9.0, "aside": 9.0, "form": 9.0, "button": 9.0, "menu": 9.0, "dialog": 9.0,
            "object": 9.0, "label": 4.0, "figcaption": 0.5}
GOOD_WORDS = set("article articlebody content entry main post story text body prose".split())
BAD_WORDS = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments complementary "
                "contentinfo consent cookie cookies copyright discussion disqus footer form gdpr header login masthead "
                "menu modal nav navbar navigation newsletter notice notification pager pagination popup promo "
                "promotion related replies reply respond search share sharing sidebar signup skip social sponsor "
                "sponsored subscribe tags toolbar widget".split())
SMOOTH = 0.6


@dataclass(slots=True, eq=False)
class Element:
    """An open element; blocks point to the innermost, so a deep chain is held once."""

    name: str
    above: Element | None
    odds: float     # of the whole chain
    depth: int
    hidden: int     # elements of the chain that hide text
    links: int      # and that are links


@dataclass(slots=True)
class Block:
    text: str
    inner: Element | None
    odds: float
    linked: int
    chars: int

    @property
    def depth(self) -> int:
        return self.inner.depth if self.inner else 0


class _TagEnds:
    """Where start and end tags end; every place of a page is scanned a bounded number of times, matched or not."""

    def __init__(self, html: str):
        self.html = html
        self.names = [m.start() for m in _NAME_END.finditer(html)]
        self.special = [m.start() for m in _SPECIAL.finditer(html)]
        self.last = {c: html.rfind(c) for c in "\"'"}
        self.failed: set[int] = set()   # special characters outside quotes from where no tag ends

    def name_end(self, start: int) -> int:
        i = bisect_left(self.names, start)
        return self.names[i] if i < len(self.names) else len(self.html)

    def __call__(self, start: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``start``; -1 if none does."""
        seen = []
        while True:
            i = bisect_left(self.special, start)
            if i == len(self.special):
                break
            at = self.special[i]
            c = self.html[at]
            if c == ">":
                return at
            if at in self.failed or self.last[c] == at:
                break
            seen.append(at)
            start = self.html.index(c, at + 1) + 1
        self.failed.update(seen)
        return -1


def _tokens(html: str) -> Iterator[tuple[int, str, str | None, str]]:
    """(place, text or attributes, tag name or None, "/" for an end tag) of a page."""
    ends, at, n = None, 0, len(html)
    while at < n:
        tag = html.find("<", at)
        if tag != at:
            yield at, html[at:tag if tag >= 0 else n], None, ""
            if tag < 0:
                return
        if html.startswith("<!--", tag):
            end = html.find("-->", tag + 4)
            at = end + 3 if end >= 0 else n
            continue
        if m := _RAW.match(html, tag):
            close = _RAW_END[m[1].lower()].search(html, m.end()) if m[1].lower() in _RAW_END else None
            end = html.find(">", close.end()) if close else -1
            at = end + 1 if end >= 0 else n
            continue
        if m := _NAME.match(html, tag):
            if ends is None:
                ends = _TagEnds(html)
            name_end = ends.name_end(m.end())
            end = ends(name_end) if name_end < n else -1
            if end >= 0:
                yield tag, html[name_end:end], html[m.end() - 1:name_end].lower(), m[1]
                at = end + 1
                continue
        following = html[tag + 1:tag + 2]
        if following and following in "!?/":
            end = html.find(">", tag + 2)
            at = end + 1 if end >= 0 else n
        elif m and html.find("<", tag + 1) < 0:
            return
        else:
            yield tag, "<", None, ""
            at = tag + 1


def _words(attrs: str) -> set[str]:
    out: set[str] = set()
    for m in _ATTR.finditer(attrs):
        value = m[1] or m[2] or m[3] or ""
        out.update(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))
    return out


def blocks(html: str) -> list[Block]:
    """Blocks of a page in order, with the log-odds of their surroundings."""
    out: list[Block] = []
    stack: list[Element] = []
    places: dict[str, list[int]] = {}   # of the open elements of each name
    scopes: list[int] = []              # and of those that implied ends do not leave
    pieces: list[tuple[str, bool]] = []
    last_end: dict[str, int] | None = None  # of each element that hides text

    def last(name: str) -> int:
        at = places.get(name)
        return at[-1] if at else -1

    def hidden(depth: int) -> bool:
        return depth > 0 and stack[depth - 1].hidden > 0

    def flush() -> None:
        nonlocal pieces
        if pieces:
            text = " ".join(entities.unescape("".join(t for t, _ in pieces)).split())
            if text:
                linked = sum(len(t.strip()) for t, a in pieces if a)
                inner = stack[-1] if stack else None
                out.append(Block(text, inner, inner.odds if inner else 0.0, linked, sum(len(t.strip()) for t, _ in pieces)))
        pieces = []

    def pop(i: int) -> None:
        # blocks inside a hidden element leave the text around it whole
        if not hidden(i):
            for e in stack[i:]:
                if e.name in HIDDEN:
                    break
                if e.name in BLOCK:
                    flush()
                    break
        for e in stack[i:]:
            places[e.name].pop()
        del stack[i:]
        while scopes and scopes[-1] >= i:
            scopes.pop()

    for place, text, name, end in _tokens(html):
        if name is None:
            if stack and stack[-1].name == "head" and not text.isspace():
                pop(len(stack) - 1)
            if not hidden(len(stack)):
                pieces.append((text, bool(stack) and stack[-1].links > 0))
            continue
        if end:
            if (i := last(name)) >= 0:
                pop(i)
            continue
        if stack and stack[-1].name == "head" and name not in HEAD:
            pop(len(stack) - 1)
        leaves = max((last(x) for x in LEAVES if name in LEAVES[x]), default=-1)
        if leaves > last("foreignobject"):
            pop(leaves)
        if name in INNER:
            if last_end is None:
                last_end = {e[1].lower(): e.start() for e in _HIDDEN_END.finditer(html)}
            if last_end.get(name, -1) < place:
                continue  # never closed: it does not hide the rest of the page
        covered = hidden(len(stack))
        if name in BLOCK and not covered:
            flush()
        if closes := CLOSES.get(name):
            while (i := max(map(last, closes))) >= 0 and i >= (scopes[-1] if scopes else 0):
                pop(i)
        if name == "br" and not covered:
            pieces.append((" ", False))
        if name in VOID or text.rstrip().endswith("/"):
            continue
        above = stack[-1] if stack else None
        odds = _evidence(name, text, last("article") >= 0)
        places.setdefault(name, []).append(len(stack))
        if name in SCOPE or name in INNER:
            scopes.append(len(stack))
        stack.append(Element(name, above, odds + (above.odds if above else 0.0), len(stack) + 1,
                             (name in HIDDEN) + (above.hidden if above else 0), (name == "a") + (above.links if above else 0)))
    flush()
    return out


def _evidence(name: str, attrs: str, in_article: bool) -> float:
    words = _words(attrs) if "=" in attrs else set()
    odds = GOOD_TAGS.get(name, 0.0) - BAD_TAGS.get(name, 0.0)
    if name == "header" and not in_article:
        odds -= 9.0
    if name not in ("html", "body", "main", "article", "h1") and words & BAD_WORDS:
        odds -= 9.0
    elif words & GOOD_WORDS:
        odds += 2.0
    return odds


def _log_odds(block: Block) -> float:
    n = block.text.count(" ") + 1
    odds = block.odds - 1.5 + min(3.0, 1.2 * math.log2(1 + n / 8))
    odds -= 5.0 * block.linked / max(1, block.chars)
    last = block.inner.name if block.inner else ""
    if last in ("h1", "p", "pre", "blockquote"):
        odds += 1.0
    if block.text[-1] in ".!?\"'”»…":
        odds += 0.5
    return odds


class FlowNetwork:
    """Small directed network; shortest augmenting paths."""

    def __init__(self, nodes: int):
        self.to: list[int] = []
        self.room: list[float] = []
        self.of: list[list[int]] = [[] for _ in range(nodes)]

    def edge(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        for x, y, c in ((a, b, there), (b, a, back)):
            self.of[x].append(len(self.to))
            self.to.append(y)
            self.room.append(c)

    def _levels(self, s: int) -> list[int]:
        level = [-1] * len(self.of)
        level[s] = 0
        queue = deque([s])
        while queue:
            x = queue.popleft()
            for e in self.of[x]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, s: int, t: int) -> list[bool]:
        """Nodes on the source's side of a minimum cut."""
        while (level := self._levels(s))[t] >= 0:
            at = [0] * len(self.of)
            path: list[int] = []
            x = s
            while True:
                if x == t:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    path, x = [], s
                    continue
                while at[x] < len(self.of[x]):
                    e = self.of[x][at[x]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[x] + 1:
                        break
                    at[x] += 1
                if at[x] < len(self.of[x]):
                    path.append(e)
                    x = self.to[e]
                elif path:
                    e = path.pop()
                    x = self.to[e ^ 1]
                    at[x] += 1
                else:
                    break
        return [v >= 0 for v in level]


def _shared(a: Block, b: Block) -> float:
    """Share of the longer chain that both stand under."""
    x, y = a.inner, b.inner
    while x is not y:
        # from the deeper one up; between neighbours that is no further than the tags between them
        if y is None or (x is not None and x.depth > y.depth):
            x = x.above
        elif x is None or y.depth > x.depth:
            y = y.above
        else:
            x, y = x.above, y.above
    return (x.depth if x else 0) / max(1, a.depth, b.depth)


def label(page: list[Block], smooth: float = SMOOTH) -> list[bool]:
    """True for content blocks: the minimum cut."""
    if not page:
        return []
    n = len(page)
    net = FlowNetwork(n + 2)
    same_parent: dict[Element | None, int] = {}
    for i, b in enumerate(page):
        odds = _log_odds(b)
        net.edge(n, i, max(0.0, odds))
        net.edge(i, n + 1, max(0.0, -odds))
        if i:
            net.edge(i - 1, i, w := smooth * (0.25 + _shared(page[i - 1], b)), w)
        parent = b.inner.above if b.inner else None
        if (j := same_parent.get(parent)) is not None and j != i - 1:
            net.edge(j, i, w := smooth * _shared(page[j], b), w)
        same_parent[parent] = i
    return net.source_side(n, n + 1)[:n]


def main_text(html: str | None) -> str:
    """Content blocks of a page joined by line feeds."""
    page = blocks(html or "")
    return "\n".join(b.text for b, keep in zip(page, label(page), strict=True) if keep)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(text, pa.string()),
             pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): one row per page."""
    shipped(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(_pages, "page_id long, url string, text string, n_chars long")
