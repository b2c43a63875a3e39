"""Main text of web pages by minimum-cut labelling of their blocks.

1. A tolerant tokenizer walks the markup once, keeps the open elements (with the implied ends of p, li, td and the
   like) and cuts the page into blocks: text between the edges of block elements. Scripts, styles, comments and the
   head are no text.
   A name like "has-sidebar" on a wrapper says nothing about what it holds: negative parts of names do not count on an
   element around the page's main element, around its long articles, or around most of its text. Whole names count.
2. A classifier gives every block a cost for either label. Where a block stands (article, nav, footer, class names)
   is a fixed prior; the look of its text (length, links, punctuation, heading, list) is a logistic regression that is
   trained on at most ``max_pages`` pages of the table (those with the smallest digests), with the blocks whose place is
   beyond doubt as labels.
3. The costs become capacities from the source (content) and to the sink (boilerplate). Neighbouring blocks, and blocks
   alike in place with the same parent, are tied by smoothness edges that weaken with their distance in the element tree. The minimum
   cut, found by maximum flow along shortest augmenting paths, is the labelling with the least total cost.

A page is one row and independent of all others. Null and empty pages, and pages without content, give an empty text.
Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PAGES = 2_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noframes", "svg", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul button".split()
)
#: Elements that end, where they start, an open element of the named kinds, up to the limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
P_LIMITS = {"button", "td", "th", "caption", "object", "body", "html"}

#: Log-odds of content for what encloses a block.
PLACE = {
    "article": 3.0, "main": 2.0, "nav": -6.0, "footer": -6.0, "aside": -6.0, "header": -3.5, "form": -6.0, "menu": -6.0, "dialog": -6.0, "button": -6.0,
    "select": -6.0, "head": -12.0, "address": -1.0, "fieldset": -4.0, "search": -6.0, "label": -2.0,
}
NEGATIVE_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion promoted sponsor sponsored comment comments commentlist reply replies disqus cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login sidebar sidenav widget widgets menu navbar nav navigation "
    "footer breadcrumb breadcrumbs share sharing social related recommended recommendations trending pagination pager toolbar disclaimer alert masthead skip form search "
    "copyright legal respond discussion outbrain taboola teaser toc".split()
)
POSITIVE_NAMES = set("article content main post entry story text body".split())
ROLES = {"navigation": -6.0, "banner": -5.0, "contentinfo": -6.0, "complementary": -6.0, "search": -6.0, "form": -6.0, "dialog": -6.0, "alert": -6.0, "main": 2.0, "article": 3.0}
NAME_COST, NAME_GAIN, HIDDEN_COST = -6.0, 1.0, -12.0
FEATURES = 8
#: Bound on what the look of a block may add to its place.
LOOK_LIMIT = 1.5
ADJACENT, SIBLING, SCALE = 0.6, 0.8, 1000


class Element:
    __slots__ = ("tag", "own", "kind", "part", "whole", "place", "depth", "parent", "size", "wraps")

    def __init__(self, tag: str, own: float, kind: str, part: bool, whole: bool, parent: Element | None):
        self.tag, self.own, self.kind, self.part, self.whole, self.parent = tag, own, kind, part, whole, parent
        self.depth = parent.depth + 1 if parent else 0
        self.place, self.size, self.wraps = 0.0, 0, False


def _settle(elements: list[Element]) -> None:
    """Places of all elements of a page, parents first, when its texts are known."""
    for e in reversed(elements[1:]):
        e.parent.size += e.size
    total = elements[0].size
    shut, inside = set(), set()
    for e in elements:
        if e.whole or e.own <= -2 or id(e.parent) in shut:
            shut.add(id(e))
        if e.kind == "main" or id(e.parent) in inside:
            inside.add(id(e))
    fit = [e for e in elements if e.kind and e.size and not e.part and id(e) not in shut]
    articles = [e for e in fit if e.kind == "article"]
    articles = [e for e in articles if id(e) in inside] or ([] if inside else articles)
    longest = max((e.size for e in articles), default=0)
    for e in [e for e in fit if e.kind == "main"] + [e for e in articles if 2 * e.size >= longest]:
        while (e := e.parent) and not e.wraps:
            e.wraps = True
    for e in elements:
        lifted = e.part and not e.whole and (e.wraps or 2 * e.size > total)
        place, above = e.own + (NAME_COST if (e.part or e.whole) and not lifted else 0.0), e.parent.place if e.parent else 0.0
        # what is inside a menu stays a menu, and an advert in an article is an advert
        place = min(place, above + min(place, 0)) if above < 0 else place if place < 0 else place + above
        e.place = max(min(place, 4.0), -12.0)


class Block:
    __slots__ = ("text", "links", "element", "tag")

    def __init__(self, text: str, links: int, element: Element, tag: str):
        self.text, self.links, self.element, self.tag = text, links, element, tag


def _element(tag: str, attributes: str, parent: Element | None) -> Element:
    """An element with what its tag, role and names say; its place follows when the page is read."""
    own, kind = PLACE.get(tag, 0.0), tag if tag in ("main", "article") else ""
    if not attributes or attributes.isspace():
        return Element(tag, own, kind, False, False, parent)
    parts: list[str] = []
    whole: list[str] = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            parts += [n.lower() for n in _NAME_PART.findall(value)]
            whole += value.lower().split()
        elif name == "role":
            role = value.lower().strip()
            own += ROLES.get(role, 0.0)
            kind = role if role in ("main", "article") else kind
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            own += HIDDEN_COST
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            own += HIDDEN_COST
    if tag in ("html", "body"):
        return Element(tag, own, kind, False, False, parent)
    bad, exact = not NEGATIVE_NAMES.isdisjoint(parts), not NEGATIVE_NAMES.isdisjoint(whole)
    if not (bad or exact) and POSITIVE_NAMES.intersection(parts + whole):
        own += NAME_GAIN
    return Element(tag, own, kind, bad, exact, parent)


def blocks_of(page: str) -> list[Block]:
    """Blocks of a page in order, with white space collapsed; empty ones are left out."""
    out: list[Block] = []
    stack = [_element("#root", "", None)]
    elements = list(stack)
    pieces: list[str] = []
    links = 0

    def cut() -> None:
        nonlocal links
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                holder = next((e for e in reversed(stack) if e.tag in BLOCK or e.tag == "#root"))
                holder.size += len(text)
                out.append(Block(text, min(links, len(text)), holder, holder.tag))
            pieces.clear()
        links = 0

    def close(kinds: set[str], limits: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in kinds:
                del stack[i:]
                return
            if stack[i].tag in limits:
                return

    def add(raw: str) -> None:
        nonlocal links
        text = unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if any(e.tag == "a" for e in stack):
            links += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at:tag.start()])
        at = tag.end()
        name = tag[2] or tag[5]
        if name is None:
            continue
        name, ending, attributes = name.lower(), tag[1] or tag[4], tag[3] or tag[6] or ""
        if ending:
            if name in BLOCK:
                cut()
            close({name}, {"table", "td", "th"} if name in ("p", "li", "a", "b", "i", "span", "em", "strong") else set())
        elif name in RAW:
            if not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else n
        elif name == "br":
            pieces.append(" ")
        elif name in VOID:
            if name == "hr":
                cut()
        else:
            if name in BLOCK:
                cut()
                if name != "option":
                    close({"p"}, P_LIMITS)
                if name in CLOSES:
                    close(*CLOSES[name])
            stack.append(_element(name, attributes, stack[-1]))
            elements.append(stack[-1])
    cut()
    _settle(elements)
    return out


def looks(blocks: list[Block]) -> np.ndarray:
    """Features of the text of each block, without its place."""
    rows = []
    for b in blocks:
        n, words = len(b.text), b.text.count(" ") + 1
        stops = sum(map(b.text.count, ".!?,;"))
        rows.append((1.0, math.log1p(words) / 3, b.links / n, min(stops / words, 1.0), b.text[-1] in ".!?", b.tag[0] == "h" and b.tag[1:].isdigit(), b.tag in ("li", "td", "th", "dd", "dt"), b.tag in ("p", "pre", "blockquote")))
    return np.array(rows, float).reshape(-1, FEATURES)


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling (True: content) with the least cost; odds above 0 cost if labelled boilerplate and the other way round.

    Maximum flow from blocks with positive to blocks with negative odds, along shortest augmenting paths.
    """
    n = len(odds)
    excess = [round(o * SCALE) for o in odds]
    to: list[list[int]] = [[] for _ in range(n)]
    room: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, weight in edges:
        for x, y in ((a, b), (b, a)):
            if y not in room[x]:
                to[x].append(y)
            room[x][y] = room[x].get(y, 0) + round(weight * SCALE)
    supply = [max(e, 0) for e in excess]
    demand = [max(-e, 0) for e in excess]
    while True:
        before = [i if supply[i] else -1 for i in range(n)]
        queue = deque(i for i in range(n) if supply[i])
        end = -1
        while queue and end < 0:
            i = queue.popleft()
            for j in to[i]:
                if before[j] < 0 and room[i][j] > 0:
                    before[j] = i
                    if demand[j]:
                        end = j
                        break
                    queue.append(j)
        if end < 0:
            return [before[i] >= 0 for i in range(n)]
        path = [end]
        while before[path[-1]] != path[-1]:
            path.append(before[path[-1]])
        start = path[-1]
        flow = min([supply[start], demand[end], *(room[b][a] for a, b in zip(path[:-1], path[1:], strict=True))])
        supply[start] -= flow
        demand[end] -= flow
        for a, b in zip(path[:-1], path[1:], strict=True):
            room[b][a] -= flow
            room[a][b] += flow


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Ties between neighbours, weaker the farther they are in the element tree, and between blocks alike in place under one parent."""
    edges = []
    last_of: dict[tuple[int, float], int] = {}
    for i, block in enumerate(blocks):
        if i:
            a, b, steps = blocks[i - 1].element, block.element, 0
            while a is not b:
                if a.depth >= b.depth:
                    a = a.parent
                else:
                    b = b.parent
                steps += 1
            edges.append((i - 1, i, ADJACENT / (1 + steps)))
        like = (id(block.element.parent or block.element), block.element.place)
        if like in last_of:
            edges.append((last_of[like], i, SIBLING))
        last_of[like] = i
    return edges


def extract(page: str | None, weights: np.ndarray) -> str:
    """Main text of a page: content blocks in page order, one per line."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    look = np.clip(looks(blocks) @ weights, -LOOK_LIMIT, LOOK_LIMIT)
    odds = [b.element.place + v for b, v in zip(blocks, look.tolist(), strict=True)]
    keep = minimum_cut(odds, smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def train(pages: DataFrame, max_pages: int = MAX_PAGES, steps: int = 200) -> np.ndarray:
    """Weights of the looks, from blocks whose place is beyond doubt; zero if only one kind of them is there."""
    ids = pages.where("html is not null and page_id is not null").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)
    chosen = pages.select("page_id", "html").where("html is not null").join(F.broadcast(ids), "page_id", "left_semi").limit(max_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(0):
                sure = [b for b in blocks_of(page.as_py()) if abs(b.element.place) >= 2]
                rows = [[float(b.element.place > 0), *x] for b, x in zip(sure, looks(sure).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([[v for r in rows for v in r]], pa.list_(pa.float64()))], ["blocks"])

    found = chosen.select("html").mapInArrow(run, "blocks array<double>").toArrow()
    rows = np.asarray(found.column(0).combine_chunks().flatten(), float).reshape(-1, FEATURES + 1)
    y, x = rows[:, 0], rows[:, 1:]
    weights = np.zeros(FEATURES)
    if not len(y) or y.min() == y.max():
        return weights
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        weights += 0.5 * (x.T @ (balance * (y - p)) / len(y) - 0.001 * weights)
    return weights


def main_text(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py(), weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
