"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into text blocks at block-level tags. A block is described by its words and link density,
those of the blocks before and after it, whether it stands in an element that isn't the article (navigation, header, footer, sidebar, form) or
in a part whose class says so (strong words such as "ad" or "comments", weak ones such as "related"), which share of the article's words
that part holds, and whether the page marks an article around it. A decision tree fitted to a small labelled table (page_blocks.csv: the blocks of hand-made
pages of several layouts, in page order) says which blocks are main text.

One forward scan reads a page; unclosed tags, quotes and elements cost no more than closed ones.
"""

from __future__ import annotations

import csv
import html
import io
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from pkgutil import get_data

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements of the HTML standard.
BLOCK_TAGS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html iframe legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea svg math object canvas".split())
#: Tags that end by themselves when another of the set opens.
SELF_CLOSING = {"p": BLOCK_TAGS - {"option"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
ASIDE_TAGS = frozenset("nav header footer aside form menu select button dialog iframe".split())
ARTICLE_TAGS = frozenset(["article", "main"])
#: Words in class, id and role that say of a part of the page that it isn't the article.
STRONG_WORDS = frozenset("ad ads adbox adsbygoogle advert adverts advertisement advertising banner sponsor sponsored promo promotion navigation nav navbar menu breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar sidenav aside cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login paywall comment comments commentlist disqus reply replies opinions pagination pager form contentinfo complementary".split())
#: Words that stand on such parts and, in compounds, on articles' own parts as well.
WEAK_WORDS = frozenset("widget related recommended share sharing social teaser teasers trending popular search searchbox respond discussion".split())

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "mark", "share", "article")

#: Words that don't mark a part inside an article as something else: articles have headers of their own.
ARTICLE_PARTS = frozenset("header masthead social form".split())
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|=|$)|style\s*=\s*["']?[^"'>]*display\s*:\s*none)""", re.I)

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""[>"']""")
_RAW_START = {tag: re.compile(f"</{tag}", re.I) for tag in (*RAW_TAGS, "title")}
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")


def _marked(attributes: str, article: bool) -> int:
    """2 if class, id or role hold a strong word (inside an article, other than ARTICLE_PARTS), 1 for a weak one, else 0."""
    strength = 0
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        found = set(_PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower()))
        found = found - ARTICLE_PARTS if article else found
        strength = max(strength, 2 if found & STRONG_WORDS else 1 if found & WEAK_WORDS else 0)
    return strength


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of every tag; comments and declarations have no name.

    A quoted value may hold ">". A tag or comment that the page's end cuts off takes the rest of the page. Every search starts
    where the one before ended, so the scan is linear.
    """
    at, size, last_quote = 0, len(page), {q: page.rfind(q) for q in "\"'"}
    last_end = page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        name = _NAME.match(page, start + 1)
        if not name:
            if page.startswith("<!--", start):
                stop = page.find("-->", start + 4)
                at = stop + 3 if stop >= 0 else size
            elif page[start + 1 : start + 2] in ("!", "?", "/"):
                at = page.find(">", start) + 1 or size
            else:
                at = start + 1
                continue
            yield start, at, "", "", ""
            continue
        at = name.end()
        while at <= last_end:
            stop = _STOP.search(page, at)
            at = stop.end()
            if stop[0] == ">":
                yield start, at, name[1], name[2].lower(), page[name.end() : at - 1]
                break
            if last_quote[stop[0]] >= at and page[name.end() : stop.start()].rstrip()[-1:] == "=":
                at = page.find(stop[0], at) + 1
        else:
            yield start, size, name[1], "", ""
            return


class Part:
    """A marked part of the page, or an article, or the page: how many words it holds, and the article or page around it."""

    __slots__ = ("words", "around")

    def __init__(self, around: Part | None = None):
        self.words, self.around = 0, around

    @property
    def share(self) -> float:
        return self.words / max(self.words, self.around.words)


class Block:
    """One text block with its features."""

    __slots__ = ("text", "words", "links", "mark", "part", "article", "given")

    def __init__(self, text: str, words: int, linked: int, aside: bool, strength: int, part: Part | None, article: bool, share: float = 0.0):
        self.text, self.words, self.links = text, words, linked / words
        self.mark, self.article = 3.0 if aside else float(strength), float(article)  # element, strong word, weak word
        self.part, self.given = part, share

    @property
    def share(self) -> float:
        return self.part.share if self.part else self.given


class Place:
    """An open element: its tag and what holds inside it. ``around`` is the text around an inline element of its own, ``linked`` its linked words."""

    __slots__ = ("tag", "aside", "strength", "part", "scope", "article", "around", "linked")

    def __init__(self, tag: str, aside: bool, strength: int, part: Part | None, scope: Part, article: bool, around: list[str] | None, linked: int):
        self.tag, self.aside, self.strength, self.part, self.scope, self.article, self.around, self.linked = tag, aside, strength, part, scope, article, around, linked


def text_blocks(page: str) -> list[Block]:
    """All blocks of a page with text, in order; tags that are never closed or opened are tolerated.

    An advert or the like inside a line of text is a block of its own, and the text around it stays one block. Hidden elements are asides.
    """
    blocks: list[Block] = []
    stack: list[Place] = [Place("", False, 0, None, Part(), False, None, 0)]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = in_link = in_head = 0

    def flush() -> None:
        nonlocal linked, parts
        words = "".join(parts).split()
        if words:
            here = stack[-1]
            blocks.append(Block(" ".join(words), len(words), min(linked, len(words)), here.aside, here.strength, here.part, here.article))
            here.scope.words += len(words)
            if here.part:
                here.part.words += len(words)
                if here.part.around is not here.scope:
                    here.part.around.words += len(words)
        parts, linked = [], 0

    def pop() -> None:
        nonlocal linked, parts
        flush()
        done = stack.pop()
        opened[done.tag] -= 1
        if done.around is not None:
            parts, linked = done.around, done.linked
            parts.append(" ")

    def text(raw: str) -> None:
        nonlocal linked
        if raw and not in_head:
            raw = html.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if in_link:
                linked += len(raw.split())

    at, end, last_end = 0, len(page), page.rfind(">")
    for start, stop, slash, tag, attributes in tags(page):
        if start < at:
            continue
        text(page[at:start])
        at = stop
        if not tag:
            continue
        if slash:
            in_link = 0 if tag == "a" else in_link
            in_head = 0 if tag == "head" else in_head
            if opened[tag] > 0:
                while stack[-1].tag != tag:
                    pop()
                pop()
            elif tag in BLOCK_TAGS:
                flush()
            continue
        if tag in _RAW_START:
            if tag == "title" or not attributes.endswith("/"):
                closing = _RAW_START[tag].search(page, at)
                at = page.find(">", closing.end()) + 1 if closing and closing.end() <= last_end else end
            continue
        if tag == "head":
            in_head = 1
            continue
        in_head = 0 if tag == "body" else in_head
        in_link = 1 if tag == "a" else in_link
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK_TAGS:
            flush()
            while stack[-1].tag in SELF_CLOSING and tag in SELF_CLOSING[stack[-1].tag]:
                pop()
            flush()
        if tag in VOID_TAGS or attributes.endswith("/"):
            continue
        was = stack[-1]
        aside = tag in ASIDE_TAGS and not (tag == "header" and was.article) or bool(attributes) and _HIDDEN.search(attributes) is not None
        strength = _marked(attributes, was.article) if attributes and tag not in ("a", "html", "body", "article", "main") else 0
        if tag in BLOCK_TAGS or aside or strength:
            article = tag in ARTICLE_TAGS
            part = Part(was.scope) if strength > was.strength else was.part
            opened[tag] += 1
            stack.append(Place(tag, was.aside or aside, max(was.strength, strength), part, Part(was.scope) if article and not was.article else was.scope, was.article or article, None if tag in BLOCK_TAGS else parts, linked))
            parts, linked = [], 0
    text(page[at:end])
    while len(stack) > 1:
        pop()
    flush()
    return blocks


def features(blocks: list[Block]) -> list[tuple[float, ...]]:
    """The columns of FEATURES for each block."""
    none = (0, 0.0)
    around = [none, *((b.words, b.links) for b in blocks), none]
    return [(b.words, b.links, *around[k], *around[k + 2], b.mark, b.share, b.article) for k, b in enumerate(blocks)]


class DecisionTree:
    """A binary tree by Gini impurity on a small table of numbers."""

    def __init__(self, rows: list[tuple[float, ...]], labels: list[int], depth: int = 9, least: int = 3):
        self.least = least
        self.root = self._grow(rows, labels, depth)

    @staticmethod
    def _gini(n: int, ones: int) -> float:
        return 2.0 * ones * (n - ones) / n if n else 0.0

    def _grow(self, rows, labels, depth):
        n, ones = len(labels), sum(labels)
        if depth == 0 or ones in (0, n):
            return 2 * ones > n
        best = None
        for f in range(len(rows[0])):
            pairs = sorted(zip((r[f] for r in rows), labels))
            left = 0
            for k in range(1, n):
                left += pairs[k - 1][1]
                if pairs[k][0] > pairs[k - 1][0] and self.least <= k <= n - self.least:
                    cost = self._gini(k, left) + self._gini(n - k, ones - left)
                    if best is None or cost < best[0] - 1e-12:
                        best = (cost, f, (pairs[k][0] + pairs[k - 1][0]) / 2)
        if best is None or best[0] >= self._gini(n, ones) - 1e-12:
            return 2 * ones > n
        _, f, cut = best
        low = [k for k in range(n) if rows[k][f] <= cut]
        high = [k for k in range(n) if rows[k][f] > cut]
        return f, cut, *(self._grow([rows[k] for k in part], [labels[k] for k in part], depth - 1) for part in (low, high))

    def predict(self, row: tuple[float, ...]) -> bool:
        node = self.root
        while not isinstance(node, bool):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node


def read_labelled(content: str | None = None) -> tuple[list[tuple[float, ...]], list[int]]:
    """Rows and labels of a labelled table in CSV (page, words, linked, aside, mark, share, article, main: blocks in page order; mark is 2 for strong words, 1 for weak ones); by default the one beside this module."""
    content = content if content is not None else get_data("sluice.llm", "page_blocks.csv").decode()
    rows, labels = [], []
    for _, page in groupby(csv.DictReader(io.StringIO(content)), key=lambda r: r["page"]):
        page = list(page)
        rows += features([Block("", int(r["words"]), int(r["linked"]), r["aside"] == "1", int(r["mark"]), None, r["article"] == "1", float(r["share"])) for r in page])
        labels += [int(r["main"]) for r in page]
    return rows, labels


def main_text(page: str | None, tree: DecisionTree) -> str:
    """Main blocks of a page, joined by newlines."""
    if not page:
        return ""
    blocks = text_blocks(page)
    return "\n".join(b.text for b, row in zip(blocks, features(blocks)) if tree.predict(row))


def extract_main_text(pages: DataFrame, html_col: str = "html", labelled: str | None = None, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(keep.., text, n_chars) of every row; n_chars counts code points.

    Null and empty html, and pages without main text, give an empty text. Repeated rows stay rows, pages of
    any length are read whole. Of the input only ``keep`` and the html are read, so other columns can't clash.
    The tree has a few nodes and travels with the code; no shuffle.
    """
    tree = DecisionTree(*read_labelled(labelled))
    picked = pages.select(*keep, F.col(html_col).alias("_html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                texts = [main_text(x, tree) for x in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*keep, "text", "n_chars"])

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return picked.mapInArrow(extract, f"{kinds}, text string, n_chars bigint")
