"""The main text of web pages from flat text blocks and a decision tree.

Markup is read as one run of tags and text, without a document tree. Every block-level
tag ends a text block. A block has its number of words, the share of them inside links,
the same of the blocks before and after it, whether it is a heading or in a list, and what
the open elements say: the last one that names a part of the page (``article``, ``nav``, a
class like ``sidebar``) and whether the page names an article at all. A decision tree,
grown by Gini impurity on the small labelled table of ``html_labels``, keeps or drops each
block; the kept ones are the text. The tree is a few numbers and travels with the tasks.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from studylake.llm.html_labels import PAGES
from studylake.llm.shipping import map_batches
from studylake.llm.words import blocks as row_blocks

MAX_DEPTH = 6
MIN_LEAF = 2

#: Elements whose content is never text of the page.
_RAW = "script|style|title|textarea|noscript|template|iframe"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\b[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I)
_NAMED = re.compile(r"(?:^|[\s\"'])(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

#: Tags inside a line of text; every other tag ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Tags and words of class, id or role that name an article, and those that name other parts of a page.
ARTICLE_TAGS = frozenset("article main".split())
ARTICLE_WORDS = frozenset("article articlebody content entry main post prose story".split())
OTHER_TAGS = frozenset("aside button dialog fieldset footer form header menu nav select svg".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog discussion disqus footer form gdpr login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification pagination paywall popup promo promoted "
    "promotion recommended related replies reply respond search share sharing sidebar sidebars signup social sponsor "
    "sponsored subscribe subscription toolbar topbar trending widget widgets".split())
#: Words that say of an element which other parts its page has or lacks.
ABOUT_WORDS = frozenset("has no with without".split())
#: Names of a page's head, which inside an article is part of it.
HEAD_WORDS = frozenset(("header", "head"))

NONE, ARTICLE, OTHER = range(3)

FEATURES = (
    "words", "words_before", "words_after", "links", "links_before", "links_after",
    "heading", "item", "part", "named_article")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    heading: bool
    item: bool
    part: int
    place: int


def _kind(tag: str, attributes: str, inside: int) -> int:
    """What an element names: an article, another part of the page or nothing."""
    words: set[str] = set()
    if attributes and tag not in ("html", "body"):
        for found in _NAMED.findall(attributes):
            split = [w.lower() for w in _PART.findall("".join(found))]
            words |= {w for before, w in zip(["", *split], split) if before not in ABOUT_WORDS}
    if words & OTHER_WORDS:
        return OTHER
    if tag == "header" or words & HEAD_WORDS:
        return inside if inside == ARTICLE or words & ARTICLE_WORDS else OTHER
    if tag in OTHER_TAGS:
        return OTHER
    return ARTICLE if tag in ARTICLE_TAGS or words & ARTICLE_WORDS else NONE


_known_kind = lru_cache(maxsize=1 << 12)(_kind)


def _kind_of(tag: str, attributes: str, inside: int) -> int:
    return (_known_kind if len(attributes) < 200 else _kind)(tag, attributes, inside)


def text_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, references decoded and white space made one space.

    An element inside one that names another part stays in that part, but for an article inside a form.
    """
    found: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    open_: list[tuple[str, int]] = []  # (tag, part) of the elements that end blocks
    part, anchors, heading, item, start, leaf = NONE, 0, False, False, 0, NONE

    def close() -> None:
        nonlocal pieces
        if pieces:
            text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = sum(len(html.unescape(p).split()) for p, a in pieces if a)
                found.append(Block(
                    text, text.count(" ") + 1, linked, heading, item, max(part, leaf), start))
            pieces = []

    last = 0
    for token in _TOKEN.finditer(page):
        if token.start() > last:
            if not pieces:
                start = last
            pieces.append((page[last:token.start()], anchors > 0))
        last = token.end()
        ends, tag, attributes = token.group(2), token.group(3), token.group(4)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                anchors = 0 if ends else 1
            elif tag == "br":
                pieces.append((" ", False))
            continue
        close()
        anchors, leaf = 0, NONE
        if tag in HEADINGS:
            heading = not ends
        elif not ends and tag not in VOID:
            heading = False
        if tag == "li":
            item = not ends
        if ends:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == tag:
                    del open_[depth:]
                    part = open_[-1][1] if open_ else NONE
                    break
        elif tag == "p" or tag == "li" or tag in HEADINGS:
            leaf = _kind_of(tag, attributes, part) if attributes else NONE
        elif tag not in VOID and not attributes.endswith("/"):
            kind = _kind_of(tag, attributes, part)
            if part == OTHER and not (kind == ARTICLE and open_ and all(
                    t == "form" for t, p in open_ if p == OTHER)):
                kind = OTHER
            part = kind or part
            open_.append((tag, part))
    if last < len(page):
        if not pieces:
            start = last
        pieces.append((page[last:], anchors > 0))
    close()
    return found


def features(pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages; beyond a page's ends there are no words."""
    rows = [b for page in pages for b in page]
    if not rows:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b.words for b in rows], dtype=float)
    links = np.array([min(b.linked, b.words) for b in rows], dtype=float) / words
    sizes = np.array([len(page) for page in pages])
    stops = np.cumsum(sizes)
    first = np.zeros(len(rows), dtype=bool)
    final = first.copy()
    first[(stops - sizes)[sizes > 0]] = True
    final[stops[sizes > 0] - 1] = True
    part = np.array([b.part for b in rows], dtype=float)
    named = np.repeat([float(any(b.part == ARTICLE for b in page)) for page in pages], sizes)
    before = lambda x: np.where(first, 0.0, np.roll(x, 1))
    after = lambda x: np.where(final, 0.0, np.roll(x, -1))
    return np.column_stack([
        words, before(words), after(words), links, before(links), after(links),
        [b.heading for b in rows], [b.item for b in rows], part, named])


class Tree(NamedTuple):
    """Nodes in arrays: ``feature`` -1 is a leaf; up to ``limit`` goes to ``low``, above to ``high``."""

    feature: np.ndarray
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    keep: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=int)
        for _ in range(MAX_DEPTH):
            split = np.flatnonzero(self.feature[node] >= 0)
            at = node[split]
            node[split] = np.where(
                x[split, self.feature[at]] <= self.limit[at], self.low[at], self.high[at])
        return self.keep[node]


def _impurity(kept: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Gini impurity of groups, weighted by their size."""
    return 2 * kept * (size - kept) / np.maximum(size, 1)


def grow(x: np.ndarray, y: np.ndarray) -> Tree:
    """A binary tree by greatest fall of Gini impurity; ties take the first feature and least limit."""
    nodes: list[list] = []

    def add(rows: np.ndarray, depth: int) -> int:
        place = len(nodes)
        size, kept = len(rows), int(y[rows].sum())
        nodes.append([-1, 0.0, 0, 0, 2 * kept >= size and kept > 0])
        best = (float(_impurity(np.array(kept), np.array(size))) - 1e-9, -1, 0.0)
        if depth < MAX_DEPTH and 0 < kept < size:
            for f in range(x.shape[1]):
                order = rows[np.argsort(x[rows, f], kind="stable")]
                values, done = x[order, f], np.arange(1, size)
                left = np.cumsum(y[order])[:-1]
                total = _impurity(left, done) + _impurity(kept - left, size - done)
                usable = (values[1:] > values[:-1]) & (done >= MIN_LEAF) & (size - done >= MIN_LEAF)
                if usable.any():
                    cut = int(np.argmin(np.where(usable, total, np.inf)))
                    if total[cut] < best[0] - 1e-9:
                        best = (float(total[cut]), f, float(values[cut] + values[cut + 1]) / 2)
        if best[1] >= 0:
            low = x[rows, best[1]] <= best[2]
            nodes[place][:2] = best[1:]
            nodes[place][2] = add(rows[low], depth + 1)
            nodes[place][3] = add(rows[~low], depth + 1)
        return place

    add(np.arange(len(y)), 0)
    feature, limit, low, high, keep = zip(*nodes)
    return Tree(np.array(feature), np.array(limit), np.array(low), np.array(high), np.array(keep))


def labelled(pages=PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages; a block has its part's label."""
    split, labels = [], []
    for parts in pages:
        found = text_blocks("".join(markup for _, markup in parts))
        ends = np.cumsum([len(markup) for _, markup in parts])
        split.append(found)
        labels += [parts[int(np.searchsorted(ends, b.place, side="right"))][0] for b in found]
    return features(split), np.array(labels)


@lru_cache(maxsize=1)
def main_text_tree() -> Tree:
    return grow(*labelled())


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    split = [text_blocks(page) for page in pages]
    keep = tree(features(split))
    out, place = [], 0
    for page in split:
        out.append("\n\n".join(b.text for b, k in zip(page, keep[place:place + len(page)]) if k))
        place += len(page)
    return out


def extract_main_text(
    pages: DataFrame, markup: str = "html", name: str = "text", tree: Tree | None = None,
) -> DataFrame:
    """``pages`` without ``markup``, with the main text as ``name`` and its length ``n_chars``.

    Blocks are joined in page order by two line feeds; nothing else is added, dropped or cut. NULL and empty
    pages, and pages without an article, give an empty text. All other columns stay, but for those of the two
    names, which are replaced. Broken markup is read as it comes: an element that is never closed ends
    with the one around it, a comment or script that is never closed with the page. Pages are taken
    in batches of about a megabyte; one longer page is a batch.
    """
    tree = tree or main_text_tree()
    others = [c for c in pages.columns if c not in (markup, name, "n_chars")]
    kind = T.StructType([pages.schema[c] for c in others]).add(name, T.StringType()).add("n_chars", T.LongType())
    schema = to_arrow_schema(kind)
    hidden = "_llm_markup"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in row_blocks(batch, hidden):
                texts = main_texts([page or "" for page in block.column(hidden).to_pylist()], tree)
                columns = [block.column(c) for c in others]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), sizes], schema=schema)

    return map_batches(pages.select(*others, pages[markup].cast("string").alias(hidden)), run, kind)
