"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of its block elements and text blocks.  Each node has features of its subtree (density of text,
links and punctuation), its tag and attribute words, its depth, its ancestors and its siblings.  Boosted trees, fitted here on
generated pages of ``TRAIN_PAGES`` varied layouts whose main text is known, give each node the log-odds that it holds main text; a second
set, fitted on other pages, adds the first scores of parents and siblings.  Decoding picks the set of nodes with the largest sum
that holds each node's parent too, so no kept block lies in a refused container; menus, footers, asides and forms by tag are refused.

Defined results: a null or empty page has an empty text; repeated rows are read one by one; an empty table gives an empty one; other
columns are not read.  Nothing is cut or capped.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandmart.llm import boosting

#: Generated pages that the trees are fitted on.
TRAIN_PAGES = 1200
#: Characters of pages whose nodes are scored together.
GROUP_CHARS = 2_000_000

# Quantifiers are possessive, so a tag is read once, forwards.  A quote that is never closed is a character like others, and a tag whose quotes hide all
# that could end it is reported as broken: from there on tags end at the next ">", whatever the quotes.
_RAW = "script|style|title|noscript|template|svg|math|iframe|textarea|select"
_QUOTED = r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+"""


def _tokens(attributes: str, otherwise: str) -> re.Pattern:
    return re.compile(
        r"<!--.*?(?:-->|\Z)"
        rf"|<(?P<raw>{_RAW})\b{attributes}>.*?(?:</(?P=raw)\s*>|\Z)"
        rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?:(?P<attributes>{attributes})>{otherwise})"
        r"|<[!?/][^>]*>",
        re.DOTALL | re.IGNORECASE,
    )


TOKEN, BROKEN_TOKEN = _tokens(_QUOTED, "|(?P<broken>)"), _tokens("[^>]*+", "")
NAMES = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
ATTRIBUTE_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?]")

# Tags by their part in a page, and attribute words by theirs.
TAG_GROUPS = {
    "heading": "h1 h2 h3 h4 h5 h6", "paragraph": "p", "list": "ul ol li dl dt dd", "table": "table thead tbody tfoot tr td th caption",
    "quote": "blockquote pre figure figcaption", "article": "article", "main": "main", "section": "section", "div": "div center address",
    "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside", "form": "form fieldset legend button label dialog",
    "body": "html body",
}
ATTRIBUTE_GROUPS = {
    "content": "content article post entry story main text body page blog hentry markdown prose",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc topbar tabs",
    "side": "sidebar side aside widget rail secondary complementary", "foot": "footer foot bottom copyright legal colophon contentinfo",
    "head": "header masthead head top logo banner brand", "comment": "comment comments reply replies discussion disqus respond thread",
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion promoted adsense dfp",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay privacy message warning banner",
    "social": "share sharing social follow like tweet facebook", "related": "related recommended recommendations more trending popular latest teaser",
    "form": "form search login signup subscribe newsletter register contact", "meta": "meta byline author date tags tag category categories info caption",
}
TAG_INDEX = {t: k for k, tags in enumerate(TAG_GROUPS.values()) for t in tags.split()}
WORD_INDEX: dict[str, list[int]] = {}
for _k, _words in enumerate(ATTRIBUTE_GROUPS.values()):
    for _w in _words.split():
        WORD_INDEX.setdefault(_w, []).append(_k)
N_TAGS, N_WORDS = len(TAG_GROUPS), len(ATTRIBUTE_GROUPS)
TEXT_TAG, OTHER_TAG = N_TAGS, N_TAGS + 1
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that the start of an element ends.
ENDS = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "tbody": {"thead", "tbody", "tr", "td", "th", "p"}, "tfoot": {"thead", "tbody", "tr", "td", "th", "p"},
}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
TABLE = {"table"}
REFUSED = frozenset(TAG_INDEX[t] for t in ("nav", "footer", "aside", "form"))


class Page:
    """The nodes of a page in page order, parents before children; node 0 is the page."""

    def __init__(self, source: str | None) -> None:
        self.parent, self.tag, self.words, self.text = [-1], [TAG_INDEX["body"]], [0], [""]
        self.links = [0]
        self._stack = [("html", 0)]
        self._open: list[str] = []
        self._linked = self._in_link = 0
        self._read(source or "")
        self._flush()
        self._open_forms()

    def _open_forms(self) -> None:
        """A form that holds at least half of the page's text is a container like others, as on pages that are one form."""
        size = [len(t) for t in self.text]
        for k in range(len(size) - 1, 0, -1):
            size[self.parent[k]] += size[k]
        for k, tag in enumerate(self.tag):
            if tag == TAG_INDEX["form"] and 2 * size[k] >= size[0]:
                self.tag[k], self.words[k] = TAG_INDEX["div"], 0

    def _node(self, tag: int, words: int, text: str = "", links: int = 0) -> int:
        self.parent.append(self._stack[-1][1])
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        self.links.append(links)
        return len(self.parent) - 1

    def _flush(self) -> None:
        """End the open text block: references decoded, white space to one space."""
        if self._open:
            text = " ".join("".join(self._open).split())
            if text:
                self._node(TEXT_TAG, 0, text, min(self._linked, len(text)))
            self._open = []
        self._linked = 0

    def _say(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self._open.append(text)
        if self._in_link:
            self._linked += len(text)

    def _close(self, names: set[str], limits: set[str]) -> None:
        """End the innermost open element of these names, and what is open in it, unless a limit lies between."""
        for k in range(len(self._stack) - 1, 0, -1):
            name = self._stack[k][0]
            if name in names:
                self._flush()
                del self._stack[k:]
                return
            if name in limits:
                return

    def _read(self, source: str) -> None:
        at = 0
        for m in _marks(source):
            if m.start() > at:
                self._say(source[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if tag in VOID:
                if tag == "hr":
                    self._flush()
                elif tag == "br":
                    self._open.append(" ")
                continue
            if tag == "a":
                self._in_link = 0 if m["end"] else 1
            group = TAG_INDEX.get(tag)
            if group is None:
                continue
            if m["end"]:
                self._flush()
                self._close({tag}, TABLE if tag not in ("table", "article", "main", "body", "html", "section", "div") else set())
                if tag == "p":
                    self._in_link = 0
                continue
            self._flush()
            for name in ENDS.get(tag, ("p",)):
                self._close({name}, LIMITS.get(tag, TABLE) if name != "p" else TABLE | {"div", "td", "li", "article", "section", "blockquote"})
            if tag in ("html", "body"):
                continue
            words = 0
            if m["attributes"]:
                for value in NAMES.findall(m["attributes"]):
                    for w in ATTRIBUTE_WORD.findall(value):
                        for k in WORD_INDEX.get(w.lower(), ()):
                            words |= 1 << k
            self._stack.append((tag, self._node(group, words)))
        if at < len(source):
            self._say(source[at:])


def _marks(source: str):
    """Tags, comments and raw elements; behind the last ">" there are none."""
    last = source.rfind(">") + 1
    for m in TOKEN.finditer(source, 0, last):
        if "broken" in m.groupdict() and m["broken"] is not None:
            yield from BROKEN_TOKEN.finditer(source, m.start(), last)
            return
        yield m


FEATURES = 17 + 2 * (N_TAGS + 2) + 2 * N_WORDS


def features(page: Page) -> np.ndarray:
    """A row for each node."""
    n = len(page.parent)
    parent = np.array(page.parent)
    tag, words = np.array(page.tag), np.array(page.words)
    chars = np.array([len(t) for t in page.text], float)
    links = np.array(page.links, float)
    marks = np.array([len(PUNCTUATION.findall(t)) if t else 0 for t in page.text], float)
    is_text = tag == TEXT_TAG
    blocks, tags = is_text.astype(float), (~is_text).astype(float)
    depth = np.zeros(n)
    sums = np.stack((chars, links, marks, blocks, tags), axis=1)
    own_tag = np.zeros((n, N_TAGS + 2), np.float32)
    own_tag[np.arange(n), tag] = 1
    own_word = ((words[:, None] >> np.arange(N_WORDS)) & 1).astype(np.float32)
    above_tag, above_word = np.zeros_like(own_tag), np.zeros_like(own_word)
    for k in range(n - 1, 0, -1):
        sums[parent[k]] += sums[k]
    index, last, followed = np.zeros(n), {}, np.full(n, -1)
    before = np.full(n, -1)
    for k in range(1, n):
        p = page.parent[k]
        depth[k] = depth[p] + 1
        above_tag[k] = above_tag[p] + own_tag[p]
        above_word[k] = above_word[p] + own_word[p]
        if p in last:
            before[k] = last[p]
            followed[last[p]] = k
            index[k] = index[last[p]] + 1
        last[p] = k
    family = np.bincount(parent[1:], minlength=n).astype(float)
    siblings = np.where(parent >= 0, family[np.maximum(parent, 0)], 1)
    same = np.zeros(n)
    if n > 1:
        _, where, count = np.unique(parent * 100 + tag, return_inverse=True, return_counts=True)
        same = count[where].astype(float)
    total = max(sums[0, 0], 1)
    start = np.concatenate(([0], np.cumsum(chars)[:-1]))
    size, link, mark, block, element = sums.T
    neighbour = lambda which: np.where(which >= 0, np.log1p(size[np.maximum(which, 0)]), 0)
    base = np.stack(
        (
            depth, np.log1p(size), link / np.maximum(size, 1), np.log1p(size / np.maximum(element, 1)), 100 * mark / np.maximum(size, 1),
            np.log1p(block), np.log1p(size / np.maximum(block, 1)), start / total, size / total, index, siblings, same,
            size / np.maximum(size[np.maximum(parent, 0)], 1), neighbour(before), neighbour(followed),
            np.array([("©" in t) or ("All rights" in t) for t in page.text], float), family,
        ),
        axis=1,
    )
    return np.concatenate((base, own_tag, np.minimum(above_tag, 3), own_word, np.minimum(above_word, 3)), axis=1).astype(np.float32)


def around(page: Page, scores: np.ndarray) -> np.ndarray:
    """First scores of the node, its parent and grandparent, its neighbours, and the mean of its siblings, of those like it and of its children."""
    n = len(scores)
    parent, tag = np.array(page.parent), np.array(page.tag)
    up = np.maximum(parent, 0)
    _, where = np.unique(parent * 100 + tag, return_inverse=True)
    mean = lambda keys, size, of: (np.bincount(keys, scores[of], size) / np.maximum(np.bincount(keys, minlength=size), 1))
    inner = np.arange(1, n)
    children = mean(up[inner], n, inner)
    before, after, last = np.full(n, -9.0), np.full(n, -9.0), {}
    for k in range(1, n):
        if (j := last.get(page.parent[k])) is not None:
            before[k], after[j] = scores[j], scores[k]
        last[page.parent[k]] = k
    alike = mean(where, int(where.max()) + 1, np.arange(n))[where]
    return np.stack((scores, scores[up], scores[up[up]], children[up], alike, before, after, children), axis=1).astype(np.float32)


def scored(pages: list[Page], trees: tuple[boosting.Trees, boosting.Trees]) -> list[np.ndarray]:
    """Log-odds of each page's nodes."""
    found = [features(p) for p in pages]
    ends = np.cumsum([len(x) for x in found])[:-1]
    x = np.concatenate(found)
    first = np.split(trees[0].scores(x), ends)
    more = np.concatenate([around(p, s) for p, s in zip(pages, first, strict=True)])
    return np.split(trees[1].scores(np.concatenate((x, more), axis=1)), ends)


def decode(page: Page, scores: np.ndarray) -> list[int]:
    """Text nodes of the best set of nodes in which each node's parent is kept too."""
    gain = scores.tolist()
    for k in range(len(gain) - 1, 0, -1):
        if gain[k] > 0 and page.tag[k] not in REFUSED:
            gain[page.parent[k]] += gain[k]
    keep = [True] + [False] * (len(gain) - 1)
    for k in range(1, len(gain)):
        keep[k] = keep[page.parent[k]] and gain[k] > 0 and page.tag[k] not in REFUSED
    return [k for k in range(1, len(gain)) if keep[k] and page.text[k]]


def main_texts(sources: list[str | None], trees: tuple[boosting.Trees, boosting.Trees]) -> list[str]:
    """Main text of each page, blocks joined by an empty line."""
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    return ["\n\n".join(p.text[k] for k in decode(p, s)) for p, s in zip(pages, scored(pages, trees), strict=True)]


@lru_cache(maxsize=1)
def model(pages: int = TRAIN_PAGES, seed: int = 11) -> tuple[boosting.Trees, boosting.Trees]:
    """Both sets of trees, each fitted on half of the generated pages; a node is positive when it is or holds a main block."""
    from strandmart.llm.page_layouts import labelled_pages

    made, rows, labels = [], [], []
    for source, main in labelled_pages(pages, seed):
        page = Page(source)
        y = np.array([1.0 if t in main else 0.0 for t in page.text])
        for k in range(len(y) - 1, 0, -1):
            y[page.parent[k]] = max(y[page.parent[k]], y[k])
        made.append(page)
        rows.append(features(page))
        labels.append(y)
    half = pages // 2
    first = boosting.fit(np.concatenate(rows[:half]), np.concatenate(labels[:half]), trees=30)
    more = [np.concatenate((x, around(p, first.scores(x))), axis=1) for x, p in zip(rows[half:], made[half:], strict=True)]
    return first, boosting.fit(np.concatenate(more), np.concatenate(labels[half:]), trees=40)


def main_text(pages: DataFrame, trees: tuple[boosting.Trees, boosting.Trees] | None = None, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns with ``text`` and ``n_chars`` of each page."""
    shared = pages.sparkSession.sparkContext.broadcast(trees or model())
    slim = pages.select(*keep, html_col)
    fields = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in keep)

    def extract(batches):
        for batch in batches:
            sources = batch.column(len(keep)).to_pylist()
            texts, first, size = [], 0, 0
            for k, s in enumerate(sources):
                size += len(s or "")
                if size > GROUP_CHARS or k == len(sources) - 1:
                    texts += main_texts(sources[first : k + 1], shared.value)
                    first, size = k + 1, 0
            columns = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*keep, "text", "n_chars"])

    return slim.mapInArrow(extract, f"{fields}, text string, n_chars long")
