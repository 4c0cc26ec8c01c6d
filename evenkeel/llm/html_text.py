"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's streaming parser is fed piece by piece. Its events make *lines*: the text between two block
boundaries, with the number of tags and of link characters seen in it. A line's text-to-tag ratio is its characters
per tag. The ratios, in page order, are smoothed by a Gaussian; lines above the threshold (the standard deviation,
at most half the largest smoothed value) are clusters of content.

Elements that are menus, footers, scripts and so on by their tag hold no lines. What a class, id or role calls so, and
forms, is evidence only: such lines take part in the ratios, and the element goes unless it holds a cluster, most of the
page's text and every article; a comment section goes whatever it holds. Clusters are found again among what is left. The article or main
element with most text in lines of at least a tenth of the threshold is taken whole, so that it keeps its heading, short
paragraphs, sections, table cells and link lists. If the clusters outside such elements hold more, or there is none, what is taken is the common
parent of all clusters: a table cell or the page, there without the mostly linked lines before the first and after the last
cluster.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEED = 1 << 16
SIGMA = 1.0
WEAK = 0.1  # share of the threshold from which a line of an article counts
PAGES = 64  # pages held as text at a time

# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that are never content.
CLUTTER = frozenset(
    "aside button canvas datalist dialog footer head iframe map menu nav noscript object option script select style svg "
    "template textarea title".split()
)
# Elements that make a form one that is filled in.
CONTROLS = frozenset("button input select textarea".split())
# Elements that begin a new line. All others are part of a line.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
# Elements that make a region of their own.
REGION = frozenset("article body main section td".split())
# Elements whose end tag is often left out, and what else ends them.
CLOSES = {
    "p": frozenset(("p",)),
    "li": frozenset(("p", "li")),
    "dt": frozenset(("p", "dt", "dd")),
    "dd": frozenset(("p", "dt", "dd")),
    "tr": frozenset(("p", "td", "th", "tr")),
    "td": frozenset(("p", "td", "th")),
    "th": frozenset(("p", "td", "th")),
}
# Words in a class, id or role that mark an element as clutter.
CLUTTER_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "contentinfo cookie cookies disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices overlay pagination popup promo promoted promotion recommended related replies respond rss search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription tags teaser teasers toolbar topbar widget widgets".split()
)
# On these elements such words describe the page; an article can still be a comment or a teaser.
ARTICLE = frozenset(("article", "main", "body", "html"))
ARTICLE_CLUTTER = frozenset("ad advert comment promo recommended related reply sponsored teaser".split())
# Inside an article these words name its own head.
HEADS = frozenset(("header", "masthead", "banner"))
# What these words mark is never the main text, however much of it there is.
READERS = frozenset("comment comments commentlist disqus replies reply respond".split())
# A name's first part marks the element only before words like these: ``comment-list``, but not ``ad-free-layout``.
PLACES = frozenset(
    "area bar block body bottom box button buttons card container content feed inner item items left link links list main menu "
    "outer panel post posts primary region right row secondary section slot stack text thread top unit wrap wrapper".split()
)
# Before a name these words say that the element is beside such a thing, or without it.
BESIDE = frozenset("has hide is no not show with without".split())
_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_SPACE = re.compile(r"\s+")


def marks(value: str, words: frozenset[str]) -> str | None:
    """The word by which a class, id or role names clutter: a whole name, its last part, or its first before a place."""
    for name in value.split():
        parts = [part.lower() for part in _NAME.findall(name)]
        if not parts or parts[0] in BESIDE:
            continue
        if parts[-1] in words:
            return parts[-1]
        if parts[0] in words and all(part in PLACES for part in parts[1:]):
            return parts[0]
    return None


class Lines(HTMLParser):
    """Collects the lines of one page: text, tags, link characters, region, and the innermost mark they lie in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # element, clutter, region, mark
        self.places: dict[str, list[int]] = {}  # where in ``open`` an element stands
        self.blocks: list[int] = []  # where in ``open`` block elements stand
        self.regions = 1
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.links: list[int] = []
        self.region: list[int] = []
        self.mark: list[int] = []
        self.parent: list[int] = [0]
        self.kind: list[str] = ["html"]
        self.around: list[int] = [0]  # of each mark the one around it; 0 is no mark
        self.word: list[str] = [""]
        self.controls: list[int] = [0]
        self._text: list[str] = []
        self._tags = self._link = 0

    def _state(self) -> tuple[bool, int, int]:
        return self.open[-1][1:] if self.open else (False, 0, 0)

    def _within(self, *names: str) -> bool:
        return any(self.places.get(name) for name in names)

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self._text)).strip()
        if text:
            _, region, mark = self._state()
            self.texts.append(text)
            self.tags.append(self._tags)
            self.links.append(self._link)
            self.region.append(region)
            self.mark.append(mark)
            self._tags = 0
        self._text.clear()
        self._link = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.end_line()
            self._close_implied(tag)
        self._tags += 1
        clutter, region, mark = self._state()
        if tag in CONTROLS:
            self.controls[mark] += 1
        if tag == "br":
            self._text.append(" ")
        if tag in VOID:
            return
        if tag in ("article", "main") and not self._within("article", "main"):
            clutter = self._within(*CLUTTER)  # a hidden block before it was left open
        clutter = clutter or tag in CLUTTER or any(
            name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attrs
        )
        word = "form" if tag in ("form", "fieldset") else self._word(tag, attrs)
        if tag == "header" and not self._within("article", "main"):
            clutter = True
        if word:
            self.around.append(mark)
            self.word.append(word)
            self.controls.append(0)
            mark = len(self.word) - 1
        if tag in REGION:
            self.parent.append(region)
            self.kind.append(tag)
            region, self.regions = self.regions, self.regions + 1
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append((tag, clutter, region, mark))

    def _word(self, tag: str, attrs: list[tuple[str, str | None]]) -> str | None:
        words = CLUTTER_WORDS if tag not in ARTICLE else ARTICLE_CLUTTER if tag == "article" else frozenset()
        if self._within("article", "main"):
            words = words - HEADS
        for name, value in attrs:
            if name in ("class", "id", "role") and value and (found := marks(value, words)):
                return found
        return None

    def _close_implied(self, tag: str) -> None:
        """A new block ends an open paragraph, a new item an open item; all that can be ended are blocks."""
        if self.blocks and self.open[self.blocks[-1]][0] in CLOSES.get(tag, CLOSES["p"]):
            self._pop(self.blocks[-1])

    def _pop(self, at: int) -> None:
        for name, *_ in reversed(self.open[at:]):
            self.places[name].pop()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()
        del self.open[at:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.end_line()
        self._tags += 1
        at = self.places.get(tag)
        # An end tag without its element is passed over; that of an inline element does not reach out of its block.
        if at and (tag in BLOCK or not self.blocks or self.blocks[-1] < at[-1]):
            self._pop(at[-1])

    def handle_data(self, data: str) -> None:
        if not self._state()[0]:
            self._text.append(data)
            if self._within("a"):
                self._link += len(data)


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing with the ends mirrored."""
    reach = max(1, int(np.ceil(3 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(values, reach, mode="symmetric") if len(values) else values
    return np.convolve(padded, weights / weights.sum(), mode="valid") if len(values) else values


def page_lines(html: str) -> Lines:
    lines = Lines()
    for at in range(0, len(html), FEED):
        lines.feed(html[at : at + FEED])
    lines.close()
    lines.end_line()
    return lines


def strength(length: np.ndarray, tags: np.ndarray, dense: np.ndarray, sigma: float) -> np.ndarray:
    """Smoothed text-to-tag ratio of each line as a share of the threshold: 1 in a cluster, less outside; 0 for ``dense``
    lines, which are mostly links."""
    ratio = length / np.maximum(tags, 1)
    score = smoothed(np.where(dense, 0.0, ratio), sigma)
    threshold = min(float(np.std(ratio)), float(score.max()) / 2)
    share = np.minimum(score / threshold, 1.0) if threshold > 0 else np.ones(len(score))
    return np.where(dense, 0.0, share)


def _dropped(lines: Lines, length: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which marks take their lines with them: all but those with a cluster and more than half of the page's text, on
    pages that have no article outside of it, and forms without anything to fill in. What lies in a dropped mark is
    dropped."""
    n = len(lines.word)
    mark, text, dense = np.array(lines.mark), np.zeros(n), np.zeros(n, bool)
    np.add.at(text, mark, length)
    dense[mark[chosen]] = True
    articles = np.bincount(mark, _articles(lines)[lines.region] > 0, n)
    controls = list(lines.controls)
    for at in range(n - 1, 0, -1):  # marks come after what is around them
        text[lines.around[at]] += text[at]
        dense[lines.around[at]] |= dense[at]
        articles[lines.around[at]] += articles[at]
        controls[lines.around[at]] += controls[at]
    gone = np.zeros(n, bool)
    for at in range(1, n):
        word = lines.word[at]
        bulk = dense[at] and text[at] * 2 > text[0] and articles[at] == articles[0]
        empty = word == "form" and not controls[at]
        gone[at] = gone[lines.around[at]] or word in READERS or not (bulk or empty)
    return gone


def content_lines(lines: Lines, sigma: float = SIGMA) -> list[str]:
    """The lines of the article or, if the page has none that holds most of the content, of the clusters' common parent."""
    if not lines.texts:
        return []
    length = np.array([len(t) for t in lines.texts], float)
    tags, dense = np.array(lines.tags), np.array(lines.links) * 2 > length
    left = ~_dropped(lines, length, strength(length, tags, dense, sigma) >= 1)[lines.mark]
    if not left.any():
        return []
    share = np.zeros(len(length))
    share[left] = strength(length[left], tags[left], dense[left], sigma)
    chosen = share >= 1
    region = np.array(lines.region)
    article = _articles(lines)[region]  # of every line, 0 outside
    inside = np.bincount(article, length * (share >= WEAK))
    inside[0] = length[chosen & (article == 0)].sum()
    if not inside.any():
        inside = np.bincount(article, length * left)
        inside[0] = 0
    best = int(np.argmax(inside))
    if best:
        kept = article == best
    elif not chosen.any():
        kept = ~dense
    else:
        at = np.flatnonzero(chosen)
        between = (np.arange(len(dense)) > at[0]) & (np.arange(len(dense)) < at[-1])
        kept = _below(lines, _common_parent(lines, set(region[chosen].tolist())))[region] & (~dense | between)
    return [text for text, keep in zip(lines.texts, (kept & left).tolist()) if keep]


def _articles(lines: Lines) -> np.ndarray:
    """The outermost article or main element around each region, 0 where there is none."""
    found = np.zeros(len(lines.parent), np.int64)
    for at in range(1, len(found)):  # parents come first
        found[at] = found[lines.parent[at]] or (at if lines.kind[at] in ("article", "main") else 0)
    return found


def _below(lines: Lines, top: int) -> np.ndarray:
    """Which regions are ``top`` or lie below it."""
    found = np.zeros(len(lines.parent), bool)
    found[top] = True
    for at in range(top + 1, len(found)):
        found[at] = found[lines.parent[at]]
    return found


def _common_parent(lines: Lines, regions: set[int]) -> int:
    """The innermost region around all of ``regions`` that is a whole: not a section, which is part of one."""
    rest = set(regions)
    while len(rest) > 1:
        last = max(rest)  # no other one lies below it
        rest.remove(last)
        rest.add(lines.parent[last])
    top = rest.pop()
    while lines.kind[top] == "section":
        top = lines.parent[top]
    return top


def extract(html: str | None, sigma: float = SIGMA) -> str:
    return "\n".join(content_lines(page_lines(html), sigma)) if html else ""


def main_text(pages: DataFrame, sigma: float = SIGMA) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    ``text`` is the lines of the page's article in page order, joined by a line feed: character references decoded, white
    space within a line made one blank, nothing but marked elements left out. On a page of several articles that is the
    one with most text that is not thin by its ratio; on a page without one, see the module. A null or empty page, or one without content, has an empty text.
    Unclosed and badly nested elements are closed as browsers do. Repeated rows give repeated rows, an empty table an
    empty result; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), PAGES):
                some = batch.slice(at, PAGES)
                texts = [extract(html, sigma) for html in some["html"].to_pylist()]
                yield pa.record_batch([some["page_id"], some["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    fields = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    schema = f"page_id {fields['page_id']}, url {fields['url']}, text string"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
