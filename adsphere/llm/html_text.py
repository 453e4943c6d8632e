"""Main text of HTML pages by text-to-tag ratio (operator 2).

The standard library's parser is fed the page in pieces and turned into lines: one line per
block, with the number of text characters and of tags in it and the containers (article,
main, section, div, …) it stands in.  Elements that never hold article text (scripts, styles,
menus, headers and footers of the page, sidebars, forms, notices, adverts, comments) are left
out by tag, by role and by the words of their class and id.  Such words do not count on
headings and paragraphs, in flags (``has-sidebar``), on elements that hold an article or main
or, where the page has none, most of its text; inside an article and on sections a name
counts only if nothing else is said in it (``comments``, not ``related-work``).

Each remaining line has a text-to-tag ratio.  The ratios, smoothed with a Gaussian over
neighbouring lines, are split by a threshold (a share of their standard deviation) into
content and other lines; runs of content lines are clusters.  The clusters that hold most of
the text set the content region: the innermost container that holds them all, widened to the
article or main around it or, where there is none, to the outermost container that adds no
left-out element and no line of mostly links; where they have none but the page itself,
everything from the first to the last of them, widened as far in the same way.  Every line
inside the region is kept, however short: the ratio chooses regions, it does not drop
paragraphs.

Defined cases: a NULL or empty page has the empty text; character references are decoded;
unclosed and badly nested elements are closed by their parents; repeated rows give repeated
results; an empty table gives an empty result; other columns of the input are ignored.  Rows
are independent: no shuffle.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr br".split())
NEVER = frozenset("script style noscript template head title nav footer aside form button select textarea option "
                  "iframe object svg canvas audio video dialog menu math".split())
CLOSES_ITSELF = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]),
                 "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]),
                 "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
SCOPES = frozenset("ul ol dl table article section div main body html blockquote nav aside header footer form".split())
CONTAINERS = frozenset("article main section div td blockquote".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("title style script noscript template meta link base basefont bgsound noframes".split())
UNSEEN = frozenset("script style noscript template head title iframe object svg canvas audio video math".split())

#: Words of a class or id that mark what is not the article (fixed values).
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar "
    "navigation navigator breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar comment comments "
    "commentlist disqus reply replies respond discussion notice notices cookie cookies consent gdpr alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "widget pagination pager copyright legal disclaimer search searchbox toc skip".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                        "toolbar".split())
#: Words that say nothing of their own beside those.
PLAIN_WORDS = frozenset(
    "area bar block body box button buttons center container content form group head icon icons inner item items left "
    "link links list main outer page panel post posts primary right row section site slot title top bottom unit "
    "view wrap wrapper".split())
FLAG = re.compile(r"(?i)^(has|no|is|with|without)[-_]|[-_](enabled|disabled)$")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

SIGMA = 1.0       # of the Gaussian over lines
RADIUS = 2
THRESHOLD = 0.5   # standard deviations of the smoothed ratios
MAIN_SHARE = 0.2  # a cluster counts if it has this share of the largest cluster's text
FEED = 1 << 16    # characters fed to the parser at once


#: Text, characters, tags, containers, characters in links, doubtful elements around it.  A
#: left-out element is a line without characters.
Line = tuple[str, int, int, tuple[int, ...], int, tuple[int, ...]]
LINKS = 0.5  # of a line's characters in links: the line is mostly links
MOST = 0.5   # of a page's text


def named_other(value: str, strict: bool) -> tuple[bool, bool]:
    """Whether a class or id names what is not the article, and whether it says nothing else."""
    some = False
    for name in value.split():
        if FLAG.search(name):
            continue
        words = {w.lower() for w in WORD.findall(name)}
        if not OTHER_WORDS.isdisjoint(words):
            if words <= OTHER_WORDS | PLAIN_WORDS:
                return True, True
            some = not strict
    return some, False


class Lines(HTMLParser):
    """Parser events → lines, containers from the outermost in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # element, left out, containers, in article, doubtful elements around it
        self.open: list[tuple[str, bool, tuple[int, ...], bool, tuple[int, ...]]] = []
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0
        self.containers = 0
        self.articles: dict[int, int] = {}  # container → 1 for main, 2 for article
        self.doubtful: list[bool] = []      # whether the name says nothing else
        self.holders: set[int] = set()      # doubtful elements that hold an article or main

    @property
    def out(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    @property
    def path(self) -> tuple[int, ...]:
        return self.open[-1][2] if self.open else ()

    @property
    def article(self) -> bool:
        return bool(self.open) and self.open[-1][3]

    @property
    def doubts(self) -> tuple[int, ...]:
        return self.open[-1][4] if self.open else ()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, len(text), self.tags, self.path, min(self.linked, len(text)), self.doubts))
            self.tags = 0
        self.parts = []
        self.linked = 0

    def left_out(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in NEVER:
            return True
        if tag in ("html", "body", "main", "article"):
            return False
        if tag == "header" and not self.article:
            return True
        for name, value in attrs:
            if name == "role" and value and value.lower() in OTHER_ROLES:
                return True
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
        return False

    def doubt(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[int, ...]:
        """The number of the element if its class or id speaks against it."""
        if tag in HEADING or tag in ("p", "html", "body", "main", "article"):
            return ()
        found = [named_other(value, self.article or tag == "section")
                 for name, value in attrs if name in ("class", "id") and value]
        if not any(some for some, _ in found):
            return ()
        self.doubtful.append(any(only for _, only in found))
        return (len(self.doubtful) - 1,)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open and self.open[-1][0] == "head" and tag not in IN_HEAD:
            self.cut(len(self.open) - 1)  # </head> is optional
        if tag == "br":
            self.parts.append(" ")
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            self.tags += not self.out
            return
        if tag in CLOSES_ITSELF:
            self.close_open(CLOSES_ITSELF[tag])
        elif tag not in INLINE:
            self.close_open(frozenset(["p"]))
        out = self.out or self.left_out(tag, attrs)
        if out and not self.out and tag not in UNSEEN:
            self.lines.append(("", 0, 0, self.path, 0, self.doubts))
        doubts = self.doubts if out else self.doubts + self.doubt(tag, attrs)
        if len(doubts) > len(self.doubts):
            self.flush()
        self.tags += not out
        path = self.path
        if tag in CONTAINERS:
            self.containers += 1
            path += (self.containers,)
            if tag in ("article", "main") and not out:
                self.articles[self.containers] = 1 + (tag == "article")
                self.holders.update(doubts)
        self.links += tag == "a"
        self.open.append((tag, out, path, self.article or tag == "article", doubts))

    def cut(self, at: int) -> None:
        """Close the open elements from place ``at`` on."""
        before = self.open[at - 1][4] if at else ()
        if len(self.doubts) > len(before):
            self.flush()
            self.tags = 0  # those of the doubtful element do not count for the next line
        self.links -= sum(e[0] == "a" for e in self.open[at:])
        del self.open[at:]

    def close_open(self, tags: frozenset) -> None:
        """Close the nearest open element of ``tags`` within the current scope."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                self.flush()
                self.cut(i)
                return
            if self.open[i][0] in SCOPES:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += not self.out
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.cut(i)
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and data.strip():
            self.cut(len(self.open) - 1)
        if not self.out:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def dropped(self) -> set[int]:
        """The doubtful elements to leave out."""
        size = np.zeros(len(self.doubtful), np.int64)
        inside = np.zeros(len(self.doubtful), np.int64)
        total = other = 0
        for _, n, _, path, _, doubts in self.lines:
            total += n
            in_article = any(c in self.articles for c in path)
            other += n * in_article
            for d in doubts:
                size[d] += n
                inside[d] += n * in_article
        return {d for d, only in enumerate(self.doubtful) if d not in self.holders
                and (only or other > inside[d] or size[d] <= MOST * total)}


def page_lines(html: str) -> tuple[list[Line], dict[int, int]]:
    """The page's lines, left-out elements among them, and which containers are articles."""
    parser = Lines()
    for i in range(0, len(html), FEED):
        parser.feed(html[i:i + FEED])
    parser.close()
    parser.flush()
    dropped = parser.dropped()
    lines = [line if dropped.isdisjoint(line[5]) else ("", 0, 0, line[3], 0, ()) for line in parser.lines]
    # an element named like the rest that holds all there is
    return (lines if any(line[1] for line in lines) else parser.lines), parser.articles


def smoothed(ratio: np.ndarray) -> np.ndarray:
    """The ratios under a Gaussian over the lines around each."""
    x = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-0.5 * (x / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[RADIUS:len(ratio) + RADIUS]
    return np.convolve(ratio, kernel)[RADIUS:len(ratio) + RADIUS] / weight


def content_region(every: list[Line], articles: dict[int, int]) -> list[bool]:
    """Which lines are the article."""
    lines = [line for line in every if line[1]]
    own = np.array([line[1] / max(line[2], 1) for line in lines])  # text characters per tag
    ratios = smoothed(own)
    threshold = THRESHOLD * ratios.std()
    content = ratios >= threshold
    size = np.array([line[1] for line in lines])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], content, [0]]).astype(np.int8)))
    clusters = [(a, b, size[a:b].sum()) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    largest = max(c[2] for c in clusters)
    chosen = [c for c in clusters if c[2] >= MAIN_SHARE * largest]
    # lines that only their neighbours lift over the threshold do not widen the container
    shared = os.path.commonprefix([lines[i][3] for a, b, _ in chosen for i in range(a, b) if own[i] >= threshold])
    foreign = [not n or linked > LINKS * n for _, n, _, _, linked, _ in every]
    around = [(-articles[c], i) for i, c in enumerate(shared) if c in articles]
    if around:  # the outermost article, or main where there is no article
        shared = shared[:min(around)[1] + 1]
    elif shared:
        depth = len(shared)
        alien = [os.path.commonprefix([line[3], shared]) for line, f in zip(every, foreign, strict=True) if f]
        near = max((len(a) for a in alien if len(a) < depth), default=-1)
        if near < 0:
            return [line[1] > 0 for line in every]
        shared = shared[:near + 1]
    if shared:
        return [line[1] > 0 and line[3][:len(shared)] == shared for line in every]
    places = [i for i, line in enumerate(every) if line[1]]
    first, last = places[chosen[0][0]], places[chosen[-1][1] - 1]
    while first > 0 and not foreign[first - 1]:
        first -= 1
    while last + 1 < len(every) and not foreign[last + 1]:
        last += 1
    return [line[1] > 0 and first <= i <= last for i, line in enumerate(every)]


def main_text(html: str | None) -> str:
    """The page's article: its blocks in order, one per line."""
    if not html:
        return ""
    lines, articles = page_lines(html)
    if not any(line[1] for line in lines):
        return ""
    return "\n".join(line[0] for line, keep in zip(lines, content_region(lines, articles), strict=True) if keep)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [main_text(h.as_py()) for h in part["html"]]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long")
