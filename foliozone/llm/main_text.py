"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams events; they become lines, one for every block of text, each
with its number of characters, of characters inside links and of tags, and its place in the page.

**Dense lines.** A line's ratio is its characters outside links to its tags, on a logarithmic scale.
The ratios are smoothed with a Gaussian and split in two clusters by a threshold between their means.
A line is dense if it reaches the threshold both smoothed and by itself. This is computed for every
page, and all that follows goes by the characters of dense lines.

**Labels.** A page may label a part as something else than content: by element, role, style, or the
whole name of a class or id. Such a part is left out, unless it holds ``WHOLE`` of the dense text: a page
inside a form, or an article called a widget, is not silenced by that. Labels inside it count then.

**Region.** What is left is clustered again. If the page's ``article`` and ``main`` elements hold most of
the dense text, their lines are the content; else it is the smallest element that holds all dense
lines, widened to the elements around it for as long as what that adds is not lists of links.
All lines of the region are kept, whatever elements they are in, but for lists of links: three or
more lines in a row, none of them dense, whose text is inside links.

Broken markup: open paragraphs, list items and cells end where the next one starts, unknown end
tags are ignored, and what is still open at the end closes there. Character references are decoded,
white space becomes one space. Null, empty and textless pages give an empty text. Repeated rows
get equal results, one each; other columns are not looked at. A page is one row's work, in time
that grows with its length however deep it nests; nothing is exchanged.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from foliozone.llm.tables import small_batches

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html label legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text.
SKIPPED = frozenset("audio button canvas datalist head iframe object option script select style svg template textarea title video".split())
#: Elements that say they are not content.
LABELS = frozenset("aside dialog footer form label menu nav noscript search".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Names of classes and ids that say the same; an underscore counts as a hyphen.
NAMES = frozenset(
    "ad ads adbox ad-box adslot ad-slot advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments comment-list comments-area comments-section commentlist "
    "consent cookie cookies cookie-banner cookie-consent cookie-notice disqus disqus-thread footer footer-widgets gdpr main-menu main-nav main-navigation masthead menu menus modal nav navbar "
    "nav-menu navigation newsletter newsletter-signup notice notices page-footer page-header pager pagination popup post-navigation promo promotion related related-articles related-posts replies "
    "respond share share-buttons sharing sidebar sidebars sidebar-left sidebar-right site-footer site-header site-nav site-navigation skip-link social social-links social-share sponsor sponsored "
    "subscribe toolbar top-bar topbar top-menu user-comments widget widget-area widgets".split()
)
#: What an element of these ends when it starts, and where looking for it stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CONTAINERS = frozenset("article blockquote body center div main section table td".split())
SIGMA, REACH = 1.0, 3
#: A labelled part with this share of the dense text is content; so are articles with more than that of theirs.
WHOLE, MOST = 0.9, 0.5
#: On the logarithmic scale of ratios.
APART = 1.0
#: Lines in a row that make a list of links.
LINKS = 3

_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Line:
    text: str
    tags: int
    container: int
    region: int  # the outermost article or main around it, 0 for none
    label: int  # the innermost labelled part around it, 0 for none
    linked: int  # characters inside links, white space aside

    @property
    def size(self) -> int:
        """Characters outside links."""
        return max(0, len(self.text) - self.linked - (self.text.count(" ") if self.linked else 0))

    @property
    def is_link(self) -> bool:
        return 2 * self.linked > len("".join(self.text.split()))


@dataclass
class Open:
    tag: str
    skipped: bool
    container: int
    region: int
    label: int
    link: bool = False


class Lines(HTMLParser):
    """Turns events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack = [Open("", False, 0, 0, 0)]
        self.places: dict[str, list[int]] = {}  # by tag: where it is open
        self.blocks = [0]  # where blocks are open
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.around = [0]  # by container: the one around it
        self.above = [0]  # by labelled part: the one around it

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        top = self.stack[-1]
        if text and not top.skipped:
            self.lines.append(Line(text, self.tags, top.container, top.region, top.label, self.linked))
            self.tags = 0
        self.parts.clear()
        self.linked = 0

    def cut(self, k: int) -> None:
        """Close all from place k on."""
        for o in self.stack[k:]:
            self.places[o.tag].pop()
        del self.stack[k:]
        while self.blocks[-1] >= k:
            self.blocks.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag in BLOCKS
        if block or tag in SKIPPED:
            self.end_line()
        self.tags += 1
        if block:
            self.close_before(tag)
        if tag in VOID:
            if tag in ("br", "hr"):
                self.parts.append("\n")
            return
        top = self.stack[-1]
        container, region, label = top.container, top.region, top.label
        if tag in CONTAINERS:
            self.around.append(container)
            container = len(self.around) - 1
            if not region and tag in ("article", "main"):
                region = container
        if self.labelled(tag, attrs):
            self.above.append(label)
            label = len(self.above) - 1
        self.places.setdefault(tag, []).append(len(self.stack))
        if block:
            self.blocks.append(len(self.stack))
        self.stack.append(Open(tag, top.skipped or tag in SKIPPED, container, region, label, top.link or tag == "a"))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        places = self.places.get(tag)
        # an inline end tag ends nothing outside its block
        if places and (tag in BLOCKS or self.blocks[-1] < places[-1]):
            if tag in SKIPPED or self.blocks[-1] >= places[-1]:
                self.end_line()
            self.cut(places[-1])
        self.tags += 1

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.stack[-1].link:
            self.linked += len("".join(data.split()))

    def close_before(self, tag: str) -> None:
        """Ends the open paragraph, and what else the start of ``tag`` ends."""
        own, stop = ENDS.get(tag, (set(), set()))
        if not own:
            last = self.blocks[-1]
            if self.stack[last].tag == "p":
                self.cut(last)
            return
        limit = max((self.places[name][-1] for name in stop if self.places.get(name)), default=0)
        found = [places[k] for name in (*own, "p") if (places := self.places.get(name)) and (k := bisect_right(places, limit)) < len(places)]
        if found:
            self.cut(min(found))

    def labelled(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        """Whether the page says that this element is not content."""
        if tag in LABELS:
            return True
        if tag == "header":  # of the page; an article's own header has its title
            return not self.stack[-1].region
        if tag in ("html", "body", "article", "main"):
            attrs = [a for a in attrs if a[0] in ("class", "id") and tag == "article"]
        for key, value in attrs:
            value = (value or "").lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in ROLES):
                return True
            if key == "style" and _HIDDEN.search(value):
                return True
            if key in ("class", "id") and not NAMES.isdisjoint(value.replace("_", "-").split()):
                return True
        return False


def smoothed(values: list[float]) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is cut and keeps its sum."""
    kernel = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(REACH + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - REACH), min(len(values), i + REACH + 1)
        weights = [kernel[abs(i - j)] for j in range(lo, hi)]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi], strict=True)) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Between the means of two clusters, moved until it stays."""
    low, high = min(values), max(values)
    cut = (low + high) / 2
    for _ in range(50):
        upper = [v for v in values if v >= cut]
        lower = [v for v in values if v < cut]
        if not lower or not upper:
            break
        moved = (sum(upper) / len(upper) + sum(lower) / len(lower)) / 2
        if moved == cut:
            break
        cut = moved
    return cut


def dense(lines: list[Line]) -> list[bool]:
    """The upper of two clusters of smoothed ratios, but for lines that are high by their neighbours alone.

    Clusters whose means lie within ``APART`` of each other are one, and all of its lines dense.
    """
    if not lines:
        return []
    own = [math.log1p(x.size / max(1, x.tags)) for x in lines]
    ratios = smoothed(own)
    cut = threshold(ratios)
    upper, lower = [r for r in ratios if r >= cut], [r for r in ratios if r < cut]
    if not lower or sum(upper) / len(upper) - sum(lower) / len(lower) < APART:
        cut = min(own + ratios)
    marks = [r >= cut and o >= cut for r, o in zip(ratios, own, strict=True)]
    if not any(marks):
        marks[own.index(max(own))] = True
    return marks


def unlabelled(lines: list[Line], above: list[int]) -> list[Line]:
    """The lines outside labelled parts; a part that holds nearly all dense text is none."""
    held = [0] * len(above)  # dense characters in each part
    for x, mark in zip(lines, dense(lines), strict=True):
        held[x.label] += x.size if mark else 0
    for part in range(len(above) - 1, 0, -1):  # parts are numbered as they open
        held[above[part]] += held[part]
    ignored = [h >= WHOLE * max(held[0], 1) for h in held]
    silent = [False] * len(above)
    for part in range(1, len(above)):
        silent[part] = silent[above[part]] or not ignored[part]
    return [x for x in lines if not silent[x.label]]


def without_links(lines: list[Line], marks: list[bool]) -> list[Line]:
    """Runs of ``LINKS`` lines or more that are links go."""
    out, run = [], []
    for x, mark in zip(lines, marks, strict=True):
        if x.is_link and not mark:
            run.append(x)
            continue
        out.extend([*(run if len(run) < LINKS else ()), x])
        run = []
    return out + (run if len(run) < LINKS else [])


def region(lines: list[Line], marks: list[bool], around: list[int]) -> tuple[list[Line], list[bool]]:
    """The lines of the content region; ``around``: the container around each container."""
    total = sum(x.size for x, mark in zip(lines, marks, strict=True) if mark)
    named = sum(x.size for x, mark in zip(lines, marks, strict=True) if mark and x.region)
    if named and named > MOST * total:
        inside = [bool(x.region) for x in lines]
    else:
        # containers are numbered as they open, so the largest number is never around another
        heap = [-c for c in {x.container for x, mark in zip(lines, marks, strict=True) if mark}]
        heapify(heap)
        while len(heap) > 1:
            at = heappop(heap)
            if heap[0] != at:
                heappush(heap, -around[-at])
        at, n = -heap[0], 0
        level = {at: 0}  # 0: the common container, 1: the one around it, and so on
        while at:
            at, n = around[at], n + 1
            level[at] = n
        for c in range(len(around)):
            level.setdefault(c, level[around[c]] if c else n)
        limit = min((level[x.container] for x in lines if level[x.container] and x.is_link), default=n + 1)
        inside = [level[x.container] < limit for x in lines]
    return [x for x, i in zip(lines, inside, strict=True) if i], [m for m, i in zip(marks, inside, strict=True) if i]


def content(lines: list[Line], around: list[int], above: list[int]) -> list[str]:
    lines = unlabelled(lines, above)
    if not lines:
        return []
    return [x.text for x in without_links(*region(lines, dense(lines), around))]


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return "\n\n".join(content(parser.lines, parser.around, parser.above))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    small_batches(pages.sparkSession)
    text = arrow_udf(lambda pages: pa.array([main_text(p) if p else "" for p in pages.to_pylist()], pa.string()), "string")
    return pages.select("page_id", "url", text("html").alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
