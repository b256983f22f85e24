"""Main text of web pages: parser events, text-to-tag ratio, smoothing, threshold clustering.

The standard library's parser is fed in slices and its events make *lines*, one for each
block of text. Each line has its number of characters and of tags. The ratio of the two
is smoothed along the page with a Gaussian kernel; lines at or above the threshold (the
standard deviation of the smoothed ratios, at most half their maximum) form the content
cluster. The deepest element that holds nearly all text of that cluster is widened to the
article or main element around it, or else until it holds all of the cluster. This is the region,
and every line of the region is kept, however short, except in parts that are never
article text: elements such as nav, aside, footer or hidden ones, and *marked* elements
(forms, and those with a word such as ad, sidebar, comments or cookie in class, id or role).
A mark never removes the article itself: marked elements around the article or main element
(without one, around the first heading) are wrappers, and so is a marked element that holds
nearly all text of the page. A mark that may be meant otherwise (a menu, or an ambiguous word beside an unknown one,
such as related-work or ad-hoc-analysis) is decided by density: within an article or main element the part stays
if its text-to-tag ratio reaches the threshold and little of it is links. Outside an article or main element, lines that are nothing but
links, with a ratio below the threshold, are menus and go too.

Inside a block white space becomes one space (a line break element counts as white
space); blocks are joined by one newline.

Defined results: null or empty html and pages without text give "", 0; repeated rows
repeat; an empty table gives an empty result; other columns are not read; long pages
are read whole.
"""

from __future__ import annotations

import collections
import heapq
import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SLICE = 1 << 16  # characters fed at a time
SIGMA = 1.5  # lines
HOLDS = 0.9  # share of the cluster's text that the region must hold

BARE = 100  # characters; less text than this outside marked elements is no article

# Elements by role.
SKIPPED = frozenset("head nav aside footer script style noscript template iframe svg canvas object button select textarea dialog menu".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end of themselves when a block or one of their own kind begins.
LOOSE = frozenset("p li dt dd tr td th option".split())
REGIONS = frozenset("article main section div td body html form".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Hints for lists of links: prose in such a part is no menu.
LINKS = frozenset("breadcrumb breadcrumbs menu nav navbar navigation pager pagination toolbar".split())
#: Hints that are ordinary words too, and the words that leave them their usual meaning.
AMBIGUOUS = LINKS | frozenset("ad ads banner modal notice notices related share sharing social widget".split())
COMPANIONS = frozenset(
    "area article articles bar block body bottom box btn button buttons col column container content desktop follow global "
    "group heading icon icons image inline inner item items label left link links list main media mobile more news outer page panel "
    "placeholder post posts primary reading right row secondary section site slot space sticky stories story text title top unit "
    "wrap wrapper zone".split()
)
UNLINKED = 0.8  # least share of an ambiguous part's text outside links, for it to stay
#: A name with one of these tells what surrounds or lacks the thing: has-sidebar, no-ads.
AROUND = frozenset("has no not with without hide".split())
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _marked(attrs: list) -> tuple[bool, bool]:
    """Whether class, id or role tells of a part that is no article text, and whether only an ambiguous name does."""
    found = soft = False
    for name, value in attrs:
        if name in ("class", "id"):
            for token in (value or "").split():
                words = {w.lower() for w in _WORDS.findall(token)}
                hints = words & HINTS
                if not hints or words & AROUND:
                    continue
                if not (hints <= LINKS or hints <= AMBIGUOUS and words - HINTS - COMPANIONS):
                    return True, False
                found = soft = True
        if name == "role" and (value or "").strip().lower() in ROLES:
            return True, False
    return found, soft


def _unseen(attrs: list) -> bool:
    return any(
        n == "hidden" or n == "aria-hidden" and v == "true" or n == "style" and v and _UNSEEN.search(v.lower()) for n, v in attrs
    )


class Line(NamedTuple):
    text: str
    tags: int
    skipped: bool
    region: int
    mark: int  # innermost marked element, 0 for none
    linked: bool  # nothing but link text
    heading: bool


class Lines(HTMLParser):
    """Parser events -> lines, with the trees of region elements and of marked elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, bool]] = []  # tag, skipped from here on, region or -1, marked
        self.skipped = 0
        self.regions = [0]
        self.parent = {0: -1}
        self.marks = [0]
        self.mark_parent = {0: -1}
        self.soft: set[int] = set()  # marks by ambiguous names
        self.articles: dict[int, int] = {}  # article and main elements without a mark of their own -> mark around them
        self.inside = collections.Counter()  # open elements by tag
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0
        self.unlinked = 0

    @property
    def n_regions(self) -> int:
        return len(self.parent)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, self.skipped > 0, self.regions[-1], self.marks[-1], not self.unlinked, self.inside["h1"] > 0))
            self.tags = 0
        self.parts, self.unlinked = [], 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections that HTML does not know, as word processors write them, are comments up to the next >."""
        return super().parse_marked_section(i, report) if self.rawdata.startswith("<![CDATA[", i) else self.parse_bogus_comment(i, report)

    def _pop(self) -> None:
        tag, skip, region, mark = self.stack.pop()
        self.skipped -= skip
        if region >= 0:
            self.regions.pop()
        if mark:
            self.marks.pop()
        self.inside[tag] -= 1

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            while self.stack and self.stack[-1][0] not in BLOCK and any(x[0] in LOOSE for x in self.stack[-3:]):
                self._pop()  # inline elements left open in a paragraph end with it
            if self.stack and (self.stack[-1][0] == "p" or self.stack[-1][0] == tag and tag in LOOSE):
                self._pop()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        skip = tag in SKIPPED or _unseen(attrs) or tag == "header" and not (self.inside["article"] or self.inside["main"])
        mark, soft = (True, False) if tag == "form" else _marked(attrs)
        mark = mark and tag not in ("html", "body")
        region = -1
        if tag in REGIONS:
            region = self.n_regions
            self.parent[region] = self.regions[-1]
            self.regions.append(region)
            if tag in ("article", "main") and not mark:
                self.articles[region] = self.marks[-1]
        if mark:
            self.mark_parent[len(self.mark_parent)] = self.marks[-1]
            self.marks.append(len(self.mark_parent) - 1)
            if soft:
                self.soft.add(self.marks[-1])
        self.inside[tag] += 1
        self.skipped += skip
        self.stack.append((tag, skip, region, mark))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        if self.inside[tag]:
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        self.parts.append(data)
        if not self.inside["a"]:
            self.unlinked += bool(data.strip())


def _summed(own: dict[int, int], parent: dict[int, int]) -> dict[int, int]:
    """own with all that lies below added."""
    out = dict.fromkeys(parent, 0) | own
    for i in range(len(parent) - 1, 0, -1):  # children come after their parents
        out[parent[i]] += out[i]
    return out


def _within(parent: dict[int, int], chosen) -> list[bool]:
    """For each element whether it or one around it is chosen."""
    out: list[bool] = []
    for i, up in parent.items():
        out.append(i in chosen or up >= 0 and out[up])
    return out


def _wrappers(p: Lines, seen: list[Line]) -> set[int]:
    """The marked elements that stand around the article, 0 (no mark) among them; each element is looked at once."""
    size, own = collections.Counter(), collections.Counter()
    in_article = _within(p.parent, p.articles)
    telling = set()  # marks right around text of an article
    for x in seen:
        size[x.region] += len(x.text)
        own[x.mark] += len(x.text)
        if not x.heading and in_article[x.region]:
            telling.add(x.mark)
    size, held = _summed(size, p.parent), _summed(own, p.mark_parent)
    starts = [(size[r], m) for r, m in p.articles.items() if size[r]] or [(1, x.mark) for x in seen if x.heading][:1]
    around = {0}
    if starts and all(m for _, m in starts):
        m = max(starts)[1]
        while m:
            around.add(m)
            m = p.mark_parent[m]
    inner: dict[int, list[int]] = {}
    for m, up in p.mark_parent.items():
        inner.setdefault(up, []).append(m)
    heap: list[tuple[int, int]] = []
    outside, told, todo = 0, False, [0]
    while True:  # a marked element that holds nearly all text
        while todo:
            m = todo.pop()
            outside, told = outside + own[m], told or m in telling
            for child in inner.get(m, ()):
                if child in around:
                    todo.append(child)
                else:
                    heapq.heappush(heap, (-held[child], child))
        if told or outside >= BARE or not heap or -heap[0][0] <= 3 * outside:
            return around
        todo.append(heapq.heappop(heap)[1])
        around.add(todo[0])


def _prose(p: Lines, seen: list[Line], around: set[int], least: float) -> set[int]:
    """Marks by ambiguous names, inside an article, whose text is as dense as content and hardly linked."""
    in_article = _within(p.parent, p.articles)
    text, linked, tags = collections.Counter(), collections.Counter(), collections.Counter()
    for x in seen:
        if x.mark in p.soft and in_article[x.region]:
            text[x.mark] += len(x.text)
            linked[x.mark] += len(x.text) * x.linked
            tags[x.mark] += max(1, x.tags)
    stay = set(around)
    for m in sorted(p.soft):  # parents first
        dense = m in text and text[m] >= least * tags[m] and linked[m] <= (1 - UNLINKED) * text[m]
        if p.mark_parent[m] in stay and dense:
            stay.add(m)
    return stay


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    r = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    sums = np.convolve(np.pad(ratio, r), kernel, "valid")
    return sums / np.convolve(np.pad(np.ones_like(ratio), r), kernel, "valid")


def _whole(p: Lines, best: int, content: list[int]) -> int:
    """The article or main element around the region; without one, the deepest element around it with all content lines."""
    up = [best]
    while p.parent[up[-1]] >= 0:
        up.append(p.parent[up[-1]])
    for region in up:
        if region in p.articles:
            return region
    lines = _summed(collections.Counter(content), p.parent)
    return next(region for region in up if lines[region] == len(content))


def _ratios(lines: list[Line]) -> tuple[np.ndarray, np.ndarray, float]:
    """Text to tags of each line, the same smoothed, and the threshold of content."""
    own = np.array([len(x.text) / max(1, x.tags) for x in lines])
    ratio = smoothed(own)
    return own, ratio, min(ratio.std(), ratio.max() / 2)


def main_text(html: str | None) -> str:
    """The article's blocks, joined by newlines."""
    p = Lines()
    html = html or ""
    for i in range(0, len(html), SLICE):
        p.feed(html[i : i + SLICE])
    p.close()
    p.flush()
    kept = [x for x in p.lines if not x.skipped]
    if any(x.mark for x in kept):
        seen, around = kept, _wrappers(p, kept)
        kept = [x for x in seen if x.mark in around]
        if kept and p.soft:
            around = _prose(p, seen, around, _ratios(kept)[2])
            kept = [x for x in seen if x.mark in around]
    if not kept:
        return ""
    own, ratio, least = _ratios(kept)
    content = ratio >= least
    held: dict[int, int] = {}
    total = 0
    for x, chosen in zip(kept, content, strict=True):
        if chosen:
            total += len(x.text)
            held[x.region] = held.get(x.region, 0) + len(x.text)
    for region in range(p.n_regions - 1, 0, -1):  # children come after their parents
        if region in held:
            up = p.parent[region]
            held[up] = held.get(up, 0) + held[region]
    best = max((r for r, n in held.items() if n >= HOLDS * total), default=0)
    best = _whole(p, best, [x.region for x, chosen in zip(kept, content, strict=True) if chosen])
    inside = {best}
    for r in range(best + 1, p.n_regions):
        if p.parent[r] in inside:
            inside.add(r)
    menus = best not in p.articles
    return "\n".join(
        x.text for x, dense in zip(kept, own >= least, strict=True) if x.region in inside and not (menus and x.linked and not dense)
    )


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keep + text, n_chars (code points) for each page."""
    kinds = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep]

    def work(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(h) for h in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [*keep, "text", "n_chars"],
                )

    picked = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").cast("string").alias("_html"))
    return picked.mapInArrow(work, ", ".join([*kinds, "text string", "n_chars bigint"]))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
