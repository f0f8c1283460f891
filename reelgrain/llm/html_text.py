"""Main text of web pages by text-to-tag ratios.

The standard-library parser streams over a page; every block-level tag ends a line. A line's ratio is its
text length over its tags. Ratios are smoothed by a Gaussian along the page and split in two clusters by
a threshold; lines of the upper cluster mark content regions. Parts that the markup itself names as menus,
adverts, forms, comments and the like take no part. A class or id alone never takes out an article or main
element, what holds one, or what holds most of an article's text or, without articles, of the page's.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags of HTML by their role here.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                   "ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("aside button canvas dialog fieldset footer form head header iframe math menu nav noscript object "
                    "script select style svg template textarea title".split())
MAIN = frozenset(("article", "main"))
HINTS = frozenset("ad ads advert adverts advertisement aside banner breadcrumb breadcrumbs comment comments consent cookie "
                  "cookies disqus footer form header login masthead menu modal nav navbar navigation newsletter notice "
                  "popup promo related reply replies search share sharing sidebar signup social sponsor sponsored "
                  "subscribe toolbar widget "
                  "ad-container ad-slot comment-list cookie-banner cookie-consent cookie-notice main-nav nav-menu "
                  "related-articles related-posts share-buttons sidebar-left sidebar-right site-footer site-nav social-share".split())
#: Parts of a class or id that name such a thing wherever they stand in it, and ends that do so behind the given beginnings.
NAMED = frozenset("ad ads advert advertisement adverts comment comments consent cookie cookies disqus newsletter sponsor sponsored".split())
PAGE_WIDE, ENDS = frozenset("global main page site top".split()), frozenset("footer header menu nav navbar navigation sidebar".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Tags whose end tag may be missing: a new one of the group closes an open one.
LOOSE = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold the lines of a region together; the other blocks are lines of the one they are in.
HOLDERS = frozenset("body center details div html section td th".split())
#: Width of the smoothing, in lines.
SIGMA = 1.0
PIECE = 1 << 16
TAG = re.compile("</?[A-Za-z]")


class Line(NamedTuple):
    text: str
    tags: int
    #: The innermost article or main element, part named by a class or id, and holder; 0 where there is none.
    region: int
    part: int
    holder: int
    heading: bool
    #: All its text is in links.
    linked: bool


@lru_cache(maxsize=10_000)
def hint(name: str) -> bool:
    """Whether a class or id names a part that isn't main text: as a whole, or by its parts."""
    parts = name.replace("_", "-").split("-")
    return name in HINTS or not NAMED.isdisjoint(parts) or (len(parts) > 1 and parts[0] in PAGE_WIDE and parts[-1] in ENDS)


class Lines(HTMLParser):
    """Lines of a page outside dropped elements, and what they are in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # tag, dropped, region, part, holder and heading of the open elements; where each tag is open, and where blocks are
        self.open: list[tuple[str, bool, int, int, int, bool]] = []
        self.depths: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.dropped = self.tags = self.regions = self.elements = self.links = self.unlinked = 0
        #: The part and the region around each part, whether an article or main element is in it; the region around each region.
        self.around, self.within, self.main, self.outer = [0], [0], [False], [0]
        self.text: list[str] = []
        self.place = (0, 0, 0, False)

    def _end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append(Line(text, max(1, self.tags), *self.place, not self.unlinked))
        self.text, self.tags, self.unlinked = [], 0, 0

    def _close(self) -> None:
        tag, dropped, _, part, _, _ = self.open.pop()
        self.depths[tag].pop()
        if tag in BLOCKS:
            self.blocks.pop()
        if tag in BLOCKS or dropped or part != self._place()[1]:
            self._end_line()
        self.dropped -= dropped
        self.links -= tag == "a"

    def _place(self) -> tuple[int, int, int, bool]:
        return self.open[-1][2:] if self.open else (0, 0, 0, False)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1
        if tag in VOID:
            return
        while self.open and self.open[-1][0] in LOOSE.get(tag, ()):
            self._close()
        # a block inside an open paragraph ends the paragraph, also below unclosed inline tags
        if tag in BLOCKS and self.blocks and self.open[self.blocks[-1]][0] == "p":
            self._close_to(self.blocks[-1])
        named = dict(attrs)
        names = f"{named.get('class') or ''} {named.get('id') or ''}".lower().split()
        dropped = tag in DROPPED or "hidden" in named or (named.get("role") or "").lower() in ROLES
        hinted = any(map(hint, names)) and tag not in MAIN and tag not in ("html", "body")
        if dropped or hinted:
            self._end_line()
        region, part, holder, heading = self._place()
        self.elements += 1
        if hinted:
            self.around.append(part)
            self.within.append(region)
            self.main.append(False)
            part = len(self.around) - 1
        if tag in MAIN and not dropped and not self.dropped:
            self.regions += 1
            self.outer.append(region)
            region, self.main[part] = self.regions, True
        if tag in HOLDERS or tag in MAIN:
            holder = self.elements
        self.depths[tag].append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((tag, dropped, region, part, holder, tag in HEADINGS if tag in BLOCKS else heading))
        self.dropped += dropped
        self.links += tag == "a"

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._close()

    def handle_endtag(self, tag):
        self.tags += 1
        at = self.depths[tag][-1] if self.depths[tag] else -1
        # an inline end tag doesn't reach beyond its block
        if at >= 0 and (tag in BLOCKS or not self.blocks or at > self.blocks[-1]):
            self._close_to(at)
        elif tag in BLOCKS:
            self._end_line()

    def handle_data(self, data):
        if not self.dropped:
            if not data.isspace():
                self.place = self._place()
                self.unlinked += not self.links
            self.text.append(data)

    def finished(self) -> list[Line]:
        """The lines that no part takes out; all lines if the parts would leave none."""
        while self.open:
            self._close()
        self._end_line()
        held, main, total = [0] * len(self.around), list(self.main), [0] * len(self.outer)
        for line in self.lines:
            held[line.part] += len(line.text)
            total[line.region] += len(line.text)
        for part in range(len(held) - 1, 0, -1):
            held[self.around[part]] += held[part]
            main[self.around[part]] |= main[part]
        named = sum(total[1:])
        for region in range(len(total) - 1, 0, -1):
            total[self.outer[region]] += total[region]
        # most of what: of the article that the part is in; of the page where no article has text
        most = [2 * held[part] > total[r] and (r > 0 or not named) for part, r in enumerate(self.within)]
        stay = [part == 0 or main[part] or most[part] for part in range(len(held))]
        return [line for line in self.lines if stay[line.part]] or self.lines


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """A Gaussian mean along the lines, its weights cut at three deviations and scaled to the lines there are."""
    reach = max(1, int(3 * sigma + 0.5))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(values, weights)[reach:reach + len(values)] / np.convolve(np.ones(len(values)), weights)[reach:reach + len(values)]


def threshold(values: np.ndarray) -> float:
    """The cut that separates low from high values best: least squares within the two clusters."""
    ordered = np.sort(values)
    n = np.arange(1, len(ordered))
    sums = np.cumsum(ordered)
    low, high = sums[:-1] / n, (sums[-1] - sums[:-1]) / (len(ordered) - n)
    between = n * (len(ordered) - n) * (high - low) ** 2
    if not len(between) or between.max() <= 0:
        return ordered[0]
    return ordered[int(np.argmax(between)) + 1]


def without_lists(lines: list[Line], chosen: np.ndarray) -> np.ndarray:
    """True for lines but those of lists of links: two or more in a row all in links, no headings, most of them in the lower cluster."""
    links = np.array([False] + [line.linked and not line.heading for line in lines] + [False])
    begin, end = (np.flatnonzero(np.diff(links.astype(int)) == d) for d in (1, -1))
    kept = np.ones(len(lines), bool)
    for a, b in zip(begin, end, strict=True):
        if b - a > 1 and 2 * chosen[a:b].sum() < b - a:
            kept[a:b] = False
    return kept


def main_text(html: str) -> str:
    parser = Lines()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at:at + PIECE])
    # a tag that the page breaks off is none; closing would look for its end from each of its beginnings
    if TAG.match(parser.rawdata):
        parser.rawdata = ""
    parser.close()
    lines = parser.finished()
    if not lines:
        return ""
    ratio = smooth(np.array([len(line.text) / line.tags for line in lines]))
    chosen = ratio >= threshold(ratio)
    at = np.flatnonzero(chosen)
    begin, end = int(at[0]), int(at[-1]) + 1
    if any(line.region for line in lines):
        # the markup names the articles: their lines count, but for lists of links, and what is outside only where no article has a content line
        inside, kept = any(line.region and c for line, c in zip(lines, chosen, strict=True)), without_lists(lines, chosen)
        return "\n".join(line.text for n, line in enumerate(lines) if (line.region and kept[n]) or (not inside and begin <= n < end))
    # headings above the content, and what stands beside its ends in the same element, belong to it
    first, last = lines[begin].holder, lines[end - 1].holder
    while begin and (lines[begin - 1].heading or (lines[begin - 1].holder == first and not lines[begin - 1].linked)):
        begin -= 1
    while end < len(lines) and not lines[end].linked and lines[end].holder == last:
        end += 1
    return "\n".join(line.text for line in lines[begin:end])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """`page_id, url, text, n_chars` of every page.

    A null or empty page, and one without text outside dropped elements, has an empty text. Repeated rows
    stay apart, other columns are not kept, an empty table gives no rows. Pages stay where they are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (page_id, url)}
    schema = f"page_id {kinds[page_id]}, url {kinds[url]}, text string, n_chars bigint"
    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    return chosen.mapInArrow(run, schema)
