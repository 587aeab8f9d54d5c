"""The main text of web pages.

A page goes through the standard library's streaming parser. Its events make *lines*:
the text between two block-level tags, with the number of tags seen since the line
before and the open containers. The text-to-tag ratio of
each line is smoothed with a Gaussian, and a threshold splits the ratios into two
clusters. The text of the dense cluster chooses the content region: the ``article`` or ``main``
with most of it, if that is ``MARKED_SHARE`` of it, else the innermost container with ``SHARE``
of it, or the page. A region's lines are all kept, sparse ones too, except what stands in navigation, forms, notices, adverts, comments and the like.
Inside an article only such names drop an element as say nothing else ("share-buttons", not
"share-prices"), and the headings of its header stay.
Where the region is the whole body, a menu that no tag, role, class or id marks is kept.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEED = 1 << 16  # characters handed to the parser at once
SIGMA = 1.5  # lines
SHARE = 0.7  # of the dense text that makes a container the region
MARKED_SHARE = 0.25  # the same for an article or main

_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul option".split()
)
_CONTAINER = set("article aside body div main section table tbody td tr blockquote form nav header footer ul ol dl center".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never content.
_DROPPED = set(
    "aside audio button canvas datalist dialog footer form head header iframe map menu nav noscript object script select "
    "style svg template textarea title video".split()
)
_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words in class names and ids that mark what is not content.
_HINTS = set(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion promoted banner "
    "sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs topbar header masthead footer comment comments "
    "commentlist disqus respond replies cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations teaser "
    "widget toolbar pagination pager paywall skip".split()
)
_READERS = {"comment", "comments", "commentlist", "disqus", "respond", "replies"}
_BY_RULE, _BY_HINT, _BY_HEADER = 1, 2, 4  # why an element is dropped; the last is an article's own header
#: Words that say nothing of their own next to a hint.
_NEUTRAL = set(
    "area bar block body bottom box btn button buttons col column container content desktop first footer group header icon icons inline inner "
    "item items label last left link links list message mobile module outer panel right row section slot small text title top unit wrap wrapper".split()
)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_LAYOUT = {"has", "with", "no", "without", "non", "not"}
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _hinted(names: str, among: set[str], alone: bool = False) -> bool:
    """Whether a name has a word of ``among``; with ``alone`` no other words that say something."""
    for name in names.lower().split():
        parts = [p for p in re.split(r"[^a-z0-9]+", name) if p]
        if alone and not all(p in among or p in _NEUTRAL or p.isdigit() for p in parts):
            continue
        if any(p in among for p in parts) and not any(p in _LAYOUT for p in parts):
            return True
    return False


class _Lines(HTMLParser):
    """Collects ``(text, tags, innermost container, dropped)`` for each line, and the
    tag and parent of each container. Its work is in proportion to the page, however deep
    its elements are nested."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.open: list[tuple[str, int, int]] = []  # tag, container number or -1, why dropped
        self.count: Counter = Counter()  # open elements by tag
        self.inside: list[int] = [-1]  # open containers
        #: Open elements that are dropped, headers of articles, headings; and how many an article has set free.
        self.dropped = self.headers = self.titles = self.free = 0
        self.kinds: list[str] = []  # of each container
        self.parents: list[int] = []
        self.parts: list[str] = []
        self.tags = 0

    def _end_line(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.inside[-1], self.dropped > (self.headers if self.titles else 0)))
            self.tags = 0
        self.parts = []

    def _counted(self, tag, why, by):
        self.count[tag] += by
        self.dropped += by * (why > 0)
        self.headers += by * (why == _BY_HEADER)
        self.titles += by * (tag in _HEADINGS)

    def _add(self, tag, number, why):
        self.open.append((tag, number, why))
        if number >= 0:
            self.inside.append(number)
        self._counted(tag, why, 1)

    def _close(self, start):
        for tag, number, why in self.open[start:]:
            if number >= 0:
                self.inside.pop()
            self._counted(tag, why, -1)
        del self.open[start:]
        self.free = min(self.free, start)

    def _implied_ends(self, tag):
        """What a block's start closes: a paragraph, an item before an item, the head;
        and what stands around an article is a page's frame, whatever its class says, and
        so is a form. Only reader comments stay comments."""
        if self.count["p"] or tag == "li" and self.count["li"] or tag == "body" and self.count["head"]:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p" or tag == "li" and self.open[i][0] == "li" or tag == "body" and self.open[i][0] == "head":
                    self._close(i)
                    break
                if self.open[i][1] >= 0:
                    break
        if tag in ("article", "main"):
            for i in range(self.free, len(self.open)):
                name, number, why = self.open[i]
                self._counted(name, why, -1)
                self.open[i] = name, number, 0 if name == "form" else why & ~_BY_HINT
                self._counted(name, self.open[i][2], 1)
            self.free = len(self.open)

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._end_line()
            self._implied_ends(tag)
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in _VOID:
            return
        if tag in _CONTAINER or tag in _DROPPED or tag in ("a", "p", "span", "li", "figure") or self.headers and tag in _HEADINGS:
            own = {k: v or "" for k, v in attrs}
            names = f"{own.get('class', '')} {own.get('id', '')}"
            page = tag in ("html", "body", "article", "main")
            alone = self.count["article"] > 0
            hard = (
                tag in _DROPPED
                or own.get("role", "").lower() in _ROLES
                or "hidden" in own
                or _UNSEEN.search(own.get("style", "")) is not None
                or _hinted(names, _READERS, alone)
            )
            dropped = _BY_RULE * hard | _BY_HINT * (not page and _hinted(names, _HINTS, alone))
            number = -1
            if tag in _CONTAINER:
                number = len(self.kinds)
                self.kinds.append("main" if own.get("role") == "main" else tag)
                self.parents.append(self.inside[-1])
            if tag == "header" and alone and not _hinted(names, _HINTS - {"header", "masthead"}, True):
                dropped = _BY_HEADER
            self._add(tag, number, 0 if tag in ("html", "body") else dropped)

    def handle_startendtag(self, tag, attrs):
        if tag in _BLOCK:
            self._end_line()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self._end_line()
        self.tags += 1
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._close(i)
                return
            # An inline end tag doesn't close what stands around a block.
            if tag not in _CONTAINER and tag not in _DROPPED and self.open[i][1] >= 0:
                return

    def handle_data(self, data):
        self.parts.append(data)

    def finish(self):
        self.close()
        self._end_line()
        return self


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; past the ends the first and last values go on."""
    reach = int(3 * sigma) + 1
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """The value halfway between the means of the two clusters it makes."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values < cut], values[values >= cut]
        if not len(low) or not len(high):
            break
        new = (float(low.mean()) + float(high.mean())) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def main_text(html: str) -> str:
    """The content lines of one page, joined by line feeds; empty if there are none."""
    parser = _Lines()
    for i in range(0, len(html), FEED):
        parser.feed(html[i : i + FEED])
    lines = parser.finish().lines
    if not lines:
        return ""
    size = np.array([len(t) for t, *_ in lines], dtype=float)
    ratio = smoothed(np.log1p(size / np.maximum(1, [tags for _, tags, *_ in lines])))
    kept = np.array([not dropped for *_, dropped in lines])
    if not kept.any():
        return ""
    dense = (ratio >= threshold(ratio)) & kept
    if not dense.any():
        dense = kept
    inside = np.array([c for *_, c, _ in lines])
    region, last = _region(parser.kinds, parser.parents, inside, size * dense, size * kept)
    chosen = kept & (inside >= region) & (inside <= last)
    return "\n".join(lines[i][0] for i in np.flatnonzero(chosen))


def _region(kinds: list[str], parents: list[int], inside: np.ndarray, dense: np.ndarray, every: np.ndarray) -> tuple[int, int]:
    """The first and last number of the containers in the content region; -1 is the page.
    Containers are numbered as they open, so those inside one follow it."""
    n = len(kinds)
    weight, text = (np.bincount(inside + 1, w, n + 1) for w in (dense, every))
    last = np.arange(-1, n)
    for c in range(n - 1, -1, -1):
        up = parents[c] + 1
        weight[up] += weight[c + 1]
        text[up] += text[c + 1]
        last[up] = max(last[up], last[c + 1])
    region = -1
    for marks in (("main", "article"), ("article",)):
        # Of articles as heavy as each other the one with more text, then the outermost.
        marked = [c for c in range(region + 1, last[region + 1] + 1) if kinds[c] in marks]
        best = max(marked, key=lambda c: (weight[c + 1], text[c + 1], kinds[c] == "article", -c), default=None)
        if best is not None and weight[best + 1] >= MARKED_SHARE * weight[region + 1]:
            region = best
    if region >= 0:
        return region, int(last[region + 1])
    # No mark-up says where the text is: go down while one container holds most of it.
    for c in range(n):
        if parents[c] == region and weight[c + 1] >= SHARE * weight[0] and weight[c + 1] > 0:
            region = c
    return region, int(last[region + 1])


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row for each page: the columns in ``keep``, text, n_chars (code points).

    The whole html is read; a null or empty one, and a page without content, has the
    text "". Repeated rows are pages of their own. Columns not in ``keep`` are ignored,
    whatever their names; a kept one must not be called text or n_chars.
    """
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").alias("_html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"],
            )

    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{schema}, text string, n_chars long")
