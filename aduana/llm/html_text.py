"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, threshold clustering.

The standard library's parser streams events. Block elements cut the page into lines of text; a line keeps its text, the
number of tags within it, how much of it is link text, and the container it stands in. The ratio of a line is its text
outside links divided by its tags. Ratios are smoothed with a Gaussian along the page, so that a short line amid
long ones is lifted and a long one amid menus is lowered, and lines above the standard deviation of the page's
ratios are clustered. The heaviest cluster stands in an article, a main element or the body.

* Main or article: the outermost of these around the cluster is the content region, with all its lines and articles within it,
  so no title, lead or short paragraph is lost. Articles beside it belong to it, too, if they have a line above the threshold.
* Body: no element marks the article. What stands before the first or after the last line above the threshold goes if its own
  block has no such line, consists of links, or is a copyright line.
* Lines in page furniture - navigation, headers and footers of the page, sidebars, notices, adverts, forms, scripts, styles,
  comments of readers, recognised by element, role, class or id - have ratio 0 and never belong to the text. Within an
  article a class is a verdict only if it says nothing but furniture ("newsletter", "ad-slot"); where it could mean the
  subject ("notice-period", "related"), the block's own ratio and its share of links decide.

Cases: null and empty html give an empty text; a page without a cluster gives its lines outside furniture; unclosed and
stray tags are taken as browsers take them, near enough; repeated rows give equal texts; an empty table gives no rows;
other columns are ignored. A page is parsed as a whole, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SIGMA = 1.0
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset(
    "aside button datalist dialog footer form head iframe menu nav noscript object script select style svg template textarea title".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Names that, within an article, say little by themselves; and words beside a name that say nothing.
_WEAK = frozenset("banner pager popup related share sharing social toolbar widget".split())
_PLAIN = frozenset(
    "area bar block bottom box btn button buttons card container content form icon icons inner item items left link links list main outer "
    "page panel post region right row section site slot story text top unit wrap wrapper".split())
_READERS = frozenset("comment comments disqus replies reply respond".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr masthead menu menus modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "rail related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
#: A start tag of the key closes open elements of the value, up to the nearest block that may hold both.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
_UNFINISHED = re.compile(r"<[A-Za-z/!?]")
_COPYRIGHT = re.compile(r"(?i)(©|\(c\)|copyright\b|all rights reserved)")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


class Line(NamedTuple):
    text: str
    tags: int
    link_chars: int
    #: Article, main or body; block; whether it is furniture; and the element that may be, 0 for none.
    container: int
    block: int
    furniture: bool
    doubtful: int


class _Lines(HTMLParser):
    """Lines of a page from parser events. `open` holds (tag, container, block, furniture, doubtful) of open blocks and furniture."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, int, int, bool, int]] = []
        #: Tag and enclosing container of each container.
        self.containers = [("body", 0)]
        self.blocks = self.doubts = 0
        self.parts: list[str] = []
        self.tags = self.links = self.link_chars = 0

    def state(self) -> tuple[int, int, bool, int]:
        return self.open[-1][1:] if self.open else (0, 0, False, 0)

    def cut(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip(" ")
            if text:
                self.lines.append(Line(text, self.tags, self.link_chars, *self.state()))
            self.parts = []
        self.tags = self.link_chars = 0

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCKS:
            self.cut()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag == "a":
            self.links += 1
        if tag in _VOID:
            return
        if tag in _BLOCKS:
            closed = _CLOSES.get(tag, set()) | {"p"}
            while self.open and self.open[-1][0] in closed:
                self.open.pop()
        container, block, furniture, doubtful = self.state()
        verdict = self.is_furniture(tag, attrs)
        if tag in ("article", "main") and not furniture and not verdict:
            self.containers.append((tag, container))
            container = len(self.containers) - 1
        if tag in ("article", "div", "main", "section", "table", "td"):
            self.blocks += 1
            block = self.blocks
        if verdict is None and not doubtful:
            self.doubts += 1
            doubtful = self.doubts
        if tag in _BLOCKS or verdict is not False:
            self.open.append((tag, container, block, furniture or bool(verdict), doubtful))

    def is_furniture(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool | None:
        """Whether an element is furniture; None if its names leave that open."""
        if tag in _FURNITURE:
            return True
        inside = self.state()[0] > 0
        # The header of an article holds its title.
        if tag == "header" and not inside:
            return True
        verdict: bool | None = False
        for name, value in attrs:
            value = (value or "").lower()
            if name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name not in ("class", "id") or tag in ("html", "body", "main"):
                continue
            for label in value.split():
                words = set(re.split(r"[^a-z]+", label)) - {""}
                if tag == "article":
                    if words & _READERS:
                        return True
                elif words & _NAMES:
                    if not inside or not words & _WEAK and words <= _NAMES | _PLAIN:
                        return True
                    verdict = None
        return verdict

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing but on void elements

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.cut()
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.cut()
                del self.open[k:]
                break
            if self.open[k][0] in ("article", "main", "body", "table") and tag not in ("article", "main", "body", "html", "table"):
                break  # a stray end tag does not close what holds it

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        self.parts.append(data)
        if self.links:
            self.link_chars += len(data)


def page_lines(html: str) -> tuple[list[Line], list[tuple[str, int]]]:
    """Lines of a page, and tag and enclosing container of its containers."""
    parser = _Lines()
    parser.feed(html)
    if _UNFINISHED.match(parser.rawdata):
        parser.rawdata = ""  # a tag that the page ends in is no text
    parser.close()
    parser.cut()
    return parser.lines, parser.containers


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    radius = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, "full")[radius:-radius]
    return np.convolve(values, kernel, "full")[radius:-radius] / weight


def _mostly_links(lines: list[Line]) -> bool:
    return 3 * sum(x.link_chars for x in lines) > sum(len(x.text) for x in lines)


def _settled(lines: list[Line]) -> list[Line]:
    """The lines, with those of doubtful elements as furniture if they are mostly links, or have less text for their tags than
    lines of the page's text."""
    groups: dict[int, list[Line]] = {}
    for x in lines:
        if x.doubtful and not x.furniture:
            groups.setdefault(x.doubtful, []).append(x)
    if not groups:
        return lines
    least = smoothed(_ratios(lines)).std()
    out = {
        k for k, group in groups.items()
        if _mostly_links(group) or sum(len(x.text) for x in group) < least * sum(max(1, x.tags) for x in group)}
    return [x._replace(furniture=True) if x.doubtful in out else x for x in lines]


def _ratios(lines: list[Line]) -> np.ndarray:
    return np.array([0.0 if x.furniture else max(0, len(x.text) - x.link_chars) / max(1, x.tags) for x in lines])


def _outermost(container: int, containers: list[tuple[str, int]]) -> int:
    while containers[container][1]:
        container = containers[container][1]
    return container


def main_text(html: str | None) -> str:
    lines, containers = page_lines(html or "")
    if not lines:
        return ""
    lines = _settled(lines)
    ratio = _ratios(lines)
    level = smoothed(ratio)
    above = (level >= level.std()) & (ratio > 0)
    if not above.any():
        return "\n\n".join(x.text for x in lines if not x.furniture)
    # Runs of lines above the threshold are clusters; the heaviest one says which container is the content.
    edges = np.flatnonzero(np.diff(np.concatenate([[0], above.astype(np.int8), [0]])))
    first, last = max(zip(edges[::2], edges[1::2], strict=True), key=lambda run: (level[run[0]:run[1]].sum(), -run[0]))
    region = _outermost(lines[int(first + np.argmax(ratio[first:last]))].container, containers)
    tops = [_outermost(x.container, containers) for x in lines]
    if region:
        # Articles beside the region belong to the text, too, if they hold text and not teasers.
        beside = {t for t in set(tops) - {0, region} if not _mostly_links([x for x, own in zip(lines, tops, strict=True) if own == t])}
        kept = {region} | {t for t, high in zip(tops, above, strict=True) if high and t in beside}
        own = [k for k, top in enumerate(tops) if top in kept and not lines[k].furniture]
    else:
        own = [k for k, top in enumerate(tops) if not top and not lines[k].furniture]
        high = [k for k in own if above[k]]
        blocks = {lines[k].block for k in high}
        own = [
            k for k in own if high[0] <= k <= high[-1]
            or lines[k].block in blocks and 2 * lines[k].link_chars <= len(lines[k].text) and not _COPYRIGHT.match(lines[k].text)]
        while own and (_COPYRIGHT.match(lines[own[-1]].text) or 2 * lines[own[-1]].link_chars > len(lines[own[-1]].text)):
            own.pop()
    return "\n\n".join(lines[k].text for k in own)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        extract, "page_id long, url string, text string, n_chars long")
