"""Operator 1: main text of web pages.

Standard-library parser events stream past once. Every block element becomes a
line with its text, the text outside links, and the number of tags seen in it.
The text-to-tag ratios of all lines, those of menus and adverts included, are
smoothed with a Gaussian, and a threshold that splits their logarithms into two
classes clusters the lines into content and the rest. The clusters select the
content region:

* From the page downwards, the region moves into the container that holds most
  of the clustered text, as long as one does. ``article`` and ``main`` elements
  are tried first and win unless another container holds several times as much.
* Around it the region grows to the nearest container with the page's main
  heading, so a title beside the body text stays.
* Inside the region whatever belongs to it stays, short lines too. What the
  clusters leave out goes where something else speaks against it as well: blocks
  that are mostly links, blocks whose class only hints at furniture, and, where
  no element says where the article is, blocks before the first and after the
  last clustered line.

Menus, headers, forms, scripts and other elements that never hold main text are
left out by their tags, and elements whose class or id names nothing but page
furniture (``cookie-notice``, ``comments``) by that name.

Results by case: null or empty html, and pages without text, give ''. Repeated
rows give repeated results. Other columns of the input are ignored. Long and
broken pages take time in proportion to their length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that stay open until their own end tag, whatever is left open inside.
SECTION = BLOCK - frozenset("p h1 h2 h3 h4 h5 h6 dt dd li option optgroup td th tr thead tbody tfoot".split())
#: What an opening tag closes if it is still open in the same section.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
#: Elements that never hold main text.
DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select textarea iframe object svg "
    "canvas dialog menu audio video math datalist search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Fixed words: a class or id made of these alone, or of these and PLAIN ones, names page furniture.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login sidebar aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments commentlist disqus discussion replies reply respond share sharing social related recommended "
    "toolbar pagination pager skip sitemap copyright".split()
)
#: Words that say where or what kind of box something is, not what it holds.
PLAIN = frozenset(
    "area bar block bottom box button buttons col column container content fixed form global group holder icons inner item "
    "items left link links list main outer page panel primary right row secondary section site slot sticky sub text top "
    "unit wrap wrapper zone".split()
)
#: As the last word of a name these say what the whole is: article-comments are comments.
HEADS = frozenset(
    "ad ads advert adverts advertisement breadcrumb breadcrumbs comment comments commentlist cookies disqus discussion menu "
    "nav navbar navigation newsletter pagination pager replies sidebar sitemap toolbar".split()
)
#: A class such as has-sidebar or no-header describes the page, not the element.
ABOUT = frozenset("has no with without is".split())
REGION = frozenset(("article", "main"))
#: Elements that the region may move into.
CONTAINER = frozenset("article body center div main section td".split())
MARKED, HINTED = 2, 1


def _named(value: str) -> int:
    """MARKED if a class or id names furniture, HINTED if only a part of a name does."""
    found = 0
    for label in value.split():
        parts = [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", label).lower()) if x]
        if not parts or parts[0] in ABOUT or FURNITURE.isdisjoint(parts):
            continue
        if parts[-1] in HEADS or all(x in FURNITURE or x in PLAIN for x in parts):
            return MARKED
        found = HINTED
    return found


def _furniture(attrs: list[tuple[str, str | None]]) -> int:
    found = 0
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return MARKED
        if not value:
            continue
        if name == "role" and value.strip().lower() in ROLES:
            return MARKED
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return MARKED
        if name in ("class", "id"):
            found = max(found, _named(value))
    return found


@dataclass
class Line:
    """One block of text: where it stands and what the ratios are made of."""

    text: str
    plain: int  # code points outside links
    tags: int
    place: int  # the container around it
    block: int  # the child of that container, or an inner element, that it belongs to
    dropped: bool
    hinted: bool
    heading: bool


class _Lines(HTMLParser):
    """Turns parser events into lines and the containers that they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, int, int]] = []  # tag, dropped here or above, hinted, container, block
        self.at: dict[str, list[int]] = {}  # tag -> places in open
        self.sections: list[int] = []  # places in open of elements that stay open
        self.links = self.titles = 0  # open a and h1 elements
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.plain = self.tags = 0
        self.heading = False
        self.parent: list[int] = [-1]  # of each container; 0 is the page
        self.semantic: list[bool] = [False]
        self.blocks = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, dropped, hinted, place, block = self.open[-1] if self.open else ("", False, False, 0, 0)
            self.lines.append(Line(text, min(self.plain, len(text)), self.tags, place, block, dropped, hinted, self.heading))
        self.parts, self.plain, self.tags, self.heading = [], 0, 0, False

    def _close(self, index: int) -> None:
        if any(element[0] in BLOCK for element in self.open[index:]):
            self._flush()
        for tag, *_ in self.open[index:]:
            self.at[tag].pop()
            self.links -= tag == "a"
            self.titles -= tag == "h1"
        del self.open[index:]
        while self.sections and self.sections[-1] >= index:
            self.sections.pop()

    def _find(self, tags: set[str] | frozenset[str], through: bool) -> int:
        """The innermost open element of these tags; unless ``through``, none outside the innermost section."""
        found = max((places[-1] for tag in tags if (places := self.at.get(tag))), default=-1)
        inside = self.sections[-1] if self.sections and not through else -1
        return found if found >= inside else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            closes = CLOSES.get(tag, set()) | {"p"}
            if (i := self._find(closes, False)) >= 0:
                self._close(i)
            self._flush()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        _, dropped, hinted, place, block = self.open[-1] if self.open else ("", False, False, 0, 0)
        if tag in BLOCK and tag not in ("p", "li"):
            self.blocks += 1
            block = self.blocks
        if tag in CONTAINER or ("role", "main") in attrs:
            self.parent.append(place)
            self.semantic.append(tag in REGION or ("role", "main") in attrs)
            place = len(self.parent) - 1
        marked = 0 if tag in ("html", "body", "main") else MARKED if tag in DROPPED else _furniture(attrs)
        self.at.setdefault(tag, []).append(len(self.open))
        if tag in SECTION:
            self.sections.append(len(self.open))
        self.links += tag == "a"
        self.titles += tag == "h1"
        self.open.append((tag, dropped or marked == MARKED, hinted or marked == HINTED, place, block))

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        self.tags += 1
        if (i := self._find({tag}, tag in SECTION)) >= 0:
            self._close(i)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if self.at.get("script") or self.at.get("style") or self.at.get("title"):
            return
        self.parts.append(data)
        self.heading = self.heading or self.titles > 0
        if not self.links:
            self.plain += len(data)

    def close(self) -> None:
        if re.match(r"<[!/?a-zA-Z]", self.rawdata):  # markup that the page's end cuts off
            self.rawdata = ""
        super().close()
        self._flush()


def smoothed(values: list[float], sigma: float = 1.5) -> list[float]:
    """Gaussian smoothing with a kernel cut at three sigma and renormalised at the ends."""
    half = math.ceil(3 * sigma)
    kernel = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-half, half + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - half), min(len(values), i + half + 1)
        weights = kernel[lo - i + half : hi - i + half]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi], strict=True)) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Where to cut sorted values into two classes of the least variance within; the least value if they are alike."""
    ordered = sorted(values)
    total, n = sum(ordered), len(ordered)
    best, place, below = 0.0, ordered[0], 0.0
    for i in range(1, n):
        below += ordered[i - 1]
        if ordered[i] > ordered[i - 1]:
            gap = (total - below) / (n - i) - below / i
            if (between := i * (n - i) * gap * gap) > best and gap > ALIKE:
                best, place = between, ordered[i]
    return place


def content(lines: list[Line], sigma: float) -> tuple[list[bool], list[bool]]:
    """For each line whether it is in the content cluster, and whether its own ratio alone would be.

    Smoothing lifts what stands next to content; where content begins and ends shows in the ratios themselves.
    """
    ratios = [line.plain / max(1, line.tags) for line in lines]
    logs = [math.log1p(r) for r in smoothed(ratios, sigma)]
    least = threshold(logs)
    return [x >= least for x in logs], [math.log1p(r) >= least for r in ratios]


#: Classes whose mean ratios differ by less than this factor are one class; the share of the clustered text that a region
#: must hold; how many times the text of an article element another container must hold to win; a block of links.
ALIKE, SHARE, OUTWEIGH, LINKED = math.log(2), 0.8, 4, 0.5


def region(lines: list[Line], inside: list[bool], parent: list[int], semantic: list[bool]) -> tuple[int, bool]:
    """The container that holds the content, and whether an element says that it does."""
    weight = [0] * len(parent)
    titled = [False] * len(parent)
    for line, clustered in zip(lines, inside, strict=True):
        if not line.dropped:
            weight[line.place] += len(line.text) * clustered
            titled[line.place] |= line.heading
    for i in range(len(parent) - 1, 0, -1):  # a container counts for those around it
        weight[parent[i]] += weight[i]
        titled[parent[i]] |= titled[i]
    children: list[list[int]] = [[] for _ in parent]
    for i in range(1, len(parent)):
        children[parent[i]].append(i)
    at = 0
    while children[at]:
        most = max(children[at], key=lambda i: weight[i])
        if weight[most] < SHARE * weight[at] or not weight[most]:
            break
        at = most
    named = [i for i in range(1, len(parent)) if semantic[i]]
    some = {line.place for line in lines if not line.dropped}
    for i in range(len(parent) - 1, 0, -1):
        if i in some:
            some.add(parent[i])
    named = [i for i in named if i in some]
    if named:
        best = max(named, key=lambda i: (weight[i], i))
        if OUTWEIGH * weight[best] >= weight[at]:
            return best, True
    if titled[0]:
        while not titled[at]:
            at = parent[at]
    return at, False


def main_lines(html: str | None, sigma: float = 1.5) -> list[str]:
    """The lines of the article, in page order."""
    if not html:
        return []
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if all(line.dropped for line in lines):
        return []
    inside, alone = content(lines, sigma)
    at, named = region(lines, inside, parser.parent, parser.semantic)
    within = {at}
    for i in range(at + 1, len(parser.parent)):
        if parser.parent[i] in within:
            within.add(i)
    kept = [i for i, line in enumerate(lines) if line.place in within and not line.dropped]
    length: dict[int, list[int]] = {}  # of each block: all text, text outside links, lines, clustered lines
    for i in kept:
        sums = length.setdefault(lines[i].block, [0, 0, 0, 0])
        for k, v in enumerate((len(lines[i].text), lines[i].plain, 1, inside[i])):
            sums[k] += v
    edges = [i for i in kept if inside[i] and alone[i]] or [i for i in kept if inside[i]] or kept
    first, last = edges[0], edges[-1]

    def stays(i: int) -> bool:
        text, plain, many, good = length[lines[i].block]
        if lines[i].heading:
            return True
        if 2 * good < many and (lines[i].hinted or many > 1 and plain < LINKED * text):
            return False
        return named or first <= i <= last or lines[i].place == at and plain >= LINKED * text

    return [lines[i].text for i in kept if stays(i)]


def extract(pages: DataFrame, sigma: float = 1.5) -> DataFrame:
    """Per page: page_id, url, text and n_chars, the code points of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n".join(main_lines(html.as_py(), sigma)) for html in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kept = pages.select("page_id", "url", "html")
    kinds = dict(kept.dtypes)
    return kept.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
