"""Main text of HTML pages by tag ratios.

The standard library's parser streams its events over the whole page. Text between two block-level
tags is a line; its text-to-tag ratio is its length over the number of tags met since the line
before. The ratios are smoothed with a Gaussian and their logarithms split in two clusters; lines of
the upper one are content and vote, with their length, for the elements that hold them. The innermost
container with nearly all votes is the region of the article. A marked element (article, main) that
holds it, or holds most votes inside it, stands for it, without teasers of other articles; otherwise
the region is grown over siblings that are text. All lines of the region are returned, short ones too.

Never text are scripts, styles, templates, form controls and hidden parts. Menus, page headers, footers,
sidebars, notices, adverts and reader comments are left out when their tag, role or a whole word of
their class says so, except those that hold the article: the marked element with most votes or, on
a page without any, more than half of all votes in several blocks. Compounds of such words (ad-hoc, modal-open), words that also name parts of articles
(discussion, related, search ...), ids, and forms leave out a block only if its own ratio is in the
lower cluster. Headings, paragraphs and what is in them never go by such hints.

Elements know their parent only, and all sums over them are made in one pass from the last one back,
so time is linear in the page however deep it nests.

Defined results: null and empty pages and pages without text give an empty text; unclosed and stray
tags are tolerated; repeated rows give equal texts; other columns are not touched, but for those that
are called text or n_chars in any letter case, which the results replace.
"""

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelab.llm.common import col
from imagelab.session import ship_package

SLICE = 1 << 16
SIGMA = 1.0
RADIUS = 3
NEARLY_ALL = 0.9
SHARE_OF_LARGEST = 0.25  # only marked elements with fewer content characters can be teasers of other articles
TEASER_LINES = 3  # what a teaser has at most besides its linked title

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
REGIONS = frozenset(("article", "main"))
CONTAINERS = frozenset("html body div section main article center".split())
LISTS = frozenset("ul ol menu dl table".split())
NEVER = frozenset(
    "head title script style noscript template button select textarea iframe object svg canvas option audio video".split()
)
NAMED = frozenset("nav footer aside menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NOT_WITH = r"(?<![a-z])(?<!has-)(?<!with-)(?<!no-)"
COMMENTS = r"comments?|comment(?:er|ers|list|form|area)|disqus"
READERS = re.compile(rf"{NOT_WITH}(?:{COMMENTS})(?![a-z])(?!-(?:open|opened|closed|status|count|enabled|disabled))")
# Words that only name what is around articles.
BOILERPLATE = re.compile(
    NOT_WITH + r"(?:ads?|adverts?|advertis\w*|sponsor\w*|promos?|(?:ad|top|cookie|page|site)-?banners?|"
    r"cookie-?(?:notice|consent|bar|banner|policy|popup)s?|gdpr|popups?|modals?|newsletters?|side-?bars?|nav|navbar|navigation|"
    r"breadcrumbs?|footer|pagination|pager|toolbar|skip-(?:link|nav|to)\w*|(?:share|social|search|login|signup)-?(?:bar|box|buttons?|icons?|links|form))(?![a-z])"
)
# Words that name what is around articles, and parts of articles too.
AMBIGUOUS = re.compile(
    NOT_WITH + r"(?:banners?|cookies?|consent|notices?|promotions?|alerts?|overlay|subscri\w*|widgets?|related|recommend\w*|shar(?:e|ing)|social|menus?|"
    r"forms?|login|signup|search|skip|repl(?:y|ies)|discussions?|respond)(?![a-z])"
)
HEADERS = re.compile(r"(?:(?:page|site|main|top|blog|global|entry|post|article)-?)?(?:header|masthead)")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
CLOSES_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}
TWINS = {"li": ("li",), "tr": ("tr",)} | dict.fromkeys(("dt", "dd"), ("dt", "dd")) | dict.fromkeys(("td", "th"), ("td", "th"))


@dataclass
class Line:
    text: str
    tags: int
    element: int  # number of the innermost open element; 0 is the page
    linked: int = 0  # characters of the text inside links


@dataclass
class Element:
    """An element, numbered in the order in which elements open; its lines are neighbours."""

    tag: str
    parent: int
    splits: bool = False  # holds block-level elements
    named: bool = False  # says that it is not part of the article
    suspect: bool = False  # left out if its ratio is in the lower cluster
    marked: bool = False  # an article, or main, that is not in another article
    readers: bool = False  # holds comments of readers
    in_heading: bool = False


@dataclass
class _Open:
    tag: str
    number: int
    skips: bool  # nothing in it is text
    only_headings: bool


@dataclass
class _Lines(HTMLParser):
    """Collects the lines of a page."""

    lines: list[Line] = field(default_factory=list)
    elements: list[Element] = field(default_factory=lambda: [Element("html", 0, True)])

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self._open: list[_Open] = []
        self._blocks: list[int] = []  # places of the open block-level elements
        self._count: Counter[str] = Counter()  # open elements by tag
        self._headings = self._regions = 0  # open ones
        self._tags = 0
        self._text: list[str] = []
        self._linked = 0

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                self.lines.append(Line(text, self._tags, self._open[-1].number if self._open else 0, self._linked))
                self._tags = 0
            self._linked = 0

    def _skipping(self) -> bool:
        if not self._open:
            return False
        inside = self._open[-1]
        return inside.skips or inside.only_headings and not self._headings

    def _push(self, opened: _Open) -> None:
        if opened.tag in BLOCK:
            self._blocks.append(len(self._open))
        self._open.append(opened)
        self._count[opened.tag] += 1
        self._headings += opened.tag in HEADINGS
        self._regions += opened.tag in REGIONS

    def _cut(self, at: int) -> None:
        """Close the open elements from a place on."""
        while len(self._open) > at:
            tag = self._open.pop().tag
            self._count[tag] -= 1
            self._headings -= tag in HEADINGS
            self._regions -= tag in REGIONS
            if tag in BLOCK:
                self._blocks.pop()

    def _close(self, tag: str) -> None:
        """Close the innermost open `tag` and all inside it."""
        if self._count[tag]:
            at = len(self._open) - 1
            while self._open[at].tag != tag:
                at -= 1
            self._cut(at)

    def _close_before(self, tag: str) -> None:
        """Close what ends where a block-level `tag` begins: a paragraph, and an item of the same list or table."""
        if self._blocks and self._open[self._blocks[-1]].tag == "p":
            self._cut(self._blocks[-1])
        for twin in TWINS.get(tag, ()):
            if self._count[twin]:
                for at in reversed(self._blocks):
                    if self._open[at].tag == twin:
                        self._cut(at)
                        break
                    if self._open[at].tag in CLOSES_ITSELF[tag]:
                        break

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag in BLOCK:
            self._flush()
            self._close_before(tag)
        elif tag == "br":
            self._text.append(" ")
        if tag in VOID:
            return
        named, inside = dict(attrs), self._open[-1] if self._open else None
        number = len(self.elements)
        element = Element(tag, inside.number if inside else 0, in_heading=tag in HEADINGS or self._headings > 0)
        self.elements.append(element)
        if tag in BLOCK:
            at = element.parent
            while not self.elements[at].splits:
                self.elements[at].splits = True
                at = self.elements[at].parent
        skips, only_headings = _never(tag, named), _is_header(tag, named)
        if not element.in_heading:
            element.named, element.suspect, element.readers = _hints(tag, named, self._regions > 0)
        if only_headings and not self._regions:  # that of the page; one inside the article has its title
            element.named, only_headings = True, False
        if inside:
            skips, only_headings = skips or inside.skips, only_headings or inside.only_headings
        element.marked = tag in REGIONS and not self._count["article"] and not element.named
        self._push(_Open(tag, number, skips, only_headings))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do: the slash means nothing

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in BLOCK:
            self._flush()
        if tag == "br":
            self._text.append(" ")
        else:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self._skipping():
            self._text.append(data)
            if self._count["a"]:
                self._linked += len("".join(data.split()))

    def finish(self) -> None:
        self.close()
        self._flush()


def _words(value: str | None) -> str:
    return HUMP.sub("-", value or "").lower()


def _is_header(tag: str, attrs: dict[str, str | None]) -> bool:
    words = _words(attrs.get("class")).split()
    return tag == "header" or tag in CONTAINERS - REGIONS - {"html", "body"} and any(HEADERS.fullmatch(word) for word in words)


def _never(tag: str, attrs: dict[str, str | None]) -> bool:
    """Whether nothing in an element is text that a reader sees."""
    if tag in NEVER:
        return True
    if not attrs or tag in REGIONS or tag in ("html", "body"):
        return False
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true"
    return hidden or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()


def _hints(tag: str, attrs: dict[str, str | None], in_region: bool) -> tuple[bool, bool, bool]:
    """(named, suspect, of readers): what tag, role, class and id say against an element."""
    if tag in ("html", "body"):
        return False, False, False
    of_class, of_id = _words(attrs.get("class")), _words(attrs.get("id"))
    tokens = of_class.split()
    readers = any(READERS.fullmatch(token) for token in tokens)
    named = readers or tag in NAMED or tag not in REGIONS and (
        (attrs.get("role") or "").lower() in ROLES or any(BOILERPLATE.fullmatch(token) for token in tokens)
    )
    if named or tag in REGIONS or tag not in BLOCK or tag == "p":
        return named, False, readers
    by_id = BOILERPLATE.search(of_id) or READERS.search(of_id) or not in_region and HEADERS.fullmatch(of_id)
    by_class = BOILERPLATE.search(of_class) or READERS.search(of_class) or AMBIGUOUS.search(of_class)
    of_readers = any(READERS.fullmatch(word) for word in of_id.split())
    return False, bool(tag == "form" or by_id or by_class), of_readers


def tag_ratios(lines: list[Line]) -> np.ndarray:
    """Text length over tags of each line, smoothed with a Gaussian over its neighbours."""
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    at = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(at**2) / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[RADIUS:-RADIUS]
    return np.convolve(ratios, kernel, "full")[RADIUS:-RADIUS] / weight


def cluster_threshold(values: np.ndarray) -> float:
    """What separates two clusters of values: the point half way between their means."""
    threshold = min(values.mean(), values.max())  # a rounded mean of equal values can exceed them
    for _ in range(20):
        upper = values >= threshold
        if upper.all():
            break
        moved = (values[upper].mean() + values[~upper].mean()) / 2
        if math.isclose(moved, threshold):
            break
        threshold = moved
    return threshold


class _Page:
    """The lines of a page that are still in it, and sums over them for every element and all inside it."""

    def __init__(self, lines: list[Line], elements: list[Element], content: np.ndarray, stays: list[bool]):
        self.lines, self.elements, self.content, self.stays = lines, elements, content, stays
        many = len(elements)
        self.size, self.spaces, self.tags, self.linked, self.votes, self.count = ([0] * many for _ in range(6))
        self.first, self.last = [len(lines)] * many, [0] * many  # range of its lines, left-out ones too
        for at, line in enumerate(lines):
            e = line.element
            self.first[e], self.last[e] = min(self.first[e], at), at + 1
            if stays[at]:
                self.size[e] += len(line.text)
                self.spaces[e] += line.text.count(" ")
                self.tags[e] += line.tags
                self.linked[e] += line.linked
                self.votes[e] += len(line.text) if content[at] else 0
                self.count[e] += 1
        for e in range(many - 1, 0, -1):  # inner elements come after those that hold them
            up = elements[e].parent
            for sums in (self.size, self.spaces, self.tags, self.linked, self.votes, self.count):
                sums[up] += sums[e]
            self.first[up], self.last[up] = min(self.first[up], self.first[e]), max(self.last[up], self.last[e])

    def inside(self, number: int) -> list[int]:
        """Places of the lines of an element."""
        return [at for at in range(self.first[number], self.last[number]) if self.stays[at]]

    def holders(self, number: int) -> set[int]:
        """An element and all that hold it."""
        found = {number, 0}
        while number:
            number = self.elements[number].parent
            found.add(number)
        return found

    def mostly_links(self, number: int) -> bool:
        return 2 * self.linked[number] > self.size[number] - self.spaces[number]

    def is_teaser(self, number: int) -> bool:
        """Whether a marked element is a linked title with a few lines, or a list of links."""
        titles = [line for line in map(self.lines.__getitem__, self.inside(number)) if self.elements[line.element].in_heading]
        linked_title = bool(titles) and all(_is_linked(line) for line in titles)
        return self.mostly_links(number) or linked_title and self.count[number] - len(titles) <= TEASER_LINES


def _is_linked(line: Line) -> bool:
    return 2 * line.linked > len(line.text) - line.text.count(" ")


def _left_out(page: _Page, threshold: float) -> list[bool]:
    """For each element, whether it is left out: by its name, or as a suspect of low ratio."""
    elements, votes = page.elements, page.votes
    named, readers = [False] * len(elements), [False] * len(elements)
    for e in range(1, len(elements)):
        named[e] = named[elements[e].parent] or elements[e].named
        readers[e] = readers[elements[e].parent] or elements[e].readers
    marked = [e for e in range(1, len(elements)) if elements[e].marked and not readers[e] and page.count[e]]
    free = [e for e in marked if not named[e]] or [e for e in marked if 2 * votes[e] > votes[0]]
    holders = {0}
    if free:
        holders = page.holders(max(free, key=lambda e: (elements[e].tag == "article", votes[e], -e)))
    out = [False] * len(elements)
    for e in range(1, len(elements)):
        holds = e in holders if free else elements[e].splits and 2 * votes[e] > votes[0]
        low = elements[e].suspect and math.log1p(page.size[e] / max(1, page.tags[e])) < threshold
        out[e] = out[elements[e].parent] or not holds and (elements[e].named or low)
    return out


def _voted(page: _Page) -> int:
    """The innermost container with nearly all votes; one without blocks in it is a paragraph."""
    least = NEARLY_ALL * page.votes[0]
    fits = (
        e for e in range(len(page.elements) - 1, 0, -1)
        if page.votes[e] >= least and page.elements[e].tag in CONTAINERS and page.elements[e].splits
    )
    return next(fits, 0)


def _marked_lines(page: _Page, region: int) -> list[int] | None:
    """Places of the lines of the marked elements that stand for the region; None if there are none."""
    around = page.holders(region)
    marked = [e for e in range(1, len(page.elements)) if page.elements[e].marked and page.count[e]]
    for tag in ("article", "main"):
        # an article may be searched in all of the page: what holds it may hold other articles as well
        found = [e for e in marked if page.elements[e].tag == tag]
        if any(e in around for e in found) or found and 2 * sum(page.votes[e] for e in found) >= page.votes[0]:
            least = max(page.votes[e] for e in found) * SHARE_OF_LARGEST
            chosen = [e for e in found if page.votes[e] >= least or not page.is_teaser(e)]
            return sorted({at for e in chosen for at in page.inside(e)})
    return None


@dataclass
class _Child:
    """A child element of a parent that has lines, or one line of its own."""

    tag: str
    number: int | None
    at: list[int]


def _grown(page: _Page, region: int) -> list[int]:
    """Places of the lines of the region, without menus at its ends, and of siblings that are text."""
    elements = page.elements
    children: dict[int, list[_Child]] = {}
    around = page.holders(region)
    for e in range(1, len(elements)):
        if elements[e].parent in around and page.count[e]:
            children.setdefault(elements[e].parent, []).append(_Child(elements[e].tag, e, [page.first[e]]))
    for at, line in enumerate(page.lines):
        if line.element in around and page.stays[at]:
            children.setdefault(line.element, []).append(_Child("p", None, [at]))
    for found in children.values():
        found.sort(key=lambda child: child.at[0])

    def places(child: _Child) -> list[int]:
        return child.at if child.number is None else page.inside(child.number)

    def links(child: _Child) -> bool:
        return page.mostly_links(child.number) if child.number is not None else _is_linked(page.lines[child.at[0]])

    def votes(child: _Child) -> int:
        at = child.at[0]
        return page.votes[child.number] if child.number is not None else len(page.lines[at].text) * bool(page.content[at])

    def is_text(child: _Child) -> bool:
        size = page.size[child.number] if child.number is not None else len(page.lines[child.at[0]].text)
        return 2 * votes(child) >= size and not links(child)

    inside = children.get(region, [])
    text = [i for i, child in enumerate(inside) if votes(child)]
    menus = [
        i for i, child in enumerate(inside)
        if text and not text[0] <= i <= text[-1] and child.tag in CONTAINERS | LISTS and links(child)
    ]
    chosen = {at for i, child in enumerate(inside) if i not in menus for at in places(child)}
    own = True  # whether the siblings are those of the region itself
    while region and elements[region].tag != "body":
        parent = elements[region].parent
        beside = children[parent]
        holds = next(i for i, child in enumerate(beside) if child.number == region)
        text = [i for i, child in enumerate(beside) if is_text(child)] + [holds]
        first, last = min(text), max(text)
        while first and not links(beside[first - 1]) and (beside[first - 1].tag in HEADINGS or own and beside[first - 1].tag == "p"):
            first -= 1
        while own and last + 1 < len(beside) and beside[last + 1].tag == "p" and not links(beside[last + 1]):
            last += 1
        for i in range(first, last + 1):
            if i != holds and not links(beside[i]):
                chosen.update(places(beside[i]))
        region, own = parent, False
    return sorted(chosen)


def article_lines(page: str) -> list[str]:
    parser = _Lines()
    for at in range(0, len(page), SLICE):
        parser.feed(page[at : at + SLICE])
    parser.finish()
    lines, elements = parser.lines, parser.elements
    if not lines:
        return []
    ratios = np.log1p(tag_ratios(lines))
    threshold = cluster_threshold(ratios)
    content = ratios >= min(threshold, ratios.max())
    out = _left_out(_Page(lines, elements, content, [True] * len(lines)), threshold)
    stays = [not out[line.element] for line in lines]
    if not any(stays):
        return []
    if not (content & stays).any():  # all content was left out by name
        content = np.array(stays)
    left = _Page(lines, elements, content, stays)
    region = _voted(left)
    chosen = _marked_lines(left, region)
    return [lines[at].text for at in (chosen if chosen is not None else _grown(left, region))]


def main_text(page: str | None) -> str:
    return "\n".join(article_lines(page or ""))


def article_text(html: str | Column) -> Column:
    """The article's lines, joined by line feeds."""

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return extract(html)


def extract_articles(df: DataFrame, html_col: str = "html") -> DataFrame:
    """All other columns, `text` and `n_chars` (code points)."""
    ship_package(df.sparkSession)
    taken = {html_col.lower(), "text", "n_chars"}
    rest = [c for c in df.columns if c.lower() not in taken]
    extracted = df.select(*[col(c) for c in rest], article_text(col(html_col).cast("string")).alias("text"))
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
