"""Main text of web pages by two passes over their blocks.

First pass: a block is good by its stop words, bad by its links or by standing in page furniture;
short ones, and long ones without stop words, stay undecided. Second pass: an undecided block
takes the label of its nearest decided neighbours. Within an article or main element, or one named
as such, both ends count as good neighbours, and where a page has such a landmark with text,
nothing outside it is part of the article; an element counts for more than a name.

A class, id or role names furniture only as a whole ("cookie-notice", "siteFooter"), not because one of
its words does ("overflow-hidden", "social-science", "no-sidebar"); an element that also bears the name of
a landmark is none, and an article element is only what names of companions of a text make of it. Of two
decided neighbours equally far the later one counts. Each row is read by itself, repeated rows alike.

Null, empty and textless html give an empty text. Cut-off tags and comments end with the page,
white space within a block is one blank. Each page is handled on its own, at any length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.llm.common import share_code

# Frequent function words of the four languages of the tables.
STOP_WORDS = frozenset(
    """
    a an and are as at be by for from has have he her his i in is it its not of on or she that the their they
    this to was we were will with you
    als am auf aus bei das dem den der des die ein eine einem einen einer es für hat ich im ist mit nicht sich sie
    sind so und von war wie wir zu zum zur über
    al como con de del el en es esta este la las lo los más no o para pero por que se sin su sus un una y
    au aux avec ce ces cette dans des du elle est et il ils je le les leur mais ne nous ou par pas plus pour qu
    que qui sa se ses son sur une vous
    """.split()
)
# Elements by what they mean for the text.
BLOCKS = frozenset(
    """
    address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
    """.split()
)
RAW = frozenset("script style title textarea noscript template iframe noframes xmp".split())
FURNITURE = frozenset(
    "nav footer aside form menu dialog head select option button svg object audio video canvas map noscript".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LANDMARKS = frozenset(("article", "main"))
# Classes, ids and roles that pages without such elements give to what holds the text.
LANDMARK_NAMES = frozenset(
    """
    article article-body article-content articlebody content content-body entry entry-content main main-content
    maincontent page-content post post-body post-content story story-body
    """.split()
)
# Words in class, id or role that name page furniture.
FURNITURE_NAMES = frozenset(
    """
    ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline-share comment comments
    complementary consent contentinfo cookie cookies copyright disclaimer discussion disqus footer gdpr hidden legal
    login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo
    promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor
    sponsored subscribe teaser toolbar widget
    """.split()
)
HEADER_NAMES = frozenset(("header", "topbar"))
# Furniture that pages also mark up as article elements.
COMPANION_NAMES = frozenset(
    "ad ads advert advertisement comment comments promo recommended related replies reply sponsored teaser widget".split()
)
# Words that tell where furniture stands or what it is made of, and change nothing.
PLAIN_NAMES = frozenset(
    """
    area article articles bar block body bottom box button buttons card container content element entry form global
    group icons inner item items layer left link links list main message outer page panel post posts primary right row
    secondary section site slot stories sub text thread title top unit wrap wrapper zone
    """.split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"[ \t\n\x0b\x0c\r\xa0]+")


@dataclass(frozen=True)
class BlockRules:
    """Limits of the first pass."""

    short: int = 70  # characters below which stop words decide nothing
    good_stop_share: float = 0.25
    bad_link_share: float = 0.33
    bad_link_share_in_article: float = 0.8


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    links: int
    furniture: bool
    region: int  # number of the landmark, 0 outside
    element: bool  # whether the landmark is an element, not just a name
    heading: bool


@dataclass
class _Open:
    tag: str
    furniture: bool
    region: int
    element: bool


_NOTHING = _Open("", False, 0, False)


@dataclass
class _Reader:
    """Cuts a page into blocks."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    in_link: int = 0
    regions: int = 0

    def flush(self, heading: bool = False) -> None:
        text = _SPACE.sub(" ", unescape("".join(self.parts))).strip(" ")
        if text:
            top = self.stack[-1] if self.stack else _NOTHING
            linked = min(self.linked, len(text))
            self.blocks.append(Block(text, linked, self.links, top.furniture, top.region, top.element, heading))
        self.parts, self.linked, self.links = [], 0, 0

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("p", "div", "article", "section", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6"):
            self.close_paragraph()
        if tag in ("li", "td", "th", "tr", "dt", "dd"):
            self.close_item(tag)
        top = self.stack[-1] if self.stack else _NOTHING
        furniture = top.furniture or tag in FURNITURE or (tag == "header" and not top.region)
        region, element = top.region, top.element
        if attributes and not furniture and tag not in ("html", "body"):
            furniture = bool(_HIDDEN.search(attributes))
            if tag != "main" and not furniture and not _names_landmark(attributes):
                known = COMPANION_NAMES if tag == "article" else FURNITURE_NAMES
                furniture = _names_furniture(attributes, known if region or tag == "article" else known | HEADER_NAMES)
        if not furniture and not element and (tag in LANDMARKS or (not region and _names_landmark(attributes))):
            self.regions += 1
            region, element = self.regions, tag in LANDMARKS
        self.stack.append(_Open(tag, furniture, region, element))

    def close_paragraph(self) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == "p":
                del self.stack[i:]
                return
            if self.stack[i].tag in BLOCKS:
                return

    def close_item(self, tag: str) -> None:
        same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag in same.get(tag, ("tr", "td", "th")):
                del self.stack[i:]
                return
            if self.stack[i].tag in ("ul", "ol", "dl", "table", "tbody", "thead"):
                return

    def end(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            # a stray end of an inline element closes no block
            if tag not in BLOCKS and self.stack[i].tag in BLOCKS:
                return


def _names(attributes: str) -> list[str]:
    """The single names in class, id and role."""
    return [name for match in _NAMES.finditer(attributes) for name in match[2].strip("\"'").split()]


def _names_furniture(attributes: str, known: frozenset[str]) -> bool:
    """Whether one name consists of known words for furniture and of plain words."""
    for name in _names(attributes):
        parts = [part.lower() for part in _PART.findall(name)]
        if not known.isdisjoint(parts) and all(part in known or part in PLAIN_NAMES for part in parts):
            return True
    return False


def _names_landmark(attributes: str) -> bool:
    return any(name.lower() in LANDMARK_NAMES for name in _names(attributes))


def read_blocks(html: str) -> list[Block]:
    """The blocks of a page in order, with where they stand."""
    reader, at = _Reader(), 0
    while True:
        match = _TOKEN.search(html, at)
        text = html[at : match.start()] if match else html[at:]
        if text:
            reader.parts.append(text)
            if reader.in_link:
                reader.linked += len(text)
        if not match:
            break
        at = match.end()
        closing, tag, attributes = match.group(1, 2, 3) if match[2] else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                reader.in_link = 0
            if tag in BLOCKS:
                reader.flush(heading=tag in ("h1", "h2", "h3", "h4", "h5", "h6"))
            reader.end(tag)
        elif tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = over.end() if over else len(html)
        elif tag in VOID:
            if tag == "hr":
                reader.flush()
            elif tag == "br":
                reader.parts.append(" ")
        else:
            if tag in BLOCKS or tag in FURNITURE:
                reader.flush()
            if tag == "a":
                reader.in_link, reader.links = 1, reader.links + 1
            reader.start(tag, attributes.rstrip("/") if attributes else "")
            if attributes and attributes.endswith("/") and tag not in BLOCKS:
                reader.end(tag)
    reader.flush()
    return reader.blocks


def first_pass(block: Block, rules: BlockRules) -> bool | None:
    """Good, bad or undecided."""
    if block.furniture:
        return False
    most = rules.bad_link_share_in_article if block.region else rules.bad_link_share
    if block.linked > most * len(block.text) and (block.links > 1 or not block.region):
        return False
    if len(block.text) < rules.short:
        return None
    found = block.text.lower().split(" ")
    stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in found)
    if stops >= rules.good_stop_share * len(found):
        return True
    return None


def second_pass(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided ones in their region."""
    n = len(blocks)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for places, nearest, step in ((range(n), before, 1), (range(n - 1, -1, -1), after, -1)):
        last: tuple[int, bool] | None = None
        region = -1
        for i in places:
            if blocks[i].region != region and not blocks[i].furniture:
                region = blocks[i].region
                # the ends of an article are good neighbours
                last = (i - step, True) if region else last
            nearest[i] = last
            if labels[i] is not None and not (blocks[i].furniture and region):
                last = (i, labels[i])
    out = []
    for i, label in enumerate(labels):
        if label is None:
            left, right = before[i], after[i]
            if left is None or right is None:
                label = (left or right or (0, False))[1]
            elif left[1] == right[1] or blocks[i].heading:
                label = right[1]
            else:
                label = left[1] if i - left[0] < right[0] - i else right[1]
        out.append(label)
    return out


def main_text(html: str | None, rules: BlockRules = BlockRules()) -> str:
    """The article of a page, a line per block."""
    blocks = read_blocks(html or "")
    labels = second_pass(blocks, [first_pass(b, rules) for b in blocks])
    good = [b for b, ok in zip(blocks, labels, strict=True) if ok]
    for inside in (lambda b: b.element, lambda b: b.region):
        if any(map(inside, good)):
            good = list(filter(inside, good))
    return "\n".join(b.text for b in good)


def extract(html: Column, rules: BlockRules = BlockRules()) -> Column:
    """The main text of each page; never null."""

    share_code()

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        return pa.array([main_text(page.as_py(), rules) for page in column], pa.string())

    return texts(html)
