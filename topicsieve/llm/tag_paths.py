"""Main text of web pages by tag-path ratios.

A page is read as a list of text blocks, each with the path of block-level tags from
the root to it. Text length and punctuation are added up per path and divided by the
number of its blocks; the two ratios are smoothed over neighbouring blocks, fused, and
paths above a share of the best one are content. The content node is the page's article
or, without one, the innermost element around all blocks of these paths; all blocks in it
are the main text, but for lists of links around the text where the element is no more
than the page or a layout. Parts
that say what they are (menus, footers, adverts, comments, ...) do not take part, unless
they hold the page's article or most of its text: a wrapper's name is evidence only.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.frames import slices

#: A path is content if its fused ratio reaches this share of the page's best.
CONTENT_SHARE = 0.15
#: One article of several is the page's own if it holds this share of the content's text.
MAIN_ARTICLE_SHARE = 0.9
#: Paths and blocks with more than this share of their text in links are lists of links.
LINK_SHARE = 0.6
#: An article is the page's own if it holds this share of the text.
ARTICLE_SHARE = 0.25
#: Shares of the text with which a wrapper, or any other part, counts whatever it is called.
WRAPPER_SHARE = 0.5
PART_SHARE = 0.9
#: Weights of a block and its neighbours on either side.
SMOOTHING = np.array([0.06, 0.24, 0.4, 0.24, 0.06])

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|iframe|noembed|noframes|noscript|xmp"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd figcaption td th".split())
PROSE = TEXT_BLOCKS - {"li", "td", "th"}
CLOSED_BY_NEXT = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset("ul ol dl table tbody thead tfoot select article main section div body html".split())
NEVER = frozenset(
    "button select option template svg math object audio video canvas head datalist".split()
)
PARTS = frozenset("nav footer aside menu".split())
WRAPPERS = frozenset("form fieldset dialog".split())
PART_ROLES = frozenset("navigation contentinfo complementary menu menubar toolbar".split())
WRAPPER_ROLES = frozenset("banner search form dialog alert alertdialog".split())
# Words that name a part in any compound ("site-footer") that tells no state of a layout
# ("has-footer"), and words that do so only alone or with words of place and kind
# ("left-sidebar", not "widget-content").
PART_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsored nav navbar navigation breadcrumb "
    "breadcrumbs footer cookie cookies gdpr newsletter comment comments commentlist disqus replies "
    "pagination pager".split()
)
WRAPPER_WORDS = frozenset(
    "sponsor promo promotion banner menu sidebar masthead header consent notice alert popup modal "
    "overlay subscribe subscription signup login reply respond share sharing social related "
    "recommended recommendations widget toolbar search".split()
)
STATE_WORDS = frozenset(
    "has with no without is not show hide open opened closed enabled disabled on off visible "
    "free note notes count".split()
)
PLACE_WORDS = frozenset(
    "site left right top bottom upper lower primary secondary list lists area areas box boxes bar bars "
    "block blocks button buttons link links posts articles stories news items container wrapper wrap "
    "inner form js".split()
)

MARKUP = rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*+(?:>|\Z)"
TOKEN = re.compile(
    MARKUP + r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S | re.I,
)
#: The same without quoted values, for the rest of a page whose quotes are broken.
UNQUOTED = re.compile(MARKUP + r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>()()()", re.S | re.I)
#: How often a page may be searched in vain for the end of a quoted value.
BROKEN_QUOTES = 20
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：¿¡]")


# What an element says of itself: nothing, a layout wrapper's or a part's name, never text.
KEPT, WRAPPER, PART, HIDDEN = range(4)


@dataclass(slots=True)
class Element:
    tag: str
    number: int
    path: int  # the page's number for the tags from the root to here
    parent: int  # the element around it
    doubt: int = KEPT
    excluded: bool = False


class Open:
    """The elements that are open, and where on the stack each tag is."""

    def __init__(self, root: Element):
        self.items = [root]
        self.at: dict[str, list[int]] = {}
        self.others = [0]  # places of elements that are not text blocks

    def push(self, element: Element) -> None:
        place = len(self.items)
        self.at.setdefault(element.tag, []).append(place)
        if element.tag not in TEXT_BLOCKS:
            self.others.append(place)
        self.items.append(element)

    def cut(self, place: int) -> None:
        """Close everything from a place on."""
        while len(self.items) > place:
            self.at[self.items.pop().tag].pop()
        while self.others[-1] >= max(place, 1):
            self.others.pop()

    def last(self, tags) -> int:
        """The innermost place of one of these tags, 0 for none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def in_article(self) -> bool:
        return bool(self.at.get("article") or self.at.get("main"))


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""

    def is_links(self) -> bool:
        return self.link_chars > LINK_SHARE * len(self.text)


def name_doubt(name: str, inside_article: bool) -> int:
    """What a class or an identifier says of its element."""
    words = {w for w in re.split(r"[_-]+", name) if w and not w.isdigit()}
    if words & PART_WORDS:
        return KEPT if words & STATE_WORDS else PART
    says = words & WRAPPER_WORDS
    if inside_article:
        says -= {"header"}
    return WRAPPER if says and words <= WRAPPER_WORDS | PLACE_WORDS else KEPT


def doubt(tag: str, attributes: str, inside_article: bool) -> int:
    """What an element's tag, role, name or visibility says against it."""
    if tag in NEVER:
        return HIDDEN
    found = PART if tag in PARTS else KEPT
    if tag in WRAPPERS or (tag == "header" and not inside_article):
        found = WRAPPER
    if not attributes or tag in ("html", "body", "article", "main"):
        return found
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden":
            return HIDDEN
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return HIDDEN
        if name == "aria-hidden" and value == "true":
            found = max(found, WRAPPER)
        elif name == "role":
            found = max(found, PART * (value in PART_ROLES), WRAPPER * (value in WRAPPER_ROLES))
        elif name in ("class", "id"):
            found = max([found, *(name_doubt(x, inside_article) for x in value.split())])
    return found


def settle(blocks: list[Block], elements: list[Element]) -> None:
    """Decide which doubted elements are excluded, with all below them.

    A doubted element stays if it holds a ``main``, or the article with most text if
    that is a fair share of the page, or most of the text itself; a part needs more of
    it than a wrapper, and the only article. Text is counted without links, and without
    parts inside (comments below an article, for one).
    """
    if all(e.doubt in (KEPT, HIDDEN) for e in elements):
        return
    held = np.zeros(len(elements))
    for b in blocks:
        held[b.element.number] += max(0, len(b.text) - b.link_chars)
    whole = held.sum()
    has_main = [False] * len(elements)
    longest = [(0.0, 0)] * len(elements)  # text and number of the longest article in it
    in_part = [False] * len(elements)
    for e in elements[1:]:
        in_part[e.number] = in_part[e.parent] or e.doubt >= PART
    free = any(e.tag == "article" and not in_part[e.number] for e in elements)
    # from the inside out: elements come in page order, so inner ones follow
    for e in reversed(elements[1:]):
        i, above = e.number, e.parent
        has_main[i] |= e.tag == "main" and held[i] > 0
        if e.tag == "article":
            longest[i] = max(longest[i], (held[i], -i))
        if e.doubt == PART:
            only = not free and longest[i][0] > WRAPPER_SHARE * whole
            e.excluded = not (has_main[i] or only or held[i] >= PART_SHARE * whole > 0)
        has_main[above] |= has_main[i]
        if not e.excluded:
            held[above] += held[i]
            longest[above] = max(longest[above], longest[i])
    own = longest[0][0] > 0 and longest[0][0] >= ARTICLE_SHARE * held[0]
    around = articles_around(elements)
    for e in elements[1:]:
        i = e.number
        if elements[e.parent].excluded:
            e.excluded = True
        elif e.doubt == WRAPPER:
            share = PART_SHARE if not around[i] and (own or has_main[0]) else WRAPPER_SHARE
            stays = has_main[i] or (own and longest[i] == longest[0])
            e.excluded = not stays and held[i] <= share * held[around[i]]


def articles_around(elements: list[Element]) -> list[int]:
    """The innermost ``article`` or ``main`` around each element, 0 for none."""
    around = [0] * len(elements)
    for e in elements[1:]:
        above = elements[e.parent]
        around[e.number] = above.number if above.tag in ("article", "main") else around[above.number]
    return around


def in_tree(elements: list[Element], values: np.ndarray) -> np.ndarray:
    """The sums of ``values`` over each element and all below it."""
    sums = values.copy()
    for e in reversed(elements[1:]):
        sums[e.parent] += sums[e.number]
    return sums


def markup(page: str) -> Iterator[re.Match]:
    """The comments, declarations, raw elements and tags of a page, in linear time.

    Behind the last ``>`` there is no tag. A value whose quote never ends makes a search
    go through all the page; after a few of these quotes are ordinary characters.
    """
    end = page.rfind(">") + 1
    vain, at = 0, 0
    while vain < BROKEN_QUOTES:
        for match in TOKEN.finditer(page, at, end):
            yield match
            if match[6]:
                vain, at = vain + 1, match.end()
                if vain == BROKEN_QUOTES:
                    break
        else:
            return
    yield from UNQUOTED.finditer(page, at, end)


def is_unfinished(page: str, match: re.Match) -> bool:
    """Whether a comment or raw element at the end of all tags has no end itself."""
    if match.end() <= page.rfind(">"):
        return False
    if match[1]:
        return not re.search(rf"</{match[1]}\s*>\Z", match[0], re.I)
    return match[0].startswith("<!--") and not match[0].endswith("-->")


def read_blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The text blocks of a page in order, and all its block-level elements."""
    root = Element("#", 0, 0, 0)
    stack, elements = Open(root), [root]
    paths: dict[tuple[int, str], int] = {}
    blocks: list[Block] = []
    block = Block(root)
    links = 0

    def flush() -> None:
        nonlocal block
        if block.parts:
            blocks.append(block)
        block = Block(stack.items[-1])

    def add(text: str) -> None:
        if text and not stack.items[-1].excluded:
            block.parts.append(text)
            if links:
                block.link_chars += len(text)

    at, last = 0, page.rfind(">")
    for match in markup(page):
        add(page[at : match.start()])
        at = match.end()
        if at > last and is_unfinished(page, match):
            at = len(page)
        closing = match[2] if match[3] else match[5]
        tag = (match[3] or match[6] or "").lower()
        if not tag:
            continue
        attributes = match[4] or match[7] or ""
        if tag == "a":
            links = 0 if closing else 1
        excluded_inline = (
            bool(attributes and tag in INLINE and tag not in VOID and not closing)
            and doubt(tag, attributes, stack.in_article()) != KEPT
        )
        if tag in INLINE and not excluded_inline:
            if tag == "br":
                add(" ")
            elif closing and stack.at.get(tag):
                # an inline element that was ruled out ends
                flush()
                stack.cut(stack.at[tag][-1])
                block = Block(stack.items[-1])
            continue
        flush()
        if closing:
            if stack.at.get(tag):
                stack.cut(stack.at[tag][-1])
            links = 0
        elif tag not in VOID:
            closes = CLOSED_BY_NEXT.get(tag)
            if closes and (place := stack.last(closes)) >= max(1, stack.last(SCOPES)):
                stack.cut(place)
            # a paragraph ends where the next block begins
            if not excluded_inline and (place := stack.last(("p",))) > stack.others[-1]:
                stack.cut(place)
            if stack.items[-1].tag == "head" and tag != "template":
                # its end tag may be left out
                stack.cut(len(stack.items) - 1)
            above = stack.items[-1]
            says = doubt(tag, attributes, stack.in_article())
            element = Element(
                tag,
                len(elements),
                paths.setdefault((above.path, tag), len(paths) + 1),
                above.number,
                says,
                above.excluded or says == HIDDEN,
            )
            elements.append(element)
            if not attributes.rstrip().endswith("/"):
                stack.push(element)
        block = Block(stack.items[-1])
    # an unfinished tag at the end is no text
    rest = page[at:]
    add(re.sub(r"<[a-zA-Z/!?][^>]*\Z", "", rest))
    flush()
    for b in blocks:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
    blocks = [b for b in blocks if b.text]
    settle(blocks, elements)
    return blocks, elements


def content_paths(blocks: list[Block]) -> set[int]:
    """The paths whose smoothed and fused ratios make them content."""
    paths = [b.element.path for b in blocks]
    names = {p: i for i, p in enumerate(dict.fromkeys(paths))}
    of_block = np.array([names[p] for p in paths])
    n = np.bincount(of_block)
    chars = np.bincount(of_block, [len(b.text) for b in blocks]) / n
    points = np.bincount(of_block, [len(PUNCTUATION.findall(b.text)) for b in blocks]) / n
    linked = np.bincount(of_block, [b.link_chars for b in blocks]) / n
    smooth = [np.convolve(np.pad(x[of_block], 2, "edge"), SMOOTHING, "valid") for x in (chars, points)]
    fused = np.sqrt(smooth[0] * (1 + smooth[1]))
    score = np.maximum(np.bincount(of_block, fused) / n, np.sqrt(chars * (1 + points)))
    score[linked > LINK_SHARE * chars] = 0
    return {p for p, i in names.items() if score[i] >= CONTENT_SHARE * score.max() and score[i] > 0}


def content_node(blocks: list[Block], elements: list[Element], paths: set[int]) -> int:
    """Number of the page's article, or of the innermost element with all content."""
    content = [b for b in blocks if b.element.path in paths and not b.is_links()] or blocks
    own = np.zeros((len(elements), 2))
    for b in content:
        own[b.element.number] += (len(b.text), 1)
    held, n_blocks = in_tree(elements, own[:, 0]), in_tree(elements, own[:, 1])
    around = articles_around(elements)
    articles = [
        e.number
        for e in elements
        if e.tag in ("article", "main") and held[e.number] and not around[e.number]
    ]
    least = ARTICLE_SHARE if len(articles) == 1 else MAIN_ARTICLE_SHARE
    for number in articles:
        if held[number] >= least * held[0]:
            return number
    whole = [e.number for e in elements if n_blocks[e.number] == len(content) and e.tag not in TEXT_BLOCKS]
    return whole[-1] if whole else 0


def below(elements: list[Element], node: int, tags=None) -> list[bool]:
    """Which elements are a node or below it, with only ``tags`` (or any) between."""
    found = [False] * len(elements)
    found[node] = True
    for e in elements[node + 1 :]:
        found[e.number] = found[e.parent] and (tags is None or e.tag in tags)
    return found


def main_text(page: str) -> str:
    """The main text of a page: its blocks, an empty line between them."""
    blocks, elements = read_blocks(page)
    blocks = [b for b in blocks if not b.element.excluded]
    if not blocks:
        return ""
    paths = content_paths(blocks)
    node = content_node(blocks, elements, paths)
    inside = below(elements, node)
    inner = [b for b in blocks if inside[b.element.number]]
    if not paths:
        # nothing but links: headings and paragraphs
        inner = [b for b in inner if b.element.tag in PROSE]
    elif elements[node].tag not in ("article", "main"):
        content = [i for i, b in enumerate(inner) if b.element.path in paths and not b.is_links()]
        # only paragraphs, cells and the like between them and the node
        direct = below(elements, node, TEXT_BLOCKS)
        if elements[node].tag in ("#", "html", "body") or not any(
            direct[inner[i].element.number] for i in content
        ):
            # around the text itself, lists of links are the page's menus
            inner = [
                b
                for i, b in enumerate(inner)
                if b.element.tag in PROSE
                or not b.is_links()
                or (content and content[0] <= i <= content[-1])
            ]
    return "\n\n".join(b.text for b in inner)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    Null or empty pages give the empty text, an empty table an empty one. Every row is
    read for itself, so repeated rows and those without an identifier are like all
    others; other columns are not looked at. A page is read whole, in time and memory
    that grow with its length, however deep or broken its markup.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(x.as_py()) for x in batch["html"]]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    chosen = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return chosen.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
