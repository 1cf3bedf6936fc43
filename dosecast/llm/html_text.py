"""Operator 10: main text of a page by composite text density.

The page becomes a tree of elements. Every element has its characters, its tags, and the characters and
tags inside links. Its density is characters per tag, adjusted for links:

    density = C / T * log(C * T / (LC * LT), base log(C / NLC * LC + page LC / page C * C + e))

with C characters, T tags, LC and LT those in links, NLC characters outside links; counts of zero that divide count as one.
The score of an element is the sum of its children's densities, its own text standing for a child. The threshold is the
lowest density on the path from the element of highest score up to the body. From the body down, each element at or
above it gives the element of highest score in its subtree; the article is all of these, in page order. Where the
element of highest score lies in an ``article`` or ``main``, only such elements count, each from its start to its end.
Inside of what was chosen the threshold counts once more: a part (``PARTS``) below it goes if it is made of links, which is at least
``LINK_SHARE`` of its characters, and in lists and tables, short by nature, at least ``LIST_LINK_SHARE``; not so a part that holds an
element found above. Parts without links stay, however short: their density says no more than that.

Elements that by their nature hold no article (menus, headers, footers, sidebars, forms, scripts, styles) and those that
a class, id or role names as notice, advert or comments are taken out before anything is counted. Such names say nothing
about an ``article`` (unless inside another one) or ``main`` and what is around a ``main``, nor about an element with most of the page's
text outside links, as long as no other ``article`` or ``main`` has text. Names after has-, with-, without-, no- and layout- are of other
elements, and headers inside an article are part of it.

Text comes out by blocks: white space inside a block is one space, block edges are trimmed, blocks are joined by
a line feed in page order. Nothing is cut by length. A null or empty page, and a page without text, gives an empty text.
Unclosed and misplaced tags are closed as a browser would close them in the common cases: a block start ends
an open paragraph, an item ends the item before it, an end tag closes what is open inside it. Repeated pages
repeat; null ids and urls are kept; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import prepare

# fixed values: HTML element names by how they act
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
NO_ARTICLE = set(
    "head nav footer aside form script style noscript template iframe object svg math button select option "
    "textarea input dialog menu title xmp noembed noframes canvas audio video map".split()
)
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
LISTS = set("ul ol dl table".split())
# elements that hold a part of a page
PARTS = LISTS | set("div section article blockquote figure center details fieldset address".split())
LINK_SHARE, LIST_LINK_SHARE = 0.2, 0.5
ENDS_PARAGRAPH = BLOCKS - set("body html caption tbody td tfoot th thead tr".split())
# open elements that a start tag closes, and the elements that shield them
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# fixed values: words of a class, id or role that name what is not the article
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|header|masthead|footer|sidebar|side-bar|rail|widget|"
    r"complementary|contentinfo|comment|comments|disqus|discussion|replies|reply|notice|notices|cookie|cookies|"
    r"consent|gdpr|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|"
    r"social|related|recommended|pagination|pager|search|form|hidden)(?:$|[\s_-]|\d)",
    re.IGNORECASE,
)
# what a class word says of something else than its element
_OF_OTHERS = re.compile(r"(?:(?<=[\s_-])|^)(?:has|with|without|no|layout)[_-]\S*", re.IGNORECASE)
_HEADER = re.compile(r"(?:(?<=[\s_-])|^)header(?=$|[\s_-]|\d)", re.IGNORECASE)
HOMES = ("article", "main")
_TAG = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Element:
    __slots__ = (
        "tag", "parent", "children", "drop", "named", "in_home", "chars", "tags", "link_chars", "link_tags", "density", "score",
    )

    def __init__(self, tag: str, parent: Element | None, drop: bool = False, named: bool = False):
        self.tag, self.parent, self.drop, self.named = tag, parent, drop, named
        self.in_home = parent is not None and (parent.in_home or parent.tag in HOMES)
        self.children: list[Element | str] = []


def parse(html: str) -> Element:
    """The body of a page as a tree of elements and texts, in one pass over its tags."""
    root = here = Element("body", None)
    at = 0
    while True:
        found = _TAG.search(html, at)
        if found is None:
            here.children.append(unescape(html[at:]))
            _settle(root)
            return root
        if found.start() > at:
            here.children.append(unescape(html[at : found.start()]))
        at = found.end()
        close, tag, attributes = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if close:
            here = _closed(here, tag)
            continue
        if tag in ("html", "body"):
            continue
        here = _made_room(here, tag)
        in_home = here.in_home or here.tag in HOMES
        page_header = tag == "header" and not in_home
        hidden, named = _says(attributes, in_home)
        element = Element(tag, here, tag in NO_ARTICLE or page_header or hidden, named)
        here.children.append(element)
        if tag in VOID or (attributes.endswith("/") and tag not in BLOCKS):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
            continue
        here = element


def _says(attributes: str, in_home: bool) -> tuple[bool, bool]:
    """Whether attributes hide an element, and whether a class, id or role names it as what is not the article."""
    hidden = named = False
    if "=" not in attributes and "hidden" not in attributes.lower():
        return hidden, named
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape("".join(values))
        if name in ("class", "id", "role"):
            own = _OF_OTHERS.sub("", value)
            named = named or bool(BOILERPLATE.search(_HEADER.sub("", own) if in_home else own))
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            hidden = True
    return hidden, named


def _settle(root: Element) -> None:
    """Drops the elements that their names speak against, unless they hold the article."""
    order, stack, any_named = [], [(root, False, False, False)], False
    plain, around_main, at_home = {}, set(), 0
    while stack:
        element, in_link, under_name, in_article = stack.pop()
        if element.named and (element.tag == "main" or (element.tag == "article" and not in_article)):
            element.named = False
        any_named = any_named or element.named
        in_link, under_name = in_link or element.tag == "a", under_name or element.named
        in_article = in_article or element.tag == "article"
        count = 0 if in_link else sum(_characters(c) for c in element.children if isinstance(c, str))
        plain[element] = count
        if not under_name and (element.in_home or element.tag in HOMES):
            at_home += count
        order.append(element)
        stack.extend((c, in_link, under_name, in_article) for c in element.children if not isinstance(c, str) and not c.drop)
    if not any_named:
        return
    for element in reversed(order):
        if element.parent is not None:
            plain[element.parent] += plain[element]
            if element in around_main or (element.tag == "main" and plain[element]):
                around_main.add(element.parent)
    for element in order:
        if element.named and element not in around_main:
            most = 2 * plain[element] > plain[root]
            element.drop = not most or (not element.in_home and at_home > 0)


def _closed(here: Element, tag: str) -> Element:
    """Where an end tag leads: the parent of the nearest open element of that name, or nowhere else."""
    at = here
    while at.parent is not None:
        if at.tag == tag:
            return at.parent
        if tag not in BLOCKS and at.tag in BLOCKS:
            return here  # an inline end tag does not close a block
        at = at.parent
    return here


def _made_room(here: Element, tag: str) -> Element:
    """Where a start tag opens, once what it ends is closed."""
    if tag in ENDS_PARAGRAPH:
        at = here
        while at.parent is not None and (at.tag == "p" or at.tag not in BLOCKS):
            if at.tag == "p":
                here = at.parent
                break
            at = at.parent
    if tag in CLOSES:
        ends, shields = CLOSES[tag]
        at, target = here, None
        while at.parent is not None and at.tag not in shields:
            if at.tag in ends:
                target = at.parent
            at = at.parent
        here = target or here
    return here


def _characters(text: str) -> int:
    return len("".join(text.split()))


def measure(root: Element) -> None:
    """Counts, densities and scores of all elements, children before parents."""
    order, stack = [], [(root, False)]
    while stack:
        element, in_link = stack.pop()
        in_link = in_link or element.tag == "a"
        element.chars = element.tags = element.link_chars = element.link_tags = 0
        for child in element.children:
            if isinstance(child, str):
                count = _characters(child)
                element.chars += count
                element.link_chars += count if in_link else 0
            elif not child.drop:
                stack.append((child, in_link))
        order.append(element)
    for element in reversed(order):
        parent = element.parent
        if parent is not None:
            parent.chars += element.chars
            parent.tags += element.tags + 1
            parent.link_chars += element.link_chars
            parent.link_tags += element.link_tags + (element.tag == "a")
    page_ratio = root.link_chars / max(1, root.chars)
    for element in order:
        element.density = _density(element, page_ratio)
    for element in order:
        own = sum(_characters(c) for c in element.children if isinstance(c, str))
        element.score = own + sum(c.density for c in element.children if not isinstance(c, str) and not c.drop)


def _density(e: Element, page_ratio: float) -> float:
    if not e.chars:
        return 0.0
    tags, link_chars, link_tags = max(1, e.tags), max(1, e.link_chars), max(1, e.link_tags)
    plain = max(1, e.chars - e.link_chars)
    base = math.log(e.chars / plain * e.link_chars + page_ratio * e.chars + math.e)
    return max(0.0, e.chars / tags * math.log(max(1.0, e.chars * tags / (link_chars * link_tags))) / base)


def main_elements(root: Element) -> list[Element]:
    """The subtrees of the article, apart and in page order; parts of them that are made of links are dropped."""
    if not root.chars:
        return []
    elements, stack = [], [root]
    while stack:
        element = stack.pop()
        elements.append(element)
        stack.extend(c for c in reversed(element.children) if not isinstance(c, str) and not c.drop)
    at = {e: i for i, e in enumerate(elements)}
    top, end = {}, {}
    for i in range(len(elements) - 1, -1, -1):
        element = elements[i]
        end[element], top[element] = i + 1, element
        for child in element.children:
            if child in at:
                end[element] = max(end[element], end[child])
                if top[child].score > top[element].score:
                    top[element] = top[child]
    threshold = min(e.density for e in _up(top[root]))
    home, whole = {}, {}
    for element in elements:
        parent = element.parent
        home[element] = element if element.tag in HOMES else home.get(parent)
        # an article is made of blocks
        whole[element] = element if parent is None or (element.tag in BLOCKS and element.tag != "p") else whole[parent]
    found, stack = set(), [root]
    while stack:
        element = stack.pop()
        if element.density >= threshold:
            found.add(top[element])
            stack.extend(c for c in element.children if c in at)
    in_home = home[top[root]] is not None
    chosen = {home[e] if in_home else whole[e] for e in found} - {None}
    out, covered = [], 0
    for element in sorted(chosen, key=at.get):
        if at[element] >= covered:
            out.append(element)
            covered = end[element]
    kept = {above for element in found for above in _up(element)}
    for element in out:
        for part in elements[at[element] + 1 : end[element]]:
            part.drop = part.density < threshold and part not in kept and _made_of_links(part)
    return out


def _made_of_links(part: Element) -> bool:
    share = LIST_LINK_SHARE if part.tag in LISTS else LINK_SHARE
    return part.tag in PARTS and part.link_chars > 0 and part.link_chars >= share * part.chars


def _up(element: Element | None) -> Iterator[Element]:
    while element is not None:
        yield element
        element = element.parent


def blocks(element: Element) -> list[str]:
    """Texts of the blocks of a subtree in page order, white space folded, empty ones left out."""
    out, now = [], []

    def flush():
        text = " ".join("".join(now).split())
        if text:
            out.append(text)
        now.clear()

    stack: list[Element | str | None] = [element]
    while stack:
        at = stack.pop()
        if at is None:
            flush()
        elif isinstance(at, str):
            now.append(at)
        elif at is element or not at.drop:
            if at.tag == "br":
                now.append(" ")
            elif at.tag in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(at.children))
    flush()
    return out


def extract(html: str | None) -> str:
    """Main text of one page."""
    if not html:
        return ""
    root = parse(html)
    measure(root)
    return "\n".join(text for element in main_elements(root) for text in blocks(element))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per page row."""
    prepare(pages.sparkSession)
    kinds = dict(pages.dtypes)

    def run(batches):
        for batch in batches:
            texts = [extract(h.as_py()) for h in batch.column("html")]
            yield pa.record_batch(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array(list(map(len, texts)), pa.int64()),
                }
            )

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select(*[F.col(c) for c in ("page_id", "url", "html")]).mapInArrow(run, schema)
