"""Main text of web pages by tree scoring.

Paragraphs give points for length and commas to the elements around them, less with each level, and
a container's points are discounted by the share of its text that lies in links. The best container
is kept with those of its neighbours that score too. Menus, adverts and other surroundings are left
out before, by what elements say about themselves. Each page is parsed in its own task; nothing is
shuffled.
"""

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)|([^\s=/>\"']+)")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Elements without content.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements whose content is no markup; it is never shown as running text.
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
#: Elements that flow inside a block; all others begin and end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that are never part of an article.
_OUTSIDE = frozenset(
    "head nav footer aside form button select option optgroup datalist fieldset menu dialog svg math "
    "canvas object embed audio video map".split()
)
#: Those of them that have no running text, or none that is shown with the page.
_NEVER = frozenset(
    "head button select option optgroup datalist svg math canvas object embed audio video map".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
    "toolbar tablist status".split()
)
#: Words in class and id that mark surroundings.
_SURROUNDINGS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs "
    "byline combx consent cookie cookies copyright disclaimer footer footnav gdpr header hidden login "
    "masthead menu menus modal nav navbar navigation navigator newsletter notice notices notification "
    "overlay pager pagination popup privacy promo promos promotion recommended related rss share "
    "sharing shoutbox sidebar sidebars signin signup skip social sponsor sponsored subscribe "
    "subscription tags toc toolbar tooltip warning widget widgets".split()
)
#: Those of them that a layout around the article may name too, as in "with-sidebar".
_LAYOUT = frozenset("sidebar sidebars header menu nav navbar footer widget widgets toc tags hidden".split())
_COMMENTS = frozenset("comment comments commentlist respond disqus replies reply".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("article", "main"))
#: Elements that an opening tag closes if they are still open, and where the search for them ends.
_CLOSES = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("tr", "td", "th", "thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("tr", "td", "th", "thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("tr", "td", "th", "thead", "tbody", "tfoot"), ("table",)),
    "body": (("head",), ("html",)),
}

#: A paragraph needs so many signs to give points; one point for it, one per comma, and one per so
#: many signs up to a bound.
PARAGRAPH_CHARS = 25
POINT_CHARS = 100
MOST_LENGTH_POINTS = 3
#: Points of elements that are meant for the main text.
MAIN_POINTS = 25.0
#: A neighbour of the best container is kept with this share of its score.
NEIGHBOUR_SHARE = 0.2
#: An element that calls itself surroundings stays if it holds this share of all paragraph text.
MOST_TEXT = 0.5


class Element:
    """An element with its content in order: text and further elements."""

    __slots__ = ("tag", "parent", "content", "block", "outside", "layout", "named", "link",
                 "own", "own_links", "commas", "chars", "links", "score", "mass", "mains")

    def __init__(self, tag: str, parent):
        self.tag, self.parent, self.content = tag, parent, []
        self.block = tag not in _INLINE
        self.link = tag == "a" or (parent is not None and parent.link)
        self.outside = self.layout = self.named = False
        self.own = self.own_links = self.commas = self.chars = self.links = self.mass = self.mains = 0
        self.score = 0.0


def _mark(element: Element, attributes: str) -> None:
    """Note whether the element belongs to the surroundings of an article, and whether it does so by its
    tag, role or class alone (``named``), which a wrapper around the whole page may have too."""
    tag = element.tag
    element.named = tag in _OUTSIDE and tag not in _NEVER
    element.outside = tag in _OUTSIDE
    if not attributes or tag in ("html", "body"):
        return
    names: list[str] = []
    unseen = tag in _NEVER
    for name, value, flag in _ATTRIBUTE.findall(attributes):
        name = (name or flag).lower()
        value = html.unescape(value.strip("\"'"))
        if name in ("class", "id"):
            names += [part.lower() for part in _NAME_PART.findall(value)]
        elif name == "role" and value.lower() in _ROLES:
            element.outside = element.named = True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            element.outside = unseen = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            element.outside = unseen = True
    if not _COMMENTS.isdisjoint(names):
        element.outside = unseen = True
    elif tag not in _MAIN and tag not in _HEADINGS and not _SURROUNDINGS.isdisjoint(names):
        element.layout = not element.outside and _SURROUNDINGS.intersection(names) <= _LAYOUT
        element.outside = element.named = True
    element.named = element.named and not unseen


def parse(page: str) -> list[Element]:
    """All elements in page order, the first one the page itself. Never fails on broken markup."""
    root = Element("#page", None)
    elements, stack, open_tags = [root], [root], {}

    def close(count: int) -> None:
        for _ in range(count):
            open_tags[stack.pop().tag] -= 1

    def add_text(text: str) -> None:
        if text:
            stack[-1].content.append(html.unescape(text) if "&" in text else text)

    def close_nearest(tags: tuple[str, ...], ends: tuple[str, ...]) -> None:
        if any(open_tags.get(tag) for tag in tags):
            keep = None
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    break
                if stack[depth].tag in tags:
                    keep = depth
            if keep is not None:
                close(len(stack) - keep)

    at = 0
    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            add_text(page[at:])
            return elements
        add_text(page[at : found.start()])
        at = found.end()
        ended, opened = found.group(1), found.group(2) or found.group(4)
        if ended:
            tag = ended.lower()
            if open_tags.get(tag):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close(len(stack) - depth)
            elif tag == "br":
                stack[-1].content.append(" ")
        elif opened:
            tag = opened.lower()
            attributes = found.group(3) or found.group(5) or ""
            if tag in _RAW:
                if not attributes.endswith("/") or tag in ("script", "style"):
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = end.end() if end else len(page)
                continue
            if tag in _VOID:
                if tag not in ("wbr", "img"):
                    stack[-1].content.append(" ")
                continue
            if tag in _CLOSES:
                close_nearest(*_CLOSES[tag])
            if tag not in _INLINE:
                close_nearest(("p",), ("table", "td", "th", "button", "object"))
            element = Element(tag, stack[-1])
            _mark(element, attributes)
            stack[-1].content.append(element)
            elements.append(element)
            if not (attributes.endswith("/") and tag not in _INLINE and tag in ("svg", "math", "path")):
                stack.append(element)
                open_tags[tag] = open_tags.get(tag, 0) + 1


def _measure(elements: list[Element]) -> None:
    """Text sizes of each block's own lines and of each element's whole content."""
    for element in elements:
        text = "".join([part if isinstance(part, str) else " " for part in element.content])
        size = len(" ".join(text.split()))
        if size:
            block = element
            while not block.block:
                block = block.parent
            block.own += size
            block.commas += sum(map(text.count, ",،、，"))
            if element.link:
                block.own_links += size
            element.chars += size
            element.links += size if element.link else 0
    for element in reversed(elements):
        if element.block and element.own >= PARAGRAPH_CHARS and element.own_links * 2 < element.own:
            element.mass += element.own
        element.mains += element.tag in _MAIN and element.chars > 0 and not element.outside
        if element.parent is not None:
            element.parent.chars += element.chars
            element.parent.links += element.links
            element.parent.mass += element.mass
            element.parent.mains += element.mains


def _settle_outside(elements: list[Element]) -> None:
    """Page headers are surroundings, an article's own heading is not; what holds most of the page's
    paragraphs is no surroundings, whatever it is called, unless an article or main element lies beside
    it. Marks pass down."""
    total = elements[0].mass
    for element in elements[1:]:
        above = element.parent
        if element.tag == "header":
            element.named = element.named or not element.outside
            element.outside = True
        if element.layout or element.named and element.mains == elements[0].mains:
            element.outside = not (total and element.mass > MOST_TEXT * total)
        if above.outside:
            in_article_header = above.tag == "header" and element.tag in _HEADINGS
            element.outside = not (in_article_header and _inside_main(above))


def _inside_main(element: Element) -> bool:
    while element is not None:
        if element.tag in _MAIN:
            return True
        element = element.parent
    return False


def _score(elements: list[Element]) -> None:
    for element in elements:
        if element.outside or not element.block or element.own < PARAGRAPH_CHARS:
            continue
        if element.tag in _HEADINGS:
            continue
        points = 1 + element.commas + min(element.own / POINT_CHARS, MOST_LENGTH_POINTS)
        points *= 1 - element.own_links / element.own
        # the lines of a container itself count as its own paragraph
        holder = element.parent if element.tag in ("p", "pre", "li", "td", "blockquote", "dd") else element
        share, level = 1.0, 1
        while holder is not None and level <= 6:
            holder.score += points * share
            level += 1
            share = 0.5 if level == 2 else 1 / (3 * (level - 1))
            holder = holder.parent
    for element in elements:
        if element.score:
            if element.tag in _MAIN:
                element.score += MAIN_POINTS
            element.score *= 1 - element.links / max(element.chars, 1)


def _chosen(elements: list[Element]) -> list[Element]:
    """The best container with its neighbours, in page order."""
    inside = [one for one in elements if not one.outside and one.block]
    best = max(inside, key=lambda one: one.score, default=elements[0])
    if best.score <= 0:
        return [elements[0]]
    above = best
    while above is not None:
        if above.tag in _MAIN and not above.outside and not _mostly_links(above):
            best = above
        above = above.parent
    if best.parent is None:
        return [best]
    kept = []
    for one in best.parent.content:
        if isinstance(one, str) or one.outside:
            continue
        density = one.links / max(one.chars, 1)
        paragraph = one.tag == "p" and one.chars and density < 0.25
        wanted = one is best or one.score >= NEIGHBOUR_SHARE * best.score
        heading = one.tag in ("h1", "h2") and density < 0.5 and not kept
        if wanted or paragraph or heading:
            kept.append(one)
    return kept


def _mostly_links(element: Element) -> bool:
    """Whether most of the element's text lies in links, as in a list of teasers."""
    return element.links * 2 > max(element.chars, 1)


def _text(roots: list[Element]) -> str:
    """All text of the elements but for surroundings; blocks are apart by one space."""
    parts: list[str] = []
    for root in roots:
        stack = [iter([root])]
        ends = [""]
        while stack:
            part = next(stack[-1], None)
            if part is None:
                stack.pop()
                parts.append(ends.pop())
            elif isinstance(part, str):
                parts.append(part)
            elif part.outside:
                # a heading can be inside where the header around it is not
                nested = [one for one in part.content if not isinstance(one, str) and not one.outside]
                parts.append(" " if part.block else "")
                stack.append(iter(nested))
                ends.append(" ")
            else:
                edge = " " if part.block else ""
                parts.append(edge)
                stack.append(iter(part.content))
                ends.append(edge)
    return " ".join("".join(parts).split())


def main_text(page: str) -> str:
    """The article of one page; empty if the page has no text outside its surroundings."""
    elements = parse(page)
    _measure(elements)
    _settle_outside(elements)
    _score(elements)
    return _text(_chosen(elements))


def extract_main_text(pages: DataFrame, page: str = "html", output: str = "text") -> DataFrame:
    """Add ``output``: each page's main text, with white space runs as one space.

    Null and empty pages give an empty text. Pages of any length are parsed whole. Repeated rows are
    extracted each; an empty table gives an empty table; a column called ``output`` is replaced.
    """

    @F.pandas_udf("string")
    def extracted(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(value) if value else "" for value in column], dtype="object")

    return pages.withColumn(output, extracted(F.col(f"`{page}`")))
