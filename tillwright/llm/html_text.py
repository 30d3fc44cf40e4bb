"""Main text of web pages by scoring the element tree.

Each paragraph gives points for its length and its commas to its ancestors, less the further up they are. The
points of an element are discounted by its link density, the share of its text inside links. The best container
is kept, widened to the article that it lies in, with those of its siblings that score or read alike. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out wherever
they stand, by their element or by the words of their class, id or role. Class and id words, and forms, do not drop
a wrapper: an element around an article (`article`, or `main` where there is none) that holds nearly all paragraph points of
the page's articles. What stands beside or inside the article is dropped, however long it is. On a page without
article, words of layout do not drop an element that holds nearly all points; words of adverts, notices, menus and
comments do. Where nothing would be left, the element with nearly all points stays.

Defined results: a null or empty page, and one without text, have the empty text. Markup may be broken:
unclosed elements end where their parent ends or where a block follows a paragraph, unclosed menus and the like
where an article begins, stray end tags and lone `<` are ignored or text. Columns other than the html pass through; `text` replaces a column of this name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attributes>[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+|[^>]*+)>"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style title textarea noscript template iframe svg".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_NOISE = frozenset("head nav footer aside button select dialog menu object canvas".split()) | _RAW
_FORM = frozenset(("form", "fieldset"))
_ARTICLE = frozenset(("article", "main"))
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_PARAGRAPH = frozenset("p pre td blockquote li dd".split())
# Words of parts that are never the main text, and words that layouts also use for what holds it.
_PART_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|nav\w*|menus?|breadcrumbs?|"
    r"footer|comments?|disqus|repl(?:y|ies)|responses?|related|recommend\w*|subscribe|newsletter)(?:$|[\s_-])",
    re.IGNORECASE,
)
_LAYOUT_WORD = re.compile(
    r"(?:^|[\s_-])(?:banner|alerts?|modal|overlay|side-?bar|masthead|site-?header|page-?header|shar(?:e|ing)|social|sign-?up|log-?in|"
    r"search|widget|pag(?:er|ination)|toolbar|skip|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
# Words that name what an element has around it or lacks, as in has-sidebar.
_MODIFIED = re.compile(r"(?:^|(?<=[\s_-]))(?:has|have|with|without|no|not|non)[_-]\S*", re.IGNORECASE)
# Share of the paragraph points from which on class words do not drop an element.
_MAJOR = 0.8
_NOISE_ROLE = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog menu menubar form".split())


class _Element:
    __slots__ = ("tag", "parent", "children", "noise", "worded", "chars", "linked", "commas", "points")

    def __init__(self, tag: str, parent: _Element | None, noise: bool):
        self.tag, self.parent, self.noise = tag, parent, noise
        self.worded = 0  # its class or id names a part that is not the main text: 1 by a word of layout, 2 for sure
        self.children: list = []  # elements and texts in page order
        self.chars = self.linked = self.commas = 0
        self.points = 0.0


def _is_noise(tag: str, attributes: str, parent: _Element) -> bool:
    if parent.noise or tag in _NOISE:
        return True
    if tag == "header":  # an article's own header holds its title
        return not _inside(parent, ("article", "main"))
    if not attributes.strip() or tag in ("html", "body", "main"):
        return False
    named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in named or named.get("aria-hidden") == "true" or named.get("role", "").lower() in _NOISE_ROLE:
        return True
    return bool(re.search(r"display\s*:\s*none", named.get("style", "")))


def _worded(tag: str, attributes: str) -> int:
    if tag == "main":
        return 0
    named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    texts = [_MODIFIED.sub("", named.get(name, "")) for name in ("class", "id")]
    if any(_PART_WORD.search(text) for text in texts):
        return 2
    return int(tag in _FORM or any(_LAYOUT_WORD.search(text) for text in texts))


def _past_unclosed(element: _Element, html: str, at: int) -> _Element:
    """Where an article begins: an open menu, footer or the like that has no end tag of its own left ends before it."""
    here, noise = element, element if element.noise else None
    while noise is not None and noise.noise:
        if noise.tag in _NOISE or noise.tag == "header":
            found = re.compile(rf"<(/?){noise.tag}\b", re.IGNORECASE).search(html, at)
            if found is not None and found[1]:
                break
            here = noise.parent
        noise = noise.parent
    return here


def _inside(element: _Element | None, tags: tuple[str, ...]) -> _Element | None:
    while element is not None and element.tag not in tags:
        element = element.parent
    return element


def _open(element: _Element, tag: str) -> _Element:
    """The element that a new `tag` goes into: a block ends an open paragraph, an item the last one of its list."""
    if tag in _BLOCK:
        at: _Element | None = element
        while at is not None and (at.tag not in _BLOCK or at.tag == "p"):
            if at.tag == "p":
                element = at.parent
                break
            at = at.parent
    if closes := _CLOSES.get(tag):
        at = element
        while at is not None and at.tag not in ("ul", "ol", "dl", "table"):
            if at.tag in closes:
                element = at.parent
            at = at.parent
    return element


def _tree(html: str) -> _Element:
    root = here = _Element("html", None, False)
    at, size = 0, len(html)
    while at < size and (token := _TOKEN.match(html, at)):
        at = token.end()
        if (text := token["text"]) is not None:
            here.children.append(text)
        elif (tag := token["tag"]) is not None:
            tag = tag.lower()
            if token["end"]:
                found = here
                while found is not None and found.tag != tag and (tag in _BLOCK or found.tag not in _BLOCK):
                    found = found.parent
                if found is not None and found.tag == tag and found.parent is not None:
                    here = found.parent
            elif tag in ("html", "body"):
                continue  # one level less for all pages
            elif tag in _RAW:  # no markup inside: skip to the end tag
                close = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, at)
                if tag not in ("svg", "iframe") or not token["attributes"].rstrip().endswith("/"):
                    at = close.end() if close else size
            elif tag in _VOID:
                here.children.append("\n" if tag != "hr" else _Element("hr", here, False)) if tag in ("br", "hr") else None
            else:
                here = _open(here, tag)
                if tag in _ARTICLE and here.noise:
                    here = _past_unclosed(here, html, at)
                child = _Element(tag, here, _is_noise(tag, token["attributes"], here))
                child.worded = 0 if child.noise else _worded(tag, token["attributes"])
                here.children.append(child)
                here = child
    return root


def _measure(root: _Element) -> list[_Element]:
    """Fill in characters, linked characters and commas bottom-up; all elements that are not noise, in page order."""
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo += [c for c in reversed(element.children) if isinstance(c, _Element) and not c.noise]
    for element in reversed(order):
        element.chars = element.linked = element.commas = 0
        for child in element.children:
            if isinstance(child, str):
                element.chars += len(" ".join(child.split()))
                element.commas += child.count(",")
            elif not child.noise:
                element.chars += child.chars
                element.linked += child.linked
                element.commas += child.commas
        if element.tag == "a":
            element.linked = element.chars
    return order


def _density(element: _Element) -> float:
    return element.linked / element.chars if element.chars else 0.0


def _is_paragraph(element: _Element) -> bool:
    """A paragraph, or a division whose own text stands between no blocks."""
    if element.tag in _PARAGRAPH:
        return True
    return element.tag in ("div", "section", "article", "main") and any(
        isinstance(c, str) and len(c.strip()) > 20 for c in element.children
    )


def _paragraph_points(element: _Element) -> float:
    if element.chars < 20 or not _is_paragraph(element):
        return 0.0
    return (1 + element.commas + min(element.chars / 100, 3)) * (1 - _density(element))


def _summed(order: list[_Element], own: dict[int, float]) -> dict[int, float]:
    """The sum of own values over each element and what it holds."""
    total = dict(own)
    for element in reversed(order):  # children come last
        if element.parent is not None:
            total[id(element.parent)] += total[id(element)]
    return total


def _drop_worded(root: _Element, order: list[_Element]) -> None:
    """Elements whose class or id names a part that is not the main text become noise, unless they hold it."""
    if not any(element.worded for element in order):
        return
    part, article, worded = set(), set(), set()  # inside a part, an article, any worded element
    tags = {e.tag for e in order}
    core = "article" if "article" in tags else "main" if "main" in tags else None
    for element in order:  # parents come first
        above = id(element.parent)
        if element.worded == 2 or above in part:
            part.add(id(element))
        if element.worded or above in worded:
            worded.add(id(element))
        if core and (element.tag == core or above in article):
            article.add(id(element))
    if article - part:
        article -= part
    points = {id(e): _paragraph_points(e) for e in order}
    texts = {id(e): sum(len(c.strip()) for c in e.children if isinstance(c, str)) for e in order}
    inside = article or set(points)
    if not any(points[i] for i in inside):
        points = texts  # only short paragraphs
    held = _summed(order, {i: float(points[i]) if i in inside else 0.0 for i in points})
    around = _summed(order, {id(e): float(e.tag == core and id(e) in article) for e in order})
    major = [e for e in order if e.worded and held[id(e)] > _MAJOR * held[id(root)]]
    if core:
        # An article is around itself; what lies inside it is not.
        kept = {id(e) for e in major if around[id(e)] and not _inside(e.parent, (core,))}
    else:
        kept = {id(e) for e in major if e.worded == 1}
    # Without the others: whether any text is left.
    gone: set[int] = set()
    for element in order:
        if id(element.parent) in gone or (element.worded and id(element) not in kept):
            gone.add(id(element))
    if not any(texts[i] for i in inside - gone):
        kept |= {id(e) for e in major}
    for element in order:
        element.noise = element.noise or (element.worded > 0 and id(element) not in kept)


def _score(order: list[_Element]) -> _Element | None:
    best = None
    for element in order:
        if points := _paragraph_points(element):
            above, level = element.parent, 1
            while above is not None and level <= 5:
                above.points += points / level
                above, level = above.parent, level + 1
    for element in order:
        element.points *= 1 - _density(element)
        if element.points > (best.points if best else 0):
            best = element
    return best


def _kept(root: _Element) -> list[_Element]:
    _drop_worded(root, _measure(root))
    order = _measure(root)
    best = _score(order)
    if best is None:
        return [_inside(max(order, key=lambda e: (e.tag == "article", e.chars)), ("article", "html")) or root]
    # Outermost article around the best container; failing that, the main part.
    for tag in ("article", "main"):
        wide, at = None, _inside(best, (tag,))
        while at is not None:
            wide, at = at, _inside(at.parent, (tag,))
        if wide is not None:
            best = wide
            break
    if best.parent is None:
        return [best]
    least = max(10.0, 0.2 * best.points)
    kept = []
    for child in best.parent.children:
        if isinstance(child, _Element) and not child.noise:
            reads_alike = child.tag == "p" and child.chars > 80 and _density(child) < 0.25
            if child is best or child.points >= least or reads_alike:
                kept.append(child)
    return kept


def _blocks(element: _Element, out: list[list[str]]) -> None:
    """Append the texts of the element, a new list at each start and end of a block."""
    todo: list = [element]
    while todo:
        item = todo.pop()
        if item is None:
            out.append([])
        elif isinstance(item, str):
            out[-1].append(item)
        elif not item.noise:
            if item.tag in _BLOCK:
                out.append([])
                todo.append(None)
            todo += reversed(item.children)


def main_text(html: str | None) -> str:
    """Main text of one page: references decoded, white space inside a block as one space, blocks joined by one space."""
    out: list[list[str]] = [[]]
    for element in _kept(_tree(html or "")):
        _blocks(element, out)
    blocks = (" ".join(unescape("".join(texts)).split()) for texts in out if texts)
    return " ".join(b for b in blocks if b)


def _extracted(batches: Iterator[pa.RecordBatch], html: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([main_text(h.as_py()) for h in batch.column(html)], type=pa.string())
        yield pa.record_batch([*[batch.column(n) for n in names], texts], names=[*names, "text"])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """`pages` with `text`, the main text, in place of the html column."""
    names = [c for c in pages.columns if c not in (html, "text")]
    given = pages.select(*names, F.col(html).alias("_html"))
    kinds = ", ".join(f"`{n}` {pages.schema[n].dataType.simpleString()}" for n in names)
    return given.mapInArrow(partial(_extracted, html="_html", names=names), f"{kinds}{', ' if kinds else ''}text string")
