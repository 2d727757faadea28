"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines: a block element ends a line. Scripts, styles, menus, headers, footers, sidebars, notices,
adverts, forms and comments give no lines. A block element is judged by its name, its role or a whole class or id name, an
inline one never; one that wraps the page's article or most of its text is no advert, whatever its names say. End tags that
HTML lets a page omit are put in.

Where ``article`` and ``main`` hold at least half of the page's text outside links, all their lines are the main text and
no threshold is used. Else a line's length is its text outside links, whatever element it is in. The lengths are summed over
a sliding window of lines. A region begins with the first window that reaches a line with text outside links, and ends where
more than ``dive`` lines have none. The regions whose sum surges over a threshold are the main text. If no sum reaches the
threshold, the region of the largest sum is taken, so that a short page is not lost.

Character references are decoded, white space inside a block becomes one space, blocks are joined by an empty line.
Null, empty and markup-only pages give the empty text. Equal rows are extracted each on their own; an empty table
gives no rows; other columns are ignored. Work is linear in a page's length, unclosed tags and quotes included, and pages are independent.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines a window sums over, and the characters at which the sum is a surge.
WINDOW = 3
SURGE = 86
#: Lines of links alone that a region may hold in a row.
DIVE = 6

_START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*+)>")
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z_:-])([a-zA-Z_:-]++)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
#: Elements whose content is no markup and never shown.
_RAW = {"script", "style", "textarea", "title", "template", "iframe"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "math", "q", "rp", "rt", "ruby",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "svg", "time", "tt", "u", "var", "wbr",
}
#: Elements without main text. A header or footer inside the article is no exception.
_ASIDE = {"head", "nav", "header", "footer", "aside", "button", "select", "menu", "dialog"}
#: The same, but some pages are one form.
_FORMS = {"form", "fieldset"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
_COMMENT = {"comment", "comment-body", "reply"}
#: Whole class and id names of what may be longer than the main text.
_LONG = _COMMENT | {
    "comments", "comment-list", "comment-section", "comments-section", "comments-area", "disqus", "disqus-thread", "replies", "cookie", "cookies", "cookie-notice", "cookie-banner", "cookie-bar",
    "cookie-consent", "consent", "consent-banner", "gdpr",
}
#: Whole class and id names that mark what is not main text; ``_`` counts as ``-``.
_NAMES = _LONG | {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "ad-banner", "ad-container", "ad-slot", "ad-unit", "adsbygoogle", "sponsor", "sponsored", "promo", "promotion", "banner",
    "sidebar", "side-bar", "left-sidebar", "right-sidebar", "aside", "nav", "navbar", "navigation", "main-nav", "site-nav", "menu", "main-menu", "nav-menu", "breadcrumb", "breadcrumbs", "footer", "site-footer",
    "page-footer", "header", "site-header", "masthead", "notice", "notices", "popup", "modal", "overlay", "newsletter", "newsletter-signup", "subscribe", "subscription", "signup", "login", "login-form",
    "search-form", "comment-form", "share", "sharing", "share-buttons", "social", "social-links", "social-share", "related", "related-posts", "related-articles", "recommended", "widget", "pagination", "pager",
    "toolbar", "copyright", "disclaimer",
}
#: Elements that end an open p.
_ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "li", "listing", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul", "xmp",
}
_SCOPE = {"button", "caption", "object", "table", "td", "th"}
#: The elements of which another ends the nearest, and those beyond which it does not look.
_IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", *_SCOPE}), "dt": ({"dt", "dd"}, {"dl", *_SCOPE}), "dd": ({"dt", "dd"}, {"dl", *_SCOPE}), "option": ({"option"}, {"select"}), "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
#: What a head may hold besides the elements of ``_RAW``; others end it.
_HEAD = {"head", "base", "link", "meta", "noscript"}
#: Elements that hold a paragraph at most, and so are never a wrapper.
_SMALL = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "dt"}


@dataclass
class Line:
    text: str
    length: int
    in_article: bool


@dataclass
class Element:
    """``kind``: "aside" without main text, "maybe" or "long" by its names alone. Lengths are of text outside links and asides."""

    name: str
    parent: int
    kind: str
    is_article: bool
    total: int = 0
    own: int = 0  # without that of articles in it
    held: int = -1  # most ``own`` of the articles in it, itself included


def _kind(name: str, attributes: str) -> str:
    if name in _ASIDE:
        return "aside"
    kind = "maybe" if name in _FORMS else ""
    if not attributes or name in ("html", "body", "main"):
        return kind
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key in ("class", "id"):
            names = value.replace("_", "-").split()
            if name == "article":
                kind = kind if _COMMENT.isdisjoint(names) else "aside"
            elif not _NAMES.isdisjoint(names):
                kind = "maybe" if kind != "long" and _LONG.isdisjoint(names) else "long"
        elif name != "article" and (key == "role" and value in _ROLES or key == "aria-hidden" and value == "true"):
            kind = kind or "maybe"
    if name != "article" and re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", _VALUE.sub("= ", attributes)):
        kind = kind or "maybe"
    return kind


def _places(elements: list[Element]) -> list[tuple[bool, bool]]:
    """Of each element, whether it is set aside, and whether it is in an article.

    What only names or a form mark stays where it wraps an article that is not small beside the page's longest, or most of the
    page's text. Comments and consents may hold most of it: they stay only if less than a surge is left without them.
    """
    for element in reversed(elements[1:]):
        if element.is_article:
            element.held = max(element.held, element.own)
        if element.kind != "aside":
            above = elements[element.parent]
            above.total += element.total
            above.held = max(above.held, element.held)
            above.own += 0 if element.is_article else element.own
    page = elements[0]
    places = [(False, False)]
    for element in elements[1:]:
        aside, in_article = places[element.parent]
        if element.kind and not aside:
            most = 2 * element.total > page.total and element.total >= SURGE and (element.kind != "long" or page.total - element.total < SURGE)
            wraps = element.held >= 0 and 2 * element.held >= page.held or most
            aside = element.kind == "aside" or element.name in _SMALL or not wraps
        places.append((aside, in_article or element.is_article))
    return places


class Markup:
    """Finds a page's markup from left to right, in time linear in the page whatever its faults.

    A tag ends at the first ``>`` outside quotes. Where a quote is never closed, quotes count no more from there on, and what
    is not closed before the next ``<`` is text. So is what no ``>`` follows, except for a comment.
    """

    def __init__(self, page: str):
        self.page, self.last, self.pattern = page, page.rfind(">"), _TAG

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(first, end, slash, name, attributes) of the next piece of markup; comments and declarations have no name."""
        page = self.page
        while start := _START.search(page, at):
            first = start.start()
            if start[0] == "<!--":
                end = page.find("-->", first + 4)
                return first, len(page) if end < 0 else end + 3, "", "", ""
            if first > self.last:
                at = start.end()
                continue
            if start[0] in ("<!", "<?"):
                return first, page.index(">", first) + 1, "", "", ""
            tag = self.pattern.match(page, first)
            if tag is None:
                self.pattern = _PLAIN_TAG
                tag = self.pattern.match(page, first)
            if tag:
                return first, tag.end(), tag[1], tag[2], tag[3]
            at = start.end()
        return None


def lines_of(page: str) -> list[Line]:
    """The page's lines in order, empty ones in place of those that are set aside."""
    found: list[tuple[str, int, int]] = []  # text, length, element
    elements = [Element("", 0, "", False)]
    stack: list[int] = []  # open elements that are not inline
    opened: Counter[str] = Counter()
    parts: list[str] = []
    links = text_length = 0
    foreign = ""  # svg or math, while open

    def end_line() -> None:
        nonlocal text_length
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            at = stack[-1] if stack else 0
            found.append((text, text_length, at))
            elements[at].total += text_length
            elements[at].own += text_length
        parts.clear()
        text_length = 0

    def close(names: set[str], within: set[str] = frozenset()) -> None:
        """The nearest open element of the names, and what is open in it."""
        if not any(opened[name] for name in names):
            return
        for k in range(len(stack) - 1, -1, -1):
            name = elements[stack[k]].name
            if name in names:
                opened.subtract(elements[at].name for at in stack[k:])
                del stack[k:]
                return
            if name in within:
                return

    at, markup = 0, Markup(page)
    while at < len(page):
        token = markup.after(at)
        text = page[at : token[0] if token else len(page)]
        if text:
            parts.append(text)
            if not links:
                text_length += len(text.strip())
        if token is None:
            break
        _, at, closing, name, attributes = token
        name = name.lower()
        if not name:
            continue
        if opened["head"] and not closing and name not in _HEAD and name not in _RAW:
            end_line()
            close({"head"})
        if name in _RAW:
            if not foreign:
                end_line()
            if not closing and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif name in ("svg", "math"):
            foreign = "" if closing or attributes.rstrip().endswith("/") else name
        elif foreign and name not in _ENDS_P:
            if foreign == "svg":
                parts.append(" ")
        elif name == "a":
            links = max(0, links + (-1 if closing else 1))
        elif name == "br":
            parts.append(" ")
        elif name not in _INLINE:
            foreign = ""
            end_line()
            links = 0
            if closing:
                close({name})
                continue
            if name in _ENDS_P:
                close({"p"}, _SCOPE)
            if name in _IMPLIED_END:
                close(*_IMPLIED_END[name])
            if name not in _VOID:
                kind = _kind(name, attributes)
                elements.append(Element(name, stack[-1] if stack else 0, kind, name in ("article", "main") and not kind))
                stack.append(len(elements) - 1)
                opened[name] += 1
    end_line()
    places = _places(elements)
    return [Line("", 0, places[at][1]) if places[at][0] else Line(text, length, places[at][1]) for text, length, at in found]


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE, dive: int = DIVE) -> str:
    """The text of the page's articles, or that between the surge and dive points of the line lengths."""
    lines = [line for line in lines_of(page or "") if line.text]
    inside = [line for line in lines if line.in_article]
    if inside and 2 * sum(line.length for line in inside) >= sum(line.length for line in lines):
        return "\n\n".join(line.text for line in inside)
    lengths = [line.length for line in lines]
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    regions: list[list[int]] = []
    for i, length in enumerate(lengths):
        if length and regions and i - regions[-1][1] <= dive:
            regions[-1][1] = i + 1
        elif length:
            regions.append([max(0, i - window + 1), i + 1])
    least = min(surge, max(sums, default=0))
    kept = [i for first, last in regions if max(sums[first:last]) >= least for i in range(first, last)]
    return "\n\n".join(lines[i].text for i in kept)


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text and n_chars."""
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(page.as_py()) for page in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["page_id", "url", "text"])

    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(texts, f"page_id {id_type}, url {url_type}, text string").withColumn("n_chars", F.char_length("text").cast("long"))
