"""Main text of web pages by composite text density.

Every element of a page gets a density: its characters per tag, lowered by the
share of its text that stands in links. The element whose children's densities
sum highest holds the main text; the smallest density on the way from it to the
body is the threshold, and below every element that reaches the threshold the
part with the highest sum is kept. Formatting inside a line (bold, spans, line
breaks) counts as text, links and blocks as elements. Elements that are never article text (menus,
forms, notices, reader comments and so on) are taken out before the densities
are computed, by tag, role or the words of their class and id. Such a word alone
takes out neither what holds the page's text nor its article (see ``settle``).
"""

from __future__ import annotations

import html as htmllib
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes".split())
DROP_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe object embed svg canvas audio video button "
    "select textarea input dialog menu title xmp noembed noframes".split()
)
DROP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay menu menus nav navbar navigation "
    "breadcrumb breadcrumbs header masthead topbar footer foot sidebar sidebars aside widget widgets comment comments "
    "commentlist disqus reply replies respond discussion share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login search pagination pager toolbar skip".split()
)
KEEP_TAGS = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {
    "a": frozenset(["a"]),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("html body article section main div ul ol dl table td th blockquote nav aside footer header form".split())

# A quote opens a value only after "="; anywhere else, and where none closes it, it is a letter like any other.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""", re.S
)
_BROKEN_OFF = re.compile(r"</?(?:[a-zA-Z]|\Z)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|([^\s"'>/=]+)""")
_WORDS = re.compile(r"[a-z0-9]+")
#: An element with more than this share of a page's text isn't taken out for a word of its class or id.
MOST = 0.75


class Node:
    __slots__ = ("tag", "parent", "items", "drop", "listed", "chars", "tags", "link_chars", "link_tags", "density", "sum", "best")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, listed: bool = False) -> None:
        self.tag, self.parent, self.drop, self.listed = tag, parent, drop, listed
        self.items: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.best = self


def _dropped(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element goes for its tag, role or style, and whether its class or id has a listed word."""
    if tag in DROP_TAGS or tag == "header" and not in_article:
        return True, False
    if not attributes:
        return False, False
    found = {}
    for name, a, b, c, bare in _ATTRIBUTE.findall(attributes):
        found.setdefault((name or bare).lower(), (a or b or c).lower())
    listed = not DROP_WORDS.isdisjoint(_WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}"))
    if tag in KEEP_TAGS:
        return False, listed
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "") in DROP_ROLES
    return hidden or "display:none" in found.get("style", "").replace(" ", ""), listed


def parse(page: str) -> Node:
    """The page's tree. Unclosed elements end with their container, a page that breaks off ends all of them."""
    root = Node("html", None)
    at, where, body, articles = 0, root, None, 0
    size = len(page)
    while at < size:
        start = page.find("<", at)
        if start != at:
            where.items.append(page[at : start if start >= 0 else size])
        if start < 0:
            break
        m = _MARKUP.match(page, start)
        if m is None:
            if _BROKEN_OFF.match(page, start):
                break  # the page ends within a tag
            where.items.append("<")
            at = start + 1
            continue
        at = m.end()
        closing, tag, attributes = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            node = where
            while node is not None and node.tag != tag:
                if node.tag in SCOPES and tag not in SCOPES:
                    node = None  # a stray end tag doesn't leave its container
                    break
                node = node.parent
            if node is not None and node.parent is not None and node.tag != "body":
                while where is not node.parent:
                    articles -= where.tag in ("article", "main")
                    where = where.parent
            continue
        if tag == "html":
            continue
        if tag == "body":
            if body is None:
                where = root
                body = Node("body", root)
                root.items.append(body)
                where = body
            continue
        closed = CLOSED_BY.get(tag) or (None if tag in INLINE else frozenset(["p"]))
        if closed:
            node = where
            while node is not None and node.tag not in closed and node.tag not in SCOPES - closed:
                node = node.parent
            if node is not None and node.tag in closed:
                where = node.parent
                if tag in ("td", "th") and node.tag == "tr":
                    where = node
        drop, listed = (True, False) if where.drop else _dropped(tag, attributes, articles > 0)
        if tag in INLINE and tag != "a" and not drop and not listed:
            if tag == "br":
                where.items.append("\n")
            continue  # formatting is part of the text around it, not structure
        node = Node(tag, where, drop, listed)
        where.items.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if attributes.endswith("/") and tag not in INLINE and tag in ("svg", "path"):
            continue
        articles += tag in ("article", "main")
        where = node
    top = body if body is not None else root
    settle(top)
    return top


def settle(top: Node) -> None:
    """Take out the elements whose class or id has a listed word.

    Those stay that hold over ``MOST`` of the page's text, or its largest article
    (``article`` or ``main`` without such a word) if that has more text than all
    elements outside of listed ones. Their densities decide then.
    """
    order = _in_order(top)
    size: dict[int, int] = {}
    outside, clear, largest = 0, {id(top.parent)}, None
    for n in order:
        size[id(n)] = sum(len(x) - sum(map(x.count, " \n\t")) for x in n.items if isinstance(x, str))
        if id(n.parent) in clear and (not n.listed or n.tag in KEEP_TAGS):
            clear.add(id(n))
            outside += size[id(n)]
    for n in reversed(order):
        if n is not top:
            size[id(n.parent)] += size[id(n)]
        if n.tag in ("article", "main") and not n.listed and (largest is None or size[id(n)] >= size[id(largest)]):
            largest = n
    holders = set()
    if largest is not None and size[id(largest)] > outside:
        node = largest
        while node is not top:
            node = node.parent
            holders.add(id(node))
    for n in order:
        if n.listed and n.tag not in KEEP_TAGS and id(n) not in holders:
            n.drop = size[id(n)] <= MOST * size[id(top)]


def _in_order(top: Node) -> list[Node]:
    """All kept elements, each before its children."""
    found, stack = [], [top]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(x for x in reversed(node.items) if not isinstance(x, str) and not x.drop)
    return found


def _density(n: Node, link_share: float) -> float:
    if not n.chars:
        return 0.0
    chars, tags = n.chars, max(n.tags, 1)
    links, link_tags, rest = max(n.link_chars, 1), max(n.link_tags, 1), max(n.chars - n.link_chars, 1)
    base = math.log(chars / rest * links + link_share * chars + math.e)
    return max(0.0, chars / tags * math.log(chars / links * tags / link_tags) / math.log(base))


def weigh(top: Node) -> list[Node]:
    """Fill in counts, densities, sums and the element of the highest sum in each subtree; returns the kept elements, each before its children."""
    order = _in_order(top)
    own: dict[int, int] = {}
    for n in reversed(order):
        direct = sum(len(x) - x.count(" ") for x in n.items if isinstance(x, str))
        own[id(n)] = direct
        kids = [x for x in n.items if not isinstance(x, str) and not x.drop]
        n.chars = direct + sum(x.chars for x in kids)
        n.tags = sum(x.tags + 1 for x in kids)
        link = n.tag == "a"
        n.link_chars = n.chars if link else sum(x.link_chars for x in kids)
        n.link_tags = sum(x.link_tags + (x.tag == "a") for x in kids)
    share = top.link_chars / max(top.chars, 1)
    for n in order:
        n.density = _density(n, share)
    for n in order:
        n.sum = sum(x.density for x in n.items if not isinstance(x, str) and not x.drop)
        if own[id(n)]:
            text = Node("#text", n)
            text.chars = own[id(n)]
            text.link_chars = text.chars if n.tag == "a" else 0
            n.sum += _density(text, share)
    for n in reversed(order):
        for x in n.items:
            if not isinstance(x, str) and not x.drop and x.best.sum > n.best.sum:
                n.best = x.best
    return order


def choose(top: Node) -> list[Node]:
    """The elements that hold the main text, in page order, none inside another."""
    weigh(top)
    if not top.chars:
        return []
    node = top.best
    threshold = node.density
    while node is not top:
        node = node.parent
        threshold = min(threshold, node.density)
    chosen: set[int] = set()
    stack = [top]
    while stack:
        node = stack.pop()
        if node.density >= threshold and node.chars:
            chosen.add(id(node.best))
            if node.best is node:
                continue
        stack.extend(x for x in reversed(node.items) if not isinstance(x, str) and not x.drop and x.chars)
    found, stack = [], [top]
    while stack:
        node = stack.pop()
        if id(node) in chosen:
            found.append(node)
        else:
            stack.extend(x for x in reversed(node.items) if not isinstance(x, str) and not x.drop)
    return found


def blocks(nodes: list[Node]) -> list[str]:
    """Text of the elements by block, references decoded, white space folded."""
    found: list[str] = []
    parts: list[str] = []

    def end() -> None:
        text = " ".join(htmllib.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append(text)

    for top in nodes:
        end()
        stack: list[Node | str | None] = [top]
        while stack:
            x = stack.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                parts.append(x)
            elif not x.drop:
                if x.tag not in INLINE:
                    end()
                    stack.append(None)
                stack.extend(reversed(x.items))
    end()
    return found


def main_text(page: str | None) -> str:
    return "\n\n".join(blocks(choose(parse(page)))) if page else ""


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of every whole page: ``key, url, text``.

    Blocks are joined in page order by two line feeds. A null or empty page, and
    one without any article text, has an empty text. Null keys and urls and
    repeated rows stay; other columns take no part. One narrow pass, no shuffle.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = pages.schema[key].dataType.simpleString()

    def make():
        return lambda cols: {"key": cols["key"], "url": cols["url"], "text": [main_text(h) for h in cols["html"]]}

    return map_rows(rows, make, f"key {kind}, url string, text string").withColumnsRenamed({"key": key, "url": url})
