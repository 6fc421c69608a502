"""Main text of web pages by composite text density.

A page is parsed into a DOM (forgiving of missing end tags).  Elements that
the page itself marks as something else go by their tag, role or state:
scripts, styles and other unrendered elements, navigation, headers and footers
of the page, asides, forms, hidden elements, unless they hold the article.

On what is left, every node gets its composite text density: characters per
tag, adjusted by the logarithm that weighs link characters and link tags
against the page's.  The densities of a node's children sum up, and the node
with the greatest sum is the content; the smallest density on its path to the
body is the threshold above which other subtrees give their own greatest node
as well.  Article and main elements are a hint for the borders only: a chosen
node inside of one stands for the whole element, and a chosen node above some
that hold most of its text stands for all of them and for its other subtrees
that pass the threshold.  Where the chosen nodes have no first-level heading,
the last one before them belongs to them.

A class or id removes nothing.  Where all words of one say advert, notice,
menu, sidebar, comments and the like, the densities below it are lowered, by
a tenth or, for adverts and comments, a hundredth; the threshold then decides
on it like on every subtree, also inside of the chosen nodes.  A name under
which most of the page's text outside of links stands lowers nothing.

The work is one function per page, linear in its nodes however deep they
nest; nothing is shuffled.

Defined results: null or empty html gives an empty text; a page without text
outside of boilerplate gives an empty text; very long pages are parsed whole,
one page in memory at a time; repeated rows get the same result; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import col, read_table, ship_package

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset(
    "script style noscript template head title meta link iframe object embed svg canvas audio video map math "
    "datalist dialog".split()
)
ASIDE = frozenset("nav footer aside form button select option optgroup textarea input fieldset legend menu".split())
#: An open element of the key's set ends when the key starts.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"}, "thead": {"tr", "td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
#: ... but only within the nearest of these.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
_TABLE = {"table"}
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
# Words of class and id names that mark boilerplate.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disqus footer gdpr hidden login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination paywall popup promo promotion recommended "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription teaser toolbar topbar widget".split()
)
STRONG = frozenset(
    "ad ads advert adverts advertisement advertising adsense comment comments disqus replies reply respond sponsored".split()
)
# words that add nothing to a mark: the name of a part or of a kind of box
PLAIN = frozenset("area bar block box container content inner item link links list main page section site top wrap wrapper".split())
LOWERED, STRONGLY = 0.1, 0.01
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_UNNAMED = INLINE | _HEADINGS | frozenset("#root html body main td th".split())


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total",
                 "inside", "holds", "weight", "low", "begin", "end", "best")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.weight, self.low = 1.0, False

    def kids(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]


class Tree(HTMLParser):
    """Builds the DOM; every page gives a tree, whatever is missing.  Open
    elements are a stack with the places of each tag, so that a start tag
    finds what it ends without a walk up the tree."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}

    def _last(self, tags: set[str] | frozenset[str]) -> int:
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=0)

    def _cut(self, place: int) -> None:
        """Close the element at ``place`` and all inside."""
        while len(self.open) > place:
            self.places[self.open.pop().tag].pop()

    def _close(self, tags: set[str] | frozenset[str], scope: set[str]) -> None:
        place = self._last(tags)
        if place > self._last(scope):
            self._cut(place)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS:
            self._close(ENDS[tag], SCOPES.get(tag, _TABLE))
        if tag not in INLINE and tag not in UNSEEN:
            self._close({"p"}, {"button", "table", "td", "th"})
            if tag in _HEADINGS:
                self._close(_HEADINGS, {"div", "section", "article", "main", "td"})
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        place = self._last({tag})
        if not place:
            return
        if tag in INLINE:  # a stray end of an inline element closes no block
            at = len(self.open) - 1
            while at > place and self.open[at].tag in INLINE:
                at -= 1
            if at > place:
                return
        self._cut(place)

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _in_order(root: Node) -> list[Node]:
    """All nodes in page order, with the places where each begins and ends."""
    out, stack = [], [(root, False)]
    while stack:
        node, over = stack.pop()
        if over:
            node.end = len(out)
            continue
        node.begin = len(out)
        out.append(node)
        stack.append((node, True))
        stack += [(c, False) for c in reversed(node.kids())]
    return out


def _marked_names(node: Node) -> dict[str, float]:
    """Names (of class and id) all of whose words mark boilerplate, with the
    weight that they give."""
    out: dict[str, float] = {}
    if node.tag in _UNNAMED:
        return out
    for name in f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".split():
        words = {w.lower() for w in _WORDS.findall(name)}
        marks = words & MARKS | (words & {"header"} if not node.inside else set())
        if marks and words <= marks | PLAIN:
            out[name] = STRONGLY if marks & STRONG else LOWERED
    return out


def is_boilerplate(node: Node) -> bool:
    tag = node.tag
    if tag in UNSEEN:
        return True
    if tag in ("#root", "html", "body", "main", "article"):
        return False
    style = node.attrs.get("style", "").replace(" ", "").lower()
    gone = "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true" or "display:none" in style
    gone = gone or tag in ASIDE or node.attrs.get("role", "").lower() in ROLES
    gone = gone or tag == "header" and not node.inside
    return gone and not node.holds


def prune(root: Node) -> None:
    """Remove what tag, role or state mark; note which nodes are inside of an
    article and which hold one."""
    nodes = _in_order(root)
    for node in nodes:
        up = node.parent
        node.inside = up is not None and (up.inside or up.tag in ("article", "main"))
    for node in reversed(nodes):
        node.holds = any(
            k.holds or k.tag == "main" or k.tag == "article" and not _marked_names(k) for k in node.kids()
        )
    stack = [root]
    while stack:
        node = stack.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not is_boilerplate(c)]
        stack += node.kids()


def _own_chars(node: Node) -> int:
    return sum(len("".join(c.split())) for c in node.children if isinstance(c, str))


def _void_names(nodes: list[Node], names: list[dict[str, float]]) -> set[str]:
    """Marked names that hold more than half of the text outside of links, so
    that they say nothing.

    Text below comments, adverts and the like counts as the page's only where
    it is nine tenths of all."""
    if not any(names):
        return set()
    chars: Counter[tuple[str, bool]] = Counter()  # of name and "not below a strong mark"
    total: Counter[bool] = Counter()
    own = [0 if n.tag == "a" else _own_chars(n) for n in nodes]
    text, plain = [0] * len(nodes), [0] * len(nodes)  # outside of links; of it not below a strong mark
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        kids = [] if node.tag == "a" else node.kids()
        text[i] = own[i] + sum(text[k.begin] for k in kids)
        strong = any(w == STRONGLY for w in names[i].values())
        plain[i] = 0 if strong else own[i] + sum(plain[k.begin] for k in kids)
        for name in names[i]:
            # a name inside of itself counts once more at most; it only errs to "void"
            chars[name, True] += plain[i]
            chars[name, False] += text[i] - plain[i]
    total[True], total[False] = plain[0], text[0] - plain[0]
    every = text[0]
    alone = 10 * total[True] <= every  # nearly all is below comments and the like
    strong_names = {name for d in names for name, w in d.items() if w == STRONGLY}
    out = set()
    for name in {name for name, _ in chars}:
        held = chars[name, True] + chars[name, False]
        if name in strong_names or alone:
            void = 10 * held >= 9 * every
        else:
            void = 2 * chars[name, True] > total[True]
        if void:
            out.add(name)
    return out


def weigh(nodes: list[Node]) -> None:
    """Lower the weights below marked names (``low``: here, not above)."""
    names = [_marked_names(n) for n in nodes]
    void = _void_names(nodes, names)
    for node, own in zip(nodes, names, strict=True):
        marks = [w for name, w in own.items() if name not in void]
        node.low = bool(marks) and not node.holds
        node.weight = (node.parent.weight if node.parent else 1.0) * (min(marks) if node.low else 1.0)


def measure(nodes: list[Node]) -> None:
    """Weighted densities of all nodes (given in page order), their sums, and
    the node of the greatest sum in every subtree."""
    root = nodes[0]
    for node in reversed(nodes):
        kids = node.kids()
        node.chars = _own_chars(node) + sum(k.chars for k in kids)
        node.tags = len(kids) + sum(k.tags for k in kids)
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(k.link_chars for k in kids)
        node.link_tags = sum(k.link_tags + (k.tag == "a") for k in kids)
    body_ratio = root.link_chars / root.chars if root.chars else 0.0
    for node in nodes:
        c, t = node.chars, max(node.tags, 1)
        if not c:
            node.density = 0.0
            continue
        lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c / max(c - node.link_chars, 1) * lc + body_ratio * c + math.e)
        node.density = node.weight * c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(base)
    for node in reversed(nodes):
        kids = node.kids()
        node.total = sum(k.density for k in kids)
        node.best = node
        for k in kids:  # the first of equal ones in page order
            if k.best.total > node.best.total:
                node.best = k.best


def _above(upper: Node, node: Node) -> bool:
    return upper.begin < node.begin < upper.end


def _tops(nodes: list[Node]) -> list[Node]:
    """Those of the nodes that lie below no other of them, in page order."""
    out: list[Node] = []
    for n in sorted(nodes, key=lambda n: (n.begin, -n.end)):
        if not out or n.begin >= out[-1].end:
            out.append(n)
    return out


def content_nodes(root: Node) -> tuple[list[Node], float]:
    """The chosen nodes in page order, and the threshold."""
    nodes = _in_order(root)
    weigh(nodes)
    measure(nodes)
    if not root.chars:
        return [], 0.0
    body = next((n for n in nodes if n.tag == "body"), root)
    node = body.best
    limit = node.density
    while node is not body:
        node = node.parent
        limit = min(limit, node.density)
    taken = bytearray(len(nodes))
    chosen: list[Node] = []
    for n in nodes[body.begin :]:
        if n.density >= limit and n.chars and not taken[n.begin]:
            top = n if n.best.total == 0 else n.best
            if not taken[top.begin]:
                chosen.append(top)
                # chosen subtrees never overlap: a later one is below no
                # earlier one, and holds none, as that would be its best
                taken[top.begin : top.end] = b"\1" * (top.end - top.begin)
    marked = [n for n in nodes if n.tag in ("article", "main") and n.chars and n.weight == 1.0]
    out = _tops([m for part in _bordered(chosen, marked, limit) for m in part])
    return _with_headline(nodes, out), limit


def _with_headline(nodes: list[Node], chosen: list[Node]) -> list[Node]:
    """The last first-level heading before the chosen nodes, if they have
    none of their own."""
    heads = [n for n in nodes if n.tag == "h1" and n.chars and n.weight == 1.0 and 2 * n.link_chars <= n.chars]
    if not chosen or any(c.begin <= h.begin < c.end for h in heads for c in chosen):
        return chosen
    before = [h for h in heads if h.begin < chosen[0].begin]
    return [*before[-1:], *chosen]


def _bordered(chosen: list[Node], marked: list[Node], limit: float) -> Iterator[list[Node]]:
    """What each chosen node stands for where the page marks its articles."""
    tops = _tops(marked)
    outer = {m.begin: m for m in tops}
    starts = [m.begin for m in tops]
    inner = [m for m in marked if m.tag == "article"]
    for node in chosen:
        at = bisect.bisect_right(starts, node.begin) - 1
        top = outer[starts[at]] if at >= 0 else None
        if top is not None and (top is node or _above(top, node)):
            # the outermost article around it, else the main element
            yield [next((m for m in inner if m is node or _above(m, node)), top)]
            continue
        within = tops[bisect.bisect_left(starts, node.begin) : bisect.bisect_left(starts, node.end)]
        if not within or 2 * sum(m.chars for m in within) < node.chars:
            yield [node]
            continue
        held = {m.begin for m in within}
        over, out, stack = set(), list(within), [node]
        for m in within:
            while m is not node and m.begin not in over:
                over.add(m.begin)
                m = m.parent
        while stack:
            for child in stack.pop().kids():
                if child.begin in held:
                    continue
                if child.begin in over:
                    stack.append(child)
                elif child.density >= limit:
                    out.append(child)
        yield out


def blocks(root: Node, chosen: list[Node], limit: float) -> list[str]:
    """Texts of the blocks below the chosen nodes, in page order, without
    marked subtrees below the threshold."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    ids = {id(n) for n in chosen}
    stack: list = [(root, id(root) in ids)]
    while stack:
        item, on = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            if on:
                line.append(item)
        elif item.tag in ("br", "wbr"):
            line.append(" " if item.tag == "br" else "")
        else:
            on = (on or id(item) in ids) and not (item.low and item.density < limit)
            block = item.tag not in INLINE
            if block:
                end()
                stack.append((None, on))
            stack += [(c, on) for c in reversed(item.children)]
    end()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    prune(root)
    return "\n\n".join(blocks(root, *content_nodes(root)))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", *keep: str) -> DataFrame:
    """page_id, the kept columns and ``text``."""
    ship_package(pages.sparkSession)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield html.map(main_text, na_action=None)

    return pages.select(col(id_col).alias(id_col), *[col(k) for k in keep], text(F.coalesce(col(html_col), F.lit(""))).alias("text"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    out = extract(pages, "page_id", "html", "url")
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
