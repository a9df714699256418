"""Main text of web pages by composite text density (operator 6).

The page becomes a tree; parts that are never main text go first: scripts, styles,
menus, asides, footers, site headers, and nodes whose role, class or id says advert, comment,
share and the like, and forms. A class, id or form is a guess: names of a state (has-sidebar, no-ads, with-toc)
say nothing, nor does the name of a node that holds more than half of the page's text outside
links (unless an article or main lies elsewhere; for comments: and a main or h1), and names that articles use too (notice, related,
search) count only outside the main text that is found. If nothing is left, no name counts. Each remaining node has characters C, tags T, link characters
LC and link tags LT of its subtree, and the composite density

    C / T * log(C / LC * T / LT) / log(ln(C / nLC * LC + LC_body / C_body * C + e))

with nLC = C - LC and zero denominators taken as one. The node whose block-level children's
densities have the largest sum is the main subtree (inline tags count in T, but a phrase in
bold is no main text of its own). The least density on the path from body to it is
the threshold: other nodes of that density or more are searched in the same way. Link
lists in them stay; only if body itself is the main subtree, its own children that are link
lists (four fifths of the characters in three links or more) count as menus and go.

Blocks are runs of text between block-level tags; character references are decoded, white
space inside a block becomes one space, blocks are joined by one line feed. Nothing else is
dropped or capped.

Edge cases: a null or empty page, or one without text, gives an empty text; unclosed and
stray tags are handled as browsers do in the common cases, in linear time however broken or
deep the page is (the rest after a "<" without any ">" is text); repeated rows get equal answers;
an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .scratch import text_batches
from .text import slices

#: A tag with its name and attributes; a quote counts after an equals sign only, and if it is closed.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)>""")
#: The same where no tag ends outside quotes any more.
_SHORT_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_HINTS = frozenset("class id role hidden".split())
#: Tag names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
_DROP = frozenset("script style textarea title noscript template iframe noembed noframes xmp head nav aside footer button select option svg canvas object map dialog menu".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr del".split())
#: A start tag here ends an open paragraph.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A start tag that ends an open one of the same group, up to the nearest container of it.
_SIBLING = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table", "thead", "tbody", "tfoot")), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
#: Words of classes and ids. Of a part that is no main text:
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies gdpr popup modal comment comments respond replies disqus sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs toolbar pagination pager share sharing social recommended newsletter subscribe subscription signup login footer masthead".split()
)
#: that articles have too,
_WEAK_NAMES = frozenset("alert banner consent notice notices overlay related search side skip toc widget".split())
#: of readers' texts, which may be longer than the main text,
_READERS = frozenset("comment comments respond replies disqus".split())
#: and of a state of what lies around or beside.
_STATES = frozenset("has have no non not with without open closed enabled disabled".split())
_WORD = re.compile(r"[^\W\d_]+")
_LANDMARK = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())


#: Kinds of ``Node.drop``: a name that counts outside the main text, a name, a name of readers' texts, a part that always goes.
_WEAK, _NAMED, _READ, _GONE = 1, 2, 3, 4


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "plain", "heads", "articles", "chars", "tags", "link_chars", "link_tags", "density", "sum", "best", "above")

    def __init__(self, tag: str, parent: Node | None, drop: int):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.children: list[Node | str] = []


def _named(value: str) -> int:
    """What a class or id says of its node."""
    found = 0
    for token in value.lower().split():
        parts = {m[0] for m in map(_WORD.match, re.split("[-_]", token)) if m}
        if parts & _STATES:
            continue
        if parts & _NAMES:
            found = max(found, _READ if parts & _READERS else _NAMED)
        elif parts & _WEAK_NAMES:
            found = max(found, _WEAK)
    return found


def _dropped(tag: str, attributes: str, in_article: bool) -> int:
    if tag in _DROP or (tag == "header" and not in_article):
        return _GONE
    found = _NAMED if tag == "form" else 0
    if not attributes or tag in ("body", "html", "article", "main"):
        return found
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name not in _HINTS:
            continue
        if name == "hidden" or (name == "role" and value.lower() in _LANDMARK):
            return _GONE
        if name in ("class", "id"):
            found = max(found, _named(value))
    return found


#: What an end tag of an inline element does not reach beyond.
_INLINE_ENDS = ("p", "td", "th", "li", "div", "article", "section", "body")
_P_ENDS = ("div", "td", "th", "li", "article", "section", "body", "blockquote")


class _Path:
    """The open nodes. Whether a name is open below some others is known without a walk, so parsing takes linear time."""

    def __init__(self, root: Node):
        self.nodes, self.depths = [root], {}

    def open(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def is_open(self, tag: str) -> bool:
        return bool(self.depths.get(tag))

    def depth(self, tags: tuple[str, ...]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def close(self, names: tuple[str, ...], until: tuple[str, ...] = ()) -> None:
        """Close the innermost node of these names, unless one of ``until`` was opened in it."""
        at = self.depth(names)
        if at > self.depth(until):
            for node in self.nodes[at:]:
                self.depths[node.tag].pop()
            del self.nodes[at:]


def parse(html: str) -> Node:
    """The tree of a page, with what speaks for dropping a node."""
    root = Node("#root", None, 0)
    path, tags = _Path(root), _TAG
    at, look, end = 0, 0, len(html)  # text from at on is not in the tree yet, look is where the next tag is looked for
    while (lt := html.find("<", look)) >= 0:
        after = html[lt + 1 : lt + 2]
        m = None
        if html.startswith("<!--", lt):
            stop = html.find("-->", lt + 4)
            look = stop + 3 if stop >= 0 else end
        elif after in ("!", "?"):
            stop = html.find(">", lt)
            if stop < 0:
                break
            look = stop + 1
        else:
            if after == "/" or after.isalpha():
                m = tags.match(html, lt)
                if m is None and tags is _TAG:
                    tags = _SHORT_TAG
                    m = tags.match(html, lt)
                if m is None and html.find(">", lt) < 0:
                    break
            if m is None:
                look = lt + 1
                continue
            look = m.end()
        if lt > at:
            path.nodes[-1].children.append(html[at:lt])
        at = look
        if m is None:
            continue
        tag = m[2].lower()
        if m[1]:
            path.close((tag,), () if tag == "p" or tag not in _INLINE else ("td", "body") if tag == "a" else _INLINE_ENDS)
            continue
        if tag in _RAW and not m[3].endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            close = html.find(">", stop.start()) if stop else -1
            at = look = close + 1 if close >= 0 else end
            continue
        if tag in _ENDS_P:
            path.close(("p",), _P_ENDS)
        if tag in _SIBLING:
            path.close(*_SIBLING[tag])
        node = Node(tag, path.nodes[-1], _dropped(tag, m[3], path.is_open("article") or path.is_open("main")))
        path.nodes[-1].children.append(node)
        if tag not in _VOID and not m[3].endswith("/"):
            path.open(node)
    if at < end:
        path.nodes[-1].children.append(html[at:])
    return root


def _kept(node: Node) -> list[Node]:
    return [c for c in node.children if not isinstance(c, str) and not c.drop]


def _judge_names(root: Node, named: bool) -> None:
    """Clears the names of nodes that hold most of the page's text outside links; all of them, if not ``named``."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        node.children = [c for c in node.children if isinstance(c, str) or c.drop != _GONE]
        stack.extend(c for c in node.children if not isinstance(c, str))
    if not any(node.drop for node in order):
        return
    for node in reversed(order):
        node.plain, node.heads, node.articles = 0, node.tag in ("h1", "main"), 0
        for c in node.children:
            if isinstance(c, str):
                node.plain += len(" ".join(c.split()))
            else:
                node.plain += c.plain
                node.heads = node.heads or c.heads
                node.articles += c.articles
        if node.tag == "a":
            node.plain = 0
        if node.tag in ("article", "main") and node.plain:
            node.articles += 1
    for node in order:
        node.above = node.parent.above + (node.parent.tag in ("article", "main") and node.parent.plain > 0) if node.parent else 0
        if node.drop and (not named or (2 * node.plain > root.plain and (node.drop != _READ or node.heads) and (node.articles or root.articles <= node.above))):
            node.drop = 0


def _measure(root: Node) -> list[Node]:
    """Counts of each node that stays, children before parents; returns them parents first."""
    order = _under(root)
    for node in reversed(order):
        chars = tags = link_chars = link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                chars += len(" ".join(c.split()))
            elif not c.drop:
                chars += c.chars
                tags += c.tags + 1
                link_chars += c.link_chars
                link_tags += c.link_tags + (c.tag == "a")
        if node.tag == "a":
            link_chars = chars
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    return order


def _densities(order: list[Node], body: Node) -> None:
    whole = body.link_chars / (body.chars or 1)
    for node in order:
        c, t, lc, lt = node.chars, node.tags or 1, node.link_chars, node.link_tags or 1
        if not c:
            node.density = 0.0
            continue
        base = math.log(c / (c - lc or 1) * lc + whole * c + math.e)
        node.density = c / t * math.log(max(c / (lc or 1) * t / lt, 1.0)) / math.log(base) if base > 1.0 + 1e-12 else c / t * math.log(max(c / (lc or 1) * t / lt, 1.0))
    for node in reversed(order):
        kept = _kept(node)
        node.sum, node.best = sum(c.density for c in kept if c.tag not in _INLINE), node
        for c in reversed(kept):
            if c.best.sum > node.best.sum:
                node.best = c.best


def main_nodes(root: Node) -> set[Node]:
    """The nodes whose text is the main text."""
    order = _measure(root)
    body = next((n for n in order if n.tag == "body"), root)
    order = _under(body)
    _densities(order, body)
    best = body.best
    threshold, node = best.density, best
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    chosen, stack = {best}, _kept(body)
    while stack:
        node = stack.pop()
        if node in chosen or node.density < threshold or not node.chars:
            continue
        chosen.add(node.best)
        stack.extend(_kept(node))
    return chosen


def _under(node: Node) -> list[Node]:
    order, stack = [], [node]
    while stack:
        x = stack.pop()
        order.append(x)
        stack.extend(reversed(_kept(x)))
    return order


def main_text(html: str) -> str:
    return _text(html, True) or _text(html, False)


def _text(html: str, named: bool) -> str:
    root = parse(html)
    _judge_names(root, named)
    chosen = main_nodes(root)
    blocks: list[list[str]] = [[]]
    # (node, is it inside a chosen one: 1 for body, 2 for another); None ends a block
    stack: list[tuple[Node | str | None, int]] = [(root, 0)]
    while stack:
        node, inside = stack.pop()
        if node is None:
            if blocks[-1]:
                blocks.append([])
        elif isinstance(node, str):
            if inside:
                blocks[-1].append(node)
        else:
            if node in chosen:
                inside = 1 if node.tag in ("body", "#root") else 2
            elif node.drop > _WEAK or (node.drop and inside < 2):
                continue
            elif inside == 1 and node.parent.tag in ("body", "#root") and node.tag in ("ul", "ol", "div", "table", "section", "dl") and node.link_tags >= 3 and 5 * node.link_chars >= 4 * node.chars:
                continue
            block = node.tag not in _INLINE
            if block:
                stack.append((None, inside))
            elif node.tag == "br" and inside:
                blocks[-1].append(" ")
            stack.extend((c, inside) for c in reversed(node.children))
            if block:
                stack.append((None, inside))
    lines = (" ".join(unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, id: str = "page_id", html: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """``id``, ``carry`` columns, text and n_chars of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_html"):
                texts = [main_text(x or "") for x in batch.column(len(out.fields) - 2).to_pylist()]
                own = [batch.column(i) for i in range(len(out.fields) - 2)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=out.fieldNames())

    text_batches(pages.sparkSession)
    given = pages.select(id, *carry, pages[html].alias("_html"))
    out = StructType(pages.select(id, *carry).schema.fields + StructType.fromDDL("text string, n_chars long").fields)
    return given.mapInArrow(run, out)
