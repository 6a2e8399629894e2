"""Main text of web pages by composite text density.

The page becomes a tree of blocks.  For every node the density is its characters per tag,
lowered for characters that stand in links: with C characters and T tags below a node, LC and
LT of them in links, and LCb and Cb those of the whole body,

    density = C / T * log(C / LC * T / LT, base = ln(C / nLC * LC + LCb / Cb * C + e))

where nLC = C - LC and zero counts are taken as 1.  A node's sum is that of the densities of
its children.  The node with the largest sum is the seed, and the least density on the path
from the body to it is the threshold.  The text is that of the article around the seed; where
the page marks none, it is that of the seed and of the nodes beside its path that reach the
threshold.  What the page itself marks as something else counts nowhere: menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and styles.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicpulse.llm.common import map_rows

# How elements behave.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set(
    "script style noscript template svg canvas iframe object embed audio video map head title "
    "nav footer aside form button select textarea input label fieldset dialog menu annotation "
    "annotation-xml".split()
)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr br img "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup mover munder munderover mtable "
    "mtr mtd mstyle mpadded mphantom menclose merror mspace mmultiscripts semantics".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_BLOCK = {"p"}
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer "
    "sidebar aside widget cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe subscription signup login comment comments disqus respond replies reply share "
    "sharing social related recommended recommendations pagination pager toolbar skip".split()
)
ASIDE_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu "
    "menubar toolbar".split()
)
_PARTS = re.compile(r"[A-Za-z][a-z]+|[A-Z]+|[a-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Node:
    __slots__ = ("tag", "parent", "children", "aside", "by_name", "chars", "tags",
                 "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", aside: bool = False, by_name=False):
        self.tag, self.parent, self.aside, self.by_name = tag, parent, aside or by_name, by_name
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _hidden(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether the page marks an element as no part of its text."""
    if tag in SKIPPED or (tag == "header" and not in_article):
        return True
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value and value.strip().lower() in ASIDE_ROLES:
            return True
        if name == "style" and value and _UNSEEN.search(value):
            return True
    return False


def _named_aside(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether class or id name a menu, an advert, comments and the like.

    A heading is never hidden by its name; a section or paragraph, and what stands inside an
    article, only by a whole name and not by a part of one.
    """
    if tag in ("main", "article") or tag in HEADINGS:
        return False
    split = str.split if in_article or tag in ("section", "p") else _PARTS.findall
    return any(
        word.lower() in ASIDE_WORDS
        for name, value in attrs
        if value and name in ("class", "id")
        for word in split(value)
    )


class TreeBuilder(HTMLParser):
    """A tree out of any markup: open paragraphs and items are closed by what follows them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None)
        self.open = [self.root]

    def _close(self, tags: set[str], scopes: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at].tag
            if tag in tags:
                del self.open[at:]
                return
            if tag in scopes or (tag not in INLINE and tag not in tags):
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("html", "body"):
            return
        if tag not in INLINE:
            self._close(CLOSED_BY_BLOCK, set())
            if tag in SELF_CLOSING:
                self._close(SELF_CLOSING[tag], SCOPES[tag])
        parent = self.open[-1]
        in_article = any(n.tag in ("article", "main") for n in self.open)
        named = bool(attrs) and _named_aside(tag, attrs, in_article)
        node = Node(tag, parent, _hidden(tag, attrs, in_article), named)
        parent.children.append(node)
        if tag in ("article", "main") and not named:
            for outer in self.open:  # a name doesn't hide what holds an article
                if outer.by_name and not any(w in outer.tag for w in ("li", "section")):
                    outer.by_name = outer.aside = False
        if tag not in VOID and len(self.open) < 500:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and tag not in ("html", "body"):
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def _parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def _in_order(root: Node) -> list[Node]:
    """All nodes that aren't aside, parents first."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.aside)
    return nodes


def _measure(nodes: list[Node]) -> None:
    linked = set()
    for node in nodes:  # parents first
        if node.tag == "a" or node.parent in linked:
            linked.add(node)
    for node in reversed(nodes):  # children first
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += own
        if node in linked:
            node.link_chars += own
        parent = node.parent
        if parent is not None:
            parent.chars += node.chars
            parent.link_chars += node.link_chars
            parent.tags += node.tags + 1
            parent.link_tags += node.link_tags + (node in linked)
    body = nodes[0]
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        chars, tags = node.chars, max(node.tags, 1)
        if not chars:
            continue
        link_chars, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
        other = max(chars - node.link_chars, 1)
        base = log(chars / other * link_chars + share * chars + e)
        value = log(chars / link_chars * tags / link_tags) / log(base)
        node.density = max(chars / tags * value, 0.0)
    for node in nodes:
        node.total = sum(
            c.density for c in node.children if isinstance(c, Node) and not c.aside
        )


def _container(root: Node, nodes: list[Node]) -> tuple[Node, float, set[Node]]:
    """Where the text is, the threshold, and the path from the body to the seed."""
    seed = max(nodes, key=lambda n: n.total)  # the first of equals
    path, node = [], seed
    while node is not None:
        path.append(node)
        node = node.parent
    threshold = min(n.density for n in path)
    for node in path:
        if node.tag in ("article", "main"):
            return node, 0.0, set(path)
    return root, threshold, set(path)


def _blocks(node: Node, threshold: float, path: set[Node], seed_inside: bool) -> list[str]:
    """The blocks of text below a node in page order."""
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            blocks.append(text)

    # Entries: (node, whole) to enter, or None to end a block.
    stack: list[tuple[Node | str | None, bool]] = [(node, not seed_inside)]
    while stack:
        item, whole = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if whole:
                held.append(item)
        elif item.aside:
            if item.tag not in INLINE:
                flush()
        elif item.tag in ("br", "wbr"):
            held.append(" " if item.tag == "br" else "")
        else:
            on_path = item in path
            last = on_path and not any(isinstance(c, Node) and c in path for c in item.children)
            heading = item.tag in HEADINGS and item.link_chars == 0
            take = whole or last or heading or (not on_path and item.density >= threshold > 0)
            if not take and not on_path:
                continue
            block = item.tag not in INLINE
            if block:
                flush()
                stack.append((None, whole))
            stack.extend((c, take) for c in reversed(item.children))
    flush()
    return blocks


def main_text(html: str | None) -> str:
    """The main text of a page, one line per block."""
    if not html:
        return ""
    root = _parse(html)
    nodes = _in_order(root)
    _measure(nodes)
    container, threshold, path = _container(root, nodes)
    return "\n".join(_blocks(container, threshold, path, container is root))


def extract(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url"
) -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page.

    A null or empty page, and one without text, has the empty text.  Other columns are not
    looked at, repeated rows come out repeatedly.
    """

    def make() -> Callable[[pa.RecordBatch], dict]:
        def apply(batch: pa.RecordBatch) -> dict:
            texts = [main_text(v.as_py()) for v in batch.column(2)]
            return {
                id_col: batch.column(0),
                url_col: batch.column(1),
                "text": texts,
                "n_chars": [len(t) for t in texts],
            }

        return apply

    frame = pages.select(
        F.col(id_col), F.col(url_col).cast("string"), F.col(html_col).cast("string").alias("_html")
    )
    kind = frame.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars bigint"
    return map_rows(frame, make, schema, "_html")
