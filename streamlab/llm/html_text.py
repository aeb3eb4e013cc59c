"""Main text of web pages by composite text density.

Every DOM node has a density: its characters per tag, adjusted by how much of its text lies in links.
Densities of a node's children are summed, and the subtree with the largest sum holds the article. The
smallest density on the path from it to the body is the threshold by which other subtrees are judged.

Tags, roles, class names and ids only hint that an element is a menu, a notice, an advert, a form, comments or
the like. Hints are judged once the whole page is measured: a believed one sets the density of its subtree to
zero; one that holds the larger part of the article, or of the unlinked text of a page without one, is not
believed. Every ``article`` or ``main`` that is left stays whole.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.arrow import text_chunks

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Text up to the end tag is not markup.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Tags that do not end a block of text.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Tags whose text is never shown as running text.
DROPPED = set(
    "script style noscript template iframe textarea title head button select option input object svg canvas audio video map "
    "noembed noframes".split()
)
#: Tags and roles that hint at what is not the article; so does a header outside of one.
ASIDE_TAGS = set("nav footer aside form dialog menu menuitem".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class names and ids that hint at reader comments, and at anything else that is not the article.
COMMENT_NAMES = set("comment comments commentlist disqus respond reply replies".split())
NAMES = COMMENT_NAMES | set(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer foot sidebar aside ad ads advert adverts advertisement "
    "advertising adsense adsbygoogle banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup signin login paywall discussion share "
    "sharing social related recommended recommendations teaser widget pagination pager toolbar copyright search skip form tags".split()
)
HEADER_NAMES = {"header", "topbar", "masthead"}
#: Words beside them that change nothing; with any other word a name says something else (has-sidebar, related-work).
NEUTRAL = set(
    "site global page main top bottom left right primary secondary inner outer box list block area section container wrap wrapper "
    "thread link links post posts article articles entry bar unit slot item items body content text meta author count title google "
    "mobile desktop sticky fixed icons buttons".split()
)
#: Names that are also headings of articles, from which their ids are made.
TOPICS = set("discussion notice notices alert search social related share sharing copyright form tags reply replies recommendations consent advertising".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE = {"article", "main"}
HINT, COMMENT_HINT = 1, 2
#: An open element of the first kind is ended by a start tag of the second.
IMPLIED_END = {
    "p": set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"},
}
#: Where the search for an element to end stops.
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
BLOCK_SCOPE = {"table", "td", "th", "button", "object"}


class Node:
    __slots__ = ("tag", "parent", "dropped", "linked", "hint", "article", "within", "out", "chars", "tags", "link_chars", "link_tags", "told", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, hint: int = 0, article: bool = False):
        self.tag, self.parent, self.dropped, self.hint = tag, parent, dropped, hint
        self.linked = tag == "a" or parent is not None and parent.linked
        #: An article that is not a reader's comment, and whether the node lies in one.
        in_comment = hint == COMMENT_HINT or parent is not None and parent.within < 0
        self.article = article and not in_comment
        self.within = -1 if in_comment else int(self.article or parent is not None and parent.within > 0)
        self.out = False
        self.chars = self.tags = self.link_chars = self.link_tags = self.told = 0
        self.density = self.sum = 0.0


class Page:
    """Nodes in page order, and the blocks of text: the node that holds each, and its pieces with their nodes."""

    def __init__(self, html: str):
        self.root = Node("html", None)
        self.nodes = [self.root]
        self.open = [self.root]
        #: Places of open elements by tag, and of those that hold blocks; the last is the innermost.
        self.places: dict[str, list[int]] = {}
        self.holders = [0]
        self.body: Node | None = None
        self.blocks: list[tuple[Node, list[tuple[Node, str]]]] = []
        self.pending: list[tuple[Node, str]] = []
        self._parse(html)

    # -- building the tree

    def _parse(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            m = TOKEN.search(html, at)
            if m is None:
                self._text(html[at:])
                break
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            tag = (m[1] or m[3] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"), decode=False)
                continue
            if m[0][1] == "/":
                self._end(tag)
                continue
            attributes = m[2] if m[1] else m[4]
            self._start(tag, attributes or "")
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = close.end() if close else end
                self._end(tag)
        self._flush()

    def _text(self, text: str, decode: bool = True) -> None:
        node = self.open[-1]
        if node.dropped:
            return
        text = entities.unescape(text) if decode and "&" in text else text
        self.pending.append((node, text))
        size = len("".join(text.split()))
        node.chars += size
        if node.linked:
            node.link_chars += size

    def _flush(self) -> None:
        if self.pending:
            self.blocks.append((self.open[self.holders[-1]], self.pending))
            self.pending = []

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._flush()
            self.open[-1].tags += not self.open[-1].dropped
            return
        if tag == "body" or tag == "html":
            if len(self.open) > 1 and self.open[1].tag == "head":
                self._close(1)
            if tag == "html" or self.body is not None:
                return
        for kind, enders in IMPLIED_END.items():
            if tag in enders:
                self._end_implied(kind)
        if tag not in INLINE:
            self._flush()
        parent = self.open[-1]
        if parent.dropped or tag in DROPPED:
            node = Node(tag, parent, dropped=True)
        else:
            hint, article = hints(tag, attributes, parent.within > 0)
            node = Node(tag, parent, hint=hint, article=article)
            node.tags = 1
            node.link_tags = int(tag == "a")
        if tag == "body":
            self.body = node
        self.nodes.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            if tag not in INLINE:
                self.holders.append(len(self.open))
            self.open.append(node)

    def _innermost(self, tag: str) -> int:
        found = self.places.get(tag)
        return found[-1] if found else 0

    def _end_implied(self, tag: str) -> None:
        i = self._innermost(tag)
        if i and i > max(map(self._innermost, SCOPE.get(tag, BLOCK_SCOPE))):
            self._close(i)

    def _end(self, tag: str) -> None:
        i = self._innermost(tag)
        # The end of an inline element that another block opened ends nothing.
        if i and (tag not in INLINE or i > self.holders[-1]):
            self._close(i)

    def _close(self, i: int) -> None:
        if self.holders[-1] >= i:
            self._flush()
        for node in reversed(self.open[i:]):
            self.places[node.tag].pop()
        del self.open[i:]
        while self.holders[-1] >= i:
            self.holders.pop()

    # -- densities

    def _add_up(self, names: tuple[str, ...]) -> None:
        for node in reversed(self.nodes):  # children come after their parents
            if node.parent is not None and not node.out:
                for name in names:
                    setattr(node.parent, name, getattr(node.parent, name) + getattr(node, name))

    def judge(self) -> None:
        """Leaves out the subtrees whose hints are believed.

        ``told`` is the unlinked text that speaks against a hint: of the articles, else of ``main``, else of the page.
        """
        counted = [n for n in self.nodes if n.article]
        counted = [n for n in counted if n.tag == "article"] or counted
        own = [(n, n.chars - n.link_chars) for n in self.nodes]
        if counted:
            inside: set[int] = {id(n) for n in counted}
            for node in self.nodes:
                if node.parent is not None and id(node.parent) in inside and node.within > 0:
                    inside.add(id(node))
            if any(size for n, size in own if id(n) in inside):
                own = [(n, size) for n, size in own if id(n) in inside]
        for node, size in own:
            node.told = size
        self._add_up(("told",))
        total = self.root.told
        for node in self.nodes:
            if node.parent is not None and node.parent.out:
                node.out = True
            elif node.hint == COMMENT_HINT:
                node.out = node.told < total
            elif node.hint == HINT:
                node.out = 2 * node.told < total
            node.out |= node.dropped

    def measure(self) -> Node:
        """Sums over what is left of the subtrees, then densities; returns the body, or the root if there is none."""
        self.judge()
        self._add_up(("chars", "tags", "link_chars", "link_tags"))
        body = self.body or self.root
        link_share = body.link_chars / max(body.chars, 1)
        for node in self.nodes:
            if not node.out:
                node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, link_share)
        for node in self.nodes:
            if node.parent is not None and not node.out and node.tag not in INLINE:
                node.parent.sum += node.density
        return body

    def main_blocks(self) -> list[str]:
        """Blocks of the subtree with the largest sum, of subtrees as dense as its path, and of articles."""
        body = self.measure()
        inner = [n for n in self.nodes if not n.out and n.tag not in INLINE and n.chars]
        if not inner:
            return []
        best = max(inner, key=lambda n: n.sum)  # the first of equals
        path = [best]
        while path[-1].parent is not None and path[-1] is not body:
            path.append(path[-1].parent)
        threshold = min(n.density for n in path)
        above = {id(n) for n in path} | {id(body), id(self.root)}
        chosen = {id(best)} | {id(n) for n in inner if n.article or n.density >= threshold and id(n) not in above}
        kept: dict[int, bool] = {}
        for node in self.nodes:
            kept[id(node)] = not node.out and (id(node) in chosen or node.parent is not None and kept[id(node.parent)])
        texts = (" ".join("".join(t for n, t in pieces if not n.out).split()) for holder, pieces in self.blocks if kept[id(holder)])
        return [text for text in texts if text]


def hints(tag: str, attributes: str, within: bool) -> tuple[int, bool]:
    """What an element's tag and attributes say of it: a kind of hint, and whether it is an article."""
    article = tag in ARTICLE
    if tag == "body":
        return 0, False
    hint = HINT if tag in ASIDE_TAGS or tag == "header" and not within else 0
    if not attributes.strip():
        return hint, article
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role":
            article |= value.lower() in ARTICLE
            hint = hint or HINT * (value.lower() in ROLES)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hint = hint or HINT
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hint = hint or HINT
        elif name in ("class", "id") and tag not in HEADINGS:
            for token in value.split():
                words = {w for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) if len(w) > 1}
                named = words & NAMES - TOPICS if name == "id" else words & NAMES
                if not within:
                    named |= words & HEADER_NAMES
                if named and words <= named | NEUTRAL:
                    hint = COMMENT_HINT if named & COMMENT_NAMES else hint or HINT
    if article and hint != COMMENT_HINT:
        hint = 0
    return hint, article


def density(chars: int, tags: int, link_chars: int, link_tags: int, link_share: float) -> float:
    """Characters per tag, times a logarithm to a base that grows with the linked text.

    Counts of zero are taken as one. The base, itself a logarithm, is taken as e where it is smaller (pages
    without links would have the base one).
    """
    if not chars:
        return 0.0
    plain = max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + link_share * chars + math.e)
    ratio = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
    return chars / max(tags, 1) * math.log(max(ratio, 1.0)) / math.log(max(base, math.e))


def main_text(html: str) -> str:
    """The article's blocks joined by line feeds; empty if there is none."""
    return "\n".join(Page(html).main_blocks())


def extract_text(df: DataFrame, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """(id columns, text) of every whole page.

    A null page is empty and has an empty text. Every row is taken by itself, so ids may be null or
    repeated. Other columns are left out. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in text_chunks(batches, "_html"):
            texts = [main_text(h) if h else "" for h in rows.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in id_cols), pa.array(texts, pa.string())], [*id_cols, "text"])

    picked = df.select(*id_cols, F.col(html_col).alias("_html"))
    schema = df.select(*id_cols).withColumn("text", F.lit("")).schema
    return picked.mapInArrow(run, schema)


def op2_html(pages: DataFrame) -> DataFrame:
    return extract_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
