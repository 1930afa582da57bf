"""Main text of web pages by site style trees.

The DOM trees of a host's pages are merged: nodes with the same path of elements are one node of the
site style tree. A node's importance is the entropy of its presentations (the sequences of its child
elements) and of its contents over the pages that have it: what looks and reads the same everywhere
is of no importance. A content that many pages show at one node is of as little importance by itself,
whatever else stands at that node. Elements that are page furniture by their kind or class are
presentations of importance 0. Branches outside the article of a page that has one count half.
A page's text is that of its branches of importance above a threshold.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.operators.balance import small_enough, written

#: Nodes seen on fewer pages are judged by their kind alone.
LEAST_PAGES = 8
#: Importance below which a node's branch goes.
LEAST_IMPORTANCE = 0.25
#: Importance counts this much outside the article of a page that has one.
OUTSIDE_WEIGHT = 0.5
#: Removed nodes of all sites that are broadcast, at most; more are joined by host.
BROADCAST_ROWS = 1_000_000

#: Elements by what they are (fixed values).
RAW = frozenset("script style template noscript iframe object svg math canvas title".split())
FURNITURE = frozenset("head nav footer aside form button select textarea input dialog menu fieldset".split())
#: Places of nodes that are not below an article.
OUTSIDE, ABOVE, NO_ARTICLE = 0, 1, 2
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body head center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
ARTICLE = frozenset(("article", "main"))
#: Classes, ids and roles that name page furniture, as whole tokens (fixed values).
FURNITURE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager sidebar aside widget footer header masthead comment comments reply replies disqus "
    "share sharing social related recommended toolbar search skip complementary contentinfo".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    """An open element: its label, the path hash from the root, and what it holds."""

    tag: str
    path: int
    #: furniture by element, or hidden; holds for all below
    kind: bool
    #: furniture by name, unless an article or a page heading turns up below
    named: bool = False
    up: Node | None = None
    #: outermost article or main at or above this node
    article: Node | None = None
    #: an article stands at or below this node
    holds: bool = False
    children: list[str] = field(default_factory=list)
    content: int = 0

    @property
    def furniture(self) -> bool:
        """Known once the page is read; names do not count above a heading."""
        n: Node | None = self
        named = False
        while n is not None and n.tag not in HEADINGS and not named:
            named, n = n.named, n.up
        return self.kind or named


def _mixed(a: int, b: str) -> int:
    h = a
    for c in b.encode():
        h = ((h ^ c) * 0x100000001B3) & 0x7FFFFFFFFFFFFFFF
    return h


_paths: dict[tuple[int, str], int] = {}


def _path(parent: int, label: str) -> int:
    got = _paths.get((parent, label))
    if got is None:
        if len(_paths) > 1 << 16:
            _paths.clear()
        got = _paths[parent, label] = _mixed(_mixed(parent, ">"), label)
    return got


class Page(HTMLParser):
    """Blocks of text of a page with the nodes above them, and a summary of each node."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.stack: list[Node] = [Node("", 0xCBF29CE484222325 >> 1, False)]
        self.raw: str | None = None
        self.parts: list[str] = []
        #: (text, node it stands in)
        self.blocks: list[tuple[str, Node]] = []
        self.closed: list[Node] = []
        self.feed(html)
        self.close()
        while len(self.stack) > 1:
            self._leave()
        self._flush()

    def _flush(self) -> None:
        if not self.parts:
            return
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        self.parts = []
        if text:
            value = hash_text(text)
            for node in self.stack:
                node.content = (node.content * 31 + value) & 0x7FFFFFFFFFFFFFFF
            self.blocks.append((text, self.stack[-1]))

    def _leave(self) -> None:
        node = self.stack[-1]
        if node.tag in BLOCKS:
            self._flush()
        self.stack.pop()
        if node.tag in BLOCKS and not node.kind:
            self.closed.append(node)

    def nodes(self) -> list[tuple[int, int, int, int, int]]:
        """(path, presentation, content, place, first) of the distinct elements outside furniture.

        ``place`` is ABOVE for articles and what holds them, OUTSIDE for other branches of a page with an
        article, NO_ARTICLE on a page without one, and below an article a value of that article's content.
        ``first`` is 1 for one element of each path.
        """
        none = not any(n.holds for n in self.closed)
        found, paths, out = set(), set(), []
        for n in self.closed:
            if n.furniture:
                continue
            if n.article is not None and n.article is not n:
                place = n.article.content | 4
            else:
                place = ABOVE if n.holds else NO_ARTICLE if none else OUTSIDE
            row = (n.path, hash_text(" ".join(n.children)), n.content, place)
            if row not in found:
                found.add(row)
                out.append((*row, int(n.path not in paths)))
                paths.add(n.path)
        return out

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.raw:
            return
        if tag in RAW:
            self.raw = tag
            return
        if tag == "br":
            self.parts.append(" ")
            return
        if tag == "body":
            self._close("head", ())
        if tag in BLOCKS:
            self._flush()
            if tag in CLOSES_P:
                self._close("p", ("article", "body", "div", "li", "section", "td", "th"))
            if tag == "li":
                self._close("li", ("ul", "ol", "menu"))
        names = [v for k, v in attrs if k in ("class", "id", "role") and v]
        label = tag + "".join(f".{n}" for n in sorted({w for v in names for w in v.lower().split()}))
        words = {w for v in names for w in v.lower().split()}
        inside = self.stack[-1].article is not None
        kind = (tag in FURNITURE or (tag == "header" and not inside)
                or any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs))
        named = bool(words & FURNITURE_NAMES)
        if tag in ("body", "html", "article", "main"):
            kind = tag == "article" and bool(words & {"comment", "comments", "reply", "replies"})
            named = False
        self.stack[-1].children.append(label)
        if tag not in VOID:
            parent = self.stack[-1]
            node = Node(tag, _path(parent.path, label), kind or parent.kind, named, parent, parent.article)
            if tag in ARTICLE and not node.kind:
                node.article = node.article or node
                for n in (*self.stack, node):
                    n.holds, n.named = True, False
            elif tag == "h1" and not node.kind:
                for n in self.stack:
                    n.named = False
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not close an HTML element

    def _close(self, tag: str, scope: tuple[str, ...]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self._leave()
                return
            if self.stack[i].tag in scope:
                return

    def handle_endtag(self, tag: str) -> None:
        if self.raw:
            if tag == self.raw:
                self.raw = None
            return
        if tag in BLOCKS:
            self._flush()
        if any(n.tag == tag for n in self.stack[1:]):
            while True:
                found = self.stack[-1].tag == tag
                self._leave()
                if found:
                    return

    def handle_data(self, data: str) -> None:
        if not self.raw:
            self.parts.append(data)


def hash_text(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) << 31 ^ zlib.crc32(data[::-1])


def host_of(url: str) -> Column:
    """Lower-case host of a URL; empty if it has none."""
    host = F.regexp_extract(F.col(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def style_rows(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, path, presentation, content, place, first``: a row for each node of each page outside page furniture."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if html:
                    out += [(host, *n) for n in Page(html).nodes()]
            columns = list(zip(*out)) or [[], [], [], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["host", "path", "presentation", "content", "place", "first"])

    return pages.select(host_of(url_col).alias("host"), html_col).mapInArrow(
        nodes, "host string, path bigint, presentation bigint, content bigint, place bigint, first bigint")


def site_rules(pages: DataFrame, url_col: str = "url", html_col: str = "html", least: float = LEAST_IMPORTANCE) -> DataFrame:
    """``host, rule, id``: what the merged trees say about nodes that stand on enough pages.

    ``removed`` are paths of less importance than ``least``, and below articles also contents of a path
    (path XOR content) that over half of its articles have; ``likely`` are contents whose importance,
    1 - log(k) / log(m) for k of m articles, is too low, on fewer articles; ``kept`` are paths outside
    articles that are important enough there. Below articles each article counts once, however many
    pages repeat it. Equal rows are counted before the shuffle, so a host with a third of all pages is
    no hot spot.
    """
    below = F.col("place") > NO_ARTICLE
    rows = style_rows(pages, url_col, html_col).groupBy("host", "path", "presentation", "content", "place").agg(
        F.count("*").alias("pages"), F.sum("first").alias("firsts")).select(
        "host", "path", "presentation", "content", (F.col("place") == OUTSIDE).alias("outside"), below.alias("below"),
        F.when(below, 1).otherwise(F.col("pages")).alias("c"),
        F.when(below, F.least("firsts", F.lit(1))).otherwise(F.col("firsts")).alias("m"))
    rows = written(rows, "styles")  # read four times below, so pages are parsed once for all rules
    totals = F.sum("c").alias("c"), F.sum("m").alias("m"), F.max("outside").alias("outside"), F.max("below").alias("below")
    presentation = rows.groupBy("host", "path", "presentation").agg(*totals)
    content = rows.groupBy("host", "path", "content").agg(*totals)

    def entropy(each: DataFrame, name: str) -> DataFrame:
        total = each.groupBy("host", "path").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log2("c")).alias("s"),
                                                 F.sum("m").alias("m"), F.max("outside").alias("outside"))
        share = (F.log2("n") - F.col("s") / F.col("n")) / F.log2("n")
        return total.where(F.col("n") >= LEAST_PAGES).select("host", "path", "n", "m", "outside", share.alias(name))

    shown = entropy(content, "c")
    importance = F.greatest("p", "c")
    paths = entropy(presentation, "p").select("host", "path", "p").join(shown, ["host", "path"]).select(
        "host", F.when(importance < least, "removed").when(
            F.col("outside") & (importance * OUTSIDE_WEIGHT >= least), "kept").alias("rule"), F.col("path").alias("id"))
    common = content.where(F.col("below") & (F.col("content") != 0) & (F.col("c") > 1)).select(
        "host", "path", "content", F.col("c").alias("k"))
    contents = common.join(shown.where(F.col("m") >= LEAST_PAGES).select("host", "path", "m"), ["host", "path"]).where(
        1 - F.log2("k") / F.log2("m") < least).select(
        "host", F.when(F.col("k") * 2 > F.col("m"), "removed").otherwise("likely").alias("rule"),
        F.col("path").bitwiseXOR(F.col("content")).alias("id"))
    return paths.where("rule is not null").union(contents)


NOTHING: frozenset = frozenset()


def main_text(html: str | None, removed: frozenset | set, likely: frozenset | set = NOTHING,
              kept: frozenset | set = NOTHING) -> str:
    """Text of the branches that stay.

    On a page with an article these are those below the article, and others only if ``kept`` names them.
    Contents that are ``likely`` removed go if at least half of the article stays: else it is one of
    several near copies and not full of notices. An article never goes as a whole.
    """
    if not html:
        return ""
    found = []  # text, below an article, fate: 0 stays, 1 likely goes, 2 goes
    for text, node in Page(html).blocks:
        if node.furniture:
            continue
        fate, n, article = 0, node, node.article
        block = None
        while n is not None and n is not article:
            if block is None and n.tag in BLOCKS:
                block = n.path
            if n.path in removed or (article is not None and n.path ^ n.content in removed):
                fate = 2
                break
            if article is not None and n.path ^ n.content in likely:
                fate = 1
            n = n.up
        found.append((text, article is not None, fate, block))
    articles = any(article for _, article, _, _ in found)
    inside = [(len(text), fate) for text, article, fate, _ in found if article]
    left = sum(n for n, fate in inside if fate < 2)
    sure = sum(n for n, fate in inside if fate < 1)
    # the first fate that goes below articles
    goes = 3 if not left else 1 if 2 * sure >= left else 2
    return "\n".join(text for text, article, fate, block in found
                     if (fate < goes if article else fate < 2 and (not articles or block in kept)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least: float = LEAST_IMPORTANCE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``id_col, url_col, text, n_chars``, a row for each row of ``pages``.

    A null or empty page has an empty text. Pages without a host are one site. Repeated pages are
    extracted each; an article that stands on many pages is not of less importance for it.
    """
    rules = written(site_rules(pages, url_col, html_col, least), "sites")
    names = ("removed", "likely", "kept")
    sites = rules.groupBy("host").agg(*[F.collect_set(F.when(F.col("rule") == r, F.col("id"))).alias(r) for r in names])
    sited = pages.select(id_col, url_col, html_col, host_of(url_col).alias("_host"))
    if small_enough(rules, broadcast_rows):
        known = {r["host"]: [frozenset(r[n]) for n in names] for r in sites.collect()}  # at most broadcast_rows ids

        @F.arrow_udf("string")
        def text_of(hosts: pa.Array, htmls: pa.Array) -> pa.Array:
            return pa.array([main_text(h.as_py(), *known.get(host.as_py(), (NOTHING,)))
                             for host, h in zip(hosts, htmls)], pa.string())

        out = sited.select(id_col, url_col, text_of("_host", html_col).alias("text"))
    else:
        @F.arrow_udf("string")
        def text_with(htmls: pa.Array, removed: pa.Array, likely: pa.Array, kept: pa.Array) -> pa.Array:
            return pa.array([main_text(h.as_py(), *(frozenset(x.as_py() or ()) for x in ids))
                             for h, *ids in zip(htmls, removed, likely, kept)], pa.string())

        out = sited.join(sites.withColumnRenamed("host", "_host"), "_host", "left").select(
            id_col, url_col, text_with(html_col, *names).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
