"""Main text of web pages: rules for parts that are never content, and removal of what a host repeats on its pages.

Every element of a page is hashed with all it holds. Subtrees that recur on many different pages of a host are its
templates; they are deleted before the content is looked for.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small_or_hot
from ..session import stage

MIN_PAGES = 5
MIN_SHARE = 0.2

# Names of the HTML standard, and words that mark up parts around the content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
DROPPED = frozenset(
    "script style noscript template head title nav aside footer form button select textarea input iframe object svg "
    "canvas dialog menu audio video map math".split()
)
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
MARKERS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended comment comments commentlist discussion disqus reply replies respond pagination pager "
    "skip toolbar".split()
)
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense sponsored".split())
CLOSED_BY = {
    "p": BLOCKS - {"br", "body", "html", "option"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}
CONTAINERS = frozenset("div section ul ol dl table figure details center fieldset span a".split())
# What can be a template inside a text: boxes, and lists and tables that are menus (all of their text in links).
BOXES = frozenset("div section figure details center fieldset".split())
LISTS = frozenset("ul ol dl table".split())
# What identifies a subtree besides tag and content.
TELLING = ("class", "href", "role")
SCOPES = frozenset("ul ol dl table td th article section main div body html aside nav header footer form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[\s\xa0]+")


@dataclass
class Node:
    """An element: its children are elements and strings; ``kept`` is false for parts that are never content.

    The rest is set once it is hashed: its digest, the characters of its text, those of them in links, and whether it
    is a ``candidate``, which alone can be taken for a template.
    """

    tag: str
    kept: bool = True
    attributes: str = ""
    children: list = field(default_factory=list)
    digest: int = 0
    n_text: int = 0
    n_linked: int = 0
    candidate: bool = False

    def is_in(self, templates: frozenset[int]) -> bool:
        return self.candidate and self.digest in templates


def _attributes(source: str) -> Iterator[tuple[str, str]]:
    """Names and values of a tag in lower case, without what stands inside the values."""
    for name, value in _ATTRIBUTE.findall(source):
        if name:
            yield name.lower(), value.strip("\"'").lower()


def _is_content(tag: str, attributes: str, inside: bool, in_text: bool) -> bool:
    """False for elements that are around the content by name, role or marker.

    ``inside``: within an article; ``in_text``: within an article or main element.
    """
    if tag in DROPPED or (tag == "header" and not inside):
        return False
    if tag in ("html", "body", "article", "main") or not attributes:
        return _plain_article(tag, attributes)
    return not _marked(tag, attributes, in_text)


def _plain_article(tag: str, attributes: str) -> bool:
    """Comments are often articles of their own; the page and its main part are never dropped by a marker."""
    if tag != "article" or not attributes:
        return True
    words = {
        w
        for name, value in _attributes(attributes)
        if name in ("class", "id", "role")
        for w in (value.split() if name == "id" else _WORD.findall(value))
    }
    return not words & {"comment", "comments", "reply", "related", "ad", "ads", "promo", "sponsored"}


def _marked(tag: str, attributes: str, in_text: bool) -> bool:
    """Whether an element is hidden or marked as a part around the content.

    In the text of an article a marker is a whole class or id of a container, or of anything if it names an advert.
    Elsewhere it may be part of a class, or of the id of a container.
    """
    for name, value in _attributes(attributes):
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role":
            if value in ROLES:
                return True
        elif name in ("class", "id") and (tag in CONTAINERS or not in_text):
            whole = in_text or (name == "id" and tag not in CONTAINERS)
            if MARKERS.intersection(value.split() if whole else _WORD.findall(value)):
                return True
        elif name in ("class", "id") and ADVERTS.intersection(value.split()):
            return True
    return False


class _Open:
    """The open elements, outermost first, and where those of a tag, the scopes and the blocks are among them.

    Looking up an end tag takes the same time at any depth.
    """

    def __init__(self, root: Node):
        self.nodes = [root]
        self._of_tag: dict[str, list[int]] = {}
        self._scopes: list[int] = []
        self._blocks: list[int] = []

    def _lists(self, tag: str) -> Iterator[list[int]]:
        yield self._of_tag.setdefault(tag, [])
        if tag in SCOPES:
            yield self._scopes
        if tag in BLOCKS:
            yield self._blocks

    def push(self, node: Node) -> None:
        for places in self._lists(node.tag):
            places.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, depth: int) -> None:
        while len(self.nodes) > depth:
            for places in self._lists(self.nodes.pop().tag):
                places.pop()

    def count(self, tag: str) -> int:
        return len(self._of_tag.get(tag, ()))

    def end(self, tag: str) -> None:
        """End the innermost element of a tag, unless a scope keeps the end tag from it."""
        places = self._of_tag.get(tag)
        if places and (tag in SCOPES or not self._scopes or self._scopes[-1] < places[-1]):
            self.cut(places[-1])

    def close_paragraph(self) -> None:
        """A block ends an open paragraph even when inline elements of it are still open."""
        if self._blocks and self.nodes[self._blocks[-1]].tag == "p":
            self.cut(self._blocks[-1])


def parse_page(source: str) -> Node:
    """A forgiving tree of a page: optional end tags are implied, stray ones ignored, open ones closed at the end."""
    root = Node("#page")
    stack, at = _Open(root), 0
    find = _TOKEN.search
    while True:
        match = find(source, at)
        if match is None:
            if at < len(source):
                stack.nodes[-1].children.append(source[at:])
            return root
        if match.start() > at:
            stack.nodes[-1].children.append(source[at : match.start()])
        at = match.end()
        name = match[2]
        if name is None:
            if match[0].startswith("<![CDATA["):
                stack.nodes[-1].children.append(html.escape(match[0][9:].removesuffix("]]>")))
            continue
        tag, attributes = name.lower(), match[3]
        if match[1]:
            stack.end(tag)
            continue
        while stack.nodes[-1].tag in CLOSED_BY and tag in CLOSED_BY[stack.nodes[-1].tag]:
            stack.cut(len(stack.nodes) - 1)
        if tag in BLOCKS and tag not in ("br", "li", "option"):
            stack.close_paragraph()
        inside = stack.count("article") > 0
        node = Node(tag, _is_content(tag, attributes, inside, inside or stack.count("main") > 0), attributes)
        stack.nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            node.children.append(source[at : end.start()] if end else source[at:])
            at = end.end() if end else len(source)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.push(node)


def content_root(root: Node, templates: frozenset[int] = frozenset()) -> list[Node]:
    """Where the content is: the outermost articles, else the main element, else the whole page; no templates."""
    for tag in ("article", "main"):
        found: list[Node] = []
        _collect(root, tag, templates, found)
        if found:
            return found
    return [root]


def _collect(node: Node, tag: str, templates: frozenset[int], found: list[Node]) -> None:
    todo = [node]
    while todo:
        node = todo.pop()
        if not node.kept or node.is_in(templates):
            continue
        if node.tag == tag:
            found.append(node)
        else:
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]


def _ordered(page: Node) -> list[tuple[Node, Node | None, bool]]:
    """Every kept element, children before parents, with its parent and whether it is within an article or main element."""
    order: list[tuple[Node, Node | None, bool]] = []
    todo: list[tuple[Node, Node | None, bool]] = [(page, None, False)]
    while todo:
        node, parent, in_text = todo.pop()
        if node.kept:
            order.append((node, parent, in_text))
            within = in_text or node.tag in ("article", "main")
            todo += [(c, node, within) for c in node.children if isinstance(c, Node)]
    return order[::-1]


def _identity(node: Node) -> str:
    if not node.attributes:
        return node.tag
    found = sorted((name, value) for name, value in _attributes(node.attributes) if name in TELLING and value)
    return " ".join([node.tag, *(f"{name}={value}" for name, value in found)])


def _can_be_template(node: Node, in_text: bool) -> bool:
    """Blocks with text, but in an article or main element only boxes and menus.

    A paragraph, heading, list or table that many articles share is still content, and so is everything inline.
    """
    if not node.n_text:
        return False
    if not in_text:
        return node.tag in BLOCKS and node.tag not in ("html", "body", "main")
    return node.tag in BOXES or (node.tag in LISTS and node.n_linked == node.n_text)


def hash_subtrees(page: Node) -> list[int]:
    """Hash every kept element of a page (tag, class, role, target and content, white space made even).

    Returns the digests of those that can be templates. The longest article (or main element) of the page and what it
    lies in never are.
    """
    order = _ordered(page)
    for node, _, in_text in order:
        parts = [_identity(node)]
        for child in node.children:
            if isinstance(child, str):
                text = _SPACE.sub(" ", child).strip()
                if text:
                    parts.append(text)
                    node.n_text += len(text)
            elif child.kept:
                parts.append(str(child.digest))
                node.n_text += child.n_text
                node.n_linked += child.n_linked
        if node.tag == "a":
            node.n_linked = node.n_text
        node.digest = xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)
        node.candidate = _can_be_template(node, in_text)
    spared = {id(max(content_root(page), key=lambda root: root.n_text))}
    for node, parent, _ in order:
        if id(node) in spared:
            node.candidate = False
            spared.add(id(parent))
    return [node.digest for node, _, _ in order if node.candidate]


def main_text(roots: list[Node], templates: frozenset[int] = frozenset()) -> str:
    """Blocks of the content in page order, joined by line feeds; subtrees in ``templates`` are left out."""
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        if text:
            blocks.append(text)
        run.clear()

    for root in roots:
        todo: list = [root]
        while todo:
            item = todo.pop()
            if item is None:
                close()
            elif isinstance(item, str):
                run.append(item)
            elif item.kept and not item.is_in(templates):
                if item.tag in BLOCKS or item is root:
                    close()
                    todo.append(None)
                todo += reversed(item.children)
    close()
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), host_of(F.col("url").cast("string")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def subtree_counts(pages: DataFrame) -> DataFrame:
    """``host, digest, n_pages``: on how many different pages of its host each subtree occurs.

    Pages with equal content count once, so that copies of one article don't make a template of it. ``digest`` is null
    in the row that counts all pages of a host.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, digests, contents = [], [], []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = parse_page(source)
                found = set(hash_subtrees(page))
                content = xxhash.xxh64_intdigest(main_text(content_root(page))) - (1 << 63)
                hosts += [host] * (len(found) + 1)
                digests += [None, *found]
                contents += [content] * (len(found) + 1)
            columns = [pa.array(hosts, pa.string()), pa.array(digests, pa.int64()), pa.array(contents, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["host", "digest", "content"])

    seen = _pages(pages).select("host", "html").mapInArrow(hashes, "host string, digest bigint, content bigint")
    return seen.distinct().groupBy("host", "digest").agg(F.count("*").alias("n_pages"))


def host_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``host, templates``: subtrees on at least ``min_pages`` different pages and ``min_share`` of those of the host.

    The share bounds the list of a host: it has at most 1 / ``min_share`` times the subtrees of its average page.
    """
    counts = stage(subtree_counts(pages).filter(F.col("digest").isNull() | (F.col("n_pages") >= min_pages)), "subtrees")
    totals = counts.filter("digest is null").select("host", F.col("n_pages").alias("n_all"))
    common = counts.filter("digest is not null").join(totals, "host").filter(F.col("n_pages") >= min_share * F.col("n_all"))
    return common.groupBy("host").agg(F.collect_set("digest").alias("templates"))


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html, ...)``.

    Null and empty pages have an empty text. Null ids and URLs are kept (all pages without a host count as one host),
    repeated rows are treated one by one but count as one page of their host, an empty table gives no rows. Pages may
    have any length and depth; a task holds one page as a tree. Other columns are ignored, whatever their names.
    """
    templates = stage(host_templates(pages, min_pages, min_share), "templates")
    lists = templates.select("host", F.array_join(F.col("templates").cast("array<string>"), ",").alias("templates"))
    found = _pages(pages)
    with_lists = join_templates(found, lists)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            known: dict[str, frozenset[int]] = {"": frozenset()}
            for source, joined in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                joined = joined or ""
                if joined not in known:
                    known[joined] = frozenset(map(int, joined.split(",")))
                page, templates = parse_page(source), known[joined]
                if templates:
                    hash_subtrees(page)
                texts.append(main_text(content_root(page, templates), templates))
            columns = [batch.column(0), batch.column(1), pa.array(texts), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    schema = "page_id bigint, url string, text string, n_chars bigint"
    return with_lists.select("page_id", "url", "html", "templates").mapInArrow(extract, schema)


def join_templates(pages: DataFrame, lists: DataFrame) -> DataFrame:
    """Give each page the list of its host. Hosts without one stay where they are; only the others are joined."""
    if not lists.limit(1).count():
        return pages.withColumn("templates", F.lit(None).cast("string"))
    rows = pages.withColumn("_row", F.xxhash64("page_id", "url"))
    hosts = lists.select(F.col("host").alias("_host"))
    has = join_small_or_hot(rows, lists, "host", ["_row"]).select("page_id", "url", "html", "templates")
    rest = rows.join(hosts, F.col("host") == F.col("_host"), "left_anti")
    return has.unionByName(rest.select("page_id", "url", "html", F.lit(None).cast("string").alias("templates")))
