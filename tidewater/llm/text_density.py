"""Main text of web pages by composite text density.

A page becomes a tree of its block elements (inline markup belongs to the text of its block); what can't hold main text by
its tag or its declared role is left out. Every node gets the link-adjusted characters per tag of its subtree; the density
sum of a node adds up its children's densities. The subtree with the largest sum is the main text, and the smallest density on the
path from it to the body is the threshold: from the body down, every other subtree that reaches it is taken as well (and a first heading).
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import slices

# ---- fixed values: element kinds of the HTML standard, and class or id words of parts around an article
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp", "svg", "math")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
SKIPPED = frozenset("head nav footer aside form button select option dialog menu object canvas audio video map fieldset".split())
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BARRIER = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promoted promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside footer masthead cookie cookies consent gdpr notice notification alert popup modal overlay comment comments commentlist disqus reply replies respond "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search toolbar pagination pager widget".split()
)

_TOKEN = re.compile(r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*+>?", re.I) for t in RAW}


class _Node:
    """An element: its parts are texts (str, True if in a link) and nodes, in page order."""

    __slots__ = ("chars", "density", "link_chars", "link_tags", "parts", "skip", "tag", "tags", "total")

    def __init__(self, tag: str, skip: bool):
        self.tag, self.skip, self.parts = tag, skip, []


def _around(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of the article by its tag, role, class or id (inside: of an article or main element)."""
    if tag in SKIPPED or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
        if name == "id" and value in ("header", "site-header") and not inside:
            return True  # what the header element stands for
        if name in ("class", "id") and not AROUND.isdisjoint(re.split(r"[^a-z]+", value)):
            return True
    return False


def parse(page: str) -> _Node:
    """The tree below <body> (or of the whole page without one). Missing end tags are implied as HTML does for
    paragraphs, list items and table parts; an end tag without a start is ignored."""
    root = _Node("body", False)
    stack = [root]
    links = 0
    at = 0
    inside = 0

    def close_to(depth: int) -> None:
        nonlocal inside, links
        while len(stack) > depth:
            node = stack.pop()
            inside -= node.tag in ("article", "main")
            links -= node.tag == "a"

    def text(s: str) -> None:
        if s:
            stack[-1].parts.append((entities.unescape(s) if "&" in s else s, links > 0))

    while True:
        m = _TOKEN.search(page, at)
        text(page[at : m.start()] if m else page[at:])
        if not m:
            return root
        at = m.end()
        end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue  # a comment or declaration
        tag = tag.lower()
        if tag in ("html", "body"):
            continue
        if end:
            for d in range(len(stack) - 1, 0, -1):
                if stack[d].tag == tag:
                    close_to(d)
                    break
                if stack[d].tag in ("article", "main", "section", "table") and tag in INLINE:
                    break
            continue
        if tag in _RAW_END:
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag in ENDS_P:
            for d in range(len(stack) - 1, 0, -1):
                if stack[d].tag == "p":
                    close_to(d)
                    break
                if stack[d].tag not in INLINE:
                    break
        if tag in CLOSED_BY:
            for d in range(len(stack) - 1, 0, -1):
                if stack[d].tag in CLOSED_BY[tag]:
                    close_to(d)
                    break
                if stack[d].tag in BARRIER[tag]:
                    break
        if tag in VOID:
            stack[-1].parts.append((" ", links > 0) if tag in ("br", "wbr", "img") else _Node(tag, True))
            continue
        node = _Node(tag, _around(tag, attributes, inside > 0))
        stack[-1].parts.append(node)
        stack.append(node)
        inside += tag in ("article", "main")
        links += tag == "a"
        if attributes.endswith("/") and tag not in INLINE and tag not in ENDS_P:
            close_to(len(stack) - 1)


def _measure(root: _Node) -> list[tuple[_Node, _Node | None]]:
    """Fill in counts, densities and density sums; (block node, parent) in page order. Inline elements count with their block."""
    blocks: list[tuple[_Node, _Node | None]] = []
    flow = [(root, None)]
    while flow:
        node, parent = flow.pop()
        blocks.append((node, parent))
        node.chars = node.link_chars = node.link_tags = 0
        node.tags, node.total = 0, 0.0
        children = []
        inner = [iter(node.parts)]
        while inner:
            for part in inner[-1]:
                if isinstance(part, tuple):
                    size = sum(map(len, part[0].split()))
                    node.chars += size
                    node.link_chars += size * part[1]
                elif part.skip:
                    continue
                elif part.tag in INLINE:
                    node.link_tags += part.tag == "a"
                    node.tags += part.tag == "a"
                    inner.append(iter(part.parts))
                    break
                else:
                    children.append((part, node))
            else:
                inner.pop()
        flow += reversed(children)
    for node, parent in reversed(blocks):  # children come after their parents
        if parent is not None:
            parent.chars += node.chars
            parent.link_chars += node.link_chars
            parent.tags += node.tags + 1
            parent.link_tags += node.link_tags
    body = blocks[0][0]
    share = body.link_chars / body.chars if body.chars else 0.0
    for node, _ in blocks:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if not c:
            node.density = 0.0
            continue
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e)
        node.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / max(math.log(base) if base > math.e else 1.0, 1.0)
    for node, parent in reversed(blocks):
        if parent is not None:
            parent.total += node.density
    return blocks


def _collect(node: _Node, out: list[str], wanted: set[int] | None) -> None:
    """Append the block texts below ``node``; a text run ends where a block element begins or ends."""
    run: list[str] = []

    def flush() -> None:
        s = " ".join("".join(run).split())
        if s:
            out.append(s)
        run.clear()

    todo: list = [(iter(node.parts), False)]
    while todo:
        parts, block = todo[-1]
        for part in parts:
            if isinstance(part, tuple):
                run.append(part[0])
            elif part.skip:
                flush()
            elif part.tag in INLINE:
                todo.append((iter(part.parts), False))
                break
            else:
                flush()
                if wanted is None or id(part) in wanted:
                    todo.append((iter(part.parts), True))
                    break
        else:
            todo.pop()
            if block:
                flush()
    flush()


def main_text(page: str) -> str:
    """Blocks of the main text, joined by one space; empty if the page has none."""
    root = parse(page)
    blocks = _measure(root)
    if not root.chars:
        return ""
    parents = {id(n): p for n, p in blocks}
    best = max((n for n, _ in blocks), key=lambda n: n.total)  # ties: the first on the page
    if best.total <= 0:
        best = root
    path, node = [], best
    while node is not None:
        path.append(node)
        node = parents[id(node)]
    threshold = min(n.density for n in path)
    # an article element around the choice belongs to it as a whole
    for node in reversed(path):
        if node.tag == "article" or (node.tag == "main" and not any(x.tag == "article" for x in path)):
            best = node
            break
    above = {id(x) for x in path[next(i for i, x in enumerate(path) if x is best) + 1 :]}
    passed = set(above)  # nodes that aren't taken themselves, but perhaps parts of them
    out: list[str] = []
    for n, p in blocks:
        if p is not None and id(p) not in passed:
            continue  # part of a subtree that was taken
        if n is best or (id(n) not in above and n.chars and (n.density >= threshold or (n.tag == "h1" and id(p) in above))):
            _collect(n, out, None)
        else:
            passed.add(id(n))
    return " ".join(out)


def extract_pages(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns in ``keep`` and ``text``, for every row. A null page is empty; an empty page, or one without main text, gives
    the empty string. Broken markup never fails: unclosed elements end with the page. Equal rows give equal results; an
    empty table an empty one; columns not named are ignored."""
    source = pages.select(F.struct(*keep).alias("row"), F.coalesce(F.col(html_col), F.lit("")).alias("txt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([main_text(t) for t in b.column("txt").to_pylist()], pa.string())], ["row", "text"])

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, text string").select("row.*", "text")
