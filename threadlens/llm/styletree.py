"""Main text of pages by site style trees.

The DOMs of one host are merged: nodes with the same path of tags and classes are one
node of the host's tree. A node's presentation importance is the entropy of the child
tag sequences it takes, its content importance the entropy of the texts it holds, both
over the host's pages and scaled to 0..1. Branches whose importance is low (the same
layout with the same words on page after page) are removed from each page, as are
branches whose element says that it is no article text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import in_batches, sized_side

# A node is judged by its entropies when this many pages of its host have it.
MIN_PAGES = 8
# Composite importance below which a branch goes.
MIN_IMPORTANCE = 0.2

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
# One attribute after another, so that nothing inside a value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[a-z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr del".split())
# Elements that never hold article text.
NOISE_TAGS = RAW | frozenset("head nav header footer aside form button select option input svg canvas audio video object dialog menu".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Parts of class and id names that mark such branches.
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disclaimer footer header login masthead menu modal nav navbar navigation newsletter notice notices popup "
    "promo promoted related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar widget widgets disqus gdpr alert".split())
MAIN_TAGS = frozenset(("article", "main"))
# Opening one of these closes an open paragraph.
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table body html article main section div".split())


class Node:
    """An element with its texts and child nodes in page order."""

    __slots__ = ("tag", "label", "noise", "named", "parent", "items")

    def __init__(self, tag: str, label: str, noise: bool, named: int = 0, parent: "Node | None" = None):
        self.tag, self.label, self.noise, self.named, self.parent, self.items = tag, label, noise, named, parent, []


@lru_cache(maxsize=4096)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I)


@lru_cache(maxsize=4096)
def _label(tag: str, attributes: str) -> tuple[str, bool, int]:
    """The node's name in the style tree, whether its element rules out article text, and
    whether a class or id speaks against it: 2 for a whole name, 1 for a part of one."""
    noise, named = tag in NOISE_TAGS, 0
    label = tag
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "class":
            label += "".join("." + part for part in sorted(value.split()))
        if name in ("class", "id"):
            if tag not in MAIN_TAGS and tag != "body":
                whole = not NOISE_NAMES.isdisjoint(value.split())
                named = max(named, 2 * whole or int(not NOISE_NAMES.isdisjoint(_NAME_PART.findall(value))))
        elif name == "role":
            noise = noise or value in NOISE_ROLES
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            noise = True
    return label, noise, named


def _judge_names(root: Node) -> None:
    """Let names rule branches out, but not one that holds every article of the page, nor
    one with most of its text: where the whole class or id is such a name, that counts
    only without an article elsewhere (a long list of comments is no article)."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        if not node.noise:
            stack.extend(child for child in node.items if isinstance(child, Node))
    size, mains = {}, {}
    for node in reversed(order):
        size[node], mains[node] = 0, int(node.tag in MAIN_TAGS)
        if node.noise:
            mains[node] = 0
            continue
        for item in node.items:
            if isinstance(item, str):
                size[node] += len(item) if item.strip() else 0
            else:
                size[node] += size[item]
                mains[node] += mains[item]
    for node in order:
        if node.named:
            elsewhere = mains[node] < mains[root]
            most = 2 * size[node] > size[root] and (node.named == 1 or not elsewhere)
            node.noise = node.noise or not (most or mains[node] and not elsewhere)


def parse(page: str) -> Node:
    """A lenient tree: end tags close what is open by their name, paragraphs and list
    items end where the next begins, raw text elements run to their end tag."""
    root = Node("", "", False)
    at, open_ = 0, root
    size = len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None:
            open_.items.append(page[at:])
            break
        if found.start() > at:
            open_.items.append(page[at:found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), found[1] or found[4], found[3] or found[6] or ""
        if closing:
            node = open_
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                open_ = node.parent
            continue
        if tag in CLOSES_P:
            node = open_
            while node is not root and node.tag not in _SCOPE and node.tag != "p":
                node = node.parent
            if node.tag == "p":
                open_ = node.parent
        if tag in _SAME:
            node = open_
            while node is not root and node.tag not in _SCOPE and node.tag not in _SAME[tag]:
                node = node.parent
            if node.tag in _SAME[tag]:
                open_ = node.parent
        label, noise, named = _label(tag, attributes)
        node = Node(tag, label, noise, named, open_)
        open_.items.append(node)
        if tag in RAW:
            end = _raw_end(tag).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            open_ = node
    _judge_names(root)
    return root


def host_of(url: str | None) -> str:
    """Host of the url in lower case; the empty host where there is none."""
    found = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "", re.I)
    return found[1].lower() if found else ""


def _walk(root: Node) -> Iterator[tuple[str, Node]]:
    """Nodes outside ruled-out branches and outside article elements, with their paths."""
    stack = [("", root)]
    while stack:
        path, node = stack.pop()
        if node.noise or node.tag in MAIN_TAGS:
            continue
        if node.tag:
            yield path, node
        stack.extend((f"{path}/{child.label}", child) for child in node.items if isinstance(child, Node))


def _text(node: Node) -> str:
    parts, stack = [], [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        else:
            stack.extend(reversed(item.items))
    return " ".join(" ".join(parts).split())


def _in_main(node: Node) -> bool:
    while node is not None:
        if node.tag in MAIN_TAGS:
            return True
        node = node.parent
    return False


def features(page: str) -> list[tuple[str, int, int]]:
    """For each node of the style tree that the page has: path, layout and content codes.

    Nodes inside an article element, and all that their elements rule out already, are
    not judged by entropy.
    """
    root, out = parse(page), {}
    for path, node in _walk(root):
        if node.tag in INLINE or node.tag in VOID or node.tag in ("html", "body"):
            continue
        layout, content = out.setdefault(path, ([], []))
        layout.append("+".join(item.label for item in node.items if isinstance(item, Node)))
        content.append(_text(node))
    code = lambda parts: int.from_bytes(hashlib.blake2b("\n".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)
    return [(path, code(layout), code(content)) for path, (layout, content) in out.items()]


def extract(page: str, dropped: set[str]) -> str:
    """Text of the branches that stay. White space inside a block becomes one space."""
    root = parse(page)
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        if line:
            text = "".join(line)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                blocks.append(text)
            line.clear()

    stack: list = [("", root)]
    while stack:
        entry = stack.pop()
        if entry is None:
            end()
            continue
        path, item = entry
        if isinstance(item, str):
            line.append(item)
            continue
        if item.noise or (path in dropped and not _in_main(item)):
            continue
        block = item.tag not in INLINE
        if block:
            end()
            stack.append(None)
        for child in reversed(item.items):
            if isinstance(child, str):
                stack.append(("", child))
            else:
                stack.append((f"{path}/{child.label}" if dropped else "", child))
    end()
    return " ".join(blocks)


def style_tree(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """Importance of every node of every host's tree: ``host, path, pages, presentation, content, importance``.

    Tasks count first; a host of any size then meets as one row for each path and
    distinct layout or content.
    """
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                host = host_of(url)
                for path, layout, content in features(page or ""):
                    counts[host, path, 0, layout] += 1
                    counts[host, path, 1, content] += 1
            if counts:
                host, path, kind, code = zip(*counts)
                yield pa.record_batch({"host": list(host), "path": list(path), "kind": pa.array(kind, pa.int32()),
                                       "code": pa.array(code, pa.int64()), "n": pa.array(counts.values(), pa.int64())})

    counted = in_batches(pages.select("url", "html"), body, "host string, path string, kind int, code long, n long")
    by_code = counted.groupBy("host", "path", "kind", "code").agg(F.sum("n").alias("n"))
    by_kind = by_code.groupBy("host", "path", "kind").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"))
    # Entropy over the node's pages, to the base of their number: 0 when all agree, 1 when none do.
    entropy = F.when(F.col("pages") > 1, 1 - F.col("s") / (F.col("pages") * F.log("pages"))).otherwise(1.0)
    return (by_kind.groupBy("host", "path").agg(
                F.max("pages").alias("pages"),
                F.max(F.when(F.col("kind") == 0, entropy)).alias("presentation"),
                F.max(F.when(F.col("kind") == 1, entropy)).alias("content"))
            # A node counts if its layout or its content varies: the complement of both being fixed.
            .withColumn("importance", F.when(F.col("pages") >= min_pages,
                                             1 - (1 - F.col("presentation")) * (1 - F.col("content"))).otherwise(1.0)))


def main_text(pages: DataFrame, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    A null or empty html has an empty text; a null url belongs to the host of pages
    without one. Pages that repeat are separate rows of the same host. Very long pages
    are parsed whole by one task; the tree's depth is not limited by recursion. An
    empty table gives no rows. Columns other than page_id, url and html are not read.
    """
    low = (style_tree(pages).filter(F.col("importance") < min_importance)
           .groupBy("host").agg(F.collect_list("path").alias("paths")))
    ids = dict(pages.dtypes)["page_id"]
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    joined = (pages.select("page_id", "url", "html").withColumn("_host", host)
              .join(sized_side(low), F.col("_host") == F.col("host"), "left").select("page_id", "url", "html", "paths"))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page or "", set(paths or ())) for page, paths in
                     zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist())]
            yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                                   "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return in_batches(joined, body, f"page_id {ids}, url string, text string, n_chars long")
