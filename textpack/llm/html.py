"""Main text of web pages by site style trees.

All pages of a host are merged into one tree of styles: a node is the path of containers (tags, roles, classes and the place among
siblings of the same style) from the root. It is counted on how many different pages it occurs, which children it has there (its
presentation) and which texts it holds (its contents). A node whose presentations and contents hardly vary from page to page is
part of the site's frame: its importance is the larger of the two entropies, each as a share of the most its
pages could give. Every container is counted and judged, those in the article too. Pages of the same main text count once, so that copies
don't make an article look like a frame.

Names are the prior. What the tags and class names of menus, headers, footers and the like hold has importance 0 whatever the
tree says, as menus and adverts do change from page to page. ``article`` and ``main`` have 1; a node in them is cut by the tree if they
themselves vary on the site and it doesn't.

The merged tree is never in one place: pages emit counts of nodes, which are added up before and after one
shuffle, and get back which of their own nodes are of low importance.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.llm.urls import split_url
from textpack.session import materialize

#: Importance under which a branch is left out, and pages of a node under which entropies say nothing.
THRESHOLD, LEAST_PAGES = 0.2, 5
# The tags and words that name parts of a page.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FRAME_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "template", "svg", "object"}
FRAME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "cookie", "cookies", "disqus", "footer", "header", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "popup", "promo", "related", "respond", "share", "sharing", "sidebar", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget"}
#: Words that only say more of a frame, and those that make a name a mention of it. Some words name a frame beside any other.
FILLERS = {"site", "main", "list", "area", "slot", "button", "buttons", "bar", "box", "container", "wrapper", "inner", "links", "block",
           "wp", "signup", "top", "bottom", "primary", "global"}
MENTIONS = {"has", "no", "with", "without", "is", "enabled", "disabled", "open", "closed", "count"}
FRAME_ANYWHERE = {"comment", "comments", "commentlist", "advert", "advertisement", "navigation", "newsletter"}
MAIN_TAGS, MAIN_WORDS = {"article", "main"}, {"main"}
NEVER_FRAME = {"html", "body", *MAIN_TAGS}
CONTAINERS = {
    "article", "aside", "body", "center", "details", "dialog", "div", "dl", "fieldset", "figure", "footer", "form", "header", "main", "menu",
    "nav", "ol", "section", "table", "td", "ul"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul"}
#: A start tag ends an open element of these, unless one of the others lies between.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
# Quoted values may hold a >, but no <: a quote that isn't closed ends with its tag.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]++|"[^"<]*"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"""
    r"""|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WHITE = re.compile(r"\s+")
_PARTS = re.compile(r"[_-]+")


PLAIN, FRAME, MAIN, PAGE = 0, 1, 2, 3


class Node:
    """A container. ``kind`` is PLAIN, FRAME, MAIN for the outermost element of the main text, or PAGE for html and body."""

    __slots__ = ("key", "parent", "role", "kind", "styles", "seen", "content")

    def __init__(self, key: int, parent: int, role: str, kind: int):
        self.key, self.parent, self.role, self.kind = key, parent, role, kind
        self.styles: list[str] = []
        self.seen: Counter = Counter()
        self.content = xxhash.xxh64()


def names_frame(name: str) -> bool:
    """Whether a class name as a whole names a frame: ``site-footer`` does, ``has-sidebar`` only mentions one."""
    parts = set(_PARTS.split(name))
    if parts & MENTIONS:
        return False
    return bool(parts & FRAME_ANYWHERE) or bool(parts & FRAME_WORDS) and FRAME_WORDS | FILLERS >= parts


def role_of(tag: str, names: set[str], parent: str) -> str:
    """``frame``, ``main`` or nothing; what lies in either stays in it, but a frame may lie in main.

    No name makes a frame of a whole page or of its main text.
    """
    if parent == "frame" or tag in FRAME_TAGS or tag not in NEVER_FRAME and any(map(names_frame, names)):
        return "frame"
    return "main" if parent == "main" or tag in MAIN_TAGS or names & MAIN_WORDS else ""


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Containers of a page, each after its parent, and the blocks of text with the container that holds each.

    Broken markup is read as browsers do in the main: a paragraph ends where a block starts, unclosed
    elements end with what holds them, stray end tags and a tag that is cut off mean nothing. Takes memory in proportion to the
    page, however deep it nests.
    """
    nodes = [Node(0, 0, "", PAGE)]
    stack: list[tuple[str, int]] = [("", 0)]  # open elements, each with its container
    blocks: list[tuple[int, str]] = []
    text: list[str] = []
    at = 0

    def flush() -> None:
        if not text:
            return
        block = _WHITE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if block:
            blocks.append((stack[-1][1], block))
            nodes[stack[-1][1]].content.update(block + "\n")

    def end(tags: set[str], barrier: set[str]) -> None:
        """Close the nearest open element of ``tags``, if none of ``barrier`` lies above it."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                if stack[depth][1] != stack[-1][1] or stack[depth][0] in BLOCKS or stack[depth][1] != stack[depth - 1][1]:
                    flush()
                del stack[depth:]
                return
            if stack[depth][0] in barrier:
                return

    while m := _TAG.search(page, at):
        if at < m.start():
            text.append(page[at:m.start()])
        at = m.end()
        tag, attributes = (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in BLOCKS:
                flush()
            end({tag}, set() if tag in BLOCKS or tag in FRAME_TAGS else BLOCKS)
            continue
        if tag in RAW:
            closing = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if tag in BLOCKS:
            flush()
            end({"p"}, BLOCKS - {"p"})
        if tag in IMPLIED:
            end(*IMPLIED[tag])
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        parent = nodes[stack[-1][1]]
        whole = {w for _, v in _NAMES.findall(attributes) for n in v.strip("\"'").lower().split() if (w := n.strip("_-"))} if attributes else set()
        role = role_of(tag, whole, parent.role)
        if tag not in CONTAINERS and role == parent.role:
            stack.append((tag, stack[-1][1]))
            continue
        flush()
        style = f"{tag} {' '.join(sorted(w for n in whole for w in _PARTS.split(n)))}"
        parent.styles.append(style)
        kind = PAGE if tag in ("html", "body") else FRAME if role == "frame" else MAIN if role != parent.role else PLAIN
        nodes.append(Node(xxhash.xxh64_intdigest(f"{parent.key} {style} {parent.seen[style]}"), stack[-1][1], role, kind))
        parent.seen[style] += 1
        stack.append((tag, len(nodes) - 1))
    text.append(page[at:])
    flush()
    return nodes, blocks


def parsed_pages(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """Each row's host, text by names alone, containers, and if the tree may cut any of them, the blocks with their containers."""
    host, _ = split_url(F.col("url"))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"))
    rows = rows.select("key", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"),
                       F.monotonically_increasing_id().alias("row"))
    node = pa.struct([("node", pa.int64()), ("parent", pa.int32()), ("kind", pa.int8()), ("style", pa.int64()), ("content", pa.int64())])
    block = pa.struct([("text", pa.string()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                parsed = [parse_page(body) for body in part.column("html").to_pylist()]
                open_ = [any(n["kind"] == PLAIN for n in nodes) for nodes, _ in parsed]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], part.column("row"), pa.array([identity(nodes) for nodes, _ in parsed], pa.int64()),
                     pa.array(["\n".join(b["text"] for b in blocks) for _, blocks in parsed], pa.string()),
                     pa.array([nodes for nodes, _ in parsed], pa.list_(node)),
                     pa.array([blocks if o else None for (_, blocks), o in zip(parsed, open_)], pa.list_(block))],
                    names=["key", "url", "host", "row", "page", "text", "nodes", "blocks"])

    kind = dict(pages.dtypes)[key]
    return rows.mapInArrow(run, f"""
        key {kind}, url string, host string, row long, page long, text string,
        nodes array<struct<node:bigint,parent:int,kind:tinyint,style:bigint,content:bigint>>, blocks array<struct<text:string,at:int>>""")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def parse_page(body: str) -> tuple[list[dict], list[dict]]:
    """All containers, and the blocks that no name puts into a frame."""
    nodes, blocks = parse(body)
    for node in reversed(nodes[1:]):  # a container's content includes that of those in it
        nodes[node.parent].content.update(node.content.digest())
    return [{"node": signed(n.key), "parent": n.parent, "kind": n.kind, "style": signed(xxhash.xxh64_intdigest("\n".join(n.styles))),
             "content": signed(n.content.intdigest())} for n in nodes], [
        {"text": text, "at": at} for at, text in blocks if nodes[at].role != "frame"]


def identity(nodes: list[dict]) -> int:
    """What makes a page differ from others of its site: its main text, or all of it if none is named."""
    return next((n["content"] for n in nodes if n["kind"] == MAIN), nodes[0]["content"])


def importance(parsed: DataFrame) -> DataFrame:
    """``(host, node, importance)`` of every container of every host.

    Entropies are sums over the distinct presentations and contents of a node, taken from counts of different pages; the larger one
    is divided by the log of the node's pages. A node of few pages is important.
    """
    seen = materialize(parsed.select("host", "page", F.explode("nodes").alias("n"))
                       .select("host", "page", "n.node", "n.style", "n.content").distinct(), "style-tree")

    def entropy(of: str) -> DataFrame:
        counts = seen.groupBy("host", "node", of).agg(F.count("*").alias("c"))
        return counts.groupBy("host", "node").agg(
            F.sum("c").alias("pages"),
            (F.log(F.sum("c")) - F.sum(F.col("c") * F.log("c")) / F.sum("c")).alias(of))

    both = entropy("style").join(entropy("content").drop("pages"), ["host", "node"])
    share = F.greatest("style", "content") / F.log("pages")
    return both.select("host", "node", F.when(F.col("pages") < LEAST_PAGES, 1.0).otherwise(share).alias("importance"))


def kept_text(nodes: list[dict], blocks: list[dict], low: set[int]) -> str:
    """The blocks outside of containers that are cut: those of low importance, but in a main text only if that isn't."""
    gone, same = [False] * len(nodes), [False] * len(nodes)  # cut; in a main text that hardly varies
    for i, n in enumerate(nodes[1:], 1):
        same[i] = same[n["parent"]] or n["kind"] == MAIN and n["node"] in low
        gone[i] = gone[n["parent"]] or n["kind"] == PLAIN and n["node"] in low and not same[i]
    return "\n".join(b["text"] for b in blocks if not gone[b["at"]])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
            threshold: float = THRESHOLD) -> DataFrame:
    """Main text of each row: ``key, url, text``.

    Character references are decoded, white space in a block is one space, blocks are joined by one line feed in
    page order. A null, empty or textless page has an empty text; pages without a host share one tree. Sites of fewer than
    LEAST_PAGES different pages are judged by names alone. Repeated rows are kept.
    """
    parsed = materialize(parsed_pages(pages, key, url, page), "parsed-pages")
    low = importance(parsed).where(F.col("importance") < threshold).select("host", "node")
    asked = parsed.where("blocks IS NOT NULL").select("row", "host", F.explode("nodes").alias("n")).select("row", "host", "n.node", "n.kind")
    cut = (asked.where(F.col("kind").isin(PLAIN, MAIN)).join(low, ["host", "node"]).groupBy("row")
           .agg(F.collect_set("node").alias("low"), F.min("kind").alias("kind")))
    # Written first, so that Spark knows its size: texts are shuffled only if many pages have something to cut.
    cut = materialize(cut.where(F.col("kind") == PLAIN).select("row", "low"), "cut")
    names = [key, url, "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i in np.flatnonzero(batch.column("low").is_valid().to_numpy(zero_copy_only=False)).tolist():
                texts[i] = kept_text(*(batch.column(c)[i].as_py() for c in ("nodes", "blocks")), set(batch.column("low")[i].as_py()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=names)

    judged = parsed.where("blocks IS NOT NULL").join(cut, "row", "left").select("key", "url", "text", "nodes", "blocks", "low")
    plain = parsed.where("blocks IS NULL").select(F.col("key").alias(key), F.col("url").alias(url), "text")
    return plain.unionByName(judged.mapInArrow(run, plain.schema))
