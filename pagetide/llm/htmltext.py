"""Main text of HTML pages, with a site style tree per host.

A page is parsed once, in a task, into the blocks of its article: what stands inside menus, headers, footers, sidebars,
notices, adverts, forms or reader comments, by element, role or name, is left out at once. The blocks that are left carry the
keys of the branches they stand in, hashes of the path from the root. All pages of a host then make one style tree, as aggregations by host and branch: a branch
is important if its pages arrange it in many ways (presentation) and if its texts differ from page to page (content), both as
entropies between 0 and 1. Copies of a page count once, so that they do not pass for shared text. Blocks in branches of low
importance are removed from every page of the host, however short its article, but for the title; a page that would lose all
its text stays whole. A host may hold any share of the pages: sums by branch combine before their shuffle.

Defined results: null and empty html give an empty text; a form is left out unless it holds the article or most of the text, its
controls always; elements nested more than `DEEPEST` deep belong to the branch of the last one above that; pages without a host, and hosts with fewer than `least_pages` different
pages, have no style tree; repeated rows are pages of their own; an empty table gives an empty table; only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.operators.skew import lookup_join
from pagetide.session import materialise

# Names of HTML elements and of page parts.
RAW = {"script", "style", "noscript", "template", "iframe", "noembed", "noframes", "xmp", "svg", "math", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
    "wbr", "img", "br", "nobr", "picture", "audio", "video",
}
DROPPED = {
    "head", "title", "nav", "footer", "aside", "button", "select", "option", "textarea", "input", "label", "dialog", "menu",
    "datalist", "output", "progress", "meter", "frameset",
}
FORMS = {"form", "fieldset"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
DROPPED_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "submenu", "breadcrumb", "breadcrumbs", "pagination", "pager", "footer", "masthead", "topbar",
    "sidebar", "aside", "widget", "widgets", "related", "recommended", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "banner", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search", "searchbox",
    "share", "sharing", "social", "comment", "comments", "commentlist", "respond", "reply", "replies", "disqus", "copyright", "legal",
    "toolbar", "skip", "alert", "paywall", "outbrain", "taboola",
}
# Words that may stand beside a name of a part without changing what it is: cookie-bar, sidebar-left, but not has-sidebar.
BESIDE_NAMES = {
    "left", "right", "top", "bottom", "site", "list", "area", "box", "bar", "container", "wrapper", "wrap", "inner", "outer", "section",
    "block", "links", "buttons", "slot", "unit", "zone", "form", "primary", "secondary", "global",
}
MAIN = {"article", "main"}
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

PARSED = (
    "page_id bigint, url string, blocks array<struct<branches: array<bigint>, title: boolean, text: string>>, "
    "styles array<struct<branch: bigint, style: bigint>>"
)


# What another element's start or end may close before its time.
CLOSABLE = {"p"}.union(*CLOSED_BY.values())

# How deep the branches of the style tree go.
DEEPEST = 128


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    key: str
    dropped: bool
    named: bool  # by class or id a part that is not the article
    main: bool
    header: bool
    closable: int  # the nearest element that may be closed early, itself included, in its scope
    children: list[str] | None = None
    holds_main: bool = False


def judged(attrs: str) -> tuple[str, bool, set[str], bool]:
    """Class and id of an element, whether it is left out for an attribute, the parts that its names say it is, and whether it has
    no other names."""
    names, dropped = "", False
    for name, *values in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name == "role":
            dropped |= value.strip().lower() in DROPPED_ROLES
        elif name == "hidden" or name == "aria-hidden":
            dropped |= name == "hidden" or value.lower() == "true"
        elif name == "class" or name == "id":
            names += " " + value
    words: set[str] = set()
    only = True
    for name in names.split():
        own = {word.lower() for word in NAME.findall(name)}
        if own <= DROPPED_NAMES | BESIDE_NAMES:
            words |= own & DROPPED_NAMES
        else:
            only = False
    return names, dropped, words, only


@dataclass(frozen=True)
class TreeSettings:
    least_pages: int = 5
    least_importance: float = 0.2
    presentation: float = 0.1  # weight of presentation against content


class Page:
    """The element tree of one page, of block elements only, and the text that stands directly in each of them."""

    def __init__(self, source: str) -> None:
        self.nodes = [Node("", -1, "", False, False, False, False, 0)]
        self.at = 0
        self.opened: Counter[str] = Counter()
        # An inline element that is left out: its tag, how many of that tag are open in it, and the element it stands in.
        self.muted: tuple[str, int, int] | None = None
        self.blocks: list[tuple[int, str]] = []
        self.text: list[str] = []
        end = 0
        skip = 0
        for token in TOKEN.finditer(source):
            if token.start() < skip:
                continue
            start = max(end, skip)
            if token.start() > start and not self.muted:
                self.text.append(source[start : token.start()])
            end = token.end()
            tag = (token["tag"] or token["tag2"] or "").lower()
            if not tag:
                continue
            if token["end"] or token["end2"]:
                self._close(tag)
            elif tag in RAW:
                close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, end)
                attrs = token["attrs"] or token["attrs2"] or ""
                skip = end if attrs.rstrip().endswith("/") else (close.end() if close else len(source))
                end = skip
            else:
                self._open(tag, token["attrs"] or token["attrs2"] or "")
        if max(end, skip) < len(source) and not self.muted:
            self.text.append(source[max(end, skip) :])
        self._flush()

    def _flush(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            if text:
                self.blocks.append((self.at, text))
            self.text = []

    def _open(self, tag: str, attrs: str) -> None:
        if tag in INLINE:
            self._open_inline(tag, attrs)
            return
        self._flush()
        if tag in VOID:
            return
        closed = CLOSED_BY.get(tag, set()) | ({"p"} if tag not in ("li",) else set())
        node = self.nodes[self.at].closable
        while node:
            if self.nodes[node].tag in closed:
                self._leave(self.nodes[node].parent)
            node = self.nodes[self.nodes[node].parent].closable
        names, dropped, words, _ = judged(attrs) if attrs else ("", False, set(), True)
        dropped |= tag in DROPPED
        named = tag in FORMS or bool(words) and tag not in ("html", "body", "main") and not (
            tag == "article" and not words & {"comment", "reply", "ad", "ads", "sponsored", "related", "promo"}
        )
        parent = self.at
        key = f"{tag}.{' '.join(sorted(set(re.sub(r'[0-9]+', '', names).split())))}"
        if self.nodes[parent].children is None:
            self.nodes[parent].children = []
        self.nodes[parent].children.append(key)
        own = len(self.nodes)
        closable = 0 if tag in SCOPES else own if tag in CLOSABLE else self.nodes[parent].closable
        main = tag in MAIN and not dropped and not named
        self.nodes.append(Node(tag, parent, key, dropped, named, main, tag == "header", closable))
        self.opened[tag] += 1
        self.at = own

    def _open_inline(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.text.append("\n")
        elif tag in VOID or attrs.rstrip().endswith("/"):
            return
        elif self.muted:
            name, depth, node = self.muted
            self.muted = (name, depth + (tag == name), node)
        elif attrs:
            # Words in a text may be marked by kind (a comment in code): an inline part has no other name.
            _, dropped, words, only = judged(attrs)
            if dropped or (words and only):
                self.muted = (tag, 1, self.at)

    def _leave(self, node: int) -> None:
        """The elements up to `node` are closed."""
        while self.at != node:
            self.opened[self.nodes[self.at].tag] -= 1
            self.at = self.nodes[self.at].parent
        if self.muted and self.at < self.muted[2]:
            self.muted = None

    def _close(self, tag: str) -> None:
        if tag in INLINE:
            if self.muted and self.muted[0] == tag:
                name, depth, node = self.muted
                self.muted = (name, depth - 1, node) if depth > 1 else None
            return
        self._flush()
        if not self.opened[tag]:
            return
        node = self.at
        if tag == "p":
            node = self.nodes[node].closable
            while node and self.nodes[node].tag != "p":
                node = self.nodes[self.nodes[node].parent].closable
        else:
            while node and self.nodes[node].tag != tag:
                node = self.nodes[node].parent
        if node:
            self._leave(self.nodes[node].parent)

    def main_text(self) -> tuple[list[tuple[list[int], bool, str]], list[tuple[int, int]]]:
        """(branches, is a title, text) of the blocks of the article, and (branch, arrangement of its children)."""
        nodes = self.nodes
        for node in nodes[1:]:
            if node.main:
                above = node.parent
                while above > 0 and not nodes[above].holds_main:
                    nodes[above].holds_main = True
                    above = nodes[above].parent
        chars = [0] * len(nodes)
        for at, text in self.blocks:
            chars[at] += len(text)
        for k in range(len(nodes) - 1, 0, -1):
            chars[nodes[k].parent] += 0 if nodes[k].dropped else chars[k]
        # A node's branch is itself, or the one above if it is an outer element or too deep.
        gone, inside, branch, depth, hashed = [False], [False], [0], [0], [0]
        for k, node in enumerate(nodes[1:], 1):
            up = node.parent
            # A page's wrapper may be named after a part it holds; what holds the article, or most of the text, is not that part.
            own = (
                (node.dropped and not (node.holds_main and node.tag not in DROPPED))
                or (node.named and not node.holds_main and 2 * chars[k] <= chars[0])
                or (node.header and not inside[up] and not node.holds_main)
            )
            gone.append(gone[up] or own)
            inside.append(inside[up] or (node.main and not gone[-1]))
            path = hashed[up].to_bytes(8, "big", signed=True) + node.key.encode("utf-8", "surrogatepass")
            hashed.append(int.from_bytes(xxhash.xxh3_64_digest(path), "big", signed=True))
            outer = node.tag in ("html", "body", "article", "main") or depth[branch[up]] >= DEEPEST
            branch.append(branch[up] if outer else k)
            depth.append(0 if outer else depth[branch[up]] + 1)
        sizes = [0, 0]
        for at, text in self.blocks:
            sizes[inside[at]] += 0 if gone[at] else len(text)
        # Articles beside far more text that is no named part are teasers; <main> is what it says.
        only_main = any(inside) and (sizes[0] <= 2 * sizes[1] or any(node.main and node.tag == "main" for node in nodes))

        def path_of(at: int) -> list[int]:
            found, b = [], branch[at]
            while b:
                found.append(hashed[b])
                b = branch[nodes[b].parent]
            return found[::-1]

        kept = [
            (path_of(at), nodes[at].tag == "h1", text)
            for at, text in self.blocks
            if not gone[at] and (inside[at] or not only_main)
        ]
        styles = [
            (hashed[k], int.from_bytes(xxhash.xxh3_64_digest(" ".join(node.children).encode("utf-8", "surrogatepass")), "big", signed=True))
            for k, node in enumerate(nodes)
            if k and node.children and not gone[k] and branch[k] == k
        ]
        return kept, styles


def parse_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, the blocks of the article and the arrangements of its branches."""
    kinds = [
        pa.list_(pa.struct([("branches", pa.list_(pa.int64())), ("title", pa.bool_()), ("text", pa.string())])),
        pa.list_(pa.struct([("branch", pa.int64()), ("style", pa.int64())])),
    ]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, styles = [], []
            for source in batch.column("html").to_pylist():
                found, arranged = Page(source or "").main_text()
                blocks.append([{"branches": b, "title": t, "text": x} for b, t, x in found])
                styles.append([{"branch": b, "style": s} for b, s in dict.fromkeys(arranged)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(blocks, kinds[0]), pa.array(styles, kinds[1])],
                ["page_id", "url", "blocks", "styles"],
            )

    narrow = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return narrow.mapInArrow(parse, PARSED)


def low_branches(parsed: DataFrame, settings: TreeSettings) -> DataFrame:
    """(host, branch) of the style tree whose importance is below the least."""
    sited = parsed.filter("host <> ''").withColumn("body", F.xxhash64("blocks"))
    texts = F.array_distinct(F.flatten(F.transform("blocks", lambda b: F.transform(
        b["branches"], lambda branch: F.struct(branch.alias("branch"), F.xxhash64(b["text"]).alias("value"))
    ))))
    pages = sited.select("host", "body", F.explode(F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["branches"])))).alias("branch"))
    pages = pages.distinct().groupBy("host", "branch").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= settings.least_pages)

    def sums(values: DataFrame) -> DataFrame:
        """Per branch, before any join: how many values, on how many pages in all, and their sums of logarithms."""
        counts = values.distinct().groupBy("host", "branch", "value").agg(F.count(F.lit(1)).alias("n"))
        return counts.groupBy("host", "branch").agg(
            F.count(F.lit(1)).alias("values"), F.sum("n").alias("total"), F.sum(F.log("n")).alias("logs"),
            F.sum(F.col("n") * F.log("n")).alias("weighted"),
        )

    size = F.log("pages")
    content = sums(sited.select("host", "body", F.explode(texts).alias("x")).select("host", "body", "x.branch", "x.value"))
    # A text on n of the branch's pages has the entropy log n in the base of its pages.
    content = content.join(pages, ["host", "branch"]).select("host", "branch", "pages", (1 - F.col("logs") / F.col("values") / size).alias("content"))
    shapes = sums(sited.select("host", "body", F.explode("styles").alias("x")).select("host", "body", "x.branch", F.col("x.style").alias("value")))
    # The sum of -n/pages * log(n/pages).
    entropy = (F.col("total") * size - F.col("weighted")) / (F.col("pages") * size)
    shapes = shapes.join(pages, ["host", "branch"]).select("host", "branch", entropy.alias("presentation"))
    weight = settings.presentation
    importance = weight * F.coalesce("presentation", F.lit(0.0)) + (1 - weight) * F.col("content")
    return content.join(shapes, ["host", "branch"], "left").filter(importance < settings.least_importance).select("host", "branch")


def extract_text(pages: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    parsed = materialise(parse_pages(pages).withColumn("host", host), "parsed-pages", keep=True)
    low = low_branches(parsed, settings).groupBy("host").agg(F.collect_set("branch").alias("low"))
    joined = lookup_join(parsed.select("page_id", "url", "host", "blocks"), materialise(low, "low-branches", keep=True), ["host"], "left")
    left = F.filter("blocks", lambda b: b["title"] | ~F.coalesce(F.arrays_overlap(b["branches"], "low"), F.lit(False)))
    kept = F.when(F.size(left) == 0, F.col("blocks")).otherwise(left)
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
