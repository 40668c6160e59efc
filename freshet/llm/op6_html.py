"""Main text of web pages by wrapper induction.

Pages of one host are made by one wrapper. Each page is read into a DOM; its
layout tree keeps the block elements (tag and class) and folds siblings of equal
structure, so a layout is small however long the page is (see below). Per host

1. the most frequent layout is the reference;
2. every other layout is aligned with it by simple tree matching (the largest
   order-keeping set of node pairs with equal labels whose parents are paired);
3. the texts of aligned nodes are compared over all pages of the host: one that
   varies, or that only copies of one page have, is a slot;
4. the content region is the article element with most slot text, or else the
   smallest subtree with all slots; menus, headers, footers, sidebars, notices,
   adverts, forms and comments (told by element and class) are no part of it.

A page's text is its region's blocks without the template: blocks that recur in
their place on at least ``LEAST_PAGES`` pages of their own and on at least half of
those that have the place. Equal siblings share a place, so a constant paragraph
beside varying ones is told by its text. A page is one of its own if at least
``OWN_SHARE`` of its region's blocks are on no other page of the host: copies, and
near copies, are no evidence. The rule is the same for hosts of any size; on a host
with fewer pages of their own nothing is template, as a repeat may be chance. A page
whose layout has no counterpart of the region is read from its own article, or
else its body.

Class names help, but do not decide alone: they are read as whole words or by their
closing word, a name that says what is absent or what the page has (no-comments,
has-sidebar) counts for nothing, and html, body, the article and what lies around
it are never chrome. A layout's labels leave out words with digits, and an element
with over ``KINDS`` kinds of children is told by their elements alone.

What moves between tasks are counts per (host, layout, node), combined in each
task first, and hashes of the blocks of pages that differ; html itself is only
joined with the small table of layouts by (host, layout). A host with a third of all pages is no group anywhere.

Defined cases: a null or empty html has the empty text; a null url is the host
""; unclosed elements are closed as browsers do; character references are
decoded, also without a semicolon where HTML allows it; repeated rows are read
each; very long pages are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table
from freshet.operators.materialize import materialize

LEAST_PAGES = 3  # so many pages of their own have to agree before a block is template
OWN_SHARE = 0.25  # of a page's blocks no other page has, if it is a page of its own
DEPTH = 150  # elements nested deeper lie flat in the last one
KINDS = 64  # more kinds of siblings than this are told by their element alone

# HTML's element kinds.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
CLOSED_BY_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"html", "body", "article", "section", "div", "table", "ul", "ol", "dl", "td", "th", "main", "aside", "nav", "header", "footer", "form", "blockquote"}
# What is never main text: elements, and words of class, id and role.
CHROME = {"head", "nav", "footer", "aside", "form", "button", "select", "object", "svg", "canvas", "dialog", "menu", "input"} | RAW
CHROME_WORDS = {
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie",
    "cookies", "disqus", "footer", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "related", "replies",
    "respond", "share", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "complementary", "contentinfo", "search", "alert",
}
# A name that begins so says what is not there, or what a page as a whole has.
NEGATIONS = {"has", "with", "no", "non", "without", "not", "hide", "is"}
# What a chrome word may be followed by.
PART_WORDS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "column", "container", "content", "form", "group", "header", "icon", "icons", "inner",
    "item", "items", "label", "left", "link", "links", "list", "main", "outer", "panel", "primary", "right", "row", "secondary", "section", "slot", "title", "top", "unit",
    "widget", "widgets", "wrap", "wrapper",
}
MAIN = ("article", "main")

_TAG = re.compile(r"<(?:!--(?P<c>.*?)(?:-->|\Z)|[!?][^>]*>|/(?![a-zA-Z])[^>]*>|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]{0,65536}\"|'[^']{0,65536}')*+|[^>]*)>)", re.S)
_CUT = re.compile(r"<[a-zA-Z/!?].*", re.S)  # a tag or comment the page ends in
_ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def _is_chrome(token: str) -> bool:
    """A class, id or role that names chrome: the whole of it, its closing word
    (main-sidebar, but not has-sidebar or ad-free), or its opening one if only words
    for parts and numbers follow (footer-widgets, but not alert-level)."""
    words = _WORD.findall(token)
    if not words or words[0] in NEGATIONS:
        return False
    return words[-1] in CHROME_WORDS or words[0] in CHROME_WORDS and all(w in PART_WORDS or w.isdigit() for w in words[1:])


class Node:
    __slots__ = ("tag", "label", "named", "chrome", "kids", "place")

    def __init__(self, tag: str, attrs: str = ""):
        found = [(k.lower(), (a or b or c).lower()) for k, a, b, c in _ATTR.findall(attrs)] if "=" in attrs else []
        # Words with digits number an element (post-4711); they are no kind.
        classes = ".".join(w for k, v in found if k == "class" for w in _WORD.findall(v) if w.isalpha())
        self.tag, self.label = tag, f"{tag}.{classes}" if classes else tag
        self.named = tag not in ("html", "body") and any(_is_chrome(t) for _, v in found for t in v.split())
        self.chrome = tag in CHROME or self.named
        self.kids: list = []  # nodes and texts
        self.place = -1


def _spare(root: Node) -> None:
    """What holds the page's text is no chrome, whatever it is called: an element
    around all article and main elements, and these themselves if all of them are
    called so (one of several may be a reader's comment)."""
    mains: list[tuple[Node, list[Node]]] = []
    todo = [(root, [])]
    while todo:
        n, above = todo.pop()
        if n.tag in MAIN:
            mains.append((n, above))
        if n.tag not in CHROME:
            todo += [(k, [*above, n] if n.named or n.tag in MAIN else above) for k in n.kids if not isinstance(k, str)]
    good = [m for m in mains if not m[0].named] or mains
    for n, _ in good:
        n.chrome = False
    around = [{id(x): x for x in above} for _, above in good]
    for i, n in (around[0] if around else {}).items():
        if all(i in others for others in around):
            n.chrome = False


def parse(html: str) -> Node:
    """The DOM below one root; raw text elements stay empty."""
    root = Node("#root")
    stack, at = [root], 0

    def close(names: set, scopes: set) -> None:
        """Close up to the nearest open element of ``names`` within its scope."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in scopes:
                return

    last = html.rfind(">")  # no tag or comment is closed after it
    while at < len(html):
        m = _TAG.search(html, at) if at <= last else None
        if m is None:
            stack[-1].kids.append(_CUT.sub("", html[at:]))
            break
        if m.start() > at:
            stack[-1].kids.append(html[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            close({tag}, () if tag in SCOPES or tag in ("p", "head") else SCOPES)
            continue
        if tag in CLOSES_P:
            close({"p"}, SCOPES)
        if tag in CLOSED_BY_LIKE:
            close(CLOSED_BY_LIKE[tag], SCOPES - CLOSED_BY_LIKE[tag])
        node = Node(tag, m["attrs"])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID and not m["attrs"].endswith("/") and len(stack) < DEPTH:
            stack.append(node)
    _spare(root)
    return root


def blocks(node: Node, in_main: bool = False) -> Iterator[tuple[int, str]]:
    """(layout place, text) of the blocks below ``node``, without chrome; white
    space inside a block is one space."""
    held: list[str] = []

    def flush(place: int) -> Iterator[tuple[int, str]]:
        text = " ".join(html_lib.unescape("".join(held)).split())
        held.clear()
        if text:
            yield place, text

    def walk(n: Node, place: int, main: bool) -> Iterator[tuple[int, str]]:
        for kid in n.kids:
            if isinstance(kid, str):
                held.append(kid)
            elif kid.chrome or kid.tag == "header" and not main:
                if kid.tag not in INLINE:
                    yield from flush(place)
            elif kid.tag in ("br", "wbr", "img"):
                held.append(" ")
            elif kid.tag in INLINE:
                yield from walk(kid, place, main)
            else:
                yield from flush(place)
                yield from walk(kid, kid.place, main or kid.tag in MAIN)
                yield from flush(kid.place)

    yield from walk(node, node.place, in_main or node.tag in MAIN)
    yield from flush(node.place)


def layout(root: Node) -> str:
    """The layout tree as text, label(child,child); sets every block element's
    place, its number in that tree in document order."""

    def shape(n: Node) -> tuple:
        kids: dict[tuple, list[Node]] = {}
        todo = n.kids[::-1]
        while todo:
            kid = todo.pop()
            if isinstance(kid, str):
                continue
            if kid.tag in INLINE:
                todo += kid.kids[::-1]
            elif not kid.chrome or kid.tag not in CHROME:
                form, made = shape(kid)
                kids.setdefault(form, []).append((kid, made))
        if len(kids) > KINDS:
            plain: dict[str, list] = {}
            for kid, _ in (k for of in kids.values() for k in of):
                plain.setdefault(kid.tag, []).append((kid, None))
            kids = plain
        text = f"{n.label}({','.join(kids)})" if kids else n.label
        return text, kids

    text, kids = shape(root)
    count = [0]

    def flatten(n: Node, place: int) -> None:
        """What lies below an element of too many kinds shares its place."""
        for kid in n.kids:
            if not isinstance(kid, str) and not (kid.chrome and kid.tag in CHROME):
                kid.place = place if kid.tag not in INLINE else -1
                flatten(kid, place)

    def number(nodes: list, text: str) -> None:
        """Equal siblings share their places."""
        place = count[0]
        count[0] += 1
        merged: dict[str, list] = {}
        for node, inner in nodes:
            node.place = place
            if inner is None:
                flatten(node, place)
            for form, below in (inner or {}).items():
                merged.setdefault(form, []).extend(below)
        for form, below in merged.items():
            number(below, form)

    number([(root, kids)], text)
    return text


class Layout:
    """A layout tree read back: labels, children and chrome by place."""

    def __init__(self, text: str):
        self.label: list[str] = []
        self.kids: list[list[int]] = []
        stack: list[int] = []
        for label, mark in re.findall(r"([^(),]+)|([(),])", text):
            if label:
                if stack:
                    self.kids[stack[-1]].append(len(self.label))
                self.label.append(label)
                self.kids.append([])
            elif mark == "(":
                stack.append(len(self.label) - 1)
            elif mark == ")":
                stack.pop()

    def tag(self, i: int) -> str:
        return self.label[i].partition(".")[0]


def match_trees(a: Layout, b: Layout) -> dict[int, int]:
    """Simple tree matching: places of ``a`` to places of ``b``."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def best(i: int, j: int) -> int:
        """Size of the largest matching of the subtrees, roots paired."""
        if a.label[i] != b.label[j]:
            return 0
        if (i, j) not in memo:
            rows, cols = a.kids[i], b.kids[j]
            m = [[0] * (len(cols) + 1) for _ in range(len(rows) + 1)]
            for x, p in enumerate(rows):
                for y, q in enumerate(cols):
                    m[x + 1][y + 1] = max(m[x][y + 1], m[x + 1][y], m[x][y] + best(p, q))
            memo[i, j] = 1 + m[-1][-1], m
        return memo[i, j][0]

    pairs: dict[int, int] = {}

    def trace(i: int, j: int) -> None:
        pairs[i] = j
        rows, cols, m = a.kids[i], b.kids[j], memo[i, j][1]
        x, y = len(rows), len(cols)
        while x and y:
            if m[x][y] == m[x - 1][y]:
                x -= 1
            elif m[x][y] == m[x][y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                trace(rows[x], cols[y])

    if best(0, 0):
        trace(0, 0)
    return pairs


def _hash(texts: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b("\n".join(texts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


_KEPT = 50_000  # (host, layout, node) a task counts before it gives them out
_COUNTS = "host string, layout string, place int, pages long, chars long, low long, high long, first long, last long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, list[int]] = {}

    def out() -> pa.RecordBatch:
        rows = [(*k, *v) for k, v in held.items()]
        held.clear()
        types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=_COUNTS.replace(",", "").split()[::2])

    for b in batches:
        for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            root = parse(html or "")
            form = layout(root)
            texts: dict[int, list[str]] = {0: []}
            for place, text in blocks(root):
                texts.setdefault(place, []).append(text)
            page = _hash([t for found in texts.values() for t in found])
            for place, found in texts.items():
                h, n = _hash(found), sum(map(len, found))
                s = held.setdefault((host, form, place), [0, 0, h, h, page, page])
                s[:] = s[0] + 1, s[1] + n, min(s[2], h), max(s[3], h), min(s[4], page), max(s[5], page)
        if len(held) > _KEPT:
            yield out()
    yield out()


_TEXTS = "host string, layout string, places array<int>, texts array<long>"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's blocks: their places and the hashes of their texts; what a
    task has given out it does not give again."""
    given: set[int] = set()
    types = [pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    for b in batches:
        rows = []
        for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            root = parse(html or "")
            form = layout(root)
            found = [(place, _hash([text])) for place, text in blocks(root)]
            key = _hash([host, form, str(found)])
            if key not in given:
                given.add(key)
                rows.append((host, form, [p for p, _ in found], [t for _, t in found]))
        if len(given) > _KEPT:
            given.clear()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["host", "layout", "places", "texts"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, layout, place) to the reference's place, -1 for none, and to the
    place behind the last one below it."""
    for b in batches:
        to, end = [], []
        for form, reference, place in zip(*(b.column(c).to_pylist() for c in ("layout", "reference", "place"))):
            tree = Layout(form)
            pairs = match_trees(tree, Layout(reference))
            to.append([pairs.get(p, -1) for p in place])
            behind = [p + 1 for p in place]
            for p in reversed(place):
                behind[p] = behind[tree.kids[p][-1]] if tree.kids[p] else p + 1
            end.append(behind)
        yield pa.RecordBatch.from_arrays([b.column("host"), b.column("layout"), b.column("reference"), b.column("place"), pa.array(to, pa.list_(pa.int32())), pa.array(end, pa.list_(pa.int32()))], names=["host", "layout", "reference", "place", "to", "end"])


def _choose(pdf: pd.DataFrame) -> pd.DataFrame:
    """A host's region among its reference's places."""
    tree = Layout(pdf["reference"].iloc[0])
    stats = {r.to: r for r in pdf.itertuples()}
    # Nothing tells text and template of a single page, or of its copies, apart.
    slot = {p: r.chars if r.low != r.high or r.first == r.last else 0 for p, r in stats.items()}

    def mass(i: int) -> int:
        return slot.get(i, 0) + sum(map(mass, tree.kids[i]))

    mains = [i for i in range(len(tree.label)) if tree.tag(i) in MAIN]
    if mains:
        region = max(mains, key=lambda i: (mass(i), -i))
    else:
        region = 0
        while not slot.get(region) and len(below := [k for k in tree.kids[region] if mass(k)]) == 1 and tree.kids[below[0]]:
            region = below[0]
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "region": [region]})


def host_of(url) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def _template(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, template): the (at, text) of the blocks in a host's reference places
    that at least LEAST_PAGES pages of their own have, and half of those that have
    the place. A page is one of its own if OWN_SHARE of its region's blocks are on
    no other page of the host, so copies and near copies are no evidence."""
    met = pages.mapInArrow(_texts, _TEXTS).join(wrappers.where("region is not null"), ["host", "layout"])
    inside = F.filter(F.arrays_zip("places", "texts"), lambda p: (p["places"] >= F.col("region")) & (p["places"] < F.col("end")))
    met = met.select("host", "to", inside.alias("inside")).withColumn("page", F.xxhash64("inside"))
    texts = F.transform("inside", lambda p: F.struct(F.element_at("to", p["places"] + 1).alias("at"), p["texts"].alias("text")))
    met = met.select("host", "page", F.explode(F.array_distinct(texts)).alias("t")).select("host", "page", "t.at", "t.text")
    met = materialize(met.where("at >= 0").distinct(), "template-blocks")
    often = met.groupBy("host", "at", "text").agg(F.count("*").alias("n")).where("n > 1")
    shared = met.join(materialize(often.drop("n"), "template-often"), ["host", "at", "text"], "left_semi")
    shared = materialize(shared, "template-shared")
    every = met.groupBy("host", "page").agg(F.count("*").alias("all"))
    again = shared.groupBy("host", "page").agg(F.count("*").alias("again"))
    own = every.join(again, ["host", "page"], "left").where(F.coalesce("again", F.lit(0)) <= F.col("all") * (1 - OWN_SHARE)).select("host", "page")
    own = materialize(own, "template-pages")
    mine = lambda rows: rows.join(own, ["host", "page"], "left_semi")
    counts = mine(shared).groupBy("host", "at", "text").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES)
    reach = mine(met.select("host", "page", "at").distinct()).groupBy("host", "at").agg(F.count("*").alias("reach"))
    fixed = counts.join(reach, ["host", "at"]).where("2 * n >= reach")
    return fixed.groupBy("host").agg(F.collect_list(F.struct("at", "text")).alias("template"))


def induce(pages: DataFrame) -> DataFrame:
    """(host, layout, region, fixed): for every layout of a host its place of
    the region (null if there is none) and the template's (place, text)."""
    keyed = pages.select(host_of(F.col("url")).alias("host"), "html")
    totals = [F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), *[f(c).alias(c) for c, f in (("low", F.min), ("high", F.max), ("first", F.min), ("last", F.max))]]
    counts = materialize(keyed.mapInArrow(_count, _COUNTS).groupBy("host", "layout", "place").agg(*totals), "layout-counts")
    layouts = counts.where("place = 0").select("host", "layout", "pages")  # each page counts its root
    reference = layouts.groupBy("host").agg(F.max_by("layout", F.struct("pages", "layout")).alias("reference"))
    sizes = F.size(F.regexp_extract_all("layout", F.lit("[^(),]+"), 0))
    asked = layouts.join(reference, "host").select("host", "layout", "reference", F.sequence(F.lit(0), sizes - 1).alias("place"))
    aligned = materialize(asked.mapInArrow(_align, "host string, layout string, reference string, place array<int>, to array<int>, end array<int>"), "layouts")

    pairs = aligned.select("host", "layout", "reference", F.explode(F.arrays_zip("place", "to")).alias("p")).select("host", "layout", "reference", "p.place", "p.to")
    slots = counts.join(pairs.where("to >= 0"), ["host", "layout", "place"]).groupBy("host", "reference", "to").agg(*totals)
    chosen = slots.groupBy("host").applyInPandas(_choose, "host string, region int")
    region = F.nullif(F.array_position("to", F.col("region")), F.lit(0))  # from 1
    wrappers = aligned.join(chosen, "host").select("host", "layout", "to", "end", region.cast("int").alias("region"))
    wrappers = materialize(wrappers.select("host", "layout", "to", (F.col("region") - 1).alias("region"), F.try_element_at("end", "region").alias("end")), "regions")

    fixed = F.transform("template", lambda t: F.struct((F.array_position("to", t["at"]) - 1).cast("int").alias("place"), t["text"].alias("text")))
    fixed = F.filter(fixed, lambda p: p["place"] >= 0)
    return wrappers.join(_template(keyed, wrappers), "host", "left").select("host", "layout", "region", fixed.alias("fixed"))


def _own_region(root: Node) -> Node:
    """The page's first article or main element, or else its body, or all."""
    for tags in (MAIN, ("body",)):
        todo = deque([root])
        while todo:
            n = todo.popleft()
            if n.tag in tags:
                return n
            todo += [k for k in n.kids if not isinstance(k, str) and not k.chrome]
    return root


def _at(root: Node, place: int) -> list[Node]:
    """The topmost elements of a place, in document order."""
    if root.place == place:
        return [root]
    return [n for k in root.kids if not isinstance(k, str) and not (k.chrome or k.place < 0 and k.tag not in INLINE) for n in _at(k, place)]


def main_text(html: str | None, region: int | None, fixed: list[dict] | None) -> str:
    root = parse(html or "")
    layout(root)
    regions = _at(root, region) if region is not None else []
    if not regions:
        regions = [_own_region(root)]
    skip = {(f["place"], f["text"]) for f in fixed or ()}
    return "\n".join(text for n in regions for place, text in blocks(n) if not skip or (place, _hash([text])) not in skip)


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        forms = pa.array([layout(parse(h or "")) for h in b.column("html").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns, forms], names=[*b.schema.names, "layout"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(*row) for row in zip(*(b.column(c).to_pylist() for c in ("html", "region", "fixed")))]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of ``pages`` (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    wrappers = materialize(induce(pages), "wrappers")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    formed = pages.withColumn("host", host_of(F.col("url"))).mapInArrow(_layouts, f"page_id {kinds['page_id']}, url string, html string, host string, layout string")
    joined = formed.join(wrappers, ["host", "layout"], "left").select("page_id", "url", "html", "region", "fixed")
    return joined.mapInArrow(_extract, f"page_id {kinds['page_id']}, url string, text string, n_chars long")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


QUERIES = {"op6_html": op6_html}
