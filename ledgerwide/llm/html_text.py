"""Main text of web pages by wrapper induction.

A page becomes its block-level DOM tree, in which neighbouring siblings of one label are one
node, and its blocks of text. Per host the commonest tree is the exemplar; every other tree of
that host is aligned with it by simple tree matching, and each text is counted at the exemplar's
nodes over the host's different pages. A text that (nearly) all pages with its node share is
template, other texts are content. The content root is the page's own article or main element,
or else the host's: an article, main, or the node that holds most of the varying text outside
links. The varying texts in it are the page's text, without nodes that their own tag, class, id
or role calls a menu, header, footer, sidebar, notice, advert, form or comments.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.llm.tables import stored
from ledgerwide.llm.trees import Matcher, Tree
from ledgerwide.llm.words import text_slices

ALWAYS_SAME = 5  # different pages that need to share a text before it counts as template
CONSTANT = 95  # percent of the pages with a slot that need to share it; pages cut short may lack it
MOST = 0.8  # share of the varying text that a child needs to be the content root instead

#: Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "select", "object"}
BLOCK = set(
    "html head body article section main nav header footer aside form fieldset div p ul ol li dl dt dd "
    "table thead tbody tfoot tr td th caption h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption address "
    "details summary dialog menu hgroup button".split()
)
CLOSES_P = BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"} | {"hr"}
ONE_AT_A_TIME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = {"ul", "ol", "dl", "table", "body", "html", "menu"}
BOILER_TAGS = {"head", "nav", "footer", "aside", "form", "fieldset", "menu", "button", "dialog"}
BOILER_WORDS = set(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments "
    "disqus reply replies share sharing social related recommended newsletter subscribe signup login search pagination "
    "pager widget popup modal overlay toolbar skip complementary contentinfo hidden".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z|<[a-zA-Z][^>]*>",
    re.S,
)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\shidden(?=[\s=/]|\Z)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


class Node:
    __slots__ = ("label", "children", "place")

    def __init__(self, label: str) -> None:
        self.label, self.children, self.place = label, [], -1

    def child(self, label: str) -> Node:
        """The last child if it has this label, else a new one."""
        if not self.children or self.children[-1].label != label:
            self.children.append(Node(label))
        return self.children[-1]


def _label(tag: str, attributes: str) -> str:
    if not attributes or attributes.isspace():
        return tag
    words: set[str] = set()
    for m in NAMES.finditer(attributes):
        words.update(w for w in re.split(r"[^a-z]+", (m[2] or m[3] or m[4] or "").lower()) if w)
    if HIDDEN.search(attributes):
        words.add("hidden")
    return ".".join([tag, *sorted(words)])


def parse(page: str) -> tuple[Node, list[tuple[Node, str, int]]]:
    """Block tree of a page and its blocks: node, text, characters inside links."""
    root = Node("#")
    stack: list[tuple[str, Node]] = [("#", root)]
    blocks: list[tuple[Node, str, int]] = []
    run: list[str] = []
    opened: Counter = Counter("#")  # spares walks through the stack for tags that are not open
    links = in_link = at = 0

    def flush() -> None:
        nonlocal links
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                blocks.append((stack[-1][1], text, min(links, len(text))))
            run.clear()
        links = 0

    def close(index: int) -> None:
        flush()
        opened.subtract(t for t, _ in stack[index:])
        del stack[index:]

    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece:
            run.append(piece)
            links += len(piece) * bool(in_link)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                in_link = 0
            elif tag in BLOCK and opened[tag]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
            continue
        if tag in RAW:
            done = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = done.end() if done else end
        elif tag == "a":
            in_link = 1
        elif tag in ("br", "hr"):
            run.append(" ")
        elif tag in BLOCK:
            flush()
            in_link = 0
            if tag in CLOSES_P and opened["p"]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in SCOPE or stack[k][0] in ("td", "th"):
                        break
            if tag in ONE_AT_A_TIME and any(opened[t] for t in ONE_AT_A_TIME[tag]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in ONE_AT_A_TIME[tag]:
                        close(k)
                        break
                    if stack[k][0] in SCOPE:
                        break
            if not (tag in ("html", "body") and opened[tag]):
                stack.append((tag, stack[-1][1].child(_label(tag, m[3] or ""))))
                opened[tag] += 1
    flush()
    return root, blocks


def numbered(root: Node) -> list:
    """The tree as a flat list of depth, label, depth, label, ... of its nodes, numbered in that order."""
    flat: list = []
    waiting = [(0, root)]
    while waiting:
        depth, node = waiting.pop()
        node.place = len(flat) // 2
        flat += [depth, node.label]
        waiting += [(depth + 1, c) for c in reversed(node.children)]
    return flat


def tree_of(flat: list) -> Tree:
    return Tree(flat[::2], flat[1::2])


def match_trees(a: list, b: list) -> list[tuple[tuple, tuple]]:
    """Simple tree matching of small nested lists [label, child, ...], as pairs of paths."""
    trees, paths = [], []
    for nested in (a, b):
        flat, named = [], []
        waiting = [((), nested)]
        while waiting:
            path, node = waiting.pop()
            flat += [len(path), node[0]]
            named.append(path)
            waiting += [((*path, k), c) for k, c in reversed(list(enumerate(node[1:], 1)))]
        trees.append(tree_of(flat))
        paths.append(named)
    return [(paths[0][x], paths[1][y]) for x, y in Matcher(*trees).pairs()]


def _boiler(label: str, in_article: bool) -> bool:
    tag, *words = label.split(".")
    return tag in BOILER_TAGS or tag == "header" and not in_article or bool(BOILER_WORDS & set(words))


def placed(flat: list, like: list) -> tuple[list[int], list[int], list[int]]:
    """For each node of a tree: its slot, the exemplar's node that it hangs from, and its use.

    A slot is the number of the exemplar's node that the node is aligned with, or else a negative
    hash of the node's own path, so that nodes the exemplar lacks meet their like on other pages.
    Use: 0 never content, 1 inside the page's own article, 2 content if the host's root holds it.
    """
    tree = tree_of(flat)
    size = range(len(tree.labels))
    to = {k: k for k in size} if flat == like else {y: x for x, y in Matcher(tree_of(like), tree).pairs()}
    boiler = _judged(tree)
    marked = [l.split(".")[0] in ("article", "main") and not b for l, b in zip(tree.labels, boiler)]
    any_marked, inside = any(marked), list(marked)
    names: list[bytes] = []
    met: dict[tuple[int, str], int] = {}
    anchors: list[int] = []
    slots, uses = [], []
    for k, label in enumerate(tree.labels):
        up = tree.parent[k]
        if up >= 0 and inside[up]:
            inside[k] = True
        nth = met[up, label] = met.get((up, label), 0) + 1
        above = names[up] if up >= 0 else b""
        names.append(hashlib.blake2b(above + f"/{label}:{nth}".encode(), digest_size=8).digest())
        anchors.append(to.get(k, anchors[up] if up >= 0 else 0))
        slots.append(to.get(k, -1 - (int.from_bytes(names[k]) >> 1)))
        uses.append(0 if boiler[k] or any_marked and not inside[k] else 1 if any_marked else 2)
    return slots, anchors, uses


def _judged(tree: Tree) -> list[bool]:
    boiler: list[bool] = []
    article: list[bool] = []
    for label, up in zip(tree.labels, tree.parent):
        inside = up >= 0 and article[up]
        article.append(inside or label.split(".")[0] in ("article", "main"))
        boiler.append(up >= 0 and boiler[up] or _boiler(label, inside))
    return boiler


def content_root(flat: list, varying: dict[int, int]) -> tuple[int, int]:
    """First node of the host's content root and the first one after it, by the exemplar's numbers.

    ``varying``: characters outside links at each node, without texts that stay constant.
    """
    tree = tree_of(flat)
    boiler = _judged(tree)
    weight = [0 if b else varying.get(k, 0) for k, b in enumerate(boiler)]
    depth = [0] * len(boiler)
    for k, up in enumerate(tree.parent):
        depth[k] = depth[up] + 1 if up >= 0 else 0
    for k in range(len(weight) - 1, 0, -1):
        weight[tree.parent[k]] += weight[k]
    tags = [l.split(".")[0] for l in tree.labels]
    named = [k for tag in ("article", "main") for k, t in enumerate(tags) if t == tag and not boiler[k]]
    if named:
        root = max(named, key=lambda k: (weight[k], -depth[k]))
    else:
        root = 0
        while inner := [c for c in tree.children[root] if weight[root] and weight[c] >= MOST * weight[root]]:
            root = inner[0]
    return root, tree.end[root]


SAME = "array<struct<node: int, texts: array<bigint>>>"
PARSED = "page_id long, url string, host string, tree string, blocks array<struct<node: int, text: string, linked: int, fresh: boolean>>"


def _parsed(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string()), ("linked", pa.int32()), ("fresh", pa.bool_())]))
        for batch in text_slices(batches):
            trees, rows = [], []
            for page in batch.column(3).to_pylist():
                root, blocks = parse(page or "")
                trees.append(json.dumps(numbered(root), ensure_ascii=False, separators=(",", ":")))
                met: set[tuple[int, str]] = set()
                row = []
                for n, t, k in blocks:
                    row.append({"node": n.place, "text": t, "linked": k, "fresh": (n.place, t) not in met})
                    met.add((n.place, t))
                rows.append(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(trees), pa.array(rows, block)],
                ["page_id", "url", "host", "tree", "blocks"],
            )

    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), host.alias("host"), F.col("html").cast("string")]
    return pages.select(*columns).mapInArrow(run, PARSED)


def _aligned(spark: SparkSession, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, shape, slots, anchors, uses) of every different tree, and (host, exemplar).

    A host's exemplar is the tree of the most pages, of several the first by its text. Each tree
    is one row beside its exemplar, so a host of very many trees is split over tasks.
    """
    trees = parsed.groupBy("host", F.xxhash64("tree").alias("shape")).agg(F.min("tree").alias("tree"), F.count("*").alias("pages"))
    trees = stored(spark, trees, "trees")
    best = F.min(F.struct((-F.col("pages")).alias("minus"), "tree"))
    exemplars = stored(spark, trees.groupBy("host").agg(best.alias("b")).select("host", F.col("b.tree").alias("exemplar")), "exemplars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            columns: list[list] = [[], [], []]
            for tree, exemplar in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                for column, values in zip(columns, placed(json.loads(tree), json.loads(exemplar))):
                    column.append(values)
            kinds = pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, columns, kinds)],
                ["host", "shape", "slots", "anchors", "uses"],
            )

    both = trees.join(exemplars, "host").select("host", "shape", "tree", "exemplar")
    schema = "host string, shape long, slots array<long>, anchors array<int>, uses array<int>"
    return stored(spark, both.mapInArrow(run, schema), "aligned"), exemplars


def _roots(exemplars: DataFrame, varying: DataFrame) -> DataFrame:
    """(host, lo, hi): the content root of every host as a range of its exemplar's nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = [
                content_root(json.loads(tree), {v["slot"]: v["free"] for v in free or []})
                for tree, free in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            ends = [pa.array([f[k] for f in found], pa.int32()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *ends], ["host", "lo", "hi"])

    # Slots from 0 are nodes of the exemplar: no more per host than that has.
    free = varying.where("slot >= 0").groupBy("host").agg(F.collect_list(F.struct("slot", "free")).alias("free"))
    return exemplars.join(free, "host", "left").select("host", "exemplar", "free").mapInArrow(run, "host string, lo int, hi int")


def wrappers(spark: SparkSession, parsed: DataFrame) -> DataFrame:
    """host, shape, keep (one flag per node), same (node, hashes of its constant texts) of every tree.

    Every different page of a host counts once. Texts are counted at their slot one by one, so a
    constant paragraph among varying ones is found; all counts combine on the map side.
    """
    aligned, exemplars = _aligned(spark, parsed)
    fresh = F.filter("blocks", lambda b: b["fresh"])
    pages = parsed.select(
        "host",
        F.xxhash64("tree").alias("shape"),
        F.xxhash64("tree", F.transform("blocks", lambda b: F.struct(b["node"], b["text"]))).alias("page"),
        F.transform(fresh, lambda b: b["node"]).alias("nodes"),
        F.transform(fresh, lambda b: F.xxhash64(b["text"])).alias("texts"),
        F.transform(fresh, lambda b: F.length(b["text"]) - b["linked"]).alias("free"),
    ).dropDuplicates(["host", "shape", "page"])
    slotted = pages.join(aligned.select("host", "shape", "slots"), ["host", "shape"])
    slots = F.transform("nodes", lambda n: F.get("slots", n))
    none = F.lit(None).cast("long")
    each = F.arrays_zip(slots.alias("slot"), F.col("texts").alias("text"), F.col("free"))
    each = F.transform(each, lambda e: F.struct(e["slot"].alias("slot"), e["text"].alias("text"), e["free"].cast("long").alias("free")))
    once = F.transform(F.array_distinct(slots), lambda s: F.struct(s.alias("slot"), none.alias("text"), F.lit(0).cast("long").alias("free")))
    exploded = slotted.select("host", F.explode(F.concat(each, once)).alias("e")).select("host", "e.*")
    counted = exploded.groupBy("host", "slot", "text").agg(F.count("*").alias("n"), F.sum("free").alias("free"))
    counted = stored(spark, counted, "counted")
    at_slot = counted.groupBy("host", "slot").agg(F.sum("free").alias("all"), F.max(F.when(F.col("text").isNull(), F.col("n"))).alias("pages"))
    often = counted.where(F.col("text").isNotNull() & (F.col("n") >= ALWAYS_SAME))
    often = often.join(at_slot.select("host", "slot", "pages"), ["host", "slot"]).where(100 * F.col("n") >= CONSTANT * F.col("pages"))
    # As many texts as a page can hold at one slot, whatever the number of pages.
    constant = often.groupBy("host", "slot").agg(F.sum("free").alias("fixed"), F.collect_list("text").alias("texts"))
    constant = stored(spark, constant, "constant")
    varying = at_slot.join(constant, ["host", "slot"], "left").select("host", "slot", (F.col("all") - F.coalesce("fixed", F.lit(0))).alias("free"))
    roots = stored(spark, _roots(exemplars, varying), "roots")
    nodes = aligned.select("host", "shape", F.posexplode("slots").alias("node", "slot"))
    same = nodes.join(constant, ["host", "slot"]).groupBy("host", "shape").agg(F.collect_list(F.struct("node", "texts")).alias("same"))
    keep = F.transform(
        F.arrays_zip("uses", "anchors"),
        lambda u: (u["uses"] == 1) | (u["uses"] == 2) & (u["anchors"] >= F.col("lo")) & (u["anchors"] < F.col("hi")),
    )
    ruled = aligned.join(roots, "host").join(same, ["host", "shape"], "left")
    return ruled.select("host", "shape", keep.alias("keep"), F.map_from_entries(F.coalesce("same", F.array().cast(SAME))).alias("same"))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text for every row of ``pages`` (page_id, url, html).

    Null and empty html give an empty text; null urls share one nameless host. Repeated rows
    each give theirs. Pages cut off inside a tag end before it. A host's single page is its
    own exemplar. Other columns of ``pages`` are not read.
    """
    parsed = stored(spark, _parsed(pages), "parsed-pages")
    # Written first, so its measured size decides the join before any page has moved.
    rules = stored(spark, wrappers(spark, parsed), "wrappers")
    joined = parsed.withColumn("shape", F.xxhash64("tree")).join(rules, ["host", "shape"], "left")
    constant = lambda b: F.coalesce(F.array_contains(F.try_element_at("same", b["node"]), F.xxhash64(b["text"])), F.lit(False))
    kept = F.filter("blocks", lambda b: F.coalesce(F.get("keep", b["node"]), F.lit(False)) & ~constant(b))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), " ")
    return joined.select("page_id", "url", text.alias("text"))
