"""Operator 11: main text of web pages by site style trees.

The pages of one host are merged into a style tree.  Its nodes are elements,
named by the host and the path of tags, classes, ids and roles from the top
(presentation), and below them the texts that pages show there (content).
Both kinds have an importance between 0 and 1:

* a presentation node by the entropy of its styles, the sequences of children
  that its pages show there: one style on all pages gives 0;
* a content node by the entropy of its text over the pages: a text on all
  pages gives 0, one on a single page 1.

The importance of an element is (1 - g ** l) times that of its presentation
plus g ** l times the mean of its children's, for l styles, averaged over its
pages.  As the mean over pages of a mean over children is linear, every page
computes its own part from the counts of its nodes, and one average for each
element finishes it, whatever the depth.  Branches of low importance go.

Elements that are beside the article by the standard's or by common usage
(``html_blocks``: navigation, footers, forms, adverts, comments ...) have no
importance in any tree.  Where a page marks its article, the tree is the
article's, and its plain paragraphs go only if practically all pages of the
host show them; so what many articles quote stays.

Pages of a host with the same longest block (copies, near copies) count as
one page, so that a copied article does not pass for a template.

Defined results: null or empty html and pages without text give an empty
text; a null url is a host of its own; equal rows have equal results, row by
row; hosts with fewer than ``LEAST_PAGES`` different pages are left to the
elements' meaning alone; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import stored
from runledger.llm.html_blocks import BODY, Node, Page, article, name_of, texts
from runledger.llm.sketches import bitmap, in_bitmap

GAMMA = 0.9
LOW = 0.3              # importance of branches that go
LOW_PLAIN = 0.02       # of plain paragraphs of a marked article
LEAST_PAGES = 3        # different pages, for a tree to say anything
LEAST_PLAIN = 8        # the same for plain paragraphs of a marked article

_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)", re.I)
_NODE = ("pos int, parent int, leaf boolean, plain boolean, first int, "
         "last int, key binary, value long, fresh boolean")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _number(name: bytes) -> int:
    return int.from_bytes(name[:8], "little", signed=True)


def tree_of(host: str, html: str) -> tuple[int, list[tuple]]:
    """Identity of a page and its nodes (_NODE), parents first: elements,
    and blocks (leaves) with the range first..last of blocks they hold; the
    first of a key and kind is fresh."""
    page = Page(html)
    number = {k: i for i, k in enumerate(article(page))}
    if not number:
        return 0, []
    blocks = [page.blocks[k] for k in number]
    marked = blocks[0][2] > BODY
    names = [name_of(t.encode("utf-8", "replace"), size=8)
             for t, *_ in blocks]
    longest = max(zip((len(t) for t, *_ in blocks), names))[1]
    out: list[list] = []
    tops: dict[int, Node] = {}
    for _, node, _ in blocks:       # the outermost elements of the region
        while node.parent is not None and not (
                marked and node.parent.region != node.region):
            node = node.parent
        tops[id(node)] = node
    for top in tops.values():
        todo = [(top, -1, name_of(host.encode("utf-8", "replace"), b"\0",
                                  top.sign.encode("utf-8", "replace")),
                 True)]
        while todo:
            node, parent, key, plain = todo.pop()
            inside = [c for c in node.children
                      if isinstance(c, Node) or c in number]
            if len(inside) == 1 and not isinstance(inside[0], Node) \
                    and parent >= 0:
                i = number[inside[0]]    # one text and nothing else
                out.append([len(out), parent, True, marked and plain, i, i,
                            key, _number(names[i])])
                continue
            at, style, last = len(out), [], None
            out.append([at, parent, False, marked and plain, None, None,
                        key, 0])
            for c in inside:
                sign = c.sign if isinstance(c, Node) else "#"
                if sign != last:         # equal neighbours are one run
                    style.append(sign)
                    last = sign
                if isinstance(c, Node):
                    todo.append((c, at, name_of(key, c.sign.encode(
                        "utf-8", "replace")), plain and c.plain))
                else:
                    i = number[c]
                    out.append([len(out), at, True, marked and plain, i, i,
                                key, _number(names[i])])
            out[at][7] = _number(name_of("\0".join(style).encode(
                "utf-8", "replace"), size=8))
    for node in reversed(out):           # ranges, and elements without text
        if node[4] is not None and node[1] >= 0:
            up = out[node[1]]
            up[4] = node[4] if up[4] is None else min(up[4], node[4])
            up[5] = node[5] if up[5] is None else max(up[5], node[5])
    seen: set[tuple] = set()
    rows = []
    for n in out:
        if n[4] is not None:
            rows.append((*n, (n[6], n[2]) not in seen))
            seen.add((n[6], n[2]))
    return _number(longest), rows


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty) and the page's name: what its text
    depends on, hashed."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select(
        "page_id", "url", html.alias("html"),
        F.unhex(F.md5(F.concat(url, F.lit("\0"), html).cast("binary")))
        .alias("page"))


def _nodes(rows: DataFrame) -> DataFrame:
    """Nodes of the different pages: page, ident and the fields of _NODE."""
    names = [f.split()[0] for f in _NODE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int32(),
                 pa.int32(), pa.binary(), pa.int64(), pa.bool_()]
        for batch in batches:
            for url, html, page in zip(*(batch.column(c) for c in (
                    "url", "html", "page"))):
                ident, nodes = tree_of(host_of(url.as_py()), html.as_py())
                if nodes:
                    n = len(nodes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([page.as_py()] * n, pa.binary()),
                         pa.array([ident] * n, pa.int64()),
                         *[pa.array(c, t) for c, t in zip(zip(*nodes),
                                                          types)]],
                        ["page", "ident", *names])

    return rows.select("url", "html", "page").mapInArrow(
        run, f"page binary, ident long, {_NODE}").dropDuplicates(
        ["page", "pos"])


def node_stats(nodes: DataFrame) -> DataFrame:
    """(key, leaf, value), the number m of different pages of the node, its
    styles or texts l, and the importance: of a presentation node, or of the
    content node that shows this value."""
    values = stored(nodes.select("key", "leaf", "value", "ident").distinct()
                    .groupBy("key", "leaf", "value").agg(
                        F.count(F.lit(1)).alias("n")), "style-values")
    pages = stored(nodes.filter("fresh").select("key", "leaf", "ident")
                   .distinct().groupBy("key", "leaf").agg(
                       F.count(F.lit(1)).alias("m")).filter("m > 1"),
                   "style-pages")
    n, m = F.col("n"), F.col("m").cast("double")
    spread = stored(values.groupBy("key", "leaf").agg(
        F.sum("n").alias("all"), F.count(F.lit(1)).alias("l"),
        F.sum(n * F.log(n.cast("double"))).alias("n_log_n")), "style-nodes")
    per_node = pages.join(spread, ["key", "leaf"])
    entropy = F.when(F.col("leaf"), F.log(n.cast("double"))).otherwise(
        F.log(F.col("all").cast("double")) - F.col("n_log_n") / F.col("all")
    ) / F.log(m)
    return stored(values.join(per_node, ["key", "leaf"]).select(
        "key", "leaf", "value", "m", "l", F.when(
            F.col("leaf"), 1 - entropy).otherwise(F.least(
                entropy, F.lit(1.0))).alias("own"))
        .filter("not leaf or own < 1"), "style-stats")


def removals(nodes: DataFrame) -> DataFrame:
    """(page, first, last): ranges of blocks in branches of low importance."""
    stats = node_stats(nodes)
    same = ["key", "leaf", "value"]
    rated = nodes.join(stats, same, "left").select(
        "page", F.struct("pos", "parent", "leaf", "plain", "first", "last",
                         "key", "own", "m", "l").alias("node"))
    pages = rated.groupBy("page").agg(F.collect_list("node").alias("nodes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1)
            bounds = found.offsets.to_pylist()
            pos, parent, leaf, plain, first, last, key, own, m, styles = (
                found.values.field(k).to_pylist() for k in range(10))
            out = []
            for page, a, z in zip(batch.column(0).to_pylist(), bounds,
                                  bounds[1:]):
                sums: dict[int, tuple[float, int]] = {}
                for i in sorted(range(a, z), key=pos.__getitem__,
                                reverse=True):         # children first
                    value = 1.0 if own[i] is None else own[i]
                    if not leaf[i]:
                        total, k = sums.pop(pos[i])
                        g = GAMMA ** (styles[i] or 1)
                        value = (1 - g) * value + g * total / k
                    if parent[i] >= 0:
                        total, k = sums.get(parent[i], (0.0, 0))
                        sums[parent[i]] = total + value, k + 1
                        if m[i] is not None and (not leaf[i] or value < LOW):
                            out.append((page, key[i], leaf[i], plain[i],
                                        first[i], last[i], m[i], value))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in enumerate(
                    [pa.binary(), pa.binary(), pa.bool_(), pa.bool_(),
                     pa.int32(), pa.int32(), pa.int64(), pa.float64()])],
                ["page", "key", "leaf", "plain", "first", "last", "m", "own"])

    parts = stored(pages.mapInArrow(
        run, "page binary, key binary, leaf boolean, plain boolean, "
             "first int, last int, m long, own double"), "style-parts")
    elements = parts.filter("not leaf")
    means = stored(elements.groupBy("key").agg(F.avg("own").alias("mean"))
                   .filter(F.col("mean") < LOW), "style-means")
    low = (F.when(F.col("plain"), (F.col("m") >= LEAST_PLAIN)
                  & (F.col("own") < LOW_PLAIN))
           .otherwise((F.col("m") >= LEAST_PAGES) & (F.col("own") < LOW)))
    branches = elements.drop("own").join(
        means.withColumnRenamed("mean", "own"), "key")
    return branches.filter(low).select("page", "first", "last").unionByName(
        parts.filter("leaf").filter(low).select("page", "first", "last"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = page_rows(pages)
    nodes = stored(_nodes(rows), "style-tree")
    gone = stored(removals(nodes).groupBy("page").agg(F.collect_set(
        F.struct("first", "last")).alias("gone")), "style-gone")
    # A bitmap of fixed size tells most pages that keep all their blocks.
    some = bitmap(F.xxhash64("page"), gone)

    def run(batches: Iterator[pa.RecordBatch], changed: bool
            ) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            batch = batch.filter(pa.array(in_bitmap(some, at) == changed))
            found = [texts(h) for h in batch.column("html").to_pylist()]
            if changed:
                last = pa.array(found, pa.list_(pa.string()))
            else:
                last = pa.array([" ".join(b) for b in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("page_id", "url", "page")],
                 last], ["page_id", "url", "page", "text"])

    rows = rows.select("page_id", "url", "html", "page",
                       F.xxhash64("page").alias("at"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    url_type = rows.schema["url"].dataType.simpleString()
    schema = f"page_id {id_type}, url {url_type}, page binary, text "
    whole = rows.mapInArrow(lambda b: run(b, False), schema + "string")
    parts = rows.mapInArrow(lambda b: run(b, True), schema + "array<string>")
    left = F.filter("text", lambda t, i: ~F.exists(
        F.coalesce("gone", F.array()), lambda g: (g["first"] <= i)
        & (i <= g["last"])))
    cut = parts.join(gone, "page", "left").select(
        "page_id", "url", F.array_join(left, " ").alias("text"))
    return whole.select("page_id", "url", "text").unionByName(cut).select(
        "page_id", "url", "text", F.length("text").cast("long")
        .alias("n_chars"))
