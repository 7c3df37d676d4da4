"""Operator 10: exact n-gram Jaccard join with a count-vector tree.

A document is the set of its distinct word n-grams.  The n-grams are hashed
into ``GROUPS`` groups; the counts per group are the document's point.  The
overlap of two sets is at most the summed coordinate minima of their points,
which is the pruning bound of the tree.  Boxes use points of ``BOX_GROUPS``
groups, pairs the finer ones.  The tree has three levels:

* cells: n-grams are ordered from rare to frequent, and a set stands in the
  cell of each of its first ``n - ceil(t n) + 1`` n-grams.  Two sets with a
  Jaccard similarity of t or more share a cell (their overlap is at least t
  times the larger size), so cells are an exact first level that Spark can
  deal out.  The order follows a count sketch of fixed size over all texts;
  its errors only move work, as any fixed order is exact;
* leaves: a crowded cell is cut into leaves of sets of similar size, with
  the coordinate ranges of their points (bounding boxes);
* points: pairs of sets.

Pairs that pass the bound are verified by comparing the n-gram sets of their
whole texts.

A component needs no link between sets that are in it already.  So each round
takes the most connected set of every cell as its centre, verifies it against
the cell's sets of other components (a linear number of pairs), and then
leaves it out of that cell, as all its pairs there are settled.  After
``STAR_ROUNDS`` rounds the pairs of different components that remain are all
compared, leaf box by leaf box.  Equal sets are one set from the start.

Defined results: a null, empty or blank text has no n-gram, size 0 and its own
id as component; null ids take part and never are a component's name unless it
has no other; repeated rows are equal sets; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import (
    CACHED_LENGTH, at_work, doc_texts, keyed, once, row_key, rows_of, stored)
from runledger.llm.components import components
from runledger.llm.sketches import (
    CHUNK, bitmap, in_bitmap, summed_counts)

WORDS, PERCENT = 4, 85      # of the query
STAGE_WORDS, STAGE_PERCENT = 5, 80
GROUPS, BOX_GROUPS = 256, 32
SKETCH = 1 << 20            # counters, 4 MB
STAR_ROUNDS = 3
LEAF = 256
CELL_MASK = (1 << 48) - 1   # a shorter cell name only adds candidates
CACHE_ENTRIES = 500_000

_ODD = np.array([xxhash.xxh64_intdigest(f"word {i}") | 1 for i in range(64)],
                dtype=np.uint64)
_WORDS: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit names of a text's word k-grams.  Words are
    split at the six ASCII blanks and A-Z is lower-cased, nothing else."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(at_work(_WORDS)) > CACHE_ENTRIES:
        _WORDS.clear()
    names = []
    for w in words:
        h = _WORDS.get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w)
            if len(w) <= CACHED_LENGTH:
                _WORDS[w] = h
        names.append(h)
    h = np.array(names, np.uint64)
    width = min(k, len(h))
    n = len(h) - width + 1
    acc = np.full(n, width, np.uint64)   # a short text is one k-gram apart
    for o in range(width):
        acc += h[o:o + n] * _ODD[o]
    return np.unique(_mix(acc))


def set_tag(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _texts(docs: DataFrame) -> DataFrame:
    return doc_texts(docs)


def _sketch(docs: DataFrame, k: int) -> np.ndarray:
    """How often the n-grams of each hash bucket occur, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for text in batch.column(1):
                s = shingles(text.as_py(), k)
                np.add.at(total, (s >> np.uint64(20)) & np.uint64(SKETCH - 1),
                          np.uint32(1))
        part = TaskContext.get().partitionId()
        chunks = range(SKETCH // CHUNK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(chunks), pa.int32()),
             pa.array(chunks, pa.int32()),
             pa.array([total[c * CHUNK:(c + 1) * CHUNK].tobytes()
                       for c in chunks])], ["part", "chunk", "counts"])

    return summed_counts(_texts(docs).mapInArrow(
        count, "part int, chunk int, counts binary"), SKETCH)


def _sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n, tag (128-bit name of the set), box_point, point, cells of
    all rows.  Counts of a point stop at 127."""
    sketch = docs.sparkSession.sparkContext.broadcast(_sketch(docs, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            out = {c: [] for c in ("n", "tag", "box", "point", "cells")}
            for text in batch.column(1):
                s = shingles(text.as_py(), k)
                n = len(s)
                out["n"].append(n)
                out["tag"].append(set_tag(s))
                point = np.bincount((s % np.uint64(GROUPS)).astype(np.int64),
                                    minlength=GROUPS)
                out["box"].append(point.reshape(BOX_GROUPS, -1).sum(1))
                out["point"].append(np.minimum(point, 127))
                often = counts[(s >> np.uint64(20)) & np.uint64(SKETCH - 1)]
                order = np.argsort(often, kind="stable")  # then by name
                first = n - -(-percent * n // 100) + 1 if n else 0
                out["cells"].append((s[order[:first]] & np.uint64(
                    CELL_MASK)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["n"], pa.int32()),
                 pa.array(out["tag"], pa.binary()),
                 pa.array(out["box"], pa.list_(pa.int32())),
                 pa.array(out["point"], pa.list_(pa.int8())),
                 pa.array(out["cells"], pa.list_(pa.int64()))],
                ["doc_id", "n", "tag", "box_point", "point", "cells"])

    return stored(_texts(docs).mapInArrow(
        run, "doc_id long, n int, tag binary, box_point array<int>, "
             "point array<byte>, cells array<long>"), "jaccard-sets")


def _live_cells(sets: DataFrame) -> DataFrame:
    """(cell, tag) of the cells that hold two or more different sets."""
    cells = sets.filter("n > 0").select(
        F.xxhash64("tag").alias("short"), F.explode("cells").alias("cell"))
    live = stored(cells.groupBy("cell").agg(
        F.min("short").alias("low"), F.max("short").alias("high")).filter(
        "low < high").select("cell"), "jaccard-live")
    bits = sets.sparkSession.sparkContext.broadcast(
        bitmap(F.col("cell"), live))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).flatten().to_numpy()
            of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            ok = in_bitmap(bits.value, flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[ok]), batch.column(0).take(pa.array(of[ok]))],
                ["cell", "tag"])

    likely = sets.filter("n > 0").select("tag", "cells").mapInArrow(
        pick, "cell long, tag binary")
    return stored(likely.join(live, "cell").distinct(), "jaccard-cells")


def _needed(nx: Column, ny: Column, percent: int) -> Column:
    """Least overlap of two sets of these sizes: ceil(t (x + y) / (1 + t))."""
    return F.ceil(percent * (nx + ny) / F.lit(100.0 + percent))


def _box_bound(top_x: Column, top_y: Column) -> Column:
    """Summed minima of the tops of two boxes."""
    return F.aggregate(F.zip_with(top_x, top_y,
                                  lambda a, b: F.least(a, b)),
                       F.lit(0), lambda a, b: a + b)


def _bound(nx: Column, ny: Column, px: Column, py: Column) -> Column:
    """Summed minima of two points, as half of the sizes less the summed
    differences; counts cut at 127 only make the bound larger."""
    apart = F.aggregate(F.zip_with(px, py, lambda a, b: F.abs(
        a.cast("int") - b)), F.lit(0), lambda a, b: a + b)
    return (nx + ny - apart) / 2


def _sizes_fit(nx: Column, ny: Column, percent: int) -> Column:
    return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny))


def _texts_of(docs: DataFrame, sets: DataFrame, tags: DataFrame, k: int
              ) -> DataFrame:
    """(tag, text) of one document for each of the tags."""
    ids = sets.join(tags, "tag").groupBy("tag").agg(
        F.min("doc_id").alias("doc_id"))
    bits = docs.sparkSession.sparkContext.broadcast(
        bitmap(F.xxhash64("doc_id"), stored(ids.filter(
            "doc_id is not null"), "jaccard-ids")))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = in_bitmap(bits.value, batch.column(2).to_numpy())
            ok |= batch.column(0).is_null().to_numpy(zero_copy_only=False)
            texts = batch.column(1).filter(pa.array(ok))
            tag = [set_tag(shingles(t.as_py(), k)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tag, pa.binary()), texts], ["tag", "text"])

    found = _texts(docs).withColumn("mark", F.xxhash64("doc_id")).mapInArrow(
        pick, "tag binary, text string")
    return stored(found.join(tags, "tag").dropDuplicates(["tag"]),
                  "jaccard-texts")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int
              ) -> DataFrame:
    """The pairs (x, y) whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            ok = []
            for x, tx, ty in zip(batch.column(0).to_pylist(),
                                 batch.column(2), batch.column(3)):
                if x != last:
                    last, own = x, shingles(tx.as_py(), k)
                other = shingles(ty.as_py(), k)
                both = len(np.intersect1d(own, other, assume_unique=True))
                ok.append(100 * both >= percent * (
                    len(own) + len(other) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)],
                ["a", "b"])

    y = texts.select(F.col("tag").alias("y"), F.col("text").alias("text_y"))
    x = texts.select(F.col("tag").alias("x"), F.col("text").alias("text_x"))
    return pairs.select("x", "y").join(y, "y").join(x, "x").select(
        "x", "y", "text_x", "text_y").mapInArrow(run, "a binary, b binary")


def _with_labels(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows (…, tag, …) with their current component label."""
    labels = components(links)
    return rows.drop("label").join(labels, rows["tag"] == labels["node"],
                                   "left").select(
        *[c for c in rows.columns if c != "label"],
        F.coalesce("label", "tag").alias("label"))


def _open_cells(cells: DataFrame) -> DataFrame:
    """Rows of the cells that still hold sets of different components."""
    alive = stored(cells.groupBy("cell").agg(
        F.min("label").alias("low"), F.max("label").alias("high")).filter(
        "low < high").select("cell"), "jaccard-open")
    return stored(cells.join(alive, "cell"), "jaccard-cells")


def _star_pairs(cells: DataFrame, points: DataFrame, percent: int
                ) -> tuple[DataFrame, DataFrame]:
    """Pairs of each cell's centre with its other sets that pass the bound,
    and the cells without their centres.  The centre is the set that stands
    in the most live cells."""
    centre = stored(cells.groupBy("cell").agg(F.max(F.struct(
        "score", "tag", "label", "n")).alias("c")).select(
        "cell", *[F.col(f"c.{f}").alias(f"c_{f}")
                  for f in ("tag", "label", "n")]), "jaccard-centres")
    met = cells.join(centre, "cell")
    pairs = stored(
        met.filter((F.col("label") != F.col("c_label"))
                   & _sizes_fit(F.col("n"), F.col("c_n"), percent))
        .select(F.col("c_tag").alias("x"), F.col("tag").alias("y"))
        .distinct(), "jaccard-pairs")
    rest = met.filter(F.col("tag") != F.col("c_tag")).select(*cells.columns)
    x = points.select(F.col("tag").alias("x"), F.col("n").alias("nx"),
                      F.col("point").alias("px"))
    y = points.select(F.col("tag").alias("y"), F.col("n").alias("ny"),
                      F.col("point").alias("py"))
    near = pairs.join(y, "y").join(x, "x").filter(
        _bound(F.col("nx"), F.col("ny"), F.col("px"), F.col("py"))
        >= _needed(F.col("nx"), F.col("ny"), percent)).select("x", "y")
    return near, rest


def _leaf_pairs(cells: DataFrame, points: DataFrame, percent: int,
                labelled: bool = True) -> DataFrame:
    """All pairs of a cell's sets that pass the bound, over pairs of leaves
    whose boxes pass it (of different components only, if labelled)."""
    band = F.floor(F.log("n") / np.log(100 / percent)).cast("int")
    crowd = stored(cells.select("cell", band.alias("band")).groupBy(
        "cell", "band").count(), "jaccard-crowds")
    rows = stored(cells.withColumn("band", band).join(
        crowd, ["cell", "band"]).withColumn(
        "leaf", F.pmod(F.xxhash64("tag"), F.ceil(F.col("count") / LEAF)))
        .drop("count").join(points.drop("n"), "tag"), "jaccard-leaves")
    axes = range(BOX_GROUPS)
    boxes = stored(rows.groupBy("cell", "band", "leaf").agg(
        F.array(*[F.max(F.col("box_point")[g]) for g in axes]).alias("top"),
        F.min("n").alias("n_low"), F.max("n").alias("n_high"),
        F.min("label").alias("l_low"), F.max("label").alias("l_high")),
        "jaccard-boxes")
    names = ("band", "leaf", "top", "n_low", "n_high", "l_low", "l_high")
    a = boxes.select("cell", *[F.col(c).alias(f"a_{c}") for c in names])
    b = boxes.select("cell", *[F.col(c).alias(f"b_{c}") for c in names])
    # The box bound: no overlap exceeds the summed minima of the tops.
    near = (F.abs(F.col("a_band") - F.col("b_band")) <= 1) & (
        _box_bound(F.col("a_top"), F.col("b_top")) >= _needed(
            F.col("a_n_low"), F.col("b_n_low"), percent)) & (
        (F.col("a_band") < F.col("b_band"))
        | (F.col("a_band") == F.col("b_band"))
        & (F.col("a_leaf") <= F.col("b_leaf")))
    if labelled:
        near = near & ~((F.col("a_l_low") == F.col("a_l_high"))
                        & (F.col("b_l_low") == F.col("b_l_high"))
                        & (F.col("a_l_low") == F.col("b_l_low")))
    leaves = stored(a.join(b, "cell").filter(near).select(
        "cell", "a_band", "a_leaf", "b_band", "b_leaf"), "jaccard-near")
    # A leaf has about LEAF members, so a pair of leaves is a bounded row.
    members = stored(rows.groupBy("cell", "band", "leaf").agg(
        F.collect_list("tag").alias("tags"),
        F.collect_list("label").alias("labels"),
        F.collect_list("n").alias("ns"),
        F.flatten(F.collect_list("point")).alias("points")),
        "jaccard-members")
    fields = ("tags", "labels", "ns", "points")
    left = members.select("cell", F.col("band").alias("a_band"),
                          F.col("leaf").alias("a_leaf"),
                          *[F.col(c).alias(f"a_{c}") for c in fields])
    right = members.select("cell", F.col("band").alias("b_band"),
                           F.col("leaf").alias("b_leaf"),
                           *[F.col(c).alias(f"b_{c}") for c in fields])
    met = leaves.join(left, ["cell", "a_band", "a_leaf"]).join(
        right, ["cell", "b_band", "b_leaf"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in range(3)]
            other = [batch.column(c).to_pylist() for c in range(4, 7)]
            x, y = [], []
            for i in range(batch.num_rows):
                a = _leaf(cols, batch.column(3), i)
                b = _leaf(other, batch.column(7), i)
                for p, q in _near_members(a, b, percent, labelled):
                    x.append(min(a[0][p], b[0][q]))
                    y.append(max(a[0][p], b[0][q]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.binary()), pa.array(y, pa.binary())],
                ["x", "y"])

    return met.select(*[f"a_{c}" for c in fields],
                      *[f"b_{c}" for c in fields]).mapInArrow(
        run, "x binary, y binary").filter("x <> y").distinct()


def _leaf(cols: list[list], points: pa.Array, i: int) -> tuple:
    tags, labels, ns = (c[i] for c in cols)
    return tags, labels, np.array(ns), np.array(
        points[i].values.to_numpy(zero_copy_only=False)).reshape(
        len(tags), GROUPS).astype(np.int16)


def _near_members(a: tuple, b: tuple, percent: int, labelled: bool
                  ) -> Iterator[tuple[int, int]]:
    """Pairs of members of two leaves whose sizes and points are near."""
    names = {x: k for k, x in enumerate({*a[1], *b[1]})}
    lb = np.array([names[x] for x in b[1]])
    for p in range(len(a[0])):
        n, m = a[2][p], b[2]
        ok = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
        if labelled:
            ok &= lb != names[a[1][p]]
        q = np.nonzero(ok)[0]
        if len(q):
            apart = np.abs(b[3][q] - a[3][p]).sum(1)
            need = -(-percent * (n + m[q]) // (100 + percent))
            for k in q[n + m[q] - apart >= 2 * need]:
                yield p, int(k)


def _prepared(docs: DataFrame, k: int, percent: int
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets of all documents; cell rows and points of the live ones."""
    sets = _sets(docs, k, percent)
    cells = _live_cells(sets)
    tags = stored(cells.groupBy("tag").agg(F.count(F.lit(1)).alias("score")),
                  "jaccard-tags")
    points = stored(sets.select("tag", "n", "box_point", "point").join(
        tags, "tag").dropDuplicates(["tag"]), "jaccard-points")
    cells = stored(cells.join(points.select("tag", "n", "score"), "tag")
                   .withColumn("label", F.col("tag")), "jaccard-cells")
    return sets, cells, points.drop("score")


class _Verifier:
    """Verifies pairs; fetches the text of a set when a pair first needs it,
    so only sets with a pair that passed the bound are fetched."""

    def __init__(self, docs: DataFrame, sets: DataFrame, k: int,
                 percent: int):
        self.docs, self.sets = docs, sets
        self.k, self.percent = k, percent
        self.texts: DataFrame | None = None

    def links(self, pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "jaccard-pairs")
        tags = pairs.select(F.col("x").alias("tag")).union(
            pairs.select("y")).distinct()
        if self.texts is not None:
            tags = tags.join(self.texts.select("tag"), "tag", "left_anti")
        tags = stored(tags, "jaccard-tags")
        more = _texts_of(self.docs, self.sets, tags, self.k)
        self.texts = more if self.texts is None else \
            self.texts.unionByName(more)
        return _verified(pairs, self.texts, self.k, self.percent)


def _links(docs: DataFrame, k: int, percent: int
           ) -> tuple[DataFrame, DataFrame]:
    """Sets of all documents, and links that connect every component."""
    sets, cells, points = _prepared(docs, k, percent)
    verifier, links = _Verifier(docs, sets, k, percent), None
    for _ in range(STAR_ROUNDS):
        pairs, rest = _star_pairs(cells, points, percent)
        found = verifier.links(pairs)
        links = stored(found if links is None else links.union(found),
                       "jaccard-links")
        cells = _open_cells(_with_labels(rest, links))
        if not cells.limit(1).count():
            return sets, links
    found = verifier.links(_leaf_pairs(cells, points, percent))
    return sets, stored(found if links is None else links.union(found),
                        "jaccard-links")


def similar_pairs(docs: DataFrame, k: int = WORDS, percent: int = PERCENT
                  ) -> tuple[DataFrame, DataFrame]:
    """The whole join: every pair (a, b) of different sets that are similar
    enough, and the membership (doc_id, n, set) of the documents."""
    sets, cells, points = _prepared(docs, k, percent)
    pairs = _leaf_pairs(cells, points, percent, labelled=False)
    return _Verifier(docs, sets, k, percent).links(pairs), sets.select(
        "doc_id", "n", F.col("tag").alias("set"))


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT
                    ) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    sets, links = _links(docs, k, percent)
    labels = components(links)
    some = sets.filter("n > 0")
    least = stored(some.groupBy("tag").agg(F.min("doc_id").alias("least")),
                   "jaccard-least")
    named = stored(least.join(labels, least["tag"] == labels["node"], "left")
                   .select("tag", F.coalesce("label", "tag").alias("label"),
                           "least"), "jaccard-named")
    top = stored(named.groupBy("label").agg(
        F.min("least").alias("component_id")), "jaccard-top")
    names = stored(named.join(top, "label").select("tag", "component_id"),
                   "jaccard-names")
    return some.join(names, "tag").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        "component_id").unionByName(sets.filter("n = 0").select(
            "doc_id", F.lit(0).cast("long").alias("n_shingles"),
            F.col("doc_id").alias("component_id")))


def deduplicate(docs: DataFrame, k: int = STAGE_WORDS,
                percent: int = STAGE_PERCENT) -> DataFrame:
    """One row of each component (the smallest id; a null id if there is no
    other), all columns."""
    found = stored(near_duplicates(keyed(docs), k, percent)
                   .withColumnRenamed("doc_id", "key"), "jaccard-result")
    ids = stored(docs.select(row_key(docs).alias("key"), F.col("doc_id").cast(
        "long").alias("doc_id")).distinct(), "jaccard-row-ids")
    kept = stored(found.join(ids, "key").groupBy("component_id").agg(F.min(
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
        .alias("b")).select(F.col("b.key").alias("doc_id")), "jaccard-kept")
    out = rows_of(docs, kept)
    # Rows that repeat an id and text stay once.
    if found.groupBy("key").count().filter("count > 1").limit(1).count():
        out = once(out)
    return out
