"""Operator 12: the prefix trie of rebuilt conversations, by whole sequences.

A conversation c is rebuilt from the first h turns of conversation c - c % 100
(as many as it has) and its own turns after its first h, where h is the CRC-32
of c in decimal, modulo 6.  Equal rebuilt conversations collapse to one
weighted sequence with the list of the conversations that end there.  An anti
join with the proper prefixes of all sequences leaves the trie's leaves, and
one aggregation over the prefixes of the weighted sequences gives the nodes.

A prefix is named by its depth and two 64-bit words, each the exclusive or of
the hashes of its (place, role, text); so a prefix's name follows from the one
before, and the names of a very long conversation can be made in blocks of
``BLOCK`` turns by different tasks.

The tokens saved below a node need each node of its subtree once.  Each node
is owned by the smallest leaf below it; a leaf then owns the lower end of its
own path, from some depth on.  So a sum over a subtree is a sum over the
leaves below of a suffix sum along the leaf's path, and no pairs of nodes and
ancestors are made.

Defined results: rows without a conv_id belong to no conversation and are
left out; null role or text is the empty string; turns are ordered by turn
(null first), ties by the SHA-256 of role, a NUL and text; repeated rows are
turns of their own.  ``c % 100`` has the sign of c.  A conversation none of
whose turns remain ends at the root.  An empty table gives no nodes, not even
a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import crc_remainder, numbered, stored

SHARED = 100       # conversations per common start
HEADS = 6          # the common start has 0 to HEADS - 1 turns
BLOCK = 1024       # turns whose running names one group makes
CHUNK_IDS = 8192   # ids that are joined to one piece of an end list

NAME = ["depth", "p1", "p2"]


def _hashes(place: Column) -> list[Column]:
    return [F.xxhash64(F.lit(k), place, "c1", "c2") for k in (1, 2)]


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, ...), c1, c2 (content names), n_chars."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    content = F.sha2(F.concat(role, F.lit("\0"), text).cast("binary"), 256)

    def word(at: int) -> Column:
        return F.conv(F.substring("content", at, 15), 16, 10).cast("long")

    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        content.alias("content"), F.length(text).cast("long").alias("n_chars"))
    ordered = numbered(rows, ["conv_id"], [F.col("turn").asc_nulls_first(),
                                           F.col("content").asc()], "place")
    return ordered.select("conv_id", "place", word(1).alias("c1"),
                          word(17).alias("c2"), "n_chars")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored turns (conv, depth, c1, c2, n_chars) of the rebuilt
    conversations, and (conv, size) of all of them."""
    convs = stored(turns.groupBy("conv_id").agg(F.max("place").alias("n"))
                   .withColumn("h", crc_remainder(F.col("conv_id"), HEADS))
                   .withColumn("base", F.col("conv_id")
                               - F.col("conv_id") % SHARED), "trie-convs")
    sizes = convs.select(F.col("conv_id").alias("base"),
                         F.col("n").alias("n_base"))
    convs = stored(convs.join(sizes, "base", "left").select(
        "conv_id", "base", "n", "h", F.least("h", F.coalesce(
            "n_base", F.lit(0))).alias("taken")), "trie-convs")
    # At most SHARED conversations have one base, which gives a few turns.
    heads = turns.filter((F.col("conv_id") % SHARED == 0)
                         & (F.col("place") < HEADS)).select(
        F.col("conv_id").alias("base"), F.col("place").alias("depth"), "c1",
        "c2", "n_chars")
    start = heads.join(convs, "base").filter("depth <= taken").select(
        F.col("conv_id").alias("conv"), "depth", "c1", "c2", "n_chars")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id") \
        .filter("place > h").select(
        F.col("conv_id").alias("conv"),
        (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "c1",
        "c2", "n_chars")
    zero = F.lit(0).cast("long")
    sized = convs.select(F.col("conv_id").alias("conv"), (
        F.col("taken") + F.greatest(F.col("n") - F.col("h"), zero))
        .alias("size"))
    return stored(start.unionByName(own), "trie-rebuilt"), sized


def _running(rows: DataFrame, key: str, order: str, columns: dict[str, str],
             from_end: bool = False) -> DataFrame:
    """Running aggregates along ``order`` within ``key``: out column ->
    (aggregate of a column, as SQL).  Blocks of rows first, then the blocks
    of one key, so that a long key is shared by many tasks."""
    sort = F.desc if from_end else F.asc
    block = F.floor(F.col(order) / BLOCK).alias("block")
    inside = Window.partitionBy(key, "block").orderBy(sort(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy(sort("block")).rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.select("*", block)
    blocks = rows.groupBy(key, "block").agg(*[
        F.expr(a).alias(f"b_{c}") for c, a in columns.items()])
    blocks = blocks.select(key, "block", *[F.coalesce(F.expr(
        a.split("(")[0] + f"(b_{c})").over(before), F.lit(0)).alias(f"b_{c}")
        for c, a in columns.items()])
    parts = rows.select("*", *[F.expr(a).over(inside).alias(f"i_{c}")
                               for c, a in columns.items()])
    out = parts.join(blocks, [key, "block"])
    for c, a in columns.items():
        both = (F.col(f"i_{c}").bitwiseXOR(F.col(f"b_{c}"))
                if a.startswith("bit_xor") else F.col(f"i_{c}")
                + F.col(f"b_{c}"))
        out = out.withColumn(c, both).drop(f"i_{c}", f"b_{c}")
    return out.drop("block")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(rep, ends_sha256) from (rep, conv): the ids of a group in order,
    joined by commas.  Pieces of the list are joined by many tasks; only the
    pieces of a group, not its rows, meet in one task, one at a time."""
    chunk = CHUNK_IDS
    n = max(ends.sparkSession.sparkContext.defaultParallelism, int(
        ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, first, ids = None, None, []

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([rep], pa.int64()), pa.array([first], pa.int64()),
                 pa.array([",".join(map(str, ids))], pa.string())],
                ["rep", "first", "ids"])

        for batch in batches:
            for r, c in zip(batch.column(0).to_pylist(),
                            batch.column(1).to_pylist()):
                if ids and (r != rep or len(ids) == chunk):
                    yield piece()
                    ids = []
                if not ids:
                    rep, first = r, c
                ids.append(c)
        if ids:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]
                ) -> Iterator[pa.RecordBatch]:
        rep, digest = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([rep], pa.int64()),
                 pa.array([digest.hexdigest()], pa.string())],
                ["rep", "ends_sha256"])

        for batch in batches:
            for r, ids in zip(batch.column(0).to_pylist(),
                              batch.column(2).to_pylist()):
                if r != rep:
                    if digest is not None:
                        yield done()
                    rep, digest = r, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if digest is not None:
            yield done()

    ordered = ends.select("rep", "conv").repartitionByRange(
        n, "rep", "conv").sortWithinPartitions("rep", "conv")
    joined = ordered.mapInArrow(pieces, "rep long, first long, ids string")
    return joined.repartition(n, "rep").sortWithinPartitions(
        "rep", "first").mapInArrow(digests, "rep long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    turns = stored(_turns(conversations), "trie-turns")
    rebuilt, sized = _rebuilt(turns)
    z1, z2 = _hashes(F.col("depth"))
    named = stored(_running(
        rebuilt.select("conv", "depth", "n_chars", z1.alias("z1"),
                       z2.alias("z2")), "conv", "depth",
        {"p1": "bit_xor(z1)", "p2": "bit_xor(z2)"}), "trie-named")

    # Equal conversations collapse: the name at full depth is the sequence.
    zero = F.lit(0).cast("long")
    whole = stored(named.join(sized.filter("size > 0"), "conv").filter(
        "depth = size").select("conv", *NAME).unionByName(
        sized.filter("size = 0").select("conv", *[
            zero.alias(c) for c in NAME])), "trie-whole")
    sequences = stored(whole.groupBy(*NAME).agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("weight")),
        "trie-sequences")
    ends = stored(whole.join(sequences.select(*NAME, "rep"), NAME).select(
        "rep", "conv"), "trie-ends")

    # The prefixes of each sequence, from its representative; root first.
    own = sequences.select(F.col("rep").alias("conv"), F.col("depth").alias(
        "size"), "weight")
    steps = named.join(own, "conv").select(
        "conv", "size", "weight", *NAME, "n_chars",
        F.col("p1").bitwiseXOR(F.col("z1")).alias("q1"),
        F.col("p2").bitwiseXOR(F.col("z2")).alias("q2"))
    steps = steps.unionByName(own.select(
        "conv", "size", "weight", *[zero.alias(c) for c in NAME],
        zero.alias("n_chars"), zero.alias("q1"), zero.alias("q2")))
    steps = stored(steps, "trie-steps")
    # A leaf is a sequence that is no proper prefix of another.
    proper = steps.filter("depth < size").groupBy(*NAME).agg(
        F.count(F.lit(1)).alias("below")).select(*NAME)
    leaves = stored(sequences.join(proper, NAME, "left_anti").select(
        F.col("rep").alias("conv"), F.lit(1).alias("leaf")), "trie-leaves")
    steps = stored(_running(steps, "conv", "depth", {
        "rest": "sum(n_chars)"}, from_end=True).join(leaves, "conv", "left"),
        "trie-prefixes")

    nodes = stored(steps.groupBy(*NAME).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.min(F.when(F.col("leaf") == 1, F.col("conv"))).alias("owner"),
        F.count("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("rest")).alias("all_tokens"),
        F.first("n_chars").alias("n_chars"), F.first("q1").alias("q1"),
        F.first("q2").alias("q2"),
        F.min(F.when(F.col("depth") == F.col("size"), F.col("conv")))
        .alias("rep")), "trie-nodes")
    owned = stored(nodes.groupBy(F.col("owner").alias("conv")).agg(
        F.min("depth").alias("from_depth"),
        F.sum("n_chars").alias("owned_tokens")), "trie-owned")
    once = steps.filter("leaf = 1").join(owned, "conv").groupBy(*NAME).agg(
        F.sum(F.when(F.col("depth") >= F.col("from_depth"), F.col("rest"))
              .otherwise(F.col("owned_tokens"))).alias("once_tokens"))

    parents = nodes.select(
        F.col("depth").alias("at"), F.col("p1").alias("at1"),
        F.col("p2").alias("at2"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"),
        F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    none = hashlib.sha256(b"").hexdigest()
    out = (nodes.join(once, NAME).join(children, NAME, "left")
           .join(_end_digests(ends), "rep", "left")
           .join(parents, (F.col("depth") - 1 == F.col("at"))
                 & (F.col("q1") == F.col("at1"))
                 & (F.col("q2") == F.col("at2")), "left"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        (F.col("all_tokens") - F.col("once_tokens")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
