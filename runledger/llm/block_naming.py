"""Operator 3: exact deduplication by deterministic block naming.

A text's UTF-8 bytes are cut into fixed-size blocks.  Every distinct block
gets an integer name; adjacent names are then paired and the pairs named in
the same way, level after level, until one name is left per document.  Two
documents of the same byte length have the same last name exactly when their
bytes are equal.

A name is ``hash_bits`` bits of a hash with the block's rank, in sort order,
among the distinct blocks that share those bits.  So a name needs no global
numbering, and the blocks themselves are compared (in one distributed
DISTINCT per level) to find the ones whose bits collide; only these need a
rank other than zero and a join.  Only built-in functions are used.

Defined results: a null text is the empty text (one empty block).  Rows with
a null id take part like others and lose to any row with an id.  Repeated
rows (same id, same text) are separate rows of which one stays.  An empty
table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import doc_texts, once, stored

BLOCK_BYTES = 4096
HASH_BITS = 56


def _key(hash_bits: int, *cols: Column) -> Column:
    return F.shiftleft(F.xxhash64(*cols), 64 - hash_bits)


def _collisions(units: DataFrame, parts: list[str]) -> DataFrame | None:
    """Rank of each distinct unit whose key another distinct unit shares."""
    distinct = units.select("key", *parts).distinct()
    shared = distinct.groupBy("key").count().filter("count > 1").select("key")
    if not shared.limit(1).count():
        return None
    order = Window.partitionBy("key").orderBy(*parts)
    ranked = (units.select("key", *parts).distinct().join(shared, "key")
              .withColumn("rank", F.row_number().over(order).cast("long") - 1))
    return stored(ranked, "block-collisions")


def _ranked(units: DataFrame, parts: list[str], ranks: DataFrame,
            row: list[str]) -> DataFrame:
    """Names per row, for units (row columns, pos, key, parts)."""
    same = F.lit(True)
    for c in ["key", *parts]:
        same = same & units[c].eqNullSafe(ranks[c])
    named = units.join(ranks, same, "left").select(
        *[units[c] for c in row], "pos",
        units["key"].bitwiseOR(F.coalesce("rank", F.lit(0))).alias("name"))
    return named.groupBy(*row).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "name"))),
        lambda x: x["name"]).alias("names"))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
               hash_bits: int = HASH_BITS) -> DataFrame:
    """One row per input row: doc_id, row_no, n_bytes, text_sha256, name."""
    row = ["row_no", "doc_id", "n_bytes", "text_sha256"]
    base = doc_texts(docs).select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id",
        F.encode("text", "UTF-8").alias("bytes"))
    base = base.select("row_no", "doc_id",
                       F.length("bytes").cast("long").alias("n_bytes"),
                       F.sha2("bytes", 256).alias("text_sha256"), "bytes")
    starts = F.sequence(F.lit(0), F.greatest(
        F.ceil(F.col("n_bytes") / block_bytes) - 1, F.lit(0)).cast("int"))
    blocks = F.transform(starts, lambda i: F.substring(
        "bytes", i * block_bytes + 1, F.lit(block_bytes)))

    units = base.select(*row, F.posexplode(blocks).alias("pos", "block"))
    units = units.withColumn("key", _key(hash_bits, F.col("block")))
    ranks = _collisions(units, ["block"])
    if ranks is None:
        names = base.select(*row, F.transform(
            blocks, lambda b: _key(hash_bits, b)).alias("names"))
    else:
        names = _ranked(units, ["block"], ranks, row)
    names = stored(names, "block-names")

    longest = names.agg(F.max(F.size("names"))).first()[0] or 1
    while longest > 1:
        names = _next_level(names, row, hash_bits)
        longest = (longest + 1) // 2
    return names.select(*row, F.element_at("names", 1).alias("name"))


def _next_level(names: DataFrame, row: list[str], hash_bits: int
                ) -> DataFrame:
    """Name adjacent pairs.  A last odd name is paired with null; documents
    of equal byte length pair up at the same places, so this is exact."""
    pairs = names.filter(F.size("names") > 1).select(*row, F.transform(
        F.sequence(F.lit(1), F.size("names"), F.lit(2)),
        lambda i: F.struct(
            F.element_at("names", i).alias("left"),
            F.get("names", i).alias("right"))).alias("pairs"))
    units = (pairs.select(*row, F.posexplode("pairs").alias("pos", "pair"))
             .select(*row, "pos", "pair.left", "pair.right")
             .withColumn("key", _key(hash_bits, F.col("left"),
                                     F.col("right"))))
    ranks = _collisions(units, ["left", "right"])
    if ranks is None:
        out = pairs.select(*row, F.transform("pairs", lambda p: _key(
            hash_bits, p["left"], p["right"])).alias("names"))
    else:
        out = _ranked(units, ["left", "right"], ranks, row)
    done = names.filter(F.size("names") <= 1)
    return stored(done.unionByName(out), "block-names")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
                     hash_bits: int = HASH_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    named = identities(docs, block_bytes, hash_bits)
    # Count and the row that stays, per identity: partially aggregated.
    # Stored, so that the join below reads two plain shuffles and a large
    # group of copies can be split over several tasks.
    groups = stored(named.groupBy("n_bytes", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("doc_id", "row_no")).alias("top")), "block-groups")
    return named.join(groups, ["n_bytes", "name"]).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("top.row_no")).alias("kept"),
        "text_sha256")


def deduplicate(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key, text = f"k_{uuid.uuid4().hex}", F.coalesce(docs["text"], F.lit(""))
    found = stored(exact_duplicates(docs, **params).filter(
        "doc_id <=> keep_id").select("doc_id", "text_sha256", "kept"),
        "block-kept")
    kept = found.filter("kept").select(
        F.col("doc_id").alias(key), F.col("text_sha256").alias(f"{key}_text"))
    out = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col(key))
                    & (F.sha2(text.cast("binary"), 256)
                       == F.col(f"{key}_text")), "left_semi")
    # Rows that repeat the kept id and text pass the join too: one stays.
    if found.filter("not kept").limit(1).count():
        out = once(out)
    return out
