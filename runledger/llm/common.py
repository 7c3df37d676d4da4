"""Helpers shared by the corpus operators.

Conventions: a null text counts as the empty text; operators select only the
columns they need, so extra columns of the input (whatever their names) never
interfere; intermediate tables are Parquet files in a fresh folder below
``spark.checkpoint.dir``, so a lost executor costs a re-read, not a rerun.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runledger.session import new_run_dir

# Longer words are not kept in a worker's cache, which bounds its bytes.
CACHED_LENGTH = 64

# The cache of the operator that a worker is busy with, if any.
_AT_WORK: list[dict] = []


def at_work(cache: dict) -> dict:
    """``cache``, which a worker keeps between its tasks.  A worker lives on
    from one step of a pipeline to the next, so the caches of other operators
    are emptied: an executor has to hold the largest, not all of them."""
    if not _AT_WORK or _AT_WORK[0] is not cache:
        for other in _AT_WORK:
            other.clear()
        _AT_WORK[:] = [cache]
        give_back()
    return cache


def give_back() -> None:
    """Memory that Arrow has freed goes back to the system; the worker would
    keep it otherwise, also while it is idle."""
    pa.default_memory_pool().release_unused()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), plus the named columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       *more)


def stored(df: DataFrame, kind: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder (compressed by ``codec``; none:
    the session's) and read it back."""
    path = new_run_dir(df.sparkSession, kind)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(docs: DataFrame) -> Column:
    """64-bit name of a row by its doc_id and text together: rows that share
    only one of them (many may have no id) are told apart."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["doc_id"].isNull(),
                      F.coalesce(docs["text"], F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """The texts with their row keys as ``doc_id``."""
    return docs.select(row_key(docs).alias("doc_id"), "text")


def rows_of(docs: DataFrame, keys: DataFrame, how: str = "left_semi"
            ) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose row key is among
    ``keys`` (column doc_id), or is not (``left_anti``)."""
    key = f"k_{uuid.uuid4().hex}"
    wanted = keys.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(wanted, row_key(docs) == F.col(key), how)


def once(docs: DataFrame) -> DataFrame:
    """One row of those that repeat a doc_id together with its text."""
    key = f"k_{uuid.uuid4().hex}"
    return docs.withColumn(key, row_key(docs)).dropDuplicates([key]).drop(key)


def crc_remainder(col: Column, n: int) -> Column:
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(n))


def numbered(rows: DataFrame, key: list[str], order: list[Column], name: str
             ) -> DataFrame:
    """``rows`` with their number (1, 2, ...) in ``order`` within ``key`` (no
    key: in the whole table).  A global range sort deals the rows out, so one
    key may be spread over many tasks; only the counts of the ranges meet."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, int(
        rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sort = [F.col(c) for c in key] + order
    at = F.monotonically_increasing_id()
    placed = stored(rows.repartitionByRange(n, *sort).sortWithinPartitions(
        *sort).select("*", F.shiftright(at, 33).alias("part"), at.bitwiseAND(
            F.lit((1 << 33) - 1)).alias("at")), "numbered")
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    # One row for each key and range: a range ends in at most one more key.
    ranges = placed.groupBy(*key, "part").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    ranges = ranges.select(*key, "part", (F.coalesce(F.sum("n").over(before),
                                                     F.lit(0))
                                          - F.col("first") + 1).alias("plus"))
    if not key:   # as many rows as there are ranges
        ranges = F.broadcast(ranges)
    return placed.join(ranges, [*key, "part"]).withColumn(
        name, (F.col("at") + F.col("plus")).cast("long")).drop(
        "at", "part", "plus")
