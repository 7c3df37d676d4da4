"""Keyed tables in hash buckets: puts rewrite the buckets they touch.

A row lies in the bucket of its key's hash.  A put reads the buckets of its
keys, writes them anew as one part and commits the part by an entry in the log,
a single file with the buckets it holds.  For each bucket the newest valid
entry counts; so a put takes effect in one step, other buckets are neither read
nor written, and a reader resolves the log once and sees one state.

An entry says up to which one its writer had read.  Where another writer has
committed one of the same buckets since, the entry is void and its put raises
``ConcurrentPut``; puts to other buckets do not disturb each other.  What
reaches the driver is bounded by the number of buckets and entries.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators.keyed import latest_per_key, upsert
from runledger.session import materialized

LOG = ("part string, buckets array<int>, n_buckets int, read_to bigint, "
       "at bigint")
PART, BUCKET = "_part", "_bucket"
BUCKETS = 256


class ConcurrentPut(RuntimeError):
    """Another put has changed a bucket of this one meanwhile."""


def _valid(spark: SparkSession, path: str) -> list:
    """The entries that count, in order of time."""
    try:
        rows = spark.read.schema(LOG).parquet(f"{path}/log").collect()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    out, newest = [], {}
    for e in sorted(rows, key=lambda r: (r["at"], r["part"])):
        if any(newest.get(b, 0) > e["read_to"] for b in e["buckets"]):
            continue
        out.append(e)
        newest.update((b, e["at"]) for b in e["buckets"])
    return out


def bucket_parts(spark: SparkSession, path: str) -> dict[int, str]:
    """The part that holds each bucket at present."""
    return {b: e["part"] for e in _valid(spark, path) for b in e["buckets"]}


def read(spark: SparkSession, path: str, schema,
         buckets: set[int] | None = None,
         parts: dict[int, str] | None = None) -> DataFrame:
    """The table's present rows, or those of some buckets."""
    parts = bucket_parts(spark, path) if parts is None else parts
    paths = [f"{path}/data/{PART}={p}/{BUCKET}={b}"
             for b, p in sorted(parts.items())
             if buckets is None or b in buckets]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option(
        "basePath", f"{path}/data").parquet(*paths).drop(PART, BUCKET)


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def put(updates: DataFrame, path: str, schema, keys: list[str],
        order: list[str], n_buckets: int = BUCKETS) -> set[int]:
    """Put rows by key, the last in ``order`` wins; the first put creates the
    table with ``n_buckets``.  Returns the buckets that were rewritten."""
    spark = updates.sparkSession
    entries = _valid(spark, path)
    n = entries[0]["n_buckets"] if entries else n_buckets
    parts = {b: e["part"] for e in entries for b in e["buckets"]}
    latest = materialized(latest_per_key(updates, keys, order), "put")
    at = _bucket(keys, n)
    touched = {r[0] for r in latest.select(at).distinct().collect()}
    if not touched:
        return touched
    current = read(spark, path, schema, touched, parts)
    part = "p-" + uuid.uuid4().hex
    (upsert(current, latest, keys, order).withColumn(BUCKET, at)
     .hint("rebalance", BUCKET).write.partitionBy(BUCKET)
     .parquet(f"{path}/data/{PART}={part}"))
    read_to = max((e["at"] for e in entries), default=0)
    spark.createDataFrame(
        [(part, sorted(touched), n, read_to, time.time_ns())], LOG).coalesce(
        1).write.mode("append").parquet(f"{path}/log")
    if part not in {e["part"] for e in _valid(spark, path)}:
        raise ConcurrentPut(path)
    return touched
