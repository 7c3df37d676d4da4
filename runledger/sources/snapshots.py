"""Append-only tables with compaction.

A table is a folder of parts, each written by one append or compaction, and a
log with an entry for each part, which is a single file: a part counts once its
entry is there, as a whole or not at all.  An entry may name parts that it
replaces; so a compaction, which packs the small parts into a new one, takes
effect in one step.

Readers resolve the log once and read the files of those parts only.  So a
reader sees one state, whatever is appended or compacted meanwhile, and
``vacuum`` removes replaced parts only when they have been so for a while.
Where two compactions replace the same part, the first entry counts and the
other is void.

The log has as many entries as there are live parts and parts not yet removed:
with a compaction every n appends, about n and one for every full part.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.session import conf_set, delete_folder, shuffles_dropped
from runledger.sources.files import bare_path, below, list_files

LOG = "part string, replaces array<string>, at bigint"
PART = "_part"            # folder of a part
OPEN_FILES = 100          # files a task writes at a time, without gathering
FULL_BYTES = 1 << 30      # parts of this size are not packed again
RETAIN_SECONDS = 86_400   # replaced parts stay for readers that began before


def _commit(spark: SparkSession, path: str, part: str, replaces: list[str]
            ) -> None:
    spark.createDataFrame([(part, replaces, time.time_ns())], LOG).coalesce(
        1).write.parquet(f"{path}/log/{part}")


def _write(rows: DataFrame, path: str, partition: str | None,
           gather: bool = True) -> str:
    part = "p-" + uuid.uuid4().hex
    if partition and gather:
        rows = rows.hint("rebalance", partition)
    writer = rows.write.option("compression", "zstd")
    if partition:
        writer = writer.partitionBy(partition)
    if not gather:      # small buffers, as many files are open
        writer = writer.options(**{"parquet.page.size": 1 << 18,
                                   "parquet.dictionary.page.size": 1 << 16})
    with (conf_set(rows.sparkSession,
                   "spark.sql.maxConcurrentOutputFileWriters",
                   str(0 if gather else OPEN_FILES)),
          shuffles_dropped(rows.sparkSession)):
        writer.parquet(f"{path}/data/{PART}={part}")
    return part


def append(rows: DataFrame, path: str, partition: str | None = None,
           gather: bool = True) -> None:
    """Append rows as a new part.  ``rebalance`` lets Spark write few files
    for each value of the partition column, while splitting one that holds a
    large share of the rows.  Without ``gather`` every task writes a file for
    each value that it has, and no row is shuffled or sorted: for many rows,
    of few values, in tasks that have many of each."""
    _commit(rows.sparkSession, path, _write(rows, path, partition, gather),
            [])


def _log(spark: SparkSession, path: str) -> list[tuple[str, list[str], int]]:
    """The entries in order of time (as many as there are parts)."""
    try:
        rows = spark.read.schema(LOG).parquet(f"{path}/log/*").collect()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(((r["part"], r["replaces"] or [], r["at"]) for r in rows),
                  key=lambda e: (e[2], e[0]))


def _resolved(entries: list[tuple[str, list[str], int]]
              ) -> tuple[list[str], dict[str, int]]:
    """Live parts, and since when the others are replaced or void."""
    gone: dict[str, int] = {}
    for part, replaces, at in entries:
        if any(r in gone for r in replaces):
            gone[part] = at              # another compaction was first
        else:
            gone.update((r, at) for r in replaces)
    return [p for p, _, _ in entries if p not in gone], gone


def live_parts(spark: SparkSession, path: str) -> list[str]:
    """The parts of the table's present state."""
    return _resolved(_log(spark, path))[0]


def read(spark: SparkSession, path: str, schema=None,
         parts: list[str] | None = None) -> DataFrame:
    """The rows of the present state, or of the given parts."""
    parts = live_parts(spark, path) if parts is None else parts
    if not parts:
        if schema is None:
            raise ValueError(f"nothing has been written to {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", f"{path}/data").parquet(
        *[f"{path}/data/{PART}={p}" for p in parts]).drop(PART)


def part_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of every part, live or not (one row for each)."""
    root = f"{path}/data"
    part = F.regexp_extract(below(bare_path(F.col("path")), root),
                            rf"^{PART}=([^/]+)", 1)
    return {r["part"]: r["size"] for r in list_files(spark, root).groupBy(
        part.alias("part")).agg(F.sum("length").alias("size")).collect()}


def small_parts(spark: SparkSession, path: str,
                full_bytes: int | None = None) -> list[str]:
    """The live parts that a compaction would pack."""
    limit = FULL_BYTES if full_bytes is None else full_bytes
    parts = live_parts(spark, path)
    if len(parts) < 2:
        return parts
    sizes = part_sizes(spark, path)
    return [p for p in parts if sizes.get(p, 0) < limit]


def compact(spark: SparkSession, path: str, partition: str | None = None,
            fold: Callable[[DataFrame], DataFrame] | None = None,
            full_bytes: int | None = None, schema=None) -> int:
    """Pack the parts below ``full_bytes`` (``FULL_BYTES``) into one;
    ``fold`` may reduce their rows.  Returns how many parts were packed."""
    small = small_parts(spark, path, full_bytes)
    if len(small) < 2:
        return 0
    rows = read(spark, path, schema, small)
    new = _write(fold(rows) if fold else rows, path, partition)
    _commit(spark, path, new, small)
    return len(small)


def vacuum(spark: SparkSession, path: str, retain: float = RETAIN_SECONDS
           ) -> int:
    """Remove parts that have been replaced for ``retain`` seconds; oldest
    first, and each with its entry first, so that none can come back."""
    entries = _log(spark, path)
    _, gone = _resolved(entries)
    since = time.time_ns() - int(retain * 1e9)
    old = [p for p, _, _ in entries if gone.get(p, since + 1) <= since]
    for p in old:
        delete_folder(spark, f"{path}/log/{p}")
        delete_folder(spark, f"{path}/data/{PART}={p}")
    return len(old)
