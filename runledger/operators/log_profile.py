"""Log-level profiling (P9, P10, A7, A8) and the file top-k.

A7 is a grouped aggregation of conditional counts, so Spark combines it
map-side before the shuffle; a file (or source) holding a third of all lines
costs one partial row per task, not one hot task.  For whole documents the
per-line levels are computed with higher-order array functions inside the
row, which needs no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.scalar import (
    ERROR_LEVELS, LOG_LEVEL_ORDER, OTHER_LEVEL, guarded_ratio, log_level)
from runledger.sources.files import bare_path

LEVEL_COLUMNS = tuple(f"{lv.lower()}_count"
                      for lv in (*LOG_LEVEL_ORDER, OTHER_LEVEL))


def classify_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """P9 + P10: add ``level`` (null for blank lines)."""
    return lines.withColumn("level", log_level(F.col(line_col)))


def level_aggregates(level: Column) -> list[Column]:
    """lines, errors and the five per-level counts for one group."""
    exprs = [F.count(level).alias("lines"),
             F.count_if(level.isin(*ERROR_LEVELS)).alias("errors")]
    for name, lv in zip(LEVEL_COLUMNS, (*LOG_LEVEL_ORDER, OTHER_LEVEL)):
        exprs.append(F.count_if(level == lv).alias(name))
    return exprs


def profile_lines(lines: DataFrame, keys: list[str],
                  line_col: str = "line") -> DataFrame:
    """Per-key profile (lines, errors, five level counts)."""
    classified = classify_lines(lines, line_col)
    return classified.groupBy(*keys).agg(*level_aggregates(F.col("level")))


def profile_texts(docs: DataFrame, text_col: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """A7 for whole texts, one row per document, without explode/shuffle.

    Each text is split on ``\\n``; levels are computed per line with
    ``transform`` and counted with ``filter`` inside the row.
    """
    keep = keep or []
    levels = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")),
                                 "\n"), log_level)
    staged = docs.select(*keep, levels.alias("_levels"))

    def count_of(pred) -> Column:
        return F.size(F.filter(F.col("_levels"), pred)).cast("bigint")

    def equals(level: str):
        # A one-argument lambda: filter() treats two arguments as (x, index).
        return lambda x: x == F.lit(level)

    cols = [count_of(lambda x: x.isNotNull()).alias("lines"),
            count_of(lambda x: x.isin(*ERROR_LEVELS)).alias("errors")]
    for name, lv in zip(LEVEL_COLUMNS, (*LOG_LEVEL_ORDER, OTHER_LEVEL)):
        cols.append(count_of(equals(lv)).alias(name))
    return staged.select(*keep, *cols)


def profile_totals(profile: DataFrame, failed_col: str | None = None
                   ) -> DataFrame:
    """Totals over per-file profiles, error rate guarded (F8).

    ``failed_col`` marks files that could not be read (Q10: counted in
    ``total_files`` but not in ``processed_files``).
    """
    failed = F.col(failed_col) if failed_col else F.lit(False)
    agg = profile.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(~failed).alias("processed_files"),
        F.coalesce(F.sum(F.when(~failed, F.col("lines"))), F.lit(0))
        .cast("bigint").alias("total_log_lines"),
        F.coalesce(F.sum(F.when(~failed, F.col("errors"))), F.lit(0))
        .cast("bigint").alias("error_log_lines"))
    return agg.withColumn("error_rate",
                          guarded_ratio("error_log_lines", "total_log_lines"))


def check_level_invariant(profile: DataFrame) -> DataFrame:
    """Rows where the level counts do not sum to ``lines`` (should be none)."""
    total = sum((F.col(c) for c in LEVEL_COLUMNS), F.lit(0))
    return profile.where(total != F.col("lines"))


def most_recent(df: DataFrame, key: str, ts_col: str, k: int) -> DataFrame:
    """T1 over sources: last activity per key, newest first, first ``k``."""
    return (df.groupBy(key)
            .agg(F.max(ts_col).alias("last_ts"),
                 F.count(F.lit(1)).alias("lines"))
            .orderBy(F.col("last_ts").desc(), F.col(key).asc())
            .limit(k))


def profile_files(listing: DataFrame, lines: DataFrame) -> DataFrame:
    """A7 per listed log file with a ``failed`` flag (Q10).

    ``listing`` holds the log files (S7 + P8: path, length,
    modification_time); ``lines`` the scanned lines (``file``, ``line``).
    A listed file of size > 0 always yields at least one line, so a listed
    file without lines could not be read: it is marked failed and its
    counts are zero (it still counts in ``total_files``)."""
    per_file = profile_lines(lines, ["file"])
    joined = listing.select("path", "length", "modification_time").join(
        per_file, bare_path(listing["path"]) == per_file["file"], "left")
    read = per_file["file"].isNotNull()
    return joined.select(
        "path", "length", "modification_time",
        (~read).alias("failed"),
        *[F.coalesce(per_file[c], F.lit(0)).cast("bigint").alias(c)
          for c in ("lines", "errors", *LEVEL_COLUMNS)])
