"""Per-table statistics (A9, A10, P11), cross-table summary (A11), the table
cap (T2) and samples (T3, T4 with F5).

Row count and error-row count of a table are one aggregate over one scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runledger.functions.scalar import cell_display, guarded_ratio

# The error predicate's keywords (upper-case substring).
ERROR_KEYWORDS = ("ERROR", "WARN")

def error_predicate(c: Column) -> Column:
    """``UPPER(c) LIKE '%ERROR%' OR UPPER(c) LIKE '%WARN%'``."""
    upper = F.upper(c)
    return reduce(lambda a, b: a | b,
                  [upper.contains(k) for k in ERROR_KEYWORDS])


def first_tables(names: DataFrame, cap: int | None) -> DataFrame:
    """Flag the first ``cap`` tables by name (all when cap is None)."""
    if cap is None:
        return names.withColumn("analyzed", F.lit(True))
    # Names are catalog metadata (bounded), so one ordered window is fine.
    rank = F.row_number().over(Window.orderBy("table_name"))
    return names.withColumn("analyzed", rank <= cap)


def table_stats(spark: SparkSession, name: str, df: DataFrame,
                column: str) -> DataFrame:
    """A9 + A10 fused: one row with row and error-row counts.

    A missing column is reported as a failed table: ``ok`` false with the
    reason in ``error``, no error count (and left out of every summary); its
    rows are counted all the same.
    """
    known = column in df.columns
    errors = (F.count_if(error_predicate(F.col(column))) if known
              else F.lit(None).cast("bigint"))
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  errors.alias("error_count")).select(
        F.lit(name).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit(known).alias("ok"), "row_count", "error_count",
        F.lit(None if known else f"column {column} not found")
        .cast("string").alias("error"))


def tables_stats(spark: SparkSession,
                 specs: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """A9/A10 for several tables, one row each (union all)."""
    parts = [table_stats(spark, n, df, c) for n, df, c in specs]
    return reduce(DataFrame.unionByName, parts)


def stats_summary(stats: DataFrame) -> DataFrame:
    """Failed tables count in ``total_tables`` only; ``success`` when
    at least one table was analysed."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    out = stats.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(ok).alias("successful_tables"),
        F.coalesce(F.sum(F.when(ok, F.col("row_count"))), F.lit(0))
        .cast("bigint").alias("total_log_entries"),
        F.coalesce(F.sum(F.when(ok, F.col("error_count"))), F.lit(0))
        .cast("bigint").alias("total_error_entries"))
    return out.withColumns({
        "error_rate": guarded_ratio("total_error_entries",
                                    "total_log_entries"),
        # Q13: the analysis succeeds when at least one table succeeded.
        "success": F.col("successful_tables") > 0})


def sample_rows(df: DataFrame, n: int, order_by: list[str] | None = None
                ) -> DataFrame:
    """First ``n`` rows; ordered when a stable sample is needed."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def display_cells(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """F5 on every column except ``keep`` (applied after the limit)."""
    keep = keep or []
    return df.select(*[F.col(c) if c in keep else cell_display(c).alias(c)
                       for c in df.columns])
