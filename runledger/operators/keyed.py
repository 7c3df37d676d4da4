"""Skew-safe per-key operators: latest record per key (W2) and first-n per
group (W1).

Both are written so that no single key can pin one task:

* latest-per-key keeps the first row of a ranking, which Spark applies within
  each task before the shuffle (a window group limit), so a key with a billion
  copies costs one row per task;
* first-n-per-group ranks inside ``(group, salt)`` first (a hot group is
  spread over ``salt_buckets`` tasks), keeps ``n`` per salt, and ranks the
  at most ``n * salt_buckets`` survivors per group in a second pass.
  The result is exact: any global top-n row is in the top-n of its salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DEFAULT_SALT_BUCKETS = 32


def latest_per_key(df: DataFrame, keys: list[str], order: list[str],
                   tie: Column | None = None) -> DataFrame:
    """The row with the greatest ``order`` tuple per key.

    Rows that are equal in it are told apart by ``tie`` (default: a hash of
    the whole row as JSON), so the result is deterministic; columns of any
    type may be carried.
    """
    if tie is None:
        tie = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    rank = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in order], tie.desc())
    return (df.withColumn("_rank", F.row_number().over(rank))
            .where("_rank = 1").drop("_rank"))


def first_n_per_group(df: DataFrame, group: list[str], order: list[Column],
                      n: int, rank_col: str = "rank",
                      salt_buckets: int = DEFAULT_SALT_BUCKETS,
                      salt_on: Column | None = None) -> DataFrame:
    """The first ``n`` rows per group by ``order`` with their rank.

    ``salt_on`` (default: a hash of all columns) spreads one group over
    ``salt_buckets`` partial rankings.
    """
    salt_src = salt_on if salt_on is not None else F.xxhash64(*df.columns)
    salted = df.withColumn("_salt", F.pmod(salt_src, F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    partial = (salted.withColumn("_r1", F.row_number().over(w1))
               .where(F.col("_r1") <= n).drop("_r1", "_salt"))
    w2 = Window.partitionBy(*group).orderBy(*order)
    return (partial.withColumn(rank_col,
                               F.row_number().over(w2).cast("bigint"))
            .where(F.col(rank_col) <= n))


def upsert(base: DataFrame, updates: DataFrame, keys: list[str],
           order: list[str]) -> DataFrame:
    """Put by key, last write wins.  Base rows without an update are
    kept; every updated key holds its latest update.  The updates are
    reduced once and met by the base in one full outer join."""
    latest = latest_per_key(updates.select(
        *base.columns, *[c for c in order if c not in base.columns]),
        keys, order).select(*base.columns)
    put = latest.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                        F.struct(*base.columns).alias("_put"))
    same = F.lit(True)
    for k in keys:
        same = same & base[k].eqNullSafe(F.col(f"_k_{k}"))
    joined = base.join(put, same, "full_outer")
    return joined.select(*[
        F.when(F.col("_put").isNotNull(), F.col(f"_put.{c}"))
        .otherwise(base[c]).alias(c) for c in base.columns])
