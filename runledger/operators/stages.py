"""Per-batch stage joins (J4), pipeline statistics (A12, A6), the status
branch (P20) and failure lists (U2, U3).

Each stage result is a per-batch DataFrame with an ``ok`` flag.  A stage
that did not run for a batch is simply absent; left joins on ``batch_id``
turn absence into zeros.  Stage tables hold one row per batch, so these
joins shuffle batch-sized data, never the underlying rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.scalar import guarded_ratio

# Status names of the log pipeline's branches.
LOG_STATUS_SUCCESS = "SUCCESS"
LOG_STATUS_PARTIAL = "PARTIAL_SUCCESS"
LOG_STATUS_CRAWLER_FAILED = "CRAWLER_FAILED"
LOG_STATUS_COLLECT_FAILED = "LOG_COLLECT_FAILED"
JSON_STATUS_FAILED = "FAILED"
LOG_STEPS = 3


def _prefixed(df: DataFrame, prefix: str, key: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{prefix}_{c}")
                            for c in df.columns if c != key])


def join_stages(batches: DataFrame, stages: dict[str, DataFrame],
                key: str = "batch_id") -> DataFrame:
    """Left-join each stage's per-batch row, columns prefixed."""
    out = batches.select(key).distinct()
    for name, df in stages.items():
        out = out.join(_prefixed(df, name, key), key, "left")
    return out


def _ok(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(False))


def _if_ok(ok: Column, value: str) -> Column:
    return F.when(ok, F.coalesce(F.col(value), F.lit(0))).otherwise(F.lit(0)) \
        .cast("bigint")


def log_pipeline_status(joined: DataFrame) -> DataFrame:
    """P20 + A12 for the log pipeline.

    Expects stages ``collect`` (files, lines, errors), ``register``
    (tables) and ``query`` (queries, rows), each with ``ok``.  A later stage
    only counts when every earlier one succeeded (the branch order).
    """
    collect_ok = _ok("collect_ok")
    register_ran = collect_ok & F.col("register_ok").isNotNull()
    register_ok = collect_ok & _ok("register_ok")
    query_ok = register_ok & _ok("query_ok")
    status = (F.when(~collect_ok, LOG_STATUS_COLLECT_FAILED)
              .when(~register_ok, LOG_STATUS_CRAWLER_FAILED)
              .when(~query_ok, LOG_STATUS_PARTIAL)
              .otherwise(LOG_STATUS_SUCCESS))
    steps_ok = (collect_ok.cast("int") + register_ok.cast("int")
                + query_ok.cast("int"))
    return joined.select(
        "batch_id",
        status.alias("status"),
        _if_ok(collect_ok, "collect_files").alias("log_files_processed"),
        _if_ok(collect_ok, "collect_lines").alias("total_log_lines"),
        _if_ok(collect_ok, "collect_errors").alias("error_log_lines"),
        _if_ok(register_ok, "register_tables").alias("tables_created"),
        _if_ok(query_ok, "query_queries").alias("athena_queries_executed"),
        _if_ok(query_ok, "query_rows").alias("rows_analyzed"),
        (steps_ok / F.lit(float(LOG_STEPS))).alias("processing_success_rate"),
        register_ran.alias("register_ran"))


def json_batch_statistics(joined: DataFrame) -> DataFrame:
    """A6 + P20 for the JSON pipeline.

    Stages ``pre`` (received, processed, ok) and ``write`` (success,
    failed, ok).  ``input_items`` counts received items (Q24).
    """
    pre_ok = _ok("pre_ok")
    write_ok = pre_ok & _ok("write_ok")
    status = (F.when(~pre_ok, JSON_STATUS_FAILED)
              .when(~write_ok, LOG_STATUS_PARTIAL)
              .otherwise(LOG_STATUS_SUCCESS))
    processed = _if_ok(pre_ok, "pre_processed")
    success = _if_ok(pre_ok, "write_success")
    return joined.select(
        "batch_id", status.alias("status"),
        F.coalesce(F.col("pre_received"), F.lit(0)).cast("bigint")
        .alias("input_items"),
        processed.alias("preprocessed_items"),
        success.alias("dynamodb_success"),
        _if_ok(pre_ok, "write_failed").alias("dynamodb_failed"),
        guarded_ratio(success, processed).alias("success_rate"))


def failures_union(*parts: DataFrame) -> DataFrame:
    """Failure rows of every stage appended (union all)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  parts)


# Step names and default errors of the log pipeline.
LOG_FAILURE_STEPS = (("collect", "log_collect", "Log collection failed"),
                     ("register", "glue_crawler", "Glue crawler failed"),
                     ("query", "athena_query", "Athena query failed"))


def log_pipeline_failures(joined: DataFrame) -> DataFrame:
    """One row per failed stage that ran.  A stage runs only when every
    earlier one succeeded; an absent collect stage counts as failed.

    The candidate failures of a batch are built as a small array and
    exploded, so the joined stages are evaluated once (a union of three
    filters would plan the stage joins three times)."""
    collect_ok = _ok("collect_ok")
    register_ok = collect_ok & _ok("register_ok")
    ran = {"collect": F.lit(True),
           "register": collect_ok & F.col("register_ok").isNotNull(),
           "query": register_ok & F.col("query_ok").isNotNull()}
    candidates = []
    for stage, step, error in LOG_FAILURE_STEPS:
        err = (F.coalesce(F.col(f"{stage}_error"), F.lit(error))
               if f"{stage}_error" in joined.columns else F.lit(error))
        candidates.append(F.struct(
            F.lit(step).alias("step"), err.alias("error"),
            (ran[stage] & ~_ok(f"{stage}_ok")).alias("failed")))
    failed = F.filter(F.array(*candidates), lambda x: x["failed"])
    return (joined.select("batch_id", F.explode(failed).alias("f"))
            .select("batch_id", "f.step", "f.error"))
