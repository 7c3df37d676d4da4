"""CSV batch summary.

Per-file results of the conversion and load steps are joined to the
batch's files on the file key; the summary is a grouped aggregation.
Results arrive as raw JSON (an invoked step's ``Payload`` is sometimes an
object, sometimes a JSON string), decoded with built-in JSON functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.operators.stages import failures_union

# Job state, default error texts and batch statuses.
SUCCEEDED_STATE = "SUCCEEDED"
GLUE_DEFAULT_ERROR = "Glue job failed"
LOAD_DEFAULT_ERROR = "Redshift load failed"
STATUS_SUCCESS = "SUCCESS"
STATUS_PARTIAL_FAILURE = "PARTIAL_FAILURE"
STEP_CONVERT = "glue_convert"
STEP_LOAD = "redshift_load"
STEP_PREVALIDATE = "prevalidate"
PREVALIDATE_FILE = "validation"

PAYLOAD_SCHEMA = ("success boolean, inserted_rows bigint, table_rows bigint, "
                  "error string")


def decode_payload(raw: Column) -> Column:
    """``$.Payload`` as a struct whether it was an object or a string.

    ``get_json_object`` returns an object's JSON text and a string's
    content, which is the same JSON text in both cases.
    """
    return F.from_json(F.get_json_object(raw, "$.Payload"), PAYLOAD_SCHEMA)


def conversion_ok(state: Column) -> Column:
    """The job state is SUCCEEDED; an absent result is a failure."""
    return F.coalesce(state == F.lit(SUCCEEDED_STATE), F.lit(False))


def file_results(files: DataFrame, conversions: DataFrame,
                 loads: DataFrame) -> DataFrame:
    """``files(batch_id, key)`` left-joined with conversion results
    ``(batch_id, key, job_state, error_message, input_rows, rows)`` and raw
    load results ``(batch_id, key, load_result)``; a key may stand in several
    batches.  Attribution is by step (Q3)."""
    joined = (files.join(conversions, ["batch_id", "key"], "left")
              .join(loads, ["batch_id", "key"], "left"))
    payload = decode_payload(F.col("load_result"))
    return joined.select(
        "batch_id", "key",
        conversion_ok(F.col("job_state")).alias("converted"),
        F.coalesce(F.col("error_message"), F.lit(GLUE_DEFAULT_ERROR))
        .alias("convert_error"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("input_rows", "rows")],
        F.col("load_result").isNotNull().alias("load_ran"),
        F.coalesce(payload.success, F.lit(False)).alias("loaded"),
        F.coalesce(payload.inserted_rows, F.lit(0)).alias("inserted_rows"),
        F.coalesce(payload.error, F.lit(LOAD_DEFAULT_ERROR))
        .alias("load_error"))


def batch_summary(results: DataFrame,
                  prevalidate_errors: DataFrame | None = None) -> DataFrame:
    """A4: counts per batch; SUCCESS iff no failures and every file was
    both converted and loaded, else PARTIAL_FAILURE.  Row totals are
    summed from the conversion results (Q2).  A batch of which nothing but
    validation errors is known is listed too."""
    loaded = F.col("converted") & F.col("loaded")
    per_batch = results.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_input_files"),
        F.count_if("converted").alias("successful_conversions"),
        F.count_if(loaded).alias("successful_loads"),
        F.sum(F.when(F.col("converted"), F.col("input_rows")).otherwise(0))
        .cast("bigint").alias("total_input_rows"),
        F.sum(F.when(F.col("converted"), F.col("rows")).otherwise(0))
        .cast("bigint").alias("total_output_rows"),
        F.sum(F.when(loaded, F.col("inserted_rows")).otherwise(0))
        .cast("bigint").alias("total_loaded_rows"),
        (F.count_if(~F.col("converted"))
         + F.count_if(F.col("converted") & F.col("load_ran")
                      & ~F.col("loaded"))).alias("_step_failures"))
    counts = [c for c in per_batch.columns if c != "batch_id"]
    if prevalidate_errors is not None:
        pre = prevalidate_errors.groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("_pre_failures"))
        per_batch = per_batch.join(pre, "batch_id", "full_outer").select(
            "batch_id", *[F.coalesce(c, F.lit(0)).alias(c)
                          for c in [*counts, "_pre_failures"]])
    else:
        per_batch = per_batch.withColumn("_pre_failures", F.lit(0))
    failures = (F.col("_step_failures")
                + F.coalesce(F.col("_pre_failures"), F.lit(0))).cast("bigint")
    ok = ((failures == 0)
          & (F.col("successful_conversions") == F.col("total_input_files"))
          & (F.col("successful_loads") == F.col("total_input_files")))
    return per_batch.select(
        "batch_id", "total_input_files", "successful_conversions",
        "successful_loads", "total_input_rows", "total_output_rows",
        "total_loaded_rows", failures.alias("failure_count"),
        F.when(ok, STATUS_SUCCESS).otherwise(STATUS_PARTIAL_FAILURE)
        .alias("status"))


def batch_failures(results: DataFrame,
                   prevalidate_errors: DataFrame | None = None) -> DataFrame:
    """Conversion, load and validation failures as one long table."""
    # Both step failures come from the same joined results: build them as
    # a small array per file and explode it (one pass over the results).
    candidates = F.array(
        F.struct(F.lit(STEP_CONVERT).alias("step"),
                 F.col("convert_error").alias("error"),
                 (~F.col("converted")).alias("failed")),
        F.struct(F.lit(STEP_LOAD).alias("step"),
                 F.col("load_error").alias("error"),
                 (F.col("converted") & F.col("load_ran") & ~F.col("loaded"))
                 .alias("failed")))
    steps = (results.select("batch_id", F.col("key").alias("file"),
                            F.explode(F.filter(candidates,
                                               lambda x: x["failed"]))
                            .alias("f"))
             .select("batch_id", "f.step", "file", "f.error"))
    parts = [steps]
    if prevalidate_errors is not None:
        parts.append(prevalidate_errors.select(
            "batch_id", F.lit(STEP_PREVALIDATE).alias("step"),
            F.lit(PREVALIDATE_FILE).alias("file"),
            F.col("reason").alias("error")))
    return failures_union(*parts)
