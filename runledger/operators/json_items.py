"""JSON batch validation, enrichment and write statistics
(S5, P3-P7, J6, A5, W1, U2).

Documents and items are variants, so the JSON type of every value is known: a
string that looks like a list is not one, numbers and nested objects stay what
they are, and an absent field can be told apart from one that is null (Q6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions.scalar import guarded_ratio, ttl_epoch
from runledger.operators.keyed import first_n_per_group

# Required fields, messages, threshold and default names.
REQUIRED_FIELDS = ("name", "category")
FLATTENED_FIELDS = ("name", "category", "description")
MSG_NOT_OBJECT = "データがDict形式ではありません"
MSG_NO_ITEMS = "'items'キーが存在しません"
MSG_NOT_LIST = "'items'がリスト形式ではありません"
MSG_EMPTY = "'items'が空です"
MSG_MISSING_FIELD = "アイテム%d: 必須フィールド'%s'が存在しません"
MSG_VALIDATION_FAILED = "JSON検証失敗"
MSG_WRITE_FAILED = "Write failed"
SUCCESS_THRESHOLD = 0.9
STATUS_SUCCESS = "SUCCESS"
STATUS_PARTIAL = "PARTIAL_SUCCESS"
STEP_PREPROCESS = "json_preprocess"
STEP_WRITE = "dynamodb_write"
REPORTED_WRITE_FAILURES = 5
SUMMARY_WRITE_FAILURES = 3


# S5 -------------------------------------------------------------------------
def read_batch_documents(spark: SparkSession, path: str,
                         multi_line: bool = True) -> DataFrame:
    """JSON batch documents, ``input_data`` as a variant.

    ``multi_line``: one (pretty-printed) document per file; otherwise one
    document per line, which splits across tasks for large inputs."""
    return (spark.read.option("multiLine", str(multi_line).lower())
            .schema("batch_id string, input_data variant").json(path))


def read_item_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one item per line: ``batch_id, item_index, item``."""
    return spark.read.schema(
        "batch_id string, item_index long, item variant").json(path)


def _kind(value: Column) -> Column:
    """JSON type of a variant: OBJECT, ARRAY, STRING, ... (null if none)."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def fields(item: Column) -> Column:
    """The fields of an item; null for anything but an object."""
    return F.when(_kind(item) == "OBJECT", F.variant_get(
        item, "$", "map<string,variant>"))


def field_names(item: Column) -> Column:
    return F.coalesce(F.map_keys(fields(item)),
                      F.array().cast("array<string>"))


def text_of(value: Column) -> Column:
    """A variant as text: strings as they are, other values as JSON; a JSON
    null (or no value) is null."""
    return F.when(_kind(value) == "STRING",
                  F.try_variant_get(value, "$", "string")).when(
        F.is_variant_null(value), F.lit(None)).otherwise(F.to_json(value))


# P3 -------------------------------------------------------------------------
def structure_check(docs: DataFrame) -> DataFrame:
    """Batch-level structure error (null when the structure is valid)."""
    data = F.col("input_data")
    items = F.try_variant_get(data, "$.items", "variant")
    kind = F.coalesce(_kind(data), F.lit("VOID"))
    n = F.size(F.when(_kind(items) == "ARRAY", F.variant_get(
        items, "$", "array<variant>")))
    error = (F.when(kind != "OBJECT", MSG_NOT_OBJECT)
             .when(~F.array_contains(field_names(data), "items"),
                   MSG_NO_ITEMS)
             .when(F.coalesce(_kind(items), F.lit("VOID")) != "ARRAY",
                   MSG_NOT_LIST)
             .when(n == 0, MSG_EMPTY))
    return docs.select("batch_id", "input_data",
                       error.alias("structure_error"))


def explode_items(checked: DataFrame) -> DataFrame:
    """Items of structurally valid documents with their 0-based index."""
    return (checked.where(F.col("structure_error").isNull())
            .select("batch_id", F.posexplode(F.variant_get(
                "input_data", "$.items", "array<variant>"))
                .alias("item_index", "item"))
            .select("batch_id", F.col("item_index").cast("bigint"), "item"))


# P4 -------------------------------------------------------------------------
def field_violations(items: DataFrame,
                     required: tuple[str, ...] = REQUIRED_FIELDS
                     ) -> DataFrame:
    """One row per (item, missing field) with the indexed message.
    Presence is tested, not non-null (a null ``name`` passes)."""
    keys = field_names(F.col("item"))
    missing = F.filter(F.array(*[F.lit(f) for f in required]),
                       lambda f: ~F.array_contains(keys, f))
    return (items.select("batch_id", "item_index",
                         F.explode(missing).alias("field"))
            .withColumn("message", F.format_string(
                MSG_MISSING_FIELD, F.col("item_index"), F.col("field"))))


def batch_validation(items: DataFrame,
                     structure: DataFrame | None = None) -> DataFrame:
    """P3 + P4 per batch: received items, violations and ``valid``."""
    keys = field_names(F.col("item"))
    per_item = items.select(
        "batch_id", "item_index",
        *[(~F.array_contains(keys, f)).alias(f"_miss_{f}")
          for f in REQUIRED_FIELDS])
    bad = F.lit(False)
    for f in REQUIRED_FIELDS:
        bad = bad | F.col(f"_miss_{f}")
    out = per_item.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("received_items"),
        *[F.count_if(f"_miss_{f}").alias(f"missing_{f}")
          for f in REQUIRED_FIELDS],
        F.min(F.when(bad, F.col("item_index"))).alias("_first_bad"))
    violations = sum((F.col(f"missing_{f}") for f in REQUIRED_FIELDS),
                     F.lit(0)).cast("bigint")
    out = out.select(
        "batch_id", "received_items",
        *[f"missing_{f}" for f in REQUIRED_FIELDS],
        violations.alias("violations"),
        F.coalesce("_first_bad", F.lit(-1)).cast("bigint")
        .alias("first_violation_index"))
    if structure is not None:
        s = structure.select("batch_id", "structure_error")
        out = (s.join(out, "batch_id", "left")
               .select("batch_id",
                       *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                         for c in ("received_items",
                                   *[f"missing_{f}" for f in REQUIRED_FIELDS],
                                   "violations")],
                       F.coalesce("first_violation_index", F.lit(-1))
                       .alias("first_violation_index"),
                       "structure_error"))
        return out.withColumn("valid", (F.col("violations") == 0)
                              & F.col("structure_error").isNull())
    return out.withColumn("valid", F.col("violations") == 0)


# P5 / J6 --------------------------------------------------------------------
def accepted_items(items: DataFrame, validation: DataFrame) -> DataFrame:
    """All-or-nothing: items of batches without any violation (anti join)."""
    rejected = validation.where(~F.col("valid")).select("batch_id")
    return items.join(rejected, "batch_id", "left_anti")


# P6 / P7 --------------------------------------------------------------------
def item_id(batch_id: Column, item_index: Column) -> Column:
    """Deterministic id, so a replayed batch overwrites the same keys (Q7)."""
    return F.sha2(F.concat_ws("|", batch_id, item_index.cast("string")), 256)


def enrich_items(items: DataFrame, clock: str) -> DataFrame:
    """P6 + P7: id, timestamps, flattened fields (missing -> '', null stays
    null), the whole item as JSON with its types and the TTL in epoch
    seconds."""
    now = F.lit(clock).cast("timestamp_ntz")
    items = items.withColumn("_fields", fields(F.col("item")))
    keys = F.coalesce(F.map_keys("_fields"), F.array().cast("array<string>"))
    return items.select(
        item_id(F.col("batch_id"), F.col("item_index")).alias("id"),
        "batch_id", "item_index",
        now.alias("timestamp"), now.alias("processed_at"),
        *[F.when(F.array_contains(keys, f), text_of(F.col("_fields")[f]))
          .otherwise(F.lit("")).alias(f) for f in FLATTENED_FIELDS],
        F.to_json("item").alias("metadata"),
        ttl_epoch(F.lit(clock)).cast("bigint").alias("ttl"))


# A5 -------------------------------------------------------------------------
def write_outcome(results: DataFrame) -> DataFrame:
    """Per batch from ``(batch_id, item_index, ok)`` write results."""
    out = results.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if("ok").alias("success_count"),
        F.count_if(~F.col("ok")).alias("failed_count"))
    rate = guarded_ratio("success_count", "total_items")
    ok = rate >= F.lit(SUCCESS_THRESHOLD)
    return out.select("*", rate.alias("success_rate"), ok.alias("success"),
                      F.when(ok, STATUS_SUCCESS).otherwise(STATUS_PARTIAL)
                      .alias("status"))


# W1 -------------------------------------------------------------------------
def first_failures(results: DataFrame, n: int = REPORTED_WRITE_FAILURES
                   ) -> DataFrame:
    """First ``n`` failed items per batch by item index."""
    failed = results.where(~F.col("ok"))
    return first_n_per_group(failed, ["batch_id"],
                             [F.col("item_index").asc()], n,
                             salt_on=F.xxhash64("item_index"))


# U2 -------------------------------------------------------------------------
def validation_errors(violations: DataFrame,
                      structure: DataFrame | None = None) -> DataFrame:
    """(batch_id, item_index, error): every message of the validation."""
    out = violations.select("batch_id", "item_index",
                            F.col("message").alias("error"))
    if structure is not None:
        out = out.unionByName(
            structure.where(F.col("structure_error").isNotNull()).select(
                "batch_id", F.lit(-1).cast("bigint").alias("item_index"),
                F.col("structure_error").alias("error")))
    return out


def batch_failures(errors: DataFrame, results: DataFrame) -> DataFrame:
    """All validation errors of rejected batches plus the first three write
    failures of a batch."""
    pre = errors.select("batch_id", F.lit(STEP_PREPROCESS).alias("step"),
                        "item_index", "error")
    writes = first_failures(results, SUMMARY_WRITE_FAILURES).select(
        "batch_id", F.lit(STEP_WRITE).alias("step"), "item_index",
        F.coalesce(F.col("error"), F.lit(MSG_WRITE_FAILED)).alias("error"))
    return pre.unionByName(writes)


# Q25 / S18 ------------------------------------------------------------------
# Flow, step and note texts of the preprocess evidence.
JSON_FLOW = "json-to-dynamodb-pipeline"
NOTE_PREPROCESS = "JSON前処理%s: %d→%d件"
NOTE_OK, NOTE_FAILED = "成功", "失敗"


def preprocess_evidence(validation: DataFrame, clock: str) -> DataFrame:
    """Evidence of the preprocess step per batch, with the item counts in
    ``input.items`` / ``output.items`` (not only in the note)."""
    received = F.col("received_items")
    accepted = F.when(F.col("valid"), received).otherwise(F.lit(0))
    return validation.select("batch_id", F.struct(
        F.col("batch_id").alias("batch_id"), F.lit("").alias("test_id"),
        F.lit(JSON_FLOW).alias("flow"), F.lit(STEP_PREPROCESS).alias("step"),
        F.format_string(NOTE_PREPROCESS,
                        F.when(F.col("valid"), NOTE_OK).otherwise(NOTE_FAILED),
                        received, accepted).alias("note"),
        F.when(~F.col("valid"), MSG_VALIDATION_FAILED).alias("error"),
        F.col("valid").alias("ok"),
        F.lit(clock.replace(" ", "T")).alias("ts"),
        F.struct(received.alias("items")).alias("input"),
        F.struct(accepted.cast("bigint").alias("items")).alias("output"))
        .alias("evidence"))
