"""S18 + F13: the evidence each pipeline step emits.

One function per step turns the step's per-batch result into ``(batch_id,
evidence)`` rows; ``evidence.evidence_log_lines`` makes log lines of them,
which are parsed, stored and rolled up like any other step's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.scalar import note_text

# Flow names, tables, reasons and the parts of the note texts.
CSV_FLOW = "csv-to-parquet-pipeline"
JSON_FLOW = "json-to-dynamodb-pipeline"
LOG_FLOW = "log-aggregation-athena-pipeline"
OK_WORD, FAILED_WORD = "成功", "失敗"
JSON_TARGET_REASON = "DynamoDB batch write operation"
REGISTER_REASON = "Glue Crawler table creation"
QUERY_REASON = "Athena log analysis completed"


def _text(template: str, *values: Column) -> Column:
    """``template`` with each {} replaced by a value's text."""
    parts, rest = [], template
    for v in values:
        head, _, rest = rest.partition("{}")
        parts += [F.lit(head), v.cast("string")]
    return F.concat(*parts, F.lit(rest))


def _word(ok: Column) -> Column:
    return F.when(ok, OK_WORD).otherwise(FAILED_WORD)


def _struct(values: dict[str, Column]) -> Column:
    return F.struct(*[v.alias(k) for k, v in values.items()])


def _load(table: Column, inserted: Column, dropped: Column, reason: Column
          ) -> dict[str, Column]:
    return {"table": table, "inserted_rows": inserted.cast("bigint"),
            "dropped_rows": dropped.cast("bigint"), "reason": reason}


def _emit(df: DataFrame, flow: str, step: str, ok: Column, note: Column,
          clock: str, inputs: dict[str, Column], outputs: dict[str, Column],
          load: dict[str, Column] | None = None) -> DataFrame:
    ts = F.lit(clock.replace(" ", "T"))
    parts = {"batch_id": F.col("batch_id"), "test_id": F.lit(""),
             "flow": F.lit(flow), "step": F.lit(step), "ok": ok, "ts": ts,
             "note": note, "input": _struct(inputs),
             "output": _struct(outputs)}
    if load:
        parts["load"] = _struct(load)
    return df.select("batch_id", _struct(parts).alias("evidence"))


def _c(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint")


def prevalidate(totals: DataFrame, clock: str) -> DataFrame:
    """From A1 (``validate.validation_totals``)."""
    return _emit(
        totals, CSV_FLOW, "prevalidate", F.col("success"),
        _text("Validated {} files, {} errors", _c("validated_files"),
              _c("error_count")), clock,
        {"files_count": _c("files_count"),
         "total_size_bytes": _c("total_size_bytes")},
        {"validated_files": _c("validated_files"),
         "errors": _c("error_count").cast("string")})


def csv_convert(results: DataFrame, clock: str) -> DataFrame:
    """From the per-file results (J3), one record per file."""
    ok = F.col("converted")
    n_in, n_out = _c("input_rows"), _c("rows")
    return _emit(
        results, CSV_FLOW, "glue_convert", ok,
        F.when(ok, _text("Converted {} rows to {} rows", n_in, n_out))
        .otherwise(F.col("convert_error")), clock,
        {"s3": F.col("key"), "rows": F.when(ok, n_in).otherwise(0)},
        {"rows": F.when(ok, n_out).otherwise(0),
         "format": F.lit("parquet")})


def csv_load(results: DataFrame, table: str, clock: str) -> DataFrame:
    """From the per-file results (J3) that reached the load; one record per
    file."""
    ran = results.where("load_ran")
    ok, n = F.col("loaded"), _c("inserted_rows")
    error = F.col("load_error")
    return _emit(
        ran, CSV_FLOW, "redshift_load", ok,
        F.when(ok, _text("Loaded {} rows into {}", n, F.lit(table)))
        .otherwise(error), clock, {"file": F.col("key")},
        {"s3": F.lit(""), "rows": F.when(ok, n).otherwise(0)},
        _load(F.lit(table), n, F.lit(0),
              F.when(ok, "successful load").otherwise(error)))


def csv_finalize(summary: DataFrame, clock: str) -> DataFrame:
    """From A4 (``csv_batch.batch_summary``)."""
    conv, loads = _c("successful_conversions"), _c("successful_loads")
    files, failures = _c("total_input_files"), _c("failure_count")
    return _emit(
        summary, CSV_FLOW, "finalize", F.col("status") == "SUCCESS",
        _text("Finalized batch {}: {} conversions, {} loads, {} failures",
              F.col("batch_id"), conv, loads, failures), clock,
        {"total_files": files, "batch_id": F.col("batch_id")},
        {"successful_conversions": conv, "successful_loads": loads,
         "total_failures": failures},
        _load(F.lit("consolidated_summary"), _c("total_loaded_rows"),
              F.lit(0), _text("Batch processing completed: {}/{} files loaded "
                              "successfully", loads, files)))


def json_write(outcome: DataFrame, table: str, clock: str) -> DataFrame:
    """From A5 (``json_items.write_outcome``)."""
    done, total = _c("success_count"), _c("total_items")
    return _emit(
        outcome, JSON_FLOW, "dynamodb_write", F.col("success"),
        _text("DynamoDB書き込み{}: {}/{}件 → {}", _word(F.col("success")),
              done, total, F.lit(table)), clock,
        {"items": total}, {"items": done},
        _load(F.lit(table), done, _c("failed_count"),
              F.lit(JSON_TARGET_REASON)))


def json_finalize(stats: DataFrame, clock: str) -> DataFrame:
    """From A6 (``stages.json_batch_statistics``)."""
    done, failed = _c("dynamodb_success"), _c("dynamodb_failed")
    title = _text("JSON処理完了: {}", F.col("status"))
    return _emit(
        stats, JSON_FLOW, "finalize", F.col("status") == "SUCCESS",
        note_text(title, _text("{}件成功, {}件失敗", done, failed)), clock,
        {"total_items": _c("input_items"), "batch_id": F.col("batch_id")},
        {"successful_writes": done, "failed_writes": failed,
         "success_rate": F.col("success_rate")},
        _load(F.lit("consolidated_summary"), done, failed, title))


def log_collect(stages: DataFrame, clock: str) -> DataFrame:
    """From the joined log stages (J4), columns ``collect_*``."""
    ok = F.coalesce("collect_ok", F.lit(False))
    files, lines = _c("collect_files"), _c("collect_lines")
    return _emit(
        stages, LOG_FLOW, "log_collect", ok,
        F.concat(_text("ログ収集{}", _word(ok)),
                 F.when(files > 0, _text(": {}ファイル", files))
                 .otherwise(""),
                 F.when(lines > 0, _text(", {}行処理", lines))
                 .otherwise("")), clock,
        {"files": files},
        {"lines": lines, "errors": _c("collect_errors").cast("string")})


def log_register(stages: DataFrame, crawler: str, database: str, clock: str
                 ) -> DataFrame:
    """From the register stage, of the batches where it ran."""
    ran = stages.where("collect_ok and register_ok is not null")
    ok, n = F.col("register_ok"), _c("register_tables")
    return _emit(
        ran, LOG_FLOW, "glue_crawler", ok,
        _text("Glue Crawler{}: {}テーブル作成 ({})", _word(ok), n,
              F.lit(crawler)), clock,
        {"crawler": F.lit(crawler), "database": F.lit(database)},
        {"tables": n},
        _load(_text("athena_tables_{}", n), n, F.lit(0),
              F.lit(REGISTER_REASON)))


def log_query(stages: DataFrame, database: str, clock: str) -> DataFrame:
    """From the query stage, of the batches where it ran."""
    ran = stages.where("collect_ok and register_ok and query_ok is not null")
    ok, rows = F.col("query_ok"), _c("query_rows")
    done, tables = _c("query_queries"), _c("register_tables")
    return _emit(
        ran, LOG_FLOW, "athena_query", ok,
        F.concat(_text("Athena分析{}: {}/{}テーブル", _word(ok), done, tables),
                 F.when(rows > 0, _text(", {}行分析", rows)).otherwise("")),
        clock, {"database": F.lit(database), "tables": tables},
        {"analyzed_rows": rows, "successful_queries": done},
        _load(F.lit("athena_analysis_results"), rows, F.lit(0),
              F.lit(QUERY_REASON)))


def log_finalize(status: DataFrame, clock: str) -> DataFrame:
    """From A12 (``stages.log_pipeline_status``)."""
    title = _text("ログ処理完了: {}", F.col("status"))
    tables, rows = _c("tables_created"), _c("rows_analyzed")
    return _emit(
        status, LOG_FLOW, "finalize", F.col("status") == "SUCCESS",
        note_text(title, _text("{}ファイル, {}行処理",
                               _c("log_files_processed"),
                               _c("total_log_lines")),
                  _text("{}テーブル作成", tables)), clock,
        {"log_files": _c("log_files_processed"),
         "batch_id": F.col("batch_id")},
        {"tables_created": tables, "rows_analyzed": rows,
         "success_rate": F.col("processing_success_rate")},
        _load(F.lit("consolidated_log_summary"), rows, F.lit(0), title))
