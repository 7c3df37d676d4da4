"""The evidence of whole pipelines: run, log lines, parse, reconcile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators import csv_batch as cb
from runledger.operators import emitters as em
from runledger.operators import evidence as evo
from runledger.operators import json_items as ji
from runledger.operators import stages as st
from runledger.operators import validate as va
from runledger.plans import csv_queries as cq
from runledger.plans import json_queries as jq
from runledger.plans import log_queries as lq
from runledger.plans.registry import register
from runledger.session import materialized

CLOCK = "2024-02-01 00:00:00"
TARGET = "public.etl_data"
ITEMS_TABLE = "etl_items"
CRAWLER, DATABASE = "log-crawler", "logs"


def parsed(records: list[DataFrame], group: str) -> DataFrame:
    """The records written as log lines and parsed back."""
    lines = reduce(DataFrame.unionByName, [
        evo.evidence_log_lines(r, group, F.concat_ws(
            "-", F.col("batch_id").cast("string"),
            F.coalesce("evidence.step", F.lit("")),
            F.xxhash64(F.to_json("evidence")).cast("string")))
        for r in records])
    rows = evo.parse_log_events(lines, None, CLOCK)
    return rows.select(
        "batch_id", "step", "flow", F.coalesce("ok", F.lit(True)).alias("ok"),
        "note", F.coalesce("load_table", F.lit("")).alias("load_table"),
        F.coalesce("inserted_rows", F.lit(0)).alias("inserted_rows"),
        F.coalesce("evidence.load.dropped_rows", F.lit(0)).cast("bigint")
        .alias("dropped_rows"),
        F.coalesce("evidence.load.reason", F.lit("")).alias("reason"))


_CSV_SQL = cq.FILES_SUMMARY_SQL + """
, t AS (SELECT batch_id, CAST(count_if(reason IS NULL) AS BIGINT) AS good,
               CAST(count_if(reason IS NOT NULL) AS BIGINT) AS bad
        FROM r GROUP BY batch_id)
SELECT batch_id, 'prevalidate' AS step, 'csv-to-parquet-pipeline' AS flow,
       bad = 0 AND good > 0 AS ok,
       'Validated ' || good || ' files, ' || bad || ' errors' AS note,
       '' AS load_table, CAST(0 AS BIGINT) AS inserted_rows,
       CAST(0 AS BIGINT) AS dropped_rows, '' AS reason
FROM t
UNION ALL
SELECT batch_id, 'glue_convert', 'csv-to-parquet-pipeline', conv_ok,
       CASE WHEN conv_ok THEN 'Converted ' || (n + n // 4) || ' rows to '
                              || n || ' rows'
            ELSE 'Glue job failed: order pending' END, '', 0, 0, ''
FROM f
UNION ALL
SELECT batch_id, 'redshift_load', 'csv-to-parquet-pipeline', n > 0,
       CASE WHEN n > 0 THEN 'Loaded ' || n || ' rows into public.etl_data'
            ELSE 'no rows to load' END, 'public.etl_data', n,
       0, CASE WHEN n > 0 THEN 'successful load' ELSE 'no rows to load' END
FROM f WHERE conv_ok
UNION ALL
SELECT batch_id, 'finalize', 'csv-to-parquet-pipeline', status = 'SUCCESS',
       'Finalized batch ' || batch_id || ': ' || successful_conversions
           || ' conversions, ' || successful_loads || ' loads, '
           || failure_count || ' failures', 'consolidated_summary',
       total_loaded_rows, 0, 'Batch processing completed: '
           || successful_loads || '/' || total_input_files
           || ' files loaded successfully'
FROM summary
"""


@register("csv_pipeline_evidence", "S18 F13 P12 A1 A4", sql=_CSV_SQL)
def csv_pipeline_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation, conversion, load and finalize evidence of CSV batches."""
    results = cq._file_results(spark, sf_dir)
    results = materialized(results, "results")
    return parsed([
        em.prevalidate(va.validation_totals(cq._checked(spark, sf_dir)),
                       CLOCK),
        em.csv_convert(results, CLOCK),
        em.csv_load(results, TARGET, CLOCK),
        em.csv_finalize(cb.batch_summary(
            results, cq._prevalidate_errors(spark, sf_dir)), CLOCK)],
        "/aws/lambda/csv")


_JSON_SQL = jq._ITEMS_SQL + """
, w AS (SELECT i.batch_id, count_if(i.write_ok) AS s,
               count_if(NOT i.write_ok) AS f, count(*) AS n
        FROM i JOIN v ON i.batch_id = v.batch_id WHERE v.valid
        GROUP BY i.batch_id),
x AS (SELECT *, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) >= 0.9 AS good FROM w),
j AS (SELECT v.batch_id, CASE WHEN NOT v.valid THEN 'FAILED'
                              WHEN x.good THEN 'SUCCESS'
                              ELSE 'PARTIAL_SUCCESS' END AS status,
             CASE WHEN v.valid THEN x.s ELSE 0 END AS s,
             CASE WHEN v.valid THEN x.f ELSE 0 END AS f
      FROM v LEFT JOIN x ON v.batch_id = x.batch_id)
SELECT batch_id, 'dynamodb_write' AS step,
       'json-to-dynamodb-pipeline' AS flow, good AS ok,
       'DynamoDB書き込み' || CASE WHEN good THEN '成功' ELSE '失敗' END || ': '
           || s || '/' || n || '件 → etl_items' AS note,
       'etl_items' AS load_table, CAST(s AS BIGINT) AS inserted_rows,
       CAST(f AS BIGINT) AS dropped_rows,
       'DynamoDB batch write operation' AS reason
FROM x
UNION ALL
SELECT batch_id, 'finalize', 'json-to-dynamodb-pipeline', status = 'SUCCESS',
       'JSON処理完了: ' || status || ' | ' || s || '件成功, ' || f || '件失敗',
       'consolidated_summary', CAST(s AS BIGINT), CAST(f AS BIGINT),
       'JSON処理完了: ' || status
FROM j
"""


@register("json_pipeline_evidence", "S18 F13 P12 A5 A6", sql=_JSON_SQL)
def json_pipeline_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write and finalize evidence of the JSON batches."""
    _, results = jq._json_stages(spark, sf_dir)
    return parsed([
        em.json_write(ji.write_outcome(results), ITEMS_TABLE, CLOCK),
        em.json_finalize(jq.json_batch_stats(spark, sf_dir), CLOCK)],
        "/aws/lambda/json")


_LOG_SQL = lq._STAGES_SQL + """
, d AS (SELECT *, CASE WHEN NOT c_ok THEN 'LOG_COLLECT_FAILED'
                       WHEN NOT r_ok THEN 'CRAWLER_FAILED'
                       WHEN NOT q_ok THEN 'PARTIAL_SUCCESS'
                       ELSE 'SUCCESS' END AS status,
               CAST(batch_id AS VARCHAR) AS b,
               coalesce(files, 0) AS nf, coalesce(lines, 0) AS nl,
               coalesce(tables, 0) AS nt, coalesce(queries, 0) AS nq,
               coalesce(rows_, 0) AS nr
        FROM j),
e AS (SELECT *, CASE WHEN c_ok THEN nf ELSE 0 END AS of_,
             CASE WHEN c_ok THEN nl ELSE 0 END AS ol,
             CASE WHEN r_ok THEN nt ELSE 0 END AS ot,
             CASE WHEN q_ok THEN nr ELSE 0 END AS orr FROM d)
SELECT b AS batch_id, 'log_collect' AS step,
       'log-aggregation-athena-pipeline' AS flow, c_ok AS ok,
       'ログ収集' || CASE WHEN c_ok THEN '成功' ELSE '失敗' END
           || CASE WHEN nf > 0 THEN ': ' || nf || 'ファイル' ELSE '' END
           || CASE WHEN nl > 0 THEN ', ' || nl || '行処理' ELSE '' END
           AS note,
       '' AS load_table, CAST(0 AS BIGINT) AS inserted_rows,
       CAST(0 AS BIGINT) AS dropped_rows, '' AS reason
FROM e
UNION ALL
SELECT b, 'glue_crawler', 'log-aggregation-athena-pipeline', r_ok,
       'Glue Crawler' || CASE WHEN r_ok THEN '成功' ELSE '失敗' END || ': '
           || nt || 'テーブル作成 (log-crawler)', 'athena_tables_' || nt,
       nt, 0, 'Glue Crawler table creation'
FROM e WHERE c_ok AND r_present
UNION ALL
SELECT b, 'athena_query', 'log-aggregation-athena-pipeline', q_ok,
       'Athena分析' || CASE WHEN q_ok THEN '成功' ELSE '失敗' END || ': '
           || nq || '/' || nt || 'テーブル'
           || CASE WHEN nr > 0 THEN ', ' || nr || '行分析' ELSE '' END,
       'athena_analysis_results', nr, 0, 'Athena log analysis completed'
FROM e WHERE c_ok AND r_ok AND q_present
UNION ALL
SELECT b, 'finalize', 'log-aggregation-athena-pipeline',
       status = 'SUCCESS', 'ログ処理完了: ' || status || ' | ' || of_
           || 'ファイル, ' || ol || '行処理 | ' || ot || 'テーブル作成',
       'consolidated_log_summary', orr, 0, 'ログ処理完了: ' || status
FROM e
"""


@register("log_pipeline_evidence", "S18 F13 P12 A12", sql=_LOG_SQL)
def log_pipeline_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collect, register, query and finalize evidence of the log batches."""
    stages = materialized(lq._log_stages(spark, sf_dir), "log_stages")
    return parsed([
        em.log_collect(stages, CLOCK),
        em.log_register(stages, CRAWLER, DATABASE, CLOCK),
        em.log_query(stages, DATABASE, CLOCK),
        em.log_finalize(st.log_pipeline_status(stages), CLOCK)],
        "/aws/lambda/logs")
