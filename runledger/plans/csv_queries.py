"""CSV-load driver queries: manifest validation, batch summary, round trip."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.operators import csv_batch as cb
from runledger.operators import validate as va
from runledger.plans.registry import register, table
from runledger.session import materialized, new_run_dir
from runledger.sources import csv_parquet as cp
from runledger.sources import csv_records as cr
from runledger.sources import load_ledger
from runledger.sources.files import list_files

# Fixed derivation values: file suffix per language (others ".csv") and a
# byte size per character so that long documents exceed the size limit.
EXT_BY_LANG = {"fr": ".CSV", "de": ".json"}
DEFAULT_EXT = ".csv"
BYTES_PER_CHAR = 100_000
BUCKET = "landing"
URL_LANG = r"/(en|fr|de|es)/"


def _ext(lang: Column) -> Column:
    out = None
    for k, v in EXT_BY_LANG.items():
        out = F.when(lang == k, v) if out is None else out.when(lang == k, v)
    return out.otherwise(DEFAULT_EXT)


_EXT_SQL = ("CASE {c} WHEN 'fr' THEN '.CSV' WHEN 'de' THEN '.json' "
            "ELSE '.csv' END")


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory of landed files, one per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang",
                                                     "n_chars")
    return docs.select(
        F.lit(BUCKET).alias("bucket"),
        F.concat(F.lit("incoming/doc_"), F.col("doc_id").cast("string"),
                 _ext(F.col("lang"))).alias("key"),
        (F.col("n_chars") * BYTES_PER_CHAR).cast("bigint").alias("file_size"),
        F.lit(None).cast("timestamp").alias("last_modified"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest entries, one per page, batched by the page's language."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    lang = F.regexp_extract("url", URL_LANG, 1)
    return pages.select(
        F.concat(F.lit("M_"), F.coalesce(F.nullif(lang, F.lit("")),
                                         F.lit("other"))).alias("batch_id"),
        F.col("page_id").alias("file_index"),
        F.lit(BUCKET).alias("bucket"),
        F.concat(F.lit("incoming/doc_"), F.col("page_id").cast("string"),
                 _ext(lang)).alias("key"))


_CHECKED_SQL = f"""
WITH lst AS (SELECT 'landing' AS bucket,
                    'incoming/doc_' || CAST(doc_id AS VARCHAR)
                        || {_EXT_SQL.format(c='lang')} AS key,
                    CAST(n_chars * 100000 AS BIGINT) AS fs FROM documents),
m AS (SELECT 'M_' || coalesce(nullif(regexp_extract(url, '{URL_LANG}', 1), ''),
                              'other') AS batch_id,
             page_id AS file_index, 'landing' AS bucket,
             'incoming/doc_' || CAST(page_id AS VARCHAR)
                 || {_EXT_SQL.format(c=f"regexp_extract(url, '{URL_LANG}', 1)")}
                 AS key
      FROM pages),
j AS (SELECT m.*, lst.fs, lst.key IS NOT NULL AS found
      FROM m LEFT JOIN lst ON m.bucket = lst.bucket AND m.key = lst.key),
r AS (SELECT batch_id, file_index, bucket, key,
             's3://' || bucket || '/' || key AS uri, found,
             CAST(coalesce(fs, 0) AS BIGINT) AS file_size,
             CASE WHEN NOT found
                      THEN 'Error accessing ' || key || ': object not found'
                  WHEN fs > 1073741824
                      THEN 'File too large: ' || key || ' ('
                           || CAST(fs AS VARCHAR) || ' bytes)'
                  WHEN NOT (lower(key) LIKE '%.csv')
                      THEN 'Not a CSV file: ' || key END AS reason
      FROM j)
"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.validate_files(_manifest(spark, sf_dir), _listing(spark, sf_dir))


@register("manifest_validation", "S9 J1 P2 F6", sql=_CHECKED_SQL + """
SELECT *, reason IS NULL AS valid FROM r
""")
def manifest_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).drop("last_modified")


@register("manifest_batch_totals", "A1", sql=_CHECKED_SQL + """
SELECT batch_id, CAST(count(*) AS BIGINT) AS files_count,
       CAST(sum(file_size) AS BIGINT) AS total_size_bytes,
       CAST(count_if(reason IS NULL) AS BIGINT) AS validated_files,
       CAST(count_if(reason IS NOT NULL) AS BIGINT) AS error_count,
       count_if(reason IS NOT NULL) = 0 AND count_if(reason IS NULL) > 0
           AS success
FROM r GROUP BY batch_id
""")
def manifest_batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.validation_totals(_checked(spark, sf_dir))


# ---------------------------------------------------------------------------
PENDING_ERROR = "Glue job failed: order pending"
NO_ROWS_ERROR = "no rows to load"
KEYS = 3   # file numbers of a customer


def _file_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer are files, batched by priority; the same file
    name stands in several batches.  Pending orders fail their conversion; a
    converted file loads its line items, and one without items fails its
    load.  Load payloads alternate between a JSON string and an object."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    counts = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
              .agg(F.count(F.lit(1)).alias("n")))
    pending = F.col("o_orderstatus") == "P"
    n = F.coalesce("n", F.lit(0))
    # A fifth of the rows of a file are read and not written.
    base = materialized(orders.join(
        counts, orders.o_orderkey == counts.l_orderkey, "left").select(
        F.col("o_orderpriority").alias("batch_id"),
        F.concat(F.lit("orders/"), (F.col("o_orderkey") % KEYS)
                 .cast("string"), F.lit("-"), F.col("o_custkey")
                 .cast("string"), F.lit(".csv")).alias("key"),
        pending.alias("pending"), (F.col("o_orderstatus") == "O")
        .alias("nested"), n.alias("n")).groupBy("batch_id", "key").agg(
        F.bool_or("pending").alias("pending"),
        F.bool_or("nested").alias("nested"), F.sum("n").alias("n")),
        "file_results")
    files = base.select("batch_id", "key")
    conversions = base.select(
        "batch_id", "key",
        F.when(F.col("pending"), "FAILED").otherwise(cb.SUCCEEDED_STATE)
        .alias("job_state"),
        F.when(F.col("pending"), PENDING_ERROR).alias("error_message"),
        (F.col("n") + F.expr("n div 4")).alias("input_rows"),
        F.col("n").alias("rows"))
    payload = F.to_json(F.struct(
        (F.col("n") > 0).alias("success"),
        F.col("n").alias("inserted_rows"),
        F.when(F.col("n") == 0, NO_ROWS_ERROR).alias("error")))
    loads = base.where("not pending").select(
        "batch_id", "key",
        F.when(F.col("nested"), F.to_json(F.struct(payload.alias("Payload"))))
        .otherwise(F.concat(F.lit('{"Payload":'), payload, F.lit("}")))
        .alias("load_result"))
    return cb.file_results(files, conversions, loads)


def _prevalidate_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation errors of the batches, and of one with nothing else."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 50 = 0")
    return orders.select(
        F.when(F.col("o_orderkey") % 100 == 0, F.lit("0-REJECTED"))
        .otherwise(F.col("o_orderpriority")).alias("batch_id"),
        F.concat(F.lit("Not a CSV file: "), F.col("o_orderkey")
                 .cast("string")).alias("reason"))


_FILES_SQL = f"""
WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
f AS (SELECT o.o_orderpriority AS batch_id,
             'orders/' || CAST(o.o_orderkey % {KEYS} AS VARCHAR) || '-'
                 || CAST(o.o_custkey AS VARCHAR) || '.csv' AS key,
             NOT bool_or(o.o_orderstatus = 'P') AS conv_ok,
             CAST(sum(coalesce(n.n, 0)) AS BIGINT) AS n
      FROM orders o LEFT JOIN n ON o.o_orderkey = n.l_orderkey
      GROUP BY 1, 2),
p AS (SELECT CASE WHEN o_orderkey % 100 = 0 THEN '0-REJECTED'
                  ELSE o_orderpriority END AS batch_id,
             'Not a CSV file: ' || CAST(o_orderkey AS VARCHAR) AS reason
      FROM orders WHERE o_orderkey % 50 = 0)
"""


SUMMARY_CTE = """
, a AS (SELECT batch_id, 1 AS files, conv_ok, n, 0 AS pre FROM f
        UNION ALL SELECT batch_id, 0, NULL, 0, 1 FROM p),
s AS (SELECT batch_id, CAST(sum(files) AS BIGINT) AS total_input_files,
             CAST(count_if(coalesce(conv_ok, false)) AS BIGINT)
                 AS successful_conversions,
             CAST(count_if(coalesce(conv_ok AND n > 0, false)) AS BIGINT)
                 AS successful_loads,
             CAST(sum(CASE WHEN conv_ok THEN n + n // 4 ELSE 0 END) AS BIGINT)
                 AS total_input_rows,
             CAST(sum(CASE WHEN conv_ok THEN n ELSE 0 END) AS BIGINT)
                 AS total_output_rows,
             CAST(sum(CASE WHEN conv_ok AND n > 0 THEN n ELSE 0 END) AS BIGINT)
                 AS total_loaded_rows,
             CAST(count_if(coalesce(NOT conv_ok, false))
                  + count_if(coalesce(conv_ok AND n = 0, false))
                  + sum(pre) AS BIGINT) AS failure_count
      FROM a GROUP BY batch_id),
summary AS (SELECT *, CASE WHEN failure_count = 0
                    AND successful_conversions = total_input_files
                    AND successful_loads = total_input_files
               THEN 'SUCCESS' ELSE 'PARTIAL_FAILURE' END AS status
FROM s)
"""
FILES_SUMMARY_SQL = (_FILES_SQL + SUMMARY_CTE
                     + _CHECKED_SQL.replace("WITH lst AS", ", lst AS"))


@register("csv_batch_summary", "A4 J3 P18 P19",
          sql=_FILES_SQL + SUMMARY_CTE + "SELECT * FROM summary")
def csv_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cb.batch_summary(_file_results(spark, sf_dir),
                            _prevalidate_errors(spark, sf_dir))


@register("csv_batch_failures", "U1", sql=_FILES_SQL + f"""
SELECT batch_id, 'glue_convert' AS step, key AS file,
       '{PENDING_ERROR}' AS error FROM f WHERE NOT conv_ok
UNION ALL
SELECT batch_id, 'redshift_load', key, '{NO_ROWS_ERROR}'
FROM f WHERE conv_ok AND n = 0
UNION ALL
SELECT batch_id, 'prevalidate', 'validation', reason FROM p
""")
def csv_batch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cb.batch_failures(_file_results(spark, sf_dir),
                             _prevalidate_errors(spark, sf_dir))


# ---------------------------------------------------------------------------
@register("csv_roundtrip", "S1 S2 S3 S4 P1 A2 A3", sql="""
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)
           AS total_cents,
       min(o_orderdate) AS min_date, max(o_orderdate) AS max_date,
       (SELECT CAST(count(*) AS BIGINT) FROM orders) AS input_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM orders) AS output_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM orders) AS inserted_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM orders) AS table_rows
FROM orders GROUP BY o_orderpriority
""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as CSV, converted to Parquet (row counts observed),
    appended to a warehouse table and read back."""
    src = table(spark, sf_dir, "orders")
    root = new_run_dir(spark, "csvload")
    landing = f"{root}/landing/orders.csv"
    src.write.option("header", "true").csv(landing)
    dst = f"{root}/staging/parquet/orders/landing/orders.csv"
    step = cp.convert_csv_to_parquet(spark, landing, dst, schema=src.schema)
    if not step.ok:
        raise RuntimeError(f"conversion failed: {step.error}")
    name = "etl_orders_" + uuid.uuid4().hex[:12]
    load = cp.append_load(spark, dst, name, f"{root}/warehouse/{name}")
    loaded = spark.read.parquet(f"{root}/warehouse/{name}")
    spark.sql(f"DROP TABLE {name}")   # the rows stay in the run's folder
    return loaded.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
        .cast("bigint").alias("total_cents"),
        F.min("o_orderdate").alias("min_date"),
        F.max("o_orderdate").alias("max_date")).select(
        "*",
        F.lit(step.input_rows).cast("bigint").alias("input_rows"),
        F.lit(step.output_rows).cast("bigint").alias("output_rows"),
        F.lit(load["inserted_rows"]).cast("bigint").alias("inserted_rows"),
        F.lit(load["table_rows"]).cast("bigint").alias("table_rows"))


MISSING_KEY = "orders/9-MISSING"
BAD_KEY = "odd/no rows+here.csv"
# Files whose header can't be read; each fails alone.
BAD_HEADERS = {"odd/repeated.csv": ["o_orderkey,O_ORDERKEY", "1,2"],
               "odd/blank.csv": ["", "o_orderkey", "1"],
               "odd/quoted.csv": ['"o_order', 'key",b', "1,2"]}


@register("csv_batch_load", "S1 S2 S3 S4 S7 J1 J3 A2 P19", sql=f"""
WITH f AS (SELECT 'orders/a+b ' || o_orderpriority || '%' AS key,
                  CAST(count(*) AS BIGINT) AS n
           FROM orders GROUP BY o_orderpriority)
SELECT b.batch_id, key, true AS converted, n AS input_rows, n AS rows,
       true AS loaded, n AS inserted_rows
FROM f, (VALUES ('007'), ('7')) b(batch_id)
WHERE b.batch_id = '7' OR key <> 'orders/a+b 1-URGENT%'
UNION ALL
SELECT '7', k, false, CAST(0 AS BIGINT), CAST(0 AS BIGINT), false,
       CAST(0 AS BIGINT)
FROM (VALUES ('{MISSING_KEY}'), ('{BAD_KEY}'), {', '.join(
    f"('{k}')" for k in BAD_HEADERS)}) t(k)
""")
def csv_batch_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of CSV files end to end.  Orders land in one folder per
    priority, with odd names and two orders of columns; the batches share
    most of them, and one also names a file that never arrived, one without
    a line and some with headers that can't be read.  Conversion, load and per-file results (J3); a first
    conversion to the same folder is replaced."""
    orders = table(spark, sf_dir, "orders")
    root = new_run_dir(spark, "csvbatch")
    landing, staging = f"{root}/landing", f"{root}/staging"
    priorities = sorted(r[0] for r in orders.select("o_orderpriority")
                        .distinct().collect())   # five fixed values
    data = orders.drop("o_orderpriority")
    for i, p in enumerate(priorities):
        part = orders.where(F.col("o_orderpriority") == p)
        columns = data.columns if i % 2 else list(reversed(data.columns))
        part.select(*columns).write.option("header", "true").csv(
            f"{landing}/orders/a+b {p}%")
    spark.createDataFrame([("",)], "value string").coalesce(1).write.option(
        "lineSep", " ").text(f"{landing}/{BAD_KEY}")
    for k, lines in BAD_HEADERS.items():
        spark.createDataFrame([(x,) for x in lines], "value string") \
            .coalesce(1).write.text(f"{landing}/{k}")
    key = F.concat(F.lit("orders/a+b "), F.col("p"), F.lit("%"))
    keys = spark.createDataFrame([(p,) for p in priorities], "p string")
    files = (keys.where("p <> '1-URGENT'").select(
                 F.lit("007").alias("batch_id"), key.alias("key"))
             .unionByName(keys.select(F.lit("7").alias("batch_id"),
                                      key.alias("key")))
             .unionByName(spark.createDataFrame(
                 [("7", k) for k in (MISSING_KEY, BAD_KEY, *BAD_HEADERS)],
                 "batch_id string, key string")))
    cp.convert_files(spark, files.limit(1), landing, staging, data.schema)
    conversions = cp.convert_files(spark, files, landing, staging,
                                   data.schema)
    name = "etl_batch_" + uuid.uuid4().hex[:12]
    loads = cp.load_converted(spark, files, landing, staging, name,
                              f"{root}/warehouse/{name}", data.schema,
                              count_table=False)
    spark.sql(f"DROP TABLE {name}")   # the rows stay in the run's folder
    return cb.file_results(files, conversions, loads).select(
        "batch_id", "key", "converted", "input_rows", "rows", "loaded",
        "inserted_rows")


# ---------------------------------------------------------------------------
class _Lost(RuntimeError):
    """Stands for the loss of a run between its append and its marker."""


@register("csv_load_retry", "S4 S7 J1 J3", sql="""
WITH f AS (SELECT o_orderpriority AS file, CAST(count(*) AS BIGINT) AS n,
                  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT))
                       AS BIGINT) AS cents,
                  CAST(count(*) FILTER (o_orderstatus <> 'O') AS BIGINT) AS m,
                  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT))
                       FILTER (o_orderstatus <> 'O') AS BIGINT) AS less
           FROM orders GROUP BY o_orderpriority)
SELECT batch_id, file, n AS retried_rows, CAST(0 AS BIGINT) AS again_rows,
       CASE WHEN batch_id = '7' AND file < '3' THEN m ELSE 0 END
         AS changed_rows,
       CASE WHEN file < '3' THEN n + m WHEN file < '4' THEN n + n ELSE n END
         AS table_rows,
       CASE WHEN file < '3' THEN cents + less WHEN file < '4'
         THEN cents + cents ELSE cents END AS table_cents
FROM f, (VALUES ('7'), ('8')) b(batch_id)
WHERE (batch_id = '7' AND file < '3') OR (file >= '3' AND file < '4')
   OR (batch_id = '8' AND file >= '4')
""")
def csv_load_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads by the ledger: orders staged as a file for each priority, which
    two batches share in part.  The first run of batch 7 is lost before its
    marker, then both batches load, then both once more; at last the files
    of batch 7 have lost their open orders and are loaded again.  Per batch
    and file the rows inserted, and what the table holds of the file."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("file"), "o_orderkey", "o_orderstatus",
        "o_totalprice")
    root = new_run_dir(spark, "csvretry")
    location = f"{root}/warehouse"

    def staged(rows: DataFrame, name: str) -> DataFrame:
        rows.write.partitionBy("file").parquet(f"{root}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{root}/{name}")

    first = staged(orders, "staging")
    names = orders.select("file").distinct()
    seven = names.where("file < '4'").select(F.lit("7").alias("batch_id"),
                                             "file")
    eight = names.where("file >= '3'").select(F.lit("8").alias("batch_id"),
                                              "file")

    def lost(load_id: str) -> None:
        raise _Lost(load_id)

    try:
        load_ledger.load_once(first, "file", seven, location, lost)
    except _Lost:
        pass
    runs = [materialized(r, "load-run") for r in (
        load_ledger.load_once(first, "file", batch, location)
        for batch in (seven, eight, seven, eight))]
    changed = staged(orders.where("file >= '3' or o_orderstatus <> 'O'"),
                     "staging2")
    runs.append(load_ledger.load_once(changed, "file", seven, location))

    def inserted(parts: list[DataFrame], name: str) -> DataFrame:
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        return both.select("batch_id", "file",
                           F.col("inserted_rows").alias(name))

    schema = orders.drop("file").schema
    held = load_ledger.read_loaded(spark, location, schema, with_file=True)
    held = held.groupBy(F.col(load_ledger.FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("table_rows"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
        .cast("bigint").alias("table_cents"))
    key = ["batch_id", "file"]
    return (inserted(runs[:2], "retried_rows")
            .join(inserted(runs[2:4], "again_rows"), key)
            .join(inserted(runs[4:], "changed_rows"), key, "left")
            .join(held, "file").select(
                *key, "retried_rows", "again_rows",
                F.coalesce("changed_rows", F.lit(0)).alias("changed_rows"),
                "table_rows", "table_cents"))


# ---------------------------------------------------------------------------
@register("csv_record_load", "S1 S2 S3 S7 J1 A2 P1", sql="""
WITH d AS (SELECT doc_id, coalesce(source, '__HIVE_DEFAULT_PARTITION__') AS s,
                  coalesce(text, '') AS text FROM documents)
SELECT s AS source, doc_id, CAST(length(text) AS BIGINT) AS n_chars,
       md5(text) AS text_md5, 'SUCCEEDED' AS job_state,
       CAST(count(*) OVER (PARTITION BY s) AS BIGINT) AS input_rows,
       CAST(count(*) FILTER (text <> '') OVER (PARTITION BY s) AS BIGINT)
         AS rows
FROM d WHERE text <> ''
""")
def csv_record_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as CSV folders, one for each source, their texts
    quoted with all line feeds and a header that spans two lines; converted by
    records.  The transform drops empty texts.  Every text that was staged,
    and its folder's counts of rows read and written."""
    root = new_run_dir(spark, "csvrecords")
    docs = table(spark, sf_dir, "documents").select(
        F.coalesce("source", F.lit("__HIVE_DEFAULT_PARTITION__"))
        .alias("folder"), "doc_id",
        F.col("text").alias("whole\ntext"))
    (docs.write.partitionBy("folder").options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false").csv(f"{root}/landing"))
    keys = list_files(spark, f"{root}/landing").select(
        F.lit("1").alias("batch_id"),
        F.regexp_extract("path", "/(folder=[^/]*)/", 1).alias("key")).distinct()
    wanted = T.StructType([T.StructField("doc_id", T.LongType()),
                           T.StructField("whole\ntext", T.StringType())])

    def with_text(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("whole\ntext") != "")

    results = cr.convert_record_files(
        spark, keys, f"{root}/landing", f"{root}/staging", wanted, with_text)
    staged, source = cp.staged_rows(spark, f"{root}/staging", wanted)
    text = F.col("whole\ntext")
    rows = staged.select(
        F.regexp_extract(source, "^([^/]*)/", 1).alias("key"), "doc_id",
        F.length(text).cast("bigint").alias("n_chars"),
        F.md5(text).alias("text_md5"))
    return rows.join(results, "key").select(
        F.url_decode(F.regexp_replace("key", "^folder=", "")).alias("source"),
        "doc_id", "n_chars", "text_md5", "job_state", "input_rows", "rows")
