"""Log-analysis driver queries: profiles, files, tables, stage statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators import log_profile as lp
from runledger.operators import stages as st
from runledger.operators import table_stats as ts
from runledger.plans.derive import (
    EVENT_LINE_SQL, LEVEL_SQL, PROFILE_SQL, event_line)
from runledger.plans.registry import register, table
from runledger.session import (
    ensure_parallelism, materialized, new_run_dir)
from runledger.sources import catalog
from runledger.sources.evolving import register_evolving_tables
from runledger.sources.files import (
    list_files, log_file_filter, newest_files, read_log_lines)

PROFILE_COLS = ["lines", "errors", *lp.LEVEL_COLUMNS]


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("user_id", "ts", "event_type",
                     event_line(ev).alias("line"))


# ---------------------------------------------------------------------------
@register("log_level_profile", "P9 P10 A7", sql=f"""
WITH l AS (SELECT user_id, {EVENT_LINE_SQL} AS line FROM events),
c AS (SELECT user_id, {LEVEL_SQL} AS level FROM l)
SELECT user_id, {PROFILE_SQL} FROM c GROUP BY user_id
""")
def log_level_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines generated from events, one log source per user."""
    return lp.profile_lines(_event_lines(spark, sf_dir), ["user_id"])


@register("log_totals", "A8 F8", sql=f"""
WITH l AS (SELECT user_id, {EVENT_LINE_SQL} AS line FROM events),
c AS (SELECT user_id, {LEVEL_SQL} AS level FROM l),
p AS (SELECT user_id, {PROFILE_SQL} FROM c GROUP BY user_id)
SELECT CAST(count(*) AS BIGINT) AS total_files,
       CAST(count(*) AS BIGINT) AS processed_files,
       CAST(coalesce(sum(lines), 0) AS BIGINT) AS total_log_lines,
       CAST(coalesce(sum(errors), 0) AS BIGINT) AS error_log_lines,
       CASE WHEN coalesce(sum(lines), 0) > 0
            THEN CAST(sum(errors) AS DOUBLE) / CAST(sum(lines) AS DOUBLE)
            ELSE 0.0 END AS error_rate
FROM p
""")
def log_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lp.profile_totals(log_level_profile(spark, sf_dir))


@register("recent_sources_topk", "T1", sql="""
SELECT user_id, max(ts) AS last_ts, CAST(count(*) AS BIGINT) AS lines
FROM events GROUP BY user_id ORDER BY last_ts DESC, user_id LIMIT 10
""")
def recent_sources_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return lp.most_recent(ev, "user_id", "ts", 10)


@register("log_files_profile", "S8 P8 A7", sql=f"""
WITH l AS (SELECT strftime(ts, '%Y-%m-%d') AS log_date,
                  {EVENT_LINE_SQL} AS line
           FROM events WHERE event_type <> 'purchase'),
c AS (SELECT log_date, {LEVEL_SQL} AS level FROM l)
SELECT log_date, {PROFILE_SQL} FROM c GROUP BY log_date
""")
def log_files_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines written as daily log files (one folder per day), then
    listed, read and profiled per day.  Purchase lines go to ``.csv``
    files, which the log collector's suffix rule ignores."""
    root = new_run_dir(spark, "logfiles")
    lines = _event_lines(spark, sf_dir).withColumn(
        "log_date", F.date_format("ts", "yyyy-MM-dd"))
    (lines.where(F.col("event_type") != "purchase")
     .select("log_date", "line").write.partitionBy("log_date").text(root))
    (lines.where(F.col("event_type") == "purchase")
     .select("log_date", "line").write.mode("append")
     .partitionBy("log_date").csv(root))
    read = read_log_lines(spark, root).withColumn(
        "log_date", F.regexp_extract("file", r"log_date=([0-9-]+)/", 1))
    return lp.profile_lines(read, ["log_date"])


@register("log_invalid_bytes", "S8 P8", sql="""
SELECT doc_id, CAST(length(line) AS BIGINT) AS n_chars, md5(line) AS line_md5
FROM (SELECT doc_id, replace(coalesce(text, ''), chr(10), ' ') AS line
      FROM documents)
""")
def log_invalid_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines of log files, with bytes that are no UTF-8 at every
    blank and at the end (cut-off sequences, surrogates, overlong forms, stray
    continuations); the lines read back hold the text alone."""
    root = new_run_dir(spark, "logbytes")
    line = F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))
    for after, junk in ((" ", "FFE282"), (".", "EDA080"), ("a", "C0AF80F09F98")):
        bad = F.unhex(F.lit(junk)).cast("string")
        line = F.replace(line, F.lit(after), F.concat(F.lit(after), bad))
    cut = F.unhex(F.lit("F48F")).cast("string")
    table(spark, sf_dir, "documents").select(F.concat(
        F.col("doc_id").cast("string"), F.lit("\t"), line, cut)
        .alias("line")).write.text(root)
    parts = F.split("line", "\t", 2)
    return read_log_lines(spark, root).select(
        parts[0].cast("bigint").alias("doc_id"),
        F.length(parts[1]).cast("bigint").alias("n_chars"),
        F.md5(parts[1]).alias("line_md5"))


NEWEST = 10


@register("log_file_stats", "S7 S8 P8 T1 A7 A8", sql=f"""
WITH l AS (SELECT user_id % 7 AS g, event_id, {EVENT_LINE_SQL} AS line
           FROM events),
c AS (SELECT g, {LEVEL_SQL} AS level FROM l)
SELECT 'app ' || CAST(g AS VARCHAR) || '+%.log' AS name, false AS failed,
       {PROFILE_SQL}
FROM c GROUP BY g
UNION ALL
SELECT 'blank one.txt', false, 0, 0, 0, 0, 0, 0, 0
""")
def log_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files with odd names, listed, the newest ten read, one profile
    each.  Files of other suffixes are ignored."""
    root = new_run_dir(spark, "logstats")
    # One scan; every task writes its part of each log.
    _event_lines(spark, sf_dir).select(
        F.concat(F.lit("app "), F.col("user_id") % 7, F.lit("+%.log"))
        .alias("log"), "line").write.partitionBy("log").text(root)
    for name, text in (("blank one.txt", " "), ("ignored.LOGS", "ERROR")):
        spark.createDataFrame([(text,)], "line string").coalesce(1) \
            .write.text(f"{root}/{name}")
    # Spark writes folders; the folder is the log file here, and its name
    # that of the folder (partitions are escaped).
    def folder(path: str) -> Column:
        return F.regexp_replace(path, "/[^/]*$", "")

    name = F.replace(F.regexp_extract("path", r"([^/]*)$", 1).substr(
        F.when(F.col("path").rlike("/log=[^/]*$"), 5).otherwise(1),
        F.lit(1 << 30)), F.lit("%25"), F.lit("%"))
    listing = (list_files(spark, root).groupBy(folder("path").alias("path"))
               .agg(F.sum("length").alias("length"),
                    F.max("modification_time").alias("modification_time"))
               .withColumn("name", name))
    newest = newest_files(log_file_filter(listing), NEWEST)
    files = lp.profile_files(newest, read_log_lines(spark, root).withColumn(
        "file", folder("file")))
    return files.select(name.alias("name"), "failed", *PROFILE_COLS)


@register("document_log_profile", "S8 P9 P10 A7", sql=f"""
WITH l AS (SELECT doc_id,
                  unnest(string_split(coalesce(text, ''), chr(10))) AS line
           FROM documents),
c AS (SELECT doc_id, {LEVEL_SQL} AS level FROM l)
SELECT doc_id, {PROFILE_SQL} FROM c GROUP BY doc_id
""")
def document_log_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document profiled as a log file, whole text, per row."""
    docs = ensure_parallelism(
        table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lp.profile_texts(docs, "text", keep=["doc_id"])


# ---------------------------------------------------------------------------
REGISTERED_TABLES = ("region", "nation", "supplier", "customer", "part")
ANALYZED_TABLES = 3


@register("table_registration", "S10 S11 T2 A9", sql="""
SELECT 'customer' AS table_name, true AS is_new, 5 AS n_columns,
       CAST(count(*) AS BIGINT) AS row_count, true AS analyzed FROM customer
UNION ALL SELECT 'nation', true, 3, CAST(count(*) AS BIGINT), true FROM nation
UNION ALL SELECT 'part', true, 6, CAST(count(*) AS BIGINT), true FROM part
UNION ALL SELECT 'region', true, 2, CAST(count(*) AS BIGINT), false
          FROM region
UNION ALL SELECT 'supplier', true, 4, CAST(count(*) AS BIGINT), false
          FROM supplier
""")
def table_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written as CSV folders, registered with inferred schemas,
    listed, capped to the first three by name, and counted."""
    root = new_run_dir(spark, "crawl")
    for name in REGISTERED_TABLES:
        (table(spark, sf_dir, name).write.option("header", "true")
         .csv(f"{root}/{name}"))
    database = "crawl_" + uuid.uuid4().hex[:12]
    db_location = f"{root}/_catalog/{database}.db"
    catalog.create_database(spark, database, db_location)
    before = catalog.list_tables(spark, database)
    catalog.register_path_tables(spark, database, root,
                                 location=db_location)
    after = catalog.list_tables(spark, database)
    fresh = catalog.new_tables(before, after).select(
        "table_name", F.lit(True).alias("is_new"))
    listed = ts.first_tables(after, ANALYZED_TABLES)
    counts = []
    for row in after.collect():            # catalog metadata, bounded
        t = spark.table(f"`{database}`.`{row.table_name}`")
        counts.append(t.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(row.table_name).alias("table_name"),
            F.lit(len(t.columns)).alias("n_columns"), "row_count"))
    count_df = counts[0]
    for c in counts[1:]:
        count_df = count_df.unionByName(c)
    # The files stay in the run's folder, the catalog is left as it was.
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return (listed.join(fresh, "table_name", "left")
            .join(count_df, "table_name", "left")
            .select("table_name",
                    F.coalesce("is_new", F.lit(False)).alias("is_new"),
                    "n_columns", "row_count", "analyzed"))


# Quarters of the length, so that the second delivery's values are exact.
_EVOLVED_SQL = """
WITH d AS (SELECT *, n_chars < 1000 AS early,
    CASE WHEN n_chars < 1000 THEN CAST(n_chars AS DOUBLE)
         ELSE CAST(n_chars AS DOUBLE) / 4 + 0.25 END AS size FROM documents)
SELECT lang, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(CASE WHEN NOT early THEN source END) AS BIGINT)
           AS n_sources,
       CAST(sum(CAST(size * 4 AS BIGINT)) AS BIGINT) AS quarters,
       min(doc_id) AS min_id, max(doc_id) AS max_id,
       'created' AS first_status, 'altered' AS second_status,
       'unchanged' AS third_status, 'refused' AS bad_status,
       'int' AS size_type_before, 'double' AS size_type_after
FROM d GROUP BY lang
"""


@register("table_evolution", "S10 S11", sql=_EVOLVED_SQL)
def table_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents delivered to a CSV folder in two parts, partitioned by
    language: whole sizes first, then quarters and a further column.  The
    table is registered after each part (and once more) and read at the end;
    a folder whose files name their columns in another order is refused."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", "source", "lang")
    run = new_run_dir(spark, "evolve")
    root = f"{run}/data"
    short = F.coalesce(F.col("n_chars") < 1000, F.lit(False))
    database = "evolve_" + uuid.uuid4().hex[:12]

    def deliver(folder: str, part: DataFrame, *keys: str) -> None:
        writer = part.write.mode("append").option("header", "true")
        (writer.partitionBy(*keys) if keys else writer).csv(
            f"{root}/{folder}")

    def registered() -> dict:
        out = register_evolving_tables(
            spark, database, root, f"{run}/{database}.db",
            f"{run}/{database}_base.db")
        return {r.table_name: r for r in out.collect()}   # one per table

    def size_type(row) -> str:
        return {c.name: c.type for c in row["columns"]}["size"]

    nations = table(spark, sf_dir, "nation")
    deliver("docs", docs.where(short).select(
        "doc_id", F.col("n_chars").alias("size"), "lang"), "lang")
    deliver("nations", nations.select("n_nationkey", "n_name"))
    first = registered()
    deliver("docs", docs.where(~short).select(
        "doc_id", (F.col("n_chars") / 4 + 0.25).alias("size"), "source",
        "lang"), "lang")
    deliver("nations", nations.select("n_name", "n_nationkey"))
    second, third = registered(), registered()
    out = spark.table(f"`{database}`.docs").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("source").alias("n_sources"),
        F.sum((F.col("size") * 4).cast("bigint")).alias("quarters"),
        F.min("doc_id").cast("bigint").alias("min_id"),
        F.max("doc_id").cast("bigint").alias("max_id")).select(
        "*", *[F.lit(v).alias(c) for c, v in (
            ("first_status", first["docs"].status),
            ("second_status", second["docs"].status),
            ("third_status", third["docs"].status),
            ("bad_status", second["nations"].status),
            ("size_type_before", size_type(first["docs"])),
            ("size_type_after", size_type(third["docs"])))])
    # The catalog lists the partitions when the query runs: it does now.
    out = materialized(out, "evolve-result")
    # The files stay in the run's folder, the catalog is left as it was.
    for name in (database, f"{database}_base"):
        spark.sql(f"DROP DATABASE `{name}` CASCADE")
    return out


# Tables analysed for error rows, with the text column to test (Q12: the
# column is a parameter; ``orders`` has no such column and is a failed
# table).
ERROR_STAT_SPECS = (("conversations", "text"), ("documents", "text"),
                    ("events", "event_type"), ("pages", "url"),
                    ("orders", "o_comment"))

_ERR = "upper({c}) LIKE '%ERROR%' OR upper({c}) LIKE '%WARN%'"
TABLE_ERROR_SQL = "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, '{c}' AS column_name, true AS ok, "
     f"CAST(count(*) AS BIGINT) AS row_count, "
     f"CAST(count_if({_ERR.format(c=c)}) AS BIGINT) AS error_count, "
     f"CAST(NULL AS VARCHAR) AS error FROM {t}"
     for t, c in ERROR_STAT_SPECS[:-1]]
    + ["SELECT 'orders', 'o_comment', false, CAST(count(*) AS BIGINT), "
       "CAST(-1 AS BIGINT), 'column o_comment not found' FROM orders"])


def _table_error_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [(t, table(spark, sf_dir, t), c) for t, c in ERROR_STAT_SPECS]
    return ts.tables_stats(spark, specs)


@register("table_error_stats", "A9 A10 P11", sql=TABLE_ERROR_SQL)
def table_error_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without the column has a row count and -1 for its errors."""
    return _table_error_stats(spark, sf_dir).fillna(
        -1, subset=["error_count"])


@register("log_table_summary", "A11 F8", sql=f"""
WITH s AS ({TABLE_ERROR_SQL})
SELECT CAST(count(*) AS BIGINT) AS total_tables,
       CAST(count_if(ok) AS BIGINT) AS successful_tables,
       CAST(coalesce(sum(CASE WHEN ok THEN row_count END), 0) AS BIGINT)
           AS total_log_entries,
       CAST(coalesce(sum(CASE WHEN ok THEN error_count END), 0) AS BIGINT)
           AS total_error_entries,
       CASE WHEN coalesce(sum(CASE WHEN ok THEN row_count END), 0) > 0
            THEN CAST(sum(CASE WHEN ok THEN error_count END) AS DOUBLE)
                 / CAST(sum(CASE WHEN ok THEN row_count END) AS DOUBLE)
            ELSE 0.0 END AS error_rate,
       count_if(ok) > 0 AS success
FROM s
""")
def log_table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.stats_summary(_table_error_stats(spark, sf_dir))


_CELL = ("CASE WHEN {c} IS NULL THEN 'NULL' WHEN length(CAST({c} AS VARCHAR))"
         " > 50 THEN substr(CAST({c} AS VARCHAR), 1, 47) || '...' "
         "ELSE CAST({c} AS VARCHAR) END AS {c}")


@register("table_sample", "T3 T4 F5", sql=f"""
SELECT doc_id, {_CELL.format(c='text')}, {_CELL.format(c='lang')},
       {_CELL.format(c='source')}, {_CELL.format(c='n_chars')}
FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 10)
""")
def table_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars")
    return ts.display_cells(ts.sample_rows(docs, 10, ["doc_id"]),
                            keep=["doc_id"])


# ---------------------------------------------------------------------------
def _log_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stages per nation: customers are collected log files, their
    orders the registered tables, their line items the analysed rows."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag")
    collect = cust.groupBy(F.col("c_nationkey").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("files"), F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("c_acctbal") < 0).alias("errors"),
        (F.count(F.lit(1)) > 0).alias("ok"))
    oc = orders.join(cust.select("c_custkey", "c_nationkey"),
                     orders.o_custkey == cust.c_custkey)
    reg = oc.groupBy(F.col("c_nationkey").alias("batch_id")).agg(
        F.count_distinct("o_orderpriority").alias("tables"),
        (F.count_if(F.col("o_orderstatus") == "P") * 3
         < F.count(F.lit(1))).alias("ok"))
    q = (items.join(oc.select("o_orderkey", "c_nationkey"),
                    items.l_orderkey == oc.o_orderkey)
         .groupBy(F.col("c_nationkey").alias("batch_id"))
         .agg(F.count_distinct("l_returnflag").alias("queries"),
              F.count(F.lit(1)).alias("rows"),
              (F.count_if(F.col("l_returnflag") == "R") * 3
               < F.count(F.lit(1))).alias("ok")))
    batches = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("batch_id"))
    return st.join_stages(batches, {"collect": collect, "register": reg,
                                    "query": q})


@register("stage_join_stats", "J4 A12 P20", sql="""
WITH c AS (SELECT c_nationkey AS batch_id, CAST(count(*) AS BIGINT) AS files,
                  CAST(count(*) AS BIGINT) AS lines,
                  CAST(count_if(c_acctbal < 0) AS BIGINT) AS errors,
                  count(*) > 0 AS ok
           FROM customer GROUP BY c_nationkey),
oc AS (SELECT o.*, c.c_nationkey FROM orders o
       JOIN customer c ON o.o_custkey = c.c_custkey),
r AS (SELECT c_nationkey AS batch_id,
             CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS tables,
             count_if(o_orderstatus = 'P') * 3 < count(*) AS ok
      FROM oc GROUP BY c_nationkey),
q AS (SELECT oc.c_nationkey AS batch_id,
             CAST(count(DISTINCT l_returnflag) AS BIGINT) AS queries,
             CAST(count(*) AS BIGINT) AS rows_,
             count_if(l_returnflag = 'R') * 3 < count(*) AS ok
      FROM lineitem l JOIN oc ON l.l_orderkey = oc.o_orderkey
      GROUP BY oc.c_nationkey),
b AS (SELECT n_nationkey AS batch_id FROM nation),
j AS (SELECT b.batch_id, coalesce(c.ok, false) AS c_ok,
             coalesce(c.ok, false) AND coalesce(r.ok, false) AS r_ok,
             coalesce(c.ok, false) AND coalesce(r.ok, false)
                 AND coalesce(q.ok, false) AS q_ok,
             c.files, c.lines, c.errors, r.tables, q.queries, q.rows_,
             r.ok IS NOT NULL AS r_present
      FROM b LEFT JOIN c ON b.batch_id = c.batch_id
             LEFT JOIN r ON b.batch_id = r.batch_id
             LEFT JOIN q ON b.batch_id = q.batch_id)
SELECT batch_id,
       CASE WHEN NOT c_ok THEN 'LOG_COLLECT_FAILED'
            WHEN NOT r_ok THEN 'CRAWLER_FAILED'
            WHEN NOT q_ok THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS status,
       CAST(CASE WHEN c_ok THEN coalesce(files, 0) ELSE 0 END AS BIGINT)
           AS log_files_processed,
       CAST(CASE WHEN c_ok THEN coalesce(lines, 0) ELSE 0 END AS BIGINT)
           AS total_log_lines,
       CAST(CASE WHEN c_ok THEN coalesce(errors, 0) ELSE 0 END AS BIGINT)
           AS error_log_lines,
       CAST(CASE WHEN r_ok THEN coalesce(tables, 0) ELSE 0 END AS BIGINT)
           AS tables_created,
       CAST(CASE WHEN q_ok THEN coalesce(queries, 0) ELSE 0 END AS BIGINT)
           AS athena_queries_executed,
       CAST(CASE WHEN q_ok THEN coalesce(rows_, 0) ELSE 0 END AS BIGINT)
           AS rows_analyzed,
       (CAST(c_ok AS INTEGER) + CAST(r_ok AS INTEGER) + CAST(q_ok AS INTEGER))
           / 3.0 AS processing_success_rate,
       c_ok AND r_present AS register_ran
FROM j
""")
def stage_join_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.log_pipeline_status(_log_stages(spark, sf_dir))


_STAGES_SQL = """
WITH c AS (SELECT c_nationkey AS batch_id, CAST(count(*) AS BIGINT) AS files,
                  CAST(count(*) AS BIGINT) AS lines,
                  CAST(count_if(c_acctbal < 0) AS BIGINT) AS errors,
                  count(*) > 0 AS ok
           FROM customer GROUP BY c_nationkey),
oc AS (SELECT o.*, c.c_nationkey FROM orders o
       JOIN customer c ON o.o_custkey = c.c_custkey),
r AS (SELECT c_nationkey AS batch_id,
             CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS tables,
             count_if(o_orderstatus = 'P') * 3 < count(*) AS ok
      FROM oc GROUP BY c_nationkey),
q AS (SELECT oc.c_nationkey AS batch_id,
             CAST(count(DISTINCT l_returnflag) AS BIGINT) AS queries,
             CAST(count(*) AS BIGINT) AS rows_,
             count_if(l_returnflag = 'R') * 3 < count(*) AS ok
      FROM lineitem l JOIN oc ON l.l_orderkey = oc.o_orderkey
      GROUP BY oc.c_nationkey),
b AS (SELECT n_nationkey AS batch_id FROM nation),
j AS (SELECT b.batch_id, coalesce(c.ok, false) AS c_ok,
             coalesce(c.ok, false) AND coalesce(r.ok, false) AS r_ok,
             coalesce(c.ok, false) AND coalesce(r.ok, false)
                 AND coalesce(q.ok, false) AS q_ok,
             c.files, c.lines, c.errors, r.tables, q.queries, q.rows_,
             r.ok IS NOT NULL AS r_present,
             q.ok IS NOT NULL AS q_present
      FROM b LEFT JOIN c ON b.batch_id = c.batch_id
             LEFT JOIN r ON b.batch_id = r.batch_id
             LEFT JOIN q ON b.batch_id = q.batch_id)
"""


@register("log_stage_failures", "U3", sql=_STAGES_SQL + """
SELECT batch_id, 'log_collect' AS step, 'Log collection failed' AS error
FROM j WHERE NOT c_ok
UNION ALL
SELECT batch_id, 'glue_crawler', 'Glue crawler failed'
FROM j WHERE c_ok AND r_present AND NOT r_ok
UNION ALL
SELECT batch_id, 'athena_query', 'Athena query failed'
FROM j WHERE r_ok AND q_present AND NOT q_ok
""")
def log_stage_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.log_pipeline_failures(_log_stages(spark, sf_dir))
