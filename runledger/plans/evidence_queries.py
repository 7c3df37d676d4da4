"""Evidence driver queries: parse, store, roll up, reconcile, classify."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions import scalar as fx
from runledger.operators import evidence as evo
from runledger.operators.flows import classify_flow, read_flow_map
from runledger.plans.registry import register, table
from runledger.session import conf_set, new_run_dir
from runledger.sources import evidence_store as store
from runledger.sources import snapshots

# Flow map of the state machines below (pattern -> flow, in order).
FLOW_PATTERNS = {
    "machine-csv-ingest": "csv-to-parquet-pipeline",
    "machine-json-ingest": "json-to-dynamodb-pipeline",
    "machine-log-ingest": "log-aggregation-athena-pipeline",
}

# Derivation of run logs from line items (see ``_lineitem_events``).
STEP_BY_LINE = ("prevalidate", "glue_convert", "redshift_load", "finalize",
                "glue_convert", "redshift_load", "monitoring")
STATE_MACHINES = ("machine-csv-ingest", "machine-json-ingest",
                  "machine-log-ingest", "machine-adhoc")
ARN_PREFIX = "arn:aws:states:us-east-1:000000000000:execution:"
GLUE_GROUP = "/aws-glue/jobs/output"
STATES_GROUP = "/aws/states/"
CLOCK = "2024-02-01 00:00:00"
BATCH_WIDTH = 1000


def write_flow_map(spark: SparkSession, patterns: dict[str, str]) -> str:
    """Write a flow-map document into the shared run folder."""
    path = new_run_dir(spark, "flowmap")
    text = json.dumps({"flow_patterns": patterns})
    spark.createDataFrame([(text,)], "value string").coalesce(1) \
        .write.text(path)
    return path


PIECE_ITEMS = 1 << 19        # line items of a partition or file, about
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)


def _pieces(items: DataFrame) -> int:
    """Partitions for the work on messages: one for each core at least, and
    of few enough rows that a sort of them needs no disk."""
    return max(items.sparkSession.sparkContext.defaultParallelism,
               -(-items.count() // PIECE_ITEMS))


def _deliveries(items: DataFrame) -> DataFrame:
    """One row per delivery (``copy``) with the group that it is logged to."""
    line = F.col("l_linenumber")
    machine = F.element_at(F.array(*[F.lit(m) for m in STATE_MACHINES]),
                           F.pmod("l_suppkey", F.lit(4)).cast("int") + 1)
    return items.withColumn("copy", F.explode(F.sequence(
        F.lit(1), F.when(line == 3, 2).otherwise(1)))).withColumns({
            "machine": machine,
            "log_group": F.when(F.col("l_linestatus") == "F", F.concat(
                F.lit(STATES_GROUP), machine)).otherwise(F.lit(GLUE_GROUP))})


def _lineitem_events(spark: SparkSession, sf_dir: str,
                     share: tuple[int, int] | None = None) -> DataFrame:
    """The log events of all line items; with ``share`` (k, of n) of the k-th
    of n disjoint shares of their deliveries, whose equal ones stay together."""
    items = _line_items(spark, sf_dir)
    if share is None:
        n = _pieces(items)
        return _events_of(_deliveries(
            items if items.rdd.getNumPartitions() >= n
            else items.repartition(n)))
    dealt = _deliveries(items).where(F.pmod(
        F.xxhash64(*LINE_COLUMNS, "copy"), F.lit(share[1])) == share[0])
    n = max(spark.sparkContext.defaultParallelism,
            -(-_pieces(items) // share[1]))
    return _events_of(dealt if dealt.rdd.getNumPartitions() >= n
                      else dealt.repartition(n))


def _events_of(li: DataFrame, *more: str) -> DataFrame:
    """One log event per line item; line 3 is delivered twice, first with
    too few rows, an hour later corrected.  Batch ids look like numbers, with
    and without leading zeros; some records have none.

    Open orders log from the conversion job (``EVIDENCE`` lines; line 6 has
    the marker after a prefix, N-flagged line 7 is truncated JSON); fulfilled
    orders log from the state machine, with evidence under ``input``,
    ``output`` or the top level; a fourth line ends the execution.
    """
    line = F.col("l_linenumber")
    wrong = F.when((line == 3) & (F.col("copy") == 1), 5).otherwise(0)
    group = F.expr(f"l_orderkey div {BATCH_WIDTH}").cast("string")
    batch = F.when((line == 5) & (F.col("l_returnflag") == "R"),
                   F.lit(None)).when(F.col("l_suppkey") % 2 == 0,
                                     F.lpad(group, 4, "0")).otherwise(group)
    step = F.element_at(F.array(*[F.lit(s) for s in STEP_BY_LINE]), line)
    # (order, line) repeats in the provided data; with part and supplier
    # the id is unique.
    event_id = F.concat_ws("-", *[F.col(c).cast("string") for c in (
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    rows_in = F.col("l_quantity").cast("bigint")
    rows_out = (rows_in - wrong
                - F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    failure = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    ok = F.when(failure, False).when(F.col("l_returnflag") == "A",
                                     F.lit(None)).otherwise(True)
    ev = F.struct(
        batch.alias("batch_id"),
        F.lit("").alias("test_id"),
        F.lit("csv-to-parquet-pipeline").alias("flow"),
        step.alias("step"),
        F.concat(F.lit("line "), event_id).alias("note"),
        F.when(failure & (line != 7),
               F.concat(F.lit("returned item "), event_id)).alias("error"),
        ok.alias("ok"), F.col("l_shipdate").alias("ts"),
        F.struct(F.concat(F.lit("s3://landing/orders/"),
                          F.col("l_orderkey").cast("string"), F.lit(".csv"))
                 .alias("s3"),
                 F.when(line != 7, rows_in).alias("rows")).alias("input"),
        F.struct(rows_out.alias("rows"), F.lit("parquet").alias("format"))
        .alias("output"),
        F.when(step.isin("redshift_load", "finalize"),
               F.struct(F.lit("public.etl_data").alias("table"),
                        rows_out.alias("inserted_rows"),
                        F.lit(0).alias("dropped_rows"))).alias("load"))
    from_states = F.col("l_linestatus") == "F"
    etype = (F.when(line == 4, F.when(failure, "ExecutionFailed")
                    .otherwise("ExecutionSucceeded"))
             .otherwise("TaskStateExited"))
    # The record is serialised once; the three message shapes embed it.
    staged = li.select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_returnflag", "copy",
        event_id.alias("event_id"), from_states.alias("from_states"),
        F.to_json(ev).alias("bare"),
        # An object without its last brace; none of its texts needs escapes.
        F.when(from_states, F.concat(
            F.lit('{"type":"'), etype, F.lit('"'),
            _member("executionArn", F.concat(
                F.lit(ARN_PREFIX), F.col("machine"), F.lit(":"),
                F.col("l_orderkey").cast("string"))),
            _member("state", step))).alias("head"),
        "log_group", *more)
    line = F.col("l_linenumber")
    bare = F.col("bare")
    wrapped = F.concat(F.lit('{"evidence":'), bare, F.lit("}"))
    glue_json = F.when(line % 2 == 1, wrapped).otherwise(bare)
    glue_msg = (F.when(line == 6, F.concat(F.lit("INFO EVIDENCE "), glue_json))
                .when((F.col("l_returnflag") == "N") & (line == 7),
                      F.concat(F.lit("EVIDENCE "),
                               F.substring(glue_json, 1, 20)))
                .otherwise(F.concat(F.lit("EVIDENCE "), glue_json)))
    head = F.col("head")
    state_msg = (F.when(line.isin(1, 3), F.concat(
                     head, F.lit(',"input":{"evidence":'), bare, F.lit("}}")))
                 .when(line.isin(2, 4, 6), F.concat(
                     head, F.lit(',"output":{"evidence":'), bare, F.lit("}}")))
                 .otherwise(F.concat(head, F.lit(',"evidence":'), bare,
                                     F.lit("}"))))
    hours = F.make_dt_interval(hours=F.col("copy") - 1)
    return staged.select(
        "l_orderkey", "l_shipdate", "log_group", "event_id",
        F.when(F.col("from_states"), state_msg).otherwise(glue_msg)
        .alias("message"),
        (F.col("l_shipdate").cast("timestamp") + hours)
        .alias("delivered_at"), *more)


def _member(name: str, text: Column) -> Column:
    """A further member of a JSON object; none if the text is null."""
    return F.coalesce(F.concat(F.lit(f',"{name}":"'), text, F.lit('"')),
                      F.lit(""))


def _parsed(spark: SparkSession, sf_dir: str, columns: list[str]
            ) -> DataFrame:
    """Parsed events without the flows of their machines."""
    events = _lineitem_events(spark, sf_dir).select(
        "log_group", "event_id", "message", "delivered_at")
    return evo.parse_log_events(events, None, CLOCK, columns)


def _flow_map(spark: SparkSession) -> DataFrame:
    return read_flow_map(spark, write_flow_map(spark, FLOW_PATTERNS))


_EV_SQL = f"""
WITH li AS (
  SELECT CASE WHEN l_linenumber = 5 AND l_returnflag = 'R'
              THEN 'B' || CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR)
              WHEN l_suppkey % 2 = 0
              THEN lpad(CAST(l_orderkey // {BATCH_WIDTH} AS VARCHAR), 4, '0')
              ELSE CAST(l_orderkey // {BATCH_WIDTH} AS VARCHAR) END
             AS batch_id,
         CASE l_linenumber WHEN 1 THEN 'prevalidate' WHEN 2 THEN 'glue_convert'
              WHEN 3 THEN 'redshift_load' WHEN 4 THEN 'finalize'
              WHEN 5 THEN 'glue_convert' WHEN 6 THEN 'redshift_load'
              ELSE 'monitoring' END AS step,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
             || '-' || CAST(l_partkey AS VARCHAR) || '-'
             || CAST(l_suppkey AS VARCHAR) AS event_id,
         l_linestatus = 'F' AS from_states, l_linenumber, l_returnflag,
         l_suppkey,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END
             AS input_rows,
         CAST(l_quantity AS BIGINT)
             - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS output_rows,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN false
              WHEN l_returnflag = 'A' THEN NULL ELSE true END AS ok,
         l_shipdate AS ts
  FROM lineitem),
ev AS (
  SELECT *,
         CASE WHEN step IN ('redshift_load', 'finalize') THEN output_rows END
             AS inserted_rows,
         CASE WHEN ok = false AND l_linenumber <> 7
              THEN 'returned item ' || event_id END AS error,
         CASE WHEN from_states THEN
              CASE l_suppkey % 4 WHEN 0 THEN 'csv-to-parquet-pipeline'
                   WHEN 1 THEN 'json-to-dynamodb-pipeline'
                   WHEN 2 THEN 'log-aggregation-athena-pipeline'
                   ELSE 'unknown-pipeline' END
              ELSE 'csv-to-parquet-pipeline' END AS flow,
         CASE WHEN from_states THEN 'states' ELSE 'glue' END AS source,
         CASE WHEN NOT from_states THEN NULL
              WHEN l_linenumber = 4 AND ok = false THEN 'ExecutionFailed'
              WHEN l_linenumber = 4 THEN 'ExecutionSucceeded'
              ELSE 'TaskStateExited' END AS event_type,
         CASE WHEN from_states THEN step END AS state_name,
         from_states AND l_linenumber = 4 AS is_terminal
  FROM li
  WHERE from_states
     OR NOT (l_linenumber = 6 OR (l_returnflag = 'N' AND l_linenumber = 7))),
term AS (SELECT DISTINCT batch_id FROM ev WHERE is_terminal)
"""

_PARSE_COLS_SQL = """batch_id, step, event_id, source, event_type, state_name,
       flow, coalesce(ok, true) AS ok, error, ts, is_terminal,
       CAST(coalesce(input_rows, 0) AS BIGINT) AS input_rows,
       CAST(coalesce(output_rows, 0) AS BIGINT) AS output_rows,
       CAST(coalesce(inserted_rows, 0) AS BIGINT) AS inserted_rows"""


def _parse_cols(df: DataFrame) -> DataFrame:
    return df.select(
        "batch_id", "step", "event_id", "source", "event_type", "state_name",
        "flow", F.coalesce("ok", F.lit(True)).alias("ok"), "error", "ts",
        "is_terminal",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
          for c in ("input_rows", "output_rows", "inserted_rows")])


@register("evidence_parse", "P12 P13 P14 P15 U4 J2 S17", sql=_EV_SQL + f"""
SELECT {_PARSE_COLS_SQL} FROM ev
UNION ALL
SELECT {_PARSE_COLS_SQL}
FROM (SELECT * REPLACE (output_rows - 5 AS output_rows,
                        inserted_rows - 5 AS inserted_rows) FROM ev)
WHERE l_linenumber = 3
""")
def evidence_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every log event parsed (redelivered events appear twice here)."""
    # A map as small as this one is a condition on each row, read once.
    parsed = _parsed(spark, sf_dir, [
        "batch_id", "step", "event_id", "source", "event_type", "state_name",
        "execution_arn", "evidence_flow", "ok", "error", "ts", "is_terminal",
        "input_rows", "output_rows", "inserted_rows"])
    return _parse_cols(evo.with_flow(parsed, _flow_map(spark)))


def _deduped(spark: SparkSession, sf_dir: str, columns: list[str]
             ) -> DataFrame:
    cols = [*evo.EVENT_KEY, *evo.DELIVERY_ORDER, *columns]
    return evo.dedup_events(_parsed(spark, sf_dir, cols), cols)


_ROLLUP_SQL = """
SELECT batch_id,
  CAST(count_if({conv} AND coalesce(input_rows, 0) <> 0) AS BIGINT)
      AS input_files,
  CAST(coalesce(sum(CASE WHEN {conv} AND coalesce(input_rows, 0) <> 0
                         THEN input_rows END), 0) AS BIGINT) AS input_rows,
  CAST(count_if({conv} AND coalesce(output_rows, 0) <> 0) AS BIGINT)
      AS output_files,
  CAST(coalesce(sum(CASE WHEN {conv} AND coalesce(output_rows, 0) <> 0
                         THEN output_rows END), 0) AS BIGINT) AS output_rows,
  CAST(coalesce(sum(CASE WHEN {load} AND coalesce(inserted_rows, 0) <> 0
                         THEN inserted_rows END), 0) AS BIGINT)
      AS redshift_loaded,
  CAST(count(*) AS BIGINT) AS steps,
  CAST(count_if(NOT coalesce(ok, true)) AS BIGINT) AS failures,
  min(ts) AS started, max(ts) AS ended,
  CASE WHEN count_if(NOT coalesce(ok, true)) > 0 THEN 'ERROR' ELSE 'OK' END
      AS status
FROM ev WHERE batch_id IN (SELECT batch_id FROM term) GROUP BY batch_id
"""
ROLLUP_BY_STEP_SQL = _ROLLUP_SQL.format(conv="step = 'glue_convert'",
                                        load="step = 'redshift_load'")
ROLLUP_ALL_STEPS_SQL = _ROLLUP_SQL.format(conv="true", load="true")


def _summaries(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return evo.rollup(_deduped(spark, sf_dir, evo.COUNTED), mode,
                      terminal_only=True)


@register("evidence_rollup", "A13 P17 J5 Q15 Q16",
          sql=_EV_SQL + ROLLUP_BY_STEP_SQL)
def evidence_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of terminated batches, rows attributed by step."""
    return _summaries(spark, sf_dir, "by_step")


@register("evidence_rollup_all_steps", "A13 Q16",
          sql=_EV_SQL + ROLLUP_ALL_STEPS_SQL)
def evidence_rollup_all_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, summing rows over every step (the reference's behaviour)."""
    return _summaries(spark, sf_dir, "all_steps")


@register("row_reconcile", "A15 Q20", sql=_EV_SQL + f"""
, s AS ({ROLLUP_BY_STEP_SQL})
SELECT batch_id, 'inputs_present' AS check_name, CAST(1 AS BIGINT) AS expected,
       input_files AS actual, input_files > 0 AS passed,
       input_files > 0 AS passed_lenient, 1 - input_files AS difference FROM s
UNION ALL
SELECT batch_id, 'rows_in_vs_out', input_rows, output_rows,
       input_rows = output_rows, input_rows = output_rows,
       input_rows - output_rows FROM s
UNION ALL
SELECT batch_id, 'loaded_vs_out', output_rows, redshift_loaded,
       redshift_loaded = output_rows, redshift_loaded >= output_rows,
       output_rows - redshift_loaded FROM s
UNION ALL
SELECT batch_id, 'failures', CAST(0 AS BIGINT), failures, failures = 0,
       failures = 0, 0 - failures FROM s
""")
def row_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evo.reconcile(_summaries(spark, sf_dir, "by_step"))


@register("evidence_failures", "P17", sql=_EV_SQL + """
SELECT batch_id, step, event_id, coalesce(error, 'Unknown error') AS error
FROM ev WHERE NOT coalesce(ok, true)
""")
def evidence_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evo.failures(_deduped(spark, sf_dir, ["ok", "error"]))


@register("step_details", "A13 F2 F3", sql=_EV_SQL + """
SELECT batch_id, step, event_id,
       CASE step WHEN 'glue_convert' THEN 'AWS Glue Job'
            ELSE 'Lambda関数' END AS component,
       CASE step WHEN 'prevalidate' THEN '事前検証'
            WHEN 'glue_convert' THEN 'Glue変換'
            WHEN 'redshift_load' THEN 'Redshiftロード'
            WHEN 'finalize' THEN '終了処理' ELSE '監視処理' END
           AS display_name,
       coalesce(ok, true) AS ok, ts,
       's3://landing/orders/' || split_part(event_id, '-', 1) || '.csv'
           AS input_s3,
       CASE WHEN NOT coalesce(ok, true)
            THEN coalesce(error, 'Unknown error') END AS error
FROM ev
""")
def step_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step as a summary shows it."""
    seen = _deduped(spark, sf_dir, [
        "ok", "error", "ts", "is_signal", "input_s3", "output_s3"])
    return evo.step_details(seen).drop("output_s3")


@register("terminal_batches", "P16 A14", sql=_EV_SQL + """
SELECT batch_id, CAST(count(*) AS BIGINT) AS events,
       CAST(count_if(is_terminal) AS BIGINT) AS terminal_events,
       bool_or(is_terminal) AS terminal
FROM ev GROUP BY batch_id
""")
def terminal_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evo.batches_seen(_deduped(spark, sf_dir, ["is_terminal"]))


STRETCH = 1 << 16            # line items of one envelope at most
MIN_FOLDER_FILES = 40        # so that a stream takes several triggers


def write_envelopes(spark: SparkSession, sf_dir: str, path: str,
                    by_year: bool = False) -> None:
    """Log events grouped into delivery envelopes (per order and log
    group), written as gzip JSON lines.  The stretch of the input that a line
    item comes from is part of the envelope key, so an envelope never holds
    more than ``STRETCH`` line items, however many one order has.  With
    ``by_year`` each ship year becomes its own arrival folder.

    The line items are dealt out and sorted by the envelope key while they
    are narrow; the messages are then made and collected in that order, and
    neither shuffled nor sorted."""
    items = _line_items(spark, sf_dir)
    n = max(_pieces(items), MIN_FOLDER_FILES if by_year else 1)
    year = ["year"] if by_year else []
    if by_year:
        items = items.withColumn("year", F.year("l_shipdate"))
    deal = [*year, "l_orderkey", "_stretch"]
    keys = [*deal, "log_group"]
    items = items.withColumn("_stretch", F.expr(
        f"monotonically_increasing_id() div {STRETCH}"))
    dealt = _deliveries(items.repartitionByRange(n, *deal))
    ev = _events_of(dealt.sortWithinPartitions(*keys), "_stretch", *year)
    env = ev.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("event_id").alias("id"),
            F.unix_millis("delivered_at").alias("timestamp"),
            F.col("message").alias("message")))).alias("events"))
    out = env.select(
        *(["year"] if by_year else []),
        F.lit("DATA_MESSAGE").alias("messageType"),
        F.col("log_group").alias("logGroup"),
        F.col("l_orderkey").cast("string").alias("logStream"),
        F.col("events").alias("logEvents"))
    writer = out.write.option("compression", "gzip")
    if by_year:
        writer = writer.partitionBy("year")
    # Groups of sorted rows end one after the other; a hash table of them
    # would turn to sorting the messages.
    with conf_set(spark, "spark.sql.execution.useObjectHashAggregateExec",
                  "false"):
        writer.json(path)


_STORE_SQL = """
SELECT batch_id, step, CAST(count(*) AS BIGINT) AS events,
       CAST(coalesce(sum(input_rows), 0) AS BIGINT) AS rows_in,
       CAST(coalesce(sum(output_rows), 0) AS BIGINT) AS rows_out,
       CAST(coalesce(sum(inserted_rows), 0) AS BIGINT) AS inserted,
       CAST(count_if(NOT coalesce(ok, true)) AS BIGINT) AS failures
FROM ev WHERE batch_id IN (SELECT batch_id FROM term) GROUP BY batch_id, step
"""


@register("evidence_store", "S12 S13 S14 S15 S16 ST2", sql=_EV_SQL + _STORE_SQL)
def evidence_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes land as gzip JSON; they are archived raw, exploded,
    parsed, appended to the batch-partitioned store, finalized for the
    terminated batches (summary sink), and the stored evidence of those
    batches is read back de-duplicated."""
    root = new_run_dir(spark, "evidence")
    landing, raw = f"{root}/landing", f"{root}/raw"
    ev_store, summaries = f"{root}/store", f"{root}/summaries"
    write_envelopes(spark, sf_dir, landing)
    store.archive_raw(spark, landing, raw)
    # The archive (S16) is what is parsed, so it is read back whole.
    events = evo.explode_envelopes(store.read_raw(spark, raw))
    # A map as small as this one is a condition on each row, read once.
    store.append_evidence(evo.with_flow(
        evo.parse_log_events(events, None, CLOCK, evo.STORED),
        _flow_map(spark)), ev_store, gather=False)
    key = [*evo.EVENT_KEY, *evo.DELIVERY_ORDER]
    seen = store.read_evidence(spark, ev_store, columns=key + evo.COUNTED)
    store.write_summaries(evo.rollup(seen, terminal_only=True), summaries)
    # J5 + S13: the stored evidence of the finalized batches, read through
    # a semi join on the partition column (dynamic partition pruning).
    finalized = store.read_summaries(spark, summaries).select("batch_id")
    stored = store.read_evidence(spark, ev_store, batches=finalized, columns=[
        *key, "ok", "input_rows", "output_rows", "inserted_rows"])
    return stored.groupBy("batch_id", "step").agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).cast("bigint")
        .alias("rows_in"),
        F.coalesce(F.sum("output_rows"), F.lit(0)).cast("bigint")
        .alias("rows_out"),
        F.coalesce(F.sum("inserted_rows"), F.lit(0)).cast("bigint")
        .alias("inserted"),
        F.count_if(evo.failed(F.col("ok"))).alias("failures"))


# ---------------------------------------------------------------------------
# Fixed fixture values: URL patterns -> flow, in order, for the pages table.
PAGE_FLOW_PATTERNS = {"blog.": "blog-pipeline", "spam": "spam-pipeline",
                      "/en/": "english-pipeline", ".html": "html-pipeline"}
_PAGE_FLOW_SQL = """
SELECT page_id, url,
       CASE WHEN contains(url, 'blog.') THEN 'blog-pipeline'
            WHEN contains(url, 'spam') THEN 'spam-pipeline'
            WHEN contains(url, '/en/') THEN 'english-pipeline'
            WHEN contains(url, '.html') THEN 'html-pipeline'
            ELSE 'unknown-pipeline' END AS flow
FROM pages
"""


@register("flow_classify", "J2 S17", sql=_PAGE_FLOW_SQL)
def flow_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page URL to the flow of its first matching pattern."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    flow_map = read_flow_map(spark, write_flow_map(spark, PAGE_FLOW_PATTERNS))
    return classify_flow(pages, "url", flow_map)


LARGE_MAP = 1000


@register("flow_classify_join", "J2", sql=f"""
WITH m AS (
  SELECT CAST(i AS BIGINT) AS ord, CASE WHEN i = 999 THEN '' ELSE
         CAST((i * 37) % 997 AS VARCHAR) END AS pattern,
         CASE WHEN i % 50 = 7 THEN NULL ELSE 'flow-' || CAST(i AS VARCHAR) END
             AS flow
  FROM range({LARGE_MAP}) t(i)),
v AS (SELECT DISTINCT url FROM pages),
h AS (SELECT url, arg_min({{'f': flow}}, (ord, pattern)) AS f
      FROM v JOIN m ON contains(url, pattern) GROUP BY url)
SELECT page_id, p.url, CASE WHEN h.url IS NULL THEN 'unknown-pipeline'
                            ELSE h.f.f END AS flow
FROM pages p LEFT JOIN h ON p.url = h.url
""")
def flow_classify_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of a thousand number patterns over a shuffled input: an empty
    pattern that matches all, null flows, patterns of one to three digits."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    i = F.col("id")
    flow_map = spark.range(LARGE_MAP).select(
        i.alias("ord"),
        F.when(i == LARGE_MAP - 1, "").otherwise(
            ((i * 37) % 997).cast("string")).alias("pattern"),
        F.when(i % 50 != 7, F.concat(F.lit("flow-"), i.cast("string")))
        .alias("flow"))
    return classify_flow(pages.repartition("url"), "url", flow_map)


# ---------------------------------------------------------------------------
SCALAR_STEPS = ("prevalidate", "glue_convert", "redshift_load", "finalize",
                "monitoring", "archive")
EXT_BY_TYPE = {"click": ".csv", "view": ".parquet", "purchase": ".json",
               "signup": ".csv.gz", "error": ".txt"}


def _by_type(col: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out


@register("scalar_labels", "F1 F2 F3 F4 F7 F9 F10 F13", sql="""
WITH e AS (
  SELECT event_id, event_type, props, ts, value, user_id,
         CASE event_id % 6 WHEN 0 THEN 'prevalidate' WHEN 1 THEN 'glue_convert'
              WHEN 2 THEN 'redshift_load' WHEN 3 THEN 'finalize'
              WHEN 4 THEN 'monitoring' ELSE 'archive' END AS step,
         's3://landing/' || event_type || '/' || CAST(event_id AS VARCHAR)
             || CASE event_type WHEN 'click' THEN '.csv'
                WHEN 'view' THEN '.parquet' WHEN 'purchase' THEN '.json'
                WHEN 'signup' THEN '.csv.gz' WHEN 'error' THEN '.txt' END
             AS path,
         date_diff('second', date_trunc('day', ts), ts) AS secs
  FROM events)
SELECT event_id,
       regexp_replace(coalesce(nullif(event_type || '/' || props, ''),
                               'unknown'), '[^0-9A-Za-z._/-]+', '_', 'g')
           AS safe_name,
       step,
       CASE step WHEN 'prevalidate' THEN 'Lambda関数'
            WHEN 'glue_convert' THEN 'AWS Glue Job'
            WHEN 'redshift_load' THEN 'Lambda関数'
            WHEN 'finalize' THEN 'Lambda関数'
            WHEN 'monitoring' THEN 'Lambda関数'
            ELSE 'その他のAWSサービス' END AS component,
       CASE step WHEN 'prevalidate' THEN '事前検証'
            WHEN 'glue_convert' THEN 'Glue変換'
            WHEN 'redshift_load' THEN 'Redshiftロード'
            WHEN 'finalize' THEN '終了処理' WHEN 'monitoring' THEN '監視処理'
            ELSE step END AS display_name,
       CASE WHEN contains(path, '.csv') THEN 'CSVファイル'
            WHEN contains(path, '.parquet') THEN 'Parquetファイル'
            WHEN contains(path, '.json') THEN 'JSONファイル'
            ELSE 'ファイル' END AS file_type,
       coalesce(CASE WHEN event_type <> 'view'
                     THEN 'U' || CAST(user_id AS VARCHAR) END,
                'JSON_' || strftime(ts, '%Y%m%d%H%M')) AS batch_id,
       TRY_CAST(trim(json_extract_string(props, '$.k')) AS BIGINT) AS k_value,
       CASE WHEN secs < 60 THEN CAST(secs AS VARCHAR) || '秒'
            WHEN secs < 3600 THEN CAST(secs // 60 AS VARCHAR) || '分'
                 || CAST(secs % 60 AS VARCHAR) || '秒'
            ELSE CAST(secs // 3600 AS VARCHAR) || '時間'
                 || CAST((secs % 3600) // 60 AS VARCHAR) || '分' END
           AS duration_text,
       concat_ws(' | ', 'event ' || event_type,
                 CASE WHEN value > 100
                      THEN 'value ' || CAST(CAST(round(value) AS BIGINT)
                                            AS VARCHAR) END,
                 CASE WHEN event_type = 'error' THEN 'エラー: ' || props END)
           AS note
FROM e
""")
def scalar_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report helpers applied to every event."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "props", "ts", "value", "user_id")
    step = F.element_at(F.array(*[F.lit(s) for s in SCALAR_STEPS]),
                        F.pmod("event_id", F.lit(6)).cast("int") + 1)
    path = F.concat(F.lit("s3://landing/"), F.col("event_type"), F.lit("/"),
                    F.col("event_id").cast("string"),
                    _by_type(F.col("event_type"), EXT_BY_TYPE))
    batch = F.when(F.col("event_type") != "view",
                   F.concat(F.lit("U"), F.col("user_id").cast("string")))
    return ev.select(
        "event_id",
        fx.safe_name(F.concat_ws("/", "event_type", "props"))
        .alias("safe_name"),
        step.alias("step"),
        fx.component_type(step).alias("component"),
        fx.step_display_name(step).alias("display_name"),
        fx.file_type(path).alias("file_type"),
        fx.default_batch_id(batch, "JSON_", F.col("ts")).alias("batch_id"),
        fx.try_int(F.trim(F.get_json_object("props", "$.k")))
        .alias("k_value"),
        fx.duration_text(F.date_trunc("day", "ts"), F.col("ts"))
        .alias("duration_text"),
        fx.note_text(
            F.concat(F.lit("event "), F.col("event_type")),
            F.when(F.col("value") > 100,
                   F.concat(F.lit("value "),
                            F.round("value").cast("bigint").cast("string"))),
            F.when(F.col("event_type") == "error",
                   F.concat(F.lit("エラー: "), F.col("props"))))
        .alias("note"))


# ---------------------------------------------------------------------------
SUMMARY_COLUMNS = ("batch_id", "input_files", "input_rows", "output_files",
                   "output_rows", "redshift_loaded", "steps", "failures",
                   "started", "ended", "status")


@register("stream_evidence", "ST1 ST2 ST3 ST4 S12 S13 S14",
          sql=_EV_SQL + ROLLUP_BY_STEP_SQL)
def stream_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes arrive in one folder per ship year; a file stream ingests
    them in several micro-batches (late evidence re-finalizes terminated
    batches).  After all input the summaries equal the batch roll-up."""
    from runledger.streaming.evidence_stream import (
        EvidenceStreamConfig, run_until_done, start_evidence_stream)
    root = new_run_dir(spark, "stream")
    write_envelopes(spark, sf_dir, f"{root}/landing", by_year=True)
    cfg = EvidenceStreamConfig(
        landing=f"{root}/landing/*", store=f"{root}/store",
        summaries=f"{root}/summaries", checkpoint=f"{root}/checkpoint",
        ingested_at=CLOCK, max_files_per_trigger=32)
    run_until_done(start_evidence_stream(spark, cfg, _flow_map(spark)))
    return store.read_summaries(spark, cfg.summaries).select(*SUMMARY_COLUMNS)


# ---------------------------------------------------------------------------
APPENDS = 4


@register("evidence_compaction", "S12 S13 S14 A13",
          sql=_EV_SQL + ROLLUP_BY_STEP_SQL)
def evidence_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence arrives in several appends, each with a version of the
    summaries; the parts are packed on the way and at the end.  The summaries
    read then equal the roll-up of all evidence.

    Deliveries are dealt out to the appends while they are line items, so
    nothing but the store holds their messages."""
    root = new_run_dir(spark, "compaction")
    ev_store, summaries = f"{root}/store", f"{root}/summaries"
    counted = [*evo.EVENT_KEY, *evo.DELIVERY_ORDER, *evo.COUNTED]
    for k in range(APPENDS):
        arrived = evo.parse_log_events(_lineitem_events(
            spark, sf_dir, (k, APPENDS)), None, CLOCK, evo.STORED)
        store.append_evidence(evo.with_flow(arrived, None), ev_store)
        seen = store.read_evidence(spark, ev_store, columns=counted)
        store.write_summaries(evo.rollup(seen, terminal_only=True),
                              summaries, k)
        if k % 2:
            store.compact_evidence(spark, ev_store)
            store.compact_versions(spark, summaries, store.VERSIONED_SUMMARY,
                                   ["batch_id"])
    for path in (ev_store, summaries):
        # A part that is full is left as it is.
        if len(snapshots.small_parts(spark, path)) > 1:
            raise RuntimeError(f"{path} has not been packed")
    return store.read_summaries(spark, summaries).select(*SUMMARY_COLUMNS)
