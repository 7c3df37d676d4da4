"""Evidence: parse run logs (P12-P15, U4), classify flows (J2), find
terminal batches (P16, A14, J5), roll up per batch (A13, P17) and reconcile
counts (A15).

Parsing is pure projection over log events (``from_json`` with an explicit
schema), so it runs in the scan stage.  The roll-up is one grouped
aggregation of conditional sums, which Spark combines map-side; the steps
and failures of a batch stay long-form tables instead of arrays collected
into a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger import schemas
from runledger.functions.scalar import (
    component_type, epoch_batch_id, safe_name, step_display_name)
from runledger.operators.flows import classify_flow

# Marker, log-group routing, terminal event types, defaults.
EVIDENCE_PREFIX = "EVIDENCE "
STATES_GROUP_MARK = "/aws/states/"
TERMINAL_TYPES = ("ExecutionSucceeded", "ExecutionFailed",
                  "ExecutionAborted", "ExecutionTimedOut")
UNKNOWN_ERROR = "Unknown error"
MISSING_BATCH_PREFIX = "B"
STATUS_OK = "OK"
STATUS_ERROR = "ERROR"
STEP_CONVERT = "glue_convert"
STEP_LOAD = "redshift_load"

# The fields of a record that each parsed column is made of, in the order of
# the columns.
PARSED_FROM = {
    "batch_id": ["batch_id"], "step": ["step"], "event_id": [], "source": [],
    "event_type": ["event_type"], "execution_arn": ["execution_arn"],
    "state_name": ["state_name"], "evidence_flow": ["flow"],
    "test_id": ["test_id"], "ok": ["ok"], "error": ["error"],
    "note": ["note"], "ts": ["ts"], "ingested_at": [], "event_hash": [],
    "is_terminal": ["is_terminal"], "is_signal": [],
    "input_rows": ["input.rows"], "output_rows": ["output.rows"],
    "inserted_rows": ["load.inserted_rows"], "input_s3": ["input.s3"],
    "output_s3": ["output.s3"], "load_table": ["load.table"],
    "evidence": [f.name for f in schemas.EVIDENCE_RAW.fields],
    "raw_message": [], "object_key": ["step"]}
# Fields of a state log that only these columns need.
STATE_FIELDS = {"execution_arn": "executionArn", "state_name": "state"}
# What is stored: the nested record is in the delivered text.
STORED = [c for c in PARSED_FROM if c != "evidence"]


def _record(parsed: Column, record: T.StructType) -> Column:
    """The evidence-shaped fields of a parsed glue line as one struct."""
    return F.struct(*[parsed[f].alias(f) for f in record.names])


def _is_object(text: Column) -> Column:
    """The text is a well-formed JSON object (malformed -> false)."""
    return F.json_object_keys(text).isNotNull()


def _checked(parsed: str) -> Column:
    """The parsed struct unless the text was flagged and is not an object; the
    flag is the text, which need not be carried along for this."""
    flag = F.col(parsed)[schemas.CORRUPT]
    return F.when(F.col(parsed).isNotNull()
                  & (flag.isNull() | _is_object(flag)), F.col(parsed))


def _signal_record(batch_id: Column, record: T.StructType) -> Column:
    """An evidence-shaped record that only names its batch."""
    return F.struct(*[
        (batch_id if f.name == "batch_id" else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in record.fields])


def glue_evidence(parsed: Column,
                  record: T.StructType = schemas.EVIDENCE_RAW) -> Column:
    """The record of a parsed ``EVIDENCE {json}`` body; the JSON may
    wrap it in ``{"evidence": ...}``."""
    return F.coalesce(parsed["evidence"], _record(parsed, record))


def state_evidence(log: Column) -> Column:
    """Evidence from ``input``, then ``output``, then the top level,
    then an invoked step's ``output.Payload`` (Q22)."""
    return F.coalesce(log["input"]["evidence"], log["output"]["evidence"],
                      log["evidence"], log["output"]["Payload"]["evidence"])


def parse_log_events(events: DataFrame, flow_map: DataFrame | None,
                     ingested_at: str, columns: list[str] | None = None
                     ) -> DataFrame:
    """P12-P15 + U4 over ``(log_group, event_id, message)`` rows, with the
    time of delivery in ``delivered_at`` (timestamp) if there is one.

    Returns one flat row per event that yields evidence; the rest (no
    marker, marker not at the start, malformed JSON, state logs without
    evidence) are dropped.  ``ts`` keeps the event time (Q17);
    ``ingested_at`` is the time of delivery, or the argument where an event
    has none.  A record without a batch id gets ``B`` and the epoch seconds
    of its delivery.

    The flow of state-log evidence follows from its execution ARN
    (``with_flow``); without a flow map the record's own flow stays.

    With ``columns`` (of ``PARSED_FROM``; no flow) only those are returned,
    and only the fields of the JSON that they are made of are decoded.

    Each JSON text is parsed once, in its own projection: the parsed struct
    is referenced by many field accesses, and Catalyst does not inline a
    non-cheap expression that is used more than once.
    """
    wanted = columns or list(PARSED_FROM)
    record = schemas.record_part(["batch_id", "is_terminal"] + [
        f for c in wanted for f in PARSED_FROM[c]])
    glue_schema = schemas.with_corrupt(schemas.evidence_wrapped(record))
    state_schema = schemas.with_corrupt(schemas.state_log(record, [
        f for c, f in STATE_FIELDS.items() if c in wanted]))
    msg = F.col("message")
    clock = F.lit(ingested_at).cast("timestamp_ntz")
    arrived = (F.coalesce(F.col("delivered_at").cast("timestamp_ntz"), clock)
               if "delivered_at" in events.columns else clock)
    texts = events.select(
        "event_id", "log_group", arrived.alias("_arrived"),
        F.col("log_group").contains(STATES_GROUP_MARK).alias("_states"),
        # Cut by bytes, which needs no count of characters.
        F.when(msg.startswith(EVIDENCE_PREFIX), F.substring(
            msg.cast("binary"), len(EVIDENCE_PREFIX) + 1, 1 << 30)
            .cast("string")).alias("_body"),
        msg.alias("_msg"),
        F.xxhash64("log_group", msg).alias("event_hash"))
    decoded = texts.select(
        "event_id", "log_group", "_arrived", "_states", "event_hash", "_msg",
        F.from_json("_body", glue_schema, schemas.JSON_OPTIONS)
        .alias("_glue_raw"),
        F.when(F.col("_states"),
               F.from_json("_msg", state_schema, schemas.JSON_OPTIONS))
        .alias("_log_raw"))
    # A flagged text is kept only if it is still a JSON object (a value of
    # the wrong type leaves the other fields usable); the second, cheaper
    # check runs for flagged rows only.
    parsed = decoded.select(
        "event_id", "log_group", "_arrived", "_states", "event_hash", "_msg",
        _checked("_glue_raw").alias("_glue"),
        _checked("_log_raw").alias("_log"))
    log = F.col("_log")
    from_glue = F.when(F.col("_glue").isNotNull(),
                       glue_evidence(F.col("_glue"), record))
    from_states = F.when(F.col("_states"), state_evidence(log))
    terminal_event = F.col("_states") & log["type"].isin(*TERMINAL_TYPES)
    # Q18: a terminal event without evidence still ends its batch when its
    # input names the batch; it becomes a signal row (not a step).
    signal = F.when(terminal_event & log["input"]["batch_id"].isNotNull(),
                    _signal_record(log["input"]["batch_id"], record))
    states_src = from_glue.isNull()
    # Events without evidence are dropped by exploding an array of one element
    # or null rather than by a filter: a filter here would be pushed below
    # these projections with every JSON expression inlined into it, doing the
    # parse twice.
    found = F.coalesce(from_glue, from_states, signal)
    kept = F.when(found.isNotNull(), F.array(F.struct(
        found.alias("ev"),
        (from_glue.isNull() & from_states.isNull()).alias("is_signal"),
        F.when(states_src, "states").otherwise("glue").alias("source"),
        F.when(states_src, log["type"]).alias("event_type"),
        *[F.when(states_src, log[f]).alias(c)
          for c, f in STATE_FIELDS.items() if c in wanted],
        F.coalesce(terminal_event, F.lit(False)).alias("_terminal_event"))))
    staged = parsed.select("event_id", "log_group", "event_hash", "_msg",
                           "_arrived", F.explode(kept).alias("_k")).select(
        "event_id", "log_group", "event_hash", "_msg", "_arrived", "_k.*")
    e = F.col("ev")
    made = {
        "batch_id": lambda: epoch_batch_id(
            e["batch_id"], MISSING_BATCH_PREFIX, F.col("_arrived")),
        "event_id": lambda: F.col("event_id"),
        "source": lambda: F.col("source"),
        "event_type": lambda: F.coalesce("event_type", e["event_type"]),
        "execution_arn": lambda: F.coalesce("execution_arn",
                                            e["execution_arn"]),
        "state_name": lambda: F.coalesce("state_name", e["state_name"]),
        "evidence_flow": lambda: e["flow"],
        "ts": lambda: e["ts"].try_cast("timestamp_ntz"),
        "ingested_at": lambda: F.col("_arrived"),
        "event_hash": lambda: F.col("event_hash"),
        "is_terminal": lambda: F.col("_terminal_event") | F.coalesce(
            e["is_terminal"], F.lit(False)),
        "is_signal": lambda: F.col("is_signal"),
        "input_rows": lambda: e["input"]["rows"],
        "output_rows": lambda: e["output"]["rows"],
        "inserted_rows": lambda: e["load"]["inserted_rows"],
        "input_s3": lambda: e["input"]["s3"],
        "output_s3": lambda: e["output"]["s3"],
        "load_table": lambda: e["load"]["table"],
        "evidence": lambda: e,      # the whole record, nested (in flight)
        "raw_message": lambda: F.col("_msg")}     # as delivered (stored)
    out = staged.select(*[
        (made[c]() if c in made else e[c]).alias(c)
        for c in PARSED_FROM if c in {*wanted, "batch_id", "step", "event_id"}
        and c in {*made, *record.names}])
    if "object_key" in wanted:
        out = out.withColumn("object_key", F.concat_ws(
            "/", F.lit("evidence"), "batch_id", F.lit("per-step"),
            F.concat(safe_name(F.col("step")), F.lit("_"),
                     F.coalesce("event_id", F.lit("")), F.lit(".json"))))
    if columns:
        return out.select(*columns)
    return with_flow(out, flow_map)


def with_flow(evidence: DataFrame, flow_map: DataFrame | None) -> DataFrame:
    """State-log evidence takes its flow from the execution ARN, other
    evidence from its record."""
    if flow_map is None:
        return evidence.withColumn("flow", F.col("evidence_flow"))
    return (classify_flow(evidence, "execution_arn", flow_map, "_arn_flow")
            .withColumn("flow", F.when(F.col("source") == "states",
                                       F.col("_arn_flow"))
                        .otherwise(F.col("evidence_flow")))
            .drop("_arn_flow"))


def explode_envelopes(envelopes: DataFrame) -> DataFrame:
    """One row per log event of each envelope."""
    return envelopes.select(
        F.col("logGroup").alias("log_group"),
        F.explode(F.coalesce("logEvents", F.array())).alias("e")).select(
        "log_group", F.col("e.id").alias("event_id"),
        F.col("e.message").alias("message"),
        F.timestamp_millis("e.timestamp").alias("delivered_at"))


# ST2 / W2 -------------------------------------------------------------------
EVENT_KEY = ["batch_id", "step", "event_id"]


DELIVERY_ORDER = ["ingested_at", "event_hash"]
# What the roll-up reads of a delivery, beside its key and order.
COUNTED = ["ok", "ts", "is_terminal", "is_signal", "input_rows",
           "output_rows", "inserted_rows"]
ROLLUP_INPUT = ["batch_id", "step", "event_id", "ingested_at", "event_hash",
                "ok", "error", "ts", "is_terminal", "is_signal",
                "input_rows", "output_rows", "inserted_rows"]


def dedup_events(evidence: DataFrame,
                 columns: list[str] | None = None) -> DataFrame:
    """A redelivered event overwrites the same key: keep the latest arrival
    per (batch, step, event id); equal arrivals are ordered by the hash of
    the delivered text, so the choice is deterministic.  A ``max_by``
    aggregate, combined map-side (skew-safe).  ``columns`` limits what is
    carried through the shuffle (e.g. ``ROLLUP_INPUT``)."""
    from runledger.operators.keyed import latest_per_key
    cols = columns or evidence.columns
    keyed = (evidence.select(*cols)
             .withColumn("step", F.coalesce("step", F.lit("unknown")))
             .withColumn("event_id", F.coalesce("event_id", F.lit(""))))
    # Equal hashes are equal texts, between which there is nothing to choose.
    # The event id comes first in the sort, as it tells most rows apart.
    return latest_per_key(keyed, EVENT_KEY[::-1], DELIVERY_ORDER,
                          tie=F.lit(0)).select(*cols)


# P16 / A14 / J5 -------------------------------------------------------------
def batches_seen(evidence: DataFrame) -> DataFrame:
    """Every batch with evidence, whether it terminated, and how many
    events and terminal events it has."""
    return evidence.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_terminal").alias("terminal_events"),
        F.bool_or("is_terminal").alias("terminal"))


def terminal_batches(evidence: DataFrame) -> DataFrame:
    return evidence.where(F.col("is_terminal")).select("batch_id").distinct()


def restrict_to(evidence: DataFrame, batches: DataFrame) -> DataFrame:
    """Evidence of the given batches only (left semi join)."""
    return evidence.join(batches, "batch_id", "left_semi")


# P17 / A13 ------------------------------------------------------------------
def failed(ok: Column) -> Column:
    """``ok`` false; a missing ``ok`` means success."""
    return ~F.coalesce(ok, F.lit(True))


def _truthy(c: Column) -> Column:
    return F.coalesce(c != 0, F.lit(False))


PARTIAL_SUMS = ("input_files", "input_rows", "output_files", "output_rows",
                "redshift_loaded", "steps", "failures")


def rollup_partials(evidence: DataFrame, mode: str = "by_step") -> DataFrame:
    """A13's per-batch aggregates before the status is derived (sums,
    counts, first/last time, terminated)."""
    if mode not in ("by_step", "all_steps"):
        raise ValueError(f"unknown roll-up mode {mode}")
    step = F.col("step")
    conv = F.lit(True) if mode == "all_steps" else step == STEP_CONVERT
    load = F.lit(True) if mode == "all_steps" else step == STEP_LOAD
    has_in = conv & _truthy(F.col("input_rows"))
    has_out = conv & _truthy(F.col("output_rows"))
    has_load = load & _truthy(F.col("inserted_rows"))
    step_row = (~F.coalesce(F.col("is_signal"), F.lit(False))
                if "is_signal" in evidence.columns else F.lit(True))
    return evidence.groupBy("batch_id").agg(
        F.count_if(has_in).alias("input_files"),
        F.coalesce(F.sum(F.when(has_in, F.col("input_rows"))), F.lit(0))
        .cast("bigint").alias("input_rows"),
        F.count_if(has_out).alias("output_files"),
        F.coalesce(F.sum(F.when(has_out, F.col("output_rows"))), F.lit(0))
        .cast("bigint").alias("output_rows"),
        F.coalesce(F.sum(F.when(has_load, F.col("inserted_rows"))), F.lit(0))
        .cast("bigint").alias("redshift_loaded"),
        F.count_if(step_row).alias("steps"),
        F.count_if(step_row & failed(F.col("ok"))).alias("failures"),
        F.min("ts").alias("started"), F.max("ts").alias("ended"),
        F.coalesce(F.bool_or("is_terminal"), F.lit(False)).alias("terminal"),
        F.count_if("is_terminal").alias("terminal_events"))


def finish_rollup(partials: DataFrame, terminal_only: bool = False
                  ) -> DataFrame:
    """Summaries from partials: optional terminal filter (ST3), status."""
    if terminal_only:
        partials = partials.where(F.col("terminal"))
    return partials.select(
        "batch_id", *PARTIAL_SUMS, "started", "ended",
        F.when(F.col("failures") > 0, STATUS_ERROR).otherwise(STATUS_OK)
        .alias("status"))


def rollup(evidence: DataFrame, mode: str = "by_step",
           terminal_only: bool = False) -> DataFrame:
    """A13 per batch.  ``all_steps`` sums every step's rows (the reference
    as is, Q16); ``by_step`` takes input/output rows from the conversion
    and loaded rows from the load step only.  Zero or missing rows add to
    neither the sum nor the file count (Q15).

    ``terminal_only`` keeps the batches that have a terminal event (ST3).
    Being terminal is a property of the whole batch, so it is computed in
    the same aggregation (``bool_or``) instead of a semi join of the
    evidence with itself (J5), which would scan the evidence twice."""
    return finish_rollup(rollup_partials(evidence, mode), terminal_only)


def step_details(evidence: DataFrame, signals: bool = False) -> DataFrame:
    """What a summary shows of each step: component, display name, outcome,
    where it read and wrote, and its error.  One long row per step event; if
    wanted, signals too, with columns that tell them and terminal events."""
    step = F.coalesce("step", F.lit("unknown"))
    signal = F.coalesce("is_signal", F.lit(False))
    return evidence.where(F.lit(signals) | ~signal).select(
        "batch_id", step.alias("step"), "event_id",
        component_type(step).alias("component"),
        step_display_name(step).alias("display_name"),
        F.coalesce("ok", F.lit(True)).alias("ok"), "ts", "input_s3",
        "output_s3",
        F.when(failed(F.col("ok")), F.coalesce("error", F.lit(UNKNOWN_ERROR)))
        .alias("error"),
        *([signal.alias("is_signal"),
           F.coalesce("is_terminal", F.lit(False)).alias("is_terminal")]
          if signals else []))


def failures(evidence: DataFrame) -> DataFrame:
    """The failure list of every batch, long form."""
    return evidence.where(failed(F.col("ok"))).select(
        "batch_id", "step", "event_id",
        F.coalesce("error", F.lit(UNKNOWN_ERROR)).alias("error"))


# A15 ------------------------------------------------------------------------
def reconcile(summary: DataFrame) -> DataFrame:
    """Count checks per batch in long form.  ``passed`` is the strict
    comparison (loaded == output), ``passed_lenient`` the >= variant."""
    return summary.selectExpr(
        "batch_id",
        "stack(4, "
        "'inputs_present', CAST(1 AS BIGINT), input_files, "
        "  input_files > 0, input_files > 0, "
        "'rows_in_vs_out', input_rows, output_rows, "
        "  input_rows = output_rows, input_rows = output_rows, "
        "'loaded_vs_out', output_rows, redshift_loaded, "
        "  redshift_loaded = output_rows, redshift_loaded >= output_rows, "
        "'failures', CAST(0 AS BIGINT), failures, "
        "  failures = 0, failures = 0"
        ") AS (check_name, expected, actual, passed, passed_lenient)"
    ).withColumn("difference", F.col("expected") - F.col("actual"))


# S18 (any step) -------------------------------------------------------------
def evidence_log_lines(records: DataFrame, log_group: str,
                       event_id: Column) -> DataFrame:
    """Emit evidence the way a step logs it: one ``EVIDENCE {json}`` line
    per record.  ``records`` has an ``evidence`` struct column shaped like
    (a subset of) ``schemas.EVIDENCE_RAW``; the lines go through
    ``parse_log_events`` into the same store as every other step."""
    return records.select(
        F.lit(log_group).alias("log_group"), event_id.alias("event_id"),
        F.concat(F.lit(EVIDENCE_PREFIX),
                 F.to_json(F.struct(F.col("evidence").alias("evidence"))))
        .alias("message"))
