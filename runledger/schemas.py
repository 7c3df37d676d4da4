"""Explicit schemas for evidence, manifests, batches and log envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

S, L, B, D = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Step-specific input/output fields as one wide nullable struct each.
EVIDENCE_INPUT = _struct(
    ("s3", S), ("rows", L), ("dataset", S), ("file", S),
    ("files_count", L), ("total_size_bytes", L), ("total_files", L),
    ("items", L), ("total_items", L), ("files", L), ("log_files", L),
    ("crawler", S), ("database", S), ("tables", L), ("batch_id", S))

# ``errors`` is an array of messages for prevalidate and a number for the
# log collector, so it is parsed as raw JSON text and split afterwards.
EVIDENCE_OUTPUT = _struct(
    ("s3", S), ("rows", L), ("format", S), ("validated_files", L),
    ("errors", S), ("successful_conversions", L), ("successful_loads", L),
    ("total_failures", L), ("items", L), ("successful_writes", L),
    ("failed_writes", L), ("success_rate", D), ("lines", L), ("tables", L),
    ("tables_created", L), ("analyzed_rows", L), ("successful_queries", L),
    ("rows_analyzed", L))

EVIDENCE_LOAD = _struct(("table", S), ("inserted_rows", L),
                        ("dropped_rows", L), ("reason", S))

# One evidence record as it appears in a log line (``ts`` still text).
EVIDENCE_RAW = _struct(
    ("batch_id", S), ("test_id", S), ("flow", S), ("step", S), ("note", S),
    ("error", S), ("ok", B), ("ts", S), ("event_id", S), ("event_type", S),
    ("execution_arn", S), ("state_name", S), ("is_terminal", B),
    ("input", EVIDENCE_INPUT), ("output", EVIDENCE_OUTPUT),
    ("load", EVIDENCE_LOAD))


def evidence_wrapped(record: T.StructType = EVIDENCE_RAW) -> T.StructType:
    """A glue-style line may wrap the record in {"evidence": {...}}."""
    return T.StructType(
        list(record.fields) + [T.StructField("evidence", record)])


def state_log(record: T.StructType = EVIDENCE_RAW,
              texts: Sequence[str] = ("executionArn", "state")
              ) -> T.StructType:
    """A state-machine log message, with those of its own texts."""
    return _struct(
        ("type", S), *[(t, S) for t in texts],
        ("input", _struct(("evidence", record), ("batch_id", S))),
        ("output", _struct(("evidence", record),
                           ("Payload", _struct(("evidence", record))))),
        ("evidence", record))


def record_part(paths: list[str]) -> T.StructType:
    """The fields of a record under the given paths (``a`` or ``a.b``)."""
    fields = []
    for f in EVIDENCE_RAW.fields:
        inner = {p.split(".")[1] for p in paths if p.startswith(f.name + ".")}
        if f.name in paths:
            fields.append(f)
        elif inner:
            fields.append(T.StructField(f.name, T.StructType(
                [g for g in f.dataType.fields if g.name in inner])))
    return T.StructType(fields)


LOG_EVENT = _struct(("id", S), ("timestamp", L), ("message", S))
LOG_ENVELOPE = _struct(("messageType", S), ("logGroup", S),
                       ("logStream", S),
                       ("logEvents", T.ArrayType(LOG_EVENT)))

FILE_REF = _struct(("bucket", S), ("key", S))
MANIFEST = _struct(("batch_id", S), ("files", T.ArrayType(FILE_REF)))

FLOW_MAP_DOC = _struct(("flow_patterns", T.MapType(S, S, True)))

# Parser-flag column: set by from_json when the text is malformed or a value
# does not fit its field (the other fields are still filled).
CORRUPT = "_corrupt_record"
JSON_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT}


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, S)])
