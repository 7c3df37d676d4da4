"""Evidence parsing (P12-P16), flows (J2), de-dup (ST2), roll-up (A13, P17),
reconcile (A15), the store (S12-S15) and the stream (ST1-ST4)."""

from __future__ import annotations

import gzip
import json
import os

from runledger.operators import evidence as evo
from runledger.operators.flows import classify_flow, read_flow_map
from runledger.sources import evidence_store as store
from runledger.streaming.evidence_stream import (
    EvidenceStreamConfig, make_batch_writer, run_until_done,
    start_evidence_stream)
from tests.conftest import rows

CLOCK = "2024-03-05 14:05:00"
ARN = "arn:aws:states:r:a:execution:machine-csv-ingest:x1"


def ev(batch, step, rows_in=None, rows_out=None, inserted=None, ok=True,
       ts="2024-03-05T14:01:45", **extra):
    e = {"batch_id": batch, "step": step, "ts": ts, "input": {},
         "output": {}, "load": {}}
    if ok is not None:
        e["ok"] = ok
    if rows_in is not None:
        e["input"]["rows"] = rows_in
    if rows_out is not None:
        e["output"]["rows"] = rows_out
    if inserted is not None:
        e["load"]["inserted_rows"] = inserted
    e.update(extra)
    return e


GLUE = "/aws-glue/jobs/output"
STATES = "/aws/states/machine-csv-ingest"


def _events(spark):
    data = [
        (GLUE, "1", "EVIDENCE " + json.dumps(
            {"evidence": ev("B1", "glue_convert", 10, 10)})),
        (GLUE, "2", "INFO EVIDENCE " + json.dumps(ev("B1", "glue_convert", 5,
                                                     5))),
        (GLUE, "3", 'EVIDENCE {"evidence": {"batch_id": '),
        (GLUE, "4", "plain log line"),
        (STATES, "5", json.dumps({"type": "TaskStateExited",
                                  "executionArn": ARN, "state": "Load",
                                  "input": {"evidence": ev(
                                      "B1", "redshift_load", inserted=20)}})),
        (STATES, "6", json.dumps({"type": "TaskStateExited",
                                  "executionArn": ARN, "state": "Pre",
                                  "output": {"evidence": ev(
                                      "B1", "prevalidate", ok=None)}})),
        (STATES, "7", json.dumps({"type": "ExecutionSucceeded",
                                  "executionArn": ARN,
                                  "evidence": ev("B1", "finalize",
                                                 inserted=20)})),
        (STATES, "8", json.dumps({"type": "ExecutionSucceeded",
                                  "executionArn": ARN})),
        (STATES, "12", json.dumps({"type": "ExecutionFailed",
                                   "executionArn": ARN,
                                   "input": {"batch_id": "B4"}})),
        (STATES, "9", json.dumps({"type": "TaskStateExited",
                                  "executionArn": "arn:other",
                                  "output": {"Payload": {"evidence": ev(
                                      "B2", "redshift_load", ok=False,
                                      error="copy failed")}}})),
        (STATES, "10", json.dumps({"type": "TaskStateExited",
                                   "executionArn": "arn:other",
                                   "evidence": ev("B2", "glue_convert", 0,
                                                  0)})),
        (STATES, "10", json.dumps({"type": "TaskStateExited",
                                   "executionArn": "arn:other",
                                   "evidence": ev("B2", "glue_convert", 0,
                                                  0)})),
        (GLUE, "11", "EVIDENCE " + json.dumps(ev("B3", "x", ok=False))),
    ]
    return spark.createDataFrame(data, "log_group string, event_id string, "
                                       "message string")


def _flow_map(spark, tmp_dir, patterns=None):
    patterns = patterns or {
        "machine-csv-ingest": "csv-to-parquet-pipeline",
        "machine-json-ingest": "json-to-dynamodb-pipeline"}
    os.makedirs(f"{tmp_dir}/fm", exist_ok=True)
    with open(f"{tmp_dir}/fm/flow_mapping.json", "w") as fh:
        json.dump({"flow_patterns": patterns}, fh)
    return read_flow_map(spark, f"{tmp_dir}/fm")


def test_parse_rules(spark, tmp_dir):
    parsed = evo.parse_log_events(_events(spark), _flow_map(spark, tmp_dir),
                                  CLOCK)
    got = {}
    for r in parsed.collect():
        got.setdefault(r.event_id, []).append(r)
    # marker not at the start, malformed JSON, plain line, no evidence
    assert set(got) == {"1", "5", "6", "7", "9", "10", "11", "12"}
    # a terminal event without evidence ends the batch named in its input
    assert got["12"][0].is_signal and got["12"][0].is_terminal
    assert got["12"][0].batch_id == "B4" and not got["7"][0].is_signal
    summary = {r.batch_id: r for r in
               evo.rollup(parsed, terminal_only=True).collect()}
    assert summary["B4"].steps == 0 and "B2" not in summary
    assert got["1"][0].input_rows == 10 and got["1"][0].source == "glue"
    assert got["5"][0].inserted_rows == 20 and got["5"][0].state_name == "Load"
    assert got["6"][0].ok is None                  # missing ok
    assert got["7"][0].is_terminal and not got["5"][0].is_terminal
    assert got["5"][0].flow == "csv-to-parquet-pipeline"
    assert got["9"][0].flow == "unknown-pipeline"
    assert got["9"][0].error == "copy failed"      # Payload searched last
    assert len(got["10"]) == 2                     # redelivered
    assert str(got["1"][0].ts) == "2024-03-05 14:01:45"
    dedup = evo.dedup_events(parsed)
    assert dedup.count() == parsed.count() - 1
    seen = {r.batch_id: r for r in evo.batches_seen(dedup).collect()}
    assert seen["B1"].terminal and not seen["B2"].terminal


def test_rollup_modes_and_reconcile(spark):
    data = [
        ev("B1", "prevalidate", ok=None),
        ev("B1", "glue_convert", 10, 10, ts="2024-03-05T14:01:45"),
        ev("B1", "redshift_load", 10, 20, inserted=20,
           ts="2024-03-05T14:02:30"),
        ev("B1", "finalize", inserted=20, ts="2024-03-05T14:02:54",
           is_terminal=True),
        ev("B2", "glue_convert", 0, 0),
        ev("B2", "redshift_load", ok=False),
    ]
    events = spark.createDataFrame(
        [(GLUE, str(i), "EVIDENCE " + json.dumps(e))
         for i, e in enumerate(data)],
        "log_group string, event_id string, message string")
    parsed = evo.parse_log_events(events, None, CLOCK)
    by_step = {r.batch_id: r for r in evo.rollup(parsed).collect()}
    b1 = by_step["B1"]
    assert (b1.input_files, b1.input_rows, b1.output_files, b1.output_rows,
            b1.redshift_loaded, b1.failures, b1.status) == (
        1, 10, 1, 10, 20, 0, "OK")
    assert str(b1.started) == "2024-03-05 14:01:45"
    assert str(b1.ended) == "2024-03-05 14:02:54"
    b2 = by_step["B2"]   # zero rows count nowhere
    assert (b2.input_files, b2.input_rows, b2.failures, b2.status) == (
        0, 0, 1, "ERROR")
    all_steps = {r.batch_id: r for r in
                 evo.rollup(parsed, "all_steps").collect()}
    assert (all_steps["B1"].input_rows, all_steps["B1"].output_rows,
            all_steps["B1"].redshift_loaded) == (20, 30, 40)
    assert [r.batch_id for r in
            evo.rollup(parsed, terminal_only=True).collect()] == ["B1"]
    checks = {(r.batch_id, r.check_name): r
              for r in evo.reconcile(evo.rollup(parsed)).collect()}
    loaded = checks[("B1", "loaded_vs_out")]
    # 10 out, 20 loaded: strict fails, lenient passes
    assert (loaded.passed, loaded.passed_lenient, loaded.difference) == (
        False, True, -10)
    assert checks[("B2", "inputs_present")].passed is False
    fails = evo.failures(parsed).collect()
    assert [(f.batch_id, f.error) for f in fails] == [("B2", "Unknown error")]


def test_flow_map_of_any_size(spark):
    """First pattern in map order, against a plain loop: short, empty and
    repeated patterns, equal order, null flows and null values."""
    rules = [(3, "abc", "first"), (4, "b", "second"), (5, "zz", None),
             (5, "zq", "tie"), (9, "abcd", "late"), (0, "never", "x")]
    rules += [(100 + k, f"p{k}", f"f{k}") for k in range(1200)]
    vals = ["xabcx", "b", "nothing", None, "zz", "zzq", "zqz", "abcd", "",
            "p7", "xp1199", "p1", "ZZ"] * 3
    for extra in ([], [(50, "", "any")], [(1, "", None)]):
        fm = spark.createDataFrame(rules + extra,
                                   "ord int, pattern string, flow string")
        df = spark.createDataFrame([(v,) for v in vals], "v string") \
            .repartition("v")
        want = []
        for v in vals:
            hits = sorted(r[:2] for r in rules + extra
                          if v is not None and r[1] in v)
            flow = "unknown-pipeline" if not hits else next(
                r[2] for r in rules + extra if r[:2] == hits[0])
            want.append((v, flow))
        got = [(r.v, r.flow) for r in classify_flow(df, "v", fm).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def _write_envelopes(path, name, events, timestamp=None):
    os.makedirs(path, exist_ok=True)
    env = {"messageType": "DATA_MESSAGE", "logGroup": GLUE,
           "logEvents": [{"id": i, "message": m, "timestamp": timestamp}
                         for i, m in events]}
    with gzip.open(f"{path}/{name}.json.gz", "wt") as fh:
        fh.write(json.dumps(env) + "\n")


def test_store_roundtrip(spark, tmp_dir):
    _write_envelopes(f"{tmp_dir}/in", "a", [
        ("1", "EVIDENCE " + json.dumps(ev("B1", "glue_convert", 3, 3))),
        ("1", "EVIDENCE " + json.dumps(ev("B1", "glue_convert", 3, 3))),
        ("2", "EVIDENCE " + json.dumps(ev("B2", "glue_convert", 4, 4)))])
    events = evo.explode_envelopes(store.read_envelopes(spark,
                                                        f"{tmp_dir}/in"))
    parsed = evo.parse_log_events(events, None, CLOCK)
    store.append_evidence(parsed, f"{tmp_dir}/st")
    store.append_evidence(parsed, f"{tmp_dir}/st")     # at-least-once replay
    assert store.read_evidence(spark, f"{tmp_dir}/st").count() == 2
    one = spark.createDataFrame([("B2",)], "batch_id string")
    got = store.read_evidence(spark, f"{tmp_dir}/st", batches=one).collect()
    assert [r.batch_id for r in got] == ["B2"]
    store.archive_raw(spark, f"{tmp_dir}/in", f"{tmp_dir}/raw")
    assert spark.read.text(f"{tmp_dir}/raw").count() == 1


def test_stream_equals_batch_and_replay(spark, tmp_dir):
    land = f"{tmp_dir}/land"
    _write_envelopes(land, "1", [
        ("1", "EVIDENCE " + json.dumps(ev("B1", "glue_convert", 10, 10))),
        ("2", "EVIDENCE " + json.dumps(ev("B2", "glue_convert", 7, 7)))])
    _write_envelopes(land, "2", [
        ("3", "EVIDENCE " + json.dumps(ev("B1", "finalize", is_terminal=True,
                                          ts="2024-03-05T15:00:00")))])
    _write_envelopes(land, "3", [   # late evidence after the terminal event
        ("4", "EVIDENCE " + json.dumps(ev("B1", "redshift_load",
                                          inserted=10))),
        ("1", "EVIDENCE " + json.dumps(ev("B1", "glue_convert", 10, 10)))])
    cfg = EvidenceStreamConfig(
        landing=land, store=f"{tmp_dir}/st", summaries=f"{tmp_dir}/sum",
        checkpoint=f"{tmp_dir}/ck", ingested_at=CLOCK,
        max_files_per_trigger=1, raw_archive=f"{tmp_dir}/raw",
        rocksdb_state=True)
    many = spark.range(300).selectExpr(
        "id as ord", "concat('m', id) as pattern", "'f' as flow")
    run_until_done(start_evidence_stream(spark, cfg, many))
    streamed = store.read_summaries(spark, cfg.summaries)
    all_events = evo.parse_log_events(
        evo.explode_envelopes(store.read_envelopes(spark, land)), None,
        CLOCK).transform(evo.dedup_events)
    batch = evo.rollup(all_events, terminal_only=True)
    cols = list(batch.columns)
    assert rows(streamed.select(*cols)) == rows(batch)
    got = streamed.collect()
    assert [r.batch_id for r in got] == ["B1"]     # B2 never terminated
    assert got[0].redshift_loaded == 10            # late evidence included
    assert got[0].input_rows == 10                 # redelivery not counted
    assert spark.read.text(f"{tmp_dir}/raw").count() == 3
    steps = store.read_details(spark, cfg.details).collect()
    assert sorted(r.step for r in steps) == [
        "finalize", "glue_convert", "redshift_load"]


def test_stream_ids_corrections_and_new_checkpoint(spark, tmp_dir):
    """Ids that look like numbers stay apart; the latest delivery wins; a
    second checkpoint over the same store loses nothing."""
    land = f"{tmp_dir}/land"

    def line(batch, step, *a, **k):
        return "EVIDENCE " + json.dumps(ev(batch, step, *a, **k))

    hour = 3_600_000
    _write_envelopes(land, "1", [
        ("1", line("007", "glue_convert", 5, 5, ok=False, error="bad")),
        ("2", line("007", "finalize", is_terminal=True)),
        ("1", line("7", "glue_convert", 3, 3)),
        ("2", line("7", "finalize", is_terminal=True)),
        ("1", line("2024-01-01", "finalize", is_terminal=True)),
        ("9", line(None, "glue_convert", 1, 1))], timestamp=hour)
    _write_envelopes(land, "2", [
        ("1", line("007", "glue_convert", 9, 9))], timestamp=2 * hour)
    _write_envelopes(land, "3", [     # delivered before, arrives after
        ("1", line("7", "glue_convert", 1, 1))], timestamp=hour // 2)
    cfg = EvidenceStreamConfig(
        landing=land, store=f"{tmp_dir}/st", summaries=f"{tmp_dir}/sum",
        checkpoint=f"{tmp_dir}/ck", ingested_at=CLOCK,
        max_files_per_trigger=1)
    run_until_done(start_evidence_stream(spark, cfg))

    def check():
        got = {r.batch_id: r for r in
               store.read_summaries(spark, cfg.summaries).collect()}
        assert set(got) == {"007", "7", "2024-01-01"}
        assert (got["007"].input_rows, got["007"].failures,
                got["007"].steps) == (9, 0, 2)
        assert (got["7"].input_rows, got["7"].steps) == (3, 2)
    check()
    ids = {r.batch_id for r in store.read_evidence(spark, cfg.store)
           .collect()}
    assert ids == {"007", "7", "2024-01-01", "B3600"}
    cfg.checkpoint = f"{tmp_dir}/ck2"
    run_until_done(start_evidence_stream(spark, cfg))
    check()


def test_foreach_batch_replay_is_idempotent(spark, tmp_dir):
    def events(*evs):
        df = spark.createDataFrame(
            [(GLUE, str(i), "EVIDENCE " + json.dumps(e)) for i, e in evs],
            "log_group string, event_id string, message string")
        return evo.parse_log_events(df, None, CLOCK)
    first = events((1, ev("B1", "glue_convert", 4, 4)))
    second = events((2, ev("B1", "finalize", is_terminal=True)),
                    (3, ev("B1", "redshift_load", inserted=4)))
    cfg = EvidenceStreamConfig(
        landing="unused", store=f"{tmp_dir}/st", summaries=f"{tmp_dir}/sum",
        checkpoint=f"{tmp_dir}/ck", ingested_at=CLOCK)
    process = make_batch_writer(spark, cfg)
    process(first, 0)
    # not terminated yet: no summary
    assert store.read_summaries(spark, cfg.summaries).count() == 0
    process(second, 1)
    once = rows(store.read_summaries(spark, cfg.summaries))
    process(second, 1)                             # the epoch re-runs
    assert rows(store.read_summaries(spark, cfg.summaries)) == once
    expected = evo.rollup(first.unionByName(second), terminal_only=True)
    assert rows(store.read_summaries(spark, cfg.summaries)
                .select(*expected.columns)) == rows(expected)


def test_type_mismatch_keeps_other_fields(spark):
    bad_rows = ev("B9", "glue_convert", ok=True)
    bad_rows["input"]["rows"] = "ten"               # not a number
    events = spark.createDataFrame(
        [(GLUE, "1", "EVIDENCE " + json.dumps(bad_rows)),
         (GLUE, "2", 'EVIDENCE {"batch_id": "B9", "step": ')],
        "log_group string, event_id string, message string")
    got = evo.parse_log_events(events, None, CLOCK).collect()
    assert len(got) == 1                            # malformed one dropped
    assert (got[0].batch_id, got[0].step, got[0].input_rows) == (
        "B9", "glue_convert", None)


def test_semi_join_restriction_matches_terminal_rollup(spark):
    parsed = evo.parse_log_events(_events(spark), None, CLOCK)
    dedup = evo.dedup_events(parsed)
    via_join = evo.rollup(evo.restrict_to(dedup,
                                          evo.terminal_batches(dedup)))
    assert rows(via_join) == rows(evo.rollup(dedup, terminal_only=True))


def test_missing_batch_id_and_routing(spark):
    no_batch = ev(None, "glue_convert", 1, 1)
    del no_batch["batch_id"]
    state_like = json.dumps({"type": "ExecutionSucceeded",
                             "evidence": ev("B7", "finalize")})
    events = spark.createDataFrame(
        [(GLUE, "1", "EVIDENCE " + json.dumps(no_batch)),
         (GLUE, "2", state_like)],              # not a state-machine group
        "log_group string, event_id string, message string")
    got = evo.parse_log_events(events, None, CLOCK).collect()
    assert [(r.event_id, r.batch_id) for r in got] == [("1", "B1709647500")]
