"""What the evidence queries carry, shuffle and write for each event."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from runledger import session
from runledger.operators import evidence as evo
from runledger.plans import evidence_queries as eq
from runledger.session import new_run_dir
from runledger.sources import evidence_store as store
from runledger.sources import snapshots
from runledger.streaming.evidence_stream import (
    STATE_KEY, EvidenceStreamConfig, evidence_events, run_until_done,
    start_evidence_stream, with_state_key)

from .conftest import rows
from .test_evidence import _write_envelopes
from .test_scale import plan


@pytest.fixture()
def items_dir(spark, tmp_dir):
    """400 line items; order 7 has most of them, some keys are null."""
    i = F.col("id")
    spark.range(400).select(
        F.when(i % 3 == 0, i).when(i % 50 != 1, 7).alias("l_orderkey"),
        (i % 11).alias("l_partkey"),
        F.when(i % 40 != 3, i % 5).alias("l_suppkey"),
        (i % 7 + 1).cast("int").alias("l_linenumber"),
        (i % 9 * 1.0).alias("l_quantity"),
        F.element_at(F.array(*map(F.lit, "RAN")), (i % 3 + 1).cast("int"))
        .alias("l_returnflag"),
        F.when(i % 30 != 5, F.when(i % 2 == 0, "F").otherwise("O"))
        .alias("l_linestatus"),
        F.expr("timestamp_ntz'1994-01-01 00:00:00' "
               "+ make_dt_interval(cast(id * 5 as int))")
        .alias("l_shipdate")).write.parquet(f"{tmp_dir}/lineitem.parquet")
    return tmp_dir


def test_compaction_leaves_full_parts(spark, items_dir, monkeypatch):
    want = rows(eq.evidence_rollup(spark, items_dir), *eq.SUMMARY_COLUMNS)
    monkeypatch.setattr(snapshots, "FULL_BYTES", 1)   # every part is full
    assert rows(eq.evidence_compaction(spark, items_dir)) == want


def test_shares_of_the_deliveries(spark, items_dir):
    """Together they are all events, and equal events are in one share."""
    cols = ["log_group", "event_id", "message", "delivered_at"]
    want = rows(eq._lineitem_events(spark, items_dir), *cols)
    shares = [rows(eq._lineitem_events(spark, items_dir, (k, 4)), *cols)
              for k in range(4)]
    assert sorted(sum(shares, []), key=str) == sorted(want, key=str)
    assert all(shares)
    assert sum(len(set(s)) for s in shares) == len(set(want))


def test_compaction_keeps_messages_in_the_store_only(spark, items_dir,
                                                     monkeypatch):
    kinds = []
    monkeypatch.setattr(eq, "new_run_dir", lambda spark, kind: kinds.append(
        kind) or new_run_dir(spark, kind))
    monkeypatch.setattr(session, "new_run_dir", eq.new_run_dir)
    assert eq.evidence_compaction(spark, items_dir).count()
    assert kinds == ["compaction"]


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get() \
        .blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n")
            if "shuffle_" in f}


def test_shuffle_files_go_with_their_write(spark, tmp_dir):
    before = shuffle_files(spark)
    some = spark.range(1000).selectExpr("id", "id % 3 as bucket")
    snapshots.append(some, f"{tmp_dir}/t", "bucket")
    session.materialized(some.groupBy("bucket").count(), "test")
    for _ in range(100):            # they go in the background
        if shuffle_files(spark) <= before:
            return
        time.sleep(0.1)
    raise AssertionError(shuffle_files(spark) - before)


def test_only_wanted_fields_are_decoded(spark, items_dir):
    events = eq._lineitem_events(spark, items_dir)
    whole = evo.parse_log_events(events, None, eq.CLOCK)
    cols = ["batch_id", "step", "event_id", "ok", "input_rows", "is_terminal",
            "event_hash", "is_signal"]
    narrow = evo.parse_log_events(events, None, eq.CLOCK, cols)
    assert narrow.columns == cols and rows(narrow) == rows(whole, *cols)
    stored = evo.parse_log_events(events, None, eq.CLOCK, evo.STORED)
    assert rows(stored) == rows(whole, *evo.STORED)
    text = plan(eq.evidence_rollup(spark, items_dir))
    assert "total_size_bytes" in plan(whole)
    assert "total_size_bytes" not in text and "crawler" not in text


def test_odd_records_decode_alike(spark):
    record = {"batch_id": "1", "step": "s", "input": {"rows": 3, "files": 4},
              "output": {"rows": "x", "s3": "p"}, "note": "n"}
    bodies = [json.dumps(record), json.dumps({"evidence": record}),
              json.dumps({"evidence": {}, "note": [1]}),
              json.dumps({**record, "input": {"rows": 3, "files": "many"}}),
              json.dumps({**record, "note": {"a": 1}, "load": "none"}),
              json.dumps(record)[:-1], json.dumps(record)[:30], "[]", "{", "",
              json.dumps({**record, "dataset": 1, "ok": "maybe"}),
              '{"batch_id":"2","input":{"dataset":"a\nb"}}', '{"evidence":7}']
    texts = ["EVIDENCE " + b for b in bodies] + [
        json.dumps({"type": "ExecutionFailed", "input": {"batch_id": "9"}})] + [
        f'{{"type":"T","{at}":{{"evidence":{b}}}}}' for b in bodies
        for at in ("input", "output")]
    events = spark.createDataFrame(
        [("/aws/states/m" if k % 2 else "/g", str(k), t)
         for t in texts for k in (0, 1)],
        "log_group string, event_id string, message string")
    whole = evo.parse_log_events(events, None, eq.CLOCK)
    for cols in (evo.ROLLUP_INPUT, ["batch_id", "event_id"], ["ok"]):
        assert rows(evo.parse_log_events(events, None, eq.CLOCK, cols)) == \
            rows(whole, *cols)


def test_messages_are_made_after_the_shuffle(spark, items_dir, tmp_dir,
                                             monkeypatch):
    monkeypatch.setattr(eq, "PIECE_ITEMS", 50)
    assert eq._lineitem_events(spark, items_dir).rdd.getNumPartitions() >= 8
    monkeypatch.setattr(eq, "STRETCH", 16)
    want = eq._lineitem_events(spark, items_dir)
    for by_year in (False, True):
        path = f"{tmp_dir}/landing{by_year}"
        eq.write_envelopes(spark, items_dir, path, by_year)
        env = store.read_envelopes(spark, path + ("/*" if by_year else ""))
        got = evo.explode_envelopes(env)
        cols = ["log_group", "event_id", "message"]
        assert rows(got, *cols) == rows(want, *cols)
        assert env.select(F.max(F.size("logEvents"))).first()[0] <= 32


def test_append_without_gathering(spark, items_dir, tmp_dir):
    parsed = evo.parse_log_events(eq._lineitem_events(spark, items_dir), None,
                                  eq.CLOCK, evo.STORED)
    for name, gather in (("a", True), ("b", False)):
        store.append_evidence(parsed, f"{tmp_dir}/{name}", gather=gather)
    got = [rows(store.read_evidence(spark, f"{tmp_dir}/{n}", dedup=False),
                *evo.STORED) for n in "ab"]
    assert got[0] == got[1] and len(got[0]) > 300


def test_stream_carries_no_nested_record(spark, items_dir, tmp_dir):
    eq.write_envelopes(spark, items_dir, f"{tmp_dir}/landing")
    events = evidence_events(store.read_envelopes(
        spark, f"{tmp_dir}/landing"), eq.CLOCK)
    assert "evidence" not in events.columns


def test_stream_keeps_keys_out_of_the_heap(spark, tmp_dir, monkeypatch):
    """Its state is in RocksDB, without texts; a literal repeat in a later
    micro-batch is dropped, and what an epoch wrote for itself goes with it."""
    record = json.dumps({"batch_id": "1", "step": "s", "is_terminal": True,
                         "input": {"rows": 3}})
    for k in range(2):
        _write_envelopes(f"{tmp_dir}/land", str(k),
                         [("7", "EVIDENCE " + record)])
    cfg = EvidenceStreamConfig(
        landing=f"{tmp_dir}/land", store=f"{tmp_dir}/st",
        summaries=f"{tmp_dir}/sum", checkpoint=f"{tmp_dir}/ck",
        ingested_at=eq.CLOCK, max_files_per_trigger=1)

    written = []

    def noted(spark, kind):
        written.append(new_run_dir(spark, kind))
        return written[-1]

    monkeypatch.setattr(session, "new_run_dir", noted)
    run_until_done(start_evidence_stream(spark, cfg))
    assert len(written) > 4
    assert not any(os.path.exists(p.removeprefix("file:")) for p in written)
    state = f"{tmp_dir}/ck/state/0/0"
    assert any(n.endswith(".zip") for n in os.listdir(state))
    assert not any(n.endswith(".delta") for n in os.listdir(state))
    assert store.read_evidence(spark, cfg.store, dedup=False).count() == 1


def test_state_keys(spark):
    """Those of an event, its repeat, another text, its mark, and others."""
    some = [("b", "s", "e", 1, False), ("b", "s", "e", 1, False),
            ("b", "s", "e", 2, False), ("b", "s", "e", None, True),
            ("b", "s", "f", None, True), ("bs", "", "e", 1, False),
            ("b", "", "se", 1, False)]
    got = with_state_key(spark.createDataFrame(
        some, "batch_id string, step string, event_id string, "
              "event_hash long, first_seen_event boolean"))
    assert [d for _, d in got.select(*STATE_KEY).dtypes] == ["bigint"] * 2
    for key in ([c] for c in STATE_KEY):
        found = [r[0] for r in got.select(*key).collect()]
        assert found[0] == found[1] and len(set(found)) == 6


def test_texts_are_not_carried_beyond_the_parse(spark, items_dir):
    """Only their parsed fields go on, without those of the state log that
    no column needs."""
    text = plan(eq.evidence_rollup(spark, items_dir))
    decoded = next(n for n in text.split("\n") if "from_json(" in n)
    carried = decoded.split("from_json(")[0]
    assert "_body" not in carried and "_msg" not in carried
    assert "executionArn" not in decoded and "(type," in decoded
    assert "Contains(message" not in text


def test_flagged_texts(spark):
    """A text that is an object with a wrong value is kept, others not; a
    column named like the state log's own texts takes part or not."""
    texts = ['{"type":"T","executionArn":{"a":1},"state":[2],"evidence":'
             '{"batch_id":"b%d","step":"s","input":{"rows":%s}}%s' % (k, r, e)
             for k, (r, e) in enumerate([
                 ("1", "}"), ('"x"', "}"), ("1", ""), ('"x"', ""),
                 ("1", "}}")])]
    events = spark.createDataFrame(
        [("/aws/states/m", str(k), t) for k, t in enumerate(
            texts + [f"EVIDENCE {t}" for t in texts])],
        "log_group string, event_id string, message string")
    whole = evo.parse_log_events(events, None, eq.CLOCK)
    cols = ["batch_id", "event_id", "source", "input_rows", "raw_message"]
    assert {"0", "1"} <= {r.event_id for r in whole.collect()}
    for more in ([], ["execution_arn"], ["state_name"], ["event_type"]):
        assert rows(evo.parse_log_events(
            events, None, eq.CLOCK, cols + more)) == rows(whole, *cols, *more)
