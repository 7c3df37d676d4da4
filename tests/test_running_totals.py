"""Running totals against the batch roll-up, delivery by delivery."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from runledger.operators import evidence as evo
from runledger.sources import evidence_store as store
from runledger.streaming import running_totals as running
from runledger.streaming.evidence_stream import (
    EvidenceStreamConfig, make_batch_writer, run_until_done,
    start_evidence_stream)

from .conftest import rows
from .test_evidence import CLOCK, _write_envelopes, ev

STEPS = ["glue_convert", "redshift_load", "prevalidate", None, "finalize"]


def deliveries(seed, files, per_file):
    """Per file a time of delivery and events; ids come again with other
    rows, times and outcomes, also earlier ones that arrive later."""
    rng = random.Random(seed)
    out, text = [], []
    for k in range(files):
        part = []
        for _ in range(per_file):
            if text and rng.random() < 0.15:
                part.append(rng.choice(text))           # a literal repeat
                continue
            batch = f"0{rng.randint(1, 5)}"
            step = rng.choice(STEPS)
            e = ev(batch, step, rng.randint(0, 9), rng.randint(0, 9),
                   inserted=rng.randint(0, 9), ok=rng.random() < 0.7,
                   is_terminal=step == "finalize" and rng.random() < 0.6,
                   ts=f"2024-03-{rng.randint(1, 28):02d}T10:00:00")
            part.append((str(rng.randint(0, 6)),
                         "EVIDENCE " + json.dumps(e)))
        text += part
        out.append((3_600_000 * rng.randint(1, 4 * files), part))
    return out


def land(folder, parts, first=0):
    for k, (at, part) in enumerate(parts):
        _write_envelopes(folder, f"{first + k:03d}", part, timestamp=at)


def parsed(spark, folder):
    return evo.parse_log_events(evo.explode_envelopes(
        store.read_envelopes(spark, folder)), None, CLOCK)


def check(spark, cfg):
    everything = evo.dedup_events(parsed(spark, cfg.landing))
    want = evo.rollup(everything, terminal_only=True)
    assert rows(store.read_summaries(spark, cfg.summaries).select(
        *want.columns)) == rows(want)
    steps = evo.restrict_to(evo.step_details(everything),
                            want.select("batch_id"))
    steps = steps.withColumn("event_id", F.coalesce("event_id", F.lit("")))
    assert rows(store.read_details(spark, cfg.details), *steps.columns) == \
        rows(steps)


def config(tmp_dir, **more):
    return EvidenceStreamConfig(
        landing=f"{tmp_dir}/land", store=f"{tmp_dir}/st",
        summaries=f"{tmp_dir}/sum", checkpoint=f"{tmp_dir}/ck",
        ingested_at=CLOCK, max_files_per_trigger=1, **more)


def test_corrected_late_and_repeated_deliveries(spark, tmp_dir):
    """Five files, then more to the same checkpoint, then a new one."""
    parts = deliveries(3, 6, 25)
    cfg = config(tmp_dir)
    land(cfg.landing, parts[:4])
    run_until_done(start_evidence_stream(spark, cfg))
    check(spark, cfg)
    land(cfg.landing, parts[4:5], 4)
    run_until_done(start_evidence_stream(spark, cfg))
    check(spark, cfg)
    land(cfg.landing, parts[5:], 5)
    cfg.checkpoint = f"{tmp_dir}/ck2"
    run_until_done(start_evidence_stream(spark, cfg))
    check(spark, cfg)
    totals = running.read_totals(spark, cfg.totals)
    assert {r.generation for r in totals.collect()} == {0}


def test_memory_shorter_than_the_run(spark, tmp_dir):
    """With no memory at all, every event of a known batch is looked up."""
    cfg = config(tmp_dir, watermark="0 seconds")
    land(cfg.landing, deliveries(8, 4, 20))
    run_until_done(start_evidence_stream(spark, cfg))
    check(spark, cfg)


@pytest.fixture()
def counted_reads(monkeypatch):
    calls = []
    read = store.read_evidence

    def counted(*args, **kwargs):
        calls.append(kwargs.get("before"))
        return read(*args, **kwargs)

    monkeypatch.setattr(store, "read_evidence", counted)
    return calls


def test_history_is_read_for_corrected_events_only(spark, tmp_dir,
                                                   counted_reads):
    cfg = config(tmp_dir)
    process = make_batch_writer(spark, cfg)

    def delivered(epoch, at, *events):
        df = spark.createDataFrame(
            [("/aws-glue/jobs/output", i, "EVIDENCE " + json.dumps(e), at)
             for i, e in events],
            "log_group string, event_id string, message string, at long")
        new = evo.parse_log_events(df.withColumn(
            "delivered_at", F.timestamp_millis("at")), None, CLOCK).drop(
            "flow")
        marks = new.select(*evo.EVENT_KEY)
        seen = {tuple(r) for r in known}
        first = [tuple(r) for r in marks.distinct().collect()
                 if tuple(r) not in seen]
        known.extend(first)
        marks = new.where(F.concat_ws("|", "step", "event_id").isin(
            [f"{s}|{i}" for _, s, i in first])).select([
                F.col(c) if c in evo.EVENT_KEY else F.lit(None).cast(
                    new.schema[c].dataType).alias(c) for c in new.columns])
        process(new.withColumn("first_seen_event", F.lit(False)).unionByName(
            marks.withColumn("first_seen_event", F.lit(True))), epoch)

    def summary():
        return [(r.input_rows, r.steps, r.failures, str(r.started)[:10],
                 str(r.ended)[:10]) for r in store.read_summaries(
                     spark, cfg.summaries).collect()]

    known: list = []
    hour = 3_600_000
    delivered(0, 3 * hour, ("1", ev("B", "glue_convert", 5, 5,
                                    ts="2024-03-02T00:00:00")))
    delivered(1, 3 * hour, ("2", ev("B", "finalize", is_terminal=True,
                                    ts="2024-03-09T00:00:00")),
              ("3", ev("B", "prevalidate", ok=False,
                       ts="2024-03-05T00:00:00")))
    assert counted_reads == []           # nothing had been counted before
    assert summary() == [(5, 3, 1, "2024-03-02", "2024-03-09")]
    # A correction inside the batch's times: one read, of the old delivery.
    delivered(2, 4 * hour, ("3", ev("B", "prevalidate",
                                    ts="2024-03-06T00:00:00")))
    assert len(counted_reads) == 1
    assert summary() == [(5, 3, 0, "2024-03-02", "2024-03-09")]
    # The first time is taken back: the batch's times are read once more.
    delivered(3, 4 * hour, ("1", ev("B", "glue_convert", 7, 7,
                                    ts="2024-03-04T00:00:00")))
    assert len(counted_reads) == 3
    assert summary() == [(7, 3, 0, "2024-03-04", "2024-03-09")]
    # Delivered before, arrives after: it changes nothing; nor does a replay.
    delivered(4, 2 * hour, ("1", ev("B", "glue_convert", 1, 1,
                                    ts="2024-03-01T00:00:00")))
    delivered(4, 2 * hour, ("1", ev("B", "glue_convert", 1, 1,
                                    ts="2024-03-01T00:00:00")))
    assert summary() == [(7, 3, 0, "2024-03-04", "2024-03-09")]
