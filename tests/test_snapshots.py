"""Compaction in one step, under readers and other writers."""

from __future__ import annotations

import os

from runledger.sources import evidence_store as store
from runledger.sources import snapshots as sn
from runledger.streaming.evidence_stream import (
    make_batch_writer, run_until_done, start_evidence_stream)

from .conftest import rows
from .test_running_totals import check, config, deliveries, land, parsed

SCHEMA = "id long, bucket int"


def part(spark, *ids):
    return spark.createDataFrame([(i, i % 3) for i in ids], SCHEMA)


def files(path):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(path)
               for n in names)


def ids(df):
    return [r[0] for r in rows(df, "id")]


def test_hundred_appends_end_in_few_files(spark, tmp_dir):
    for k in range(100):
        sn.append(part(spark, k).coalesce(1), tmp_dir, "bucket")
        if k % 20 == 19:
            assert sn.compact(spark, tmp_dir, "bucket", schema=SCHEMA) == (
                20 if k == 19 else 21)
            sn.vacuum(spark, tmp_dir, 0)
    assert sorted(ids(sn.read(spark, tmp_dir, SCHEMA))) == sorted(range(100))
    assert len(sn.live_parts(spark, tmp_dir)) == 1
    assert files(f"{tmp_dir}/data") <= 3 * 2 and files(f"{tmp_dir}/log") == 1
    assert sn.compact(spark, tmp_dir, "bucket", schema=SCHEMA) == 0


def test_reader_sees_one_state(spark, tmp_dir):
    assert ids(sn.read(spark, tmp_dir, SCHEMA)) == []
    for k in (1, 2, 3):
        sn.append(part(spark, k), tmp_dir, "bucket")
    before = sn.read(spark, tmp_dir, SCHEMA)

    def fold(df):
        # In the midst of a compaction: an append, and other readers.
        sn.append(part(spark, 9), tmp_dir, "bucket")
        assert ids(sn.read(spark, tmp_dir, SCHEMA)) == [1, 2, 3, 9]
        return df.where("id <> 2")

    assert sn.compact(spark, tmp_dir, "bucket", fold, schema=SCHEMA) == 3
    assert ids(before) == [1, 2, 3]
    assert ids(sn.read(spark, tmp_dir, SCHEMA)) == [1, 3, 9]
    assert sn.vacuum(spark, tmp_dir) == 0           # not replaced long ago
    assert ids(before) == [1, 2, 3]
    assert sn.vacuum(spark, tmp_dir, 0) == 3
    assert ids(sn.read(spark, tmp_dir, SCHEMA)) == [1, 3, 9]


def test_two_compactions_at_once_and_a_lost_one(spark, tmp_dir):
    for k in (1, 2, 3):
        sn.append(part(spark, k), tmp_dir, "bucket")

    def other(df):
        assert sn.compact(spark, tmp_dir, "bucket", schema=SCHEMA) == 3
        return df

    sn.compact(spark, tmp_dir, "bucket", other, schema=SCHEMA)
    assert ids(sn.read(spark, tmp_dir, SCHEMA)) == [1, 2, 3]

    def lost(df):
        raise KeyError

    sn.append(part(spark, 4), tmp_dir, "bucket")
    try:
        sn.compact(spark, tmp_dir, "bucket", lost, schema=SCHEMA)
    except KeyError:
        pass
    # A part without an entry, as a run leaves it that ends before.
    sn._write(part(spark, 5), tmp_dir, "bucket")
    assert ids(sn.read(spark, tmp_dir, SCHEMA)) == [1, 2, 3, 4]
    sn.vacuum(spark, tmp_dir, 0)
    assert ids(sn.read(spark, tmp_dir, SCHEMA)) == [1, 2, 3, 4]


def test_full_parts_are_left(spark, tmp_dir):
    sn.append(part(spark, *range(3000)), tmp_dir, "bucket")
    size = max(sn.part_sizes(spark, tmp_dir).values())
    for k in (5001, 5002):
        sn.append(part(spark, k), tmp_dir, "bucket")
    first = sn.live_parts(spark, tmp_dir)[0]
    assert sn.compact(spark, tmp_dir, "bucket", full_bytes=size,
                      schema=SCHEMA) == 2
    assert first in sn.live_parts(spark, tmp_dir)
    assert sn.read(spark, tmp_dir, SCHEMA).count() == 3002


def test_stream_with_compaction(spark, tmp_dir):
    cfg = config(tmp_dir, compact_every=2, retain=0)
    land(cfg.landing, deliveries(11, 5, 15))
    run_until_done(start_evidence_stream(spark, cfg))
    check(spark, cfg)
    for path in (cfg.store, cfg.totals, cfg.summaries, cfg.details):
        # The packed one, and what came after the last compaction.
        live = sn.live_parts(spark, path)
        assert len(live) <= 2
        assert {d for d in os.listdir(f"{path}/data") if "=" in d} == {
            f"{sn.PART}={p}" for p in live}
    # An epoch that is run again after its compaction changes nothing.
    process = make_batch_writer(spark, config(
        tmp_dir + "/x", compact_every=1))
    cfg = config(tmp_dir + "/x")
    land(cfg.landing, deliveries(12, 1, 30))
    events = parsed(spark, cfg.landing).drop("flow")
    one, two = events.where("event_id < '3'"), events.where("event_id >= '3'")
    for epoch, df in ((0, one), (1, two), (1, two)):
        process(df, epoch)
    check(spark, cfg)
    versions = store.read_rows(spark, cfg.totals,
                               "batch_id string, version bigint").distinct()
    assert versions.count() <= 2 * 5      # of five batches, this and one more
