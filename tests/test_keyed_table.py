"""Puts by bucket against a plain dictionary."""

from __future__ import annotations

import os
import random

import pytest

from runledger.sources import keyed_table as kt

SCHEMA = "id string, v long, at long"


def rows(spark, path):
    got = [tuple(r) for r in kt.read(spark, path, SCHEMA).collect()]
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r[1:] for r in got}


def test_puts_equal_a_dictionary(spark, tmp_dir):
    rng = random.Random(1)
    assert rows(spark, tmp_dir) == {}
    want = {}
    for k in range(5):
        data = [(rng.choice([None, "", *"abcdefghij"]), rng.randint(0, 99),
                 10 * k + j) for j in range(12 if k else 40)]
        rng.shuffle(data)
        kt.put(spark.createDataFrame(data, SCHEMA), tmp_dir, SCHEMA, ["id"],
               ["at"], 8)
        for i, v, at in sorted(data, key=lambda r: r[2]):
            want[i] = (v, at)
        assert rows(spark, tmp_dir) == want
    empty = spark.createDataFrame([], SCHEMA)
    assert kt.put(empty, tmp_dir, SCHEMA, ["id"], ["at"]) == set()
    assert rows(spark, tmp_dir) == want


def test_one_key_rewrites_one_bucket(spark, tmp_dir):
    base = spark.range(2000).selectExpr(
        "cast(id as string) as id", "id as v", "0L as at")
    assert kt.put(base, tmp_dir, SCHEMA, ["id"], ["at"], 16) == set(range(16))
    before = kt.bucket_parts(spark, tmp_dir)
    pinned = kt.read(spark, tmp_dir, SCHEMA)
    one = spark.createDataFrame([("77", -1, 1), ("77", -2, 2)], SCHEMA)
    touched = kt.put(one, tmp_dir, SCHEMA, ["id"], ["at"], 999)
    after = kt.bucket_parts(spark, tmp_dir)
    assert len(touched) == 1
    assert {b for b in after if after[b] != before[b]} == touched
    new = after[touched.pop()]
    folders = [d for d in os.listdir(f"{tmp_dir}/data/_part={new}")
               if "=" in d]
    assert len(folders) == 1
    # Only the files of the touched bucket are in the put's plan.
    read = kt.read(spark, tmp_dir, SCHEMA, {0})
    assert all("_bucket=0/" in f for f in read.inputFiles())
    assert rows(spark, tmp_dir)["77"] == (-2, 2)
    assert pinned.where("id = '77'").first()["v"] == 77


def test_concurrent_puts(spark, tmp_dir, monkeypatch):
    """A put that finds its bucket changed is void; one of other buckets
    goes through."""
    base = spark.range(100).selectExpr(
        "cast(id as string) as id", "id as v", "0L as at")
    kt.put(base, tmp_dir, SCHEMA, ["id"], ["at"], 4)

    def one(key, v):
        return spark.createDataFrame([(key, v, 9)], SCHEMA)

    bucket = {r[0]: r[1] for r in base.select(
        "id", kt._bucket(["id"], 4)).collect()}
    same = next(k for k in bucket if k != "5" and bucket[k] == bucket["5"])
    other = next(k for k in bucket if bucket[k] != bucket["5"])
    stored = kt.materialized
    for key, lost in ((same, True), (other, False)):
        def between(df, kind, key=key):
            monkeypatch.setattr(kt, "materialized", stored)
            kt.put(one(key, 1000), tmp_dir, SCHEMA, ["id"], ["at"])
            return stored(df, kind)

        monkeypatch.setattr(kt, "materialized", between)
        put = lambda: kt.put(one("5", 555 + lost), tmp_dir, SCHEMA,  # noqa
                             ["id"], ["at"])
        if lost:
            with pytest.raises(kt.ConcurrentPut):
                put()
            assert rows(spark, tmp_dir)["5"] == (5, 0)
        else:
            put()
            assert rows(spark, tmp_dir)["5"] == (555, 9)
        assert rows(spark, tmp_dir)[key] == (1000, 9)
    assert len(rows(spark, tmp_dir)) == 100
