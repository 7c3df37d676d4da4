"""Plan-shape checks for the scale properties the operators rely on."""

from __future__ import annotations

import contextlib
import io
import json
import os
import re

from pyspark.sql import functions as F

from runledger.operators import evidence as evo
from runledger.operators import log_profile as lp
from runledger.operators.flows import classify_flow
from runledger.sources import evidence_store as store

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _hot_events(spark, n=3000):
    # batch B0 holds a third of all events
    rows = []
    for i in range(n):
        batch = "B0" if i % 3 == 0 else f"C{i % 50}"
        e = {"batch_id": batch, "step": "glue_convert", "ok": i % 7 != 0,
             "ts": "2025-01-01T00:00:00", "input": {"rows": i % 5},
             "output": {"rows": i % 5}, "is_terminal": i % 11 == 0}
        rows.append(("/g", str(i), "EVIDENCE " + json.dumps(e)))
    return spark.createDataFrame(rows, "log_group string, event_id string, "
                                       "message string")


def test_rollup_aggregates_partially_before_shuffle(spark):
    parsed = evo.parse_log_events(_hot_events(spark), None, "2025-01-01")
    out = evo.rollup(evo.dedup_events(parsed, evo.ROLLUP_INPUT))
    text = plan(out)
    assert "partial_sum" in text or "partial_count" in text
    assert "WindowGroupLimit" in text        # de-dup cuts hot keys per task
    assert "SortAggregate" not in text
    got = {r.batch_id: r.steps for r in out.collect()}
    assert got["B0"] == 1000 and sum(got.values()) == 3000


def test_parse_json_is_not_pushed_into_filters(spark):
    parsed = evo.parse_log_events(_hot_events(spark), None, "2025-01-01")
    text = plan(parsed)
    filters = [ln for ln in text.splitlines()
               if re.match(r"\s*Condition\s*:", ln)]
    assert not any("from_json" in ln or "json_object_keys" in ln.lower()
                   for ln in filters)


def test_profile_partial_aggregation(spark):
    lines = spark.createDataFrame(
        [("hot" if i % 3 == 0 else f"f{i % 40}", f"ERROR {i}")
         for i in range(900)], "file string, line string")
    text = plan(lp.profile_lines(lines, ["file"]))
    assert "partial_count" in text


def test_flow_match_is_an_equi_join(spark):
    fm = spark.createDataFrame([(0, "a", "x"), (1, "bcd", "y")],
                               "ord int, pattern string, flow string")
    vals = spark.createDataFrame([("abcd",), ("zz",)], "v string")
    text = plan(classify_flow(vals, "v", fm))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "monotonically" not in text


def test_store_read_prunes_buckets(spark, tmp_dir):
    df = spark.range(200).select(
        F.concat(F.lit("0"), (F.col("id") % 10).cast("string"))
        .alias("batch_id"), F.col("id").cast("string").alias("event_id"),
        F.lit("s").alias("step"), F.lit(1).alias("x"))
    store.append_evidence(df, f"{tmp_dir}/st")
    ids = spark.createDataFrame([("03",)], "batch_id string")
    read = store.read_evidence(spark, f"{tmp_dir}/st", batches=ids,
                               dedup=False)
    assert read.count() == 20 and read.schema["batch_id"].dataType \
        .simpleString() == "string"
    folders = [d for d in os.listdir(f"{tmp_dir}/st") if "=" in d]
    assert len(folders) <= store.BUCKETS


def test_upsert_reduces_updates_once(spark):
    from runledger.operators.keyed import upsert
    base = spark.range(5).selectExpr("id", "0 as v", "0 as t")
    upd = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (9, 7, 1)],
                                "id long, v int, t int")
    out = upsert(base, upd, ["id"], ["t"])
    assert sorted((r.id, r.v) for r in out.collect()) == [
        (0, 0), (1, 6), (2, 0), (3, 0), (4, 0), (9, 7)]
    fresh = plan(upsert(base, upd, ["id"], ["t"]))
    assert len(re.findall(r"\(\d+\) Window\b", fresh)) == 1


def test_latest_per_key_carries_any_type(spark):
    from runledger.operators.keyed import latest_per_key
    df = spark.range(6).selectExpr(
        "id % 2 as k", "id as t", "map('a', id) as m",
        "parse_json(concat('[', id, ']')) as j")
    got = latest_per_key(df, ["k"], ["t"]).collect()
    assert sorted((r.k, r.m["a"]) for r in got) == [(0, 4), (1, 5)]


def test_no_python_udfs_in_library():
    pattern = re.compile(r"\b(udf|pandas_udf|applyInPandas|mapInPandas|"
                         r"\.rdd\.map|localCheckpoint)\b")
    hits = []
    for base, _, files in os.walk(os.path.join(ROOT, "runledger")):
        if os.path.basename(base) == "llm":
            continue      # operators of any style, see their own tests
        for name in files:
            if name.endswith(".py"):
                text = open(os.path.join(base, name), encoding="utf-8").read()
                hits += [(name, m.group(0)) for m in pattern.finditer(text)]
    assert hits == []


def test_no_local_files_in_library():
    """Only Spark reads and writes files, so any store will do."""
    pattern = re.compile(r"(?<![\w.])open\(|os\.makedirs|glob\.glob")
    for base, _, files in os.walk(os.path.join(ROOT, "runledger")):
        if os.path.basename(base) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                text = open(os.path.join(base, name), encoding="utf-8").read()
                assert not pattern.search(text), name
