"""JSON batches (S5, P3-P7, J6, A5, A6, U2) and keyed operators (W1, W2, S6),
including a hot key holding a third of all rows."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runledger.operators import json_items as ji
from runledger.operators import stages as st
from runledger.operators.keyed import (
    first_n_per_group, latest_per_key, upsert)
from tests.conftest import rows

BATCHES = [
    {"batch_id": "ok", "input_data": {"items": [
        {"name": "a", "category": "x"}, {"name": None, "category": "y",
                                         "extra": 1}]}},
    {"batch_id": "no_items", "input_data": {"key1": "v", "timestamp": "t"}},
    {"batch_id": "not_list", "input_data": {"items": {"name": "a"}}},
    {"batch_id": "empty", "input_data": {"items": []}},
    {"batch_id": "missing", "input_data": {"items": [
        {"name": "a", "category": "x"}, {"category": "y"}, {"name": "b"}]}},
    {"batch_id": "not_dict", "input_data": [1, 2]},
    {"batch_id": "text_list", "input_data": {"items": '[{"name": "a"}]'}},
    {"batch_id": "text_doc", "input_data": '{"items": []}'},
    {"batch_id": "null_list", "input_data": {"items": None}},
    {"batch_id": "no_data", "input_data": None},
]


def _docs(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/b", exist_ok=True)
    for i, b in enumerate(BATCHES):
        with open(f"{tmp_dir}/b/{i}.json", "w") as fh:
            json.dump(b, fh, indent=2)
    return ji.read_batch_documents(spark, f"{tmp_dir}/b")


def test_structure_and_field_validation(spark, tmp_dir):
    checked = ji.structure_check(_docs(spark, tmp_dir))
    errs = {r.batch_id: r.structure_error for r in checked.collect()}
    assert errs == {"ok": None, "no_items": ji.MSG_NO_ITEMS,
                    "not_list": ji.MSG_NOT_LIST, "empty": ji.MSG_EMPTY,
                    "missing": None, "not_dict": ji.MSG_NOT_OBJECT,
                    "text_list": ji.MSG_NOT_LIST,
                    "text_doc": ji.MSG_NOT_OBJECT,
                    "null_list": ji.MSG_NOT_LIST,
                    "no_data": ji.MSG_NOT_OBJECT}
    items = ji.explode_items(checked)
    viol = sorted((r.batch_id, r.message)
                  for r in ji.field_violations(items).collect())
    assert viol == [("missing", "アイテム1: 必須フィールド'name'が存在しません"),
                    ("missing", "アイテム2: 必須フィールド'category'が存在しません")]
    val = {r.batch_id: r for r in ji.batch_validation(items, checked)
           .collect()}
    assert val["ok"].valid and val["ok"].received_items == 2
    assert not val["missing"].valid and val["missing"].violations == 2
    assert val["missing"].first_violation_index == 1
    assert not val["empty"].valid and val["empty"].received_items == 0
    accepted = ji.accepted_items(items, ji.batch_validation(items, checked))
    assert sorted(r.batch_id for r in accepted.collect()) == ["ok", "ok"]


def test_enrich_is_deterministic_and_keeps_types(spark):
    items = [{"name": "n", "category": "c"}, {"category": "c"},
             {"name": None, "category": 5, "description": {"a": [1.5, True]},
              "extra": "5"}]
    df = spark.createDataFrame(
        [("b", i, json.dumps(x)) for i, x in enumerate(items)],
        "batch_id string, item_index long, t string").select(
        "batch_id", "item_index", F.parse_json("t").alias("item"))
    a = ji.enrich_items(df, "2024-02-01 00:00:00")
    assert rows(a) == rows(ji.enrich_items(df, "2024-02-01 00:00:00"))
    r = {x.item_index: x for x in a.collect()}
    assert r[1].name == "" and r[1].description == ""
    assert r[0].ttl == 1706745600 + 2592000
    assert [json.loads(r[i].metadata) for i in range(3)] == items
    assert (r[2].name, r[2].category, r[2].description) == (
        None, "5", '{"a":[1.5,true]}')
    assert r[0].id != r[1].id and len(r[0].id) == 64


def test_write_outcome_threshold(spark):
    def results(batch, n_ok, n_bad):
        return [(batch, i, i < n_ok, None if i < n_ok else "err")
                for i in range(n_ok + n_bad)]
    df = spark.createDataFrame(
        results("r90", 90, 10) + results("r89", 89, 11),
        "batch_id string, item_index long, ok boolean, error string")
    out = {r.batch_id: r for r in ji.write_outcome(df).collect()}
    assert out["r90"].success and out["r90"].status == "SUCCESS"
    assert not out["r89"].success and out["r89"].status == "PARTIAL_SUCCESS"
    top = ji.first_failures(df).where("batch_id = 'r89'")
    assert [r.item_index for r in top.orderBy("rank").collect()] == [
        89, 90, 91, 92, 93]
    violations = spark.createDataFrame(
        [("bad", 2, "m2"), ("bad", 5, "m5")],
        "batch_id string, item_index long, message string")
    structure = spark.createDataFrame(
        [("worse", "no list"), ("r90", None)],
        "batch_id string, structure_error string")
    fails = ji.batch_failures(ji.validation_errors(violations, structure), df)
    assert fails.where("step = 'dynamodb_write'").count() == 6   # 3 + 3
    assert rows(fails.where("step = 'json_preprocess'"), "batch_id",
                "item_index", "error") == [
        ("bad", 2, "m2"), ("bad", 5, "m5"), ("worse", -1, "no list")]


def test_json_batch_statistics(spark):
    b = spark.createDataFrame([("a",), ("b",), ("c",)], "batch_id string")
    pre = spark.createDataFrame(
        [("a", 10, 10, True), ("b", 10, 10, True), ("c", 4, 0, False)],
        "batch_id string, received long, processed long, ok boolean")
    write = spark.createDataFrame(
        [("a", 10, 0, True), ("b", 8, 2, False)],
        "batch_id string, success long, failed long, ok boolean")
    out = {r.batch_id: r for r in st.json_batch_statistics(
        st.join_stages(b, {"pre": pre, "write": write})).collect()}
    assert (out["a"].status, out["a"].success_rate) == ("SUCCESS", 1.0)
    assert (out["b"].status, out["b"].success_rate) == ("PARTIAL_SUCCESS", 0.8)
    assert (out["c"].status, out["c"].input_items,
            out["c"].success_rate) == ("FAILED", 4, 0.0)


def _skewed(spark, n=3000):
    # key 0 holds a third of all rows
    data = [(0 if i % 3 == 0 else i, i, float(i % 97)) for i in range(n)]
    return spark.createDataFrame(data, "k long, ts long, v double")


def test_latest_per_key_matches_window(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("v").desc())
    brute = (df.withColumn("r", F.row_number().over(w)).where("r = 1")
             .drop("r"))
    assert rows(latest_per_key(df, ["k"], ["ts"])) == rows(brute)


def test_first_n_salted_matches_window(spark):
    df = _skewed(spark)
    fast = first_n_per_group(df, ["k"], [F.col("v").asc(), F.col("ts").asc()],
                             5, salt_buckets=7)
    w = Window.partitionBy("k").orderBy(F.col("v").asc(), F.col("ts").asc())
    brute = (df.withColumn("rank", F.row_number().over(w).cast("bigint"))
             .where("rank <= 5"))
    assert rows(fast) == rows(brute)


def test_upsert_last_write_wins(spark):
    base = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 0), (3, 3.0, 0)],
                                 "id long, v double, ts long")
    upd = spark.createDataFrame([(2, 20.0, 5), (2, 21.0, 7), (4, 4.0, 1)],
                                "id long, v double, ts long")
    out = rows(upsert(base, upd, ["id"], ["ts"]))
    assert out == [(1, 1.0, 0), (2, 21.0, 7), (3, 3.0, 0), (4, 4.0, 1)]
    # replaying the same updates changes nothing
    assert rows(upsert(upsert(base, upd, ["id"], ["ts"]), upd, ["id"],
                       ["ts"])) == out
