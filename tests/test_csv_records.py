"""CSV records that span lines (S1) and bytes that are no UTF-8."""

from __future__ import annotations

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from runledger.operators.keyed import latest_per_key
from runledger.sources import csv_records as cr
from runledger.sources.csv_parquet import staged_rows
from runledger.sources.files import read_log_lines, valid_text
from tests.conftest import rows

SIGNS = ["a", "b", " ", ",", '"', '""', "\n", "\n\n", "\r\n", "é", "\\", "'"]


@pytest.fixture()
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in (
        "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _file(path, header, data, newline="\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        out = csv.writer(fh, lineterminator=newline, quoting=csv.QUOTE_ALL)
        out.writerow(header)
        out.writerows(data)


def _convert(spark, tmp_dir, keys, schema, **kw):
    files = spark.createDataFrame([("1", k) for k in keys],
                                  "batch_id string, key string")
    return cr.convert_record_files(
        spark, files, f"{tmp_dir}/in", f"{tmp_dir}/out", schema, **kw)


def test_records_over_many_blocks_equal_a_csv_reader(spark, tmp_dir,
                                                     small_blocks):
    rnd = random.Random(5)
    schema = spark.range(0).selectExpr("'' as `x\ny`", "0L as id").schema
    expected = []
    for name, order, end in (("p.csv", 1, "\n"), ("q r.csv", -1, "\r\n")):
        data = [("".join(rnd.choices(SIGNS, k=rnd.choice((0, 3, 9, 400)))), i)
                for i in range(40)]
        _file(f"{tmp_dir}/in/{name}", ("x\ny", "id")[::order],
              [r[::order] for r in data], end)
        expected += [(t or None, i, name) for t, i in data]
    out = _convert(spark, tmp_dir, ["p.csv", "q r.csv"], schema)
    assert rows(out, "key", "job_state", "input_rows", "rows") == [
        ("p.csv", "SUCCEEDED", 40, 40), ("q r.csv", "SUCCEEDED", 40, 40)]
    staged, source = staged_rows(spark, f"{tmp_dir}/out", schema)
    got = [(t or None, i, f) for t, i, f in
           rows(staged, "x\ny", "id", source)]
    assert sorted(got, key=str) == sorted(expected, key=str)
    with open(f"{tmp_dir}/in/p.csv", encoding="utf-8", newline="") as fh:
        assert len(list(csv.reader(io.StringIO(fh.read(), newline="")))) == 41


def test_a_file_is_read_by_many_tasks(spark, tmp_dir, small_blocks):
    _file(f"{tmp_dir}/in/p.csv", ("t",), [("x\n" * 50,)] * 20)
    lines = cr.numbered_lines(spark, [f"{tmp_dir}/in/p.csv"], f"{tmp_dir}/in")
    assert lines.select("block").distinct().count() > 10
    records = cr.csv_records(lines, cr.block_starts(lines))
    assert rows(records.groupBy("record").count(), "count") == [(1,), (20,)]
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bad_files_fail_alone(spark, tmp_dir):
    schema = spark.range(0).selectExpr("0L as id", "'' as t").schema
    texts = {"open.csv": 'id,t\n1,"x\n2,y\n', "blank.csv": "\n1,2\n",
             "twice.csv": "id,t,ID\n1,2,3\n", "lacks.csv": "id\n1\n",
             "none.csv": "id,t\n", "empty.csv": "",
             "good.csv": "﻿t,,id,src_file\n\n a ,z,7,w\n,,x\n  \n"}
    for name, text in texts.items():
        os.makedirs(f"{tmp_dir}/in", exist_ok=True)
        with open(f"{tmp_dir}/in/{name}", "w", encoding="utf-8") as fh:
            fh.write(text)
    got = {r.key: r for r in _convert(
        spark, tmp_dir, [*texts, "missing.csv"], schema).collect()}
    reason = {k: (r.error_message or "").removeprefix(f"Error accessing {k}")
              for k, r in got.items()}
    assert reason == {
        "open.csv": ": a quote is never closed",
        "blank.csv": ": header line is blank",
        "twice.csv": ": a column is repeated",
        "lacks.csv": ": column t not found", "none.csv": "", "good.csv": "",
        "empty.csv": "", "missing.csv": ""}
    assert {k for k, r in got.items() if r.job_state == "SUCCEEDED"} == {
        "none.csv", "good.csv"}
    staged, _ = staged_rows(spark, f"{tmp_dir}/out", schema)
    assert rows(staged, "id", "t") == [(7, " a "), (None, None)]
    assert (got["good.csv"].input_rows, got["good.csv"].rows) == (2, 2)
    assert _convert(spark, tmp_dir, ["missing.csv"], schema).collect()[
        0].job_state == "FAILED"


def test_rows_in_and_out_with_a_transform(spark, tmp_dir):
    schema = spark.range(0).selectExpr("0L as id", "'' as t").schema
    _file(f"{tmp_dir}/in/p.csv", ("id", "t"), [(i % 3, "a\nb")
                                               for i in range(10)])
    out = _convert(spark, tmp_dir, ["p.csv"], schema,
                   transform=lambda d: latest_per_key(d, ["id"], ["t"]))
    assert rows(out, "input_rows", "rows") == [(10, 3)]


def test_invalid_bytes_are_dropped(spark, tmp_dir):
    rnd = random.Random(9)
    parts = [b"a", b"\xe2", b"\x82", b"\xac", b"\xf0", b"\x9f", b"\x98",
             b"\x80", b"\xed", b"\xa0", b"\xc0", b"\xaf", b"\xf4\x90", b"\xff",
             "é€😀�".encode(), b"\x00", b"$1\\"]
    texts = [b"".join(rnd.choices(parts, k=rnd.randrange(30)))
             for _ in range(400)] + [b"x" * 300_000 + b"\xff",
                                     b"\xff\xc3\xa9" * 100_000]
    df = spark.createDataFrame([(i, bytearray(t))
                                for i, t in enumerate(texts)],
                               "i int, b binary").repartition(3)
    got = dict(df.select("i", valid_text(F.col("b").cast("string")))
               .collect())
    assert got == {i: t.decode("utf-8", "ignore")
                   for i, t in enumerate(texts)}
    with open(f"{tmp_dir}/x.log", "wb") as fh:
        fh.write(b"\xffERROR\xe2\x82\nok\xc3\n\xf0\x9f\n")
    assert rows(read_log_lines(spark, tmp_dir), "line") == [
        ("",), ("ERROR",), ("ok",)]
    empty = spark.createDataFrame([(None,)], "t string")
    assert empty.select(valid_text(F.col("t"))).first()[0] is None
