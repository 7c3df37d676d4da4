"""Manifest validation (P2, J1, A1), conversion and load (S1-S4, A2, A3),
and the batch summary (A4, J3, P18, P19, U1)."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from runledger.operators import csv_batch as cb
from runledger.operators import validate as va
from runledger.sources import csv_parquet as cp
from runledger.sources.files import list_files

GIB = 1024 ** 3

# Rows made by rule: one empty cell, one of more than 50 characters.
EMPLOYEES = [
    (k, f"First{k}", f"Last{k}",
     None if k == 3 else "x" * 60 if k == 5 else f"p{k}@mail.invalid",
     20 + 3 * k, ("Engineering", "HR", "Sales")[k % 3], 50_000 + 1_000 * k,
     dt.date(2020, k, 2 * k))
    for k in range(1, 11)]
EMP_SCHEMA = ("employee_id int, first_name string, last_name string, "
              "email string, age int, department string, salary int, "
              "hire_date date")


def _manifest(spark):
    return spark.createDataFrame([
        ("B1", [("land", "ok.csv"), ("land", "UP.CSV"), ("land", "gone.csv"),
                ("land", "exact.csv"), ("land", "big.csv"),
                ("land", "big.json"), ("land", "notes.txt")]),
        ("B2", [("land", "ok.csv")]),
        ("B3", []),
    ], "batch_id string, files array<struct<bucket:string,key:string>>")


def _listing(spark):
    return spark.createDataFrame([
        ("land", "ok.csv", 714, None), ("land", "UP.CSV", 10, None),
        ("land", "exact.csv", GIB, None), ("land", "big.csv", GIB + 1, None),
        ("land", "big.json", GIB + 1, None), ("land", "notes.txt", 5, None),
    ], "bucket string, key string, file_size long, last_modified timestamp")


def test_validation_reasons_and_totals(spark):
    manifests = _manifest(spark)
    checked = va.validate_files(va.explode_manifest(manifests),
                                _listing(spark))
    got = {(r.batch_id, r.key): r for r in checked.collect()}
    assert got[("B1", "ok.csv")].valid
    assert got[("B1", "UP.CSV")].valid                     # case-insensitive
    assert got[("B1", "gone.csv")].reason.startswith("Error accessing gone.csv")
    assert got[("B1", "exact.csv")].valid                  # exactly 1 GiB
    assert got[("B1", "big.csv")].reason == (
        f"File too large: big.csv ({GIB + 1} bytes)")
    assert got[("B1", "big.json")].reason.startswith("File too large")
    assert got[("B1", "notes.txt")].reason == "Not a CSV file: notes.txt"
    assert got[("B1", "ok.csv")].uri == "s3://land/ok.csv"
    totals = {r.batch_id: r for r in
              va.validation_totals(checked, manifests).collect()}
    b1 = totals["B1"]
    assert (b1.files_count, b1.validated_files, b1.error_count) == (7, 3, 4)
    # rejected files still count in the size total; absent ones add nothing
    assert b1.total_size_bytes == 714 + 10 + GIB + 2 * (GIB + 1) + 5
    assert b1.success is False
    assert totals["B2"].success is True
    assert totals["B3"].files_count == 0 and totals["B3"].success is False
    go = sorted((r.batch_id, r.key) for r in va.valid_files(checked).collect())
    assert go == [("B1", "UP.CSV"), ("B1", "exact.csv"), ("B1", "ok.csv"),
                  ("B2", "ok.csv")]


def test_listing_from_files(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/a.csv", "w") as fh:
        fh.write("x\n1\n")
    listing = va.listing_from_files(list_files(spark, tmp_dir), "land",
                                    tmp_dir)
    r = listing.collect()[0]
    assert (r.key, r.file_size) == ("in/a.csv", 4)


def test_convert_and_append_load(spark, tmp_dir):
    emp = spark.createDataFrame(EMPLOYEES, EMP_SCHEMA)
    src = f"{tmp_dir}/landing/employees.csv"
    emp.write.option("header", "true").csv(src)
    dst = f"{tmp_dir}/staging/parquet/employees/landing/employees.csv"
    step = cp.convert_csv_to_parquet(spark, src, dst)     # inferred schema
    assert (step.ok, step.input_rows, step.output_rows) == (True, 10, 10)
    back = spark.read.parquet(dst)
    assert back.where("email IS NULL").count() == 1
    assert back.where("length(email) > 50").count() == 1
    name = "emp_" + uuid.uuid4().hex[:8]
    first = cp.append_load(spark, dst, name, f"{tmp_dir}/wh/{name}")
    second = cp.append_load(spark, dst, name, f"{tmp_dir}/wh/{name}")
    assert (first["inserted_rows"], first["table_rows"]) == (10, 10)
    # second load of the same file: 10 inserted, 20 in the table (Q1)
    assert (second["inserted_rows"], second["table_rows"]) == (10, 20)
    bad = cp.convert_csv_to_parquet(spark, f"{tmp_dir}/missing", dst + "x")
    assert bad.ok is False and bad.error
    ev = cp.step_evidence(spark, "B1", "csv-to-parquet-pipeline",
                          "glue_convert", step, src, dst, "employees",
                          "2024-03-05T14:01:45").collect()[0]
    assert ev.input.rows == 10 and ev.output.rows == 10 and ev.ok


def test_batch_summary_and_failures(spark):
    files = spark.createDataFrame(
        [("B1", "a.csv"), ("B1", "b.csv"), ("B1", "c.csv"), ("B1", "d.csv"),
         ("B2", "e.csv")], "batch_id string, key string")
    conv = spark.createDataFrame(
        [("B1", "a.csv", "SUCCEEDED", None, 12, 10),
         ("B1", "b.csv", "FAILED", "boom", 0, 0),
         ("B1", "c.csv", "SUCCEEDED", None, 5, 5),
         ("B1", "d.csv", "SUCCEEDED", None, 3, 3),
         ("B2", "e.csv", "SUCCEEDED", None, 10, 10),
         ("B2", "a.csv", "SUCCEEDED", None, 99, 99)],   # another batch's
        "batch_id string, key string, job_state string, "
        "error_message string, input_rows long, rows long")
    loads = spark.createDataFrame(
        [("B1", "a.csv", '{"Payload": "{\\"success\\": true, \\"inserted_rows\\": 10}"}'),
         ("B1", "c.csv", '{"Payload": {"success": false, "error": "copy failed"}}'),
         ("B1", "d.csv", '{"Payload": {"success": true, "inserted_rows": 3}}'),
         ("B2", "e.csv", '{"Payload": {"success": true, "inserted_rows": 20}}')],
        "batch_id string, key string, load_result string")
    res = cb.file_results(files, conv, loads)
    pre = spark.createDataFrame([("B1", "Not a CSV file: x.txt"),
                                 ("B9", "Not a CSV file: y.txt")],
                                "batch_id string, reason string")
    summary = {r.batch_id: r for r in cb.batch_summary(res, pre).collect()}
    b1 = summary["B1"]
    assert (b1.total_input_files, b1.successful_conversions,
            b1.successful_loads, b1.total_loaded_rows, b1.failure_count,
            b1.status) == (4, 3, 2, 13, 3, "PARTIAL_FAILURE")
    assert (b1.total_input_rows, b1.total_output_rows) == (20, 18)
    b9 = summary["B9"]     # nothing but a validation error
    assert (b9.total_input_files, b9.failure_count, b9.status) == (
        0, 1, "PARTIAL_FAILURE")
    b2 = summary["B2"]
    assert (b2.status, b2.total_loaded_rows) == ("SUCCESS", 20)
    fails = sorted((r.step, r.file, r.error)
                   for r in cb.batch_failures(res, pre).collect())
    assert fails == [("glue_convert", "b.csv", "boom"),
                     ("prevalidate", "validation", "Not a CSV file: x.txt"),
                     ("prevalidate", "validation", "Not a CSV file: y.txt"),
                     ("redshift_load", "c.csv", "copy failed")]


def test_convert_files_batch(spark, tmp_dir):
    emp = spark.createDataFrame(EMPLOYEES, EMP_SCHEMA)
    land = f"{tmp_dir}/land"
    emp.where("department = 'HR'").write.option("header", "true") \
        .csv(f"{land}/hr dept")

    def put(name, text):
        with open(f"{land}/{name}", "w") as fh:
            fh.write(text)
    put("007", "employee_id,first_name\n5,David\n10,Susan\n")
    put("a+b ü%.csv", "first_name,employee_id\nAda,77\n")
    put("short.csv", "first_name\nNo id\n")
    put("nothing.csv", "")
    names = ["hr dept", "007", "a+b ü%.csv", "gone.csv", "short.csv",
             "nothing.csv"]
    files = spark.createDataFrame(
        [("B", n) for n in names] + [("C", "007")],
        "batch_id string, key string")
    schema = emp.select("employee_id", "first_name").schema
    cp.convert_files(spark, files, land, f"{tmp_dir}/stage", schema)
    # Again, with fewer files: nothing of the first run is left.
    fewer = files.where("key <> 'hr dept'")
    cp.convert_files(spark, fewer, land, f"{tmp_dir}/stage", schema)
    assert spark.read.parquet(f"{tmp_dir}/stage").count() == 3
    conv = cp.convert_files(spark, files, f"file:{land}/",
                            f"{tmp_dir}/stage", schema)
    got = {(r.batch_id, r.key): (r.job_state, r.input_rows, r.rows)
           for r in conv.collect()}
    n_hr = sum(e[5] == "HR" for e in EMPLOYEES)
    assert got == {
        ("B", "hr dept"): ("SUCCEEDED", n_hr, n_hr),
        ("B", "007"): ("SUCCEEDED", 2, 2), ("C", "007"): ("SUCCEEDED", 2, 2),
        ("B", "a+b ü%.csv"): ("SUCCEEDED", 1, 1),
        ("B", "gone.csv"): ("FAILED", 0, 0),
        ("B", "short.csv"): ("FAILED", 0, 0),
        ("B", "nothing.csv"): ("FAILED", 0, 0)}
    # Columns are taken by name.
    rows = {(r.employee_id, r.first_name) for r in
            spark.read.parquet(f"{tmp_dir}/stage").collect()}
    assert (77, "Ada") in rows and (5, "David") in rows
    name = "b_" + uuid.uuid4().hex[:8]
    loads = cp.load_converted(spark, files, land, f"{tmp_dir}/stage", name,
                              f"{tmp_dir}/wh/{name}", schema)
    res = {(r.batch_id, r.key): r for r in
           cb.file_results(files, conv, loads).collect()}
    assert len(res) == 7
    assert res["B", "hr dept"].loaded
    assert res["B", "hr dept"].inserted_rows == n_hr
    assert not res["B", "gone.csv"].converted
    assert spark.table(name).count() == n_hr + 3
    spark.sql(f"DROP TABLE {name}")
