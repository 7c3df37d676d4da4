"""Loads that can be retried, and headers of real files."""

from __future__ import annotations

import os

import pytest

from runledger.operators import csv_batch as cb
from runledger.sources import csv_parquet as cp
from runledger.sources import load_ledger as ll

from .conftest import rows

SCHEMA = "file string, id long, v string"


def staged(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def wanted(spark, pairs):
    return spark.createDataFrame(pairs, "batch_id string, file string")


def table_rows(spark, location):
    schema = spark.createDataFrame([], "id long, v string").schema
    return rows(ll.read_loaded(spark, location, schema))


def test_second_run_inserts_nothing(spark, tmp_dir):
    data = staged(spark, [("a.csv", 1, "x"), ("a.csv", 2, None),
                          ("b/007", 3, "y"), ("b/007", 3, "y")])
    want = wanted(spark, [("B", "a.csv"), ("B", "b/007"), ("C", "b/007"),
                          ("C", "gone"), ("C", "b/007")])
    first = rows(ll.load_once(data, "file", want, tmp_dir))
    assert first == [("B", "a.csv", 2, 2), ("B", "b/007", 2, 2),
                     ("C", "b/007", 2, 2), ("C", "gone", 0, 0)]
    held = table_rows(spark, tmp_dir)
    assert held == [(1, "x"), (2, None), (3, "y"), (3, "y")]
    again = ll.load_once(data.repartition(3), "file", want, tmp_dir)
    assert [r[3] for r in rows(again)] == [0, 0, 0, 0]
    assert table_rows(spark, tmp_dir) == held
    # Another batch loads the same file again, as the reference does.
    more = ll.load_once(data, "file", wanted(spark, [("D", "a.csv")]),
                        tmp_dir)
    assert rows(more) == [("D", "a.csv", 2, 2)]
    assert len(table_rows(spark, tmp_dir)) == 6


def test_run_lost_before_its_marker(spark, tmp_dir):
    data = staged(spark, [("a", 1, "x"), ("a", 2, "y")])
    want = wanted(spark, [("B", "a")])

    def lost(load_id):
        raise KeyError(load_id)

    for _ in range(2):
        with pytest.raises(KeyError):
            ll.load_once(data, "file", want, tmp_dir, lost)
        assert table_rows(spark, tmp_dir) == []
    # The rows of both lost runs lie there and are not seen.
    assert spark.read.parquet(f"{tmp_dir}/rows").count() == 4
    assert rows(ll.load_once(data, "file", want, tmp_dir)) == [
        ("B", "a", 2, 2)]
    assert table_rows(spark, tmp_dir) == [(1, "x"), (2, "y")]


def test_two_runs_at_the_same_time(spark, tmp_dir):
    """A run that commits while another is about to: the first counts."""
    data = staged(spark, [("a", 1, "x")])
    want = wanted(spark, [("B", "a")])
    ll.load_once(data, "file", want, tmp_dir,
                 lambda _: ll.load_once(data, "file", want, tmp_dir))
    assert ll.read_ledger(spark, tmp_dir).count() == 2
    assert table_rows(spark, tmp_dir) == [(1, "x")]


def test_changed_content_is_new(spark, tmp_dir):
    want = wanted(spark, [("B", "a")])
    for k, data in enumerate(([("a", 1, "x")], [("a", 1, "z")],
                              [("a", 1, "x"), ("a", 1, "x")],
                              [("a", None, None)], [("a", 1, "x")])):
        out = rows(ll.load_once(staged(spark, data), "file", want, tmp_dir))
        assert out == [("B", "a", len(data), 0 if k == 4 else len(data))]
    assert len(table_rows(spark, tmp_dir)) == 5


def test_reserved_and_empty(spark, tmp_dir):
    odd = spark.createDataFrame([("a", 1)], "file string, _LOAD_ID long")
    with pytest.raises(ValueError):
        ll.load_once(odd, "file", wanted(spark, [("B", "a")]), tmp_dir)
    none = ll.load_once(staged(spark, []), "file",
                        wanted(spark, [("B", "a")]), tmp_dir)
    assert rows(none) == [("B", "a", 0, 0)]
    assert not os.path.exists(f"{tmp_dir}/ledger")
    assert table_rows(spark, tmp_dir) == []


def test_headers_of_real_files(spark, tmp_dir):
    """Each bad file fails alone; a column may be named like ours."""
    land = f"{tmp_dir}/land"
    os.makedirs(land)
    texts = {"good": "a,src_file,,B\n1,mine,2,3\n4,own,5,6\n",
             "bom": "﻿a,src_file\n7,x\n",
             "repeated": "a,b,a\n1,2,3\n", "case": "A,a\n1,2\n",
             "blank": "\na\n1\n", "spaces": "   \n1\n",
             "quoted": '"a\nb",c\n1,2\n'}
    for name, text in texts.items():
        with open(f"{land}/{name}", "w") as fh:
            fh.write(text)
    files = wanted(spark, [("B", n) for n in texts]).withColumnRenamed(
        "file", "key")
    conv = cp.convert_files(spark, files, land, f"{tmp_dir}/stage")
    got = {r.key: (r.job_state, r.rows, r.error_message)
           for r in conv.collect()}
    assert got["good"] == ("SUCCEEDED", 2, None)
    assert got["bom"] == ("SUCCEEDED", 1, None)
    for name, why in (("repeated", "column a is repeated"),
                      ("case", "column a is repeated"),
                      ("blank", "header line is blank"),
                      ("spaces", "header line is blank"),
                      ("quoted", "header has a line feed inside quotes")):
        assert got[name] == ("FAILED", 0, f"Error accessing {name}: {why}")
    data = spark.read.parquet(f"{tmp_dir}/stage")
    assert rows(data, "a", "src_file", "_c2", "B") == [
        ("1", "mine", "2", "3"), ("4", "own", "5", "6"),
        ("7", "x", None, None)]
    schema = spark.createDataFrame([], "a int, src_file string").schema
    conv = cp.convert_files(spark, files, land, f"{tmp_dir}/stage2", schema)
    for run in (True, False):
        loads = cp.load_converted_once(spark, files, land,
                                       f"{tmp_dir}/stage2",
                                       f"{tmp_dir}/wh", schema)
        res = {r.key: (r.converted, r.loaded, r.inserted_rows)
               for r in cb.file_results(files, conv, loads).collect()}
        assert res["good"] == (True, True, 2 if run else 0)
        assert res["blank"] == (False, False, 0)
        assert rows(ll.read_loaded(spark, f"{tmp_dir}/wh", schema)) == [
            (1, "mine"), (4, "own"), (7, "x")]
