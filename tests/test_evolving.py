"""Tables over files whose schema changes (S10): added columns, wider types,
partition folders, refusals."""

from __future__ import annotations

import datetime
import os
import uuid

import pytest

from runledger.sources.catalog import list_tables
from runledger.sources.evolving import register_evolving_tables, widest


@pytest.fixture()
def crawl(spark, tmp_dir):
    db = "e_" + uuid.uuid4().hex[:8]

    def put(path, text):
        path = f"{tmp_dir}/{path}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)

    def run():
        out = register_evolving_tables(
            spark, db, tmp_dir, f"{tmp_dir}_db", f"{tmp_dir}_base")
        return {r.table_name: (r.status, r.reason,
                               [tuple(c) for c in r["columns"]])
                for r in out.collect()}
    yield db, put, run
    for name in (db, f"{db}_base"):
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def test_widest():
    chain = ["int", "bigint", "double", "string"]
    for i, a in enumerate(chain):
        for j, b in enumerate(chain):
            assert widest(a, b) == chain[max(i, j)]
    assert widest("date", "timestamp") == "timestamp"
    assert widest("date", "int") == widest("boolean", "int") == "string"
    assert widest(None, "int") == widest("int", None) == "int"
    assert widest(None, None) is None


def test_added_and_widened_columns(spark, crawl):
    db, put, run = crawl
    put("sales/a.csv", "id,amount,note\n1,5,\n2,7,\n")
    assert run() == {"sales": ("created", None, [
        ("id", "int"), ("amount", "int"), ("note", "string")])}
    assert run()["sales"][0] == "unchanged"
    pinned = spark.table(f"{db}.sales")
    put("sales/b.csv", "ID,amount,note,day,ok\n"
                       "3000000000,2.5,12,2024-02-29,true\n4,x,,,FALSE\n")
    put("sales/empty.csv", "")
    got = run()
    assert got == {"sales": ("altered", None, [
        ("id", "bigint"), ("amount", "string"), ("note", "int"),
        ("day", "date"), ("ok", "boolean")])}
    rows = sorted(tuple(r) for r in spark.table(f"{db}.sales").collect())
    assert rows == [
        (1, "5", None, None, None), (2, "7", None, None, None),
        (4, "x", None, None, False),
        (3000000000, "2.5", 12, datetime.date(2024, 2, 29), True)]
    # A reader of the former state still has its columns.
    assert pinned.columns == ["id", "amount", "note"]
    # Types never narrow, columns never vanish.
    put("sales/b.csv", "id,amount\n9,9\n")
    assert run()["sales"] == ("unchanged", None, got["sales"][2])
    assert spark.table(f"{db}.sales").count() == 3
    assert [r.table_name for r in list_tables(spark, db).collect()] == \
        ["sales"]


@pytest.mark.parametrize("values, want", [
    (["1", "-2"], "int"), (["1", "9999999999"], "bigint"),
    (["1", "1e3", ".5"], "double"), (["1", "99999999999999999999"], "double"),
    (["2024-01-01"], "date"), (["2024-01-01", "2024-01-01 10:00:00"],
                               "timestamp"),
    (["2024-13-01"], "string"), (["true", "1"], "string"), (["2024"], "int"),
    (["1d"], "string"), ([" 7 "], "int"), ([], "string")])
def test_types(spark, crawl, values, want):
    db, put, run = crawl
    put("t/a.csv", "k,v\n" + "".join(f"0,{v}\n" for v in values))
    assert run()["t"][2][1] == ("v", want)
    rows = spark.table(f"{db}.t")
    assert rows.where("v is null").count() == 0
    assert rows.count() == len(values)


def test_partition_folders(spark, crawl):
    db, put, run = crawl
    put("ev/day=2024-01-01/part=1/a.csv", "id\n1\n")
    put("ev/day=2024-01-02/part=2/a.csv", "id\n2\n3\n")
    assert run()["ev"] == ("created", None, [
        ("id", "int"), ("day", "date"), ("part", "int")])
    put("ev/day=2024-01-03/part=x%3Ay/a.csv", "id,n\n4,8\n")
    put("ev/day=__HIVE_DEFAULT_PARTITION__/part=2/a.csv", "id\n5\n")
    assert run()["ev"] == ("altered", None, [
        ("id", "int"), ("n", "int"), ("day", "date"), ("part", "string")])
    day = datetime.date
    assert sorted((r.id, r.n, r.day, r.part)
                  for r in spark.table(f"{db}.ev").collect()) == [
        (1, None, day(2024, 1, 1), "1"), (2, None, day(2024, 1, 2), "2"),
        (3, None, day(2024, 1, 2), "2"), (4, 8, day(2024, 1, 3), "x:y"),
        (5, None, None, "2")]
    # Another key can't be added to a table.
    put("ev/day=2024-01-04/other=1/a.csv", "id\n6\n")
    status, reason, _ = run()["ev"]
    assert status == "refused" and "partition folders" in reason
    assert spark.table(f"{db}.ev").where("day < '2024-01-04'").count() == 4


def test_refused_alone(spark, crawl):
    db, put, run = crawl
    put("good/a.csv", "x\n1\n")
    put("twice/a.csv", "a,A\n1,2\n")
    put("blank/a.csv", "\n1\n")
    put("order/a.csv", "a,b\n1,2\n")
    put("clash/b=1/a.csv", "a,b\n1,2\n")
    got = run()
    assert {n for n, (s, _, _) in got.items() if s == "refused"} == {
        "twice", "blank", "clash"}
    assert got["good"][0] == got["order"][0] == "created"
    put("order/b.csv", "b,a\n2,1\n")
    assert run()["order"][0] == "refused"
    # The table stays, with the columns it had.
    assert spark.table(f"{db}.order").columns == ["a", "b"]
    # Other files with other columns than the table: refused as well.
    put("good/a.csv", "y\n1\n")
    status, reason, _ = run()["good"]
    assert status == "refused" and "the table has ['x']" in reason


def test_names_that_need_quotes(spark, crawl):
    db, put, run = crawl
    put("odd name/a.csv", "a b,it's,x`y,select\n1,2,3,4\n")
    assert run()["odd_name"][0] == "created"
    assert spark.table(f"{db}.odd_name").collect()[0].asDict() == {
        "a b": 1, "it's": 2, "x`y": 3, "select": 4}


def test_empty_root(spark, crawl):
    db, put, run = crawl
    assert run() == {}
