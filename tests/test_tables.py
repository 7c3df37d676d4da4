"""Table registration (S10, S11, Q14), statistics (A9-A11, P11), samples
(T2-T4) and stage joins (J4, A12, P20)."""

from __future__ import annotations

import uuid

from runledger.operators import stages as st
from runledger.operators import table_stats as ts
from runledger.sources import catalog


def test_register_list_and_update(spark, tmp_dir):
    db = "t_" + uuid.uuid4().hex[:8]
    spark.createDataFrame([(1, "a")], "id int, v string").write \
        .option("header", "true").csv(f"{tmp_dir}/one")
    spark.createDataFrame([(2.5,)], "x double").write \
        .option("header", "true").csv(f"{tmp_dir}/two")
    catalog.create_database(spark, db, f"{tmp_dir}_db")
    before = catalog.list_tables(spark, db)
    catalog.register_path_tables(spark, db, tmp_dir)
    after = catalog.list_tables(spark, db)
    assert sorted(r.table_name for r in after.collect()) == ["one", "two"]
    assert catalog.new_tables(before, after).count() == 2
    assert spark.table(f"{db}.one").count() == 1
    # a new column in the files updates the registered schema
    spark.createDataFrame([(3, "b", 9)], "id int, v string, w int").write \
        .mode("overwrite").option("header", "true").csv(f"{tmp_dir}/one")
    snap = catalog.list_tables(spark, db)
    catalog.register_path_tables(spark, db, tmp_dir)
    assert "w" in spark.table(f"{db}.one").columns
    assert catalog.new_tables(snap, catalog.list_tables(spark, db)).count() == 0


def test_stats_and_summary(spark):
    logs = spark.createDataFrame(
        [("an error here",), ("Warn x",), ("fine",), (None,)], "col0 string")
    other = spark.createDataFrame([(1,)], "id int")
    stats = ts.tables_stats(spark, [("logs", logs, "col0"),
                                    ("nums", other, "col0")])
    got = {r.table_name: r for r in stats.collect()}
    assert (got["logs"].ok, got["logs"].row_count,
            got["logs"].error_count) == (True, 4, 2)
    assert got["nums"].ok is False and "not found" in got["nums"].error
    summ = ts.stats_summary(stats).collect()[0]
    assert (summ.total_tables, summ.successful_tables,
            summ.total_log_entries, summ.total_error_entries) == (2, 1, 4, 2)
    assert summ.error_rate == 0.5 and summ.success is True


def test_first_tables_and_sample(spark):
    names = spark.createDataFrame([("d",), ("a",), ("c",), ("b",)],
                                  "table_name string")
    flags = {r.table_name: r.analyzed
             for r in ts.first_tables(names, 3).collect()}
    assert flags == {"a": True, "b": True, "c": True, "d": False}
    df = spark.createDataFrame([(i, "z" * (45 + i)) for i in range(20)],
                               "id int, s string")
    sample = ts.display_cells(ts.sample_rows(df, 10, ["id"]), keep=["id"])
    out = sample.collect()
    assert [r.id for r in out] == list(range(10))
    assert out[5].s == "z" * 50                   # 50 characters: kept
    assert out[6].s == "z" * 47 + "..."           # 51: shortened


def test_log_pipeline_status(spark):
    b = spark.createDataFrame([(i,) for i in range(5)], "batch_id int")
    collect = spark.createDataFrame(
        [(0, 2, 20, 1, True), (1, 2, 20, 1, True), (2, 2, 20, 1, True),
         (3, 0, 0, 0, False)],
        "batch_id int, files long, lines long, errors long, ok boolean")
    register = spark.createDataFrame(
        [(0, 3, True), (1, 3, True), (2, 1, False), (3, 3, True)],
        "batch_id int, tables long, ok boolean")
    query = spark.createDataFrame(
        [(0, 3, 100, True), (1, 2, 50, False)],
        "batch_id int, queries long, rows long, ok boolean")
    out = st.log_pipeline_status(st.join_stages(
        b, {"collect": collect, "register": register, "query": query}))
    got = {r.batch_id: r for r in out.collect()}
    assert got[0].status == "SUCCESS" and got[0].rows_analyzed == 100
    assert got[0].processing_success_rate == 1.0
    assert got[1].status == "PARTIAL_SUCCESS" and got[1].rows_analyzed == 0
    assert got[2].status == "CRAWLER_FAILED" and got[2].tables_created == 0
    assert got[3].status == "LOG_COLLECT_FAILED"
    assert got[3].processing_success_rate == 0.0
    assert got[4].status == "LOG_COLLECT_FAILED"  # no stage ran at all
    assert abs(got[2].processing_success_rate - 1 / 3) < 1e-12
