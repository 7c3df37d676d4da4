"""Scalar functions (F1-F13) and the log-level classifier."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from runledger.functions import scalar as fx


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema)
            .select(expr.alias("x")).collect()]


def test_safe_name(spark):
    out = one(spark, fx.safe_name(F.col("s")),
              [("a b/c",), ("",), (None,), ("x__y?!z",), ("ok.json",)],
              "s string")
    assert out == ["a_b/c", "unknown", "unknown", "x__y_z", "ok.json"]


def test_component_display_and_file_type(spark):
    steps = [("glue_convert",), ("monitoring",), ("other",)]
    assert one(spark, fx.component_type("s"), steps, "s string") == [
        "AWS Glue Job", "Lambda関数", "その他のAWSサービス"]
    assert one(spark, fx.step_display_name("s"), steps, "s string") == [
        "Glue変換", "監視処理", "other"]
    paths = [("a.csv.parquet",), ("b.parquet",), ("c.json",), ("d.txt",)]
    assert one(spark, fx.file_type("s"), paths, "s string") == [
        "CSVファイル", "Parquetファイル", "JSONファイル", "ファイル"]


def test_cell_display(spark):
    data = [(None,), ("x" * 50,), ("y" * 51,), ("é" * 60,)]
    out = one(spark, fx.cell_display("s"), data, "s string")
    assert out[0] == "NULL"
    assert out[1] == "x" * 50
    assert out[2] == "y" * 47 + "..."
    assert out[3] == "é" * 47 + "..."


def test_uri_batch_id_ratio_try_int(spark):
    assert one(spark, fx.object_uri("b", "k"), [("bk", "a/b.csv")],
               "b string, k string") == ["s3://bk/a/b.csv"]
    ts = dt.datetime(2025, 8, 27, 14, 5, 9)
    out = one(spark, fx.default_batch_id("b", "JSON_", F.col("t")),
              [(None, ts), ("", ts), ("B1", ts)], "b string, t timestamp_ntz")
    assert out == ["JSON_202508271405", "JSON_202508271405", "B1"]
    assert one(spark, fx.guarded_ratio("a", "b"), [(1, 4), (3, 0), (2, None)],
               "a long, b long") == [0.25, 0.0, 0.0]
    assert one(spark, fx.try_int("s"), [("12",), ("x",), (None,)],
               "s string") == [12, None, None]


def test_duration_text(spark):
    base = dt.datetime(2025, 1, 1)
    data = [(base, base + dt.timedelta(seconds=s, milliseconds=900))
            for s in (59, 61, 3599, 3600, 7322)]
    out = one(spark, fx.duration_text("a", "b"), data,
              "a timestamp_ntz, b timestamp_ntz")
    assert out == ["59秒", "1分1秒", "59分59秒", "1時間0分", "2時間2分"]


def test_ttl_and_note(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    out = one(spark, fx.ttl_epoch(F.lit("2024-02-01 00:00:00")), [(1,)],
              "x int")
    assert out == [1706745600 + 30 * 24 * 3600]
    note = fx.note_text(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))
    assert one(spark, note, [(1,)], "x int") == ["a | b"]


def test_log_level_rules(spark):
    lines = [("2024 ERROR disk",), ("warn: low",), ("Info started",),
             ("debug x",), ("plain text",), ("",), ("   ",), ("\t　",),
             ("ERROR and INFO",), ("line\r",), ("WARNING",), ("x ",)]
    out = one(spark, fx.log_level("l"), lines, "l string")
    assert out == ["ERROR", "WARN", "INFO", "DEBUG", "OTHER", None, None,
                   None, "ERROR", "OTHER", "WARN", "OTHER"]
    # blank detection follows str.strip()
    for (line,), level in zip(lines, out):
        assert (level is None) == (line.strip() == "")
