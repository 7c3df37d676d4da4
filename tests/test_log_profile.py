"""Log files (S7, S8, P8, T1) and profiles."""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from runledger.operators import log_profile as lp
from runledger.sources.files import (
    list_files, log_file_filter, newest_files, read_log_lines)
from tests.conftest import rows


def _write(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode("utf-8") if isinstance(text, str) else text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_files_filter_read_and_profile(spark, tmp_dir):
    _write(f"{tmp_dir}/a/app.log",
           "ERROR one\r\nwarn two\ninfo\n\n   \nDEBUG z\nplain\n")
    _write(f"{tmp_dir}/a/b.txt", "ERROR and INFO\nnothing\n")
    _write(f"{tmp_dir}/a/c.LOG", "ERROR ignored by suffix\n")
    _write(f"{tmp_dir}/a/d.csv", "ERROR ignored\n")
    _write(f"{tmp_dir}/a/empty.log", "")
    listing = log_file_filter(list_files(spark, tmp_dir))
    assert sorted(r.name for r in listing.collect()) == ["app.log", "b.txt"]
    lines = read_log_lines(spark, tmp_dir).withColumn(
        "name", F.regexp_extract("file", r"([^/]*)$", 1))
    prof = lp.profile_lines(lines, ["name"])
    got = {r.name: r for r in prof.collect()}
    assert set(got) == {"app.log", "b.txt"}
    a = got["app.log"]
    assert (a.lines, a.errors, a.error_count, a.warn_count, a.info_count,
            a.debug_count, a.other_count) == (5, 2, 1, 1, 1, 1, 1)
    b = got["b.txt"]
    assert (b.lines, b.errors, b.error_count, b.other_count) == (2, 1, 1, 1)
    assert lp.check_level_invariant(prof).count() == 0
    totals = lp.profile_totals(prof).collect()[0]
    assert (totals.total_files, totals.processed_files,
            totals.total_log_lines, totals.error_log_lines) == (2, 2, 7, 3)
    assert abs(totals.error_rate - 3 / 7) < 1e-12


def test_newest_cap(spark, tmp_dir):
    now = time.time()
    for i in range(11):
        _write(f"{tmp_dir}/f{i:02d}.log", f"ERROR {i}\n", mtime=now - i * 60)
    listing = log_file_filter(list_files(spark, tmp_dir))
    top = [r.name for r in newest_files(listing, 10).collect()]
    assert top == [f"f{i:02d}.log" for i in range(10)]
    capped = read_log_lines(spark, tmp_dir, newest_k=10)
    assert capped.count() == 10
    assert read_log_lines(spark, tmp_dir).count() == 11


def test_text_profile_matches_line_profile(spark):
    docs = spark.createDataFrame(
        [(1, "ERROR a\n\nwarn b\r\nplain"), (2, ""), (3, None),
         (4, "info\ninfo\nDEBUG")], "doc_id long, text string")
    by_text = lp.profile_texts(docs, "text", keep=["doc_id"])
    lines = docs.select("doc_id", F.explode(F.split(
        F.coalesce("text", F.lit("")), "\n")).alias("line"))
    by_line = lp.profile_lines(lines, ["doc_id"])
    assert rows(by_text) == rows(by_line.select(*by_text.columns))


def test_most_recent(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-03 00:00:00"),
         (3, "2024-01-03 00:00:00"), (1, "2024-01-05 00:00:00")],
        "user_id long, ts string").withColumn("ts", F.col("ts").cast(
            "timestamp_ntz"))
    out = [r.user_id for r in lp.most_recent(df, "user_id", "ts", 2)
           .collect()]
    assert out == [1, 2]


def test_unreadable_file_counts_as_failed(spark, tmp_dir):
    _write(f"{tmp_dir}/ok.log", "ERROR a\ninfo b\n")
    _write(f"{tmp_dir}/bad.txt.gz.log", b"\x1f\x8b not really gzip")
    listing = log_file_filter(list_files(spark, tmp_dir))
    lines = read_log_lines(spark, tmp_dir)
    # simulate a file that vanished/was unreadable at scan time
    lines = lines.where(~F.col("file").endswith("bad.txt.gz.log"))
    files = lp.profile_files(listing, lines)
    got = {r.path.rsplit("/", 1)[-1]: r for r in files.collect()}
    assert got["ok.log"].failed is False and got["ok.log"].lines == 2
    assert got["bad.txt.gz.log"].failed is True
    assert got["bad.txt.gz.log"].lines == 0
    totals = lp.profile_totals(files, failed_col="failed").collect()[0]
    assert (totals.total_files, totals.processed_files,
            totals.total_log_lines) == (2, 1, 2)


def test_carriage_return_and_invalid_utf8(spark, tmp_dir):
    # "\r" stays in the line (split on "\n" only); a bad byte does not
    # change the level of its line.
    _write(f"{tmp_dir}/x.log", b"ERROR one\r\n\xff\xfe warn two\n\r\nplain\n")
    lines = read_log_lines(spark, tmp_dir)
    got = [r.line for r in lines.collect()]
    assert got[0] == "ERROR one\r" and len(got) == 4
    prof = lp.profile_lines(lines.withColumn("f", F.lit(1)), ["f"]) \
        .collect()[0]
    # "\r" alone is blank, like str.strip() treats it
    assert (prof.lines, prof.error_count, prof.warn_count,
            prof.other_count) == (3, 1, 1, 1)


def test_log_file_stats_writes_each_log_by_many_tasks(spark, monkeypatch):
    import glob

    from runledger.plans import log_queries
    from runledger.session import new_run_dir

    sf_dir = new_run_dir(spark, "log-stats-test")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(f"{sf_dir}/events.parquet")
    roots = []

    def run_dir(*args):
        roots.append(new_run_dir(*args))
        return roots[-1]

    monkeypatch.setattr(log_queries, "new_run_dir", run_dir)
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a split each
    try:
        got = {r.name: r for r in log_queries.log_file_stats(
            spark, sf_dir).collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    want = {f"app {r.g}+%.log": r["count"] for r in events.selectExpr(
        "user_id % 7 as g").groupBy("g").count().collect()}
    assert {n: r.lines for n, r in got.items()} == want | {
        "blank one.txt": got["blank one.txt"].lines}
    assert not any(r.failed for r in got.values())
    root = roots[0].removeprefix("file://").removeprefix("file:")
    files = glob.glob(f"{root}/*app 0+*.log/part-*")
    assert len(files) > 1
