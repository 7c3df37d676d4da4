"""CSV files whose quoted values hold line feeds (S1), read by many tasks.

A reader that starts inside a file can't tell a line feed that ends a record
from one inside quotes: that depends on the number of quotes before it.  So
lines are read by block, as any text file, and numbered within their block
under both assumptions (the block starts outside or inside quotes).  Prefix
sums over the blocks of a file, one row each, then say which one holds.  The
first pass moves no text; the second moves each line to its block's task once,
and only records cut by the end of a block are put together elsewhere.

Quoting is that of RFC 4180: a quote inside a quoted value is doubled, and an
unquoted value has none (``csv_parquet.convert_files`` takes every line for a
record and is the one for files with stray quotes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.session import materialized
from runledger.sources.csv_parquet import (
    CONVERTED, Transform, file_column, identity, key_results, match_files)
from runledger.sources.files import bare_path, below

# Line feeds and carriage returns inside quotes stay as they are.
PARSE = {"escape": '"', "multiLine": "true", "lineSep": "\n",
         "maxCharsPerColumn": "-1"}


def numbered_lines(spark: SparkSession, paths: list[str], root: str
                   ) -> DataFrame:
    """file, block, no, value, quotes, ``empty`` (no visible sign), before
    (quotes earlier in the block) and the number of records begun in the block
    up to the line, if it starts outside (``n0``) or inside (``n1``) quotes.
    An empty line outside quotes begins none.  One task's work is a block."""
    lines = (spark.read.option("ignoreCorruptFiles", "true")
             .option("lineSep", "\n").text(paths))
    rows = lines.select(
        below(bare_path(F.col("_metadata.file_path"), encoded=True), root)
        .alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"), "value",
        (F.octet_length("value") - F.octet_length(F.replace(
            F.col("value"), F.lit('"'), F.lit("")))).cast("long")
        .alias("quotes"),
        (F.trim(F.rtrim(F.col("value"), F.lit("\r"))) == "").alias("empty"))
    w = Window.partitionBy("file", "block").orderBy("no")
    until = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("before", F.sum("quotes").over(until)
                           - F.col("quotes"))

    def begun(parity: int):
        return F.count_if((F.col("before") % 2 == parity)
                          & ~F.col("empty")).over(until)

    return rows.withColumn("n0", begun(0)).withColumn("n1", begun(1))


def block_starts(lines: DataFrame) -> DataFrame:
    """Per (file, block): ``inside`` (1: it starts inside quotes), the record
    that its first lines belong to then (``open``), the records begun in it,
    its quotes, and whether its first line is empty."""
    blocks = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.max("n0").alias("n0"),
        F.max("n1").alias("n1"), F.min_by("empty", "no").alias("empty"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    return (blocks.withColumn("inside", F.coalesce(
                F.sum("quotes").over(earlier), F.lit(0)) % 2)
            .withColumn("begun", F.when(F.col("inside") == 0, F.col("n0"))
                        .otherwise(F.col("n1")))
            .withColumn("open", F.last(F.when(F.col("begun") > 0, F.struct(
                F.col("block").alias("at"), F.col("begun").alias("n"))),
                ignorenulls=True).over(earlier))
            .select("file", "block", "inside", "open", "begun", "quotes",
                    "empty"))


def csv_records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """file, at, n (place of the record: block and number in it) and the
    record's text, of ``numbered_lines`` and their ``block_starts``.  A file's
    first record is 0, 1.  A carriage return that ends a record is dropped."""
    rows = lines.join(blocks.select("file", "block", "inside", "open"),
                      ["file", "block"])
    outside = (F.col("inside") + F.col("before")) % 2 == 0
    n = F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1"))
    # Within its block a record is grouped where the lines are already.
    pieces = (rows.where(~(F.col("empty") & outside)).withColumn("n", n)
              .groupBy("file", "block", "n").agg(
                  F.array_join(F.transform(F.array_sort(F.collect_list(
                      F.struct("no", "value"))), lambda x: x["value"]), "\n")
                  .alias("record"), F.sum("quotes").alias("quotes"),
                  F.first("open").alias("open")))
    head = F.col("n") == 0
    pieces = pieces.select(
        "file", "block", "record",
        F.when(head, F.col("open.at")).otherwise(F.col("block")).alias("at"),
        F.when(head, F.col("open.n")).otherwise(F.col("n")).alias("n"),
        (~head & (F.col("quotes") % 2 == 0)).alias("whole"))
    cut = pieces.where("not whole").groupBy("file", "at", "n").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.struct("block", "record"))), lambda x: x["record"]), "\n")
        .alias("record"))
    return pieces.where("whole").select("file", "at", "n", "record") \
        .unionByName(cut).withColumn(
            "record", F.rtrim(F.col("record"), F.lit("\r")))


def _values(record: str, width: int):
    """Array of the first ``width`` values of a record (null: empty)."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = F.from_csv(F.col(record), schema, PARSE)
    # Fields taken from the expression itself would each parse the record.
    return F.flatten(F.transform(F.array(parsed), lambda r: F.array(
        *[r[f"c{i}"] for i in range(width)])))


def file_headers(blocks: DataFrame, records: DataFrame,
                 schema: T.StructType) -> DataFrame:
    """file, names (its columns in order), input_rows (records after the
    header) and error (null: it can be read), by table-side work only."""
    spark = records.sparkSession
    closed = blocks.groupBy("file").agg(
        (F.sum("quotes") % 2 == 0).alias("closed"),
        F.min_by("empty", "block").alias("empty"),
        (F.sum("begun") - 1).alias("input_rows"))
    heads = records.where("at = 0 and n = 1").select(
        "file", F.regexp_replace("record", "^\ufeff", "").alias("header"))
    heads = materialized(closed.join(heads, "file", "left"), "csv-headers")
    width = heads.where("closed").agg(F.max(
        1 + F.length("header") - F.length(F.replace(
            F.col("header"), F.lit(","), F.lit(""))))).first()[0] or 1
    heads = heads.withColumn(
        "names", F.when(F.col("closed"), _values("header", width)))
    same = (F.col("names") if spark.conf.get("spark.sql.caseSensitive")
            == "true" else F.transform("names", F.lower))
    known = F.filter(same, lambda x: x.isNotNull())
    missing = F.array_except(
        F.array(*[F.lit(f.name) for f in schema.fields]), F.col("names"))
    return heads.select(
        "file", "names", "input_rows",
        F.when(~F.col("closed"), "a quote is never closed")
        .when(F.col("empty"), "header line is blank")
        .when(F.size(known) > F.size(F.array_distinct(known)),
              "a column is repeated")
        .when(F.size(missing) > 0, F.concat(
            F.lit("column "), F.get(missing, F.lit(0)), F.lit(" not found")))
        .alias("error"))


def convert_record_files(spark: SparkSession, files: DataFrame, root: str,
                         dst: str, schema: T.StructType,
                         transform: Transform = identity) -> DataFrame:
    """S1-S3 for the files of the batches ``(batch_id, key)`` below ``root``
    whose quoted values and headers may span lines.

    As ``csv_parquet.convert_files`` with a schema: columns by name, output
    partitioned by file, an earlier output replaced, the same result rows.  All
    files, whatever their header, are read by one scan, each row through its
    own file's names.  Input rows are known from the blocks, with a transform
    too.  Lines without visible signs outside quotes are no records.

    A file fails alone if a quote is never closed, its header is blank or
    repeats a column, or a column of the schema is missing.
    """
    matched = match_files(spark, files, root)
    wanted = files.select("batch_id", "key").distinct()
    paths = [r.path for r in matched.select("path").distinct().collect()]
    if not paths:
        return key_results(wanted, matched, spark.createDataFrame(
            [], "file string, error string"), spark.createDataFrame(
            [], f"{CONVERTED} string, input_rows long, rows long"))
    lines = numbered_lines(spark, paths, root)
    blocks = materialized(block_starts(lines), "csv-blocks")
    records = materialized(csv_records(lines, blocks), "csv-records")
    heads = materialized(file_headers(blocks, records, schema), "csv-heads")
    good = heads.where("error is null").select("file", "names")
    width = good.agg(F.max(F.size("names"))).first()[0] or 1
    data = (records.where("not (at = 0 and n = 1)").join(good, "file")
            .withColumn("values", _values("record", width)))
    source = file_column(f.name for f in schema.fields)
    rows = data.select(*[
        F.get("values", (F.array_position("names", F.lit(f.name)) - 1)
              .cast("int")).try_cast(f.dataType).alias(f.name)
        for f in schema.fields], F.col("file").alias(source))
    out = transform(rows)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(source).parquet(dst))
    written = spark.read.schema(out.schema).parquet(dst).groupBy(
        F.col(source).alias(CONVERTED)).agg(F.count(F.lit(1)).alias("rows"))
    read = heads.where("error is null").select(
        F.col("file").alias(CONVERTED), "input_rows")
    listed = matched.select("file").distinct()
    errors = listed.join(heads.select("file", "error", F.lit(True).alias(
        "seen")), "file", "left").select("file", F.when(
            F.col("seen").isNull(), "file is empty or unreadable")
        .otherwise(F.col("error")).alias("error")).where("error is not null")
    return key_results(wanted, matched, errors,
                       read.join(written, CONVERTED, "left"))
