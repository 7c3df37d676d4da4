"""CSV ingest (S1), Parquet staging (S2, S3), append load (S4) and the
evidence a finished step emits (S18).

The conversion reads the CSV once: its row count is taken by an
``Observation`` during the Parquet write rather than by a second scan, and
the written row count comes from a read-back of the Parquet output.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.sources import load_ledger
from runledger.sources.files import bare_path, below, list_files

Transform = Callable[[DataFrame], DataFrame]


def read_csv(spark: SparkSession, path: str | list[str],
             schema: T.StructType | None = None,
             options: dict[str, str] | None = None) -> DataFrame:
    """Header row; explicit schema when given, else inferred."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.options(**(options or {})).csv(path)


def identity(df: DataFrame) -> DataFrame:
    """The default transform hook."""
    return df


@dataclass
class StepResult:
    ok: bool
    input_rows: int
    output_rows: int
    error: str | None


def convert_csv_to_parquet(spark: SparkSession, src: str, dst: str,
                           schema: T.StructType | None = None,
                           transform: Transform = identity,
                           partition_by: list[str] | None = None
                           ) -> StepResult:
    """S1 -> P1 -> S2 (overwrite) -> S3 (read-back count), with A2."""
    try:
        df = read_csv(spark, src, schema)
        obs = Observation("csv_rows")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        writer = transform(observed).write.mode("overwrite") \
            .option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(dst)
        input_rows = int(obs.get["rows"])
        output_rows = spark.read.parquet(dst).count()
        return StepResult(True, input_rows, output_rows, None)
    except Exception as exc:  # the step reports failure as evidence
        return StepResult(False, 0, 0, str(exc))


def append_load(spark: SparkSession, src: str, table: str,
                location: str, fmt: str = "parquet",
                options: dict[str, str] | None = None,
                count_table: bool = True) -> dict:
    """S4 + A3: append a staged folder into a named table.

    Returns ``inserted_rows`` (this load) and ``table_rows`` (the whole
    table after the load, which is what the reference reports, Q1; null
    unless ``count_table``).
    """
    df = spark.read.format(fmt).options(**(options or {})).load(src)
    obs = Observation("load_rows")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("append").format("parquet").option("path", location)
     .saveAsTable(table))
    inserted = int(obs.get["rows"])
    total = spark.table(table).count() if count_table else None
    return {"table": table, "inserted_rows": inserted, "table_rows": total}


def step_evidence(spark: SparkSession, batch_id: str, flow: str, step: str,
                  result: StepResult, src: str, dst: str, dataset: str,
                  ts: str) -> DataFrame:
    """One evidence row for a finished conversion step."""
    note = result.error or (f"Converted {result.input_rows} rows to "
                            f"{result.output_rows} rows")
    row = (batch_id, "", flow, step, note, result.error, result.ok, ts,
           src, result.input_rows, dataset, dst, result.output_rows,
           "parquet")
    return spark.createDataFrame([row], (
        "batch_id string, test_id string, flow string, step string, "
        "note string, error string, ok boolean, ts string, input_s3 string, "
        "input_rows bigint, input_dataset string, output_s3 string, "
        "output_rows bigint, output_format string")).select(
        "batch_id", "test_id", "flow", "step", "note", "error", "ok",
        F.col("ts").try_cast("timestamp_ntz").alias("ts"),
        F.struct(F.col("input_s3").alias("s3"),
                 F.col("input_rows").alias("rows"),
                 F.col("input_dataset").alias("dataset")).alias("input"),
        F.struct(F.col("output_s3").alias("s3"),
                 F.col("output_rows").alias("rows"),
                 F.col("output_format").alias("format")).alias("output"))


def match_files(spark: SparkSession, files: DataFrame, root: str
                ) -> DataFrame:
    """(batch_id, key, path, file) of the listed files of each key below
    ``root``; a key names a file or a folder.  File-sized on both sides."""
    listed = list_files(spark, root).select(
        "path", below(bare_path(F.col("path")), root).alias("file"))
    parts = F.split("file", "/")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    names = listed.where("file is not null").select(
        "path", "file", F.explode(ancestors).alias("key"))
    return files.select("batch_id", "key").distinct().join(names, "key")


def _headers(spark: SparkSession, paths: list[str], root: str) -> DataFrame:
    """(file, header): the first line of every readable file."""
    lines = (spark.read.option("ignoreCorruptFiles", "true")
             .option("lineSep", "\n").text(paths))
    first = lines.select(
        below(bare_path(F.col("_metadata.file_path"), encoded=True), root)
        .alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.rtrim(F.col("value"), F.lit("\r")).alias("value"),
        F.monotonically_increasing_id().alias("no"))
    # Only the order within the first block of a file counts.
    return first.where("at = 0").groupBy("file").agg(
        F.min_by("value", "no").alias("header"))


CONVERTED = "src_file"


def file_column(columns: Iterable[str]) -> str:
    """Name of the column that holds a row's file: ``src_file``, with blank
    marks before it where the data have a column of that name."""
    taken, name = {c.lower() for c in columns}, CONVERTED
    while name in taken:
        name = "_" + name
    return name


def header_columns(header: str, case_sensitive: bool = False
                   ) -> tuple[list[str], str | None]:
    """Column names of a header line, and why a file with it can't be read
    (null: it can).  A column without a name is named by its place."""
    header = header.removeprefix("\ufeff")
    if not header.strip():
        return [], "header line is blank"
    if header.count('"') % 2:
        return [], "header has a line feed inside quotes"
    names = [n or f"_c{i}"
             for i, n in enumerate(next(csv.reader([header])))]
    seen = set()
    for n in names:
        key = n if case_sensitive else n.lower()
        if key in seen:
            return names, f"column {n} is repeated"
        seen.add(key)
    return names, None


def key_results(wanted: DataFrame, matched: DataFrame, errors: DataFrame,
                counts: DataFrame) -> DataFrame:
    """Result of each wanted (batch_id, key): its files' counts, FAILED with
    the first error where a file has one or none was found."""
    per_key = (matched.join(errors, "file", "left")
               .join(counts, F.col("file") == F.col(CONVERTED), "left")
               .groupBy("batch_id", "key").agg(
                   F.count_if(F.col("error").isNull()).alias("good"),
                   F.min("error").alias("error"),
                   F.sum("input_rows").alias("input_rows"),
                   F.sum("rows").alias("rows")))
    out = wanted.join(per_key, ["batch_id", "key"], "left")
    ok = F.coalesce(F.col("good") > 0, F.lit(False)) & F.col("error").isNull()
    return out.select(
        "batch_id", "key",
        F.when(ok, "SUCCEEDED").otherwise("FAILED").alias("job_state"),
        F.when(~ok, F.concat(F.lit("Error accessing "), F.col("key"),
                             F.coalesce(F.concat(F.lit(": "), F.col("error")),
                                        F.lit("")))).alias("error_message"),
        F.coalesce("input_rows", F.lit(0)).cast("bigint").alias("input_rows"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))


def convert_files(spark: SparkSession, files: DataFrame, root: str, dst: str,
                  schema: T.StructType | None = None,
                  transform: Transform = identity) -> DataFrame:
    """S1-S3 for every file of the batches ``(batch_id, key)`` below ``root``.

    A file whose header is blank, spans lines or repeats a column fails alone.
    Files are grouped by header line, each group is read with its own
    columns (one scan) and written partitioned by file; the row's file comes
    from the scan itself, so no data-sized join is needed.  With a schema,
    columns are taken by name and a file that lacks one fails; without one,
    all columns are text.  A key without a readable file is FAILED, the
    others go on.  An earlier output in ``dst`` is replaced as a whole.

    Returns per (batch_id, key): job_state, error_message, input_rows, rows.
    """
    matched = match_files(spark, files, root)
    found = matched.select("path", "file").distinct().collect()
    wanted = files.select("batch_id", "key").distinct()
    counts = spark.createDataFrame([], f"{CONVERTED} string, input_rows long,"
                                       " rows long")
    errors = spark.createDataFrame([], "file string, error string")
    if found:
        head = {r["file"]: r["header"]
                for r in _headers(spark, [r["path"] for r in found], root)
                .collect()}
        case = spark.conf.get("spark.sql.caseSensitive") == "true"
        groups: dict[str, list[tuple[str, str]]] = {}
        bad = []
        for r in found:
            if r["file"] in head:
                groups.setdefault(head[r["file"]], []).append(
                    (r["path"], r["file"]))
            else:
                bad.append((r["file"], "file is empty or unreadable"))
        readable = []
        for header, paths in sorted(groups.items()):
            names, problem = header_columns(header, case)
            missing = [] if schema is None else [
                f.name for f in schema.fields if f.name not in names]
            if problem is None and missing:
                problem = f"column {missing[0]} not found"
            if problem is None:
                readable.append((names, [path for path, _ in paths]))
            else:
                bad += [(file, problem) for _, file in paths]
        source = file_column(
            [f.name for f in schema.fields] if schema is not None
            else [n for names, _ in readable for n in names])
        parts = []
        for names, paths in readable:
            text = T.StructType([T.StructField(n, T.StringType())
                                 for n in names])
            own = file_column(names)     # here the data are as in the file
            rows = read_csv(spark, paths, text).withColumn(own, below(
                bare_path(F.col("_metadata.file_path"), encoded=True), root))
            kept = ([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                     for f in schema.fields] if schema is not None
                    else [F.col(f"`{n}`") for n in names])
            parts.append(rows.select(*kept, F.col(own).alias(source)))
        if parts:
            data = reduce(lambda a, b: a.unionByName(
                b, allowMissingColumns=True), parts)
            out = transform(data)
            (out.write.mode("overwrite")
             .option("partitionOverwriteMode", "static")
             .partitionBy(source).parquet(dst))
            written = spark.read.schema(out.schema).parquet(dst).groupBy(
                F.col(source).alias(CONVERTED)).agg(
                F.count(F.lit(1)).alias("rows"))
            # Without a transform every row read is a row written.
            read = (written.withColumnRenamed("rows", "input_rows")
                    if transform is identity else data.groupBy(
                        F.col(source).alias(CONVERTED))
                    .agg(F.count(F.lit(1)).alias("input_rows")))
            counts = read.join(written, CONVERTED, "left")
        errors = spark.createDataFrame(bad, "file string, error string")
    return key_results(wanted, matched, errors, counts)


def staged_rows(spark: SparkSession, dst: str, schema: T.StructType
                ) -> tuple[DataFrame, str]:
    """The converted rows below ``dst`` and the column that names their
    file."""
    source = file_column(f.name for f in schema.fields)
    full = T.StructType([*schema.fields,
                         T.StructField(source, T.StringType())])
    return spark.read.schema(full).parquet(dst), source


def load_converted_once(spark: SparkSession, files: DataFrame, root: str,
                        dst: str, location: str, schema: T.StructType
                        ) -> DataFrame:
    """S4 for converted batches, by the ledger at ``location``: what has been
    loaded for a batch is not loaded again.  Per (batch_id, key) the
    ``load_result`` payload as ``load_converted`` gives it."""
    staged, source = staged_rows(spark, dst, schema)
    matched = match_files(spark, files, root).select(
        "batch_id", "key", "file")
    loaded = load_ledger.load_once(staged, source, matched, location)
    per_key = matched.join(loaded.where("rows > 0"), ["batch_id", "file"]) \
        .groupBy("batch_id", "key").agg(
            F.sum("rows").alias("n"), F.sum("inserted_rows").alias("new"))
    return per_key.select("batch_id", "key", F.to_json(F.struct(F.to_json(
        F.struct(F.lit(True).alias("success"),
                 F.col("new").alias("inserted_rows"),
                 (F.col("n") - F.col("new")).alias("known_rows")))
        .alias("Payload"))).alias("load_result"))


def load_converted(spark: SparkSession, files: DataFrame, root: str,
                   dst: str, table: str, location: str,
                   schema: T.StructType, count_table: bool = True
                   ) -> DataFrame:
    """S4 for converted batches: one append of every file's output; per
    (batch_id, key) the ``load_result`` payload (JSON text) with the rows
    inserted and, if wanted, the table's total after the load (Q1)."""
    staged, source = staged_rows(spark, dst, schema)
    (staged.drop(source).write.mode("append").format("parquet")
     .option("path", location).saveAsTable(table))
    total = spark.table(table).count() if count_table else None
    per_file = staged.groupBy(F.col(source).alias(CONVERTED)).agg(F.count(F.lit(1)).alias("n"))
    per_key = (match_files(spark, files, root)
               .join(per_file, F.col("file") == F.col(CONVERTED))
               .groupBy("batch_id", "key").agg(F.sum("n").alias("n")))
    return per_key.select(
        "batch_id", "key", F.to_json(F.struct(F.to_json(F.struct(
            F.lit(True).alias("success"),
            F.col("n").alias("inserted_rows"),
            F.lit(total).cast("bigint").alias("table_rows")))
            .alias("Payload"))).alias("load_result"))
