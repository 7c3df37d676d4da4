"""Loads that can be retried (S4): staged files, a ledger, one commit marker.

A load appends the rows of staged files for the batches that want them and
then writes one marker, a single file with a row for every (batch, file,
content) it loaded.  What stands in the ledger is not loaded again, so a
repeated run inserts nothing; a file whose content has changed is new.

Rows lie in folders of their load and file.  Readers take only what the ledger
names, so rows of a load that ended before its marker are never seen, and a
retry writes them anew under another load.  Where two runs load the same at the
same time, the first marker counts for each (batch, file, content).

A file's content is known by its number of rows and two order-free sums over
the hashes of its rows, taken in one scan of the staged files (rows that come
in another order are the same content).  Files and markers are small beside
the rows: every join here but the last, a semi join on partition folders, is
between tables with a row for each file.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.session import materialized

LEDGER = ("batch_id string, file string, content string, rows bigint, "
          "load_id string, committed_at bigint")
LOAD, FILE = "_load_id", "_load_file"   # partition folders of the rows
KEY = ["batch_id", "file", "content"]


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet folder; empty while nothing has been written to it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, location: str) -> DataFrame:
    """Every committed (batch_id, file, content) with its load."""
    return _read(spark, f"{location}/ledger", LEDGER)


def contents(staged: DataFrame, file: str) -> DataFrame:
    """(file, rows, content) of every staged file."""
    cells = [F.col(f"`{c}`") for c in staged.columns if c != file]
    wide = "decimal(20,0)"
    sums = [F.sum(F.xxhash64(F.lit(k), *cells).cast(wide)) for k in (1, 2)]
    return staged.groupBy(F.col(file).alias("file")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws(":", F.count(F.lit(1)), *sums).alias("content"))


def load_once(staged: DataFrame, file: str, wanted: DataFrame, location: str,
              before_commit: Callable[[str], None] | None = None
              ) -> DataFrame:
    """Append what ``wanted`` (batch_id, file) names of the ``staged`` rows
    (column ``file`` names their file) and the ledger does not hold yet.

    A file that several batches of this call want is appended once.  Returns
    (batch_id, file, rows, inserted_rows): a wanted file without staged rows
    has none; what had been loaded before has inserted 0.  ``before_commit``
    is called between the append and the marker."""
    spark = staged.sparkSession
    if {LOAD.lower(), FILE.lower()} & {c.lower() for c in staged.columns
                                       if c != file}:
        raise ValueError(f"{LOAD} and {FILE} name the load's own folders")
    wanted = wanted.select("batch_id", "file").distinct()
    asked = materialized(wanted.join(contents(staged, file), "file"),
                         "load-asked")
    fresh = materialized(asked.join(read_ledger(spark, location), KEY,
                                    "left_anti"), "load-fresh")
    load_id = uuid.uuid4().hex
    if fresh.limit(1).count():
        names = fresh.select(F.col("file").alias(file)).distinct()
        (staged.join(names, file, "left_semi")
         .withColumn(LOAD, F.lit(load_id)).withColumnRenamed(file, FILE)
         .write.mode("append").partitionBy(LOAD, FILE)
         .parquet(f"{location}/rows"))
        if before_commit is not None:
            before_commit(load_id)
        # One file: the load is committed as a whole or not at all.
        (fresh.select(*KEY, "rows", F.lit(load_id).alias("load_id"),
                      F.lit(time.time_ns()).cast("bigint")
                      .alias("committed_at"))
         .coalesce(1).write.mode("append").parquet(f"{location}/ledger"))
    new = fresh.select(*KEY, F.col("rows").alias("n"))
    return wanted.join(asked.join(new, KEY, "left"), ["batch_id", "file"],
                       "left").select(
        "batch_id", "file", F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("n", F.lit(0)).alias("inserted_rows"))


def live_loads(spark: SparkSession, location: str) -> DataFrame:
    """(load, file) folders that count: the first committed load of each
    (batch, file, content)."""
    first = read_ledger(spark, location).groupBy(*KEY).agg(
        F.min(F.struct("committed_at", "load_id")).alias("first"))
    return first.select(F.col("first.load_id").alias(LOAD),
                        F.col("file").alias(FILE)).distinct()


def read_loaded(spark: SparkSession, location: str, schema: T.StructType,
                with_file: bool = False) -> DataFrame:
    """The rows of the loaded table, if wanted with the file of each."""
    full = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType()),
                         T.StructField(FILE, T.StringType())])
    rows = _read(spark, f"{location}/rows", full).join(
        live_loads(spark, location), [LOAD, FILE], "left_semi")
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields],
                       *[FILE] * with_file)
