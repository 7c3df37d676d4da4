"""Evidence store (S12, S13), summary sink (S14), raw-envelope archive
and the log-envelope source (S15).

Evidence and summaries are append-only Parquet datasets, partitioned by a hash
bucket of the batch id.  The number of folders is fixed, however many batches
there are, and the batch id is an ordinary text column (folder names would be
read back as numbers where they look like some).  Reading a set of batches is
a semi join on bucket and batch id, so partitions are pruned at run time.

Appends are at-least-once.  Readers of the evidence keep the latest delivery
of each event, readers of the summaries the latest version of each batch, so
replays and corrections need no rewriting.  Every append is a part of a table
with a log (``snapshots``); compaction packs small parts and drops versions
that no reader would choose, in one step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger import schemas
from runledger.operators.evidence import dedup_events
from runledger.operators.keyed import latest_per_key
from runledger.sources import snapshots

BUCKETS = 64
STORED = "stored_version"   # version under which an evidence row was stored


def bucket(batch_id: Column) -> Column:
    return F.pmod(F.xxhash64(batch_id), F.lit(BUCKETS)).cast("int")


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Log-event envelopes, one JSON document per line (``.json.gz``
    files are decompressed by the reader)."""
    return spark.read.schema(schemas.LOG_ENVELOPE).json(path)


def archive_raw(spark: SparkSession, src: str, dst: str) -> None:
    """Keep the raw envelopes as received (compressed text)."""
    (spark.read.text(src).write.mode("append")
     .option("compression", "gzip").text(dst))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The archived envelopes, parsed like newly arrived ones."""
    return read_envelopes(spark, path)


def append_rows(rows: DataFrame, path: str, gather: bool = True) -> None:
    """Append rows as a part of a table (``snapshots``); those with a batch
    id go to its bucket."""
    if "batch_id" in rows.columns:
        snapshots.append(rows.withColumn("bucket", bucket(
            F.col("batch_id"))), path, "bucket", gather)
    else:
        snapshots.append(rows, path)


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a table's present state; none while it has no part."""
    return snapshots.read(spark, path, schema)


def compact_evidence(spark: SparkSession, store: str, **limits) -> int:
    """Pack the small parts of an evidence store, deliveries unchanged."""
    return snapshots.compact(spark, store, "bucket", **limits)


def compact_versions(spark: SparkSession, path: str, schema: str | None,
                     key: list[str], before: int | None = None, **limits
                     ) -> int:
    """Pack the small parts of a table in versions.  Of the versions below
    ``before`` (all if none) only the latest of each key stays."""
    def fold(rows: DataFrame) -> DataFrame:
        if before is None:
            return latest_per_key(rows, key, ["version"])
        old = rows.where(F.col("version") < before)
        return latest_per_key(old, key, ["version"]).unionByName(
            rows.where(F.col("version") >= before))

    return snapshots.compact(spark, path, "bucket", fold, schema=schema,
                             **limits)


def append_evidence(evidence: DataFrame, store: str, version: int = 0,
                    gather: bool = True) -> None:
    """Append evidence rows, under the version of their writer (without
    ``gather``: as each task has them, see ``snapshots.append``)."""
    # The record is kept as the delivered text (``raw_message``); the
    # nested struct is an in-flight convenience and is not stored twice.
    rows = evidence.drop("evidence") if "evidence" in evidence.columns \
        else evidence
    append_rows(rows.withColumn(STORED, F.lit(version).cast("bigint")), store,
                gather)


def restrict_to_batches(df: DataFrame, batches: DataFrame | None
                        ) -> DataFrame:
    """Rows of the given batches (all if None): a semi join whose bucket
    column prunes partitions at run time."""
    if batches is None:
        return df
    ids = batches.select("batch_id").distinct().withColumn(
        "bucket", bucket(F.col("batch_id")))
    return df.join(ids, ["bucket", "batch_id"], "left_semi")


def read_evidence(spark: SparkSession, store: str,
                  batches: DataFrame | None = None,
                  dedup: bool = True,
                  columns: list[str] | None = None,
                  before: int | None = None) -> DataFrame:
    """Stored evidence, optionally of some batches only, with the latest
    delivery of each event.  ``columns`` limits the columns read (Parquet
    column pruning) and carried by the de-dup; ``before`` leaves out rows
    stored under that or a later version."""
    df = restrict_to_batches(snapshots.read(spark, store), batches)
    if before is not None:
        df = df.where(F.col(STORED) < before)
    df = df.drop("bucket", STORED)
    if columns:
        df = df.select(*columns)
    return dedup_events(df) if dedup else df


SUMMARY_SCHEMA = (
    "batch_id string, input_files bigint, input_rows bigint, "
    "output_files bigint, output_rows bigint, redshift_loaded bigint, "
    "steps bigint, failures bigint, started timestamp_ntz, "
    "ended timestamp_ntz, status string")
VERSIONED_SUMMARY = SUMMARY_SCHEMA + ", version bigint, bucket int"


def write_summaries(summaries: DataFrame, path: str, version: int = 0
                    ) -> None:
    """Append one version of the given batches' summaries."""
    append_rows(summaries.withColumn(
        "version", F.lit(version).cast("bigint")), path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The latest summary of every batch.  The schema is given, so a table
    without a finalized batch reads as empty."""
    rows = read_rows(spark, path, VERSIONED_SUMMARY).drop("bucket")
    return latest_per_key(rows, ["batch_id"], ["version"]).drop("version")


# Detail tables: one long row per step and per failure, beside the summaries.
def write_details(details: DataFrame, path: str, version: int = 0) -> None:
    """Append one version of step rows (``step_details`` with signals)."""
    append_rows(details.withColumn(
        "version", F.lit(version).cast("bigint")), path)


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """The latest step rows of every batch that has a terminal event."""
    rows = latest_per_key(snapshots.read(spark, path), [
        "bucket", "batch_id", "step", "event_id"], ["version"])
    ended = rows.where("is_terminal").select("bucket", "batch_id").distinct()
    return rows.join(ended, ["bucket", "batch_id"], "left_semi").where(
        "not is_signal").drop("bucket", "version", "is_signal",
                              "is_terminal")
