"""File-manifest validation.

A manifest lists ``(bucket, key)`` per batch; a listing (from the file
system or an inventory table) gives ``file_size`` and ``last_modified``.
The manifest is joined to the listing on the file key (equi, left outer):
both sides are file-sized, so Spark picks the join strategy from sizes
(AQE turns a small listing into a broadcast at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.scalar import object_uri
from runledger.sources.files import bare_path, below

# The size limit (strictly greater fails), the accepted
# suffix (case-insensitive) and the reason texts.
MAX_FILE_BYTES = 1024 * 1024 * 1024
CSV_SUFFIX = ".csv"
REASON_ABSENT = "Error accessing %s: object not found"
REASON_TOO_LARGE = "File too large: %s (%d bytes)"
REASON_NOT_CSV = "Not a CSV file: %s"


def explode_manifest(manifests: DataFrame) -> DataFrame:
    """One row per manifest entry with its 0-based position."""
    return manifests.select(
        "batch_id",
        F.posexplode(F.coalesce(F.col("files"), F.array()))
        .alias("file_index", "file")).select(
        "batch_id", "file_index", F.col("file.bucket").alias("bucket"),
        F.col("file.key").alias("key"))


def listing_from_files(files: DataFrame, bucket: str, root: str
                       ) -> DataFrame:
    """Turn an S7 listing into ``bucket, key, file_size, last_modified``;
    the key is the path below ``root``."""
    key = below(bare_path(F.col("path")), root)
    return files.select(F.lit(bucket).alias("bucket"), key.alias("key"),
                        F.col("length").alias("file_size"),
                        F.col("modification_time").alias("last_modified"))


def rejection_reason(key: Column, size: Column, found: Column,
                     max_bytes: int = MAX_FILE_BYTES) -> Column:
    """Absent, then too large, then wrong suffix; first reason wins."""
    return (F.when(~found, F.format_string(REASON_ABSENT, key))
            .when(size > F.lit(max_bytes),
                  F.format_string(REASON_TOO_LARGE, key, size))
            .when(~F.lower(key).endswith(CSV_SUFFIX),
                  F.format_string(REASON_NOT_CSV, key)))


def validate_files(entries: DataFrame, listing: DataFrame,
                   max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """J1 + P2: each manifest entry with ``found``, ``file_size``,
    ``reason`` (null when valid) and ``valid``."""
    listed = listing.select("bucket", "key", "file_size", "last_modified",
                            F.lit(True).alias("_found"))
    joined = entries.join(listed, ["bucket", "key"], "left")
    found = F.coalesce(F.col("_found"), F.lit(False))
    reason = rejection_reason(F.col("key"), F.col("file_size"), found,
                              max_bytes)
    return joined.select(
        "batch_id", "file_index", "bucket", "key",
        object_uri("bucket", "key").alias("uri"),
        found.alias("found"),
        F.coalesce(F.col("file_size"), F.lit(0)).cast("bigint")
        .alias("file_size"),
        "last_modified",
        reason.alias("reason"),
        reason.isNull().alias("valid"))


def validation_totals(checked: DataFrame,
                      batches: DataFrame | None = None) -> DataFrame:
    """A1 per batch.  Rejected files still add to ``total_size_bytes``;
    success needs no errors and at least one valid file.  ``batches``
    (e.g. the manifests) keeps batches whose file list is empty."""
    out = checked.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("files_count"),
        F.sum("file_size").cast("bigint").alias("total_size_bytes"),
        F.count_if("valid").alias("validated_files"),
        F.count_if(~F.col("valid")).alias("error_count"))
    if batches is not None:
        out = (batches.select("batch_id").distinct()
               .join(out, "batch_id", "left")
               .select("batch_id", *[F.coalesce(c, F.lit(0)).cast("bigint")
                                     .alias(c) for c in (
                                         "files_count", "total_size_bytes",
                                         "validated_files", "error_count")]))
    return out.withColumn(
        "success", (F.col("error_count") == 0) & (F.col("validated_files") > 0))


def valid_files(checked: DataFrame) -> DataFrame:
    """Q4: the entries that go on to conversion -- only validated files
    (invalid ones still fail the batch through ``validation_totals`` and the
    failure list)."""
    return checked.where(F.col("valid")).select(
        "batch_id", "file_index", "bucket", "key", "uri", "file_size")
