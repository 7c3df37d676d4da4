"""File listing (S7, S9) and log text (S8) sources.

The listing uses the ``binaryFile`` source but selects only metadata
columns, so file contents are never read.  Log text is read with the text
source split on ``\\n`` only (a ``\\r`` stays in the line, as with
``str.split('\\n')``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes the log collector accepts (case-sensitive).
LOG_SUFFIXES = (".log", ".txt")
LOG_GLOB = "*.{log,txt}"


def bare_path(col: Column, encoded: bool = False) -> Column:
    """A path without scheme, authority and trailing slashes.  Spark gives
    ``_metadata.file_path`` percent-encoded and listings plain; ``+`` is an
    ordinary character in both."""
    if encoded:
        col = F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(
        F.regexp_replace(col, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""),
        r"/+$", "")


def below(path: Column, root: str) -> Column:
    """The part of a bare path below ``root``; null elsewhere."""
    base = bare_path(F.lit(root))
    return F.when(path.startswith(F.concat(base, F.lit("/"))), F.substring(
        path, F.length(base) + 2, F.lit(1 << 30)))


def list_files(spark: SparkSession, root: str,
               glob: str | None = None) -> DataFrame:
    """path, name, length, modification_time of every file below ``root``.

    Zero-byte files are not listed by this source.
    """
    reader = (spark.read.format("binaryFile")
              .option("recursiveFileLookup", "true"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (reader.load(root)
            .select(F.col("path"),
                    F.regexp_extract("path", r"([^/]*)$", 1).alias("name"),
                    F.col("length"),
                    F.col("modificationTime").alias("modification_time")))


def log_file_filter(listing: DataFrame) -> DataFrame:
    """Name ends in .log or .txt (case-sensitive) and size > 0."""
    cond = F.lit(False)
    for suffix in LOG_SUFFIXES:
        cond = cond | F.col("name").endswith(suffix)
    return listing.where(cond & (F.col("length") > 0))


def newest_files(listing: DataFrame, k: int) -> DataFrame:
    """Newest first (ties by path), first ``k`` (TakeOrderedAndProject)."""
    return listing.orderBy(F.col("modification_time").desc(),
                           F.col("path").asc()).limit(k)


# Well-formed UTF-8 sequences (Unicode, table 3-7), a byte for each sign, or
# one byte that belongs to none.
UTF8_STEP = (
    r"([\x00-\x7F]++|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]"
    r"|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
    r"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}"
    r"|\xF4[\x80-\x8F][\x80-\xBF]{2})|[\x80-\xFF]")


def valid_text(text: Column) -> Column:
    """Text without the bytes that are no UTF-8; all others stay, a U+FFFD
    of the text itself too.  Valid text is only looked through."""
    signs = F.decode(text.cast("binary"), "ISO-8859-1")
    kept = F.encode(F.regexp_replace(signs, UTF8_STEP, "$1"), "ISO-8859-1")
    return F.when(F.is_valid_utf8(text), text).otherwise(kept.cast("string"))


def read_log_lines(spark: SparkSession, root: str,
                   newest_k: int | None = None) -> DataFrame:
    """One row per ``\\n``-separated line with the file it came from,
    without bytes that are no UTF-8.

    Without a cap every log file below ``root`` is scanned in one
    multi-file scan (the glob filter is the P8 suffix rule; empty files
    produce no rows).  With a cap the newest ``k`` files are chosen from the
    listing first; ``k`` bounds the path list held on the driver.
    """
    reader = (spark.read.option("lineSep", "\n")
              .option("recursiveFileLookup", "true"))
    if newest_k is None:
        df = reader.option("pathGlobFilter", LOG_GLOB).text(root)
    else:
        chosen = newest_files(log_file_filter(list_files(spark, root)),
                              newest_k)
        paths = [r.path for r in chosen.select("path").collect()]
        if not paths:
            return spark.createDataFrame([], "file string, line string")
        df = spark.read.option("lineSep", "\n").text(paths)
    return df.select(
        bare_path(F.col("_metadata.file_path"), encoded=True).alias("file"),
        valid_text(F.col("value")).alias("line"))
