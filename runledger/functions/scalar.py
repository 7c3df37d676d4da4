"""Scalar column functions (F1-F13 and the log-level classifier).

All are compositions of built-in Spark functions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's behaviour for identical
# results, so they are stated here plainly and together.
# ---------------------------------------------------------------------------
SAFE_NAME_RUN = r"[^0-9A-Za-z._/-]+"          # runs replaced by "_"
SAFE_NAME_DEFAULT = "unknown"
LOG_LEVEL_ORDER = ("ERROR", "WARN", "INFO", "DEBUG")   # first match wins
OTHER_LEVEL = "OTHER"
ERROR_LEVELS = ("ERROR", "WARN")               # "errors" = ERROR + WARN
COMPONENT_TYPES = {
    "prevalidate": "Lambda関数",
    "glue_convert": "AWS Glue Job",
    "redshift_load": "Lambda関数",
    "finalize": "Lambda関数",
    "monitoring": "Lambda関数",
}
COMPONENT_DEFAULT = "その他のAWSサービス"
FILE_TYPES = (("csv", ".csv", "CSVファイル"),
              ("parquet", ".parquet", "Parquetファイル"),
              ("json", ".json", "JSONファイル"))
FILE_TYPE_DEFAULT = "ファイル"
STEP_DISPLAY_NAMES = {
    "prevalidate": "事前検証",
    "glue_convert": "Glue変換",
    "redshift_load": "Redshiftロード",
    "finalize": "終了処理",
    "monitoring": "監視処理",
}
DURATION_FORMATS = ("%d秒", "%d分%d秒", "%d時間%d分")
CELL_NULL_TEXT = "NULL"
CELL_MAX_CHARS = 50
CELL_KEEP_CHARS = 47
CELL_ELLIPSIS = "..."
TTL_SECONDS = 30 * 24 * 60 * 60
URI_FORMAT = "s3://%s/%s"
BATCH_ID_TIME_FORMAT = "yyyyMMddHHmm"
# Python's str.isspace() set, so "blank line" means what line.strip() means.
NON_BLANK = (r"[^\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
             r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(mapping: dict[str, str]) -> Column:
    items = []
    for key, value in mapping.items():
        items += [F.lit(key), F.lit(value)]
    return F.create_map(*items)


# F1 ------------------------------------------------------------------------
def safe_name(c: Column | str) -> Column:
    """Runs outside ``[0-9A-Za-z._/-]`` become ``_``; empty/null -> unknown."""
    c = _col(c)
    return F.regexp_replace(
        F.coalesce(F.nullif(c, F.lit("")), F.lit(SAFE_NAME_DEFAULT)),
        SAFE_NAME_RUN, "_")


# F2 ------------------------------------------------------------------------
def component_type(step: Column | str) -> Column:
    return F.coalesce(_literal_map(COMPONENT_TYPES)[_col(step)],
                      F.lit(COMPONENT_DEFAULT))


# F3 ------------------------------------------------------------------------
def file_type(path: Column | str) -> Column:
    """Substring test in the fixed order csv, parquet, json."""
    path = _col(path)
    out = None
    for _, needle, label in FILE_TYPES:
        cond = path.contains(needle)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.lit(FILE_TYPE_DEFAULT))


# F4 ------------------------------------------------------------------------
def step_display_name(step: Column | str) -> Column:
    step = _col(step)
    return F.coalesce(_literal_map(STEP_DISPLAY_NAMES)[step], step)


# F5 ------------------------------------------------------------------------
def cell_display(c: Column | str) -> Column:
    """null -> NULL; longer than 50 characters -> first 47 + '...'."""
    text = F.coalesce(_col(c).cast("string"), F.lit(CELL_NULL_TEXT))
    return (F.when(F.length(text) > CELL_MAX_CHARS,
                   F.concat(F.substring(text, 1, CELL_KEEP_CHARS),
                            F.lit(CELL_ELLIPSIS)))
            .otherwise(text))


# F6 ------------------------------------------------------------------------
def object_uri(bucket: Column | str, key: Column | str) -> Column:
    return F.format_string(URI_FORMAT, _col(bucket), _col(key))


# F7 ------------------------------------------------------------------------
def default_batch_id(batch_id: Column | str, prefix: str,
                     clock: Column | str) -> Column:
    """``batch_id`` or ``prefix`` + minute timestamp of the clock value."""
    return F.coalesce(
        F.nullif(_col(batch_id), F.lit("")),
        F.concat(F.lit(prefix),
                 F.date_format(_col(clock), BATCH_ID_TIME_FORMAT)))


def epoch_batch_id(batch_id: Column | str, prefix: str,
                   clock: Column | str) -> Column:
    """``batch_id`` or ``prefix`` + epoch seconds of the clock value."""
    return F.coalesce(
        F.nullif(_col(batch_id), F.lit("")),
        F.concat(F.lit(prefix), F.unix_timestamp(
            _col(clock).cast("timestamp")).cast("string")))


# F8 ------------------------------------------------------------------------
def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, 0.0 when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(_col(num).cast("double"),
                                   _col(den).cast("double")),
                      F.lit(0.0))


# F9 ------------------------------------------------------------------------
def try_int(c: Column | str) -> Column:
    """Integer value of a text cell, null when it is not an integer."""
    return _col(c).try_cast("bigint")


def int_or_text(c: Column | str) -> Column:
    """The cell as a struct: its integer if it is one, else its text."""
    c = _col(c)
    number = c.try_cast("bigint")
    return F.struct(number.alias("number"),
                    F.when(number.isNull(), c).alias("text"))


# F10 -----------------------------------------------------------------------
def duration_text(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two timestamps rendered by size."""
    secs = F.timestamp_diff("SECOND", _col(start), _col(end))
    short_fmt, mid_fmt, long_fmt = DURATION_FORMATS
    return (F.when(secs < 60, F.format_string(short_fmt, secs))
            .when(secs < 3600, F.format_string(mid_fmt, F.floor(secs / 60),
                                               secs % 60))
            .otherwise(F.format_string(long_fmt, F.floor(secs / 3600),
                                       F.floor((secs % 3600) / 60))))


# F11 -----------------------------------------------------------------------
def ttl_epoch(clock: Column | str, seconds: int = TTL_SECONDS) -> Column:
    """Epoch seconds of the clock value plus the time to live."""
    return F.unix_timestamp(_col(clock).cast("timestamp")) + F.lit(seconds)


# F12 -----------------------------------------------------------------------
def json_encode(c: Column | str) -> Column:
    return F.to_json(_col(c))


# F13 -----------------------------------------------------------------------
def note_text(*parts: Column) -> Column:
    """Parts joined with ' | '; null parts are skipped."""
    return F.concat_ws(" | ", *parts)


# Log levels (P9, P10) ------------------------------------------------------
def is_non_blank(line: Column | str) -> Column:
    return _col(line).rlike(NON_BLANK)


def log_level(line: Column | str) -> Column:
    """ERROR, WARN, INFO, DEBUG by case-insensitive substring, first match
    wins; OTHER for any other non-blank line; null for blank lines."""
    line = _col(line)
    upper = F.upper(line)
    out = None
    for level in LOG_LEVEL_ORDER:
        cond = upper.contains(level)
        out = F.when(cond, level) if out is None else out.when(cond, level)
    return out.when(is_non_blank(line), OTHER_LEVEL)
