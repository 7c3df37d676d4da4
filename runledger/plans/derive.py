"""Derivations that turn the provided tables into the reference's inputs.

Each function here maps whole tables (no sampling, no id subsets) to the
shape an operator expects: log lines, JSON items, manifests, log events.
The matching SQL fragments used by the oracles live next to them so the
two stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event types renamed to log-level words so that every level
# occurs in the generated lines; other types keep their own name.
EVENT_LEVEL_WORDS = {"view": "debug", "click": "info", "signup": "warn"}


def _mapped(col: Column, mapping: dict[str, str]) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*items)[col], col)


def event_line(events: DataFrame) -> Column:
    word = _mapped(F.col("event_type"), EVENT_LEVEL_WORDS)
    return F.concat(F.col("event_id").cast("string"), F.lit(" "), word,
                    F.lit(" "), F.col("props"))


EVENT_LINE_SQL = (
    "CAST(event_id AS VARCHAR) || ' ' || CASE event_type "
    "WHEN 'view' THEN 'debug' WHEN 'click' THEN 'info' "
    "WHEN 'signup' THEN 'warn' ELSE event_type END || ' ' || props")

# DuckDB expression for the log level of a column ``line`` (same rules).
LEVEL_SQL = (
    "CASE WHEN upper(line) LIKE '%ERROR%' THEN 'ERROR' "
    "WHEN upper(line) LIKE '%WARN%' THEN 'WARN' "
    "WHEN upper(line) LIKE '%INFO%' THEN 'INFO' "
    "WHEN upper(line) LIKE '%DEBUG%' THEN 'DEBUG' "
    "WHEN regexp_matches(line, '[^\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}"
    "\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}"
    "\\x{3000}]') THEN 'OTHER' END")

PROFILE_SQL = (
    "CAST(count(level) AS BIGINT) AS lines, "
    "CAST(count_if(level IN ('ERROR', 'WARN')) AS BIGINT) AS errors, "
    "CAST(count_if(level = 'ERROR') AS BIGINT) AS error_count, "
    "CAST(count_if(level = 'WARN') AS BIGINT) AS warn_count, "
    "CAST(count_if(level = 'INFO') AS BIGINT) AS info_count, "
    "CAST(count_if(level = 'DEBUG') AS BIGINT) AS debug_count, "
    "CAST(count_if(level = 'OTHER') AS BIGINT) AS other_count")
