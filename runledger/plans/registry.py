"""Registry of driver queries and their DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the provided
tables.  A query registered without SQL is checked by row count only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    operators: tuple[str, ...]


_QUERIES: dict[str, Query] = {}


def register(name: str, operators: str, sql: str | None = None
             ) -> Callable[[QueryFn], QueryFn]:
    """Decorator: register ``fn`` under ``name`` with its oracle SQL."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = Query(name, fn, sql.strip() if sql else None,
                               tuple(operators.split()))
        return fn
    return wrap


def all_queries() -> dict[str, Query]:
    # Import the modules that register queries (order = display order).
    from runledger.plans import (  # noqa: F401
        csv_queries, emitter_queries, evidence_queries, json_queries,
        log_queries)
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table; columns are pruned by the callers' selects."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
