"""Registry of queries and their SQL oracles (filled by the ``q_*`` modules)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradestar.plans.sql import with_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None, raw_sql: bool = False):
    """Bind ``key`` to a Spark callable and (optionally) its DuckDB SQL. The
    SQL is prefixed with the shared stand-in CTEs unless ``raw_sql``."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip() if raw_sql else with_ctes(sql)
        return fn
    return deco
