"""The query catalog: one Spark callable and (when SQL can say it) one DuckDB
oracle text per key.  Modules under ``framewise.plans`` register into it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle_fixtures import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None, fixtures: tuple[str, ...] = ()):
    """Decorator: ``@register("key", sql="SELECT …", fixtures=("survey",))``."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_fixtures(sql, *fixtures) if fixtures else sql.strip()
        return fn

    return deco
