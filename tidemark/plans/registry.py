"""Registry of named queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.check_tables import with_tables
from tidemark.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register ``fn(Tables) -> DataFrame`` under ``name`` with its SQL check."""
    from tidemark.plans.tables import Tables

    def register(fn: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(use_utc(spark), sf_dir))
        if sql is not None:
            CHECKS[name] = with_tables(sql)
        return fn

    return register
