"""Registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`~cohortloom.plans.views.Tables` under ``name``."""

    def wrap(fn):
        from cohortloom.plans.views import Tables

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf: fn(Tables(spark, sf))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
