"""Queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = (
    "language_id", "decontaminate", "fingerprint", "licenses", "substring_dedup", "line_dedup", "packing",
    "jaccard_join", "pseudo_likelihood", "secrets", "top_k", "runs", "filter_audit",
)


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    for module in MODULES:
        import_module(f"cohortloom.llm.{module}")
