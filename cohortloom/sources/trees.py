"""Nested case trees stored as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_case_tree(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """One row per case under an explicit schema, so an absent key is null.

    The original layout is one JSON array per project (``multi_line``); JSON
    lines split across tasks and are preferred for anything large.
    """
    return spark.read.schema(schema).json(path, multiLine=multi_line, mode="FAILFAST")
