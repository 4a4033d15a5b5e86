"""What a built folder holds: file listing, table names, reads by name."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` as ``(file, n_bytes)`` with relative names; no file is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = F.lit(path.removeprefix("file://").removeprefix("file:").rstrip("/") + "/")
    relative = F.element_at(F.split("path", F.concat(F.lit(r"\Q"), root, F.lit(r"\E")), 2), -1)
    return files.select(relative.alias("file"), F.col("length").alias("n_bytes"))


def configs(spark: SparkSession, path: str) -> list[str]:
    """Names of the tables of a study folder (one folder per table)."""
    names = listing(spark, path).filter(F.col("file").endswith(".parquet"))
    first = names.select(F.substring_index("file", "/", 1).alias("name")).distinct()
    return sorted(r["name"] for r in first.collect())


def timelines(spark: SparkSession, path: str) -> list[str]:
    return [n for n in configs(spark, path) if n.startswith("timeline_")]


def table(spark: SparkSession, path: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One table; only ``columns`` are read."""
    df = spark.read.parquet(f"{path.rstrip('/')}/{name}")
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def patients(df: DataFrame, key: str) -> Iterator[Row]:
    """Rows in key order, one partition at a time on the driver."""
    return df.orderBy(key).toLocalIterator()
