"""Partitioned Parquet tables, partial rebuilds, table registry."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows per row group by table width: nested rows, wide tables, narrow long tables.
ROW_GROUPS = {"nested": 50, "wide": 100_000, "long": 1_000_000}
MAX_ROWS_PER_FILE = 20_000_000


def write_table(
    df: DataFrame, path: str, width: str = "long", partition_by: str | None = None,
    mode: str = "overwrite", only_named_partitions: bool = False, skip_empty: bool = False,
) -> int:
    """Write one table, zstd-compressed, and return its row count.

    The count is observed during the write, so the table is not read again. With
    ``only_named_partitions`` partitions absent from ``df`` stay as they are.
    """
    if skip_empty and df.isEmpty():
        return 0
    seen = Observation()
    w = (
        df.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", ROW_GROUPS[width])
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    )
    if partition_by:
        w = w.partitionBy(partition_by)
        if only_named_partitions:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return seen.get["n"]


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_folds(folds: DataFrame, path: str, columns: Iterable[str] = ("fold_10", "fold_5")) -> int:
    """Folds are stored as one-byte integers."""
    return write_table(folds.withColumns({c: F.col(c).cast("tinyint") for c in columns}), path, "wide")


def require_pinned(spark: SparkSession, path: str, sha256: str) -> None:
    """Refuse a source file whose bytes are not the pinned ones."""
    row = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h")).first()
    if row is None or row["h"] != sha256:
        raise ValueError(f"{path}: content is not the pinned source")


def pin(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def write_bundle(frames: dict[str, DataFrame], path: str, width: str = "wide") -> dict[str, int]:
    """One folder per frame (a sheet or study file); field metadata is kept."""
    return {name: write_table(df, f"{path}/{name}", width) for name, df in frames.items()}


@dataclass
class TableRegistry:
    """Lazy table builders with dependencies; only wanted tables are ever planned."""

    builders: dict[str, tuple[Callable[[dict[str, DataFrame]], DataFrame], tuple[str, ...]]] = field(default_factory=dict)

    def table(self, name: str, needs: tuple[str, ...] = ()):
        def wrap(fn):
            self.builders[name] = (fn, needs)
            return fn

        return wrap

    def build(self, only: Iterable[str] | None = None) -> dict[str, DataFrame]:
        wanted = list(self.builders) if only is None else list(only)
        unknown = sorted(set(wanted) - set(self.builders))
        if unknown:
            raise ValueError(f"unknown tables: {', '.join(unknown)}")
        done: dict[str, DataFrame] = {}

        def make(name: str) -> DataFrame:
            if name not in done:
                fn, needs = self.builders[name]
                done[name] = fn({n: make(n) for n in needs})
            return done[name]

        for name in wanted:
            make(name)
        return done
