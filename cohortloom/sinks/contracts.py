"""Tables with fixed schemas: what a table's columns must be, what it is made of, and how it is written."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortloom.sinks.writer import write_table
from cohortloom.sources.typed import schema_differences

Builder = Callable[[dict[str, DataFrame]], DataFrame]


@dataclass
class FixedTable:
    """A builder over the tables it ``needs``, and the contract for what it returns.

    ``flexible`` names struct columns whose fields follow the data; all others must have the declared type at every level. ``inner``
    tables are built for others and not written.
    """

    schema: T.StructType
    build: Builder
    needs: tuple[str, ...] = ()
    width: str = "long"
    partition_by: str | None = None
    flexible: tuple[str, ...] = ()
    inner: bool = False

    def refuse_other(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with its columns in the declared order; a column unknown, missing or of another type is refused."""
        own = T.StructType([f for f in df.schema.fields if f.name not in self.flexible])
        found = schema_differences(own, self.schema)
        if len(set(df.columns)) != len(df.columns):
            found.append("repeated columns")
        if found:
            raise ValueError(f"table {name}: {'; '.join(found)}")
        return df.select(*self.schema.names, *[c for c in self.flexible if c in df.columns])


@dataclass
class Contracts:
    """A dependency graph of fixed tables; only what is wanted, and what that needs, is planned."""

    tables: dict[str, FixedTable] = field(default_factory=dict)

    def add(self, name: str, schema: str | T.StructType, **more):
        """Register the decorated builder of table ``name``."""
        kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

        def wrap(build: Builder) -> Builder:
            if name in self.tables:
                raise ValueError(f"table {name} registered twice")
            self.tables[name] = FixedTable(kind, build, **more)
            return build

        return wrap

    def order(self, only: Iterable[str] | None = None) -> list[str]:
        """Wanted tables and all they need, each after its needs. Unknown names and circles are refused."""
        wanted = [n for n, t in self.tables.items() if not t.inner] if only is None else list(only)
        known = set(self.tables)
        unknown = sorted({n for n in wanted if n not in known} | {n for t in self.tables.values() for n in t.needs if n not in known})
        if unknown:
            raise ValueError(f"unknown tables: {', '.join(unknown)}")
        out: list[str] = []

        def visit(name: str, above: tuple[str, ...]) -> None:
            if name in above:
                raise ValueError(f"tables need each other: {' > '.join((*above, name))}")
            if name not in out:
                for n in self.tables[name].needs:
                    visit(n, (*above, name))
                out.append(name)

        for name in wanted:
            visit(name, ())
        return out

    def build(self, only: Iterable[str] | None = None, given: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        """Lazy frames of the wanted tables and their needs, each held to its contract. ``given`` tables are not built again."""
        done: dict[str, DataFrame] = {}
        for name in self.order(only):
            table = self.tables[name]
            df = (given or {}).get(name)
            done[name] = table.refuse_other(name, table.build({n: done[n] for n in table.needs}) if df is None else df)
        return done

    def write(self, spark: SparkSession, root: str, only: Iterable[str] | None = None) -> dict[str, int]:
        """Write the wanted tables below ``root``; returns their row counts.

        A table that others need is written first and read back for them, so it is computed once; a table that is only needed is
        written as well unless it is ``inner``.
        """
        done: dict[str, DataFrame] = {}
        counts: dict[str, int] = {}
        for name in self.order(only):
            table = self.tables[name]
            df = table.refuse_other(name, table.build({n: done[n] for n in table.needs}))
            if not table.inner:
                path = f"{root.rstrip('/')}/{name}"
                counts[name] = write_table(df, path, table.width, table.partition_by)
                df = spark.read.schema(df.schema).parquet(path)
            done[name] = df
        return counts
