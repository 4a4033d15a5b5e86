"""Dense sample-major matrices and their long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.skew import SLICE_ROWS, nest, ranked


def value_at(names: Column, values: Column, name: str) -> Column:
    """Value at the first position of ``name``; null when it is not there."""
    at = F.array_position(names, name)
    return F.when(at > 0, F.try_element_at(values, at.cast("int")))


def axis_index(df: DataFrame, order: Sequence[Column], name: str = "i", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Global 0-based position in ``order``."""
    return ranked(df, [], order, "__rn", slice_rows).withColumn(name, F.col("__rn") - 1).drop("__rn")


def pack(
    df: DataFrame, sample: str, index: str, value: str, n_genes: int | None = None, page_rows: int | None = None
) -> DataFrame:
    """Long to one list per sample in gene-axis order.

    With ``page_rows`` a sample comes in pages, told apart by ``page`` and ``offset``.
    With ``n_genes`` an incomplete sample is refused, its pages counted together.
    """
    packed = nest(df, [sample], [F.col(index)], [value], "__v", page_rows)
    values = F.transform("__v", lambda x: x[value])
    out = packed.select(sample, *([] if page_rows is None else ["page", "offset"]), values.alias("values"))
    if n_genes is not None:
        width = F.size("values") if page_rows is None else F.sum(F.size("values")).over(Window.partitionBy(sample))
        size = F.when(width == n_genes, F.col("values")).otherwise(
            F.raise_error(F.concat(F.lit("incomplete sample "), F.col(sample).cast("string"))).cast(
                dict(out.dtypes)["values"]
            )
        )
        out = out.withColumn("values", size)
    return out


def build(
    rows: DataFrame, axis: DataFrame, sample: str, gene: str, values: Sequence[str], index: str = "gene_index",
    tallies: dict[str, str] | None = None, tally: str | None = None, strands: tuple[str, str] | None = None,
) -> DataFrame:
    """Sample-major lists of several quantifications at once: one column per name in ``values``, in the order of ``axis``.

    ``axis`` has each ``gene`` once with its ``index`` from 0. ``tallies`` maps the names of summary rows to output columns, which take
    their ``tally`` value (null where a sample has no such row); ``strands`` adds ``strand_balance``, the first
    one's share of both sums. All of it comes out of one aggregation, read once; a sample's state is its axis. A sample that
    lacks a gene of the axis, or has one twice, is refused, and so is a gene that is neither on the axis nor a tally.
    """
    tallies = tallies or {}
    a = axis.select(F.col(gene).alias("__g"), F.col(index).cast("bigint").alias("__i"))
    n_genes = axis.agg(F.count(F.lit(1))).scalar()
    j = rows.join(a, F.col(gene) == F.col("__g"), "left")
    on = F.col("__i").isNotNull()
    stray = ~on & ~F.coalesce(F.col(gene).isin(*tallies), F.lit(False))
    out = j.groupBy(sample).agg(
        F.array_sort(F.collect_list(F.when(on, F.struct("__i", *values)))).alias("__rows"), F.max(F.when(stray, F.coalesce(F.col(gene).cast("string"), F.lit("null")))).alias("__stray"),
        *[F.max(F.when(F.col(gene) == g, F.col(tally))).alias(c) for g, c in tallies.items()],
        *([F.sum(F.when(on, F.col(s))).alias(f"__{k}") for k, s in enumerate(strands)] if strands else []),
    )
    whole = (F.size("__rows") == n_genes) & F.forall(F.transform("__rows", lambda x, i: x["__i"] == i), lambda ok: ok)
    kind = out.schema["__rows"].dataType.simpleString()
    name = F.col(sample).cast("string")
    sure = F.when(F.col("__stray").isNotNull(), F.raise_error(F.concat(F.lit("gene off the axis in sample "), name, F.lit(": "), F.col("__stray"))).cast(kind))
    sure = sure.when(~whole, F.raise_error(F.concat(F.lit("incomplete sample "), name)).cast(kind)).otherwise(F.col("__rows"))
    out = out.withColumn("__rows", sure)
    lists = [F.col(f"__rows.{v}").alias(v) for v in values]
    balance = [strand_balance(F.col("__0"), F.col("__1")).alias("strand_balance")] if strands else []
    return out.select(sample, *lists, *tallies.values(), *balance)


def unpack(df: DataFrame, sample: str, values: str, genes: DataFrame, index: str, offset: str | None = None) -> DataFrame:
    """List to long rows, joined to the gene axis by position; ``offset`` names the column
    that says where a page begins."""
    long = df.select(sample, F.lit(0).alias("__from") if offset is None else F.col(offset).alias("__from"), F.posexplode(values).alias("__i", "value"))
    long = long.withColumn("__i", F.col("__i") + F.col("__from")).drop("__from")
    g = genes.withColumnRenamed(index, "__gi")
    return long.join(g, F.col("__i") == F.col("__gi")).drop("__i").withColumnRenamed("__gi", index)


def wide_to_long(
    wide: DataFrame, ids: Sequence[str], name: str = "sample", value: str = "value",
    absent: Sequence[str] = ("NA", ""), keep_absent: bool = False,
) -> DataFrame:
    """Text matrix to long rows; ``absent`` cells are dropped or kept as null, any
    other cell must be a number."""
    cols = [c for c in wide.columns if c not in ids]
    long = wide.unpivot(list(ids), [F.col(f"`{c}`") for c in cols], name, "__text")
    gone = F.col("__text").isNull() | F.col("__text").isin(*absent)
    if not keep_absent:
        long = long.filter(~gone)
    number = F.expr("try_cast(__text AS double)")
    checked = F.when(gone, F.lit(None).cast("double")).otherwise(
        F.coalesce(number, F.raise_error(F.concat(F.lit("not a number: "), "__text")).cast("double"))
    )
    return long.withColumn(value, checked).drop("__text")


def as_map(keys: Column, values: Column, keep: Column | None = None) -> Column:
    """Parallel arrays as a map, optionally only where ``keep`` is true."""
    if keep is None:
        return F.map_from_arrays(keys, values)
    zipped = F.filter(F.arrays_zip(keys.alias("k"), values.alias("v"), keep.alias("f")), lambda x: x["f"])
    return F.map_from_entries(F.transform(zipped, lambda x: F.struct(x["k"], x["v"])))


def strand_balance(first: Column, second: Column) -> Column:
    """Share of the first strand; null without stranded reads."""
    return F.try_divide(first, first + second)
