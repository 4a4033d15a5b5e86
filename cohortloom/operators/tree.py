"""Nested specimen trees: building, canonical rows, dimensions, filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import SLICE_ROWS, paged, pick_by

# (array column, its id field) from the case down to the aliquot.
LEVELS = (("samples", "sample_id"), ("portions", "portion_id"), ("analytes", "analyte_id"), ("aliquots", "aliquot_id"))


def nest_levels(
    leaves: DataFrame,
    keys: Sequence[str],
    levels: Sequence[tuple[str, Sequence[str]]],
    page_rows: int | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Fold flat leaves into nested arrays, outermost level first in ``levels``.

    ``levels`` lists (array name, its fields); the first field of each is the id.
    One tree row per key; with ``page_rows``, which the caller names, a tree comes in
    pages of at most so many leaves. All levels share the partitioning of the first step.
    """
    cur, kept = leaves, list(keys)
    if page_rows is not None:
        order = [F.col(f[0]) for _, f in levels]
        cur, kept = paged(leaves, keys, order, page_rows, slice_rows).drop("rn"), [*keys, "page"]
    for depth in range(len(levels) - 1, -1, -1):
        name, fields = levels[depth]
        upper = [c for _, f in levels[:depth] for c in f]
        inner = [levels[depth + 1][0]] if depth + 1 < len(levels) else []
        cur = cur.groupBy(*kept, *upper).agg(
            F.array_sort(F.collect_list(F.struct(*fields, *inner))).alias(name)
        )
    return cur


def explode_tree(
    tree: DataFrame, keep: Sequence[str], levels: Sequence[tuple[str, Sequence[str]]]
) -> DataFrame:
    """One row per leaf with every parent's fields, by nesting alone.

    ``pos`` is the leaf's place in the tree row; a parent without children gives
    one row of nulls below it.
    """
    cur = tree.select(*keep, F.col(levels[0][0]).alias("__a"))
    done: list[str] = []
    places: list[str] = []
    for depth, (_, fields) in enumerate(levels):
        last = depth + 1 == len(levels)
        cur = cur.select(*keep, *done, *places, F.posexplode_outer("__a").alias(f"__p{depth}", "__x"))
        places.append(f"__p{depth}")
        nxt = [] if last else [F.col("__x")[levels[depth + 1][0]].alias("__a")]
        cur = cur.select(*keep, *done, *places, *[F.col("__x")[f].alias(f) for f in fields], *nxt)
        done += fields
    return cur.select(*keep, *done, F.struct(*places).alias("pos"))


def leaf_dim(rows: DataFrame, leaf: str, order: Sequence[str] = ("pos",)) -> DataFrame:
    """Leaf id to parents: null ids dropped, the last of several wins."""
    return pick_by(rows.filter(F.col(leaf).isNotNull()), [leaf], [F.col(c) for c in order], last=True)


def pick_struct(source: Column, fields: dict[str, str], data: Column | None = None) -> Column:
    """Exactly the declared fields of a JSON object; a missing object stays a null struct."""
    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    parsed = F.from_json(source, schema)
    return F.when(source.isNotNull(), F.struct(*[parsed[n].alias(n) for n in fields]))


def sort_temporal(items: Column, day: str, ident: str) -> Column:
    """Order an array of structs by day, nulls last, then id (null as empty text)."""
    keyed = F.transform(
        items,
        lambda x: F.struct(
            x[day].isNull().alias("n"), x[day].alias("d"),
            F.coalesce(x[ident].cast("string"), F.lit("")).alias("i"), x.alias("x"),
        ),
    )
    return F.transform(F.array_sort(keyed), lambda k: k["x"])


def sort_by_name(items: Column, name: str) -> Column:
    """Order an array of structs by one text field."""
    keyed = F.transform(items, lambda x: F.struct(x[name].alias("k"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda k: k["x"])


def canonical_patient(
    tree: DataFrame, scalars: Sequence[str], url: Column, arrays: Sequence[str], unfetched: dict[str, str]
) -> DataFrame:
    """The patient row: declared scalars, portal link, sorted arrays, empty modality
    arrays for what was not fetched and a null survival struct."""
    return tree.select(
        *scalars,
        url.alias("portal_url"),
        *[F.coalesce(F.col(a), F.expr(f"CAST(array() AS {dict(tree.dtypes)[a]})")).alias(a) for a in arrays],
        *[F.array().cast(t).alias(n) for n, t in unfetched.items()],
        F.lit(None).cast("struct<os_event:int,os_time:double>").alias("survival_derived"),
    )


def flat_level(samples: Column, path: Sequence[str]) -> Column:
    """All descendants at the end of ``path`` as one array, e.g. portions, analytes."""
    def below(items: Column, name: str) -> Column:
        return F.flatten(F.filter(F.transform(items, lambda x: x[name]), lambda a: a.isNotNull()))

    cur = samples
    for name in path:
        cur = below(cur, name)
    return cur


def of_type(items: Column, field: str, *values: str) -> Column:
    return F.filter(items, lambda x: x[field].isin(*values))
