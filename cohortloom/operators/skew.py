"""Grouped order statistics that survive a group holding a third of all rows.

A plain window or ``collect_list`` sends one group to one task. The operators
here first count rows per key (one column-pruned, map-side combined pass). When
no key exceeds ``slice_rows`` they plan the ordinary window. Otherwise the heavy
keys are cut into ordered slices, each slice is processed by its own task, and a
small table of slice totals is added back as an offset, so results are exact.

Bounds: there are at most ``rows / slice_rows`` heavy keys, and about four cut points
for each ``slice_rows`` rows of one, so every heavy key is cut and every slice stays
near that size. The small tables (heavy keys, cut points, slice totals) are broadcast: none has more rows
than cut points and heavy keys together, so rows are shuffled once, by slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000
#: Cut points a row is compared with at once.
FAN_OUT = 16


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right["__k_" + k])
    return cond


def _free(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def hot_keys(df: DataFrame, keys: Sequence[str], slice_rows: int | None) -> list[tuple]:
    """Keys with more than ``slice_rows`` rows: ``[(key values..., n)]``.

    ``slice_rows=None`` says that groups are small by construction (say, one row per
    distinct follow-up day); then nothing is counted.
    """
    if slice_rows is None:
        return []
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return [tuple(r) for r in counts.filter(F.col("__n") > slice_rows).collect()]


def _slice(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], hot: list[tuple], slice_rows: int
) -> DataFrame:
    """Add ``__slice``: position of the row's order key among its key's cut points.

    Cut points are order keys picked by hash, so a recomputed task picks the same
    ones. They form a tree: a row is compared with ``FAN_OUT`` of them a level, and only the
    branch it falls in is joined to it next. So its work grows with the number of levels, not of cut points.
    """
    spark = df.sparkSession
    # Columns of ``df`` keep their names and values, whatever they are called.
    o, at, here, among, of = (_free(df, n) for n in ("__o", "__at", "__node", "__cuts", "__branch"))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`__k_{k}` {types[k]}" for k in keys] + ["__every bigint"])
    picked = [max(4, 4 * r[-1] // slice_rows) for r in hot]
    every = [(*r[:-1], max(1, r[-1] // n)) for r, n in zip(hot, picked, strict=True)]
    hot_df = F.broadcast(spark.createDataFrame(every, schema))
    okey = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    keyed = df.withColumn(o, okey)
    names = [f"__k_{k}" for k in keys]
    sampled = keyed.join(hot_df, _same(keyed, hot_df, keys)).filter(
        F.pmod(F.xxhash64(o), F.col("__every")) == 0
    )
    cuts = sampled.select(*names, o).distinct()
    cuts = cuts.withColumn(at, F.row_number().over(Window.partitionBy(*names).orderBy(o)) - 1)
    levels = 1
    while FAN_OUT**levels < max(picked):
        levels += 1
    placed = keyed.withColumn(here, F.lit(0))
    for level in range(levels):
        # Place of the last cut point up to the row among those of this level; the first level is one branch.
        step = FAN_OUT ** (levels - 1 - level)
        of_level = cuts.filter(F.col(at) % step == 0)
        branch = F.lit(0) if level == 0 else F.expr(f"int({at} div {step * FAN_OUT})")
        branches = of_level.groupBy(*names, branch.alias(of)).agg(F.array_sort(F.collect_list(o)).alias(among))
        joined = placed.join(F.broadcast(branches), _same(placed, branches, keys) & (F.col(here) == F.col(of)), "left")
        upto = F.size(F.filter(among, lambda s: s <= F.col(o))) - 1
        node = F.when(F.col(among).isNull(), -1).otherwise(upto + (0 if level == 0 else F.col(here) * FAN_OUT))
        placed = joined.withColumn(here, node).drop(among, of, *names)
    return placed.withColumn("__slice", F.col(here) + 1).drop(o, here)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    slice_rows: int | None = SLICE_ROWS,
    hot: list[tuple] | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Inclusive running sums per key in ``order`` (ascending, a total order).

    ``hot`` passes on an earlier :func:`hot_keys` answer for the same rows;
    ``count_on`` is a frame with at least as many rows per key that is cheaper to
    count, such as ``df`` before its lookups.
    """
    keys, order = list(keys), list(order)
    if not keys:
        one = running(df.withColumn("__all", F.lit(0)), ["__all"], order, sums, slice_rows)
        return one.drop("__all")
    if hot is None:
        hot = hot_keys(df if count_on is None else count_on, keys, slice_rows)
    if not hot:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    part = keys + ["__slice"]
    sliced = _slice(df.withColumns({f"__v_{n}": c for n, c in sums.items()}), keys, order, hot, slice_rows)
    totals = sliced.groupBy(*part).agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # Only keys that really were cut have a slice above 0, so this is small.
    offsets = totals.withColumns({f"__off_{n}": F.sum(f"__t_{n}").over(before) for n in sums})
    offsets = offsets.filter(F.col("__slice") > 0).select(
        *[F.col(k).alias("__k_" + k) for k in part], *[f"__off_{n}" for n in sums]
    )
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.repartition(*part).withColumns({f"__l_{n}": F.sum(f"__v_{n}").over(w) for n in sums})
    joined = local.join(F.broadcast(offsets), _same(local, offsets, part), "left")
    # A sum is null only while neither this slice nor an earlier one has had a value.
    plus = lambda n: F.coalesce(F.col(f"__l_{n}") + F.col(f"__off_{n}"), F.col(f"__l_{n}"), F.col(f"__off_{n}"))
    out = {n: plus(n) for n in sums}
    return joined.select(*df.columns, *[c.alias(n) for n, c in out.items()])


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "rn",
    slice_rows: int | None = SLICE_ROWS,
    hot: list[tuple] | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """1-based row number per key."""
    return running(df, keys, order, {name: F.lit(1).cast("bigint")}, slice_rows, hot, count_on)


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    slice_rows: int | None = SLICE_ROWS,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles per key; nulls in ``value`` are ignored.

    Groups under ``slice_rows`` rows are one built-in aggregation, together with the
    plain aggregates of ``also``. Otherwise, or with ``slice_rows=None`` (few distinct
    values by construction), rows first collapse to (key, value, count); groups with
    many distinct values are then read off a distributed running count.
    """
    keys = list(keys)
    also = also or {}
    qs = F.array(*[F.lit(float(q)) for q in quantiles.values()])
    picked = [F.col("__q")[i].alias(n) for i, n in enumerate(quantiles)]
    if slice_rows is not None and not hot_keys(df, keys, slice_rows):
        agg = df.groupBy(*keys).agg(F.percentile(F.col(value), qs).alias("__q"), *[c.alias(n) for n, c in also.items()])
        return agg.select(*keys, *picked, *also)
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    hot = hot_keys(hist, keys, slice_rows)
    if not hot:
        agg = hist.groupBy(*keys).agg(F.percentile(F.col(value), qs, F.col("__c")).alias("__q"))
        out = agg.select(*keys, *picked)
    else:
        out = _sliced_percentiles(hist, keys, value, quantiles, slice_rows, hot)
    if not also:
        return out
    plain = df.groupBy(*keys).agg(*[c.alias(n) for n, c in also.items()])
    right = out.select(*[F.col(k).alias("__k_" + k) for k in keys], *quantiles)
    return plain.join(right, _same(plain, right, keys), "left").select(*keys, *quantiles, *also)


def _sliced_percentiles(
    hist: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], slice_rows: int, hot: list[tuple]
) -> DataFrame:
    cum = running(hist, keys, [F.col(value)], {"__cum": F.col("__c")}, slice_rows, hot)
    total = hist.groupBy(*keys).agg(F.sum("__c").alias("__total"))
    renamed = total.select(*[F.col(k).alias("__k_" + k) for k in keys], "__total")
    both = cum.join(renamed, _same(cum, renamed, keys))
    aggs = []
    for i, q in enumerate(quantiles.values()):
        pos = F.lit(float(q)) * (F.col("__total") - 1)
        v = F.col(value).cast("double")
        aggs += [
            F.min(F.when(F.col("__cum") > F.floor(pos), v)).alias(f"__lo{i}"),
            F.min(F.when(F.col("__cum") > F.ceil(pos), v)).alias(f"__hi{i}"),
        ]
    agg = both.groupBy(*keys).agg(F.max("__total").alias("__total"), *aggs)
    cols = []
    for i, (n, q) in enumerate(quantiles.items()):
        pos = F.lit(float(q)) * (F.col("__total") - 1)
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        cols.append((lo + (pos - F.floor(pos)) * (hi - lo)).alias(n))
    return agg.select(*keys, *cols)


def pick_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False
) -> DataFrame:
    """One whole row per key, the first (or last) in ``order``, by partial aggregation."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    okey = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = (F.max_by if last else F.min_by)(F.struct(*rest), okey)
    return df.groupBy(*keys).agg(best.alias("__row")).select(*keys, "__row.*").select(*df.columns)


def paged(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    page_rows: int,
    slice_rows: int = SLICE_ROWS,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Number rows per key as ``rn`` and cut them into ``page``s of ``page_rows``."""
    out = ranked(df, keys, order, "rn", slice_rows, count_on=count_on)
    return out.withColumn("page", F.expr(f"(rn - 1) div {int(page_rows)}"))


def nest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    fields: Sequence[str],
    name: str,
    page_rows: int | None = None,
    slice_rows: int = SLICE_ROWS,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Ordered array of structs per key: one row per key, whatever its size.

    A caller whose keys have more children than a row should hold names ``page_rows``;
    then every key comes in pages, with ``page`` and ``offset`` (the number of children
    on earlier pages) as further columns. The form never depends on the data.
    """
    strip = F.transform("__a", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    if page_rows is None:
        keyed = F.struct(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("__o"), *fields)
        packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(keyed)).alias("__a"))
        return packed.select(*keys, strip.alias(name))
    rows = paged(df, keys, order, page_rows, slice_rows, count_on)
    packed = rows.groupBy(*keys, "page").agg(
        F.array_sort(F.collect_list(F.struct("rn", *fields))).alias("__a")
    )
    return packed.select(*keys, "page", (F.col("page") * page_rows).alias("offset"), strip.alias(name))
