"""Data-quality checks as one-row DataFrames.

Every check is ``(check, passed, n_checked, n_bad, examples)``. Counting is a
plain partial aggregation; examples are a separate top-k of the offending keys,
so no task ever holds them all.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EXAMPLES = 5


def examples_of(bad: DataFrame, key: Column, limit: int = EXAMPLES) -> Column:
    """The first ``limit`` distinct keys in text order, as a scalar subquery."""
    top = bad.select(key.cast("string").alias("k")).distinct().orderBy("k").limit(limit)
    return top.agg(F.array_sort(F.collect_list("k")).alias("k")).scalar()


def check_rows(
    df: DataFrame, name: str, good: Column, key: str | Column, at_least: int = 0
) -> DataFrame:
    """Every row must satisfy ``good``; null counts as a failure."""
    key = F.col(key) if isinstance(key, str) else key
    bad = ~F.coalesce(good, F.lit(False))
    flagged = df.select(bad.alias("__bad"), key.alias("__key"))
    shown = examples_of(flagged.filter("__bad"), F.col("__key"))
    counts = flagged.agg(
        F.count(F.lit(1)).alias("n_checked"),
        F.count_if("__bad").alias("n_bad"),
    )
    return counts.select(
        F.lit(name).alias("check"),
        ((F.col("n_bad") == 0) & (F.col("n_checked") >= at_least)).alias("passed"),
        "n_checked",
        "n_bad",
        shown.alias("examples"),
    )


def suite(checks: list[DataFrame]) -> DataFrame:
    """All check rows of a named suite."""
    return reduce(lambda a, b: a.unionByName(b), checks)


def gate(results: DataFrame) -> DataFrame:
    """One row: whether every check of the suite passed, and the names of all that did not."""
    return results.agg(
        F.bool_and("passed").alias("passed"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check")))).alias("failed"),
    )


def require(results: DataFrame) -> None:
    """Raise when a check failed; the step after the suite must not run. All failed checks are named."""
    failed = gate(results).first()["failed"]
    if failed:
        raise ValueError(f"checks failed: {', '.join(failed)}")


@dataclass
class Check:
    """A condition every row of a table must meet; null counts as a failure."""

    name: str
    table: str
    good: Column
    key: str
    at_least: int = 0


def run_suite(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """All checks of a suite, one aggregation and so one scan for each table they name.

    ``examples`` holds the first offending key in text order. A check on a table that is not there is refused.
    """
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    lost = sorted(set(by_table) - set(tables))
    if lost:
        raise ValueError(f"no such tables: {', '.join(lost)}")
    parts = []
    for table, own in by_table.items():
        aggs = [F.count(F.lit(1)).alias("n")]
        for k, check in enumerate(own):
            bad = ~F.coalesce(check.good, F.lit(False))
            aggs += [F.count_if(bad).alias(f"bad{k}"), F.min(F.when(bad, F.col(check.key).cast("string"))).alias(f"key{k}")]
        row = tables[table].agg(*aggs)
        found = [
            F.struct(
                F.lit(check.name).alias("check"), ((F.col(f"bad{k}") == 0) & (F.col("n") >= check.at_least)).alias("passed"), F.col("n").alias("n_checked"),
                F.col(f"bad{k}").alias("n_bad"), F.array_compact(F.array(F.col(f"key{k}"))).alias("examples"),
            )
            for k, check in enumerate(own)
        ]
        parts.append(row.select(F.explode(F.array(*found)).alias("c")).select("c.*"))
    return suite(parts)


class Suites:
    """Named suites; each is a function of nothing but its name and the tables."""

    def __init__(self):
        self._made: dict[str, list[Check]] = {}

    def add(self, name: str, *checks: Check) -> None:
        self._made.setdefault(name, []).extend(checks)

    def names(self) -> list[str]:
        return sorted(self._made)

    def run(self, name: str, tables: dict[str, DataFrame]) -> DataFrame:
        if name not in self._made:
            raise ValueError(f"unknown suite {name}; there are {', '.join(self.names())}")
        return run_suite(self._made[name], tables)


def row_differences(want: DataFrame, have: DataFrame, keys: list[str], columns: list[str], buckets: int = 4096) -> DataFrame:
    """(key, kind) of rows that one side has more often than the other: ``missing``, ``extra`` or ``changed``.

    Both sides are multisets. First only counts and order-free hashes of ``buckets`` buckets of keys meet, map-side combined; rows are
    shuffled for the buckets that disagree alone. Values are compared as text, null equals null.
    """
    text = lambda c: F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(c).cast("string")))

    def side(df: DataFrame, sign: int) -> DataFrame:
        key = F.array(*[text(k) for k in keys])
        whole = F.array(*[text(c) for c in (*keys, *columns)])
        label = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
        return df.select(label.alias("key"), F.pmod(F.xxhash64(key), F.lit(buckets)).alias("b"), F.xxhash64(whole).alias("h"), F.lit(sign).alias("sign"))

    def halves(df: DataFrame) -> DataFrame:
        high, low = F.shiftright("h", 32), F.col("h").bitwiseAND(0xFFFFFFFF)
        return df.groupBy("b").agg(F.sum("sign").alias("n"), F.sum(F.col("sign") * high).alias("high"), F.sum(F.col("sign") * low).alias("low"))

    both = side(want, 1).unionByName(side(have, -1))
    bad = halves(both).filter("n <> 0 or high <> 0 or low <> 0").select(F.col("b").alias("bad"))
    rows = both.join(bad, F.col("b") == F.col("bad"), "left_semi").groupBy("key", "h").agg(F.sum("sign").alias("n")).filter("n <> 0")
    sides = rows.groupBy("key").agg(F.max(F.col("n") > 0).alias("w"), F.max(F.col("n") < 0).alias("x"))
    return sides.select("key", F.when(F.col("w") & F.col("x"), "changed").when(F.col("w"), "missing").otherwise("extra").alias("kind"))


def same_multiset(want: DataFrame, have: DataFrame, name: str, keys: list[str], columns: list[str], buckets: int = 4096) -> DataFrame:
    """Check row over :func:`row_differences`; examples read ``kind:key``, ``n_checked`` counts the wanted rows."""
    diff = row_differences(want, have, keys, columns, buckets).select(F.concat_ws(":", "kind", "key").alias("k"))
    shown = examples_of(diff, F.col("k"))
    n = want.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = diff.agg(F.count(F.lit(1)).alias("n_bad"))
    return counts.select(F.lit(name).alias("check"), (F.col("n_bad") == 0).alias("passed"), n.alias("n_checked"), "n_bad", shown.alias("examples"))


def same_columns(want: DataFrame, have: DataFrame, name: str) -> DataFrame:
    """Names, order and number of columns agree; examples read ``place:name``."""
    pairs = list(zip_longest(want.columns, have.columns))
    bad = [f"{k}:{a}/{b}" for k, (a, b) in enumerate(pairs) if a != b]
    row = [(name, not bad, len(pairs), len(bad), bad[:EXAMPLES])]
    return want.sparkSession.createDataFrame(row, "check string, passed boolean, n_checked bigint, n_bad bigint, examples array<string>")


def listing_changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, kind) of files that were added, withdrawn or changed in one of ``columns`` from ``old`` to ``new``."""
    side = lambda df, p: df.select(F.col(key).alias(f"{p}k"), F.lit(True).alias(f"{p}in"), F.struct(*columns).alias(f"{p}v"))
    j = side(old, "o").join(side(new, "n"), F.col("ok") == F.col("nk"), "full")
    kind = F.when(F.col("oin").isNull(), "added").when(F.col("nin").isNull(), "withdrawn").when(~F.col("ov").eqNullSafe(F.col("nv")), "changed")
    return j.select(F.coalesce("ok", "nk").alias(key), kind.alias("kind"))


def current(old: DataFrame, new: DataFrame, name: str, key: str, columns: list[str], digest: str) -> DataFrame:
    """The listing is still the one that was read: nothing added, withdrawn or changed, and equal digests of (key, ``digest``).

    The digests are compared by :func:`cohortloom.operators.sets.source_digest`, which a change of another column leaves alone.
    """
    from cohortloom.operators.sets import source_digest

    all_ = listing_changes(old, new, key, columns)
    flagged = all_.select(F.col("kind").isNotNull().alias("__bad"), F.concat_ws(":", "kind", F.col(key).cast("string")).alias("__key"))
    shown = examples_of(flagged.filter("__bad"), F.col("__key"), 3 * EXAMPLES)
    of = lambda df: source_digest(df.withColumn("__one", F.lit(1)), ["__one"], key, digest).select("digest").scalar()
    counts = flagged.agg(F.count(F.lit(1)).alias("n_checked"), F.count_if("__bad").alias("n_bad"))
    return counts.select(F.lit(name).alias("check"), ((F.col("n_bad") == 0) & of(old).eqNullSafe(of(new))).alias("passed"), "n_checked", "n_bad", shown.alias("examples"))


def positions(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """(at, columns...): rows of a Parquet table with their place over all its files, in the files' order.

    A row's place in its file comes from the reader, the rows before a file from one small count per file; nothing is sorted.
    """
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("__f"), F.col("_metadata.row_index").alias("__r"), *columns)
    sizes = rows.groupBy(F.col("__f").alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__g", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    return rows.join(starts, F.col("__f") == F.col("__g")).select((F.col("__s") + F.col("__r")).alias("at"), *columns)


def aligned(configs: dict[str, DataFrame], name: str, at: str, key: str) -> DataFrame:
    """Every config has the same ``key`` at the same place, once; one exchange for all. Examples read ``place:keys``."""
    parts = [df.select(F.col(at).alias("at"), F.col(key).cast("string").alias("k"), F.lit(c).alias("c")) for c, df in configs.items()]
    per = reduce(lambda a, b: a.unionByName(b), parts).groupBy("at").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("c").alias("n_configs"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("known")
    )
    good = (F.col("n") == len(configs)) & (F.col("n_configs") == len(configs)) & (F.col("known") == len(configs)) & (F.col("lo") == F.col("hi"))
    return check_rows(per, name, good, F.concat_ws(":", F.col("at").cast("string"), F.array_join(F.array_distinct(F.array("lo", "hi")), "/")))


def rows_as_expected(
    want: DataFrame, have: DataFrame, keys: list[str], columns: list[str], tolerance: float = 0.0
) -> DataFrame:
    """``(key, good)`` per key of either side: on both sides, all columns equal.

    Null equals null only. Numbers may differ by ``tolerance``.
    """
    w = want.select(*[F.col(k).alias("w_" + k) for k in keys], F.lit(True).alias("w_in"), *[F.col(c).alias("w__" + c) for c in columns])
    h = have.select(*[F.col(k).alias("h_" + k) for k in keys], F.lit(True).alias("h_in"), *[F.col(c).alias("h__" + c) for c in columns])
    on = reduce(lambda a, b: a & b, [F.col("w_" + k) == F.col("h_" + k) for k in keys])
    j = w.join(h, on, "full")
    good = F.col("w_in").isNotNull() & F.col("h_in").isNotNull()
    for c in columns:
        a, b = F.col("w__" + c), F.col("h__" + c)
        same = a.eqNullSafe(b)
        if tolerance:
            same = same | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))
        good = good & same
    label = F.concat_ws("/", *[F.coalesce(F.col("w_" + k), F.col("h_" + k)).cast("string") for k in keys])
    return j.select(label.alias("key"), good.alias("good"))


def same_rows(want, have, name: str, keys: list[str], columns: list[str], tolerance: float = 0.0) -> DataFrame:
    return check_rows(rows_as_expected(want, have, keys, columns, tolerance), name, F.col("good"), "key")


def same_sets(want: DataFrame, have: DataFrame, name: str, key: str) -> DataFrame:
    """Both sides hold the same distinct keys."""
    return same_rows(want.select(key).distinct(), have.select(key).distinct(), name, [key], [])


def foreign_keys(tables: dict[str, DataFrame], column: str, dim: DataFrame, name: str) -> DataFrame:
    """Every id of every table exists in the dimension; a table without the column is skipped."""
    held = {table: df for table, df in tables.items() if column in df.columns}
    # One aggregation by id over all tables and the dimension: no join, and no sort of either side in a task.
    sides = [df.select(F.col(column).alias("__k"), F.lit(table).alias("__of")) for table, df in held.items()]
    sides.append(dim.select(F.col(column).alias("__k"), F.lit(None).cast("string").alias("__of")))
    ids = reduce(lambda a, b: a.unionByName(b), sides).groupBy("__k").agg(
        F.max(F.col("__of").isNull()).alias("__known"), *[F.max(F.col("__of").eqNullSafe(F.lit(table))).alias(f"__in{i}") for i, table in enumerate(held)]
    )
    of = F.explode(F.filter(F.array(*[F.when(F.col(f"__in{i}"), F.lit(table)) for i, table in enumerate(held)]), lambda x: x.isNotNull()))
    found = ids.select("__k", "__known", of.alias("__of")).select(
        F.concat("__of", F.lit(":"), F.col("__k").cast("string")).alias("key"), (F.col("__known") & F.col("__k").isNotNull()).alias("good")
    )
    return check_rows(found, name, F.col("good"), "key")


def coverage(
    files: DataFrame, reference: DataFrame, name: str, data_type: str, url: str, excluded: list[str]
) -> DataFrame:
    """File counts per type equal the reference's; excluded types are not published;
    a file without type or link is reported under its type."""
    have = files.groupBy(data_type).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(url).isNull() | F.col(data_type).isNull()).alias("holes")
    )
    want = reference.filter(~F.col(data_type).isin(*excluded)).groupBy(data_type).agg(F.count(F.lit(1)).alias("n")).withColumn("holes", F.lit(0).cast("bigint"))
    return same_rows(want, have, name, [data_type], ["n", "holes"])


def axis(df: DataFrame, index: str, name: str, width: Column | None = None, n_genes: int | None = None) -> DataFrame:
    """Index values are 0..n-1 without gap or repeat; every list has the axis width."""
    per = df.groupBy(index).agg(
        F.count(F.lit(1)).alias("__m"),
        F.max(F.coalesce(width != n_genes, F.lit(True)) if width is not None else F.lit(False)).alias("__w"),
    )
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    good = (F.col("__m") == 1) & F.col(index).between(F.lit(0), n - 1) & ~F.col("__w")
    return check_rows(per, name, good, index)


def no_faults(df: DataFrame, name: str, key: str, faults: dict[str, Column]) -> DataFrame:
    """Rows showing none of the named faults; examples read ``fault:key``."""
    labels = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in faults.items()]))
    rows = df.select(F.col(key).cast("string").alias("k"), labels.alias("f"))
    label = F.concat_ws(":", F.array_join("f", "+"), "k")
    return check_rows(rows, name, F.size("f") == 0, label)


def unique(df: DataFrame, name: str, key: str) -> DataFrame:
    return check_rows(df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")), name, F.col("__n") == 1, key)


def one_value(df: DataFrame, name: str, group: str, value: str) -> DataFrame:
    """All groups carry the same value; the most common one is the yardstick."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("m"))
    usual = counts.agg(F.min_by(value, F.struct(-F.col("m"), F.col(value))).alias("v")).scalar()
    return check_rows(df, name, F.col(value) == usual, group)


def share_at_most(df: DataFrame, name: str, hit: Column, limit: float) -> DataFrame:
    """A condition may hold for at most a share of the rows."""
    g = df.agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(hit).alias("n_bad"))
    return g.select(
        F.lit(name).alias("check"),
        (F.col("n_bad") < limit * F.col("n_checked")).alias("passed"),
        "n_checked",
        "n_bad",
        F.array().cast("array<string>").alias("examples"),
    )


def rehash(content: DataFrame, manifest: DataFrame, name: str, key: str, md5: str) -> DataFrame:
    """Bytes hash to the recorded checksum."""
    m = manifest.select(F.col(key).alias("__k"), F.col(md5).alias("__md5"))
    j = content.join(m, F.col(key) == F.col("__k"), "left")
    return check_rows(j, name, F.md5("content") == F.col("__md5"), key)


def pinned(content: DataFrame, name: str, file: str, hashes: dict[str, str]) -> DataFrame:
    """Shipped files have the pinned sha256."""
    want = F.create_map(*[F.lit(x) for kv in hashes.items() for x in kv])
    return check_rows(content, name, F.sha2("content", 256) == want[F.col(file)], file)


def schema_contract(df: DataFrame, declared) -> None:
    """Refuse unknown, missing or differently typed columns, at every level."""
    from cohortloom.sources.typed import schema_differences

    found = schema_differences(df.schema, declared)
    if found:
        raise ValueError("; ".join(found))
