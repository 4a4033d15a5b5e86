"""Agreement between curated and derived values, and cohort summary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import percentiles

CLASSES = ("both_na", "der_pop_cdr_na", "cdr_pop_der_na", "match", "mismatch")
TABLE1_VOCAB = {
    "race": ("White", "Black", "Other", "NA"),
    "stage": ("0", "I", "II", "III", "IV", "NA"),
    "grade": ("1", "2", "3", "4", "NA"),
}


def classify(c_e: Column, c_t: Column, d_e: Column, d_t: Column) -> Column:
    """Five-way agreement class of one endpoint."""
    same_time = (c_t.isNull() & d_t.isNull()) | F.coalesce(F.abs(c_t - d_t) < 0.5, F.lit(False))
    return (
        F.when(c_e.isNull() & d_e.isNull(), "both_na")
        .when(c_e.isNull(), "der_pop_cdr_na")
        .when(d_e.isNull(), "cdr_pop_der_na")
        .when((c_e == d_e) & same_time, "match")
        .otherwise("mismatch")
    )


def within_days(c_e: Column, c_t: Column, d_e: Column, d_t: Column, days: float) -> Column:
    """Both missing, or equal events with times at most ``days`` apart."""
    near = (c_t.isNull() & d_t.isNull()) | F.coalesce(F.abs(c_t - d_t) <= days, F.lit(False))
    return (c_e.isNull() & d_e.isNull()) | (F.coalesce(c_e == d_e, F.lit(False)) & near)


def agreement_summary(df: DataFrame, cls: str, by: Sequence[str] = ()) -> DataFrame:
    """Count per class, total and percentage that match."""
    g = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(cls) == c).alias(c) for c in CLASSES],
    )
    return g.withColumn("match_pct", F.round(100 * F.col("match") / F.col("total"), 1))


def match_rate(df: DataFrame, cls: str, by: Sequence[str]) -> DataFrame:
    """``matched/populated (percent)`` where the curated side is populated."""
    g = df.groupBy(*by).agg(
        F.count_if(F.col(cls) == "match").alias("m"),
        F.count_if(F.col(cls).isin("match", "mismatch", "cdr_pop_der_na")).alias("d"),
    )
    pct = F.bround(100 * F.col("m") / F.col("d"), 0).cast("bigint")
    text = F.concat(F.col("m"), F.lit("/"), F.col("d"), F.lit(" ("), pct, F.lit("%)"))
    return g.select(*by, F.when(F.col("d") > 0, text).otherwise("—").alias("rate"))


def packed(column: str, vocab: Sequence[str]) -> Column:
    """Counts per category as ``a/b/c``."""
    return F.concat_ws("/", *[F.count_if(F.col(column) == v).cast("string") for v in vocab])


def table1(df: DataFrame, project: str) -> DataFrame:
    """Cohort characteristics per project (columns age, gender, race, stage, grade)."""
    age = F.concat(
        F.format_string("%.1f", F.avg("age")), F.lit(" ± "), F.format_string("%.1f", F.stddev_samp("age"))
    )
    return df.groupBy(project).agg(
        F.count(F.lit(1)).cast("string").alias("n"),
        age.alias("age"),
        packed("gender", ("male", "female")).alias("gender"),
        *[packed(c, v).alias(c) for c, v in TABLE1_VOCAB.items()],
    )


def compare_tables(
    left: DataFrame, right: DataFrame, key: str, fields: Sequence[str], match: Column
) -> DataFrame:
    """Long comparison ``(key, field, l, r, same)`` over the common keys.

    ``match`` is a predicate over ``field``, ``l`` and ``r``.
    """
    l = left.unpivot([key], list(fields), "field", "l")
    r = right.unpivot([key], list(fields), "__f", "r").withColumnRenamed(key, "__k")
    j = l.join(r, (F.col(key) == F.col("__k")) & (F.col("field") == F.col("__f")))
    same = F.coalesce(match, F.lit(False))
    return j.select(key, "field", "l", "r", same.alias("same"))


def comparison_summary(long: DataFrame) -> DataFrame:
    g = long.groupBy("field").agg(F.count_if("same").alias("m"), F.count(F.lit(1)).alias("n"))
    return g.select(
        "field",
        F.concat("m", F.lit("/"), "n").alias("match"),
        F.round(100 * F.col("m") / F.col("n"), 1).alias("pct"),
    )


def text_or_mean_match(tolerance: float, age_field: str = "age") -> Column:
    """Equal text; for the age field the means may differ by ``tolerance``."""
    head = lambda c: F.trim(F.substring_index(F.col(c), "±", 1)).try_cast("double")
    near = F.abs(head("l") - head("r")) <= tolerance
    return (F.col("l") == F.col("r")) | ((F.col("field") == age_field) & near)


def near_or_both_null(tolerance: float) -> Column:
    return (F.col("l").isNull() & F.col("r").isNull()) | (F.abs(F.col("l") - F.col("r")) <= tolerance)


def direction_table(df: DataFrame, c_e: str, d_e: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (curated, derived) event where both are populated and differ."""
    both = df.filter(F.col(c_e).isNotNull() & F.col(d_e).isNotNull() & (F.col(c_e) != F.col(d_e)))
    return both.groupBy(*by, c_e, d_e).agg(F.count(F.lit(1)).alias("n"))


def time_only_diff(df: DataFrame, by: str) -> DataFrame:
    """Equal events whose times differ by half a day or more: count and median gap."""
    gap = F.abs(F.col("c_t") - F.col("d_t"))
    rows = df.filter((F.col("c_e") == F.col("d_e")) & (gap >= 0.5)).select(by, gap.alias("gap"))
    return percentiles(rows, [by], "gap", {"median_gap": 0.5}, also={"n": F.count(F.lit(1))})
