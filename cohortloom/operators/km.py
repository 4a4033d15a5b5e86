"""Product-limit survival curves and follow-up medians."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import percentiles, running

DAYS_PER_MONTH = 30.44


def km_curve(df: DataFrame, group: str, time: str, event: str) -> DataFrame:
    """One row per distinct time: deaths ``d``, at-risk ``n`` and survival ``surv``.

    Rows collapse to (group, time) before any ordering. Times are whole days of one
    human life, so a group keeps some ten thousand rows at most, whatever the cohort.
    """
    steps = (
        df.filter(F.col(time).isNotNull() & F.col(event).isNotNull())
        .groupBy(group, time)
        .agg(
            F.sum(F.col(event).cast("bigint")).alias("d"),
            F.count(F.lit(1)).alias("c"),
        )
    )
    at_risk = running(steps, [group], [-F.col(time)], {"n": F.col("c")}, slice_rows=None)
    factor = F.when(F.col("d") < F.col("n"), F.log1p(-F.col("d") / F.col("n"))).otherwise(0.0)
    logs = running(
        at_risk,
        [group],
        [F.col(time)],
        {"ls": factor, "z": (F.col("d") == F.col("n")).cast("int")},
        slice_rows=None,
    )
    surv = F.when(F.col("z") > 0, 0.0).otherwise(F.exp("ls"))
    return logs.select(group, time, "d", "c", "n", surv.alias("surv"))


def km_horizon(
    df: DataFrame, group: str, time: str, event: str, horizons: dict[str, float]
) -> DataFrame:
    """Survival per group and horizon.

    The factor of the first event at or after the horizon still counts. Without
    such an event the last event's value stands, unless follow-up ends before
    the horizon, which gives null.
    """
    curve = km_curve(df, group, time, event)
    died = F.col("d") > 0
    aggs = []
    for name, h in horizons.items():
        at_cut = F.min_by(F.when(died, F.col("surv")), F.when(died & (F.col(time) >= h), F.col(time)))
        last = F.max_by(F.when(died, F.col("surv")), F.when(died, F.col(time)))
        followed = F.max(time) >= h
        value = F.coalesce(at_cut, F.when(followed, F.coalesce(last, F.lit(1.0))))
        aggs.append(F.round(value, 3).alias(name))
    wide = curve.groupBy(group).agg(*aggs)
    return wide.unpivot([group], list(horizons), "horizon", "surv")


def follow_up_medians(df: DataFrame, group: str, time: str, event: str) -> DataFrame:
    """Median follow-up in months: all rows, rows with and without the event."""
    labelled = df.filter(F.col(time).isNotNull()).withColumn(
        "kind",
        F.explode(
            F.array(
                F.lit("all"),
                F.when(F.col(event) == 1, "event").when(F.col(event) == 0, "censored").otherwise("missing"),
            )
        ),
    )
    med = percentiles(labelled, [group, "kind"], time, {"median": 0.5}, slice_rows=None)
    return med.select(group, "kind", F.round(F.col("median") / DAYS_PER_MONTH, 1).alias("months"))
