"""Longitudinal events and date consistency of cases."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The order in which a case's own events, its lists and its closing events are read on one day.
GROUPS = ("opening", "diagnosis", "follow_up", "sample", "closing")
ID_COLUMNS = ("diagnosis_id", "treatment_id", "follow_up_id", "sample_id")
#: Sort by these after ``case_id`` for reading order.
READING = ("day", "group", "parent", "child", "step")


class Event(NamedTuple):
    """One dated event that each row of a source may have.

    ``parent`` is the place of the row's item in its case's list, ``child`` the place of a
    treatment under its diagnosis (from 1; 0 is the diagnosis itself), ``step`` tells events
    of one item apart.
    """

    category: str
    day: Column
    label: Column
    group: str
    parent: Column | int = 0
    child: Column | int = 0
    step: int = 0
    ids: dict[str, Column] = {}


def events_of(df: DataFrame, events: Sequence[Event]) -> DataFrame:
    """All dated events of one source in one pass; an undated one is no event."""
    lit = lambda v, kind: (v if isinstance(v, Column) else F.lit(v)).cast(kind)
    rows = [
        F.struct(
            lit(e.day, "double").alias("day"), lit(GROUPS.index(e.group), "int").alias("group"), lit(e.parent, "bigint").alias("parent"),
            lit(e.child, "bigint").alias("child"), lit(e.step, "int").alias("step"), F.lit(e.category).alias("category"), lit(e.label, "string").alias("label"),
            *[lit(e.ids.get(i), "string").alias(i) for i in ID_COLUMNS],
        )
        for e in events
    ]
    return df.select("case_id", F.inline(F.filter(F.array(*rows), lambda x: x["day"].isNotNull())))


def timeline(parts: list[DataFrame]) -> DataFrame:
    """All events; sort by ``case_id`` and ``READING`` for reading order."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def consistency_check(cases: DataFrame, samples: DataFrame, treatments: DataFrame) -> DataFrame:
    """Per case: receipts after death, undated samples, pre-index treatments, other index."""
    death = cases.select(F.col("case_id").alias("__c"), "days_to_death")
    s = samples.join(death, F.col("case_id") == F.col("__c")).groupBy("case_id").agg(
        F.count_if(F.col("days_to_collection") > F.col("days_to_death")).alias("receipts_after_death"),
        F.count_if(F.col("days_to_sample_procurement").isNull() & F.col("days_to_collection").isNull()).alias("undated_samples"),
    )
    x = treatments.groupBy("case_id").agg(F.count_if(F.col("days_to_start") < 0).alias("pre_index_treatments"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return cases.join(s, "case_id", "left").join(x, "case_id", "left").select(
        "case_id", zero("receipts_after_death"), zero("undated_samples"), zero("pre_index_treatments"),
        F.coalesce((F.col("index_date") != "Diagnosis").cast("int"), F.lit(0)).alias("other_index"),
    )


def after_death(cases: DataFrame, samples: DataFrame) -> DataFrame:
    """Distinct collection days of cases collected after death, largest gap first.

    One row per (case, day): a case's days are never gathered in one array.
    """
    days = samples.filter(F.col("days_to_collection").isNotNull()).select("case_id", "days_to_collection").distinct()
    last = days.groupBy("case_id").agg(F.max("days_to_collection").alias("last_day"))
    late = cases.join(last, "case_id").filter(F.col("last_day") > F.col("days_to_death")).select(
        "case_id", "days_to_death", (F.col("last_day") - F.col("days_to_death")).alias("delta")
    )
    return late.join(days, "case_id").orderBy(F.desc("delta"), "case_id", "days_to_collection")
