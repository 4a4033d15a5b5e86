"""Deterministic stratified cross-validation folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import SLICE_ROWS, ranked

K = 10
K_NESTED = 5
# The salt names the assignment, the order deals events first.
SALT = "tcga-patient-folds:v1"
STATUSES = ("event", "censored", "missing")


def salted(text: Column) -> Column:
    return F.sha2(F.concat(F.lit(SALT + ":"), text.cast("string")).cast("binary"), 256)


def hex_mod(digest: Column, k: int) -> Column:
    """A 256-bit hex number modulo ``k``, digit by digit."""
    digit = lambda i: F.conv(F.substring(digest, i, F.lit(1)), 16, 10).cast("int")
    digits = F.transform(F.sequence(F.lit(1), F.lit(64)), digit)
    return F.aggregate(digits, F.lit(0), lambda a, x: (a * 16 + x) % k)


def status(event: Column) -> Column:
    return F.when(event.isNull(), "missing").when(event == 1, "event").otherwise("censored")


def status_choice(
    cohort: DataFrame, curated: DataFrame, key: str, endpoints: list[str], redaction: str
) -> DataFrame:
    """Status per endpoint: the curated record unless absent or redacted, else the derived."""
    cur = curated.select(
        F.col(key).alias("__key"),
        (~F.col(redaction).eqNullSafe("Redacted")).alias("__usable"),
        *[F.col(e).alias("__c_" + e) for e in endpoints],
    )
    j = cohort.join(cur, F.col(key) == F.col("__key"), "left")
    use = F.coalesce(F.col("__usable"), F.lit(False))
    out = {
        e + "_status": status(F.when(use, F.col("__c_" + e)).otherwise(F.col(e))) for e in endpoints
    }
    out["status_source"] = F.when(use, "curated").otherwise("derived")
    return j.withColumns(out).drop("__key", "__usable", *["__c_" + e for e in endpoints])


def deal(
    cohort: DataFrame,
    key: str = "case_id",
    project: str = "project_id",
    slice_rows: int = SLICE_ROWS,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """``fold_10`` and ``fold_5`` per patient; input order is irrelevant.

    Patients of a project are dealt like cards in (pfi, os, hash) order, starting
    at an offset of the project's own.
    """
    def rank_of(c: str) -> Column:
        return F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col(c))

    order = [rank_of("pfi_status"), rank_of("os_status"), salted(F.col(key))]
    pos = ranked(cohort, [project], order, "__pos", slice_rows, count_on=count_on)
    # The digest arithmetic runs once per project, not once per patient.
    offsets = cohort.select(project).distinct().select(
        F.col(project).alias("__p"), hex_mod(salted(F.col(project)), K).alias("__off")
    )
    fold = ((F.col("__pos") - 1 + F.col("__off")) % K).cast("tinyint")
    return (
        pos.join(offsets, F.col(project) == F.col("__p"))
        .withColumn("fold_10", fold)
        .withColumn("fold_5", (F.col("fold_10") % K_NESTED).cast("tinyint"))
        .drop("__pos", "__off", "__p")
    )


def fold_events(folds: DataFrame, project: str = "project_id") -> DataFrame:
    """Patients and events per project, with the mean number of events per fold."""
    g = folds.groupBy(project).agg(
        F.count(F.lit(1)).alias("patients"),
        F.count_if(F.col("pfi_status") == "event").alias("events"),
    )
    mean = F.col("events") / K
    return g.withColumn("events_per_fold", F.round(mean, 6)).withColumn("few_events", mean < 5)


def fold_balance(folds: DataFrame, groups: list[str], k: int = K, fold: str = "fold_10") -> DataFrame:
    """Largest minus smallest fold count per group, an unused fold counting 0."""
    per = folds.groupBy(*groups).agg(
        *[F.count_if(F.col(fold) == i).alias(f"f{i}") for i in range(k)]
    )
    counts = [F.col(f"f{i}") for i in range(k)]
    return per.select(*groups, (F.greatest(*counts) - F.least(*counts)).alias("spread"))
