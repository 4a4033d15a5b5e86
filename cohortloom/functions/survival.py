"""Survival endpoints (OS, DSS, PFI, DFI) from clinical records.

Each rule is an aggregate over long tables (diagnoses, treatments, follow-ups),
so records of one case never meet in an array: maps combine first and one row
per case crosses each join. Expected columns:

cases       case_id, project_id, vital_status, days_to_death, cause_of_death
diagnoses   case_id, dx_id, is_primary, days_to_diagnosis, days_to_last_follow_up,
            classification, tissue, residual_disease, stage
treatments  case_id, dx_id, tx_id, days_to_start, outcome, margin_status
follow_ups  case_id, fu_id, days_to_follow_up, disease_response, days_to_recurrence,
            days_to_progression, progression_or_recurrence, type
supplement  case_id, pos, outcome (populated values in form order); optional
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.scalars import nonempty, short_project

# Diagnosis kinds that are new tumour events.
SUBSEQUENT_KINDS = ("subsequent primary", "additional - new primary", "additional new primary")
NEW_TUMOR_KINDS = ("recurrence", "metastatic", *SUBSEQUENT_KINDS)
# Outcomes that mean disease-free, projects without a usable
# disease-free field, projects judged by residual disease alone.
FREE_OUTCOMES = ("Complete Response", "Complete Remission/Response")
NO_DFI_PROJECTS = ("LAML", "SKCM", "THYM", "UVM")
RESIDUAL_ONLY_PROJECTS = ("SARC",)
WITH_TUMOR, TUMOR_FREE = "WITH TUMOR", "TUMOR FREE"


def _temporal(day: str, ident: str) -> list[Column]:
    """Order: day ascending, nulls last, then id."""
    return [F.col(day).isNull(), F.col(day), F.coalesce(F.col(ident).cast("string"), F.lit(""))]


def _key(*cols: Column) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])


def diagnosis_facts(diagnoses: DataFrame) -> DataFrame:
    """Per case: the primary diagnosis and the earliest diagnosis-level event."""
    kind = F.lower(F.trim(F.coalesce("classification", F.lit(""))))
    flagged = F.coalesce("is_primary", F.lit(False))
    event_day = F.when(~flagged & kind.isin(*NEW_TUMOR_KINDS), F.col("days_to_diagnosis"))
    d = diagnoses.withColumns({"__kind": kind, "__event": event_day})
    order = _temporal("days_to_diagnosis", "dx_id")
    primary = F.struct("dx_id", "days_to_last_follow_up", "tissue", "residual_disease", "stage")
    return d.groupBy("case_id").agg(
        F.min_by(primary, _key(~flagged, *order)).alias("primary"),
        F.min_by(
            F.struct(F.col("__event").alias("day"), "__kind", "classification", "tissue"),
            F.when(F.col("__event").isNotNull(), _key(F.col("__event"), *order)),
        ).alias("dx_event"),
    )


def follow_up_facts(follow_ups: DataFrame) -> DataFrame:
    """Per case: last follow-up day, earliest event, latest tumour response."""
    said_yes = F.lower(F.trim("progression_or_recurrence")) == "yes"
    event = F.least(
        F.col("days_to_recurrence"), F.col("days_to_progression"), F.when(said_yes, F.col("days_to_follow_up"))
    )
    r = F.col("disease_response")
    with_tumor = r.contains("With Tumor") | F.upper(r).startswith("WT")
    free = r.contains("Tumor Free") | F.upper(r).startswith("TF")
    f = follow_ups.withColumn("__event", event)
    return f.groupBy("case_id").agg(
        F.max("days_to_follow_up").alias("last_fu_day"),
        F.min_by(
            F.struct(F.col("__event").alias("day"), "type"),
            F.when(F.col("__event").isNotNull(), _key(F.col("__event"), *_temporal("days_to_follow_up", "fu_id"))),
        ).alias("fu_event"),
        # True sorts above false, so WITH beats FREE on the same day.
        F.max(
            F.when(
                F.col("days_to_follow_up").isNotNull() & (with_tumor | free),
                F.struct(F.col("days_to_follow_up").alias("day"), with_tumor.alias("with_tumor")),
            )
        ).alias("response"),
    )


def treatment_facts(treatments: DataFrame, primary: DataFrame) -> DataFrame:
    """Per case, over the primary diagnosis's treatments.

    A diagnosis id belongs to one case. Rows meet by it alone and the case is compared afterwards, so
    treatments that already lie by diagnosis are not shuffled again.
    """
    p = primary.select(F.col("case_id").alias("__c"), F.col("primary.dx_id").alias("__dx"))
    same_case = F.coalesce(F.col("case_id") == F.col("__c"), F.lit(False))
    own = treatments.join(p, (F.col("dx_id") == F.col("__dx")) & same_case)
    order = _key(*_temporal("days_to_start", "tx_id"))

    def first(c: str) -> Column:
        return F.min_by(F.col(c), F.when(nonempty(F.col(c)).isNotNull(), order))

    return own.groupBy("case_id").agg(
        first("margin_status").alias("margin_status"),
        first("outcome").alias("tx_outcome"),
        F.max(F.col("outcome").isin(*FREE_OUTCOMES)).alias("tx_free"),
    )


def supplement_facts(supplement: DataFrame) -> DataFrame:
    return supplement.groupBy("case_id").agg(
        F.min_by("outcome", F.when(nonempty(F.col("outcome")).isNotNull(), F.col("pos"))).alias("supp_outcome"),
        F.max(F.col("outcome").isin(*FREE_OUTCOMES)).alias("supp_free"),
    )


def derive(
    cases: DataFrame,
    diagnoses: DataFrame,
    treatments: DataFrame,
    follow_ups: DataFrame,
    supplement: DataFrame | None = None,
) -> DataFrame:
    """One row per case: the intermediate facts and the struct ``survival_derived``."""
    dx = diagnosis_facts(diagnoses)
    out = cases
    parts = [dx, follow_up_facts(follow_ups), treatment_facts(treatments, dx)]
    if supplement is not None:
        parts.append(supplement_facts(supplement))
    for part in parts:
        out = out.join(part, "case_id", "left")
    if supplement is None:
        out = out.withColumns(
            {"supp_outcome": F.lit(None).cast("string"), "supp_free": F.lit(None).cast("boolean")}
        )
    c = F.col
    out = out.withColumns(
        {
            "last_contact": F.greatest(c("primary.days_to_last_follow_up"), c("last_fu_day")),
            "nte_day": F.least(c("fu_event.day"), c("dx_event.day")),
        }
    )
    other_organ = (
        c("dx_event.__kind").isin(*SUBSEQUENT_KINDS)
        & (c("primary.tissue") != "") & (c("dx_event.tissue") != "")
        & (c("dx_event.tissue") != c("primary.tissue"))
    )
    dx_type = F.when(other_organ, "New Primary").otherwise(c("dx_event.classification"))
    fu_first = c("fu_event.day").isNotNull() & (
        c("dx_event.day").isNull() | (c("fu_event.day") <= c("dx_event.day"))
    )
    short = short_project(c("project_id"))
    r0 = F.coalesce(c("primary.residual_disease") == "R0", F.lit(False))
    any_free = F.coalesce(c("supp_free"), F.lit(False)) | F.coalesce(c("tx_free"), F.lit(False))
    margin = F.coalesce(c("margin_status") == "Uninvolved", F.lit(False))
    out = out.withColumns(
        {
            "nte_type": F.when(fu_first, c("fu_event.type")).otherwise(dx_type),
            "tumor_status": F.when(c("response").isNull() & c("nte_day").isNull(), None)
            .when(c("response").isNull() | (c("nte_day") >= c("response.day")), WITH_TUMOR)
            .when(c("response.with_tumor"), WITH_TUMOR)
            .otherwise(TUMOR_FREE),
            "stage_iv": F.coalesce(F.lower(F.trim("primary.stage")).startswith("stage iv"), F.lit(False)),
            "disease_free": F.when(short.isin(*RESIDUAL_ONLY_PROJECTS), r0).otherwise(r0 | margin | any_free),
            "first_outcome": F.coalesce(nonempty(c("supp_outcome")), c("tx_outcome")),
        }
    )
    known = c("vital_status").isin("Alive", "Dead")
    dead = c("vital_status") == "Dead"
    latest = F.greatest(c("days_to_death"), c("last_contact")).cast("double")
    cancer = F.coalesce(c("tumor_status") == WITH_TUMOR, F.lit(False)) | F.coalesce(
        c("cause_of_death") == "Cancer Related", F.lit(False)
    )
    timed = known & latest.isNotNull()
    spared = dead & (c("tumor_status") == TUMOR_FREE)

    os_event = F.when(timed, dead.cast("int"))
    dss_event = F.when(timed, F.when(~dead, 0).when(F.coalesce(spared, F.lit(False)), 0).otherwise(1))
    died_of_it = dead & cancer & c("days_to_death").isNotNull()
    pfi = (
        F.when(~known, None)
        .when(c("nte_day").isNotNull(), _pair(1, c("nte_day")))
        .when(died_of_it, _pair(1, c("days_to_death")))
        .when(dead & latest.isNotNull(), _pair(0, latest))
        .when(~dead & c("last_contact").isNotNull(), _pair(0, c("last_contact")))
    )
    void = (
        F.coalesce(short.isin(*NO_DFI_PROJECTS), F.lit(False))
        | c("stage_iv") | ~F.coalesce(known, F.lit(False))
        | (dead & c("nte_day").isNull() & cancer)
        | ~F.coalesce(c("disease_free"), F.lit(False))
    )
    censoring_type = c("nte_type").contains("New Primary") & ~c("nte_type").contains("+")
    counted = F.when(~F.coalesce(censoring_type, F.lit(False)), c("nte_day"))
    dfi = (
        F.when(void, None)
        .when(counted.isNotNull(), _pair(1, counted))
        .when(latest.isNotNull(), _pair(0, latest))
    )
    out = out.withColumns({"__pfi": pfi, "__dfi": dfi})
    struct = F.struct(
        os_event.alias("os_event"), F.when(timed, latest).alias("os_time"),
        dss_event.alias("dss_event"), F.when(timed, latest).alias("dss_time"),
        c("__pfi.event").alias("pfi_event"), c("__pfi.time").alias("pfi_time"),
        c("__dfi.event").alias("dfi_event"), c("__dfi.time").alias("dfi_time"),
    )
    return out.withColumn("survival_derived", struct).drop("__pfi", "__dfi")


def _pair(event: int, time: Column) -> Column:
    return F.struct(F.lit(event).alias("event"), time.cast("double").alias("time"))


ENDPOINT_COLUMNS = [f"{e}_{x}" for e in ("os", "dss", "pfi", "dfi") for x in ("event", "time")]


def flatten_endpoints(derived: DataFrame, keys: list[str]) -> DataFrame:
    """Struct to flat columns; a case without any value is dropped."""
    flat = derived.select(*keys, "survival_derived.*")
    return flat.filter(F.coalesce(*[F.col(x).cast("double") for x in ENDPOINT_COLUMNS]).isNotNull())


def from_tree(tree: DataFrame) -> dict[str, DataFrame]:
    """The long inputs of :func:`derive` from nested case rows (row-local explodes)."""
    dx = tree.select("case_id", F.explode("diagnoses").alias("d"))
    d = F.col("d")
    return {
        "cases": tree.select(
            "case_id", F.col("project.project_id").alias("project_id"),
            F.col("demographic.vital_status").alias("vital_status"),
            F.col("demographic.days_to_death").alias("days_to_death"),
            F.col("demographic.cause_of_death").alias("cause_of_death"),
        ).dropDuplicates(["case_id"]),
        "diagnoses": dx.select(
            "case_id", d["diagnosis_id"].alias("dx_id"), d["diagnosis_is_primary_disease"].alias("is_primary"),
            d["days_to_diagnosis"].alias("days_to_diagnosis"), d["days_to_last_follow_up"].alias("days_to_last_follow_up"),
            d["classification_of_tumor"].alias("classification"), d["tissue_or_organ_of_origin"].alias("tissue"),
            d["residual_disease"].alias("residual_disease"), d["ajcc_pathologic_stage"].alias("stage"),
        ),
        "treatments": dx.select("case_id", d["diagnosis_id"].alias("dx_id"), F.explode(d["treatments"]).alias("t")).select(
            "case_id", "dx_id", F.col("t.treatment_id").alias("tx_id"), F.col("t.days_to_treatment_start").alias("days_to_start"),
            F.col("t.treatment_outcome").alias("outcome"), F.col("t.margin_status").alias("margin_status"),
        ),
        "follow_ups": tree.select("case_id", F.explode("follow_ups").alias("f")).select(
            "case_id", F.col("f.follow_up_id").alias("fu_id"), F.col("f.days_to_follow_up").alias("days_to_follow_up"),
            F.col("f.disease_response").alias("disease_response"), F.col("f.days_to_recurrence").alias("days_to_recurrence"),
            F.col("f.days_to_progression").alias("days_to_progression"),
            F.col("f.progression_or_recurrence").alias("progression_or_recurrence"),
            F.col("f.progression_or_recurrence_type").alias("type"),
        ),
    }
