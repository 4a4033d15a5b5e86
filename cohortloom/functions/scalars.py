"""Scalar column expressions: identifiers, vocabularies, file names, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens of the submission forms that mean "no data".
NA_TOKENS = (
    "[Not Available]", "[Not Applicable]", "[Unknown]", "[Discrepancy]",
    "[Not Evaluated]", "[Completed]", "[Pending]", "",
)
# Form names in matching order.
CLINICAL_FORMS = (
    "clinical_follow_up", "clinical_patient", "clinical_nte", "clinical_drug",
    "clinical_radiation", "clinical_ablation", "clinical_omf",
)
BIOSPECIMEN_FORMS = (
    "biospecimen_diagnostic_slides", "biospecimen_shipment_portion", "biospecimen_slide",
    "biospecimen_portion", "biospecimen_aliquot", "biospecimen_analyte",
    "biospecimen_protocol", "biospecimen_sample", "biospecimen_cqcf",
    "ssf_tumor_samples", "ssf_normal_controls", "auxiliary",
)
# Link templates.
CASE_URL = "https://portal.gdc.cancer.gov/cases/"
FILE_URL = "https://portal.gdc.cancer.gov/files/"
DATA_URL = "https://api.gdc.cancer.gov/data/"
GENE_SET_URL = "https://www.gsea-msigdb.org/gsea/msigdb/human/geneset/"
COMPRESSION_SUFFIXES = ("gz", "bz2", "zip")


def case_url(i: Column) -> Column:
    return F.concat(F.lit(CASE_URL), i.cast("string"))


def file_url(i: Column) -> Column:
    return F.concat(F.lit(FILE_URL), i.cast("string"))


def data_url(i: Column) -> Column:
    return F.concat(F.lit(DATA_URL), i.cast("string"))


def gene_set_url(name: Column) -> Column:
    return F.concat(F.lit(GENE_SET_URL), name.cast("string"))


def is_populated(c: Column) -> Column:
    return F.coalesce(~c.isin(*NA_TOKENS), F.lit(False))


def populated(c: Column) -> Column:
    """The value, or null when it is one of the no-data tokens."""
    return F.when(is_populated(c), c)


def nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def short_project(c: Column) -> Column:
    """``A-B`` to ``B``; a name without hyphen stays."""
    return F.regexp_replace(c, "^[^-]*-", "")


def patient_barcode(columns: list[Column], prefix: str = "TCGA-", groups: int = 3) -> Column:
    """First usable barcode's leading groups: right prefix and enough groups."""
    usable = []
    for c in columns:
        v = F.trim(c)
        ok = v.startswith(prefix) & (F.size(F.split(v, "-")) >= groups)
        usable.append(F.when(ok, F.substring_index(v, "-", groups)))
    return F.coalesce(*usable)


def uuid_part(file_name: Column) -> Column:
    """Second dot-separated part of a name of three or more, when it is a UUID."""
    part = F.split(file_name, r"\.")
    pattern = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
    return F.when((F.size(part) >= 3) & part[1].rlike(pattern), part[1])


def file_suffix(file_name: Column) -> Column:
    """Lower-case extension, with the one before it when the last is a compression."""
    low = F.lower(file_name)
    part = F.split(low, r"\.")
    last = F.element_at(part, -1)
    packed = last.isin(*COMPRESSION_SUFFIXES) & (F.size(part) > 2)
    return (
        F.when(F.size(part) < 2, "dat")
        .when(packed, F.substring_index(low, ".", -2))
        .otherwise(last)
    )


def form_kind(file_name: Column, forms: tuple[str, ...] = CLINICAL_FORMS) -> Column:
    """First form whose name stands in the file name as ``_form_`` or ``_form.``."""
    out = F.lit(None).cast("string")
    for f in reversed(forms):
        hit = file_name.contains(f"_{f}_") | file_name.contains(f"_{f}.")
        out = F.when(hit, f).otherwise(out)
    return out


def stage_bucket(stage: Column) -> Column:
    s = F.upper(F.trim(stage))
    s = F.regexp_replace(s, "^STAGE ", "")
    void = stage.isNull() | stage.isin(*NA_TOKENS, "Stage X", "I/II NOS")
    return (
        F.when(void, "NA")
        .when(s.startswith("0"), "0")
        .when(s.startswith("IV"), "IV")
        .when(s.startswith("III"), "III")
        .when(s.startswith("II"), "II")
        .when(s.startswith("I"), "I")
        .otherwise("NA")
    )


def grade_bucket(grade: Column, project: Column) -> Column:
    return (
        F.when(project == "GBM", "4")
        .when(grade.isin("G1", "G2", "G3", "G4"), F.substring(grade, 2, 1))
        .when(project.isin("BLCA", "UCEC") & (grade == "Low Grade"), "1")
        .when(project.isin("BLCA", "UCEC") & (grade == "High Grade"), "3")
        .otherwise("NA")
    )


def race_bucket(race: Column, white: str, black: str, void: tuple[str, ...]) -> Column:
    return (
        F.when(race == white, "White")
        .when(race == black, "Black")
        .when(race.isNull() | race.isin(*void), "NA")
        .otherwise("Other")
    )


def race_bucket_modern(race: Column) -> Column:
    return race_bucket(race, "white", "black or african american", ("not reported", "Unknown"))


def race_bucket_curated(race: Column) -> Column:
    return race_bucket(race, "WHITE", "BLACK OR AFRICAN AMERICAN", NA_TOKENS)


def fallback(*columns: Column) -> Column:
    """First non-empty text."""
    return F.coalesce(*[nonempty(c) for c in columns])


def curated_stage(pathologic: Column, clinical: Column) -> Column:
    return F.when(is_populated(pathologic), pathologic).otherwise(clinical)


def age_years(days_to_birth: Column) -> Column:
    return (-days_to_birth / 365.25).cast("int")


def meta_map(text: Column) -> Column:
    """``key: value`` lines as a map; the value keeps later colons."""
    lines = F.filter(F.split(text, "\n"), lambda l: l.contains(":"))
    return F.map_from_entries(
        F.transform(
            lines,
            lambda l: F.struct(
                F.trim(F.substring_index(l, ":", 1)),
                F.trim(F.substring(l, F.instr(l, ":") + 1, F.length(l))),
            ),
        )
    )


def config_name(path: Column) -> Column:
    """Table name of a top-level ``data_*`` file, dots as underscores; else null."""
    stem = F.regexp_replace(F.regexp_replace(path, "^data_", ""), r"\.txt$", "")
    table = path.startswith("data_") & ~path.contains("/")
    return F.when(table, F.regexp_replace(stem, r"\.", "_"))


def form_values(patient: Column, follow_ups: Column, field: str, order: str) -> Column:
    """Populated values of a field: the patient form first, follow-up forms by barcode."""
    sorted_forms = F.transform(
        F.array_sort(F.transform(follow_ups, lambda f: F.struct(f[order].alias("o"), f.alias("f")))),
        lambda s: s["f"][field],
    )
    every = F.concat(F.array(patient[field]), F.coalesce(sorted_forms, F.array().cast("array<string>")))
    return F.filter(every, is_populated)


def first_value(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def any_of(values: Column, *wanted: str) -> Column:
    return F.exists(values, lambda v: v.isin(*wanted))
