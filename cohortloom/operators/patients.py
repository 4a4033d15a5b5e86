"""Whole patient rows: several child lists of one parent, and the canonical order of a case's tree."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Children:
    """A child table: which column names the parent, what orders a parent's rows (expressions, or names), which columns they
    keep, and which rows are in the list."""

    rows: DataFrame
    key: str
    order: Sequence[Column | str]
    fields: Sequence[str]
    where: Column | None = None


def nest_lists(parents: DataFrame, key: str, lists: dict[str, Children]) -> DataFrame:
    """``parents`` with one ordered array column per child table; no children is an empty array.

    Parents and all children go through one exchange by the parent's key and one aggregation, however many lists
    there are. Lists of one table (the same frame and key) are read, sent and gathered together: a row goes once, with its columns and the
    lists it is in, and each list is picked out of its parent's rows. A child whose parent does not exist is an error when the rows are reached, a null
    key among the children is one too; repeated parent rows each get the lists. A row holds all children of its parent, which
    bounds what a parent may have; parents without such a bound are for :func:`cohortloom.operators.skew.nest` in pages.
    """
    own = [c for c in parents.columns if c != key]
    parts = [parents.select(F.col(key).alias("__key"), F.struct(F.lit(True).alias("__known"), *own).alias("__parent"))]
    together: dict[tuple[int, str], dict[str, Children]] = {}
    for name, child in lists.items():
        together.setdefault((id(child.rows), child.key), {})[name] = child
    picked = {}
    for n, some in enumerate(together.values()):
        child = next(iter(some.values()))
        kept, asked = {}, []
        for k, (name, c) in enumerate(some.items()):
            kept |= {f: F.col(f) for f in [*c.fields, *[o for o in c.order if isinstance(o, str)]]}
            kept |= {f"__o{k}_{i}": o for i, o in enumerate(c.order) if not isinstance(o, str)}
            if c.where is not None:
                kept[f"__in{k}"] = c.where
                asked.append(c.where)
            picked[name] = (f"__c{n}", k)
        rows = child.rows.filter(reduce(lambda a, b: a | b, asked)) if len(asked) == len(some) else child.rows
        parts.append(rows.select(F.col(child.key).alias("__key"), F.struct(*[v.alias(f) for f, v in kept.items()]).alias(f"__c{n}")))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    found = both.groupBy("__key").agg(
        F.collect_list("__parent").alias("__parents"), *[F.collect_list(f"__c{n}").alias(f"__c{n}") for n in range(len(together))]
    )
    kind = parents.schema[key].dataType.simpleString()
    lost = F.raise_error(F.concat(F.lit(f"children refer to a {key} that does not exist: "), F.coalesce(F.col("__key").cast("string"), F.lit("null"))))
    # The guard sits in the array that makes the rows, so no row can be made without it.
    known = F.when(F.size("__parents") == 0, lost.cast(both.schema["__parent"].dataType.simpleString().join(("array<", ">")))).otherwise(F.col("__parents"))
    rows = found.withColumn("__row", F.explode(known))

    def listed(name: str) -> Column:
        child, (column, k) = lists[name], picked[name]
        items = F.col(column) if child.where is None else F.filter(column, lambda x: x[f"__in{k}"])
        place = lambda x: F.struct(*[x[o if isinstance(o, str) else f"__o{k}_{i}"].alias(f"o{i}") for i, o in enumerate(child.order)]).alias("__o")
        fields = lambda x: [x[f].alias(f) for f in child.fields]
        keyed = F.array_sort(F.transform(items, lambda x: F.struct(place(x), *fields(x))))
        return F.transform(keyed, lambda x: F.struct(*fields(x)))

    return rows.select(
        F.col("__key").cast(kind).alias(key), *[F.col(f"__row.{c}").alias(c) for c in own], *[listed(name).alias(name) for name in lists]
    ).select(*parents.columns, *lists)


#: Lists that run in time: their time and their id.
IN_TIME = {
    "diagnoses": ("days_to_diagnosis", "diagnosis_id"), "follow_ups": ("days_to_follow_up", "follow_up_id"),
    "samples": ("days_to_collection", "sample_id"), "treatments": ("days_to_treatment_start", "treatment_id"),
}
#: Lists in the order of their ids.
BY_ID = {
    "annotations": "annotation_id", "pathology_details": "pathology_detail_id", "molecular_tests": "molecular_test_id",
    "other_clinical_attributes": "other_clinical_attribute_id", "aliquots": "aliquot_id", "analytes": "analyte_id", "slides": "slide_id",
    "portions": "portion_id", "exposures": "exposure_id", "family_histories": "family_history_id", "data_categories": "data_category",
    "experimental_strategies": "experimental_strategy",
}
ENDPOINTS = ("os", "dss", "pfi", "dfi")
#: Modalities of a patient row; each is an empty list until it is attached.
MODALITIES = (
    "masked_somatic_mutation", "gene_expression_quantification", "pathology_report", "allele_specific_copy_number_segment", "masked_copy_number_segment",
    "mirna_expression_quantification", "protein_expression_quantification",
)


def _order(name: str, kind: T.StructType) -> list[str]:
    """Names a list is ordered by, of those its elements have: a missing time or id comes last."""
    wanted = IN_TIME.get(name) or ((BY_ID[name],) if name in BY_ID else ())
    return [c for c in wanted if c in kind.names]


def ordered(value: Column, kind: T.DataType, name: str = "") -> Column:
    """A tree value in canonical form: every list of structs in its order, at every level, and no list null.

    A list with no order of its own keeps the order it came in.
    """
    if isinstance(kind, T.StructType):
        fields = F.struct(*[ordered(value[f.name], f.dataType, f.name).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), fields)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        element, by = kind.elementType, _order(name, kind.elementType)
        items = F.filter(value, lambda x: x.isNotNull())
        if by:
            keyed = F.transform(items, lambda x: F.struct(*[y.alias(f"o{n}") for n, y in enumerate(z for c in by for z in (x[c].isNull(), x[c]))], x.alias("x")))
            items = F.transform(F.array_sort(keyed), lambda k: k["x"])
        rows = F.transform(items, lambda x: ordered(x, element))
        return F.coalesce(rows, F.array().cast(kind.simpleString()))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(value, F.array().cast(kind.simpleString()))
    return value


def patient_rows(cases: DataFrame, portal: str, collections: Sequence[str] = ()) -> DataFrame:
    """One row per case of a case-tree table: its own fields and lists in canonical order, its link, an empty list for each
    modality, and a survival struct of nulls, both to be filled by what has been derived.

    ``project`` gives ``project_id`` and ``program``. No shuffle: a row is made of its own tree.
    """
    fields = {f.name: f.dataType for f in cases.schema.fields}
    project = fields.get("project")
    inside = project.names if isinstance(project, T.StructType) else []
    out = [F.col("case_id"), F.col("submitter_id").alias("case_submitter_id")]
    out.append((F.col("project.project_id") if "project_id" in inside else F.lit(None).cast("string")).alias("project_id"))
    out.append(F.concat(F.lit(portal), F.col("case_id").cast("string")).alias("portal_url"))
    if "program" in inside:
        out.append(ordered(F.col("project.program"), project["program"].dataType).alias("program"))
    out += [ordered(F.col(n), kind, n).alias(n) for n, kind in fields.items() if n not in ("case_id", "submitter_id", "project")]
    empty = F.array().cast("array<struct<source_file_id:string>>")
    out += [empty.alias(f"samples_{m}") for m in (*MODALITIES, *[f"ssgsea_{c}" for c in collections])]
    none = [F.lit(None).cast(kind).alias(f"{e}_{part}") for e in ENDPOINTS for part, kind in (("event", "int"), ("time", "double"))]
    return cases.select(*out, F.struct(*none).alias("survival_derived"))


def flex_column(df: DataFrame, forms: Sequence[str], name: str, single: Sequence[str] = ()) -> DataFrame:
    """Form columns as one struct of the forms that any row has; null where a row has none of them.

    A missing list is empty, ``single`` forms are structs and may be null. Without any form there is no column. Which forms
    there are is one aggregate row, read when the plan is built: a struct's fields are part of its schema.
    """
    has = {f: F.col(f).isNotNull() if f in single else F.coalesce(F.size(f) > 0, F.lit(False)) for f in forms}
    row = df.agg(*[F.max(c).alias(f) for f, c in has.items()]).first()
    kept = [f for f in forms if row[f]]
    rest = df.drop(*forms) if not kept else df
    if not kept:
        return rest
    kinds = dict(df.dtypes)
    value = F.struct(*[(F.col(f) if f in single else F.coalesce(F.col(f), F.array().cast(kinds[f]))).alias(f) for f in kept])
    some = reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in forms])
    return df.select(*[c for c in df.columns if c not in forms], F.when(some, value).alias(name))
