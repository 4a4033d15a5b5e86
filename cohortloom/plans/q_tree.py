"""Specimen trees: scan, canonical rows, dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import scalars as sc
from cohortloom.operators import resolve as rs
from cohortloom.operators import tree as tr
from cohortloom.operators.skew import nest
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, with_
from cohortloom.session import shared_dir
from cohortloom.sources.trees import read_case_tree

LEVELS = [
    ("samples", ["sample_id", "sample_type", "day"]),
    ("portions", ["portion_no"]),
    ("analytes", ["analyte_type"]),
    ("aliquots", ["aliquot_id", "quantity"]),
]
CASE = ["case_id", "submitter_id", "project_id"]


def case_tree(t: Tables):
    """Cases with their nested samples; the array is null for a case without any."""
    leaves = t.samples.select("case_id", "sample_id", "sample_type", "day").join(
        t.aliquots.select("sample_id", "portion_no", "analyte_type", "aliquot_id", "quantity"),
        "sample_id", "left",
    )
    nested = rs.prefixed(tr.nest_levels(leaves, ["case_id"], LEVELS), "n_")
    j = t.cases.select(*CASE).join(nested, F.col("case_id") == F.col("n_case_id"), "left")
    return j.select(*CASE, F.col("n_samples").alias("samples"))


def chain(t: Tables):
    """Every leaf of the tree with all its parents."""
    return tr.explode_tree(case_tree(t), CASE, LEVELS)


def aliquot_dim(t: Tables):
    return tr.leaf_dim(chain(t), "aliquot_id")


LEAVES = with_("cases", "samples", "aliquots", body=""",
leaf AS (SELECT c.case_id, c.submitter_id, c.project_id, s.sample_id, s.sample_type, s.day, a.portion_no, a.analyte_type, a.aliquot_id, a.quantity
  FROM cases c LEFT JOIN samples s ON s.case_id = c.case_id LEFT JOIN aliquots a ON a.sample_id = s.sample_id)
""")


@query("scan_case_tree", LEAVES + """SELECT case_id, submitter_id, count(DISTINCT sample_id) AS n_samples, count(aliquot_id) AS n_aliquots,
 round(coalesce(sum(quantity), 0), 6) AS quantity FROM leaf GROUP BY ALL""")
def _scan_case_tree(t: Tables):
    path = shared_dir(t.spark, "case-tree")
    case_tree(t).write.json(path, ignoreNullFields=True)
    schema = (
        "case_id bigint, submitter_id string, project_id string, samples array<struct<sample_id bigint, "
        "sample_type string, day bigint, portions array<struct<portion_no int, analytes array<struct<analyte_type string, "
        "aliquots array<struct<aliquot_id string, quantity double>>>>>>>>"
    )
    tree = read_case_tree(t.spark, path, schema, multi_line=False)
    aliquots = tr.flat_level(F.col("samples"), ["portions", "analytes", "aliquots"])
    per_row = tree.select(
        "case_id", "submitter_id",
        F.transform("samples", lambda s: s["sample_id"]).alias("ids"),
        F.filter(aliquots, lambda a: a["aliquot_id"].isNotNull()).alias("al"),
    )
    return per_row.groupBy("case_id", "submitter_id").agg(
        F.coalesce(F.sum(F.greatest(F.size("ids"), F.lit(0))), F.lit(0)).cast("bigint").alias("n_samples"),
        F.coalesce(F.sum(F.greatest(F.size("al"), F.lit(0))), F.lit(0)).cast("bigint").alias("n_aliquots"),
        F.round(F.sum(F.aggregate(F.coalesce(F.col("al.quantity"), F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + x)), 6).alias("quantity"),
    )


@query("aliquot_dim", LEAVES + "SELECT aliquot_id, sample_id, case_id FROM leaf WHERE aliquot_id IS NOT NULL")
def _aliquot_dim(t: Tables):
    return aliquot_dim(t).select("aliquot_id", "sample_id", "case_id")


@query("provenance_chain", LEAVES + "SELECT * EXCLUDE (day, quantity) FROM leaf")
def _provenance_chain(t: Tables):
    return chain(t).drop("pos", "day", "quantity")


@query("tree_filters", LEAVES + """SELECT case_id, count(DISTINCT sample_id) FILTER (WHERE sample_type = 'F') AS tumor_samples,
 count(DISTINCT sample_id) FILTER (WHERE sample_type = 'O') AS normal_samples,
 count(aliquot_id) AS aliquots, count(aliquot_id) FILTER (WHERE analyte_type = 'A') AS aliquots_a,
 count(DISTINCT (sample_id, portion_no, analyte_type)) FILTER (WHERE aliquot_id IS NOT NULL) AS analytes FROM leaf GROUP BY 1""")
def _tree_filters(t: Tables):
    s = F.col("samples")
    analytes = tr.flat_level(s, ["portions", "analytes"])
    real = F.filter(analytes, lambda a: F.exists(a["aliquots"], lambda q: q["aliquot_id"].isNotNull()))
    n_aliquots = lambda a: F.aggregate(a, F.lit(0), lambda n, x: n + F.size(x["aliquots"]))
    n = lambda c: F.coalesce(F.sum(F.greatest(c, F.lit(0))), F.lit(0)).cast("bigint")
    return case_tree(t).groupBy("case_id").agg(
        n(F.size(tr.of_type(s, "sample_type", "F"))).alias("tumor_samples"),
        n(F.size(tr.of_type(s, "sample_type", "O"))).alias("normal_samples"),
        n(n_aliquots(real)).alias("aliquots"),
        n(n_aliquots(tr.of_type(real, "analyte_type", "A"))).alias("aliquots_a"),
        n(F.size(real)).alias("analytes"),
    )


@query("pick_struct", """SELECT event_id, event_type = 'error' AS missing,
 CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
 CAST(NULL AS VARCHAR) AS absent FROM events""")
def _pick_struct(t: Tables):
    src = F.when(F.col("event_type") != "error", F.col("props"))
    picked = tr.pick_struct(src, {"k": "bigint", "absent": "string"})
    e = t.events.select("event_id", picked.alias("p"))
    return e.select("event_id", F.col("p").isNull().alias("missing"), "p.k", "p.absent")


PATIENT = LEAVES + """, smp AS (SELECT DISTINCT case_id, sample_id, sample_type, day FROM leaf WHERE sample_id IS NOT NULL)
SELECT c.case_id, c.submitter_id, c.project_id, 'https://portal.gdc.cancer.gov/cases/' || c.case_id AS portal_url,
 coalesce(string_agg(sample_id || ':' || sample_type, '|' ORDER BY day, CAST(sample_id AS VARCHAR)), '') AS samples
 {extra} FROM cases c LEFT JOIN smp s USING (case_id) GROUP BY c.case_id, c.submitter_id, c.project_id"""


def patient_rows(t: Tables):
    return tr.canonical_patient(
        case_tree(t).withColumn("samples", tr.sort_temporal(F.col("samples"), "day", "sample_id")),
        CASE,
        sc.case_url(F.col("case_id")),
        ["samples"],
        {"mutations": "array<string>", "expression": "array<string>"},
    )


def sample_text(c="samples"):
    return F.array_join(F.transform(c, lambda s: F.concat(s["sample_id"], F.lit(":"), s["sample_type"])), "|")


@query("patient_row", PATIENT.replace("{extra}", ", 0::INTEGER AS n_mutations, true AS no_survival"))
def _patient_row(t: Tables):
    p = patient_rows(t)
    return p.select(
        *CASE, "portal_url", sample_text().alias("samples"),
        F.size("mutations").alias("n_mutations"), F.col("survival_derived").isNull().alias("no_survival"),
    )


@query("cases_projection", PATIENT.replace("{extra}", ""))
def _cases_projection(t: Tables):
    molecular = ["mutations", "expression", "survival_derived"]
    return patient_rows(t).drop(*molecular).withColumn("samples", sample_text())


@query("summary_sorted", with_("files", body="""
, tally AS (SELECT project_id, data_type, count(*) AS n FROM files GROUP BY ALL)
SELECT project_id, string_agg(data_type || '=' || n, ',' ORDER BY data_type) AS summary, CAST(sum(n) AS BIGINT) AS file_count FROM tally GROUP BY 1"""))
def _summary_sorted(t: Tables):
    tally = t.files.groupBy("project_id", "data_type").agg(F.count(F.lit(1)).alias("n"))
    s = tally.groupBy("project_id").agg(
        F.collect_list(F.struct("n", "data_type")).alias("items"), F.sum("n").alias("file_count")
    )
    items = tr.sort_by_name(F.col("items"), "data_type")
    text = F.array_join(F.transform(items, lambda x: F.concat_ws("=", x["data_type"], x["n"])), ",")
    return s.select("project_id", text.alias("summary"), "file_count")


@query("temporal_sort", with_("forms", body="""
SELECT case_id, string_agg(row_no, ',' ORDER BY CASE WHEN kind = 'click' THEN NULL ELSE day END NULLS LAST, CAST(row_no AS VARCHAR)) AS rows FROM forms GROUP BY 1"""))
def _temporal_sort(t: Tables):
    f = t.forms.withColumn("day", F.when(F.col("kind") != "click", F.col("day")))
    n = nest(f, ["case_id"], [F.col("day").isNull(), F.col("day"), F.col("row_no").cast("string")], ["row_no", "day"], "items")
    items = tr.sort_temporal(F.col("items"), "day", "row_no")
    return n.select("case_id", F.array_join(F.transform(items, lambda x: x["row_no"].cast("string")), ",").alias("rows"))
