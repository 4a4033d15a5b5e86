"""Foreign keys, pairs, halves, manifests, nesting of children."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import scalars as sc
from cohortloom.operators import regions as rg
from cohortloom.operators import patients as pt
from cohortloom.operators import resolve as rs
from cohortloom.operators.skew import nest, ranked
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, day_of, r6, with_


def join_text(items: str, *fields: str, null: str = "?"):
    """An array of structs as ``a:b|a:b``."""
    part = lambda x: F.concat_ws(":", *[F.coalesce(x[f].cast("string"), F.lit(null)) for f in fields])
    return F.array_join(F.transform(items, part), "|")


ALQ = with_("cases", "samples", "aliquots", body=""",
dim AS (SELECT a.aliquot_id, a.sample_id, s.case_id, s.sample_type FROM aliquots a JOIN samples s USING (sample_id)),
measure AS (SELECT CASE WHEN status = 'F' AND discount = 0.1 THEN 'x-' || aliquot_id ELSE aliquot_id END AS aliquot_id,
  center_id AS case_id, quantity, gene_id, center_id FROM aliquots)
""")


def measures(t: Tables):
    """Measurement records keyed by case and aliquot; some name an unknown aliquot."""
    a = t.aliquots
    unknown = (F.col("status") == "F") & (F.col("discount") == 0.1)
    return a.select(
        F.when(unknown, F.concat(F.lit("x-"), "aliquot_id")).otherwise(F.col("aliquot_id")).alias("aliquot_id"),
        F.col("center_id").alias("case_id"), "quantity", "gene_id", "center_id",
    )


def attached(t: Tables):
    known = t.aliquots.select("aliquot_id", "sample_id").join(t.samples.select("sample_id"), "sample_id", "left_semi")
    m = rs.lookup(measures(t), known, "aliquot_id", "aliquot_id", {"sample_id": "sample_id"})
    return rs.attach_records(
        t.cases.select("case_id", "submitter_id"), m, "case_id", [F.col("aliquot_id")],
        ["aliquot_id", "sample_id", "quantity"], "records",
    )


@query("attach_records", ALQ + """, numbered AS (SELECT m.*, d.sample_id FROM measure m LEFT JOIN dim d USING (aliquot_id)),
packed AS (SELECT case_id, string_agg(aliquot_id || ':' || coalesce(CAST(sample_id AS VARCHAR), '?'), '|' ORDER BY aliquot_id) AS records FROM numbered GROUP BY ALL)
SELECT c.case_id, coalesce(records, '') AS records FROM cases c LEFT JOIN packed p USING (case_id)""")
def _attach_records(t: Tables):
    a = attached(t)
    return a.select("case_id", join_text("records", "aliquot_id", "sample_id").alias("records"))


@query("attach_variants", with_("samples", "aliquots", body=""",
v AS (SELECT sample_id AS tumor, sample_id + 9000 AS normal, CAST(center_id % 24 + 1 AS VARCHAR) AS chromosome, gene_id AS pos, aliquot_id FROM aliquots)
SELECT a.case_id, chromosome, pos, aliquot_id, b.sample_id AS normal_sample,
 row_number() OVER (PARTITION BY a.case_id ORDER BY chromosome, pos, aliquot_id) AS rn
FROM v LEFT JOIN samples a ON v.tumor = a.sample_id LEFT JOIN samples b ON v.normal = b.sample_id"""))
def _attach_variants(t: Tables):
    v = t.aliquots.select(
        F.col("sample_id").alias("tumor"), (F.col("sample_id") + 9000).alias("normal"),
        (F.col("center_id") % 24 + 1).cast("string").alias("chromosome"), F.col("gene_id").alias("pos"), "aliquot_id",
    )
    s = t.samples
    owned = rs.lookup(v.select("tumor"), s, "tumor", "sample_id", {"case_id": "case_id"})
    # Both samples are looked up once a pair, so that whole variants are shuffled by pair and by case alone.
    pairs = rs.lookup(v.select("tumor", "normal").distinct(), s, "tumor", "sample_id", {"case_id": "case_id"})
    pairs = rs.lookup(pairs, s, "normal", "sample_id", {"sample_id": "normal_sample"}).withColumnsRenamed({"tumor": "__t", "normal": "__n"})
    v = v.join(pairs, F.col("tumor").eqNullSafe(F.col("__t")) & F.col("normal").eqNullSafe(F.col("__n")))
    order = [F.col("chromosome"), F.col("pos"), F.col("aliquot_id")]
    out = ranked(v, ["case_id"], order, count_on=owned.select("case_id"))
    return out.select("case_id", "chromosome", "pos", "aliquot_id", "normal_sample", "rn")


@query("flat_fks", with_("cases", "samples", "aliquots", body="""
SELECT a.aliquot_id, a.sample_id, s.sample_type, s.case_id, c.submitter_id, a.quantity
FROM aliquots a JOIN samples s USING (sample_id) JOIN cases c USING (case_id)"""))
def _flat_fks(t: Tables):
    a = t.aliquots.select("aliquot_id", "sample_id", "quantity")
    s = rs.lookup(a, t.samples, "sample_id", "sample_id", {"case_id": "case_id", "sample_type": "sample_type"}, "inner")
    return rs.lookup(s, t.cases, "case_id", "case_id", {"submitter_id": "submitter_id"}, "inner")


@query("portion_fks", with_("samples", "aliquots", body=""",
portions AS (SELECT sample_id || '-' || portion_no AS portion_id, sample_id, min(aliquot_id) AS submitter FROM aliquots GROUP BY ALL),
m AS (SELECT sample_id || '-' || (portion_no + CAST(quantity AS BIGINT) % 2) AS portion_id, aliquot_id, price FROM aliquots)
SELECT m.aliquot_id, p.sample_id, coalesce(p.submitter, 'own-' || m.aliquot_id) AS submitter FROM m LEFT JOIN portions p USING (portion_id)"""))
def _portion_fks(t: Tables):
    a = t.aliquots
    portions = a.groupBy("sample_id", "portion_no").agg(F.min("aliquot_id").alias("submitter")).withColumn(
        "portion_id", F.concat_ws("-", "sample_id", "portion_no")
    )
    m = a.select(
        F.concat_ws("-", "sample_id", F.col("portion_no") + F.col("quantity").cast("bigint") % 2).alias("portion_id"),
        "aliquot_id",
    )
    j = rs.lookup(m, portions, "portion_id", "portion_id", {"sample_id": "sample_id", "submitter": "sub"})
    return j.select(
        "aliquot_id", "sample_id", F.coalesce("sub", F.concat(F.lit("own-"), "aliquot_id")).alias("submitter")
    )


@query("fallback_join", with_("samples", body="""
SELECT doc_id, coalesce(a.sample_id, b.sample_id) AS sample_id, CASE WHEN a.sample_id IS NOT NULL THEN a.case_id ELSE b.case_id END AS case_id
FROM documents LEFT JOIN samples a ON a.sample_id = doc_id * 37 LEFT JOIN samples b ON b.sample_id = n_chars"""))
def _fallback_join(t: Tables):
    d = t.documents.select("doc_id", (F.col("doc_id") * 37).alias("k1"), F.col("n_chars").alias("k2"))
    out = rs.fallback_pair(d, t.samples, "sample_id", "k1", "k2", {"sample_id": "sample_id", "case_id": "case_id"})
    return out.drop("k1", "k2")


@query("single_entity", with_("aliquots", body="""
SELECT sample_id, CASE WHEN count(DISTINCT analyte_type) = 1 THEN min(analyte_type) END AS analyte_type FROM aliquots GROUP BY 1"""))
def _single_entity(t: Tables):
    return rs.single_entity(t.aliquots, ["sample_id"], "analyte_type", "analyte_type")


@query("paired_normal", with_("aliquots", body=""",
x AS (SELECT aliquot_id, gene_id % 4 AS tumor, list_distinct([gene_id % 4, center_id % 4, CAST(quantity AS BIGINT) % 4]) AS ids FROM aliquots)
SELECT aliquot_id, tumor, CASE WHEN len(ids) = 2 THEN list_sum(ids)::BIGINT - tumor END AS normal FROM x"""))
def _paired_normal(t: Tables):
    a = t.aliquots
    ids = F.array(F.col("gene_id") % 4, F.col("center_id") % 4, F.col("quantity").cast("bigint") % 4)
    tumor = F.col("gene_id") % 4
    return a.select("aliquot_id", tumor.alias("tumor"), rs.paired_normal(ids, tumor).alias("normal"))


@query("barcode_pair", """
SELECT e.event_id, c.c_custkey AS case_id FROM events e JOIN customer c ON c.c_name = 'Customer#' || lpad(CAST(e.user_id * 20 AS VARCHAR), 9, '0')""")
def _barcode_pair(t: Tables):
    barcode = F.concat(F.lit("Customer#"), F.lpad((F.col("user_id") * 20).cast("string"), 9, "0"))
    e = t.events.select("event_id", barcode.alias("barcode"))
    return rs.lookup(e, t.customer, "barcode", "c_name", {"c_custkey": "case_id"}, "inner").select("event_id", "case_id")


@query("unordered_pair_join", with_("aliquots", body=""",
seg AS (SELECT analyte_type, least(center_id, gene_id) AS a, greatest(center_id, gene_id) AS b, min(sample_id) AS tumor FROM aliquots WHERE status = 'O' GROUP BY ALL)
SELECT x.aliquot_id, seg.tumor FROM aliquots x JOIN seg ON seg.analyte_type = x.analyte_type AND seg.a = least(x.center_id, x.gene_id) AND seg.b = greatest(x.center_id, x.gene_id)"""))
def _unordered_pair(t: Tables):
    a = t.aliquots
    seg = (
        a.filter("status = 'O'")
        .groupBy("analyte_type", F.least("center_id", "gene_id").alias("p"), F.greatest("center_id", "gene_id").alias("q"))
        .agg(F.min("sample_id").alias("tumor"))
    )
    left = a.select("aliquot_id", "analyte_type", "center_id", "gene_id")
    j = rs.unordered_pair_join(left, seg, "analyte_type", ("gene_id", "center_id"), ("q", "p"), ["tumor"])
    return j.select("aliquot_id", "tumor")


HALVES = """expr AS (SELECT DISTINCT p_partkey AS gene_id, p_name AS gene_name FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_quantity > 48),
coord AS (SELECT p_partkey AS gene_id, 'c-' || p_name AS gene_name, p_size AS start FROM part WHERE p_size > 10)
"""


@query("gene_model", "WITH " + HALVES + """SELECT coalesce(e.gene_id, c.gene_id) AS gene_id, coalesce(e.gene_name, c.gene_name) AS gene_name, c.start
FROM expr e FULL JOIN coord c ON e.gene_id = c.gene_id""")
def _gene_model(t: Tables):
    seen = t.lineitem.filter("l_quantity > 48").select("l_partkey")
    expr = t.part.join(seen, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select(
        F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("gene_name")
    )
    coord = t.part.filter("p_size > 10").select(
        F.col("p_partkey").alias("gene_id"), F.concat(F.lit("c-"), "p_name").alias("gene_name"), F.col("p_size").alias("start")
    )
    return rs.merge_by_key(expr, coord, "gene_id", prefer="left").orderBy("gene_id")


@query("annotate_genes", with_("expression", "genes", body="""
SELECT sample_id, gene_id, value, gene_name, gene_type FROM expression JOIN genes USING (gene_id)"""))
def _annotate_genes(t: Tables):
    return t.expression.join(t.genes.select("gene_id", "gene_name", "gene_type"), "gene_id")


@query("merge_halves", """
WITH l AS (SELECT c_custkey AS case_id, c_mktsegment AS label, c_acctbal AS balance FROM customer),
r AS (SELECT user_id * 11 AS case_id, max(event_type) AS label, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(l.case_id, r.case_id) AS case_id, coalesce(r.label, l.label) AS label, balance, n FROM l FULL JOIN r ON l.case_id = r.case_id""")
def _merge_halves(t: Tables):
    l = t.customer.select(F.col("c_custkey").alias("case_id"), F.col("c_mktsegment").alias("label"), F.col("c_acctbal").alias("balance"))
    r = t.events.groupBy((F.col("user_id") * 11).alias("case_id")).agg(F.max("event_type").alias("label"), F.count(F.lit(1)).alias("n"))
    rs.require_both_or_neither(l, r)
    return rs.merge_by_key(l, r, "case_id")


@query("curated_join", """
SELECT d.doc_id, l.doc_id IS NOT NULL AS matched, CASE WHEN l.toxic = 1 THEN 'Redacted' END AS redaction, l.quality,
 coalesce(l.toxic = 0 AND l.quality IS NOT NULL, false) AS complete FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _curated_join(t: Tables):
    lab = t.labels.withColumn("redaction", F.when(F.col("toxic") == 1, "Redacted"))
    return rs.curated_join(
        t.documents.select("doc_id"), lab, "doc_id", ["redaction", "quality"],
        F.col("matched") & F.col("redaction").isNull() & F.col("quality").isNotNull(),
    )


KINDS = ("click", "error", "purchase", "signup", "view")
LISTED = ("click", "error", "purchase", "view")


@query("supplement_attach", with_("cases", "forms", body=""",
patient AS (SELECT case_id, arg_max(k, row_no) AS patient_form FROM forms WHERE kind = 'signup' GROUP BY 1),
packed AS (SELECT case_id, kind, string_agg(row_no || ':' || k, '|' ORDER BY row_no) AS rows FROM forms WHERE kind <> 'signup' GROUP BY ALL)
SELECT c.case_id, any_value(patient_form) AS patient_form, """ + ", ".join(f"coalesce(max(rows) FILTER (WHERE kind = '{k}'), '') AS {k}" for k in LISTED) + """
 FROM cases c LEFT JOIN patient p USING (case_id) LEFT JOIN packed d USING (case_id) GROUP BY 1"""))
def _supplement_attach(t: Tables):
    # The patient form is one per case, the last wins; all other forms are lists in file order.
    f = t.forms
    last = f.filter("kind = 'signup'").groupBy("case_id").agg(F.max_by("k", "row_no").alias("patient_form"))
    base = rs.lookup(t.cases.select("case_id"), last, "case_id", "case_id", {"patient_form": "patient_form"})
    forms = {k: pt.Children(f, "case_id", ["row_no"], ["row_no", "k"], F.col("kind") == k) for k in LISTED}
    out = pt.nest_lists(base, "case_id", forms)
    return out.select("case_id", "patient_form", *[join_text(k, "row_no", "k").alias(k) for k in LISTED])


@query("specimen_attach", with_("cases", "forms", body=""",
packed AS (SELECT case_id, kind, string_agg(CAST(row_no AS VARCHAR), '|' ORDER BY row_no) AS rows FROM forms GROUP BY ALL)
SELECT c.case_id, """ + ", ".join(f"coalesce(max(rows) FILTER (WHERE kind = '{k}'), '') AS {k}" for k in KINDS) + """
 FROM cases c LEFT JOIN packed p USING (case_id) GROUP BY 1"""))
def _specimen_attach(t: Tables):
    f = t.forms
    forms = {k: pt.Children(f, "case_id", ["row_no"], ["row_no"], F.col("kind") == k) for k in KINDS}
    out = pt.nest_lists(t.cases.select("case_id"), "case_id", forms)
    return out.select("case_id", *[join_text(k, "row_no").alias(k) for k in KINDS])


FILES_LOCAL = """, loc AS (SELECT f.file_id, 'local-' || f.data_type AS data_type, CASE WHEN f.data_type = 'en' THEN 'expression' WHEN f.data_type = 'fr' THEN 'mirna' ELSE 'clinical_supplement_xml' END AS modality,
  l.quality FROM files f JOIN labels l ON f.file_id = l.doc_id),
listing AS (SELECT file_id, project_id, file_size, CASE WHEN file_size > 3000 THEN data_type END AS data_type FROM files)
"""
TABLE_OF = {
    "expression": "gene_expression_quantification",
    "mirna": "mirna_expression_quantification",
    "clinical_supplement_xml": None,
}


def file_sides(t: Tables):
    f = t.files
    modality = F.when(F.col("data_type") == "en", "expression").when(F.col("data_type") == "fr", "mirna").otherwise("clinical_supplement_xml")
    local = f.join(t.labels, F.col("file_id") == F.col("doc_id")).select(
        "file_id", F.concat(F.lit("local-"), "data_type").alias("data_type"), modality.alias("modality")
    )
    listing = f.select(
        "file_id", "project_id", "file_size", F.when(F.col("file_size") > 3000, F.col("data_type")).alias("data_type")
    ).withColumn("modality", F.lit(None).cast("string"))
    return listing, local


def files_index(t: Tables):
    listing, local = file_sides(t)
    return rs.files_index(listing, local, "file_id", ["data_type"], TABLE_OF, "modality", sc.data_url(F.col("file_id")))


@query("files_index", with_("files", body=FILES_LOCAL + """SELECT s.file_id, s.project_id, s.file_size, coalesce(s.data_type, l.data_type) AS data_type, l.file_id IS NOT NULL AS in_dataset,
 CASE modality WHEN 'expression' THEN 'gene_expression_quantification' WHEN 'mirna' THEN 'mirna_expression_quantification' END AS dataset_table,
 'https://api.gdc.cancer.gov/data/' || s.file_id AS url FROM listing s LEFT JOIN loc l ON s.file_id = l.file_id"""))
def _files_index(t: Tables):
    return files_index(t)


@query("nest_children", with_("cases", "samples", body=""",
p AS (SELECT case_id, string_agg(sample_id || ':' || day, '|' ORDER BY day, sample_id) AS children FROM samples GROUP BY ALL)
SELECT c.case_id, coalesce(children, '') AS children FROM cases c LEFT JOIN p USING (case_id)"""))
def _nest_children(t: Tables):
    out = rs.nest_children(
        t.cases.select("case_id"), t.samples, "case_id", "case_id",
        [F.col("day").isNull(), F.col("day"), F.col("sample_id")], ["sample_id", "day"], "children",
    )
    return out.select("case_id", join_text("children", "sample_id", "day").alias("children"))


@query("orphan_check", "SELECT event_id, user_id FROM events WHERE user_id * 12 NOT IN (SELECT c_custkey FROM customer)")
def _orphan_check(t: Tables):
    kids = t.events.withColumn("parent", F.col("user_id") * 12)
    return rs.orphans(t.customer, kids, "c_custkey", "parent").select("event_id", "user_id")


TABLE_LISTS = ", ".join(f"coalesce(max(rows) FILTER (WHERE kind = '{k}'), '') AS timeline_{k}" for k in KINDS)


@query("patient_table", with_("cases", "samples", "aliquots", "forms", body=""",
m AS (SELECT sample_id, string_agg(aliquot_id, ',' ORDER BY aliquot_id) AS aliquots FROM aliquots GROUP BY 1),
g AS (SELECT sample_id, string_agg(gene_id || '/' || center_id, ',' ORDER BY portion_no, aliquot_id, ship_day) AS genes FROM aliquots WHERE analyte_type = 'A' GROUP BY 1),
v AS (SELECT sample_id, string_agg(CAST(gene_id AS VARCHAR), ',' ORDER BY portion_no, aliquot_id, ship_day) AS sv FROM aliquots WHERE analyte_type = 'N' GROUP BY 1),
r AS (SELECT sample_id, string_agg(CAST(CAST(quantity AS BIGINT) AS VARCHAR), ',' ORDER BY portion_no, aliquot_id, ship_day) AS seg FROM aliquots WHERE analyte_type = 'R' GROUP BY 1),
p AS (SELECT sample_id, string_agg(CAST(ship_day AS VARCHAR), ',' ORDER BY portion_no, aliquot_id, ship_day) AS cna FROM aliquots WHERE status = 'F' GROUP BY 1),
s AS (SELECT case_id, string_agg(sample_id || '[' || coalesce(aliquots, '') || '][' || coalesce(genes, '') || '][' || coalesce(sv, '') || '][' || coalesce(seg, '') || '][' || coalesce(cna, '') || ']', '|' ORDER BY sample_id) AS samples
  FROM samples LEFT JOIN m USING (sample_id) LEFT JOIN g USING (sample_id) LEFT JOIN v USING (sample_id) LEFT JOIN r USING (sample_id) LEFT JOIN p USING (sample_id) GROUP BY 1),
tl AS (SELECT case_id, kind, string_agg(day || ':' || row_no, '|' ORDER BY day, row_no) AS rows FROM forms GROUP BY ALL)
SELECT c.case_id, any_value(coalesce(samples, '')) AS samples, """ + TABLE_LISTS + """
 FROM cases c LEFT JOIN s USING (case_id) LEFT JOIN tl USING (case_id) GROUP BY 1"""))
def _patient_table(t: Tables):
    # Five lists in every sample, and one list for each kind of event.
    a = t.aliquots.withColumns({"pair": F.concat_ws("/", "gene_id", "center_id"), "whole": F.col("quantity").cast("bigint")})
    of = lambda field, order, where=None: pt.Children(a, "sample_id", [order, "aliquot_id", "ship_day"], [field], where)
    kind = F.col("analyte_type")
    inner = {
        "aliquots": of("aliquot_id", "aliquot_id"), "genes": of("pair", "portion_no", kind == "A"), "sv": of("gene_id", "portion_no", kind == "N"),
        "seg": of("whole", "portion_no", kind == "R"), "cna": of("ship_day", "portion_no", F.col("status") == "F"),
    }
    samples = pt.nest_lists(t.samples.select("sample_id", "case_id"), "sample_id", inner)
    lists = {"samples": pt.Children(samples, "case_id", [F.col("sample_id")], ["sample_id", *inner])}
    f = t.forms
    lists |= {f"timeline_{k}": pt.Children(f, "case_id", ["day", "row_no"], ["day", "row_no"], F.col("kind") == k) for k in KINDS}
    whole = pt.nest_lists(t.cases.select("case_id"), "case_id", lists)

    def text(s, name: str):
        field = inner[name].fields[0]
        return F.concat(F.lit("["), F.array_join(F.transform(s[name], lambda x: x[field].cast("string")), ","), F.lit("]"))

    line = F.transform("samples", lambda s: F.concat(s["sample_id"].cast("string"), *[text(s, n) for n in inner]))
    return whole.select("case_id", F.array_join(line, "|").alias("samples"), *[join_text(f"timeline_{k}", "day", "row_no").alias(f"timeline_{k}") for k in KINDS])


@query("patient_rows", with_("cases", "samples", "aliquots", "forms", body=""",
tr AS (SELECT sample_id, string_agg(aliquot_id, ',' ORDER BY CASE WHEN portion_no <> 3 THEN ship_day END NULLS LAST, aliquot_id) AS treatments FROM aliquots GROUP BY 1),
dx AS (SELECT case_id, string_agg(sample_id || '[' || coalesce(treatments, '') || ']', '|' ORDER BY CASE WHEN sample_type <> 'P' THEN day END NULLS LAST, sample_id) AS diagnoses, count(*) AS n FROM samples LEFT JOIN tr USING (sample_id) GROUP BY 1),
fu AS (SELECT case_id, string_agg(CAST(row_no AS VARCHAR), '|' ORDER BY day, row_no) AS follow_ups FROM forms GROUP BY 1)
SELECT case_id, submitter_id AS case_submitter_id, project_id, 'https://portal.example/cases/' || case_id AS portal_url, program, coalesce(n, 0) AS n_diagnoses, coalesce(diagnoses, '') AS diagnoses,
 coalesce(follow_ups, '') AS follow_ups, 0 AS n_exposures, 0 AS n_reports, true AS underived FROM cases LEFT JOIN dx USING (case_id) LEFT JOIN fu USING (case_id)"""))
def _patient_rows(t: Tables):
    # The tree's lists come in no order, and some are missing.
    late = F.when(F.col("portion_no") != 3, F.col("ship_day")).alias("days_to_treatment_start")
    tr = t.aliquots.groupBy("sample_id").agg(F.collect_list(F.struct(F.col("aliquot_id").alias("treatment_id"), late)).alias("treatments"))
    known = F.when(F.col("sample_type") != "P", F.col("day")).alias("days_to_diagnosis")
    dx = t.samples.join(tr, "sample_id", "left").groupBy("case_id").agg(F.collect_list(F.struct(F.col("sample_id").alias("diagnosis_id"), known, "treatments")).alias("diagnoses"))
    tests = F.lit(None).cast("array<struct<molecular_test_id:string>>").alias("molecular_tests")
    fu = t.forms.groupBy("case_id").agg(F.collect_list(F.struct(F.col("row_no").alias("follow_up_id"), F.col("day").alias("days_to_follow_up"), tests)).alias("follow_ups"))
    project = F.struct("project_id", F.struct(F.col("program").alias("name")).alias("program")).alias("project")
    none = F.lit(None).cast("array<struct<exposure_id:string>>").alias("exposures")
    tree = t.cases.select("case_id", "submitter_id", project, none).join(dx, "case_id", "left").join(fu, "case_id", "left")
    rows = pt.patient_rows(tree, "https://portal.example/cases/", ["hallmark"])
    ids = lambda d: F.array_join(F.transform(d["treatments"], lambda x: x["treatment_id"]), ",")
    diagnoses = F.transform("diagnoses", lambda d: F.concat(d["diagnosis_id"].cast("string"), F.lit("["), ids(d), F.lit("]")))
    return rows.select(
        "case_id", "case_submitter_id", "project_id", "portal_url", F.col("program.name").alias("program"), F.size("diagnoses").cast("bigint").alias("n_diagnoses"),
        F.array_join(diagnoses, "|").alias("diagnoses"), F.array_join(F.transform("follow_ups", lambda x: x["follow_up_id"].cast("string")), "|").alias("follow_ups"),
        F.size("exposures").alias("n_exposures"), F.size("samples_pathology_report").alias("n_reports"), F.col("survival_derived.os_event").isNull().alias("underived"),
    )


@query("patient_lookup", with_("cases", "samples", body="""
SELECT case_id, submitter_id, sample_id, day FROM cases JOIN samples USING (case_id) WHERE submitter_id = 'Customer#000000007'"""))
def _patient_lookup(t: Tables):
    one = t.cases.filter(F.col("submitter_id") == "Customer#000000007")
    return one.join(t.samples, "case_id").select("case_id", "submitter_id", "sample_id", "day").orderBy("sample_id")


@query("axis_join", """
SELECT page_id AS i, url, md5(text) AS text_md5 FROM pages JOIN documents ON page_id = doc_id""")
def _axis_join(t: Tables):
    d = t.documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return t.pages.select(F.col("page_id").alias("i"), "url").join(d, F.col("i") == F.col("doc_id")).drop("doc_id")


@query("segments_at", with_("segments", "aliquots", "genes", body=""",
p AS (SELECT aliquot_id, center_id, gene_type AS chromosome, gene_id AS pos FROM aliquots JOIN genes USING (gene_id))
SELECT aliquot_id, pos, start, "end" AS stop, copy_number FROM p JOIN segments s ON s.center_id = p.center_id AND s.chromosome = 'chr' || p.chromosome AND pos BETWEEN start AND "end" """))
def _segments_at(t: Tables):
    p = t.aliquots.select("aliquot_id", "center_id", "gene_id").join(t.genes.select("gene_id", "gene_type"), "gene_id").select(
        "aliquot_id", "center_id", F.col("gene_type").alias("chromosome"), F.col("gene_id").alias("pos")
    )
    hit = rg.segments_at(p, t.segments, ["center_id"], "chromosome", "pos", bin_width=100)
    return hit.select("aliquot_id", "pos", "start", F.col("end").alias("stop"), "copy_number")


@query("loh_segments", """SELECT l_orderkey, l_partkey, l_discount, l_tax FROM lineitem WHERE l_tax = 0 AND l_discount > 0""")
def _loh(t: Tables):
    return rg.loh(t.lineitem, "l_tax", "l_discount").select("l_orderkey", "l_partkey", "l_discount", "l_tax")


@query("cohort_filters", """
SELECT d.doc_id FROM documents d JOIN labels l USING (doc_id) WHERE toxic <> 1 AND quality = 1 AND lang = 'en' AND n_chars / 10000.0 BETWEEN 0.1 AND 0.9""")
def _cohort_filters(t: Tables):
    ok = t.labels.filter("toxic <> 1 and quality = 1").select("doc_id")
    d = t.documents.select("doc_id", "lang", "n_chars").filter((F.col("lang") == "en") & (F.col("n_chars") / 10000.0).between(0.1, 0.9))
    return d.join(ok, "doc_id").select("doc_id")


@query("tumor_normal_pairs", with_("samples", "aliquots", body="""
SELECT DISTINCT a.sample_id AS tumor, b.sample_id AS normal FROM (SELECT DISTINCT sample_id AS x, sample_id + gene_id AS y FROM aliquots) v
JOIN samples a ON a.sample_id = x JOIN samples b ON b.sample_id = y"""))
def _tumor_normal_pairs(t: Tables):
    pairs = t.aliquots.select(F.col("sample_id").alias("x"), (F.col("sample_id") + F.col("gene_id")).alias("y")).distinct()
    s = t.samples
    p = rs.lookup(pairs, s, "x", "sample_id", {"sample_id": "tumor"}, "inner")
    return rs.lookup(p, s, "y", "sample_id", {"sample_id": "normal"}, "inner").select("tumor", "normal")


@query("missing_reports", with_("samples", body="""
SELECT sample_id, CAST(NULL AS BIGINT) AS reports FROM samples WHERE sample_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT sample_id, count(*) FROM samples JOIN (SELECT doc_id FROM documents) ON doc_id = sample_id GROUP BY 1"""))
def _missing_reports(t: Tables):
    reports = t.documents.groupBy(F.col("doc_id").alias("sample_id")).agg(F.count(F.lit(1)).alias("reports"))
    s = t.samples.select("sample_id")
    missing = rs.orphans(reports, s, "sample_id", "sample_id").withColumn("reports", F.lit(None).cast("bigint"))
    return missing.unionByName(s.join(reports, "sample_id"))


@query("gene_lookup", """SELECT vec_id, embedding[3]::DOUBLE AS value FROM embeddings WHERE label IN (1, 4)
UNION ALL SELECT vec_id, NULL FROM embeddings WHERE label NOT IN (1, 4)""")
def _gene_lookup(t: Tables):
    from cohortloom.operators.matrix import value_at

    # The gene axis of a record: position 3 is named g2 only in some of them.
    names = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.concat(F.lit("g"), i.cast("string")))
    axis = F.when(F.col("label").isin(1, 4), names).otherwise(F.transform(names, lambda n: F.concat(F.lit("x"), n)))
    return t.embeddings.select("vec_id", value_at(axis, F.col("embedding"), "g2").cast("double").alias("value"))


@query("file_provenance", with_("files", "samples", body="""
SELECT s.sample_id, f.md5sum, 'https://api.gdc.cancer.gov/data/' || f.file_id AS url FROM samples s JOIN files f ON f.file_id = s.sample_id % (SELECT count(*) FROM files)"""))
def _file_provenance(t: Tables):
    n = t.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = t.samples.select("sample_id", (F.col("sample_id") % n).alias("file_id"))
    f = t.files.select("file_id", "md5sum", sc.data_url(F.col("file_id")).alias("url"))
    return rs.with_provenance(rows, f, "file_id", ["md5sum", "url"]).drop("file_id")


@query("clause_filter", """SELECT p_partkey FROM part WHERE p_type = 'PROMO' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_size = 7
UNION ALL SELECT p_partkey FROM part WHERE p_type = 'SMALL' AND p_brand IN ('Brand#5')""")
def _clause_filter(t: Tables):
    def eq(f, v):
        return {"op": "=", "content": {"field": f, "value": v}}

    def in_(f, *v):
        return {"op": "in", "content": {"field": f, "value": list(v)}}

    a = {"op": "and", "content": [eq("p_type", "PROMO"), in_("p_brand", "Brand#1", "Brand#2", "Brand#3"), eq("p_size", 7)]}
    b = {"op": "and", "content": [eq("p_type", "SMALL"), in_("p_brand", "Brand#5")]}
    return t.part.filter(rs.clause_column(a) | rs.clause_column(b)).select("p_partkey")


@query("modality_rules", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE (l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linenumber = 3) OR (l_returnflag = 'R' AND l_linestatus = 'O' AND l_linenumber = 1)""")
def _modality_rules(t: Tables):
    rules = t.spark.createDataFrame(
        [("A", "F", None), ("N", None, 3), ("R", "O", 1)], "l_returnflag string, l_linestatus string, l_linenumber int"
    )
    hit = rs.rule_join(t.lineitem, rules, "l_returnflag", ["l_linestatus", "l_linenumber"])
    return hit.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("manifest_walk", """
SELECT event_id, user_id AS case_id FROM events e WHERE event_id IN (SELECT doc_id FROM documents)
 AND (event_type <> 'click' OR user_id = event_id % 150) AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _manifest_walk(t: Tables):
    m = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "click", F.array("user_id", F.col("event_id") % 150)).otherwise(F.array("user_id")).alias("case_ids"),
    )
    listing = t.documents.select(F.col("doc_id").alias("event_id"))
    known = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("case_id"))
    return rs.manifest_walk(m, listing, known, "event_id", "case_ids", "case_id").select("event_id", "case_id")


@query("local_files", """
WITH e AS (SELECT 0 AS src, event_id % 700 AS file_id, event_id AS pos, CASE WHEN event_type = 'error' THEN 'manifest_only' ELSE 'cached' END AS status FROM events
 UNION ALL SELECT 1, doc_id, doc_id, CASE WHEN lang = 'en' THEN 'manifest_only' ELSE 'downloaded' END FROM documents)
SELECT file_id, arg_max(pos, src * 1000000000 + pos) AS pos, arg_max(status, src * 1000000000 + pos) AS status FROM e WHERE status <> 'manifest_only' GROUP BY 1""")
def _local_files(t: Tables):
    a = t.events.select(
        (F.col("event_id") % 700).alias("file_id"), F.col("event_id").alias("pos"),
        F.when(F.col("event_type") == "error", "manifest_only").otherwise("cached").alias("status"),
    )
    b = t.documents.select(
        F.col("doc_id").alias("file_id"), F.col("doc_id").alias("pos"),
        F.when(F.col("lang") == "en", "manifest_only").otherwise("downloaded").alias("status"),
    )
    return rs.local_files([a, b], "file_id", ["pos"])


@query("manifest_status", with_("files", body=""",
h AS (SELECT f.file_id, f.project_id, l.doc_id IS NOT NULL AS cached, v.latest FROM files f LEFT JOIN labels l ON l.doc_id = f.file_id
  LEFT JOIN (SELECT page_id, page_id + page_id % 2 AS latest FROM pages) v ON v.page_id = f.file_id),
n AS (SELECT *, count_if(cached) OVER (PARTITION BY project_id) AS nc, row_number() OVER (PARTITION BY project_id, cached ORDER BY file_id) AS rn FROM h)
SELECT file_id, project_id, CASE WHEN cached THEN 'cached' WHEN rn <= greatest(0, 25 - nc) THEN 'downloaded' ELSE 'manifest_only' END AS status,
 coalesce(latest <> file_id, false) AS superseded FROM n"""))
def _manifest_status(t: Tables):
    hits = t.files.select("file_id", "project_id")
    cached = t.labels.select(F.col("doc_id").alias("file_id"))
    versions = t.pages.select(F.col("page_id").alias("file_id"), (F.col("page_id") + F.col("page_id") % 2).alias("latest_id"))
    return rs.manifest_status(hits, cached, versions, "file_id", "project_id", 25)


@query("merge_carry_forward", """
WITH old AS (SELECT doc_id AS file_id, lang AS project, 'old' AS build FROM documents),
new AS (SELECT page_id AS file_id, CASE WHEN page_id % 2 = 0 THEN 'en' ELSE 'fr' END AS project, 'new' AS build FROM pages)
SELECT * FROM old WHERE project NOT IN (SELECT project FROM new) UNION ALL SELECT * FROM new""")
def _carry(t: Tables):
    old = t.documents.select(F.col("doc_id").alias("file_id"), F.col("lang").alias("project"), F.lit("old").alias("build"))
    new = t.pages.select(
        F.col("page_id").alias("file_id"), F.when(F.col("page_id") % 2 == 0, "en").otherwise("fr").alias("project"), F.lit("new").alias("build")
    )
    return rs.carry_forward(old, new, "project")


@query("built_projects", """
WITH listing AS (SELECT DISTINCT source AS project FROM documents WHERE lang = 'fr'), rel AS (SELECT source AS project, max(n_chars) AS release FROM documents WHERE lang = 'en' GROUP BY 1)
SELECT l.project, release FROM listing l LEFT JOIN rel r USING (project)""")
def _built_projects(t: Tables):
    listing = t.documents.filter("lang = 'fr'").select(F.col("source").alias("project")).distinct()
    rel = t.documents.filter("lang = 'en'").groupBy(F.col("source").alias("project")).agg(F.max("n_chars").alias("release"))
    return rs.lookup(listing, rel, "project", "project", {"release": "release"})
