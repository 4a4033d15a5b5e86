"""Matrices, struct-of-arrays, wide/long, timeline and counting recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import scalars as sc
from cohortloom.operators import matrix as mx
from cohortloom.operators import resolve as rs
from cohortloom.operators import timeline as tl
from cohortloom.operators.patients import Children, flex_column, nest_lists
from cohortloom.operators.skew import nest, percentiles, pick_by, ranked
from cohortloom.plans.q_survival_rules import clinical
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, r6, with_

c = F.col


@query("struct_of_arrays", with_("aliquots", body="""
SELECT sample_id, string_agg(CAST(gene_id AS VARCHAR), ',' ORDER BY aliquot_id) AS genes, string_agg(CAST(CAST(quantity AS BIGINT) AS VARCHAR), ',' ORDER BY aliquot_id) AS quantities FROM aliquots GROUP BY ALL"""))
def _struct_of_arrays(t: Tables):
    a = t.aliquots.select("sample_id", "aliquot_id", "gene_id", c("quantity").cast("bigint").alias("quantity"))
    n = nest(a, ["sample_id"], [c("aliquot_id")], ["gene_id", "quantity"], "rows")
    record = F.struct(
        F.transform("rows", lambda x: x["gene_id"]).alias("gene_id"),
        F.transform("rows", lambda x: x["quantity"]).alias("quantity"),
    )
    s = n.select("sample_id", record.alias("record"))
    text = lambda f: F.array_join(F.transform(c("record")[f], lambda v: v.cast("string")), ",")
    return s.select("sample_id", text("gene_id").alias("genes"), text("quantity").alias("quantities"))


@query("variants_by_case", with_("samples", "aliquots", body="""
SELECT case_id, count(*) AS n, string_agg(aliquot_id, ',' ORDER BY aliquot_id) AS variants FROM aliquots JOIN samples USING (sample_id) GROUP BY 1"""))
def _variants_by_case(t: Tables):
    v = rs.lookup(t.aliquots.select("aliquot_id", "sample_id"), t.samples, "sample_id", "sample_id", {"case_id": "case_id"}, "inner")
    n = nest(v, ["case_id"], [c("aliquot_id")], ["aliquot_id"], "v")
    return n.select("case_id", F.size("v").cast("bigint").alias("n"), F.array_join(F.transform("v", lambda x: x["aliquot_id"]), ",").alias("variants"))


@query("axis_index", with_("cases", "samples", body="""
SELECT sample_id, row_number() OVER (ORDER BY project_id, sample_id) - 1 AS i FROM samples JOIN cases USING (case_id)"""))
def _axis_index(t: Tables):
    s = rs.lookup(t.samples.select("sample_id", "case_id"), t.cases, "case_id", "case_id", {"project_id": "project_id"}, "inner")
    # A single cohort-wide order: sliced from 4,000 rows on, so no task orders it all.
    return mx.axis_index(s, [c("project_id"), c("sample_id")], slice_rows=4000).select("sample_id", "i")


EMB = "e AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding) AS v FROM embeddings)"


def long_vectors(t: Tables):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("i", "v"))


@query("matrix_pack", "WITH " + EMB + """SELECT vec_id, count(*) AS width, round(sum(v::DOUBLE * (i + 1)), 6) AS weighted FROM e GROUP BY 1""")
def _matrix_pack(t: Tables):
    packed = mx.pack(long_vectors(t), "vec_id", "i", "v", n_genes=64)
    products = F.transform("values", lambda v, i: v.cast("double") * (i + 1))
    return packed.select(
        "vec_id", F.size("values").cast("bigint").alias("width"),
        F.round(F.aggregate(products, F.lit(0.0), lambda a, x: a + x), 6).alias("weighted"),
    )


SIX = ("unstranded", "stranded_first", "stranded_second", "tpm", "fpkm", "fpkm_uq")


@query("matrix_build", "WITH " + EMB + ", s AS (SELECT vec_id, i, abs(round(v::DOUBLE * 1000))::BIGINT AS q FROM e) SELECT vec_id, count(*) AS width, sum(q * (i + 1))::BIGINT AS unstranded, sum((q + i) * (i + 1))::BIGINT AS stranded_first, "
 + "sum((2 * q + 1) * (i + 1))::BIGINT AS stranded_second, round(sum(q / 8.0::DOUBLE * (i + 1)), 6) AS tpm, round(sum(q / 16.0::DOUBLE * (i + 1)), 6) AS fpkm, round(sum(q / 32.0::DOUBLE * (i + 1)), 6) AS fpkm_uq, "
 + "CASE WHEN vec_id % 7 <> 0 THEN vec_id * 3 END AS n_unmapped, vec_id + 1 AS n_ambiguous, round(sum(q + i)::DOUBLE / sum(3 * q + i + 1), 6) AS balance FROM s GROUP BY vec_id")
def _matrix_build(t: Tables):
    q = F.abs(F.round(c("v").cast("double") * 1000)).cast("bigint")
    gene = F.concat(F.lit("ENSG"), (63 - c("i")).cast("string"))
    long = long_vectors(t).select("vec_id", gene.alias("gene_id"), q.alias("q"), "i").select(
        "vec_id", "gene_id", c("q").alias(SIX[0]), (c("q") + c("i")).alias(SIX[1]), (2 * c("q") + 1).alias(SIX[2]), (c("q") / 8.0).alias(SIX[3]), (c("q") / 16.0).alias(SIX[4]), (c("q") / 32.0).alias(SIX[5]),
    )
    # The summary rows of a sample stand among its genes; one of them is missing in some samples.
    extra = t.embeddings.select("vec_id", F.explode(F.array(F.lit("N_unmapped"), F.lit("N_ambiguous"))).alias("gene_id"))
    extra = extra.withColumn(SIX[0], F.when(c("gene_id") == "N_unmapped", c("vec_id") * 3).otherwise(c("vec_id") + 1)).filter("gene_id <> 'N_unmapped' or vec_id % 7 <> 0")
    axis = t.spark.range(64).select(F.concat(F.lit("ENSG"), (63 - c("id")).cast("string")).alias("gene_id"), c("id").alias("gene_index"))
    m = mx.build(long.unionByName(extra, allowMissingColumns=True), axis, "vec_id", "gene_id", SIX, tallies={"N_unmapped": "n_unmapped", "N_ambiguous": "n_ambiguous"}, tally=SIX[0], strands=SIX[1:3])
    weighted = lambda v: F.aggregate(F.transform(v, lambda x, i: x * (i + 1)), F.lit(0).cast("bigint" if v in SIX[:3] else "double"), lambda a, x: a + x)
    return m.select("vec_id", F.size(SIX[0]).cast("bigint").alias("width"), *[weighted(v).alias(v) for v in SIX[:3]], *[F.round(weighted(v), 6).alias(v) for v in SIX[3:]], "n_unmapped", "n_ambiguous", r6(c("strand_balance")).alias("balance"))


@query("matrix_unpack", "WITH " + EMB + """SELECT vec_id, i AS gene_index, p_name AS gene_name, round(v::DOUBLE, 6) AS value FROM e JOIN part ON p_partkey = i""")
def _matrix_unpack(t: Tables):
    genes = t.part.select(c("p_partkey").alias("gene_index"), c("p_name").alias("gene_name"))
    u = mx.unpack(t.embeddings, "vec_id", "embedding", genes, "gene_index")
    return u.select("vec_id", "gene_index", "gene_name", r6(c("value")).alias("value"))


WIDE = """w AS (SELECT l_suppkey AS gene, coalesce(CAST(CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS BIGINT) AS VARCHAR), 'NA') AS "S-A",
 coalesce(CAST(CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS BIGINT) AS VARCHAR), '') AS "S-N", '-' || CAST(CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS VARCHAR) || '.5' AS "S-R" FROM lineitem GROUP BY 1)
"""


def wide_text(t: Tables):
    q = lambda cond: F.sum(F.when(cond, c("l_quantity"))).cast("bigint").cast("string")
    f = c("l_returnflag")
    return t.lineitem.groupBy(c("l_suppkey").alias("gene")).agg(
        F.coalesce(q(f == "A"), F.lit("NA")).alias("S-A"),
        F.coalesce(q(f == "N"), F.lit("")).alias("S-N"),
        F.concat(F.lit("-"), q(f == "R"), F.lit(".5")).alias("S-R"),
    )


@query("cna_long", "WITH " + WIDE + """SELECT gene, sample, CAST(v AS DOUBLE) AS value FROM (UNPIVOT w ON "S-A", "S-N", "S-R" INTO NAME sample VALUE v) WHERE v NOT IN ('NA', '')""")
def _cna_long(t: Tables):
    return mx.wide_to_long(wide_text(t), ["gene"])


@query("cna_long_keep", "WITH " + WIDE + """, u AS (SELECT gene, 'S-A' AS sample, "S-A" AS v FROM w UNION ALL SELECT gene, 'S-N', "S-N" FROM w UNION ALL SELECT gene, 'S-R', "S-R" FROM w) SELECT gene, sample, TRY_CAST(v AS DOUBLE) AS value FROM u""")
def _cna_long_keep(t: Tables):
    return mx.wide_to_long(wide_text(t), ["gene"], keep_absent=True)


@query("as_map", """SELECT vec_id, round(embedding[8]::DOUBLE, 6) AS g7, CASE WHEN label <> 3 THEN round(embedding[11]::DOUBLE, 6) END AS g10, CASE WHEN label = 3 THEN 63 ELSE 64 END AS entries FROM embeddings""")
def _as_map(t: Tables):
    e = t.embeddings
    names = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.concat(F.lit("g"), i.cast("string")))
    keep = F.transform("embedding", lambda v, i: (i != 10) | (c("label") != 3))
    m = e.select("vec_id", mx.as_map(names, c("embedding"), keep).alias("m"))
    at = lambda k: r6(F.try_element_at("m", F.lit(k)))
    return m.select("vec_id", at("g7").alias("g7"), at("g10").alias("g10"), F.size("m").alias("entries"))


LIB = """lib AS (SELECT l_orderkey AS lib, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS fwd, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS rev,
 sum(l_quantity) AS total, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS tally FROM lineitem GROUP BY 1)
"""


def libraries(t: Tables):
    q, f = c("l_quantity"), c("l_returnflag")
    return t.lineitem.groupBy(c("l_orderkey").alias("lib")).agg(
        F.sum(F.when(f == "A", q).otherwise(0)).alias("fwd"), F.sum(F.when(f == "R", q).otherwise(0)).alias("rev"),
        F.sum(q).alias("total"), F.sum(F.when(f == "N", q)).alias("tally"),
    )


@query("strand_summary", "WITH " + LIB + """, b AS (SELECT CASE WHEN fwd + rev > 0 THEN fwd / (fwd + rev) END AS b FROM lib)
SELECT count(*) AS libraries, count(b) AS stranded, round(quantile_cont(b, 0.5), 6) AS median, round(quantile_cont(b, 0.01), 6) AS p1, round(quantile_cont(b, 0.99), 6) AS p99, count_if(b < 0.4 OR b > 0.6)::BIGINT AS outside FROM b""")
def _strand_summary(t: Tables):
    b = libraries(t).select(mx.strand_balance(c("fwd"), c("rev")).alias("b"), F.lit("all").alias("cohort"))
    counts = {
        "libraries": F.count(F.lit(1)), "stranded": F.count("b"),
        "outside": F.count_if((c("b") < 0.4) | (c("b") > 0.6)),
    }
    j = percentiles(b, ["cohort"], "b", {"median": 0.5, "p1": 0.01, "p99": 0.99}, also=counts)
    return j.select("libraries", "stranded", *[r6(c(x)).alias(x) for x in ("median", "p1", "p99")], "outside")


@query("assigned_summary", "WITH " + LIB + """SELECT count(*) AS n, round(min(1 - tally / total), 6) AS lo, round(max(1 - tally / total), 6) AS hi FROM lib WHERE tally IS NOT NULL""")
def _assigned(t: Tables):
    whole = libraries(t).filter(c("tally").isNotNull())
    share = 1 - c("tally") / c("total")
    return whole.agg(F.count(F.lit(1)).alias("n"), r6(F.min(share)).alias("lo"), r6(F.max(share)).alias("hi"))


@query("value_counts", "SELECT l_returnflag AS category, l_linestatus AS value, count(*) AS n FROM lineitem GROUP BY ALL")
def _value_counts(t: Tables):
    return t.lineitem.groupBy(c("l_returnflag").alias("category"), c("l_linestatus").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query("dup_samples", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _dup_samples(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("barcode_nesting", with_("aliquots", body="""
SELECT analyte_type, count(*) AS n, count_if(NOT starts_with(aliquot_id, CAST(sample_id AS VARCHAR) || '-1'))::BIGINT AS not_extending FROM aliquots GROUP BY 1"""))
def _barcode_nesting(t: Tables):
    parent = F.concat(c("sample_id").cast("string"), F.lit("-1"))
    return t.aliquots.groupBy("analyte_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~c("aliquot_id").startswith(parent)).alias("not_extending")
    )


@query("single_release", "SELECT lang AS cohort, count(DISTINCT source) AS releases, CASE WHEN count(DISTINCT source) = 1 THEN min(source) END AS release FROM documents GROUP BY 1")
def _single_release(t: Tables):
    d = t.documents.select(c("lang").alias("cohort"), "source").distinct()
    g = d.groupBy("cohort").agg(F.count(F.lit(1)).alias("releases"), F.min("source").alias("one"))
    return g.select("cohort", "releases", F.when(c("releases") == 1, c("one")).alias("release"))


@query("geneset_sizes", "SELECT min(n) AS smallest, max(n) AS largest, count(*) AS sets FROM (SELECT p_brand, count(DISTINCT p_partkey) AS n FROM part GROUP BY 1)")
def _geneset_sizes(t: Tables):
    sizes = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.min("n").alias("smallest"), F.max("n").alias("largest"), F.count(F.lit(1)).alias("sets"))


@query("files_facets", with_("files", body="SELECT data_type, count(*) AS n, CAST(sum(file_size) AS BIGINT) AS bytes FROM files GROUP BY 1"))
def _files_facets(t: Tables):
    return t.files.groupBy("data_type").agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("bytes"))


@query("files_in_dataset", with_("files", body="""
SELECT l.doc_id IS NOT NULL AS in_dataset, count(*) AS n, round(sum(file_size) / 1e6::DOUBLE, 6) AS mb FROM files f LEFT JOIN labels l ON l.doc_id = f.file_id GROUP BY 1"""))
def _files_in_dataset(t: Tables):
    f = t.files.select("file_id", "file_size")
    j = f.join(t.labels.select("doc_id"), c("file_id") == c("doc_id"), "left")
    return j.groupBy(c("doc_id").isNotNull().alias("in_dataset")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("file_size") / 1e6).alias("mb")
    )


@query("table_counts", """SELECT 'customer' AS tbl, count(*) AS n, count(DISTINCT c_custkey) AS cases FROM customer
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'events', count(*), count(DISTINCT user_id) FROM events
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem""")
def _table_counts(t: Tables):
    parts = []
    for name, key in (("customer", "c_custkey"), ("orders", "o_custkey"), ("events", "user_id"), ("lineitem", "l_orderkey")):
        per_key = getattr(t, name).groupBy(c(key).alias("k")).agg(F.count(F.lit(1)).alias("m"))
        parts.append(per_key.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("cases")).select(F.lit(name).alias("tbl"), "n", "cases"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


EVENTS9 = """
diag AS (SELECT o_custkey AS case_id, CASE WHEN o_orderkey % 9 <> 0 THEN date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) - 1096 END AS day, o_orderkey, o_orderpriority FROM orders),
fu AS (SELECT user_id AS case_id, CASE WHEN event_id % 11 <> 0 THEN date_diff('day', TIMESTAMP '2024-01-01', ts) * 40 + 1000 END AS day, event_id,
  CASE event_type WHEN 'purchase' THEN 'WT-With Tumor' WHEN 'view' THEN 'TF-Tumor Free' WHEN 'click' THEN 'Tumor Free' END AS resp FROM events),
tlx AS (SELECT c_custkey AS case_id, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 100 - 50 END AS day, 0 AS seq, 'consent' AS category, 'Informed' AS label, NULL::VARCHAR AS ident FROM customer
 UNION ALL SELECT case_id, day, 1, 'diagnosis', o_orderpriority, CAST(o_orderkey AS VARCHAR) FROM diag
 UNION ALL SELECT case_id, day + 10, 2, 'treatment_start', 'Drug', CAST(o_orderkey AS VARCHAR) FROM diag
 UNION ALL SELECT case_id, CASE WHEN o_orderkey % 4 <> 0 THEN day + 40 END, 3, 'treatment_end', 'Drug', CAST(o_orderkey AS VARCHAR) FROM diag
 UNION ALL SELECT case_id, day, 4, 'follow_up', resp, CAST(event_id AS VARCHAR) FROM fu
 UNION ALL SELECT o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 5 + o_orderkey % 30 END, 5, 'sample_procurement', o_orderstatus, CAST(o_orderkey AS VARCHAR) FROM orders
 UNION ALL SELECT o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3000 END, 6, 'bcr_receipt', o_orderstatus, CAST(o_orderkey AS VARCHAR) FROM orders
 UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 10 = 8 THEN 4000 END, 7, 'lost_to_followup', 'Yes', NULL FROM customer
 UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 <> 1 AND c_custkey % 8 <> 3 THEN 900 + c_custkey % 1500 END, 8, 'death', CASE WHEN c_custkey % 10 = 9 THEN 'Unknown' WHEN c_custkey % 3 = 1 THEN 'Alive' ELSE 'Dead' END, NULL FROM customer)
"""


def dated_samples(t: Tables):
    k = c("o_orderkey")
    return t.orders.select(
        c("o_custkey").alias("case_id"), k.alias("sample_id"), c("o_orderstatus").alias("sample_type"),
        F.when(k % 2 == 0, 5 + k % 30).alias("days_to_sample_procurement"),
        F.when(k % 7 != 0, k % 3000).alias("days_to_collection"),
    )


TIMELINE = """
tm AS (SELECT c_custkey AS case_id, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 100 - 50 END AS day, 0 AS g, 0 AS parent, 0 AS child, 0 AS step, 'consent' AS category, 'Informed' AS label, NULL::BIGINT AS dx, NULL::VARCHAR AS tx, NULL::BIGINT AS fu, NULL::BIGINT AS smp FROM customer
 UNION ALL SELECT case_id, day, 1, o_orderkey, 0, 0, 'diagnosis', CASE o_orderkey % 7 WHEN 0 THEN 'Stage IV' WHEN 1 THEN ' stage iva' WHEN 2 THEN 'Stage IIIA' WHEN 3 THEN 'Stage I' END, o_orderkey, NULL, NULL, NULL FROM diag
 UNION ALL SELECT case_id, day + 10 * (o_orderkey % 2), 1, o_orderkey, 1, 0, 'treatment_start', 'Drug', o_orderkey, 'tx-' || o_orderkey, NULL, NULL FROM diag
 UNION ALL SELECT case_id, CASE WHEN o_orderkey % 4 <> 0 THEN day + 40 END, 1, o_orderkey, 1, 1, 'treatment_end', 'Drug', o_orderkey, 'tx-' || o_orderkey, NULL, NULL FROM diag
 UNION ALL SELECT case_id, day, 2, event_id, 0, 0, 'follow_up', resp, NULL, NULL, event_id, NULL FROM fu
 UNION ALL SELECT o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 5 + o_orderkey % 30 END, 3, o_orderkey, 0, 0, 'sample_procurement', o_orderstatus, NULL, NULL, NULL, o_orderkey FROM orders
 UNION ALL SELECT o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3000 END, 3, o_orderkey, 0, 1, 'bcr_receipt', o_orderstatus, NULL, NULL, NULL, o_orderkey FROM orders
 UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 10 = 8 THEN 4000 END, 4, 0, 0, 0, 'lost_to_followup', 'Yes', NULL, NULL, NULL, NULL FROM customer
 UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 <> 1 AND c_custkey % 8 <> 3 THEN 900 + c_custkey % 1500 END, 4, 0, 0, 1, 'death', CASE WHEN c_custkey % 10 = 9 THEN 'Unknown' WHEN c_custkey % 3 = 1 THEN 'Alive' ELSE 'Dead' END, NULL, NULL, NULL, NULL FROM customer)
SELECT case_id, day::DOUBLE AS day, category, label, CAST(dx AS VARCHAR) AS diagnosis_id, tx AS treatment_id, CAST(fu AS VARCHAR) AS follow_up_id, CAST(smp AS VARCHAR) AS sample_id,
 row_number() OVER (PARTITION BY case_id ORDER BY day, g, parent, child, step) AS pos FROM tm WHERE day IS NOT NULL"""


@query("timeline", "WITH " + EVENTS9 + "," + TIMELINE)
def _timeline(t: Tables):
    _, dx, _, fu, _ = clinical(t)
    k, d = c("case_id"), c("dx_id")
    cases = t.customer.select(c("c_custkey").alias("case_id"))
    status = F.when(k % 10 == 9, "Unknown").when(k % 3 == 1, "Alive").otherwise("Dead")
    own = {"diagnosis_id": d}
    both = {"diagnosis_id": d, "treatment_id": F.concat(F.lit("tx-"), d.cast("string"))}
    day = c("days_to_diagnosis")
    sample = {"sample_id": c("sample_id")}
    parts = [
        tl.events_of(cases, [
            tl.Event("consent", F.when(k % 3 == 0, k % 100 - 50), F.lit("Informed"), "opening"),
            tl.Event("lost_to_followup", F.when(k % 10 == 8, 4000), F.lit("Yes"), "closing", step=0),
            tl.Event("death", F.when((k % 3 != 1) & (k % 8 != 3), 900 + k % 1500), status, "closing", step=1),
        ]),
        tl.events_of(dx, [
            tl.Event("diagnosis", day, c("stage"), "diagnosis", d, 0, 0, own),
            tl.Event("treatment_start", day + 10 * (d % 2), F.lit("Drug"), "diagnosis", d, 1, 0, both),
            tl.Event("treatment_end", F.when(d % 4 != 0, day + 40), F.lit("Drug"), "diagnosis", d, 1, 1, both),
        ]),
        tl.events_of(fu, [tl.Event("follow_up", c("days_to_follow_up"), c("disease_response"), "follow_up", c("fu_id"), ids={"follow_up_id": c("fu_id")})]),
        tl.events_of(dated_samples(t), [
            tl.Event("sample_procurement", c("days_to_sample_procurement"), c("sample_type"), "sample", c("sample_id"), step=0, ids=sample),
            tl.Event("bcr_receipt", c("days_to_collection"), c("sample_type"), "sample", c("sample_id"), step=1, ids=sample),
        ]),
    ]
    out = ranked(tl.timeline(parts), ["case_id"], [c(x) for x in tl.READING], "pos")
    return out.select("case_id", "day", "category", "label", *tl.ID_COLUMNS, "pos")


@query("consistency_check", "WITH " + EVENTS9 + """, d AS (SELECT c_custkey AS case_id, CASE WHEN c_custkey % 3 <> 1 AND c_custkey % 8 <> 3 THEN 900 + c_custkey % 1500 END AS death FROM customer),
s AS (SELECT o_custkey AS case_id, CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS p, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3000 END AS col FROM orders),
sa AS (SELECT case_id, count_if(col > death)::BIGINT AS a, count_if(p IS NULL AND col IS NULL)::BIGINT AS b FROM s JOIN d USING (case_id) GROUP BY 1),
ta AS (SELECT case_id, count_if(day + 10 < 0)::BIGINT AS x FROM diag GROUP BY 1)
SELECT case_id, coalesce(a, 0) AS receipts_after_death, coalesce(b, 0) AS undated_samples, coalesce(x, 0) AS pre_index_treatments, CASE WHEN case_id % 20 = 3 THEN 1 ELSE 0 END AS other_index FROM d LEFT JOIN sa USING (case_id) LEFT JOIN ta USING (case_id)""")
def _consistency(t: Tables):
    cases, dx, _, _, _ = clinical(t)
    cases = cases.withColumn("index_date", F.when(c("case_id") % 20 == 3, "Sample Procurement").when(c("case_id") % 20 == 4, None).otherwise("Diagnosis"))
    tx = dx.select("case_id", (c("days_to_diagnosis") + 10).alias("days_to_start"))
    return tl.consistency_check(cases, dated_samples(t), tx)


@query("after_death", """WITH d AS (SELECT c_custkey AS case_id, CASE WHEN c_custkey % 3 <> 1 AND c_custkey % 8 <> 3 THEN 900 + c_custkey % 1500 END AS days_to_death FROM customer),
s AS (SELECT DISTINCT o_custkey AS case_id, o_orderkey % 3000 AS days_to_collection FROM orders WHERE o_orderkey % 7 <> 0),
m AS (SELECT case_id, max(days_to_collection) AS mx FROM s GROUP BY 1)
SELECT case_id, days_to_death, mx - days_to_death AS delta, days_to_collection FROM d JOIN m USING (case_id) JOIN s USING (case_id) WHERE mx > days_to_death""")
def _after_death(t: Tables):
    cases = clinical(t)[0].select("case_id", "days_to_death")
    return tl.after_death(cases, dated_samples(t))


@query("source_digest", with_("files", body="""
, ln AS (SELECT project_id, file_id || chr(9) || md5sum || chr(10) AS line FROM files),
SELECT project_id, count(*) AS n, sha256(string_agg(line, '' ORDER BY line)) AS digest FROM ln GROUP BY 1"""))
def _source_digest(t: Tables):
    from cohortloom.operators.sets import source_digest

    return source_digest(t.files, ["project_id"], "file_id", "md5sum")


@query("set_diff", """SELECT 'missing' AS side, c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT user_id * 7 FROM events)
UNION ALL SELECT 'unexpected', k FROM (SELECT DISTINCT user_id * 7 AS k FROM events) WHERE k NOT IN (SELECT c_custkey FROM customer)""")
def _set_diff(t: Tables):
    from cohortloom.operators.sets import set_diff

    want = t.customer.select(c("c_custkey").alias("id"))
    have = t.events.select((c("user_id") * 7).alias("id"))
    return set_diff(want, have, "id")


@query("union_pad", """SELECT page_id AS id, url, NULL::VARCHAR AS role FROM pages UNION ALL SELECT conv_id, NULL, role FROM conversations""")
def _union_pad(t: Tables):
    from cohortloom.operators.sets import union_pad

    a = t.pages.select(c("page_id").alias("id"), "url")
    b = t.conversations.select(c("conv_id").alias("id"), "role")
    return union_pad([a, b])


@query("dedupe_files", """SELECT event_type, user_id, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL""")
def _dedupe(t: Tables):
    e = t.events.select("event_type", "user_id", "event_id", "value")
    return pick_by(e, ["event_type", "user_id"], [c("event_id")])


@query("sample_per_group", """SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY sha256('7:' || doc_id), doc_id) <= 3""")
def _sample_per_group(t: Tables):
    from cohortloom.operators.sets import sample_per_group

    return sample_per_group(t.documents.select("doc_id", "source"), ["source"], "doc_id", 3, "7")


@query("files_by_case", """SELECT case_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM (SELECT event_id, unnest(list_distinct([user_id, event_id % 200])) AS case_id FROM events) GROUP BY 1""")
def _files_by_case(t: Tables):
    m = t.events.select("event_id", F.array_distinct(F.array("user_id", c("event_id") % 200)).alias("cases"))
    by_case = m.select("event_id", F.explode("cases").alias("case_id"))
    return by_case.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("flex_forms", with_("forms", body="SELECT case_id, kind, count(*) AS n, sum(row_no)::BIGINT AS rows, sum(k::BIGINT)::BIGINT AS ks FROM forms GROUP BY ALL"))
def _flex_forms(t: Tables):
    # One struct column per case, of the forms that any case has; the sixth kind has no rows and no field.
    kinds = ["click", "error", "purchase", "radiation", "signup", "view"]
    forms = {k: Children(t.forms.filter(c("kind") == k), "case_id", [c("row_no")], ["row_no", "k"]) for k in kinds}
    wide = nest_lists(t.forms.select("case_id").distinct(), "case_id", forms)
    flex = flex_column(wide, kinds, "supplement")
    names = flex.schema["supplement"].dataType.names
    total = lambda rows, f: F.aggregate(rows, F.lit(0).cast("bigint"), lambda a, x: a + x[f].cast("bigint"))
    each = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.size(f"supplement.{k}").cast("bigint").alias("n"), total(c(f"supplement.{k}"), "row_no").alias("rows"), total(c(f"supplement.{k}"), "k").alias("ks"))
        for k in names
    ]))
    return flex.select("case_id", each.alias("e")).select("case_id", "e.*").filter("n > 0")


@query("form_slice", """WITH ln AS (SELECT conv_id, turn, role || chr(9) || md5(text) AS line FROM conversations),
h AS (SELECT 'role' || chr(9) || 'text' || chr(10) || 'r_alias' || chr(9) || 't_alias' || chr(10) || 'cde1' || chr(9) || 'cde2' AS head)
SELECT conv_id, md5(head || chr(10) || string_agg(line, chr(10) ORDER BY turn, line)) AS slice_md5, count(*) AS lines FROM ln, h GROUP BY conv_id, head""")
def _form_slice(t: Tables):
    from cohortloom.operators.sets import form_slices

    lines = t.conversations.select("conv_id", "turn", F.concat("role", F.lit("\t"), F.md5(c("text").cast("binary"))).alias("line"))
    head = ["role\ttext", "r_alias\tt_alias", "cde1\tcde2"]
    s = form_slices(lines, "conv_id", [c("turn"), c("line")], "line", head)
    return s.select("conv_id", F.md5(c("content").cast("binary")).alias("slice_md5"), c("n_lines").alias("lines"))
