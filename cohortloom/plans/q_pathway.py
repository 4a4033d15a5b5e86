"""Gene universe, ranks, pathway scores and reference distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import pathway as pw
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, r6, with_


@query("gene_universe", with_("genes", body="""
SELECT gene_id, gene_name, gene_type FROM genes WHERE gene_type IN ('PROMO', 'LARGE', 'SMALL') AND NOT contains(gene_name, 'red')"""))
def _gene_universe(t: Tables):
    g = pw.gene_universe(t.genes, "gene_name", "gene_type", ("PROMO", "LARGE", "SMALL"), "red")
    return g.select("gene_id", "gene_name", "gene_type")


@query("expr_matrix_long", with_("genes", body=""", axis AS (SELECT gene_name AS symbol, min(gene_id) AS gene_order FROM genes WHERE gene_type <> 'PROMO' GROUP BY 1)
SELECT l_suppkey AS sample_id, symbol, gene_order, max(l_quantity) AS value
FROM lineitem JOIN genes ON l_partkey = gene_id JOIN axis ON symbol = gene_name GROUP BY ALL"""))
def _expr_matrix_long(t: Tables):
    axis = t.genes.filter("gene_type <> 'PROMO'").groupBy(F.col("gene_name").alias("symbol")).agg(
        F.min("gene_id").alias("gene_order")
    )
    expr = t.aliquots.select(F.col("center_id").alias("sample_id"), "gene_id", F.col("quantity").alias("value"))
    expr = expr.join(t.genes.select("gene_id", F.col("gene_name").alias("symbol")), "gene_id")
    return pw.expr_matrix_long(expr, axis, "sample_id", "symbol", "value")


@query("map_gene_sets", """
WITH sets AS (SELECT p_brand AS pathway, p_name AS symbol FROM part),
axis AS (SELECT DISTINCT p_name AS symbol FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_discount > 0.09 AND l_quantity > 45)
SELECT pathway, count(*) AS members, count(a.symbol) AS matched, round(count(a.symbol) / count(*)::DOUBLE, 6) AS fraction,
 count(a.symbol) BETWEEN 10 AND 500 AS kept
FROM (SELECT DISTINCT * FROM sets) s LEFT JOIN axis a ON s.symbol = a.symbol GROUP BY pathway""")
def _map_gene_sets(t: Tables):
    sets = t.part.select(F.col("p_brand").alias("pathway"), F.col("p_name").alias("symbol"))
    seen = t.lineitem.filter("l_discount > 0.09 and l_quantity > 45").select("l_partkey")
    axis = t.part.join(seen, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select(
        F.col("p_name").alias("symbol")
    )
    return pw.map_gene_sets(sets, axis, "symbol", 10, 500)


@query("average_rank", with_("expression", body="""
SELECT sample_id, gene_id, floor(rank() OVER (PARTITION BY sample_id ORDER BY value) + (count(*) OVER (PARTITION BY sample_id, value) - 1) / 2.0)::BIGINT AS r FROM expression"""))
def _average_rank(t: Tables):
    r = pw.average_rank(t.expression, "sample_id", "value", "r")
    return r.select("sample_id", "gene_id", F.floor("r").alias("r"))


SSGSEA = with_("expression", "genes", body=""",
r AS (SELECT sample_id, gene_id, floor(rank() OVER (PARTITION BY sample_id ORDER BY value) + (count(*) OVER (PARTITION BY sample_id, value) - 1) / 2.0) AS r FROM expression),
p AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY r DESC, gene_id) AS p, count(*) OVER (PARTITION BY sample_id) AS n FROM r),
scores AS (SELECT sample_id, pathway, count(*) AS n_genes,
  sum(r ** 0.25 * (n - p + 1)) / sum(r ** 0.25) - (max(n) * (max(n) + 1) / 2.0 - sum(n - p + 1)) / nullif(max(n) - count(*), 0) AS score_raw
  FROM p JOIN genes USING (gene_id) GROUP BY sample_id, pathway)
""")


@query("ssgsea_scores", SSGSEA + "SELECT sample_id, pathway, n_genes, round(score_raw, 6) AS score_raw FROM scores")
def _ssgsea(t: Tables):
    s = pw.ssgsea_scores(t.expression, t.genes)
    return s.withColumn("score_raw", r6(F.col("score_raw")))


@query("ssgsea_on_axis", with_("expression", "genes", body=""",
axis AS (SELECT p_partkey AS gene_id FROM part WHERE p_size > 10),
s AS (SELECT DISTINCT sample_id FROM expression JOIN axis USING (gene_id)),
filled AS (SELECT s.sample_id, a.gene_id, coalesce(e.value - 30, 0)::FLOAT AS value FROM s CROSS JOIN axis a LEFT JOIN expression e ON e.sample_id = s.sample_id AND e.gene_id = a.gene_id),
r AS (SELECT sample_id, gene_id, floor(rank() OVER (PARTITION BY sample_id ORDER BY value) + (count(*) OVER (PARTITION BY sample_id, value) - 1) / 2.0) AS r FROM filled),
p AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY r DESC, gene_id) AS p, count(*) OVER (PARTITION BY sample_id) AS n FROM r)
SELECT sample_id, pathway, count(*) AS n_genes,
  round(sum(r ** 0.25 * (n - p + 1)) / sum(r ** 0.25) - (max(n) * (max(n) + 1) / 2.0 - sum(n - p + 1)) / nullif(max(n) - count(*), 0), 6) AS score_raw
  FROM p JOIN genes USING (gene_id) GROUP BY sample_id, pathway"""))
def _ssgsea_on_axis(t: Tables):
    # Samples lack most genes of the axis; values are shifted so that zeros and negative ones occur.
    expr = t.expression.withColumn("value", F.col("value") - 30)
    axis = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("gene_id"))
    s = pw.ssgsea_scores_on_axis(expr, axis, t.genes)
    return s.withColumn("score_raw", r6(F.col("score_raw")))


SCORES = """scores AS (SELECT l_suppkey AS sample_id, p_brand AS pathway, n_name AS project_id,
  CASE WHEN s_acctbal < 3000 THEN 'normal' ELSE 'tumor' END AS sample_type, CAST(sum(l_quantity) AS DOUBLE) AS score_raw
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
"""
STATS = """, wide AS (SELECT unnest([project_id, 'pan']) AS population, sample_type, pathway, score_raw AS v FROM scores),
 wide2 AS (SELECT population, unnest([sample_type, 'all']) AS type, pathway, v FROM wide),
 stats AS (SELECT population, type, pathway, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS sd, min(v) AS min, max(v) AS max,
  quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q75 FROM wide2 GROUP BY ALL)
"""


def scores(t: Tables):
    # Sum before the dimension joins: the joins then see one row per (sample, gene).
    g = t.expression.join(t.genes.select("gene_id", "pathway"), "gene_id")
    s = g.groupBy("sample_id", "pathway").agg(F.sum("value").alias("score_raw"))
    sup = t.supplier.join(t.projects, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("sample_id"),
        "project_id",
        F.when(F.col("s_acctbal") < 3000, "normal").otherwise("tumor").alias("sample_type"),
    )
    return s.join(sup, "sample_id")


def stats(t: Tables):
    return pw.score_stats(scores(t), "project_id", "sample_type", "pathway", "score_raw")


STAT_COLS = ["mean", "sd", "min", "max", "q25", "median", "q75"]


@query("score_stats", "WITH " + SCORES + STATS + """SELECT population, type, pathway, n, round(mean, 6) AS mean, round(sd, 6) AS sd,
 round(min, 6) AS min, round(max, 6) AS max, round(q25, 6) AS q25, round(median, 6) AS median, round(q75, 6) AS q75 FROM stats""")
def _score_stats(t: Tables):
    return stats(t).select("population", "type", "pathway", "n", *[r6(F.col(c)).alias(c) for c in STAT_COLS])


@query("normalize_global", "WITH " + SCORES + """SELECT sample_id, pathway, round(score_raw / (SELECT max(score_raw) - min(score_raw) FROM scores), 6) AS score FROM scores""")
def _normalize(t: Tables):
    n = pw.normalize_global(scores(t), "score_raw")
    return n.select("sample_id", "pathway", r6(F.col("score")).alias("score"))


@query("zscore", "WITH " + SCORES + STATS + """SELECT sample_id, s.pathway, round((score_raw - mean) / nullif(sd, 0), 6) AS z
FROM scores s JOIN stats t ON t.population = s.project_id AND t.type = s.sample_type AND t.pathway = s.pathway""")
def _zscore(t: Tables):
    ref = stats(t).withColumnsRenamed({"population": "project_id", "type": "sample_type"})
    z = pw.zscore(scores(t), ref, ["project_id", "sample_type", "pathway"], "score_raw")
    return z.select("sample_id", "pathway", r6(F.col("z")).alias("z"))
