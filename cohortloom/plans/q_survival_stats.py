"""Kaplan-Meier, follow-up medians, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import folds as fo
from cohortloom.operators import km
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, r6, with_

HORIZONS = {"h1": 1461, "h2": 2192, "h3": 3600}

KM = with_("cohort", body=""",
steps AS (SELECT grp, t, sum(e) AS d, count(*) AS c FROM cohort GROUP BY grp, t),
risk AS (SELECT *, sum(c) OVER (PARTITION BY grp ORDER BY t DESC) AS n FROM steps),
curve AS (SELECT grp, t, d, c, n,
  CASE WHEN sum(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w > 0 THEN 0.0
       ELSE exp(sum(CASE WHEN d < n THEN ln(1 - d::DOUBLE / n) ELSE 0 END) OVER w) END AS surv
  FROM risk WINDOW w AS (PARTITION BY grp ORDER BY t))
""")


@query("km_curve", KM + """SELECT grp, t, CAST(d AS BIGINT) AS d, CAST(n AS BIGINT) AS n, round(surv, 6) AS surv FROM curve""")
def _km_curve(t: Tables):
    c = km.km_curve(t.cohort, "grp", "t", "e")
    return c.select("grp", "t", "d", "n", r6(F.col("surv")).alias("surv"))


@query("km_horizon", KM + """, hz(horizon, h) AS (VALUES ('h1', 1461), ('h2', 2192), ('h3', 3600)),
cut AS (SELECT grp, horizon, h, min(t) FILTER (WHERE d > 0 AND t >= h) AS cut, max(t) AS tmax
        FROM curve CROSS JOIN hz GROUP BY ALL)
SELECT grp, horizon, round(CASE WHEN cut IS NULL AND tmax < h THEN NULL
  ELSE coalesce((SELECT min(surv) FROM curve v WHERE v.grp = cut.grp AND d > 0 AND (cut.cut IS NULL OR v.t <= cut.cut)), 1.0) END, 3) AS surv
FROM cut""")
def _km_horizon(t: Tables):
    return km.km_horizon(t.cohort, "grp", "t", "e", HORIZONS)


@query("table2", with_("cohort", body="""
SELECT grp, kind, round(quantile_cont(t, 0.5) / 30.44, 1) AS months FROM (
  SELECT grp, t, 'all' AS kind FROM cohort
  UNION ALL SELECT grp, t, CASE e WHEN 1 THEN 'event' ELSE 'censored' END FROM cohort) GROUP BY grp, kind"""))
def _table2(t: Tables):
    return km.follow_up_medians(t.cohort, "grp", "t", "e")


HEXMOD = """list_reduce(list_prepend(0::bigint, list_transform(string_split(sha256({t}),''),
 lambda x: (strpos('0123456789abcdef',x)-1)::bigint)), lambda a, x: (a*16+x)%10)"""
STATUS = """chosen AS (SELECT sample_id AS case_id, grp AS project_id, c_e, d_e,
  (c_e IS NOT NULL OR c_t IS NOT NULL) AND sample_id % 17 <> 0 AS use FROM endpoints),
patients AS (SELECT case_id, project_id,
  CASE WHEN coalesce(CASE WHEN use THEN c_e ELSE d_e END, -1) = -1 THEN 'missing' WHEN (CASE WHEN use THEN c_e ELSE d_e END) = 1 THEN 'event' ELSE 'censored' END AS pfi_status,
  CASE WHEN coalesce(CASE WHEN use THEN 1 - c_e ELSE d_e END, -1) = -1 THEN 'missing' WHEN (CASE WHEN use THEN 1 - c_e ELSE d_e END) = 1 THEN 'event' ELSE 'censored' END AS os_status,
  CASE WHEN use THEN 'curated' ELSE 'derived' END AS status_source FROM chosen)
"""
DEAL = """, pos AS (SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY
   CASE pfi_status WHEN 'event' THEN 1 WHEN 'censored' THEN 2 ELSE 3 END,
   CASE os_status WHEN 'event' THEN 1 WHEN 'censored' THEN 2 ELSE 3 END,
   sha256('tcga-patient-folds:v1:' || case_id)) - 1 AS pos FROM patients),
offs AS (SELECT project_id, """ + HEXMOD.format(t="'tcga-patient-folds:v1:' || project_id") + """ AS off FROM (SELECT DISTINCT project_id FROM patients)),
folds AS (SELECT p.*, CAST((pos + off) % 10 AS TINYINT) AS fold_10, CAST((pos + off) % 10 % 5 AS TINYINT) AS fold_5
  FROM pos p JOIN offs o ON p.project_id = o.project_id)
"""


def patients(t: Tables):
    e = t.endpoints.withColumnsRenamed({"grp": "project_id"})
    derived = e.select(
        F.col("sample_id").alias("case_id"), "project_id",
        F.col("d_e").alias("pfi"), F.col("d_e").alias("os"),
    )
    curated = e.filter("c_e is not null or c_t is not null").select(
        F.col("sample_id").alias("case_id"), F.col("c_e").alias("pfi"), (1 - F.col("c_e")).alias("os"),
        F.when(F.col("sample_id") % 17 == 0, "Redacted").alias("redaction"),
    )
    out = fo.status_choice(derived, curated, "case_id", ["pfi", "os"], "redaction")
    return out.drop("pfi", "os")


def dealt(t: Tables):
    return fo.deal(patients(t), count_on=t.cohort.select(F.col("grp").alias("project_id")))


@query("status_choice", with_("endpoints", body="," + STATUS + "SELECT * FROM patients"))
def _status_choice(t: Tables):
    return patients(t)


@query("fold_deal", with_("endpoints", body="," + STATUS + DEAL + "SELECT case_id, project_id, fold_10, fold_5 FROM folds"))
def _fold_deal(t: Tables):
    return dealt(t).select("case_id", "project_id", "fold_10", "fold_5")


@query("fold_events", with_("endpoints", body="," + STATUS + """
SELECT project_id, count(*) AS patients, count_if(pfi_status = 'event')::BIGINT AS events,
 round(count_if(pfi_status = 'event') / 10.0::DOUBLE, 6) AS events_per_fold, count_if(pfi_status = 'event') / 10.0 < 5 AS few_events
FROM patients GROUP BY project_id"""))
def _fold_events(t: Tables):
    return fo.fold_events(patients(t))


@query("fold_balance", with_("endpoints", body="," + STATUS + DEAL + """,
per AS (SELECT project_id, pfi_status, k, count(fold_10) AS n FROM
  (SELECT DISTINCT project_id, pfi_status, unnest(range(10)) AS k FROM folds) g LEFT JOIN folds f USING (project_id, pfi_status) WHERE f.fold_10 = g.k OR f.fold_10 IS NULL GROUP BY ALL),
spread AS (SELECT project_id, pfi_status, CASE WHEN count(*) < 10 THEN max(n) ELSE max(n) - min(n) END AS spread FROM per GROUP BY ALL)
SELECT pfi_status, CAST(max(spread) AS BIGINT) AS worst, max(spread) <= 3 AS balanced FROM spread GROUP BY 1"""))
def _fold_balance(t: Tables):
    s = fo.fold_balance(dealt(t), ["project_id", "pfi_status"])
    return s.groupBy("pfi_status").agg(F.max("spread").alias("worst"), (F.max("spread") <= 3).alias("balanced"))


@query("fold_reproduce", with_("endpoints", body="," + STATUS + DEAL + """
SELECT project_id, count(*) AS checked, count_if(case_id % 97 = 3)::BIGINT AS moved, count_if(case_id % 89 = 5 AND case_id % 97 <> 3)::BIGINT AS lost FROM folds GROUP BY 1"""))
def _fold_reproduce(t: Tables):
    # The published folds are a stored table, in which some cases were moved and some left out.
    from cohortloom.session import shared_dir
    from cohortloom.sinks.writer import write_folds

    f = dealt(t).select("case_id", "fold_10", "fold_5").filter("case_id % 89 <> 5 or case_id % 97 = 3")
    path = shared_dir(t.spark, "folds")
    write_folds(f.withColumn("fold_10", F.when(F.col("case_id") % 97 == 3, (F.col("fold_10") + 1) % 10).otherwise(F.col("fold_10"))), path)
    published = t.spark.read.parquet(path).select(F.col("case_id").alias("published_id"), F.col("fold_10").alias("published"))
    # The second deal starts from differently arranged rows.
    again = fo.deal(patients(t).repartition("case_id"), count_on=t.cohort.select(F.col("grp").alias("project_id")))
    j = again.join(published, F.col("case_id") == F.col("published_id"), "left")
    there = F.col("published_id").isNotNull()
    return j.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(there & ~F.col("fold_10").eqNullSafe(F.col("published"))).alias("moved"), F.count_if(~there).alias("lost"),
    )


@query("fold_lookup", with_("endpoints", body="," + STATUS + DEAL + """
SELECT fold_10, count(*) AS aliquots, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM lineitem JOIN folds ON l_orderkey = case_id GROUP BY 1"""))
def _fold_lookup(t: Tables):
    f = dealt(t).select("case_id", "fold_10")
    j = t.aliquots.select("sample_id", "quantity").join(f, F.col("sample_id") == F.col("case_id"))
    return j.groupBy("fold_10").agg(F.count(F.lit(1)).alias("aliquots"), F.sum("quantity").alias("quantity"))


@query("chk_nested", with_("endpoints", body="," + STATUS + DEAL + """
SELECT 'fold_5 = fold_10 mod 5' AS "check", count_if(fold_5 <> fold_10 % 5) = 0 AS passed, count(*) AS n_checked, count_if(fold_5 <> fold_10 % 5)::BIGINT AS n_bad FROM folds"""))
def _chk_nested(t: Tables):
    from cohortloom.checks.quality import check_rows

    c = check_rows(dealt(t), "fold_5 = fold_10 mod 5", F.col("fold_5") == F.col("fold_10") % 5, "case_id")
    return c.drop("examples")
