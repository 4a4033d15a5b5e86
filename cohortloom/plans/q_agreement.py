"""Buckets, cohort tables, agreement of curated and derived endpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import scalars as sc
from cohortloom.operators import compare as cm
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, with_

c = F.col


def ep():
    return [c("c_e"), c("c_t"), c("d_e"), c("d_t")]


DEMO = """demo AS (SELECT case_id, project_id, submitter_id, -(20000 + case_id * 7 % 15000) AS days_to_birth,
  CASE WHEN case_id % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
  CASE segment WHEN 'BUILDING' THEN 'white' WHEN 'MACHINERY' THEN 'black or african american' WHEN 'HOUSEHOLD' THEN 'not reported' WHEN 'AUTOMOBILE' THEN 'asian' END AS race,
  CASE case_id % 11 WHEN 0 THEN 'Stage X' WHEN 1 THEN 'Stage IVA' WHEN 2 THEN 'IIIb' WHEN 3 THEN 'Stage II' WHEN 4 THEN ' i ' WHEN 5 THEN 'Stage 0' WHEN 6 THEN '[Not Available]' WHEN 7 THEN 'IS' WHEN 8 THEN 'I/II NOS' WHEN 9 THEN 'Tis' END AS stage,
  CASE case_id % 7 WHEN 0 THEN 'G1' WHEN 1 THEN 'G2' WHEN 2 THEN 'G3' WHEN 3 THEN 'G4' WHEN 4 THEN 'Low Grade' WHEN 5 THEN 'High Grade' END AS grade,
  CASE program WHEN 'ASIA' THEN 'GBM' WHEN 'EUROPE' THEN 'BLCA' WHEN 'AFRICA' THEN 'UCEC' ELSE 'BRCA' END AS kind
  FROM cases),
bucketed AS (SELECT *, CAST(trunc(-days_to_birth / 365.25) AS INTEGER) AS age,
  CASE race WHEN 'white' THEN 'White' WHEN 'black or african american' THEN 'Black' WHEN 'asian' THEN 'Other' ELSE 'NA' END AS race_b,
  CASE case_id % 11 WHEN 1 THEN 'IV' WHEN 2 THEN 'III' WHEN 3 THEN 'II' WHEN 4 THEN 'I' WHEN 5 THEN '0' WHEN 7 THEN 'I' ELSE 'NA' END AS stage_b,
  CASE WHEN kind = 'GBM' THEN '4' WHEN case_id % 7 < 4 THEN CAST(case_id % 7 + 1 AS VARCHAR) WHEN kind IN ('BLCA', 'UCEC') AND case_id % 7 = 4 THEN '1' WHEN kind IN ('BLCA', 'UCEC') AND case_id % 7 = 5 THEN '3' ELSE 'NA' END AS grade_b FROM demo)
"""


def demo(t: Tables):
    k = c("case_id")

    def pick(n: int, *values: str | None):
        out = F.lit(None).cast("string")
        for i, v in enumerate(values):
            out = F.when(k % n == i, v).otherwise(out)
        return out

    seg = c("segment")
    return t.cases.select(
        "case_id", "project_id", "submitter_id",
        (-(20000 + k * 7 % 15000)).alias("days_to_birth"),
        F.when(k % 2 == 0, "male").otherwise("female").alias("gender"),
        F.when(seg == "BUILDING", "white").when(seg == "MACHINERY", "black or african american").when(seg == "HOUSEHOLD", "not reported").when(seg == "AUTOMOBILE", "asian").alias("race"),
        pick(11, "Stage X", "Stage IVA", "IIIb", "Stage II", " i ", "Stage 0", "[Not Available]", "IS", "I/II NOS", "Tis").alias("stage"),
        pick(7, "G1", "G2", "G3", "G4", "Low Grade", "High Grade").alias("grade"),
        F.when(c("program") == "ASIA", "GBM").when(c("program") == "EUROPE", "BLCA").when(c("program") == "AFRICA", "UCEC").otherwise("BRCA").alias("kind"),
    )


def bucketed(t: Tables):
    d = demo(t)
    return d.select(
        "case_id", "project_id",
        sc.age_years(c("days_to_birth")).alias("age"), "gender",
        sc.race_bucket_modern(c("race")).alias("race"),
        sc.stage_bucket(c("stage")).alias("stage"),
        sc.grade_bucket(c("grade"), c("kind")).alias("grade"),
    )


def _bucket(name: str, out: str, sql_col: str):
    def fn(t: Tables):
        return bucketed(t).select("case_id", c(out).alias("bucket"))

    query(name, with_("cases", body="," + DEMO + f"SELECT case_id, {sql_col} AS bucket FROM bucketed"))(fn)


_bucket("stage_bucket", "stage", "stage_b")
_bucket("grade_bucket", "grade", "grade_b")
_bucket("age_floor", "age", "age")


@query("vocab_bucket", with_("cases", body="," + DEMO + """SELECT case_id, race_b AS modern,
 CASE race WHEN 'white' THEN 'White' WHEN 'black or african american' THEN 'Black' WHEN 'not reported' THEN 'Other' WHEN 'asian' THEN 'Other' ELSE 'NA' END AS curated FROM bucketed"""))
def _vocab(t: Tables):
    d = demo(t)
    return d.select(
        "case_id", sc.race_bucket_modern(c("race")).alias("modern"), sc.race_bucket_curated(F.upper("race")).alias("curated")
    )


@query("fallback_chain", with_("samples", body="""
, f AS (SELECT case_id, sample_id, day, CASE WHEN priority = '1-URGENT' THEN 'Stage I' WHEN priority = '2-HIGH' THEN '' END AS a, CASE WHEN sample_type = 'F' THEN 'Stage II' WHEN sample_type = 'O' THEN '' END AS b, CASE WHEN weight > 450000 THEN 'Stage III' END AS c FROM samples),
v AS (SELECT *, coalesce(nullif(a, ''), nullif(b, ''), nullif(c, '')) AS stage FROM f)
SELECT case_id, arg_min(stage, day * 10000000 + sample_id) AS stage FROM v WHERE stage IS NOT NULL GROUP BY 1
UNION ALL SELECT DISTINCT case_id, NULL FROM v WHERE case_id NOT IN (SELECT case_id FROM v WHERE stage IS NOT NULL)"""))
def _fallback_chain(t: Tables):
    p, s = c("priority"), c("sample_type")
    stage = sc.fallback(
        F.when(p == "1-URGENT", "Stage I").when(p == "2-HIGH", ""),
        F.when(s == "F", "Stage II").when(s == "O", ""),
        F.when(c("weight") > 450000, "Stage III"),
    )
    rows = t.samples.withColumn("stage", stage)
    # Earliest record that has any of the fields.
    order = F.when(c("stage").isNotNull(), F.struct("day", "sample_id"))
    return rows.groupBy("case_id").agg(F.min_by("stage", order).alias("stage"))


@query("fallback_two", with_("forms", body="""
SELECT row_no, CASE WHEN token IS NULL OR token IN ('[Not Available]', '[Unknown]', '') THEN kind ELSE token END AS stage FROM forms"""))
def _fallback_two(t: Tables):
    return t.forms.select("row_no", sc.curated_stage(c("token"), c("kind")).alias("stage"))


T1 = """, t1 AS (SELECT project_id, CAST(count(*) AS VARCHAR) AS n, printf('%.1f', avg(age)) || ' ± ' || printf('%.1f', stddev_samp(age)) AS age,
 count_if(gender = 'male') || '/' || count_if(gender = 'female') AS gender,
 concat_ws('/', count_if(race_b = 'White'), count_if(race_b = 'Black'), count_if(race_b = 'Other'), count_if(race_b = 'NA')) AS race,
 concat_ws('/', count_if(stage_b = '0'), count_if(stage_b = 'I'), count_if(stage_b = 'II'), count_if(stage_b = 'III'), count_if(stage_b = 'IV'), count_if(stage_b = 'NA')) AS stage,
 concat_ws('/', count_if(grade_b = '1'), count_if(grade_b = '2'), count_if(grade_b = '3'), count_if(grade_b = '4'), count_if(grade_b = 'NA')) AS grade
 FROM {src} GROUP BY 1)
"""
T1_FIELDS = ["n", "age", "gender", "race", "stage", "grade"]


@query("table1", with_("cases", body="," + DEMO + T1.format(src="bucketed") + "SELECT * FROM t1"))
def _table1(t: Tables):
    return cm.table1(bucketed(t), "project_id")


@query("table_compare", with_("cases", body="," + DEMO + T1.format(src="bucketed") + """,
 bucketed2 AS (SELECT * REPLACE (age + CAST(case_id % 3 = 0 AS INTEGER) AS age, CASE WHEN project_id = 'NATION_3' AND race_b = 'NA' THEN 'Other' ELSE race_b END AS race_b) FROM bucketed WHERE project_id <> 'NATION_5')
""" + T1.format(src="bucketed2").replace("t1 AS", "t2 AS") + """,
 l AS (UNPIVOT t1 ON n, age, gender, race, stage, grade INTO NAME field VALUE v), r AS (UNPIVOT t2 ON n, age, gender, race, stage, grade INTO NAME field VALUE v),
 j AS (SELECT l.field, l.v = r.v OR (l.field = 'age' AND abs(TRY_CAST(split_part(l.v, ' ', 1) AS DOUBLE) - TRY_CAST(split_part(r.v, ' ', 1) AS DOUBLE)) <= 1.0) AS same FROM l JOIN r ON l.project_id = r.project_id AND l.field = r.field)
SELECT field, count_if(same) || '/' || count(*) AS match, round(100.0::DOUBLE * count_if(same) / count(*), 1) AS pct FROM j GROUP BY 1"""))
def _table_compare(t: Tables):
    b = bucketed(t)
    moved = b.filter("project_id <> 'NATION_5'").withColumns({
        "age": c("age") + (c("case_id") % 3 == 0).cast("int"),
        "race": F.when((c("project_id") == "NATION_3") & (c("race") == "NA"), "Other").otherwise(c("race")),
    })
    long = cm.compare_tables(
        cm.table1(b, "project_id"), cm.table1(moved, "project_id"), "project_id", T1_FIELDS, cm.text_or_mean_match(1.0)
    )
    return cm.comparison_summary(long)


@query("age_agreement", with_("cases", body="," + DEMO + """SELECT project_id, count(*) AS n, CAST(count_if(abs(age - age2) = 0) AS BIGINT) AS exact, CAST(count_if(abs(age - age2) <= 1) AS BIGINT) AS within_one
FROM (SELECT project_id, age, age + CASE case_id % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS age2 FROM bucketed) GROUP BY 1"""))
def _age_agreement(t: Tables):
    b = bucketed(t).select("case_id", "project_id", "age")
    k = c("case_id")
    curated = b.select(k.alias("cid"), (c("age") + F.when(k % 9 == 0, 1).when(k % 9 == 1, 2).otherwise(0)).alias("age2"))
    j = b.join(curated, k == c("cid"))
    gap = F.abs(c("age") - c("age2"))
    return j.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(gap == 0).alias("exact"), F.count_if(gap <= 1).alias("within_one")
    )


@query("median_compare", with_("endpoints", body="""
, a AS (SELECT grp, round(quantile_cont(c_t, 0.5) / 30.44, 1) AS ev_all, round(quantile_cont(CASE WHEN c_e = 1 THEN c_t END, 0.5) / 30.44, 1) AS ev_one FROM endpoints GROUP BY 1),
b AS (SELECT grp, round(quantile_cont(d_t, 0.5) / 30.44, 1) AS ev_all, round(quantile_cont(CASE WHEN d_e = 1 THEN d_t END, 0.5) / 30.44, 1) AS ev_one FROM endpoints GROUP BY 1)
SELECT 'all' AS field, count_if(coalesce(abs(a.ev_all - b.ev_all) <= 0.5, a.ev_all IS NULL AND b.ev_all IS NULL)) || '/' || count(*) AS match,
 round(100.0::DOUBLE * count_if(coalesce(abs(a.ev_all - b.ev_all) <= 0.5, a.ev_all IS NULL AND b.ev_all IS NULL)) / count(*), 1) AS pct FROM a JOIN b USING (grp)
UNION ALL SELECT 'event', count_if(coalesce(abs(a.ev_one - b.ev_one) <= 0.5, a.ev_one IS NULL AND b.ev_one IS NULL)) || '/' || count(*),
 round(100.0::DOUBLE * count_if(coalesce(abs(a.ev_one - b.ev_one) <= 0.5, a.ev_one IS NULL AND b.ev_one IS NULL)) / count(*), 1) FROM a JOIN b USING (grp)"""))
def _median_compare(t: Tables):
    from cohortloom.operators.km import follow_up_medians

    def wide(time: str, event: str):
        m = follow_up_medians(t.endpoints, "grp", time, event)
        return m.groupBy("grp").agg(
            F.max(F.when(c("kind") == "all", c("months"))).alias("all"),
            F.max(F.when(c("kind") == "event", c("months"))).alias("event"),
        )

    long = cm.compare_tables(wide("c_t", "c_e"), wide("d_t", "d_e"), "grp", ["all", "event"], cm.near_or_both_null(0.5))
    return cm.comparison_summary(long)


CLS = """, cls AS (SELECT *, CASE WHEN c_e IS NULL AND d_e IS NULL THEN 'both_na' WHEN c_e IS NULL THEN 'der_pop_cdr_na' WHEN d_e IS NULL THEN 'cdr_pop_der_na'
 WHEN c_e = d_e AND abs(c_t - d_t) < 0.5 THEN 'match' ELSE 'mismatch' END AS cls FROM endpoints)
"""


def classified(t: Tables):
    return t.endpoints.withColumn("cls", cm.classify(*ep()))


@query("agreement_class", with_("endpoints", body=CLS + "SELECT sample_id, cls FROM cls"))
def _agreement_class(t: Tables):
    return classified(t).select("sample_id", "cls")


@query("agreement_summary", with_("endpoints", body=CLS + """SELECT count(*) AS total, count_if(cls = 'both_na')::BIGINT AS both_na, count_if(cls = 'der_pop_cdr_na')::BIGINT AS der_pop_cdr_na,
 count_if(cls = 'cdr_pop_der_na')::BIGINT AS cdr_pop_der_na, count_if(cls = 'match')::BIGINT AS "match", count_if(cls = 'mismatch')::BIGINT AS mismatch, round(100.0::DOUBLE * count_if(cls = 'match') / count(*), 1) AS match_pct FROM cls"""))
def _agreement_summary(t: Tables):
    return cm.agreement_summary(classified(t), "cls")


@query("agreement_by_project", with_("endpoints", body=CLS + """SELECT grp, m || '/' || d || ' (' || CAST(round_even(100.0::DOUBLE * m / d, 0) AS BIGINT) || '%)' AS rate FROM
 (SELECT grp, count_if(cls = 'match') AS m, count_if(cls IN ('match', 'mismatch', 'cdr_pop_der_na')) AS d FROM cls GROUP BY 1)"""))
def _agreement_by_project(t: Tables):
    return cm.match_rate(classified(t), "cls", ["grp"])


@query("direction_table", with_("endpoints", body="SELECT grp, c_e, d_e, count(*) AS n FROM endpoints WHERE c_e <> d_e GROUP BY ALL"))
def _direction(t: Tables):
    return cm.direction_table(t.endpoints, "c_e", "d_e", ["grp"])


@query("time_only_diff", with_("endpoints", body="""
SELECT grp, count(*) AS n, quantile_cont(abs(c_t - d_t), 0.5) AS median_gap FROM endpoints WHERE c_e = d_e AND abs(c_t - d_t) >= 0.5 GROUP BY 1"""))
def _time_only(t: Tables):
    return cm.time_only_diff(t.endpoints, "grp")


@query("agreement_30d", with_("endpoints", body="""
SELECT grp, count(*) AS total, count_if((c_e IS NULL AND d_e IS NULL) OR coalesce(c_e = d_e AND abs(c_t - d_t) <= 30, false))::BIGINT AS agree,
 count_if(c_e IS NOT NULL AND d_e IS NOT NULL)::BIGINT AS both_populated, count_if(c_e = d_e)::BIGINT AS same_direction FROM endpoints GROUP BY 1"""))
def _agreement_30d(t: Tables):
    return t.endpoints.groupBy("grp").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(cm.within_days(*ep(), 30.0)).alias("agree"),
        F.count_if(c("c_e").isNotNull() & c("d_e").isNotNull()).alias("both_populated"),
        F.count_if(c("c_e") == c("d_e")).alias("same_direction"),
    )


@query("population_delta", with_("endpoints", body="""
SELECT grp, count(c_e) AS curated, count(d_e) AS derived, count(d_e) - count(c_e) AS delta, count_if(c_e IS NULL AND d_e IS NOT NULL)::BIGINT AS over_populated, count_if(d_e IS NULL AND c_e IS NOT NULL)::BIGINT AS under_populated FROM endpoints GROUP BY 1"""))
def _population_delta(t: Tables):
    return t.endpoints.groupBy("grp").agg(
        F.count("c_e").alias("curated"), F.count("d_e").alias("derived"),
        (F.count("d_e") - F.count("c_e")).alias("delta"),
        F.count_if(c("c_e").isNull() & c("d_e").isNotNull()).alias("over_populated"),
        F.count_if(c("d_e").isNull() & c("c_e").isNotNull()).alias("under_populated"),
    )


@query("extension_coverage", with_("endpoints", body="""
SELECT grp, count(*) AS unmatched, count(d_e) AS populated, round(100.0::DOUBLE * count(d_e) / count(*), 1) AS pct FROM endpoints WHERE c_e IS NULL GROUP BY 1"""))
def _extension(t: Tables):
    return t.endpoints.filter("c_e is null").groupBy("grp").agg(
        F.count(F.lit(1)).alias("unmatched"), F.count("d_e").alias("populated"),
        F.round(100 * F.count("d_e") / F.count(F.lit(1)), 1).alias("pct"),
    )


@query("cohort_growth", """
WITH a AS (SELECT source AS project, count(*) AS n FROM documents WHERE lang <> 'es' GROUP BY 1), b AS (SELECT 'src' || user_id % 30 AS project, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(a.project, b.project) AS project, coalesce(a.n, 0) AS old_n, coalesce(b.n, 0) AS new_n, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL JOIN b ON a.project = b.project""")
def _cohort_growth(t: Tables):
    a = t.documents.filter("lang <> 'es'").groupBy(c("source").alias("project")).agg(F.count(F.lit(1)).alias("old_n"))
    b = t.events.groupBy(F.concat(F.lit("src"), (c("user_id") % 30).cast("string")).alias("project")).agg(F.count(F.lit(1)).alias("new_n"))
    j = a.join(b, "project", "full")
    old, new = F.coalesce("old_n", F.lit(0)), F.coalesce("new_n", F.lit(0))
    return j.select("project", old.alias("old_n"), new.alias("new_n"), (new - old).alias("delta"))


@query("topk_mismatch", with_("endpoints", body="""SELECT sample_id, grp, c_e, d_e FROM endpoints WHERE c_e <> d_e ORDER BY grp, sample_id LIMIT 10"""))
def _topk(t: Tables):
    bad = t.endpoints.filter(c("c_e") != c("d_e"))
    return bad.select("sample_id", "grp", "c_e", "d_e").orderBy("grp", "sample_id").limit(10)


@query("slim_cohort", with_("cases", body="," + DEMO + "SELECT case_id, submitter_id, project_id, days_to_birth, gender, nullif(trim(stage), '') AS stage FROM demo"))
def _slim(t: Tables):
    d = demo(t)
    nested = d.select("case_id", "submitter_id", "project_id", F.struct("days_to_birth", "gender").alias("demographic"), F.array(F.struct("stage")).alias("diagnoses"))
    return nested.select(
        "case_id", "submitter_id", "project_id", "demographic.days_to_birth", "demographic.gender",
        sc.nonempty(F.trim(c("diagnoses")[0]["stage"])).alias("stage"),
    )


@query("mut_by_gene", with_("aliquots", body="SELECT gene_id, count(*) AS n, count(DISTINCT sample_id) AS samples FROM aliquots GROUP BY 1"))
def _mut_by_gene(t: Tables):
    # Distinct pairs carry their row count, so the gene-level step sees no raw rows.
    pairs = t.aliquots.groupBy("gene_id", "sample_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("gene_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("samples"))


@query("mut_by_consequence", with_("forms", body="SELECT coalesce(nullif(token, ''), 'Unknown') AS consequence, count(*) AS n FROM forms GROUP BY 1"))
def _mut_by_consequence(t: Tables):
    return t.forms.groupBy(F.coalesce(sc.nonempty(c("token")), F.lit("Unknown")).alias("consequence")).agg(F.count(F.lit(1)).alias("n"))
