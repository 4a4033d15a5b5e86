"""Survival derivation: one query per rule over clinical roles of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import survival as sv
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, day_of


def clinical(t: Tables):
    k, o, e = F.col("c_custkey"), F.col("o_orderkey"), F.col("event_id")
    nation = F.col("n_nationkey")
    cases = t.customer.join(t.nation, F.col("c_nationkey") == nation).select(
        k.alias("case_id"),
        F.concat(F.lit("TCGA-"), F.when(nation == 0, "LAML").when(nation == 1, "SARC").otherwise(F.col("n_name"))).alias("project_id"),
        F.when(k % 10 == 9, "Unknown").when(k % 3 == 1, "Alive").otherwise("Dead").alias("vital_status"),
        F.when((k % 3 != 1) & (k % 8 != 3), 900 + k % 1500).alias("days_to_death"),
        F.when(k % 4 == 0, "Cancer Related").alias("cause_of_death"),
    )
    day = day_of("o_orderdate")
    diagnoses = t.orders.select(
        F.col("o_custkey").alias("case_id"), o.alias("dx_id"), (o % 6 == 0).alias("is_primary"),
        F.when(o % 9 != 0, day - 1096).alias("days_to_diagnosis"),
        F.when(o % 5 != 0, day + 100).alias("days_to_last_follow_up"),
        F.when(F.col("o_totalprice") < 400000, "primary").when(F.col("o_orderpriority") == "1-URGENT", " Subsequent Primary")
        .when(F.col("o_orderpriority") == "2-HIGH", "recurrence").when(F.col("o_orderpriority") == "3-MEDIUM", "Metastatic").alias("classification"),
        F.when(o % 3 == 0, "Lung").when(o % 3 == 1, "Skin").alias("tissue"),
        F.when(o % 4 == 0, "R0").when(o % 4 == 1, "R1").otherwise("").alias("residual_disease"),
        F.when(o % 7 == 0, "Stage IV").when(o % 7 == 1, " stage iva").when(o % 7 == 2, "Stage IIIA").when(o % 7 == 3, "Stage I").alias("stage"),
    )
    treatments = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == o).select(
        F.col("o_custkey").alias("case_id"), F.col("l_orderkey").alias("dx_id"),
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("tx_id"),
        F.lit(None).cast("bigint").alias("days_to_start"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_discount") > 0.08), "Complete Response").when(F.col("l_returnflag") == "R", "Progressive Disease").otherwise("").alias("outcome"),
        F.when(F.col("l_quantity") < 15, "Uninvolved").when(F.col("l_quantity") < 30, "Involved").otherwise("").alias("margin_status"),
    )
    fd = day_of("ts", "2024-01-01") * 40 + 1000
    kind = F.col("event_type")
    follow_ups = t.events.select(
        F.col("user_id").alias("case_id"), e.alias("fu_id"), F.when(e % 11 != 0, fd).alias("days_to_follow_up"),
        F.when(kind == "purchase", "WT-With Tumor").when(kind == "view", "TF-Tumor Free").when(kind == "click", "Tumor Free").alias("disease_response"),
        F.when(e % 50 == 0, fd + 5).alias("days_to_recurrence"),
        F.when(e % 50 == 25, fd - 5).alias("days_to_progression"),
        F.when(e % 40 == 1, " Yes ").when(e % 40 == 2, "No").alias("progression_or_recurrence"),
        F.when(e % 3 == 0, "New Primary").when(e % 3 == 1, "New Primary + Locoregional").otherwise("Distant").alias("type"),
    )
    supplement = t.events.filter("event_type = 'signup'").select(
        (F.col("user_id") * 3).alias("case_id"), e.alias("pos"),
        F.when(F.col("value") > 60, "Complete Remission/Response").when(F.col("value") > 40, "Stable Disease").otherwise("").alias("outcome"),
    )
    return cases, diagnoses, treatments, follow_ups, supplement


def derived(t: Tables):
    return sv.derive(*clinical(t))


RULES = """
WITH cs AS (SELECT c_custkey AS case_id, CASE n_nationkey WHEN 0 THEN 'LAML' WHEN 1 THEN 'SARC' ELSE n_name END AS short,
  CASE WHEN c_custkey % 10 = 9 THEN 'Unknown' WHEN c_custkey % 3 = 1 THEN 'Alive' ELSE 'Dead' END AS vital,
  CASE WHEN c_custkey % 3 <> 1 AND c_custkey % 8 <> 3 THEN 900 + c_custkey % 1500 END AS death,
  c_custkey % 4 = 0 AS cancer_cause FROM customer JOIN nation ON c_nationkey = n_nationkey),
dx AS (SELECT o_custkey AS case_id, o_orderkey AS dx_id, o_orderkey % 6 = 0 AS prim,
  CASE WHEN o_orderkey % 9 <> 0 THEN date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) - 1096 END AS dxday,
  CASE WHEN o_orderkey % 5 <> 0 THEN date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) + 100 END AS lastfu,
  CASE WHEN o_totalprice < 400000 THEN 'primary' WHEN o_orderpriority = '1-URGENT' THEN ' Subsequent Primary' WHEN o_orderpriority = '2-HIGH' THEN 'recurrence' WHEN o_orderpriority = '3-MEDIUM' THEN 'Metastatic' END AS cls,
  CASE o_orderkey % 3 WHEN 0 THEN 'Lung' WHEN 1 THEN 'Skin' END AS tissue,
  o_orderkey % 4 = 0 AS r0, o_orderkey % 7 IN (0, 1) AS iv FROM orders),
prank AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY CASE WHEN prim THEN 0 ELSE 1 END, dxday NULLS LAST, CAST(dx_id AS VARCHAR)) AS rk FROM dx),
prim AS (SELECT * FROM prank WHERE rk = 1),
fu AS (SELECT user_id AS case_id, event_id AS fu_id, date_diff('day', TIMESTAMP '2024-01-01', ts) * 40 + 1000 AS fd, event_type, event_id FROM events),
fu2 AS (SELECT case_id, fu_id, CASE WHEN event_id % 11 <> 0 THEN fd END AS day,
  CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 0 WHEN 'click' THEN 0 END AS resp,
  least(CASE WHEN event_id % 50 = 0 THEN fd + 5 END, CASE WHEN event_id % 50 = 25 THEN fd - 5 END, CASE WHEN event_id % 40 = 1 AND event_id % 11 <> 0 THEN fd END) AS ev,
  CASE event_id % 3 WHEN 0 THEN 'New Primary' WHEN 1 THEN 'New Primary + Locoregional' ELSE 'Distant' END AS type FROM fu),
ev AS (SELECT case_id, ev AS day, 0 AS src, row_number() OVER (PARTITION BY case_id ORDER BY day NULLS LAST, CAST(fu_id AS VARCHAR)) AS pos, type FROM fu2
  UNION ALL SELECT d.case_id, d.dxday, 1, row_number() OVER (PARTITION BY d.case_id ORDER BY d.dxday NULLS LAST, CAST(d.dx_id AS VARCHAR)),
   CASE WHEN trim(lower(d.cls)) = 'subsequent primary' AND d.tissue <> p.tissue THEN 'New Primary' ELSE d.cls END
   FROM dx d JOIN prim p USING (case_id) WHERE NOT d.prim AND trim(lower(d.cls)) IN ('recurrence', 'metastatic', 'subsequent primary')),
nte AS (SELECT case_id, day AS nte_day, type AS nte_type FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY day, src, pos) AS rk FROM ev WHERE day IS NOT NULL) WHERE rk = 1),
resp AS (SELECT case_id, arg_max(wt, day) AS wt, max(day) AS rday FROM (SELECT case_id, day, max(resp) AS wt FROM fu2 WHERE resp IS NOT NULL AND day IS NOT NULL GROUP BY ALL) GROUP BY 1),
lc AS (SELECT case_id, greatest(p.lastfu, f.m) AS last_contact FROM cs LEFT JOIN prim p USING (case_id) LEFT JOIN (SELECT case_id, max(day) AS m FROM fu2 GROUP BY 1) f USING (case_id)),
tx AS (SELECT p.case_id, l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS tx_id,
  CASE WHEN l_returnflag = 'A' AND l_discount > 0.08 THEN 'Complete Response' WHEN l_returnflag = 'R' THEN 'Progressive Disease' END AS outcome,
  CASE WHEN l_quantity < 15 THEN 'Uninvolved' WHEN l_quantity < 30 THEN 'Involved' END AS margin FROM lineitem JOIN prim p ON p.dx_id = l_orderkey),
txa AS (SELECT case_id, arg_min(margin, tx_id) AS margin, arg_min(outcome, tx_id) AS outcome, bool_or(outcome = 'Complete Response') AS cr FROM tx GROUP BY 1),
su AS (SELECT user_id * 3 AS case_id, event_id AS pos, CASE WHEN value > 60 THEN 'Complete Remission/Response' WHEN value > 40 THEN 'Stable Disease' END AS outcome FROM events WHERE event_type = 'signup'),
sua AS (SELECT case_id, arg_min(outcome, pos) AS outcome, bool_or(outcome = 'Complete Remission/Response') AS cr FROM su GROUP BY 1),
facts AS (SELECT c.*, p.dx_id AS primary_dx, lc.last_contact, nte_day, nte_type,
  CASE WHEN rday IS NULL AND nte_day IS NULL THEN NULL WHEN rday IS NULL OR nte_day >= rday OR wt = 1 THEN 'WITH TUMOR' ELSE 'TUMOR FREE' END AS tumor_status,
  coalesce(p.iv, false) AS stage_iv,
  CASE WHEN short = 'SARC' THEN coalesce(p.r0, false) ELSE coalesce(p.r0, false) OR coalesce(x.margin = 'Uninvolved', false) OR coalesce(x.cr, false) OR coalesce(s.cr, false) END AS disease_free,
  coalesce(s.outcome, x.outcome) AS first_outcome
  FROM cs c LEFT JOIN prim p USING (case_id) LEFT JOIN lc USING (case_id) LEFT JOIN nte USING (case_id) LEFT JOIN resp USING (case_id) LEFT JOIN txa x USING (case_id) LEFT JOIN sua s USING (case_id)),
ep AS (SELECT *, greatest(death, last_contact) AS latest, vital = 'Dead' AND (coalesce(tumor_status = 'WITH TUMOR', false) OR cancer_cause) AS died_with,
  CASE WHEN nte_type LIKE '%New Primary%' AND nte_type NOT LIKE '%+%' THEN NULL ELSE nte_day END AS counted FROM facts),
res AS (SELECT case_id,
  CASE WHEN vital <> 'Unknown' AND latest IS NOT NULL THEN CAST(vital = 'Dead' AS INTEGER) END AS os_event,
  CASE WHEN vital <> 'Unknown' THEN latest::DOUBLE END AS os_time,
  CASE WHEN vital = 'Unknown' OR latest IS NULL THEN NULL WHEN vital = 'Alive' OR tumor_status = 'TUMOR FREE' THEN 0 ELSE 1 END AS dss_event,
  CASE WHEN vital <> 'Unknown' THEN latest::DOUBLE END AS dss_time,
  CASE WHEN vital = 'Unknown' THEN NULL WHEN nte_day IS NOT NULL OR (died_with AND death IS NOT NULL) THEN 1 WHEN (vital = 'Dead' AND latest IS NOT NULL) OR (vital = 'Alive' AND last_contact IS NOT NULL) THEN 0 END AS pfi_event,
  CASE WHEN vital = 'Unknown' THEN NULL WHEN nte_day IS NOT NULL THEN nte_day WHEN died_with AND death IS NOT NULL THEN death WHEN vital = 'Dead' THEN latest ELSE last_contact END::DOUBLE AS pfi_time,
  CASE WHEN short IN ('LAML', 'SKCM', 'THYM', 'UVM') OR stage_iv OR vital = 'Unknown' OR (died_with AND nte_day IS NULL) OR NOT disease_free THEN NULL WHEN counted IS NOT NULL THEN 1 WHEN latest IS NOT NULL THEN 0 END AS dfi_event,
  CASE WHEN short IN ('LAML', 'SKCM', 'THYM', 'UVM') OR stage_iv OR vital = 'Unknown' OR (died_with AND nte_day IS NULL) OR NOT disease_free THEN NULL ELSE coalesce(counted, latest) END::DOUBLE AS dfi_time
  FROM ep)
"""


def _rule(name: str, out: str, source: str | None = None):
    def fn(t: Tables):
        return derived(t).select("case_id", F.col(source or out).alias(out))

    query(name, RULES + f"SELECT case_id, {out} FROM facts")(fn)


def _endpoint(e: str):
    cols = [f"{e}_event", f"{e}_time"]

    def fn(t: Tables):
        return derived(t).select("case_id", *[F.col("survival_derived")[c].alias(c) for c in cols])

    query(f"{e}_endpoint", RULES + f"SELECT case_id, {', '.join(cols)} FROM res")(fn)


_rule("primary_dx", "primary_dx", "primary.dx_id")
_rule("nte_days", "nte_day")
for _n in ("last_contact", "nte_type", "tumor_status", "disease_free", "stage_iv", "first_outcome"):
    _rule(_n, _n)
for _e in ("os", "dss", "pfi", "dfi"):
    _endpoint(_e)


@query("survival_derived", RULES + "SELECT * FROM res")
def _survival_derived(t: Tables):
    return derived(t).select("case_id", "survival_derived.*")


@query("survival_flat", RULES + "SELECT * FROM res WHERE coalesce(os_event, dss_event, pfi_event, dfi_event) IS NOT NULL")
def _survival_flat(t: Tables):
    return sv.flatten_endpoints(derived(t), ["case_id"])
