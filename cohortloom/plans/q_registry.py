"""Fixed tables written through their contracts and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cohortloom.operators import patients as pt
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, with_
from cohortloom.session import shared_dir
from cohortloom.sinks.contracts import Contracts

c = F.col


def contracts(t: Tables) -> Contracts:
    reg = Contracts()

    @reg.add("cases", "case_id bigint, submitter_id string, project_id string, program string", width="wide")
    def _cases(_):
        return t.cases.select("program", "project_id", "submitter_id", "case_id")

    @reg.add("last_sample", "case_id bigint, last_day bigint, closed boolean", inner=True)
    def _last(_):
        return t.samples.groupBy("case_id").agg(F.max("day").alias("last_day"), F.bool_and(c("sample_type") == "F").alias("closed"))

    @reg.add("survival_derived", "case_id bigint, project_id string, os_event int, os_time double", needs=("cases", "last_sample"))
    def _survival(need):
        j = need["cases"].join(need["last_sample"], "case_id", "left")
        return j.select("case_id", "project_id", F.when(c("closed"), 1).when(~c("closed"), 0).alias("os_event"), c("last_day").cast("double").alias("os_time"))

    @reg.add("samples", "sample_id bigint, case_id bigint, sample_type string, day bigint", partition_by="sample_type")
    def _samples(_):
        return t.samples.select("sample_id", "case_id", "sample_type", c("day").cast("bigint").alias("day"))

    @reg.add("patients", "case_id bigint, samples array<struct<sample_id:bigint,day:bigint>>", needs=("cases",), width="nested", flexible=("forms",))
    def _patients(need):
        rows = t.samples.select("case_id", "sample_id", c("day").cast("bigint").alias("day"))
        lists = {"samples": pt.Children(rows, "case_id", [c("sample_id")], ["sample_id", "day"])}
        kinds = ["view", "click", "other"]
        lists |= {k: pt.Children(t.forms.filter(c("kind") == k), "case_id", [c("row_no")], ["row_no", "k"]) for k in kinds}
        return pt.flex_column(pt.nest_lists(need["cases"].select("case_id"), "case_id", lists), kinds, "forms")

    return reg


@query("registry_tables", with_("cases", "samples", "forms", body=""",
f AS (SELECT case_id, count(*) FILTER (WHERE kind = 'view') + count(*) FILTER (WHERE kind = 'click') AS n FROM forms GROUP BY 1)
SELECT 'cases' AS name, (SELECT count(*) FROM cases) AS n_written, 'case_id,submitter_id,project_id,program' AS columns, (SELECT sum(case_id)::BIGINT FROM cases) AS total
UNION ALL SELECT 'survival_derived', (SELECT count(*) FROM cases), 'case_id,project_id,os_event,os_time', (SELECT sum(d)::BIGINT FROM (SELECT max(day) AS d FROM samples GROUP BY case_id))
UNION ALL SELECT 'samples', (SELECT count(*) FROM samples), 'sample_id,case_id,day,sample_type', (SELECT sum(day)::BIGINT FROM samples)
UNION ALL SELECT 'patients', (SELECT count(*) FROM cases), 'case_id,samples,forms', (SELECT count(*) FROM samples) + (SELECT sum(n)::BIGINT FROM f)"""))
def _registry_tables(t: Tables):
    root = shared_dir(t.spark, "tables")
    counts = contracts(t).write(t.spark, root)
    lists = F.size("samples") + F.size("forms.view") + F.size("forms.click")
    sums = {"cases": c("case_id"), "survival_derived": c("os_time"), "samples": c("day"), "patients": lists}
    parts = []
    for name, total in sums.items():
        df = t.spark.read.parquet(f"{root}/{name}")
        parts.append(df.agg(F.sum(total).cast("bigint").alias("total")).select(F.lit(name).alias("name"), F.lit(counts[name]).cast("bigint").alias("n_written"), F.lit(",".join(df.columns)).alias("columns"), "total"))
    return reduce(lambda a, b: a.unionByName(b), parts)
