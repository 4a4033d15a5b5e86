"""Shard plan, members, indexes and partial rebuilds."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import shards as sh
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables
from cohortloom.session import shared_dir
from cohortloom.sinks.writer import write_table

c = F.col
TARGET = 40_000

PLAN = """WITH RECURSIVE ordered AS (SELECT source AS project_id, doc_id, n_chars AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
plan(project_id, doc_id, rn, shard, written) AS (
 SELECT project_id, doc_id, rn, 0::BIGINT, size FROM ordered WHERE rn = 1
 UNION ALL SELECT o.project_id, o.doc_id, o.rn, CASE WHEN p.written >= 40000 THEN p.shard + 1 ELSE p.shard END, CASE WHEN p.written >= 40000 THEN o.size ELSE p.written + o.size END
 FROM plan p JOIN ordered o ON o.project_id = p.project_id AND o.rn = p.rn + 1)
"""


def plan(t: Tables, **chunks: int):
    d = t.documents.select(c("source").alias("project_id"), "doc_id", "n_chars")
    return sh.shard_plan(d, "project_id", "doc_id", "n_chars", TARGET, **chunks)


@query("shard_plan", PLAN + "SELECT project_id, doc_id, shard FROM plan")
def _plan(t: Tables):
    return plan(t)


@query("shard_members", PLAN + """SELECT p.project_id, shard, p.doc_id || '.report.' || p.doc_id || '.' || CASE WHEN lang = 'en' THEN 'txt.gz' ELSE 'pdf' END AS member, md5(text) AS md5sum,
 CASE WHEN lang <> 'en' THEN md5(text) END AS md5sum_member FROM plan p JOIN documents USING (doc_id)""")
def _members(t: Tables):
    ext = F.when(c("lang") == "en", ".txt").otherwise(".PDF")
    files = t.documents.select(
        "doc_id", F.lit("report").alias("data_type"), F.concat(F.lit("f."), c("doc_id").cast("string"), ext).alias("file_name"),
        c("text").cast("binary").alias("content"),
    )
    named = sh.members(files, "doc_id", "data_type", "doc_id", "file_name")
    rows = named.join(plan(t), "doc_id")
    out = sh.write_shards(rows, shared_dir(t.spark, "shards"), "project_id", "doc_id")
    # Compressed bytes depend on the zlib build; only plain members are compared.
    return out.select("project_id", "shard", "member", "md5sum", F.when(c("member").endswith("pdf"), c("md5sum_member")).alias("md5sum_member"))


@query("shard_index", PLAN + """, s AS (SELECT doc_id, count(*) AS n_files, sum(toxic + 10)::BIGINT AS n_bytes FROM labels GROUP BY 1)
SELECT project_id, p.doc_id, 'data/' || project_id || '/' || lower(project_id) || '-' || lpad(CAST(shard AS VARCHAR), 6, '0') || '.tar' AS shard, coalesce(n_files, 0) AS n_files, coalesce(n_bytes, 0) AS n_bytes FROM plan p LEFT JOIN s USING (doc_id)""")
def _index(t: Tables):
    sizes = sh.case_bytes(t.labels.withColumn("b", (c("toxic") + 10).cast("bigint")), "doc_id", "b")
    return sh.cases_index(plan(t), sizes, "project_id", "doc_id").orderBy("project_id", "doc_id")


@query("case_bytes", "SELECT conv_id, count(*) AS n_files, CAST(sum(length(text)) AS BIGINT) AS n_bytes FROM conversations GROUP BY 1")
def _case_bytes(t: Tables):
    f = t.conversations.select("conv_id", F.length("text").cast("bigint").alias("b"))
    return sh.case_bytes(f, "conv_id", "b")


@query("overwrite_partition", """SELECT lang, doc_id, CASE WHEN lang IN ('fr', 'es') THEN 'rebuilt' ELSE 'first' END AS build FROM documents""")
def _overwrite(t: Tables):
    path = shared_dir(t.spark, "files-table")
    first = t.documents.select("doc_id", "lang", F.lit("first").alias("build"))
    write_table(first, path, partition_by="lang")
    again = first.filter("lang in ('fr', 'es')").withColumn("build", F.lit("rebuilt"))
    write_table(again, path, partition_by="lang", only_named_partitions=True)
    return t.spark.read.parquet(path)
