"""Roles of the clinico-genomic model bound to the test tables.

Every role is a DataFrame derived from whole tables; the same role as a SQL
common table expression is in ``CTE``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def day_of(ts: str | Column, origin: str = "1992-01-01") -> Column:
    return F.datediff(F.col(ts) if isinstance(ts, str) else ts, F.lit(origin).cast("date")).cast("bigint")


def r6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


class Tables:
    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf}/{name}.parquet")
        raise AttributeError(name)

    @cached_property
    def projects(self) -> DataFrame:
        """Project dimension: one row per nation, with its region as program."""
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", F.col("n_name").alias("project_id"), F.col("r_name").alias("program")
        )

    @cached_property
    def cases(self) -> DataFrame:
        return self.customer.join(
            self.projects, F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("c_custkey").alias("case_id"),
            F.col("c_name").alias("submitter_id"),
            "project_id",
            "program",
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )

    @cached_property
    def samples(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("sample_id"),
            F.col("o_custkey").alias("case_id"),
            F.col("o_orderstatus").alias("sample_type"),
            day_of("o_orderdate").alias("day"),
            F.col("o_totalprice").alias("weight"),
            F.col("o_orderpriority").alias("priority"),
        )

    @cached_property
    def aliquots(self) -> DataFrame:
        """One row per line: its id, its parents, its measured columns."""
        return self.lineitem.select(
            F.concat_ws(
                "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                F.col("l_quantity").cast("bigint"),
            ).alias("aliquot_id"),
            F.col("l_orderkey").alias("sample_id"),
            F.col("l_linenumber").alias("portion_no"),
            F.col("l_returnflag").alias("analyte_type"),
            F.col("l_linestatus").alias("status"),
            F.col("l_partkey").alias("gene_id"),
            F.col("l_suppkey").alias("center_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            day_of("l_shipdate").alias("ship_day"),
        )

    @cached_property
    def files(self) -> DataFrame:
        """Manifest: documents as source files."""
        return self.documents.select(
            F.col("doc_id").alias("file_id"),
            F.concat(F.col("source"), F.lit("."), F.col("doc_id"), F.lit("."), F.col("lang"), F.lit(".txt")).alias("file_name"),
            F.col("lang").alias("data_type"),
            F.col("source").alias("project_id"),
            F.col("n_chars").alias("file_size"),
            F.md5(F.col("text").cast("binary")).alias("md5sum"),
        )

    @cached_property
    def expression(self) -> DataFrame:
        """(sample, gene, value): quantity per supplier and part."""
        return self.lineitem.groupBy(
            F.col("l_suppkey").alias("sample_id"), F.col("l_partkey").alias("gene_id")
        ).agg(F.sum("l_quantity").alias("value"))

    @cached_property
    def genes(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("gene_id"),
            F.col("p_name").alias("gene_name"),
            F.col("p_type").alias("gene_type"),
            F.col("p_brand").alias("pathway"),
            F.col("p_size").cast("bigint").alias("size"),
            F.col("p_retailprice").alias("price"),
        )

    @cached_property
    def cohort(self) -> DataFrame:
        """Time-to-event rows: (grp, t, e) with its case and sample."""
        s = self.samples
        return s.join(self.cases.select("case_id", "project_id"), "case_id").select(
            "case_id",
            "sample_id",
            F.col("project_id").alias("grp"),
            F.col("day").alias("t"),
            F.when(F.col("sample_type") == "F", 1).otherwise(0).alias("e"),
        )

    @cached_property
    def endpoints(self) -> DataFrame:
        """Curated (c_*) against derived (d_*) endpoint per sample.

        The derived side is the curated one with some values moved or missing.
        """
        k = F.col("sample_id")
        ce = F.when(k % 13 == 0, None).otherwise(F.col("e"))
        ct = F.when(k % 13 == 0, None).otherwise(F.col("t").cast("double"))
        de = (
            F.when(k % 11 == 0, None)
            .when(k % 7 == 0, 1 - F.col("e"))
            .otherwise(F.col("e"))
        )
        dt = F.when(k % 11 == 0, None).otherwise(
            F.col("t") + F.when(k % 5 == 0, 0.4).when(k % 5 == 1, 0.5).when(k % 5 == 2, 30.0).when(k % 5 == 3, 31.0).otherwise(0.0)
        )
        return self.cohort.select(
            "case_id", "sample_id", "grp", ce.alias("c_e"), ct.alias("c_t"), de.alias("d_e"), dt.alias("d_t")
        )

    @cached_property
    def forms(self) -> DataFrame:
        """Text form rows: events as (case, row, kind, value, token)."""
        e = self.events
        value = F.get_json_object("props", "$.k")
        token = (
            F.when(F.col("event_type") == "error", "[Not Available]")
            .when(F.col("event_type") == "signup", "[Unknown]")
            .when(F.col("event_type") == "click", "")
            .otherwise(value)
        )
        return e.select(
            F.col("user_id").alias("case_id"),
            F.col("event_id").alias("row_no"),
            F.col("event_type").alias("kind"),
            day_of("ts", "2024-01-01").alias("day"),
            F.col("value"),
            value.alias("k"),
            token.alias("token"),
        )

    @cached_property
    def segments(self) -> DataFrame:
        """Segments per (center, chromosome = gene type): [gene, gene + size]."""
        sp = self.lineitem.select("l_suppkey", "l_partkey").distinct()
        return sp.join(self.part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_suppkey").alias("center_id"),
            F.concat(F.lit("chr"), F.col("p_type")).alias("chromosome"),
            F.col("p_partkey").alias("start"),
            (F.col("p_partkey") + F.col("p_size")).alias("end"),
            (F.col("p_size") % 5).cast("bigint").alias("copy_number"),
        )


# The same roles for the SQL twins.
CTE = {
    "cases": """cases AS (SELECT c_custkey AS case_id, c_name AS submitter_id, n_name AS project_id,
  r_name AS program, c_mktsegment AS segment, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "samples": """samples AS (SELECT o_orderkey AS sample_id, o_custkey AS case_id, o_orderstatus AS sample_type,
  date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) AS day, o_totalprice AS weight,
  o_orderpriority AS priority FROM orders)""",
    "aliquots": """aliquots AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT)) AS aliquot_id,
  l_orderkey AS sample_id, l_linenumber AS portion_no, l_returnflag AS analyte_type, l_linestatus AS status,
  l_partkey AS gene_id, l_suppkey AS center_id, l_quantity AS quantity, l_extendedprice AS price,
  l_discount AS discount, l_tax AS tax, date_diff('day', TIMESTAMP '1992-01-01', l_shipdate) AS ship_day FROM lineitem)""",
    "files": """files AS (SELECT doc_id AS file_id, source || '.' || doc_id || '.' || lang || '.txt' AS file_name,
  lang AS data_type, source AS project_id, n_chars AS file_size, md5(text) AS md5sum FROM documents)""",
    "expression": """expression AS (SELECT l_suppkey AS sample_id, l_partkey AS gene_id, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)""",
    "genes": """genes AS (SELECT p_partkey AS gene_id, p_name AS gene_name, p_type AS gene_type, p_brand AS pathway,
  CAST(p_size AS BIGINT) AS size, p_retailprice AS price FROM part)""",
    "cohort": """cohort AS (SELECT s.case_id, s.sample_id, c.project_id AS grp, s.day AS t,
  CASE WHEN s.sample_type = 'F' THEN 1 ELSE 0 END AS e FROM samples s JOIN cases c ON s.case_id = c.case_id)""",
    "endpoints": """endpoints AS (SELECT case_id, sample_id, grp,
  CASE WHEN sample_id % 13 = 0 THEN NULL ELSE e END AS c_e,
  CASE WHEN sample_id % 13 = 0 THEN NULL ELSE CAST(t AS DOUBLE) END AS c_t,
  CASE WHEN sample_id % 11 = 0 THEN NULL WHEN sample_id % 7 = 0 THEN 1 - e ELSE e END AS d_e,
  CASE WHEN sample_id % 11 = 0 THEN NULL ELSE t + (CASE sample_id % 5 WHEN 0 THEN 0.4::DOUBLE WHEN 1 THEN 0.5 WHEN 2 THEN 30.0 WHEN 3 THEN 31.0 ELSE 0.0 END) END AS d_t
  FROM cohort)""",
    "forms": """forms AS (SELECT user_id AS case_id, event_id AS row_no, event_type AS kind,
  date_diff('day', TIMESTAMP '2024-01-01', ts) AS day, value, json_extract_string(props, '$.k') AS k,
  CASE event_type WHEN 'error' THEN '[Not Available]' WHEN 'signup' THEN '[Unknown]' WHEN 'click' THEN '' ELSE json_extract_string(props, '$.k') END AS token FROM events)""",
    "segments": """segments AS (SELECT DISTINCT l_suppkey AS center_id, 'chr' || p_type AS chromosome, p_partkey AS start,
  p_partkey + p_size AS "end", CAST(p_size % 5 AS BIGINT) AS copy_number
  FROM lineitem JOIN part ON l_partkey = p_partkey)""",
}
NEEDS = {"cohort": ["cases", "samples"], "endpoints": ["cases", "samples", "cohort"]}


def with_(*names: str, body: str) -> str:
    """``WITH`` clause holding the named roles and whatever they build on."""
    order: list[str] = []
    for n in names:
        for d in [*NEEDS.get(n, []), n]:
            if d not in order:
                order.append(d)
    head = "WITH RECURSIVE " if "RECURSIVE" in body[:40] else "WITH "
    body = body.replace("/*RECURSIVE*/", "")
    sep = ",\n" if body.lstrip().startswith(",") else "\n"
    ctes = ",\n".join(CTE[n] for n in order)
    return head + ctes + sep + body.lstrip().lstrip(",")
