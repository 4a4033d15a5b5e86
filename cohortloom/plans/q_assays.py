"""Flat assay tables read from files, which Spark first writes from the tables: one file per supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import assays as ay
from cohortloom.plans.q_sources import money, tabbed, text
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables
from cohortloom.session import shared_dir
from cohortloom.sinks.texts import write_texts

c = F.col
NAMED = {"name": r"file=([^/]+)$", "under": "file="}


def name(prefix: str, key: str = "l_suppkey"):
    return F.concat(F.lit(f"{prefix}_"), text(key))


def write_files(t: Tables, rows: DataFrame, header: str | None, purpose: str) -> str:
    """(file, line) rows as one file each, of its name, below ``header``. Nothing reads the new folder before the job has succeeded."""
    path = shared_dir(t.spark, purpose)
    write_texts(rows, path, "" if header is None else f"# made by a test\n{header}\n", NAMED["under"])
    return path


def manifest(t: Tables, prefix: str, two) -> DataFrame:
    """One file per supplier; ``two`` says which name a second aliquot. All name a slide as well."""
    k = text("s_suppkey")
    entity = lambda a, b, kind: F.struct(F.concat(F.lit(a), k).alias("entity_id"), F.concat(F.lit(b), k).alias("entity_submitter_id"), F.lit(kind).alias("entity_type"))
    one = [entity("sl-", "SB-", "slide"), entity("al-", "AB-", "aliquot")]
    return t.supplier.select(
        name(prefix, "s_suppkey").alias("file_name"), F.concat(F.lit("f-"), k).alias("file_id"), F.concat(F.lit("c-"), text("s_nationkey")).alias("case_id"),
        F.when(c("s_suppkey") % 2 == 0, "ASCAT3").otherwise("ASCAT2").alias("workflow_type"), F.lit("WXS").alias("experimental_strategy"), F.lit("450").alias("platform"),
        F.when(two, F.array(*one, entity("no-", "NB-", "aliquot"))).otherwise(F.array(*one)).alias("entities"),
    )


def aliquots(t: Tables) -> DataFrame:
    """Every supplier is an aliquot of its nation's case; some trees lack it, and nation 24 is no known case."""
    k, held = text("s_suppkey"), c("s_suppkey") % 11 != 5
    known = t.supplier.filter("s_nationkey <> 24")
    case = F.concat(F.lit("c-"), text("s_nationkey"))
    tag = lambda p: F.when(held, F.concat(F.lit(p), k))
    return known.select(
        case.alias("case_id"), F.concat(F.lit("C"), text("s_nationkey")).alias("case_submitter_id"), tag("s-").alias("sample_id"), tag("S").alias("sample_submitter_id"),
        F.when(held, F.when(c("s_suppkey") % 2 == 0, "Primary Tumor").otherwise("Metastatic")).alias("sample_type"), tag("al-").alias("aliquot_id"), tag("AB-").alias("aliquot_submitter_id"),
    )


def paired():
    return c("s_suppkey") % 3 != 0


def mixed():
    """Files whose aliquot column has a second value."""
    return (c("l_suppkey") % 10 == 7) & (c("l_linenumber") > 1)



KEYS_SQL = """'c-' || s_nationkey AS case_id, 'C' || s_nationkey AS case_submitter_id, CASE WHEN s_suppkey % 11 <> 5 THEN 's-' || s_suppkey END AS sample_id,
 CASE WHEN s_suppkey % 11 <> 5 THEN 'S' || s_suppkey END AS sample_submitter_id, CASE WHEN s_suppkey % 11 <> 5 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'Primary Tumor' ELSE 'Metastatic' END END AS sample_type,
 'al-' || s_suppkey AS aliquot_id, CASE WHEN s_suppkey % 11 <> 5 THEN 'AB-' || s_suppkey END AS aliquot_submitter_id, 'f-' || s_suppkey AS source_file_id"""
FLOW_SQL = "CASE WHEN s_suppkey % 2 = 0 THEN 'ASCAT3' ELSE 'ASCAT2' END AS workflow_type"
NORMAL_SQL = "CASE WHEN s_suppkey % 3 <> 0 THEN 'no-' || s_suppkey END AS matched_normal_aliquot_id, CASE WHEN s_suppkey % 3 <> 0 THEN 'NB-' || s_suppkey END AS matched_normal_aliquot_submitter_id"
FROM = "FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey <> 24"
#: Files with two values in the aliquot column: those of these suppliers that have a line beyond the first, and a first one.
SURE = "AND l_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_suppkey % 10 = 7 GROUP BY 1 HAVING count(DISTINCT l_linenumber > 1) > 1 OR max(l_linenumber) > 1)"
ALLELE = "GDC_Aliquot\tChromosome\tStart\tEnd\tCopy_Number\tMajor_Copy_Number\tMinor_Copy_Number"


def aliquot_cell(prefix: str):
    return F.concat(F.when(mixed(), f"x{prefix}").otherwise(prefix), text("l_suppkey"))


def allele_files(t: Tables) -> str:
    q, minor = c("l_quantity").cast("bigint"), c("l_partkey") % 2
    line = tabbed(aliquot_cell("al-"), F.concat(F.lit("chr"), text("l_linenumber")), text("l_partkey"), text(c("l_partkey") + q), text(q % 7), text(q % 7 - minor), text(minor))
    return write_files(t, t.lineitem.select(name("allele").alias("file"), line.alias("line")), ALLELE, "allele")


@query("flat_allele_segments", f"""SELECT {KEYS_SQL}, {NORMAL_SQL}, {FLOW_SQL}, 'WXS' AS experimental_strategy, 'chr' || l_linenumber AS chromosome, l_partkey AS start, l_partkey + CAST(l_quantity AS BIGINT) AS "end",
 CAST(l_quantity AS BIGINT) % 7 AS copy_number, CAST(l_quantity AS BIGINT) % 7 - l_partkey % 2 AS major_copy_number, l_partkey % 2 AS minor_copy_number {FROM} {SURE}""")
def _allele(t: Tables):
    return ay.allele_segments(t.spark, allele_files(t), manifest(t, "allele", paired()), aliquots(t), **NAMED)


def segment_rows(t: Tables, prefix: str, own, chromosome: str, flag: str | None = None) -> DataFrame:
    l = t.lineitem if flag is None else t.lineitem.filter(flag)
    line = tabbed(own, F.concat(F.lit(chromosome), text("l_linenumber")), text("l_partkey"), F.concat(text(c("l_partkey") + c("l_suppkey")), F.lit(".0")), text(c("l_quantity").cast("bigint")), money("l_tax"))
    return l.select(name(prefix).alias("file"), line.alias("line"))


SEGMENT_HEAD = "\tChromosome\tStart\tEnd\tNum_Probes\tSegment_Mean"
SEGMENT_SQL = """'{p}' || l_linenumber AS chromosome, l_partkey AS start, l_partkey + l_suppkey AS "end", CAST(l_quantity AS BIGINT) AS num_probes, l_tax AS segment_mean"""


@query("flat_masked_segments", f"SELECT {KEYS_SQL}, {FLOW_SQL}, {SEGMENT_SQL.format(p='')} {FROM} {SURE}")
def _masked(t: Tables):
    path = write_files(t, segment_rows(t, "masked", aliquot_cell("al-"), ""), "GDC_Aliquot" + SEGMENT_HEAD, "masked")
    return ay.masked_segments(t.spark, path, manifest(t, "masked", F.lit(False)), aliquots(t), **NAMED)


@query("flat_segments", f"""SELECT {KEYS_SQL}, NULL::VARCHAR AS matched_normal_aliquot_id, NULL::VARCHAR AS matched_normal_aliquot_submitter_id, {FLOW_SQL}, 'WXS' AS experimental_strategy, {SEGMENT_SQL.format(p='')} {FROM}
 AND l_returnflag <> 'N' UNION ALL SELECT {KEYS_SQL}, {NORMAL_SQL}, {FLOW_SQL}, 'WXS', {SEGMENT_SQL.format(p='chr')} {FROM} AND l_returnflag = 'N' AND l_suppkey % 10 <> 3""")
def _segments(t: Tables):
    # Every row belongs to one of the workflows; the second names barcodes, some of which no entity has.
    plain = F.concat(F.lit("al-"), text("l_suppkey"))
    barcode = F.concat(F.when(c("l_suppkey") % 10 == 3, "ZZ-").otherwise("AB-"), text("l_suppkey"))
    single = write_files(t, segment_rows(t, "dnacopy", plain, "", "l_returnflag <> 'N'"), "GDC_Aliquot" + SEGMENT_HEAD, "dnacopy")
    double = write_files(t, segment_rows(t, "gatk", barcode, "chr", "l_returnflag = 'N'"), "GDC_Aliquot_ID" + SEGMENT_HEAD, "gatk")
    both = manifest(t, "dnacopy", paired()).unionByName(manifest(t, "gatk", paired()))
    return ay.unmasked_segments(t.spark, single, double, both, aliquots(t), **NAMED)


@query("flat_gene_level", f"""SELECT {KEYS_SQL}, {NORMAL_SQL}, {FLOW_SQL}, 'WXS' AS experimental_strategy, 'ENSG' || l_partkey AS gene_id, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber::BIGINT END AS copy_number,
 l_suppkey AS min_copy_number, CAST(l_quantity AS BIGINT) AS max_copy_number {FROM} AND (s_suppkey % 3 = 0 OR 1 = 1 {SURE})""")
def _gene_level(t: Tables):
    line = tabbed(F.concat(F.lit("ENSG"), text("l_partkey")), F.lit("n"), F.lit("chr1"), F.lit("1"), F.lit("2"), F.when(c("l_returnflag") != "R", F.concat(text("l_linenumber"), F.lit(".0"))), text("l_suppkey"), text(c("l_quantity").cast("bigint")))
    header = "gene_id\tgene_name\tchromosome\tstart\tend\tcopy_number\tmin_copy_number\tmax_copy_number"
    path = write_files(t, t.lineitem.select(name("gene").alias("file"), line.alias("line")), header, "gene-level")
    both = manifest(t, "gene", paired()).unionByName(manifest(t, "allele", paired()).withColumn("case_id", F.lit("none")))
    return ay.gene_level(t.spark, path, both, aliquots(t), allele_files(t), **NAMED)


@query("flat_methylation", f"SELECT {KEYS_SQL}, '450' AS platform, 'cg' || l_orderkey AS probe_id, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END AS beta_value {FROM} AND s_suppkey % 3 = 0")
def _methylation(t: Tables):
    line = tabbed(F.concat(F.lit("cg"), text("l_orderkey")), F.when(c("l_returnflag") == "R", "NA").otherwise(money("l_discount")))
    path = write_files(t, t.lineitem.select(name("beta").alias("file"), line.alias("line")), None, "methylation")
    return ay.methylation(t.spark, path, manifest(t, "beta", paired()), aliquots(t), **NAMED)


@query("flat_expression", f"""SELECT 'c-' || s_nationkey AS case_id, 'C' || s_nationkey AS case_submitter_id, 'al-' || s_suppkey AS aliquot_id, CASE WHEN s_suppkey % 11 <> 5 THEN 'AB-' || s_suppkey END AS aliquot_submitter_id,
 'f-' || s_suppkey AS source_file_id, 'ENSG' || l_partkey AS gene_id, CAST(l_quantity AS BIGINT) AS unstranded, l_orderkey AS stranded_first, l_linenumber::BIGINT AS stranded_second, l_discount AS tpm_unstranded, l_tax AS fpkm_unstranded, l_extendedprice AS fpkm_uq_unstranded
 {FROM} AND s_suppkey % 3 = 0 AND l_linenumber <> 7""")
def _expression(t: Tables):
    gene = F.when(c("l_linenumber") == 7, "N_unmapped").otherwise(F.concat(F.lit("ENSG"), text("l_partkey")))
    line = tabbed(gene, F.lit("n"), F.lit("protein_coding"), text(c("l_quantity").cast("bigint")), text("l_orderkey"), text("l_linenumber"), money("l_discount"), money("l_tax"), money("l_extendedprice"))
    header = "gene_id\tgene_name\tgene_type\t" + "\t".join(ay.EXPRESSION_VALUES)
    path = write_files(t, t.lineitem.select(name("star").alias("file"), line.alias("line")), header, "expression")
    return ay.expression(t.spark, path, manifest(t, "star", paired()), aliquots(t), **NAMED)


@query("flat_isoforms", f"""SELECT {KEYS_SQL}, 'mir-' || l_partkey AS mirna_id, 'hg38:chr1:' || l_orderkey AS isoform_coords, CAST(l_quantity AS BIGINT) AS read_count, l_extendedprice AS reads_per_million_mirna_mapped,
 CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS cross_mapped, CASE WHEN l_linestatus = 'F' THEN 'mature,MIMAT' || l_linenumber END AS mirna_region {FROM} AND s_suppkey % 3 = 0""")
def _isoforms(t: Tables):
    region = F.when(c("l_linestatus") == "F", F.concat(F.lit("mature,MIMAT"), text("l_linenumber")))
    line = tabbed(F.concat(F.lit("mir-"), text("l_partkey")), F.concat(F.lit("hg38:chr1:"), text("l_orderkey")), text(c("l_quantity").cast("bigint")), money("l_extendedprice"), F.when(c("l_returnflag") == "A", "Y").otherwise("N"), region)
    path = write_files(t, t.lineitem.select(name("iso").alias("file"), line.alias("line")), "\t".join(ay.ISOFORM), "isoforms")
    return ay.isoforms(t.spark, path, manifest(t, "iso", paired()), aliquots(t), **NAMED)


@query("flat_gene_model", """SELECT 'ENSG' || coalesce(p_partkey, s_suppkey) AS gene_id, coalesce(p_name, 'g' || s_suppkey) AS gene_name, p_type AS gene_type, CASE WHEN s_suppkey IS NOT NULL THEN 'chr' || s_nationkey END AS chromosome, s_suppkey AS start, s_suppkey + 9 AS "end"
 FROM (SELECT * FROM part WHERE p_partkey % 2 = 0) p FULL JOIN supplier ON p_partkey = s_suppkey""")
def _gene_model(t: Tables):
    ensg = lambda k: F.concat(F.lit("ENSG"), text(k))
    own = tabbed(F.when(c("p_partkey") % 2 == 0, ensg("p_partkey")).otherwise(F.concat(F.lit("N_"), text("p_partkey"))), c("p_name"), c("p_type"))
    a = write_files(t, t.part.select(F.lit("one").alias("file"), own.alias("line")), "gene_id\tgene_name\tgene_type", "model-a")
    other = tabbed(text(c("s_suppkey") + 9), text("s_suppkey"), F.concat(F.lit("chr"), text("s_nationkey")), F.concat(F.lit("g"), text("s_suppkey")), ensg("s_suppkey"))
    b = write_files(t, t.supplier.select(F.lit("two").alias("file"), other.alias("line")), "end\tstart\tchromosome\tgene_name\tgene_id", "model-b")
    return ay.gene_model(t.spark, a, b)
