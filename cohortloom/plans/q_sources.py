"""Text sources and scalar functions over lines that Spark derives from the tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from cohortloom.functions import scalars as sc
from cohortloom.operators.patients import Children, nest_lists
from cohortloom.operators.sets import union_pad
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, r6, with_
from cohortloom.session import shared_dir
from cohortloom.sources import splits as sp
from cohortloom.sources import text as tx
from cohortloom.sources import typed as ty

c = F.col


def text(x) -> F.Column:
    return (c(x) if isinstance(x, str) else x).cast("string")


def money(x: str):
    """A price or rate as plain decimal text."""
    return c(x).cast("decimal(18,2)").cast("string")


def tabbed(*cells):
    return F.concat_ws("\t", *[F.coalesce(x, F.lit("")) for x in cells])


KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
KEY_SQL = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


@query("scan_text_coerce", f"""SELECT {KEY_SQL}, CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS depth,
 CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS score, CASE WHEN l_tax > 0 THEN 'NA' END AS note FROM lineitem""")
def _scan_text_coerce(t: Tables):
    header = [*KEYS, "depth", "score", "note"]
    depth = F.when(c("l_returnflag") == "R", "bad").when(c("l_returnflag") == "A", text(c("l_quantity").cast("bigint"))).otherwise(F.concat(text(c("l_quantity").cast("bigint")), F.lit(".0")))
    score = F.when(~((c("l_linestatus") == "F") & (c("l_returnflag") == "A")), money("l_extendedprice"))
    body = t.lineitem.select(tabbed(*[text(k) for k in KEYS], depth, score, F.when(c("l_tax") > 0, "NA")).alias("value"))
    path = shared_dir(t.spark, "variants")

    def with_top(batches):
        for k, batch in enumerate(batches):
            if k == 0:
                yield pa.RecordBatch.from_pylist([{"value": "#version 2.4"}, {"value": "\t".join(header)}], batch.schema)
            yield batch

    # Every file begins with a comment line and its header.
    body.mapInArrow(with_top, "value string").write.text(path)
    wanted = [*KEYS, "score", "note", "depth"]
    rows = sp.read_delimited(t.spark, path, wanted).select(*wanted)
    out = tx.coerce(rows, [*KEYS, "depth"], ["score"])
    return out.withColumn("l_linenumber", c("l_linenumber").cast("int"))


GENE_SQL = """g AS (SELECT l_orderkey AS aliquot, CASE l_linenumber WHEN 1 THEN 'N_unmapped' WHEN 2 THEN 'N_multimapping' WHEN 3 THEN 'N_noFeature' WHEN 4 THEN 'N_ambiguous' ELSE 'ENSG' || l_partkey END AS gene_id,
 CAST(sum(l_quantity) AS BIGINT) AS unstranded FROM lineitem GROUP BY ALL)
"""
COUNT_HEADER = ["gene_id", "gene_name", "unstranded"]


def count_lines(t: Tables):
    n = c("l_linenumber")
    gene = F.when(n == 1, "N_unmapped").when(n == 2, "N_multimapping").when(n == 3, "N_noFeature").when(n == 4, "N_ambiguous").otherwise(F.concat(F.lit("ENSG"), text("l_partkey")))
    g = t.lineitem.groupBy(c("l_orderkey").alias("aliquot"), gene.alias("gene_id")).agg(F.sum("l_quantity").cast("bigint").alias("q"))
    return g.select("aliquot", tabbed(c("gene_id"), F.when(~c("gene_id").startswith("N_"), F.concat(F.lit("name-"), "gene_id")), text("q")).alias("line"))


def counts(t: Tables):
    parsed = tx.delimited(count_lines(t), COUNT_HEADER, keep=["aliquot"], columns=["gene_id", "unstranded"])
    return tx.coerce(parsed, ["unstranded"])


@query("split_summary_rows", "WITH " + GENE_SQL + "SELECT aliquot, gene_id, unstranded FROM g WHERE gene_id NOT LIKE 'N\\_%' ESCAPE '\\'")
def _split(t: Tables):
    return tx.gene_rows(counts(t))


@query("qc_tallies", "WITH " + GENE_SQL + """SELECT aliquot, max(unstranded) FILTER (WHERE gene_id = 'N_unmapped') AS N_unmapped, max(unstranded) FILTER (WHERE gene_id = 'N_multimapping') AS N_multimapping,
 max(unstranded) FILTER (WHERE gene_id = 'N_noFeature') AS N_noFeature, max(unstranded) FILTER (WHERE gene_id = 'N_ambiguous') AS N_ambiguous FROM g WHERE starts_with(gene_id, 'N_') GROUP BY 1""")
def _tallies(t: Tables):
    return tx.summary_rows(counts(t), ["aliquot"], "unstranded")


@query("expression_flat", "WITH " + GENE_SQL + """SELECT o_custkey AS case_id, aliquot, gene_id, unstranded FROM g JOIN orders ON o_orderkey = aliquot JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0 AND NOT starts_with(gene_id, 'N_')""")
def _expression_flat(t: Tables):
    known = t.customer.filter("c_acctbal > 0").select("c_custkey")
    dim = t.orders.join(known, c("o_custkey") == c("c_custkey"), "left_semi").select("o_orderkey", c("o_custkey").alias("case_id"))
    g = tx.gene_rows(counts(t))
    return g.join(dim, c("aliquot") == c("o_orderkey")).select("case_id", "aliquot", "gene_id", "unstranded")


SEG_HEADER = ["GDC_Aliquot", "Chromosome", "Start", "End", "Copy_Number", "Major_Copy_Number", "Minor_Copy_Number"]


def manifest(t: Tables):
    """Segment files: one per supplier, owned by a case (null for closed ones)."""
    return t.supplier.select(
        F.concat(F.lit("seg_"), text("s_suppkey"), F.lit(".txt")).alias("file_name"),
        F.when(c("s_acctbal") > 1000, c("s_suppkey")).alias("case_id"),
    )


def seg_name():
    return F.concat(F.lit("seg_"), text("l_suppkey"), F.lit(".txt")).alias("file_name")


@query("segments_allele", """SELECT l_suppkey AS case_id, 'al-' || l_orderkey AS aliquot, 'chr' || l_linenumber AS chromosome, l_partkey AS start, l_partkey + CAST(l_quantity AS BIGINT) AS "end",
 CAST(l_quantity AS BIGINT) % 7 AS copy_number, CAST(l_quantity AS BIGINT) % 7 - l_partkey % 2 AS major, l_partkey % 2 AS minor FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 1000""")
def _segments_allele(t: Tables):
    q = c("l_quantity").cast("bigint")
    minor = c("l_partkey") % 2
    lines = t.lineitem.select(
        seg_name(),
        tabbed(F.concat(F.lit("al-"), text("l_orderkey")), F.concat(F.lit("chr"), text("l_linenumber")), text("l_partkey"), text(c("l_partkey") + q), text(q % 7), text(q % 7 - minor), text(minor)).alias("line"),
    )
    rename = dict(zip(SEG_HEADER, ["aliquot", "chromosome", "start", "end", "copy_number", "major", "minor"]))
    parsed = tx.delimited(lines, SEG_HEADER, keep=["file_name"], rename=rename)
    out = tx.coerce(parsed, ["start", "end", "copy_number", "major", "minor"])
    return out.join(manifest(t).filter("case_id is not null"), "file_name").drop("file_name")


MASKED = ["GDC_Aliquot", "Chromosome", "Start", "End", "Num_Probes", "Segment_Mean"]
PAIRED = ["GDC_Aliquot_ID", "Chromosome", "Start", "End", "Num_Probes", "Segment_Mean"]
SEG_OUT = ["aliquot", "chromosome", "start", "end", "num_probes", "segment_mean"]


def plain_segments(t: Tables, rows: str | None, prefix: str, header: list[str], normal: bool = False):
    """Segments of the rows that meet ``rows``; with ``normal``, those of paired samples name theirs."""
    l = t.lineitem if rows is None else t.lineitem.filter(rows)
    chrom = F.when(c("l_linenumber") == 7, "X").otherwise(F.concat(F.lit(prefix), text("l_linenumber")))
    line = tabbed(F.concat(F.lit("al-"), text("l_orderkey")), chrom, text("l_partkey"), text(c("l_partkey") + c("l_suppkey")), text(c("l_quantity").cast("bigint")), money("l_tax")).alias("line")
    other = F.when(c("l_returnflag") == "R", F.concat(F.lit("no-"), text("l_orderkey"))).alias("normal")
    parsed = tx.delimited(l.select(line, other), header, keep=["normal"] if normal else [], rename=dict(zip(header, SEG_OUT)))
    return tx.coerce(parsed, ["start", "end", "num_probes"], ["segment_mean"])


SEG_SQL = """SELECT 'al-' || l_orderkey AS aliquot, CASE WHEN l_linenumber = 7 THEN 'X' ELSE '{p}' || l_linenumber END AS chromosome, l_partkey AS start, l_partkey + l_suppkey AS "end", CAST(l_quantity AS BIGINT) AS num_probes, l_tax AS segment_mean{more} FROM lineitem{where}"""


@query("segments_masked", SEG_SQL.format(p="", where="", more=""))
def _segments_masked(t: Tables):
    return plain_segments(t, None, "", MASKED)


@query("segments_union", SEG_SQL.format(p="", where=" WHERE l_returnflag = 'A'", more=", 'DNAcopy' AS workflow, NULL::VARCHAR AS normal") + " UNION ALL " + SEG_SQL.format(p="chr", where=" WHERE l_returnflag <> 'A'", more=", 'GATK4 CNV', CASE WHEN l_returnflag = 'R' THEN 'no-' || l_orderkey END"))
def _segments_union(t: Tables):
    a = plain_segments(t, "l_returnflag = 'A'", "", MASKED).withColumn("workflow", F.lit("DNAcopy"))
    b = plain_segments(t, "l_returnflag <> 'A'", "chr", PAIRED, normal=True).withColumn("workflow", F.lit("GATK4 CNV"))
    return union_pad([a, b])


@query("gene_level_cn", f"""SELECT l_orderkey AS aliquot, 'ENSG' || l_partkey AS gene_id, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber::BIGINT END AS copy_number, l_suppkey AS min_copy_number, CAST(l_quantity AS BIGINT) AS max_copy_number FROM lineitem""")
def _gene_level(t: Tables):
    header = ["gene_id", "gene_name", "chromosome", "start", "end", "copy_number", "min_copy_number", "max_copy_number"]
    line = tabbed(F.concat(F.lit("ENSG"), text("l_partkey")), F.lit("n"), F.lit("chr1"), F.lit("1"), F.lit("2"), F.when(c("l_returnflag") != "R", text("l_linenumber")), text("l_suppkey"), text(c("l_quantity").cast("bigint")))
    lines = t.lineitem.select(c("l_orderkey").alias("aliquot"), line.alias("line"))
    values = header[5:]
    return tx.coerce(tx.delimited(lines, header, keep=["aliquot"], columns=["gene_id", *values]), values)


@query("scan_headerless", """SELECT 'cg' || event_id AS probe_id, CASE WHEN event_type = 'error' THEN NULL ELSE round(value, 2) END AS beta_value FROM events""")
def _headerless(t: Tables):
    beta = F.when(c("event_type") == "error", "NA").otherwise(c("value").cast("decimal(18,2)").cast("string"))
    lines = t.events.select(tabbed(F.concat(F.lit("cg"), text("event_id")), beta).alias("line"))
    parsed = tx.delimited(lines, ["probe_id", "beta_value"], nulls=("NA", ""))
    return tx.coerce(parsed, floats=["beta_value"])


@query("scan_rename", """SELECT 'mir-' || l_partkey AS mirna_id, CAST(l_quantity AS BIGINT) AS read_count, l_extendedprice AS reads_per_million, CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS cross_mapped FROM lineitem""")
def _rename(t: Tables):
    header = ["miRNA_ID", "read_count", "reads_per_million_miRNA_mapped", "cross-mapped"]
    line = tabbed(F.concat(F.lit("mir-"), text("l_partkey")), text(c("l_quantity").cast("bigint")), money("l_extendedprice"), F.when(c("l_returnflag") == "A", "Y").otherwise("N"))
    parsed = tx.delimited(
        t.lineitem.select(line.alias("line")), header,
        rename={"miRNA_ID": "mirna_id", "reads_per_million_miRNA_mapped": "reads_per_million", "cross-mapped": "cross_mapped"},
    )
    return tx.coerce(parsed, ["read_count"], ["reads_per_million"])


@query("protein_rows", """SELECT l_orderkey || '-' || l_linenumber AS portion_id, 'AG' || l_partkey AS agid, lpad(l_suppkey::VARCHAR, 8, '0') AS lab_id, CASE WHEN l_returnflag = 'N' THEN NULL ELSE -l_discount END AS protein_expression FROM lineitem""")
def _protein(t: Tables):
    header = ["AGID", "lab_id", "catalog_number", "set_id", "peptide_target", "protein_expression"]
    value = F.when(c("l_returnflag") == "N", "NA").otherwise((-c("l_discount")).cast("decimal(18,2)").cast("string"))
    line = tabbed(F.concat(F.lit("AG"), text("l_partkey")), F.lpad(text("l_suppkey"), 8, "0"), F.lit("c"), F.lit("s"), F.lit("p"), value)
    lines = t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("portion_id"), line.alias("line"))
    parsed = tx.delimited(lines, header, keep=["portion_id"], columns=["AGID", "lab_id", "protein_expression"], rename={"AGID": "agid"})
    return tx.coerce(parsed, floats=["protein_expression"])


@query("scan_multiheader", """
WITH raw AS (SELECT doc_id, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line, unnest(range(1, 1 + len(string_split(text, chr(10))))) AS n FROM documents),
kept AS (SELECT doc_id, n, string_split(line, '. ') AS cells FROM raw WHERE replace(line, '. ', '') <> ''),
cells AS (SELECT doc_id, n, unnest([1, 2, 3]) AS k, cells FROM kept)
SELECT 'form_' || doc_id AS file_name, k AS col, count(*) AS rows, CAST(sum(length(coalesce(cells[k], ''))) AS BIGINT) AS chars, count_if(coalesce(cells[k], '') = '')::BIGINT AS empties FROM cells GROUP BY ALL""")
def _multiheader(t: Tables):
    clean = F.replace(F.col("text"), F.lit("\r"), F.lit(""))
    quoted = lambda x: F.when(x.rlike('[\\t"]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)
    row = lambda line: F.array_join(F.transform(F.split(line, r"\. ", -1), quoted), "\t")
    table = F.array_join(F.transform(F.split(clean, "\n", -1), row), "\n")
    head = F.lit("c1\tc2\tc3\nalias1\talias2\talias3\nCDE:1\tCDE:2\tCDE:3\n")
    # Every document is one form: its lines are rows, its sentences cells.
    safe = F.regexp_replace(F.concat(head, table), r"[^\x00-\x{FF}]", "?")
    content = F.encode(safe, "ISO-8859-1")
    files = t.documents.select(F.concat(F.lit("form_"), text("doc_id")).alias("file_name"), content.alias("content"))
    cells = tx.multi_header(files, "file_name")
    return cells.groupBy("file_name", F.substring("column", 2, 1).cast("int").alias("col")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("value")).cast("bigint").alias("chars"), F.count_if(c("value") == "").alias("empties")
    )


@query("scan_genesets", """
WITH w AS (SELECT source || '-' || lang AS pathway, doc_id, string_split(regexp_replace(text, '[\\t\\n ]+', ' ', 'g'), ' ') AS words FROM documents),
l AS (SELECT pathway, arg_max(words, doc_id) AS words FROM w GROUP BY 1), m AS (SELECT pathway, unnest(words) AS gene FROM l)
SELECT pathway, gene, count(*) AS n FROM m WHERE gene <> '' GROUP BY ALL""")
def _genesets(t: Tables):
    words = F.regexp_replace("text", r"[\t\n ]+", "\t")
    lines = t.documents.select(
        F.concat_ws("\t", F.concat_ws("-", "source", "lang"), F.lit("link"), words).alias("line"), "doc_id"
    )
    members = tx.gene_sets(lines, ["doc_id"])
    return members.groupBy("pathway", "gene").agg(F.count(F.lit(1)).alias("n"))


@query("curated_scan", with_("endpoints", body="""
SELECT 'P-' || sample_id AS barcode, c_e AS "cdr_OS", c_t AS "cdr_OS_time", d_e AS "cdr_PFI", NULL::DOUBLE AS "cdr_PFI_time", CASE WHEN sample_id % 17 = 0 THEN 'Redacted' END AS cdr_redaction FROM endpoints"""))
def _curated_scan(t: Tables):
    e = t.endpoints
    sheet = e.select(
        F.concat(F.lit("P-"), text("sample_id")).alias("barcode"),
        F.coalesce(text("c_e"), F.lit("#N/A")).alias("OS"), F.coalesce(text("c_t"), F.lit("#N/A")).alias("OS.time"),
        F.coalesce(text("d_e"), F.lit("")).alias("PFI"), F.lit("NaN").alias("PFI.time"),
        *[F.lit(None).cast("string").alias(x) for x in ("DSS", "DSS.time", "DFI", "DFI.time")],
        F.when(c("sample_id") % 17 == 0, "Redacted").alias("Redaction"),
    )
    out = ty.curated_scan(sheet, "barcode", ["Redaction"])
    return out.select("barcode", "cdr_OS", "cdr_OS_time", "cdr_PFI", "cdr_PFI_time", "cdr_redaction")


@query("typed_sheet", """SELECT o_custkey::INTEGER AS days, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS label, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE (o_orderkey + 1)::INTEGER END AS n FROM orders""")
def _typed_sheet(t: Tables):
    s = c("o_orderstatus")
    sheet = t.orders.select(
        text(c("o_orderkey") + 1).alias("no"), text("o_custkey").alias("days"),
        F.when(s == "P", "#N/A").otherwise(c("o_orderpriority")).alias("label"),
        F.when(s == "F", "#N/A").otherwise(text(c("o_orderkey") + 1)).alias("n"),
    )
    return ty.typed_sheet(sheet, "no")


def study_lines(t: Tables):
    """A study file: four metadata lines and a header before the body."""
    head = [
        "#Patient\tGender\tBalance\tScore\tNote", "#Patient id\tSex\tBalance left\tGleason score\tFree text",
        "#STRING\tSTRING\tNUMBER\tSTRING\tNUMBER", "#1\t1\t1\t1\t1", "PATIENT_ID\tGENDER\tBALANCE\tGLEASON\tN",
    ]
    top = t.customer.agg((F.min("c_custkey") - 1).alias("no")).select(
        "no", F.posexplode(F.array(*[F.lit(h) for h in head])).alias("sub", "line")
    )
    k = c("c_custkey")
    body = t.customer.select(
        k.alias("no"), F.lit(0).alias("sub"),
        tabbed(c("c_name"), c("c_mktsegment"), money("c_acctbal"), text(k % 10), F.when(c("c_nationkey") != 3, text(k * 7))).alias("line"),
    )
    return top.unionByName(body)


@query("study_scan", """SELECT c_name AS "PATIENT_ID", c_mktsegment AS "GENDER", c_acctbal AS "BALANCE", CAST(c_custkey % 10 AS VARCHAR) AS "GLEASON", CASE WHEN c_nationkey <> 3 THEN c_custkey * 7 END AS "N" FROM customer""")
def _study_scan(t: Tables):
    return ty.read_study_table(study_lines(t), "clinical_patient", ["no", "sub"])


LOSSLESS = """CASE l_linenumber WHEN 1 THEN CAST(l_orderkey AS VARCHAR) WHEN 2 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) WHEN 3 THEN '0' || l_partkey
 WHEN 4 THEN '.' || l_suppkey WHEN 5 THEN (l_partkey + 1) || 'e2' WHEN 6 THEN (l_partkey + 1) || '.12345678901234567890123' ELSE '-' || (l_suppkey + 1) END"""


@query("lossless_numeric", f"""WITH v AS (SELECT l_linenumber AS kind, {LOSSLESS} AS v, l_partkey, l_extendedprice FROM lineitem)
SELECT kind, v, regexp_matches(v, '^-?(0|[1-9][0-9]*)$') AND CAST(TRY_CAST(v AS BIGINT) AS VARCHAR) = v AS whole, kind IN (1, 2, 5, 7) OR (kind = 3 AND l_partkey < 0) AS exact FROM v""")
def _lossless(t: Tables):
    n, p = c("l_linenumber"), c("l_partkey")
    v = (
        F.when(n == 1, text("l_orderkey")).when(n == 2, money("l_extendedprice")).when(n == 3, F.concat(F.lit("0"), text("l_partkey")))
        .when(n == 4, F.concat(F.lit("."), text("l_suppkey"))).when(n == 5, F.concat(text(p + 1), F.lit("e2")))
        .when(n == 6, F.concat(text(p + 1), F.lit(".12345678901234567890123"))).otherwise(F.concat(F.lit("-"), text(c("l_suppkey") + 1)))
    )
    out = t.lineitem.select(n.alias("kind"), v.alias("v"))
    return out.select("kind", "v", ty.is_int(c("v")).alias("whole"), ty.is_exact_float(c("v")).alias("exact"))


@query("config_name", """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN replace(p_brand, '.', '_') || '_' || replace(p_name, ' ', '_') || '_seg' WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN NULL ELSE p_brand || '_x' END AS config FROM part""")
def _config_name(t: Tables):
    y = c("p_type")
    member = (
        F.when(y == "ECONOMY", F.concat(F.lit("data_"), "p_brand", F.lit("_"), F.replace("p_name", F.lit(" "), F.lit(".")), F.lit(".seg")))
        .when(y == "PROMO", F.concat(F.lit("meta_"), "p_brand", F.lit(".txt")))
        .when(y == "SMALL", F.concat(F.lit("case_lists/data_"), "p_brand"))
        .otherwise(F.concat(F.lit("data_"), "p_brand", F.lit("_x.txt")))
    )
    return t.part.select("p_partkey", sc.config_name(member).alias("config"))


@query("binary_docs", """SELECT d.doc_id, strlen(text)::BIGINT AS n_bytes, md5(text) AS md5_bytes, quality FROM documents d JOIN labels l USING (doc_id)""")
def _binary_docs(t: Tables):
    files = t.documents.select("doc_id", c("text").cast("binary").alias("content"))
    return tx.binary_documents(files, t.labels.select("doc_id", "quality"), "doc_id").select("doc_id", "n_bytes", "md5_bytes", "quality")


DICT_TABLES = ("customer", "orders", "events")
DICT_COLS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


@query("dictionary", " UNION ALL ".join(f"SELECT '{t}' AS tbl, '{x}' AS name, count({x}) AS n_values FROM {t}" for t in DICT_TABLES for x in DICT_COLS[t]))
def _dictionary(t: Tables):
    parts = []
    for name in DICT_TABLES:
        df = getattr(t, name)
        fields = [d[0] for d in ty.dictionary(df)]
        counted = df.agg(*[F.count(x).alias(x) for x in fields])
        parts.append(counted.unpivot([], fields, "name", "n_values").select(F.lit(name).alias("tbl"), "name", "n_values"))
    return union_pad(parts)


@query("na_tokens", with_("forms", body="""SELECT row_no, coalesce(token NOT IN ('[Not Available]', '[Not Applicable]', '[Unknown]', '[Discrepancy]', '[Not Evaluated]', '[Completed]', '[Pending]', ''), false) AS populated FROM forms"""))
def _na_tokens(t: Tables):
    return t.forms.select("row_no", sc.is_populated(c("token")).alias("populated"))


@query("form_kind", """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'clinical_drug' WHEN 'MEDIUM' THEN NULL WHEN 'PROMO' THEN 'clinical_follow_up' WHEN 'STANDARD' THEN 'clinical_nte' ELSE NULL END AS clinical,
 CASE p_type WHEN 'SMALL' THEN 'biospecimen_slide' WHEN 'LARGE' THEN 'auxiliary' END AS specimen FROM part""")
def _form_kind(t: Tables):
    y = c("p_type")
    stem = (
        F.when(y == "ECONOMY", "x_clinical_drug_").when(y == "MEDIUM", "x_clinical_drugs_").when(y == "PROMO", "x_clinical_follow_up_v4.0_")
        .when(y == "STANDARD", "clinical_nte_x_clinical_nte.").when(y == "SMALL", "y_biospecimen_slide_").otherwise("org_auxiliary_")
    )
    name = F.concat(stem, F.lower("p_brand"), F.lit(".txt"))
    return t.part.select("p_partkey", sc.form_kind(name).alias("clinical"), sc.form_kind(name, sc.BIOSPECIMEN_FORMS).alias("specimen"))


@query("short_project", "SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN c_mktsegment ELSE c_mktsegment || '-' || c_nationkey END AS short FROM customer")
def _short(t: Tables):
    seg = c("c_mktsegment")
    name = F.when(c("c_nationkey") == 0, seg).otherwise(F.concat(F.lit("TCGA-"), seg, F.lit("-"), text("c_nationkey")))
    return t.customer.select("c_custkey", sc.short_project(name).alias("short"))


@query("patient_barcode", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 'TCGA-' || l_suppkey || '-' || l_partkey WHEN l_returnflag = 'N' THEN 'TCGA-' || l_partkey || '-' || l_orderkey END AS patient FROM lineitem""")
def _barcode(t: Tables):
    flag = c("l_returnflag")
    a = F.when(flag == "A", F.concat_ws("-", F.lit(" TCGA"), "l_suppkey", "l_partkey", F.lit("01A"), F.lit("11D"))).otherwise(F.concat_ws("-", F.lit("TCGA"), "l_suppkey"))
    b = F.when(flag == "N", F.concat_ws("-", F.lit("TCGA"), "l_partkey", "l_orderkey")).otherwise(F.concat_ws("-", F.lit("X"), "l_partkey", "l_orderkey"))
    return t.lineitem.select(*KEYS, sc.patient_barcode([a, b]).alias("patient"))


@query("uuid_part", """SELECT doc_id, CASE WHEN lang = 'en' THEN substr(md5(text), 1, 8) || '-' || substr(md5(text), 9, 4) || '-' || substr(md5(text), 13, 4) || '-' || substr(md5(text), 17, 4) || '-' || substr(md5(text), 21, 12) END AS uuid FROM documents""")
def _uuid(t: Tables):
    h = F.md5(c("text").cast("binary"))
    cut = lambda a, n: F.substring(h, a, n)
    uuid = F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))
    name = (
        F.when(c("lang") == "en", F.concat(F.lit("TCGA-XX."), uuid, F.lit(".PDF")))
        .when(c("lang") == "fr", F.concat(F.lit("TCGA-XX."), uuid))
        .otherwise(F.concat(F.lit("TCGA-XX."), F.replace(uuid, F.lit("-"), F.lit("")), F.lit(".PDF")))
    )
    return t.documents.select("doc_id", sc.uuid_part(name).alias("uuid"))


@query("file_suffix", """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'maf.gz' WHEN 'MEDIUM' THEN 'tsv' WHEN 'PROMO' THEN 'dat' WHEN 'STANDARD' THEN 'gz' ELSE 'pdf' END AS suffix FROM part""")
def _suffix(t: Tables):
    y = c("p_type")
    end = F.when(y == "ECONOMY", ".wxs.MAF.gz").when(y == "MEDIUM", ".seg.v2.tsv").when(y == "PROMO", "").when(y == "STANDARD", ".gz").otherwise(".a.PDF")
    name = F.concat(F.replace(c("p_name"), F.lit(" "), F.lit("_")), end)
    return t.part.select("p_partkey", sc.file_suffix(name).alias("suffix"))


@query("urls", """SELECT doc_id, 'https://portal.gdc.cancer.gov/cases/' || doc_id AS case_url, 'https://portal.gdc.cancer.gov/files/' || doc_id AS file_url, 'https://api.gdc.cancer.gov/data/' || doc_id AS data_url,
 'https://www.gsea-msigdb.org/gsea/msigdb/human/geneset/' || source AS set_url FROM documents""")
def _urls(t: Tables):
    d = c("doc_id")
    return t.documents.select(
        "doc_id", sc.case_url(d).alias("case_url"), sc.file_url(d).alias("file_url"), sc.data_url(d).alias("data_url"), sc.gene_set_url(c("source")).alias("set_url")
    )


@query("md5_col", "SELECT doc_id, md5(text) AS md5sum, sha256(text) AS sha256sum FROM documents")
def _md5(t: Tables):
    b = c("text").cast("binary")
    return t.documents.select("doc_id", F.md5(b).alias("md5sum"), F.sha2(b, 256).alias("sha256sum"))


@query("iter_values", with_("forms", body="""
, p AS (SELECT case_id, arg_max(token, row_no) AS v FROM forms WHERE kind IN ('signup', 'view') GROUP BY 1),
f AS (SELECT case_id, string_agg(token, '|' ORDER BY row_no) AS vs, arg_min(token, row_no) AS one, bool_or(token = '50') AS hit FROM forms WHERE kind NOT IN ('signup', 'view') AND token NOT IN ('[Not Available]', '') GROUP BY 1),
q AS (SELECT case_id, CASE WHEN v NOT IN ('[Unknown]', '') THEN v END AS pv, vs, one, coalesce(hit, false) AS hit FROM (SELECT DISTINCT case_id FROM forms) LEFT JOIN p USING (case_id) LEFT JOIN f USING (case_id))
SELECT case_id, concat_ws('|', pv, vs) AS vals, coalesce(pv, one) AS first, coalesce(pv = '50', false) OR hit AS any_hit FROM q"""))
def _iter_values(t: Tables):
    # Every event belongs to the patient form (the last wins) or to the follow-up forms.
    f = t.forms.select("case_id", "row_no", "kind", "token")
    own = c("kind").isin("signup", "view")
    last = f.filter(own).groupBy("case_id").agg(F.struct(F.max_by("token", "row_no").alias("token")).alias("patient"))
    base = f.select("case_id").distinct().join(last, "case_id", "left")
    j = nest_lists(base, "case_id", {"forms": Children(f.filter(~own), "case_id", [c("row_no")], ["row_no", "token"])})
    j = j.withColumn("vals", sc.form_values(c("patient"), c("forms"), "token", "row_no"))
    return j.select("case_id", F.array_join("vals", "|").alias("vals"), sc.first_value(c("vals")).alias("first"), sc.any_of(c("vals"), "50").alias("any_hit"))


@query("meta_map", """SELECT page_id, url AS link, 'a:b' AS extra, true AS ok FROM pages""")
def _meta_map(t: Tables):
    meta = F.concat(F.lit("link: "), "url", F.lit("\nno colon here\nextra : a:b\n"))
    m = t.pages.select("page_id", sc.meta_map(meta).alias("m"))
    return m.select("page_id", c("m")["link"].alias("link"), c("m")["extra"].alias("extra"), (F.size("m") == 2).alias("ok"))
