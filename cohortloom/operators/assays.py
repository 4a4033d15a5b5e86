"""Flat tables of assays out of files: measurements, the file's aliquots, and their place in the case's tree.

A manifest has one row per file: ``file_name``, ``file_id``, ``case_id``, ``workflow_type``,
``experimental_strategy``, ``platform`` and ``entities``, an array of (entity_id, entity_submitter_id, entity_type).
An aliquot table has one row per aliquot: ``case_id``, ``case_submitter_id``, ``sample_id``,
``sample_submitter_id``, ``sample_type``, ``aliquot_id``, ``aliquot_submitter_id``. Which aliquot a file measures is
settled per file, in a table of one row a file, and joined to the measurements once; a file whose
aliquot cannot be told is left out, never guessed at. Tables of one row a file or aliquot meet in shuffles too: they grow with the files, and
Spark takes them to be as small as the Parquet they come from. With ``under``, the files of a name are those in the folder ``under`` + name below
``path``, and tasks look them up by the manifest; without, the driver lists ``path``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.sets import union_pad
from cohortloom.sources.splits import read_delimited
from cohortloom.sources.text import coerce

FILE_COLUMNS = ("file_name", "file_id", "case_id", "workflow_type", "experimental_strategy", "platform", "entities")
KEYS = ["case_id", "case_submitter_id", "sample_id", "sample_submitter_id", "sample_type", "aliquot_id", "aliquot_submitter_id"]
NORMAL = ["matched_normal_aliquot_id", "matched_normal_aliquot_submitter_id"]
# Column names of the source files.
SEGMENT = {"Chromosome": "chromosome", "Start": "start", "End": "end"}
MEASURED = {"Num_Probes": "num_probes", "Segment_Mean": "segment_mean"}
COPIES = {"Copy_Number": "copy_number", "Major_Copy_Number": "major_copy_number", "Minor_Copy_Number": "minor_copy_number"}
EXPRESSION_VALUES = ("unstranded", "stranded_first", "stranded_second", "tpm_unstranded", "fpkm_unstranded", "fpkm_uq_unstranded")
GENE_LEVEL_VALUES = ("copy_number", "min_copy_number", "max_copy_number")
ISOFORM = {
    "miRNA_ID": "mirna_id", "isoform_coords": "isoform_coords", "read_count": "read_count",
    "reads_per_million_miRNA_mapped": "reads_per_million_mirna_mapped", "cross-mapped": "cross_mapped", "miRNA_region": "mirna_region",
}
# Cells that mean "no value".
NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
MIRNA = {k: v for k, v in ISOFORM.items() if k not in ("isoform_coords", "miRNA_region")}


def read_files(spark: SparkSession, path: str, manifest: DataFrame, columns: list[str], *, under: str | None = None, **read) -> DataFrame:
    """Text cells of the manifest's files; see :func:`cohortloom.sources.splits.read_delimited`."""
    where = path if under is None else manifest.select(F.concat(F.lit(f"{path.rstrip('/')}/{under}"), "file_name").alias("path"))
    return read_delimited(spark, where, columns, nulls=NA, **read)


def own_values(spark: SparkSession, path: str, manifest: DataFrame, column: str, **read) -> DataFrame:
    """(file_name, column) of the values that each file's rows have in ``column``: a look at one column, for which no row leaves its task."""
    return read_files(spark, path, manifest, [column], distinct=True, **read)


def aliquot_entities(manifest: DataFrame) -> DataFrame:
    """Manifest with ``aliquots``: its entities of type aliquot that have an id."""
    return manifest.withColumn("aliquots", F.filter("entities", lambda e: (e["entity_type"] == "aliquot") & e["entity_id"].isNotNull()))


def only_value(rows: DataFrame, file: str, column: str) -> DataFrame:
    """(file, value) of the files in which ``column`` has exactly one value, nulls aside."""
    seen = rows.filter(F.col(column).isNotNull()).select(F.col(file).alias("__file"), F.col(column).alias("value")).distinct()
    one = F.count(F.lit(1))
    return seen.groupBy("__file").agg(one.alias("n"), F.any_value("value").alias("value")).filter("n = 1").drop("n")


def _others(tumor: Column) -> Column:
    """The one other aliquot of the file, if there is exactly one."""
    rest = F.filter("aliquots", lambda e: e["entity_id"] != tumor)
    return F.when(F.size(rest) == 1, F.get(rest, F.lit(0)))


def with_normal(files: DataFrame) -> DataFrame:
    """Files with ``tumor`` get the matched normal's id and submitter id."""
    other = files.withColumn("__n", _others(F.col("tumor")))
    return other.withColumns({NORMAL[0]: F.col("__n.entity_id"), NORMAL[1]: F.col("__n.entity_submitter_id")}).drop("__n")


def tumor_by_id(manifest: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The aliquot id that the file's own rows report."""
    own = only_value(rows, "file_name", column)
    return aliquot_entities(manifest).join(own.hint("shuffle_hash"), F.col("file_name") == F.col("__file")).withColumnRenamed("value", "tumor").drop("__file")


def tumor_by_barcode(manifest: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The aliquot whose submitter id the file's own rows report; a name that no entity has is no answer."""
    own = only_value(rows, "file_name", column)
    j = aliquot_entities(manifest).join(own.hint("shuffle_hash"), F.col("file_name") == F.col("__file"))
    named = F.get(F.filter("aliquots", lambda e: e["entity_submitter_id"] == F.col("value")), F.lit(0))
    return j.withColumn("tumor", named["entity_id"]).filter(F.col("tumor").isNotNull()).drop("__file", "value")


def tumor_by_only_entity(manifest: DataFrame) -> DataFrame:
    """Files that name one aliquot."""
    m = aliquot_entities(manifest).filter(F.size("aliquots") == 1)
    return m.withColumn("tumor", F.get("aliquots", F.lit(0))["entity_id"])


def _pair(aliquots: str = "aliquots") -> Column:
    return F.array_sort(F.transform(aliquots, lambda e: e["entity_id"]))


def tumor_by_pair(manifest: DataFrame, resolved: DataFrame) -> DataFrame:
    """Files of one aliquot by that one; paired files by a file in ``resolved`` of the same workflow and pair.

    Where several such files disagree, the last by name is followed.
    """
    m = aliquot_entities(manifest)
    single = m.filter(F.size("aliquots") == 1).withColumn("tumor", F.get("aliquots", F.lit(0))["entity_id"])
    both = resolved.filter((F.size("aliquots") == 2) & F.array_contains(_pair(), F.col("tumor")))
    known = both.groupBy(F.coalesce("workflow_type", F.lit("")).alias("__w"), _pair().alias("__p")).agg(F.max_by("tumor", "file_name").alias("tumor"))
    paired = m.filter(F.size("aliquots") > 1).withColumns({"__mw": F.coalesce("workflow_type", F.lit("")), "__mp": _pair()})
    paired = paired.join(known.hint("shuffle_hash"), (F.col("__mw") == F.col("__w")) & (F.col("__mp") == F.col("__p"))).drop("__w", "__p", "__mw", "__mp")
    return single.unionByName(paired)


def with_keys(files: DataFrame, aliquots: DataFrame, tumor: str = "tumor") -> DataFrame:
    """Files of known cases with the seven key columns; sample columns are null where the case's tree lacks the aliquot."""
    cases = aliquots.select(F.col("case_id").alias("__case"), "case_submitter_id").distinct()
    known = files.join(cases, F.col("case_id") == F.col("__case")).drop("__case")
    tree = aliquots.filter(F.col("aliquot_id").isNotNull()).select(
        F.col("case_id").alias("__c"), F.col("aliquot_id").alias("__a"), "sample_id", "sample_submitter_id", "sample_type", "aliquot_submitter_id"
    )
    j = known.join(tree.hint("shuffle_hash"), (F.col("case_id") == F.col("__c")) & (F.col(tumor) == F.col("__a")), "left").drop("__c", "__a")
    return j.withColumn("aliquot_id", F.col(tumor)).withColumnRenamed("file_id", "source_file_id")


def measured(rows: DataFrame, files: DataFrame, columns: list[str]) -> DataFrame:
    """Measurements with their file's columns; rows of unresolved files go.

    Rows meet their files in a shuffle. Left to itself Spark would send the measurements to every
    task through the driver, for it sees only how few file names they come from.
    """
    f = files.select(F.col("file_name").alias("__file"), *columns, "source_file_id")
    values = [c for c in rows.columns if c not in ("file_name", "at")]
    return rows.join(f.hint("shuffle_hash"), F.col("file_name") == F.col("__file")).select(*columns, "source_file_id", *values)


def allele_segments(spark: SparkSession, path: str, manifest: DataFrame, aliquots: DataFrame, **read) -> DataFrame:
    """Allele-specific segments of paired files; the tumor is the aliquot the rows name, the other is the normal."""
    return _allele(spark, path, manifest, aliquots, **read)[0]


def _allele(spark, path, manifest, aliquots, **read):
    rows = read_files(spark, path, manifest, [*SEGMENT, *COPIES], rename={**SEGMENT, **COPIES}, **read)
    files = tumor_by_id(manifest, own_values(spark, path, manifest, "GDC_Aliquot", **read), "GDC_Aliquot")
    keyed = with_keys(with_normal(files), aliquots)
    out = coerce(rows, ["start", "end", *COPIES.values()])
    return measured(out, keyed, [*KEYS, *NORMAL, "workflow_type", "experimental_strategy"]), files


def masked_segments(spark: SparkSession, path: str, manifest: DataFrame, aliquots: DataFrame, **read) -> DataFrame:
    """Masked segments of single-aliquot files; chromosomes as written."""
    rows = read_files(spark, path, manifest, [*SEGMENT, *MEASURED], rename={**SEGMENT, **MEASURED}, **read)
    keyed = with_keys(tumor_by_id(manifest, own_values(spark, path, manifest, "GDC_Aliquot", **read), "GDC_Aliquot"), aliquots)
    return measured(coerce(rows, ["start", "end", "num_probes"], ["segment_mean"]), keyed, [*KEYS, "workflow_type"])


def unmasked_segments(spark: SparkSession, single: str, paired: str, manifest: DataFrame, aliquots: DataFrame, **read) -> DataFrame:
    """Unmasked segments of two workflows with different headers: by aliquot id without a normal, by barcode with one."""
    fields = [*KEYS, *NORMAL, "workflow_type", "experimental_strategy"]
    parts = []
    for path, column, settle in ((single, "GDC_Aliquot", tumor_by_id), (paired, "GDC_Aliquot_ID", tumor_by_barcode)):
        rows = read_files(spark, path, manifest, [*SEGMENT, *MEASURED], rename={**SEGMENT, **MEASURED}, **read)
        files = settle(manifest, own_values(spark, path, manifest, column, **read), column)
        if settle is tumor_by_barcode:
            files = with_normal(files)
        else:
            files = files.withColumns({c: F.lit(None).cast("string") for c in NORMAL})
        out = coerce(rows, ["start", "end", "num_probes"], ["segment_mean"])
        parts.append(measured(out, with_keys(files, aliquots), fields))
    return union_pad(parts)


def gene_level(spark: SparkSession, path: str, manifest: DataFrame, aliquots: DataFrame, allele: str, **read) -> DataFrame:
    """Copy number by gene: three value columns, gene annotation left out; tumors of paired files by their segment file."""
    segments = own_values(spark, allele, manifest, "GDC_Aliquot", **read)
    files = with_normal(tumor_by_pair(manifest, tumor_by_id(manifest, segments, "GDC_Aliquot")))
    rows = read_files(spark, path, manifest, ["gene_id", *GENE_LEVEL_VALUES], **read)
    return measured(coerce(rows, GENE_LEVEL_VALUES), with_keys(files, aliquots), [*KEYS, *NORMAL, "workflow_type", "experimental_strategy"])


def methylation(spark: SparkSession, path: str, manifest: DataFrame, aliquots: DataFrame, **read) -> DataFrame:
    """Beta values of headerless two-column files; masked probes are null."""
    rows = read_files(spark, path, manifest, ["probe_id", "beta_value"], header=["probe_id", "beta_value"], **read)
    return measured(coerce(rows, floats=["beta_value"]), with_keys(tumor_by_only_entity(manifest), aliquots), [*KEYS, "platform"])


def expression(spark: SparkSession, path: str, manifest: DataFrame, aliquots: DataFrame, **read) -> DataFrame:
    """Expression by gene: six value columns, the ``N_`` summary rows left out, gene annotation not repeated."""
    rows = read_files(spark, path, manifest, ["gene_id", *EXPRESSION_VALUES], **read)
    rows = rows.filter(~F.coalesce(F.col("gene_id").startswith("N_"), F.lit(False)))
    out = coerce(rows, EXPRESSION_VALUES[:3], EXPRESSION_VALUES[3:])
    return measured(out, with_keys(tumor_by_only_entity(manifest), aliquots), ["case_id", "case_submitter_id", "aliquot_id", "aliquot_submitter_id"])


def isoforms(spark: SparkSession, path: str, manifest: DataFrame, aliquots: DataFrame, **read) -> DataFrame:
    """miRNA isoforms with their coordinates and region."""
    rows = read_files(spark, path, manifest, list(ISOFORM), rename=ISOFORM, **read)
    out = coerce(rows, ["read_count"], ["reads_per_million_mirna_mapped"])
    return measured(out, with_keys(tumor_by_only_entity(manifest), aliquots), KEYS)


def mirnas(spark: SparkSession, path: str, manifest: DataFrame, aliquots: DataFrame, **read) -> DataFrame:
    """Mature miRNAs."""
    rows = read_files(spark, path, manifest, list(MIRNA), rename=MIRNA, **read)
    out = coerce(rows, ["read_count"], ["reads_per_million_mirna_mapped"])
    return measured(out, with_keys(tumor_by_only_entity(manifest), aliquots), KEYS)


def gene_model(spark: SparkSession, expression_file: str, gene_level_file: str, **read) -> DataFrame:
    """Names and types of one expression file, coordinates of one gene-level file; a gene of either keeps the half it has."""
    named = read_delimited(spark, expression_file, ["gene_id", "gene_name", "gene_type"], nulls=NA, **read).drop("file_name", "at")
    named = named.filter(~F.coalesce(F.col("gene_id").startswith("N_"), F.lit(False)))
    placed = read_delimited(spark, gene_level_file, ["gene_id", "gene_name", *SEGMENT.values()], nulls=NA, **read).drop("file_name", "at")
    placed = coerce(placed, ["start", "end"]).withColumnsRenamed({"gene_id": "__id", "gene_name": "__name"})
    j = named.join(placed, F.col("gene_id") == F.col("__id"), "full")
    name = F.when(F.col("gene_id").isNotNull(), F.col("gene_name")).otherwise(F.col("__name"))
    return j.select(F.coalesce("gene_id", "__id").alias("gene_id"), name.alias("gene_name"), "gene_type", *SEGMENT.values())
