"""Per-file text tables: delimited, headerless, summary-row and multi-header layouts.

All parsers work on a DataFrame of lines, so a file splits across tasks, and keep
the caller's key columns (path, line number, order key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Summary rows on top of a counts table.
SUMMARY_ROWS = ("N_unmapped", "N_multimapping", "N_noFeature", "N_ambiguous")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file name and an order key (``block``, ``seq``) inside the file.

    Lines of one split are read in order and splits are ordered by their start.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )


def cell(cells: Column, i: int, nulls: Sequence[str] = ("",)) -> Column:
    value = F.get(cells, F.lit(i))
    return F.when(~value.isin(*nulls), value)


def delimited(
    lines: DataFrame,
    header: Sequence[str],
    keep: Sequence[str] = (),
    nulls: Sequence[str] = ("",),
    rename: dict[str, str] | None = None,
    columns: Sequence[str] | None = None,
    sep: str = "\t",
) -> DataFrame:
    """Text columns of lines that all are rows of a table with these columns, in this order.

    Only ``nulls`` tokens become null. ``columns`` prunes, ``rename`` maps header names to
    output names. Files with a header of their own are for
    :func:`cohortloom.sources.splits.read_delimited`.
    """
    cells = F.split("line", sep, -1)
    rename = rename or {}
    wanted = list(columns or header)
    return lines.select(*keep, *[cell(cells, list(header).index(n), nulls).alias(rename.get(n, n)) for n in wanted])


def to_int(c: Column) -> Column:
    """``1`` and ``1.0`` are 1; anything else is null."""
    return c.try_cast("double").try_cast("bigint")


def to_float(c: Column) -> Column:
    return c.try_cast("double")


def coerce(df: DataFrame, ints: Sequence[str] = (), floats: Sequence[str] = ()) -> DataFrame:
    """Text columns to numbers; unreadable cells become null."""
    return df.withColumns(
        {**{n: to_int(F.col(n)) for n in ints}, **{n: to_float(F.col(n)) for n in floats}}
    )


def gene_rows(df: DataFrame, gene: str = "gene_id") -> DataFrame:
    return df.filter(~F.col(gene).startswith("N_"))


def summary_rows(df: DataFrame, by: Sequence[str], value: str, gene: str = "gene_id") -> DataFrame:
    """The four summary rows as columns; a missing row is null, not 0."""
    return (
        df.filter(F.col(gene).isin(*SUMMARY_ROWS))
        .groupBy(*by)
        .agg(*[F.max(F.when(F.col(gene) == n, F.col(value))).alias(n) for n in SUMMARY_ROWS])
    )


def read_forms(spark: SparkSession, path: str) -> DataFrame:
    """Multi-header forms of a folder, one row per cell (see :func:`multi_header`)."""
    files = spark.read.format("binaryFile").load(path)
    return multi_header(files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "content"), "file_name")


# A cell is quoted if a quote stands at its beginning; within, quotes are doubled, and tabs and
# line ends are text. A quote that is never closed goes to the end of the file.
_QUOTED = r'"[^"]*(?:""[^"]*)*(?:"[^\t\n]*|\z)'
_CELL = rf"(?:{_QUOTED}|[^\t\n]*)"
_LINE = rf"({_CELL}(?:\t{_CELL})*)(?:\n|\z)"


def _unquoted(value: Column) -> Column:
    inner = F.regexp_extract(value, r'(?s)\A"([^"]*(?:""[^"]*)*)"?(.*)\z', 1)
    rest = F.regexp_extract(value, r'(?s)\A"([^"]*(?:""[^"]*)*)"?(.*)\z', 2)
    return F.when(value.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)).otherwise(value)


def multi_header(files: DataFrame, name: str, content: str = "content", charset: str = "ISO-8859-1") -> DataFrame:
    """Cells of forms with three header lines: ``(file, row, column, value)``.

    Short rows are padded with empty text, cells beyond the header dropped, blank
    rows skipped; a file under four lines has no rows.
    """
    text = F.regexp_replace(F.decode(F.col(content), charset), "\r\n?", "\n")
    found = F.regexp_extract_all(F.regexp_replace(text, "\n\\z", ""), F.lit(_LINE), F.lit(1))
    # After the last line the pattern matches once more, at the very end.
    lines = files.select(name, found.alias("__all")).select(name, F.slice("__all", F.lit(1), F.size("__all") - 1).alias("__lines"))
    cells = lambda line: F.transform(F.regexp_extract_all(line, F.lit(rf"(?:\A|\t)({_CELL})"), F.lit(1)), _unquoted)
    rows = lines.filter(F.size("__lines") >= 4).select(
        name, cells(F.get("__lines", F.lit(0))).alias("__h"), F.posexplode("__lines").alias("__no", "__line")
    )
    body = rows.filter((F.col("__no") >= 3) & (F.regexp_replace("__line", "\t", "") != ""))
    split = body.select(name, (F.col("__no") - 3).alias("row"), "__h", cells(F.col("__line")).alias("__cells"))
    return split.select(name, "row", "__cells", F.posexplode("__h").alias("__pos", "column")).select(
        name, "row", "column", F.coalesce(F.get("__cells", F.col("__pos")), F.lit("")).alias("value")
    )


def gene_sets(lines: DataFrame, order: Sequence[str], pathway: str = "pathway", gene: str = "gene") -> DataFrame:
    """Set members, one per row: name, link, then members. A set needs more than two
    fields, the last line of a repeated name wins, empty members are dropped."""
    fields = F.split("line", "\t")
    parsed = lines.filter(F.size(fields) > 2).select(F.get(fields, F.lit(0)).alias(pathway), *order, "line")
    last = parsed.groupBy(pathway).agg(F.max_by("line", F.struct(*order)).alias("line"))
    return last.select(pathway, F.explode(F.slice(F.split("line", "\t", -1), F.lit(3), F.size(F.split("line", "\t", -1)))).alias(gene)).filter(F.col(gene) != "")


def binary_documents(files: DataFrame, manifest: DataFrame, name: str) -> DataFrame:
    """Binary files with their manifest record: bytes, size and checksum of the bytes."""
    m = manifest.withColumnRenamed(name, "__m")
    j = files.join(m, F.col(name) == F.col("__m")).drop("__m")
    return j.withColumns({"n_bytes": F.octet_length("content").cast("bigint"), "md5_bytes": F.md5("content")})
