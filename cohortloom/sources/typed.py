"""Lossless typing of text tables: study bundles and curated sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.sources.text import cell

# Fixed keys of the four metadata lines, tables that stay text.
HEADER_KEYS = ("display_name", "description", "datatype", "priority")
TEXT_ONLY = ("cna",)


def is_int(v: Column) -> Column:
    """Text that prints back to itself as a 64-bit integer."""
    return v.rlike(r"^-?(0|[1-9][0-9]*)$") & (v != "-0") & v.try_cast("bigint").isNotNull()


def is_exact_float(v: Column) -> Column:
    """Text whose every digit a float64 keeps; no leading zeros, no bare dot.

    Up to 15 significant digits always survive. 16 or 17 survive only if the
    float prints the same digits; more never do.
    """
    shaped = v.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]*)?([eE][-+]?[0-9]+)?$")

    def digits(text: Column) -> Column:
        mantissa = F.regexp_replace(F.regexp_replace(text, "[eE].*$", ""), "-", "")
        has_dot = mantissa.contains(".")
        plain = F.when(has_dot, F.regexp_replace(mantissa, r"0*$", "")).otherwise(mantissa)
        bare = F.regexp_replace(F.regexp_replace(plain, r"\.", ""), "^0+", "")
        return F.regexp_replace(bare, "0+$", "")

    number = v.try_cast("double")
    finite = F.abs(number) < float("inf")
    alive = (number != 0) | (digits(v) == "")
    n = F.length(digits(v))
    # Below the smallest normal number, fewer digits survive.
    normal = (F.abs(number) >= 2.3e-308) | (digits(v) == "")
    return shaped & finite & alive & (((n <= 15) & normal) | ((n <= 17) & (digits(number.cast("string")) == digits(v))))


def column_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Type per text column from one aggregate row: ``bigint``, ``double`` or ``string``."""
    aggs = []
    for i, name in enumerate(columns):
        v = F.col(f"`{name}`")
        full = v.isNotNull() & (v != "")
        aggs += [
            F.count_if(full).alias(f"n{i}"),
            F.count_if(full & ~F.coalesce(is_int(v), F.lit(False))).alias(f"i{i}"),
            F.count_if(full & ~F.coalesce(is_exact_float(v), F.lit(False))).alias(f"f{i}"),
        ]
    row = df.agg(*aggs).first()
    out = {}
    for i, name in enumerate(columns):
        n, bad_int, bad_float = row[f"n{i}"], row[f"i{i}"], row[f"f{i}"]
        out[name] = "bigint" if n and not bad_int else "double" if n and not bad_float else "string"
    return out


def read_study_table(
    lines: DataFrame, config: str, order: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """A study file from its lines: typed columns with field metadata.

    Zero or four ``#`` lines come first; ragged rows and repeated names are refused;
    declared STRING and BOOLEAN stay text, declared NUMBER must be numeric.
    """
    first = lines.orderBy(*order).select("line", F.struct(*order).alias("at")).limit(len(HEADER_KEYS) + 2).collect()
    top = [r["line"] for r in first]
    n_meta = next((i for i, x in enumerate(top) if not x.startswith("#")), len(top))
    if n_meta not in (0, len(HEADER_KEYS)):
        raise ValueError(f"{config}: {n_meta} '#' header lines; expected 0 or 4")
    meta = [x[1:].split("\t") for x in top[:n_meta]]
    head = top[n_meta]
    header = head.split("\t")
    if len(set(header)) != len(header):
        raise ValueError(f"{config}: duplicate column names")
    if any(len(m) != len(header) for m in meta):
        raise ValueError(f"{config}: header lines of unequal width")
    cells = F.split("line", "\t", -1)
    # Rows are what comes after the header, whatever they look like.
    kinds = dict(lines.dtypes)
    at = F.struct(*[F.lit(first[n_meta]["at"][c]).cast(kinds[c]).alias(c) for c in order])
    body = lines.filter(F.struct(*order) > at)
    ragged = body.filter(F.size(cells) != len(header))
    if not ragged.isEmpty():
        raise ValueError(f"{config}: rows with a number of cells other than {len(header)}")
    text = body.select(*keep, *[cell(cells, i).alias(n) for i, n in enumerate(header)])
    declared = dict(zip(header, meta[HEADER_KEYS.index("datatype")])) if meta else {}
    unknown = set(declared.values()) - {"STRING", "BOOLEAN", "NUMBER"}
    if unknown:
        raise ValueError(f"{config}: unknown declared datatypes {sorted(unknown)}")
    if meta:
        inferred = [n for n in header if declared[n] == "NUMBER"]
    else:
        inferred = [] if config in TEXT_ONLY else header
    types = column_types(text, inferred) if inferred else {}
    for n in inferred:
        if meta and types[n] == "string":
            raise ValueError(f"{config}.{n}: declared NUMBER but holds non-numbers")
    out = []
    for i, n in enumerate(header):
        info = {k: m[i] for k, m in zip(HEADER_KEYS, meta)} if meta else {}
        out.append(F.col(f"`{n}`").cast(types.get(n, "string")).alias(n, metadata=info))
    return text.select(*keep, *out)


def dictionary(df: DataFrame) -> list[tuple]:
    """(column, type, the four metadata values) per field."""
    return [
        (f.name, f.dataType.simpleString(), *[f.metadata.get(k) for k in HEADER_KEYS]) for f in df.schema.fields
    ]


def typed_sheet(df: DataFrame, row_no: str, missing: str = "#N/A", order_checked: bool = True) -> DataFrame:
    """A curated sheet: the row-number column must be 1..n and is dropped, error cells
    become null, all-integer columns become int, mixed columns are refused."""
    columns = [c for c in df.columns if c != row_no]
    v = lambda c: F.when(F.col(f"`{c}`") != missing, F.col(f"`{c}`"))
    aggs = [F.count(F.lit(1)).alias("n"), F.countDistinct(row_no).alias("d"), F.min(F.col(row_no).try_cast("bigint")).alias("lo"), F.max(F.col(row_no).try_cast("bigint")).alias("hi")]
    for i, c in enumerate(columns):
        aggs += [F.count(v(c)).alias(f"n{i}"), F.count_if(is_int(v(c))).alias(f"i{i}"), F.count_if(v(c).startswith("#")).alias(f"e{i}")]
    row = df.agg(*aggs).first()
    if order_checked and row["n"] and (row["d"], row["lo"], row["hi"]) != (row["n"], 1, row["n"]):
        raise ValueError("first column is not the row number 1..n")
    out = []
    for i, c in enumerate(columns):
        if row[f"e{i}"]:
            raise ValueError(f"{c}: unexpected error cells")
        whole = row[f"n{i}"] and row[f"i{i}"] == row[f"n{i}"]
        if row[f"i{i}"] and not whole:
            raise ValueError(f"{c}: mixed cell types")
        out.append((v(c).cast("int") if whole else v(c)).alias(c))
    return df.select(*out)


# Curated endpoint columns.
ENDPOINTS = ("OS", "DSS", "DFI", "PFI")


def curated_scan(df: DataFrame, key: str, extra: Sequence[str] = ()) -> DataFrame:
    """Endpoint columns as ``cdr_X`` (int) and ``cdr_X_time`` (double); NaN and ``#N/A``
    become null, a row without key is skipped."""
    def clean(c: str, t: str) -> Column:
        n = F.col(f"`{c}`").try_cast("double")
        return F.when(~F.isnan(n), n).cast(t)

    out = [F.col(key)]
    for e in ENDPOINTS:
        out += [clean(e, "int").alias(f"cdr_{e}"), clean(f"{e}.time", "double").alias(f"cdr_{e}_time")]
    return df.filter(F.col(key).isNotNull() & (F.col(key) != "")).select(*out, *[F.col(c).alias(f"cdr_{c.lower()}") for c in extra])


def schema_differences(actual: T.StructType, declared: T.StructType, path: str = "") -> list[str]:
    """Unknown, missing and differently typed fields, at every nesting level."""
    out: list[str] = []
    have, want = {f.name: f.dataType for f in actual.fields}, {f.name: f.dataType for f in declared.fields}
    out += [f"unknown {path}{n}" for n in have if n not in want]
    out += [f"missing {path}{n}" for n in want if n not in have]
    for n in have.keys() & want.keys():
        a, b = have[n], want[n]
        while isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
            a, b = a.elementType, b.elementType
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            out += schema_differences(a, b, f"{path}{n}.")
        elif a != b:
            out.append(f"type {path}{n}: {a.simpleString()} is not {b.simpleString()}")
    return sorted(out)
