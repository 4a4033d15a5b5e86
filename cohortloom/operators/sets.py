"""Set differences, unions, digests, samples, form slices."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import nest, ranked


def set_diff(want: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, labelled ``missing`` or ``unexpected``."""
    w = want.select(key).distinct()
    h = have.select(key).distinct()
    missing = w.join(h, key, "left_anti").select(F.lit("missing").alias("side"), key)
    return missing.unionByName(h.join(w, key, "left_anti").select(F.lit("unexpected").alias("side"), key))


def union_pad(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; a column one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def source_digest(df: DataFrame, by: Sequence[str], key: str, value: str) -> DataFrame:
    """sha256 over the sorted ``key<TAB>value<NEWLINE>`` lines of each group, and their number.

    A digest of a sorted listing is one chain, so a group's lines pass through one task;
    they are sorted with spilling and hashed as they stream by, in constant memory.
    """
    line = F.concat(F.col(key).cast("string"), F.lit("\t"), F.col(value).cast("string"), F.lit("\n"))
    group = F.struct(*by)
    rows = df.select(*by, line.alias("__line")).filter(F.col("__line").isNotNull())
    rows = rows.select(F.to_json(group, {"ignoreNullFields": "false"}).alias("__g"), "__line")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, digest = None, 0, hashlib.sha256()
        out: list[tuple[str, int, str]] = []
        for batch in batches:
            for g, text in zip(batch.column("__g").to_pylist(), batch.column("__line").to_pylist(), strict=True):
                if g != now:
                    if n:
                        out.append((now, n, digest.hexdigest()))
                    now, n, digest = g, 0, hashlib.sha256()
                digest.update(text.encode())
                n += 1
        if n:
            out.append((now, n, digest.hexdigest()))
        yield pa.RecordBatch.from_pylist([dict(zip(("__g", "n", "digest"), r, strict=True)) for r in out], _DIGEST)

    ordered = rows.repartition("__g").sortWithinPartitions("__g", "__line")
    found = ordered.mapInArrow(hashed, "__g string, n bigint, digest string")
    kinds = ", ".join(f"`{c}` {dict(df.dtypes)[c]}" for c in by)
    return found.select(F.from_json("__g", kinds).alias("__k"), "n", "digest").select("__k.*", "n", "digest")


_DIGEST = pa.schema([("__g", pa.string()), ("n", pa.int64()), ("digest", pa.string())])


def sample_per_group(df: DataFrame, groups: Sequence[str], key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows per group, chosen by a seeded hash of the key."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary"), 256)
    return ranked(df, list(groups), [digest, F.col(key)], "__rn").filter(F.col("__rn") <= n).drop("__rn")


def form_slices(
    lines: DataFrame, key: str, order: Sequence[Column], line: str, header: Sequence[str]
) -> DataFrame:
    """Each case's lines of a form, under the form's own header lines."""
    n = nest(lines, [key], order, [line], "__l")
    body = F.transform("__l", lambda x: x[line])
    text = F.array_join(F.concat(F.array(*[F.lit(h) for h in header]), body), "\n")
    return n.select(key, text.alias("content"), F.size("__l").cast("bigint").alias("n_lines"))
