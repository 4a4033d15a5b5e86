"""Genomic interval lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bare_chromosome(c: Column) -> Column:
    """``chr7`` and ``7`` name the same chromosome."""
    return F.regexp_replace(c, "^chr", "")


def segments_at(
    positions: DataFrame, segments: DataFrame, by: Sequence[str], chromosome: str, position: str,
    start: str = "start", end: str = "end", bin_width: int = 1_000_000,
) -> DataFrame:
    """Segments with ``start <= position <= end`` on the same chromosome.

    Segments are repeated per bin they touch, so the range condition becomes an
    equi-join on (keys, chromosome, bin) with a residual filter; a position falls
    in one bin, hence no pair is found twice.
    """
    bin_of = lambda c: F.floor(F.col(c) / bin_width)
    seg = segments.select(
        *[F.col(k).alias("__s_" + k) for k in by],
        bare_chromosome(F.col(chromosome)).alias("__chrom"),
        *[F.col(c) for c in segments.columns if c not in by and c != chromosome],
        F.explode(F.sequence(bin_of(start), bin_of(end))).alias("__sbin"),
    )
    pos = positions.withColumns(
        {"__c": bare_chromosome(F.col(chromosome)), "__bin": bin_of(position)}
    )
    cond = (F.col("__c") == F.col("__chrom")) & (F.col("__bin") == F.col("__sbin"))
    for k in by:
        cond = cond & (F.col(k) == F.col("__s_" + k))
    hit = pos.join(seg, cond & F.col(position).between(F.col(start), F.col(end)))
    return hit.drop("__c", "__bin", "__chrom", "__sbin", *["__s_" + k for k in by])


def loh(segments: DataFrame, minor: str, major: str) -> DataFrame:
    """Segments that lost one allele while keeping the other."""
    return segments.filter((F.col(minor) == 0) & (F.col(major) > 0))
