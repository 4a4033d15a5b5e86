"""Document fingerprints by one-permutation MinHash with optimal densification.

A text's five-word shingles are hashed once each. The high bits of a hash choose one of
``K`` bins, the rest is its value; a bin keeps its smallest value. An empty bin copies the
bin that a hash of (bin, attempt) names, attempts going on until that bin is not empty, so
two sets with equal bins copy alike. Of each bin the ``B`` lowest bits are stored, packed.

Likeness counts equal bins and takes away the 2^-B of them that are equal by chance:
(p - 2^-B) / (1 - 2^-B), not below 0.

A text without words has an empty fingerprint: like another empty one (1.0), unlike the
rest (0.0). Null texts are empty. With fewer than five words the whole text is one shingle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import ALNUM, U, Words, blocks, mix, shingles, text_bytes
from cohortloom.llm.registry import query, table

K, B, SHINGLE = 512, 4, 5
_SHIFT = U(64 - (K - 1).bit_length())
_EMPTY = U(0xFFFFFFFFFFFFFFFF)
#: Texts of one block are held as Python strings; a longer text is a block of its own.
BLOCK_CHARS = 1_000_000


def signatures(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(documents x K) low-order bits, and which documents have any word."""
    n = len(words.count)
    doc, h = shingles(words, SHINGLE)
    bins = np.full(n * K, _EMPTY, U)
    np.minimum.at(bins, doc * K + (h >> _SHIFT).astype(np.int64), h & ((U(1) << _SHIFT) - U(1)))
    bins = bins.reshape(n, K)
    some = words.count > 0
    full = bins != _EMPTY
    d, b = np.nonzero(~full & some[:, None])
    attempt = 0
    while len(d):
        source = (mix(b.astype(U) * U(0x9E3779B97F4A7C15) + np.array([attempt], U) * U(0xD1B54A32D192ED03)) >> _SHIFT).astype(np.int64)
        ok = full[d, source]
        bins[d[ok], b[ok]] = bins[d[ok], source[ok]]
        d, b, attempt = d[~ok], b[~ok], attempt + 1
    return (mix(bins) & U((1 << B) - 1)).astype(np.uint8), some


def pack(low: np.ndarray) -> np.ndarray:
    """Two 4-bit values to a byte."""
    return low[:, 0::2] << 4 | low[:, 1::2]


def unpack(fingerprints: list[bytes]) -> np.ndarray:
    packed = np.frombuffer(b"".join(fingerprints), np.uint8).reshape(len(fingerprints), K // 2)
    low = np.empty((len(fingerprints), K), np.uint8)
    low[:, 0::2], low[:, 1::2] = packed >> 4, packed & 15
    return low


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Estimated Jaccard similarity of paired rows of two :func:`signatures`."""
    chance = 2.0**-B
    same = np.clip(((a[0] == b[0]).mean(axis=1) - chance) / (1 - chance), 0, 1)
    return np.where(a[1] & b[1], same, (a[1] == b[1]).astype(float))


def of_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    low, some = [], []
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    for lo, hi in blocks(offsets):
        x, y = signatures(Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ALNUM))
        low.append(x)
        some.append(y)
    return (np.concatenate(low), np.concatenate(some)) if low else (np.zeros((0, K), np.uint8), np.zeros(0, bool))


def encode(sign: tuple[np.ndarray, np.ndarray]) -> list[str]:
    return [base64.b64encode(p.tobytes()).decode() if s else "" for p, s in zip(pack(sign[0]), sign[1], strict=True)]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and fingerprint (base64 of the packed bits; empty without words). A map, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = encode(of_texts([t or "" for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(out, pa.string())], [id_col, "fingerprint"])

    picked = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fingerprint string")


def in_order(docs: DataFrame, id_col: str, text_col: str, rows_per_run: int = 2000) -> DataFrame:
    """``run, doc_id, text, lead`` such that each run of descending ids lies sorted in one partition and
    is followed by the first row of the run after it (``lead`` true); after the last run comes the first.

    Cut points are quantiles of the ids; a run's first row is sent to the run before it too.
    Texts are shuffled once. Null ids come last; equal ids are ordered by text.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id"))
    total = ids.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_runs = max(1, min(total // rows_per_run, parts * 8))
    cuts = sorted(set(ids.approxQuantile("doc_id", [i / n_runs for i in range(1, n_runs)], 0.1 / n_runs))) if n_runs > 1 and total else []
    # Runs are numbered in descending order of ids; null ids form the last run.
    edges, last = np.array(cuts, np.float64), len(cuts)

    @F.pandas_udf("int")
    def run_of(one: pd.Series) -> pd.Series:
        at = last - np.searchsorted(edges, one.to_numpy(np.float64, na_value=np.inf), "right")
        return pd.Series(np.where(one.isna(), last + 1, at).astype(np.int32))

    # One head for each run, so as many as there are cut points.
    heads = ids.groupBy(run_of("doc_id").alias("run")).agg(F.max("doc_id").alias("doc_id")).orderBy("run").collect()
    before = {h["doc_id"]: heads[k - 1]["run"] for k, h in enumerate(heads)}

    @F.pandas_udf("int")
    def run_before(one: pd.Series) -> pd.Series:
        return pd.Series([before.get(None if pd.isna(i) else int(i), -1) for i in one.astype("object")], dtype="int32")

    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = own.select("doc_id", "text", run_of("doc_id").alias("run"), run_before("doc_id").alias("before"))
    both = F.array(F.struct("run", F.lit(False).alias("lead")), F.struct(F.col("before").alias("run"), F.lit(True).alias("lead")))
    dealt = placed.select("doc_id", "text", F.inline(F.filter(both, lambda s: s["run"] >= 0)))
    return dealt.repartition(parts, "run").sortWithinPartitions("run", "lead", F.col("doc_id").desc_nulls_last(), "text")


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def flush(follow) -> pa.RecordBatch:
        texts = [t for _, t in held]
        nexts = [*texts[1:], follow]
        edited = []
        for t, x in zip(texts, nexts, strict=True):
            n = len(t) // 3
            edited.append(t[: len(t) - n] + x[:n])
        sign = of_texts([*texts, follow])
        own = sign[0][:-1], sign[1][:-1]
        new = of_texts(edited)
        after = sign[0][1:], sign[1][1:]
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in held], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(encode(own)), pa.array(encode(new)),
            pa.array(likeness(own, new)), pa.array(likeness(own, after)),
        ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    run, closed = None, False
    for batch in batches:
        for r, lead, i, t in zip(*(batch.column(c).to_pylist() for c in ("run", "lead", "doc_id", "text")), strict=True):
            if r != run:
                run, closed = r, False
            if lead:
                if not closed and held:
                    yield flush(t)
                    held, size = [], 0
                closed = True
                continue
            if size > BLOCK_CHARS:
                yield flush(t)
                held, size = [], 0
            held.append((i, t))
            size += len(t)


def compared(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (its last third replaced by as much of the beginning
    of the next document, in descending order of ids), with their likeness and that to the next document."""
    ddl = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs, id_col, text_col).mapInArrow(_pair_up, ddl)


def same_or_like(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns."""

    @F.pandas_udf("double")
    def like(x, y):
        out = np.where((x == "") & (y == ""), 1.0, 0.0)
        rows = np.flatnonzero((x != "") & (y != "") & x.notna() & y.notna())
        if len(rows):
            yes = np.ones(len(rows), bool)
            p, q = (unpack([base64.b64decode(v) for v in s.iloc[rows]]) for s in (x, y))
            out[rows] = likeness((p, yes), (q, yes))
        return pd.Series(out)

    return like(a, b)


@query("op3_fingerprint")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))
