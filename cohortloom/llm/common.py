"""What several operators share: byte-level word scanning in numpy and cuts of the lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from cohortloom.session import shared_dir

U = np.uint64
#: Documents are scanned in blocks of about this many bytes (a longer document is a block of its own).
BLOCK_BYTES = 2_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _freed_shuffles(spark: SparkSession):
    """Within, a finished write deletes the shuffle files behind it."""
    before = spark.conf.get(CLEANUP, None)
    try:
        spark.conf.set(CLEANUP, "true")
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends, lost executors cost nothing."""
    spark = df.sparkSession
    path = shared_dir(spark, tag)
    with _freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _byte_set(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case; every byte of a non-ASCII character is in.
ALNUM = _byte_set([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
#: Bytes of words ``[^\x20\x09-\x0D]+``.
NON_SPACE = ~_byte_set([(0x20, 0x20), (0x09, 0x0D)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_RANDOM = mix((np.arange(256, dtype=U) + U(1)) * U(0x9E3779B97F4A7C15))
_BASE, _STEP = U(0x9E6C63D0876A9A47), U(0xD1342543DE82EF95)
_POWERS = np.ones(1, U)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([np.ones(1, U), np.full(2 * n, _BASE, U)]))
    return _POWERS


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def span_hashes(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that lie end to end in ``data``, none of them empty."""
    if not len(length):
        return np.zeros(0, U)
    opens = np.cumsum(length) - length
    rank = np.arange(len(data)) - np.repeat(opens, length)
    term = _RANDOM[data] * _powers(int(length.max()))[rank]
    return mix(np.add.reduceat(term, opens) + length.astype(U))


class Words:
    """The words of a run of documents: byte spans, owning document, 64-bit hashes.

    ``first[d]:first[d + 1]`` are the words of document ``d`` of the run.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, fold: np.ndarray = LOWER):
        data = fold[data]
        n = len(data)
        inside = kind[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:n]
        self.data = data
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.hash = span_hashes(data[inside], self.end - self.start)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each word on, and whether they lie in one document."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, U), np.zeros(0, bool)
        h = self.hash[n - 1 : n - 1 + m].copy()
        for k in range(n - 2, -1, -1):
            h *= _STEP
            h += self.hash[k : k + m]
        return mix(h + U(n)), self.doc[:m] == self.doc[n - 1 : n - 1 + m]

    def whole(self) -> np.ndarray:
        """Hash of all words of each document (of no use where it has none)."""
        longest = int(self.count.max(initial=0))
        powers = np.cumprod(np.concatenate([np.ones(1, U), np.full(max(longest - 1, 0), _STEP, U)]))
        rank = np.arange(len(self.hash)) - np.repeat(self.first[:-1], self.count)
        total = np.zeros(len(self.count), U)
        some = self.count > 0
        if len(self.hash):
            total[some] = np.add.reduceat(self.hash * powers[rank], self.first[:-1][some])
        return mix(total + self.count.astype(U))

    def text(self, lo: int, hi: int) -> bytes:
        """Words ``lo`` to ``hi`` (exclusive), joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[lo:hi], self.end[lo:hi], strict=True))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all ``n``-word shingles; fewer words, but not none, are one shingle."""
    h, ok = words.windows(n)
    doc, h = words.doc[: len(h)][ok], h[ok]
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    if len(short):
        doc, h = np.concatenate([doc, short]), np.concatenate([h, words.whole()[short]])
    return doc, h


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs ``lo:hi`` of documents of about ``size`` bytes."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def scan(batches: Iterator[pa.RecordBatch], kind: np.ndarray, fold: np.ndarray = LOWER, column: str = "text") -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Batches cut into blocks, each with its words."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        for lo, hi in blocks(offsets):
            yield batch.slice(lo, hi - lo), Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], kind, fold)


def blobs(values: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """Binary column of the pieces of ``values`` that begin at ``firsts`` (n + 1 positions)."""
    size = values.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(firsts) - 1,
        [None, pa.py_buffer((np.asarray(firsts, np.int64) * size).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())],
    ).cast(pa.binary())


def columns(fields: dict[str, str]) -> str:
    return ", ".join(f"{k} {v}" for k, v in fields.items())


ArrowMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
