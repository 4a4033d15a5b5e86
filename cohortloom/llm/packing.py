"""Best-fit packing by patterns and non-negative least squares.

Documents become token ids followed by an end id; those longer than a sequence are cut into
full sequences, the first piece taking the remainder. Only lengths then matter, and their
histogram has at most ``size`` entries, whatever the corpus:

1. All patterns of two or three lengths that fill a sequence exactly are enumerated.
2. Repeat counts x >= 0 with least ||A x - histogram|| are found by accelerated projected
   gradient steps (A is sparse: three entries to a pattern).
3. Counts are rounded, largest first, as far as the histogram still has the lengths.
4. What is left is packed best-fit decreasing, again on the histogram: equal bins are one group
   with a count.
5. Each pattern slot holds a range of ranks of its length; a piece's rank among those of its
   length names its sequence and offset. Ranks are numbers within (length, sub) plus the sum of
   the subs before, so a length that a third of all pieces have is ranked by many tasks.

The slot table that is broadcast depends on the number of patterns of ``size``, not on the data.

Tokens: texts are cut before blanks that no white space precedes, which no pre-token of byte-level
BPE with a leading blank crosses. Distinct pieces of text are encoded once by the tokenizer and
kept in a bounded cache; documents are put together from them.

Null text is empty: one end id. Repeated rows are packed each; equal ids keep their own pieces.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import blocks, cut, span_hashes, text_bytes
from cohortloom.llm.registry import query, table

END_ID, SIZE = 0, 2048
#: Fixed value: how byte-level BPE parts words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a worker's cache of encoded strings; it is emptied when full.
CACHE = 400_000


#: Texts are encoded in blocks of about this many bytes, so that a string is looked up once in each.
BLOCK = 6_000_000


@cache
def string_encoder(path: str):
    """A function from strings to lists of ids, equal to the tokenizer file's own.

    A byte-level BPE whose ids are the order of its merges is run by tiktoken, which is faster on
    short strings; any other file by the tokenizers library. Added tokens that stand in a text are
    found first and have their own ids.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    kind, vocab = model["model"], model["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in kind.get("merges", [])]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    plain = (model.get("pre_tokenizer") or {}) == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    added = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
    # Added tokens that take blanks with them, or that one another contain, are left to the library.
    plain &= not any(t["single_word"] or t["lstrip"] or t["rstrip"] or " " in t["content"] for t in model.get("added_tokens", []))
    plain &= not any(a in b for a in added for b in added if a != b)
    if kind["type"] != "BPE" or model.get("normalizer") or not plain or ids != sorted(set(ids)) or -1 in ids:
        return lambda strings: [e.ids for e in tok.encode_batch(strings, add_special_tokens=False)]
    import tiktoken

    # Byte-level BPE writes printable bytes as themselves and the others, in order, from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in added}
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda strings: [fast.encode(s, allowed_special="all") if any(a in s for a in added) else fast.encode_ordinary(s) for s in strings]


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where strings begin that are encoded by themselves: documents, and blanks after anything
    but white space (every character of three bytes from E1, E2, E3 counts as such)."""
    before = np.zeros(len(data), bool)
    if len(data) > 3:
        one, two, three = data[2:-1], data[1:-2], data[:-3]
        space = (one < 0x21) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3) & (two >= 0x80) & (one >= 0x80))
        before[3:] = (data[3:] == 0x20) & ~space
    before[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(before)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Token ids of texts by a tokenizer file, with what was encoded before kept as bytes."""

    def __init__(self, path: str):
        self.encode, self.known = string_encoder(path), {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each text)."""
        start = _starts(data, offsets)
        length = np.diff(np.append(start, len(data)))
        _, first, back = np.unique(span_hashes(data, length), return_index=True, return_inverse=True)
        raw = data.tobytes()
        strings = [raw[s : s + n] for s, n in zip(start[first].tolist(), length[first].tolist(), strict=True)]
        if len(self.known) + len(strings) > CACHE:
            self.known = {}
        new = [s for s in strings if s not in self.known]
        self.known.update(zip(new, map(_packed, self.encode([s.decode() for s in new])), strict=True))
        parts = [self.known[s] for s in strings]
        ids = np.frombuffer(b"".join(parts), "<u4")
        size = np.array([len(p) // 4 for p in parts], np.int64)
        at = np.cumsum(size) - size
        n = size[back]
        upto = np.cumsum(n)
        out = ids[np.repeat(at[back], n) + np.arange(int(n.sum())) - np.repeat(upto - n, n)] if len(n) else np.zeros(0, "<u4")
        total = np.append(0, upto)
        return out, np.diff(total[np.searchsorted(start, offsets)])


def pieces(docs: DataFrame, path: str, *, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document; a map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in blocks(offsets, BLOCK):
                flat, count = encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                rows, at = [], 0
                for i, n in zip(ids[lo:hi], count.tolist(), strict=True):
                    one = np.append(flat[at : at + n], np.uint32(END_ID)).astype("<u4")
                    at += n
                    head = len(one) % size or size
                    edges = [0, *range(head, len(one) + 1, size)]
                    rows += [(i, k, a, b - a, zlib.crc32(one[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All (a <= b <= c) of available lengths with sum ``size``; pairs have a = 0."""
    have = np.zeros(size + 1, bool)
    have[lengths] = True
    a, b = np.meshgrid(np.append(0, lengths[lengths <= size // 2]), lengths, indexing="ij")
    c = size - a - b
    ok = (a <= b) & (b <= c) & have[np.clip(c, 0, size)]
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def fit(pats: np.ndarray, target: np.ndarray, steps: int = 200) -> np.ndarray:
    """Non-negative least squares: repeat counts of the patterns whose lengths add up to ``target``."""

    def apply(x: np.ndarray) -> np.ndarray:
        y = np.bincount(pats.ravel(), np.repeat(x, 3), minlength=len(target))
        y[0] = 0
        return y

    v = np.ones(len(pats))
    for _ in range(12):
        v = apply(v)[pats].sum(axis=1)
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(steps):
        r = apply(y) - target
        new = np.maximum(y - r[pats].sum(axis=1) / (1.05 * norm), 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(histogram: np.ndarray, size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use up the histogram."""
    left = histogram.astype(np.int64).copy()
    groups = [((size,), int(left[size]))] if left[size] else []
    left[size] = 0
    lengths = np.flatnonzero(left)
    if len(lengths):
        pats = patterns(lengths, size)
        if len(pats):
            x = fit(pats, left.astype(float))
            for k in np.argsort(-x, kind="stable"):
                if x[k] < 0.05:
                    break
                own = [int(v) for v in pats[k] if v]
                times = min(int(np.ceil(x[k])), min(int(left[v]) // own.count(v) for v in own))
                if times:
                    groups.append((tuple(own), times))
                    for v in own:
                        left[v] -= times
    return groups + best_fit(left, size)


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: bins with equal content are one group."""
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for n in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[n])
        for r in sorted(k for k in room if k >= n and room[k]):
            for content, count in list(room[r].items()):
                # A bin takes as many of this length as fit before the next bin is opened.
                each = r // n
                whole = min(count, todo // each)
                for bins, many in ((whole, each), (min(count - whole, 1), todo - whole * each)):
                    if bins and many and todo:
                        many = min(many, each)
                        room[r][content] -= bins
                        room[r - n * many][content + (n,) * many] += bins
                        todo -= bins * many
                if not room[r][content]:
                    del room[r][content]
                if not todo:
                    break
            if not todo:
                break
        each = size // n
        if todo // each:
            room[size - n * each][(n,) * each] += todo // each
        if todo % each:
            room[size - n * (todo % each)][(n,) * (todo % each)] += 1
    return [(content, count) for by in room.values() for content, count in by.items() if count]


def slots(groups: list[tuple[tuple[int, ...], int]], size: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank of each slot (sorted), sequence of that rank, offset in the sequence."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    base = 0
    for content, count in groups:
        at = 0
        for n in content:
            found[n].append((taken[n], base, at))
            taken[n] += count
            at += n
        base += count
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for n, rows in found.items()}


def pack(parts: DataFrame, *, size: int = SIZE) -> DataFrame:
    """``parts`` (a written table with doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    spark = parts.sparkSession
    histogram = np.zeros(size + 1, np.int64)
    for length, n in parts.groupBy("length").count().collect():
        histogram[length] = n
    places = spark.sparkContext.broadcast(slots(plan(histogram, size), size))
    subs = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = parts.withColumn("rid", F.xxhash64("_metadata.file_name", "_metadata.row_index"))
    rows = rows.withColumn("sub", F.pmod("rid", F.lit(subs)).cast("int"))
    before = Window.partitionBy("length").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("length", "sub").count().select("length", "sub", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "sub").orderBy("rid", "doc_id", "piece")
    ranked = rows.withColumn("n", F.row_number().over(own) - 1).join(base, ["length", "sub"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("n")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = places.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                mine = length == n
                first, seq, off = at[n]
                k = np.searchsorted(first, rank[mine], "right") - 1
                sequence[mine], offset[mine] = seq[k] + rank[mine] - first[k], off[k]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, *, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(cut(pieces(docs, path, size=size, id_col=id_col, text_col=text_col), "pieces"), size=size)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
