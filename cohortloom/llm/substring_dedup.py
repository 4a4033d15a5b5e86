"""Substring dedup with difference-cover anchors.

Word positions of a document are taken modulo 7, and seven-word anchors are hashed only at
residues 1, 2 and 4. Their differences give every residue, so wherever two documents share a
long match, at any two offsets, one of its first seven places is an anchor in both; with
thirteen words the match holds that anchor whole.

1. Anchors of each document are dealt by hash into buckets, as blobs. Those found in two or
   more documents are shared; the rest of the corpus cannot hold a match.
2. Around shared anchors only, matches are extended to the windows of ``window`` words that
   contain them. Window hashes are dealt into buckets; a window whose smallest document is
   another one is removed from this document.
3. The words that removed windows cover are cut out.

No step makes pairs: a window in a third of all documents is one hash with one smallest
document. Each task settles its own documents first and sends a hash once, with its smallest
document there; so a hot hash has one row for each run of about four million values. Buckets
are sized by the number of words.

Equal hashes of 64 bits count as equal windows; among 10^9 windows the chance that any two
differing ones meet is about 3 %, and only those at shared anchors are compared at all.

Null text has no words. Rows with equal ids are one document to this operator: they never
remove from each other, and each is judged by itself. Null ids are the largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import NON_SPACE, SAME, U, Words, cut, mix, scan
from cohortloom.llm.registry import query, table

PERIOD, COVER, ANCHOR = 7, (1, 2, 4), 7
#: Values that one bucket holds, and bytes of text that one group of documents holds, at about.
BUCKET, GROUP = 400_000, 4_000_000
_LAST = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of the anchors of a run of documents."""
    h, ok = words.windows(ANCHOR)
    rank = np.arange(len(h)) - words.first[words.doc[: len(h)]]
    ok &= np.isin(rank % PERIOD, COVER)
    at = np.flatnonzero(ok)
    return at, h[at]


def _deal(hashes: np.ndarray, ids: np.ndarray, n: int, judge) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, hashes, ids) that send each hash once, with its smallest document here.

    ``judge`` marks what is decided already among these documents; those rows are answers
    (bucket ``n`` and above) and are not compared again.
    """
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1])
    hashes, ids = hashes[new], ids[new]
    first, size = _runs(hashes)
    known = judge(hashes, ids, first, size)
    rows = []
    bucket = ((hashes[first] >> U(32)) % U(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ask, bucket = first[order], bucket[order]
    firsts = np.searchsorted(bucket, np.arange(n + 1))
    for k in np.flatnonzero(np.diff(firsts)).tolist():
        at = ask[firsts[k] : firsts[k + 1]]
        rows.append((k, hashes[at].tobytes(), ids[at].tobytes()))
    if known.any():
        h, d = hashes[known], ids[known]
        slot = (mix(d.astype(U)) % U(n)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        h, d, slot = h[order], d[order], slot[order]
        firsts = np.searchsorted(slot, np.arange(n + 1))
        for k in np.flatnonzero(np.diff(firsts)).tolist():
            lo, hi = firsts[k], firsts[k + 1]
            rows.append((n + k, h[lo:hi].tobytes(), d[lo:hi].tobytes()))
    for lo in range(0, len(rows), 200):
        some = rows[lo : lo + 200]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in some], pa.int32()), pa.array([r[1] for r in some], pa.binary()), pa.array([r[2] for r in some], pa.binary())],
            names=["bucket", "hashes", "ids"],
        )


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and size of each run of equal values."""
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(h)))


def _shared(h: np.ndarray, d: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of sorted (hash, document): hashes of two or more documents."""
    return np.repeat(np.maximum.reduceat(d, first) != d[first], size) if len(h) else np.zeros(0, bool)


def _later(h: np.ndarray, d: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of sorted (hash, document): documents after the hash's smallest one."""
    return d != np.repeat(d[first], size) if len(h) else np.zeros(0, bool)


DEALT = "bucket int, hashes binary, ids binary"


def _gathered(parts: Iterator, flush: int = 4_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of (hash, id) of about ``flush`` values out of blocks of documents."""
    hs, ds, n = [], [], 0
    for h, d in parts:
        hs.append(h)
        ds.append(d)
        n += len(h)
        if n >= flush:
            yield np.concatenate(hs), np.concatenate(ds)
            hs, ds, n = [], [], 0
    if n:
        yield np.concatenate(hs), np.concatenate(ds)


def _send_anchors(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch, words in scan(batches, NON_SPACE, SAME):
                at, h = anchors(words)
                yield h, _ids(batch.column("doc_id"))[words.doc[at]]

        for h, d in _gathered(parts()):
            yield from _deal(h, d, n, _shared)

    return run


def group_of(ids: np.ndarray, n: int) -> np.ndarray:
    """``pmod(xxhash64(id), n)`` as Spark has it."""
    one, two, three, four, five = (U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, k: (x << U(k)) | (x >> U(64 - k))
    h = (np.full(len(ids), 42 + 8, U) + five) ^ (turn(ids.view(U) * two, 31) * one)
    h = turn(h, 27) * one + four
    h = (h ^ (h >> U(33))) * two
    h = (h ^ (h >> U(29))) * three
    return (h ^ (h >> U(32))).view(np.int64) % n


def _answer(h: np.ndarray, d: np.ndarray, groups: int) -> pa.Table:
    """Rows (g, hashes, ids): the hashes to give back to the documents of each group."""
    g = group_of(d, groups)
    order = np.argsort(g, kind="stable")
    h, d, g = h[order], d[order], g[order]
    first, size = _runs(g)
    spans = list(zip(first.tolist(), size.tolist(), strict=True))
    return pa.table({
        "g": pa.array(g[first], pa.int32()), "hashes": pa.array([h[a : a + k].tobytes() for a, k in spans], pa.binary()),
        "ids": pa.array([d[a : a + k].tobytes() for a, k in spans], pa.binary()),
    })


ANSWER = "g int, hashes binary, ids binary"


def _bucket_arrays(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(b"".join(rows.column("hashes").to_pylist()), U)
    d = np.frombuffer(b"".join(rows.column("ids").to_pylist()), np.int64)
    order = np.lexsort((h, d))
    return h[order], d[order]


class Answers:
    """What came back for the documents of one group, by document."""

    def __init__(self, rows: pa.Table):
        self.hash, self.id = _bucket_arrays(rows)

    def have(self, batch: pa.RecordBatch, hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Which of ``hashes`` (of row ``owner`` each, ascending) came back for their document."""
        out = np.zeros(len(hashes), bool)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        ids = _ids(batch.column("doc_id"))
        lows, highs = np.searchsorted(self.id, ids, "left"), np.searchsorted(self.id, ids, "right")
        for r in np.flatnonzero((highs > lows) & (bounds[1:] > bounds[:-1])).tolist():
            known, mine = self.hash[lows[r] : highs[r]], hashes[bounds[r] : bounds[r + 1]]
            out[bounds[r] : bounds[r + 1]] = known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine
        return out


def _extended(docs: pa.Table, found: Answers, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, id) of the windows of ``window`` words around anchors that came back."""
    for batch, words in scan(docs.to_batches(), NON_SPACE, SAME):
        at, h = anchors(words)
        at = at[found.have(batch, h, words.doc[at])]
        w, ok = words.windows(window)
        # Windows that contain the anchor at q begin at q - (window - ANCHOR) .. q.
        step = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(step, np.maximum(at - (window - ANCHOR), words.first[words.doc[at]]), 1)
        np.add.at(step, at + 1, -1)
        begin = np.flatnonzero((np.cumsum(step)[: len(w)] > 0) & ok)
        yield w[begin], _ids(batch.column("doc_id"))[words.doc[begin]]


def _covered(docs: pa.Table, found: Answers, window: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    """The result rows: windows that came back are cut out."""
    for batch, words in scan(docs.to_batches(), NON_SPACE, SAME):
        w, ok = words.windows(window)
        begin = np.flatnonzero(ok)
        begin = begin[found.have(batch, w[begin], words.doc[begin])]
        step = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(step, begin, 1)
        np.add.at(step, begin + window, -1)
        gone = np.cumsum(step)[:-1] > 0
        removed = np.bincount(words.doc[gone], minlength=batch.num_rows)
        raw, s, e = words.data.tobytes(), words.start.tolist(), words.end.tolist()
        kept = []
        for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            kept.append(b" ".join([raw[s[i] : e[i]] for i in (lo + np.flatnonzero(~gone[lo:hi])).tolist()]))
        out = [batch.column("doc_id"), pa.array(words.count, pa.int64()), pa.array(removed, pa.int64())]
        out.append(pa.array([k.decode() for k in kept], pa.string()) if keep_text else pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
        yield pa.RecordBatch.from_arrays(out, schema=_result(keep_text))


def _result(keep_text: bool) -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept" if keep_text else "kept_sha256", pa.string())])


def dedup(docs: DataFrame, *, window: int = 13, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, and the kept words' sha256 (or with ``keep_text`` the kept words)."""
    if window < ANCHOR + PERIOD - 1:
        raise ValueError(f"a window has at least {ANCHOR + PERIOD - 1} words")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    chars = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Both follow the text alone: between them lie as many messages as there are pairs of both, at most.
    n = max(1, int(chars) // 6 * len(COVER) // PERIOD // BUCKET)

    groups = max(1, int(chars) // GROUP)
    texts = texts.withColumn("g", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(_LAST))), F.lit(groups)).cast("int"))

    def met(sent: DataFrame, judge) -> DataFrame:
        def one(key: tuple, rows: pa.Table) -> pa.Table:
            d, h = _bucket_arrays(rows)[::-1]
            if key[0].as_py() < n:
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                yes = judge(h, d, *_runs(h))
                h, d = h[yes], d[yes]
            return _answer(h, d, groups)

        return sent.groupBy("bucket").applyInArrow(one, ANSWER)

    def extend(docs: pa.Table, back: pa.Table) -> pa.Table:
        out = [b for h, d in _gathered(_extended(docs, Answers(back), window)) for b in _deal(h, d, n, _later)]
        return pa.Table.from_batches(out, _DEALT)

    def cover(docs: pa.Table, back: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(_covered(docs, Answers(back), window, keep_text)), _result(keep_text))

    by_group = texts.groupBy("g")
    shared = cut(met(texts.select("doc_id", "text").mapInArrow(_send_anchors(n), DEALT), _shared), "anchors")
    around = by_group.cogroup(shared.groupBy("g")).applyInArrow(extend, DEALT)
    later = cut(met(around, _later), "windows")
    last = "kept string" if keep_text else "kept_sha256 string"
    return by_group.cogroup(later.groupBy("g")).applyInArrow(cover, f"doc_id bigint, n_words bigint, n_removed bigint, {last}")


_DEALT = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary())])

SQL = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select r, doc_id, p, array_to_string(w[p:p + 12], ' ') as x from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as p from d)),
low as (select x, min(doc_id) as least_id from win group by x),
gone as (select distinct r, unnest(range(p, p + 13)) as q from win join low using (x) where win.doc_id > least_id),
word as (select r, unnest(range(1, len(w) + 1)) as q, unnest(w) as t from d),
kept as (select r, string_agg(t, ' ' order by q) as k from word anti join gone using (r, q) group by r),
n_gone as (select r, count(*) as n from gone group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from d left join kept using (r) left join n_gone using (r)
"""


@query("op5_substring_dedup", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
