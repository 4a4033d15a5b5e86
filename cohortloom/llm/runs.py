"""Periodic runs of words, found through a grammar of each document.

A run is a longest stretch of words that repeats with smallest period q, at least four times over and at
least six words long. The words of a document are compressed by pair replacement (Re-Pair): in each
round the pairs that are more frequent than those they overlap become nonterminals, until no pair
occurs twice. A stretch of words either lies within one symbol of what is left, or crosses a boundary between two of
them; within a symbol, the same holds for its two halves. So the runs that cross a nonterminal's boundary
are looked for once, inside its expansion, and moved to all places where it was put in; those that
cross a boundary of the remaining symbols are looked for in the document. Of the intervals found, the ones
inside a longer one of the same period, or with a smaller period too, go.

At a boundary a period q shows as a square on one side, so a gram of 2^j <= q words recurs at distance q;
squares and their extensions are compared by 64-bit hashes of words.

Everything is done for blocks of documents in numpy, in a map over the table: a document is the unit
of work, of any length. Null texts have no words. Repeated rows, null ids and extra columns change
nothing; rows keep their own answers.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import NON_SPACE, SAME, U, mix, scan
from cohortloom.llm.registry import query, table

LEAST_WORDS, LEAST_TIMES = 6, 4
_BASE = U(0xD1342543DE82EF95)


class Hashes:
    """Prefix sums that give the hash of any stretch of words."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        self.powers = np.cumprod(np.concatenate([np.ones(1, U), np.full(n, _BASE, U)]))
        # sum of h[i] * base^(n - i): a stretch is compared after a shift to the same power.
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(h) * self.powers[n - np.arange(n)] if n else h)])
        self.n = n

    def of(self, start: np.ndarray, length) -> np.ndarray:
        """Comparable between stretches of equal length."""
        return (self.sums[start + length] - self.sums[start]) * self.powers[start]

    def forward(self, i: np.ndarray, k: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and ``k`` on agree, at most ``most``."""
        return self._search(lambda m: self.of(i, m) == self.of(k, m), most)

    def backward(self, i: np.ndarray, k: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``i`` and ``k`` agree, at most ``most``."""
        return self._search(lambda m: self.of(i - m, m) == self.of(k - m, m), most)

    @staticmethod
    def _search(agree, most: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros_like(most), most.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            good = agree(mid)
            lo, hi = np.where(good, mid, lo), np.where(good, hi, mid - 1)
        return lo


class Grammar:
    """Pairs of a block's documents, replaced until none occurs twice in a document.

    ``top`` are the places of the boundaries that remain. Nonterminal ``k`` was put in at the places
    ``place[rule == k]``; ``left`` and ``size`` are the words of its first half and of all of it.
    """

    def __init__(self, h: np.ndarray, doc: np.ndarray):
        rules, places, lefts, sizes, tops = [], [], [], [], []
        sym = np.unique(mix(h) ^ mix(doc.astype(U) + U(1)), return_inverse=True)[1].astype(np.int64)
        n_symbols = int(sym.max(initial=-1)) + 1
        pos, size = np.arange(len(sym)), np.ones(len(sym), np.int64)
        joined = np.zeros(len(sym), bool)
        joined[:-1] = doc[:-1] == doc[1:]
        self.n_rules = 0
        while True:
            at = np.flatnonzero(joined)
            if not len(at):
                break
            kinds, kind = np.unique(sym[at] * n_symbols + sym[at + 1], return_inverse=True)
            # Within a^k every second pair counts.
            follows = np.zeros(len(at), bool)
            follows[1:] = (at[1:] == at[:-1] + 1) & (kind[1:] == kind[:-1])
            begin = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            own = (np.arange(len(at)) - begin) % 2 == 0
            count = np.bincount(kind[own], minlength=len(kinds))
            dead = count[kind] < 2
            tops.append(pos[at[dead] + 1])
            joined[at[dead]] = False
            order = np.full(len(sym) + 1, -1, np.int64)
            order[at[own & ~dead]] = (count * (len(kinds) + 1) + np.arange(len(kinds)))[kind[own & ~dead]]
            mine = order[at]
            chosen = (mine >= 0) & (mine > order[at - 1]) & (mine > order[at + 1])
            chosen &= np.bincount(kind[chosen], minlength=len(kinds))[kind] > 1
            spot, which = at[chosen], kind[chosen]
            if len(spot):
                used, new = np.unique(which, return_inverse=True)
                rules.append(self.n_rules + new)
                places.append(pos[spot])
                lefts.append(size[spot])
                size[spot] += size[spot + 1]
                sizes.append(size[spot])
                sym[spot] = n_symbols + new
                joined[spot] = joined[spot + 1]
                self.n_rules += len(used)
                n_symbols += len(used)
            keep = joined.copy()
            keep[1:] |= joined[:-1]
            keep[spot + 1] = False
            # A symbol whose right half went keeps its place in front of what followed.
            sym, pos, size, joined = sym[keep], pos[keep], size[keep], joined[keep]
        empty = [np.zeros(0, np.int64)]
        self.rule, self.place, self.left, self.size = (np.concatenate(x or empty) for x in (rules, places, lefts, sizes))
        self.top = np.concatenate(tops or empty)


def _crossing(hs: Hashes, doc: np.ndarray, first: np.ndarray, p: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(boundary, start, end, period) of repetitions within ``a:b`` that cross the boundary ``p``, long enough."""
    word = hs.of(np.arange(hs.n), 1)
    found = []

    def squares(k: np.ndarray, q: np.ndarray, right: bool) -> None:
        """Keep what has a square next to the boundary, and extend it both ways."""
        side = np.maximum(2 * q, LEAST_WORDS // 2)
        inside = (p[k] + side <= b[k]) if right else (p[k] - side >= a[k])
        k, q, side = k[inside], q[inside], side[inside]
        i = p[k] if right else p[k] - side
        same = hs.of(i, side - q) == hs.of(i + q, side - q)
        k, q = k[same], q[same]
        if not len(k):
            return
        i = p[k] if right else p[k] - q
        start = i - hs.backward(i, i + q, i - a[k])
        end = i + q + hs.forward(i, i + q, b[k] - i - q)
        enough = (end - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * q)) & (start < p[k]) & (end > p[k])
        found.append((k[enough], start[enough], end[enough], q[enough]))

    every = np.arange(len(p))
    ones = np.ones(len(p), np.int64)
    squares(every, ones, True)
    squares(every, ones, False)
    last = first[1:][doc]
    longest = int(np.diff(first).max(initial=0))
    gram, some = 2, np.arange(hs.n)
    rank = np.full(hs.n + 1, -1, np.int64)
    salt = mix(doc.astype(U) + U(1))
    while len(some) and LEAST_TIMES * gram <= longest:
        some = some[some + gram <= last[some]]
        code = hs.of(some, gram) ^ salt[some]
        order = np.argsort(code, kind="stable")
        code, at = code[order], some[order]
        again = np.zeros(len(at), bool)
        if len(at):
            equal = code[1:] == code[:-1]
            again[1:] = equal
            again[:-1] |= equal
        code, at = code[again], at[again]
        rank[:] = -1
        rank[at] = np.arange(len(at))
        for right in (True, False):
            y = p if right else p - gram
            k = every[(y >= a) & (y < b)]
            k = k[rank[y[k]] >= 0]
            r, step = rank[y[k]], 1 if right else -1
            here = r.copy()
            while len(k):
                r = r + step
                on = (r >= 0) & (r < len(at))
                k, r, here = k[on], r[on], here[on]
                q = np.abs(at[r] - at[here])
                on = (code[r] == code[here]) & (q < 2 * gram)
                k, r, here, q = k[on], r[on], here[on], q[on]
                far = q >= gram
                squares(k[far], q[far], right)
        some, gram = np.sort(at), 2 * gram
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def find_runs(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and period; starts count from the document's first word."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if not len(h):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    grammar, hs = Grammar(h, doc), Hashes(h)
    one = np.unique(grammar.rule, return_index=True)[1]
    p = np.concatenate([grammar.place[one] + grammar.left[one], grammar.top])
    a = np.concatenate([grammar.place[one], first[doc[grammar.top]]])
    b = np.concatenate([grammar.place[one] + grammar.size[one], first[doc[grammar.top] + 1]])
    k, start, end, q = _crossing(hs, doc, first, p, a, b)
    # To all places where the nonterminal was put in.
    inner = k < len(one)
    order = np.argsort(grammar.rule, kind="stable")
    lo = np.searchsorted(grammar.rule[order], k[inner])
    times = np.searchsorted(grammar.rule[order], k[inner], "right") - lo
    use = order[np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
    shift = grammar.place[use] - np.repeat(a[k[inner]], times)
    start = np.concatenate([start[~inner], np.repeat(start[inner], times) + shift])
    end = np.concatenate([end[~inner], np.repeat(end[inner], times) + shift])
    q = np.concatenate([q[~inner], np.repeat(q[inner], times)])
    # The smallest period of an interval, then the intervals no other of that period contains.
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[fresh], end[fresh], q[fresh]
    order = np.lexsort((-end, start, q))
    start, end, q = start[order], end[order], q[order]
    if len(q):
        # Per period, by start: contained where an earlier one reaches as far.
        reach = np.maximum.accumulate(end + q * (len(h) + 1))
        fresh = np.ones(len(q), bool)
        fresh[1:] = (q[1:] != q[:-1]) | (end[1:] + q[1:] * (len(h) + 1) > reach[:-1])
        start, end, q = start[fresh], end[fresh], q[fresh]
    order = np.lexsort((q, start))
    start, end, q = start[order], end[order], q[order]
    of = doc[start]
    return of, start - first[of], end - start, q


def collapsed(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray) -> Iterator[bytes]:
    """Words ``begin:end`` of ``data``, joined by one space, document by document."""
    size = end - begin + 1
    stop = np.cumsum(size)
    take = np.repeat(begin - (stop - size), size) + np.arange(size.sum())
    out = np.append(data, np.uint8(32))[np.minimum(take, len(data))]
    out[stop - 1] = 32
    out = out.tobytes()
    bounds = np.concatenate([np.zeros(1, np.int64), stop])[first]
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield out[lo : max(lo, hi - 1)]


def planted_order(h: int, n: int) -> np.ndarray:
    """Which word stands at each place of a document with the hash ``h``: some documents get a periodic end."""
    i = np.arange(n)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        i[a:] = a + (i[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return i


OUT = {
    "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
    "runs_sha256": "string", "collapsed_sha256": "string",
}


def _scanner(planted: bool, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in scan(batches, NON_SPACE, SAME):
            n_docs, first = len(batch), words.first
            source = np.arange(len(words.hash))
            if planted:
                for d, i in enumerate(batch.column("id_text").to_pylist()):
                    h = zlib.crc32(i.encode()) if i is not None else 1
                    if h % 10 == 0:
                        source[first[d] : first[d + 1]] = first[d] + planted_order(h, int(words.count[d]))
            of, start, length, period = find_runs(words.hash[source], first)
            depth = np.zeros(len(source) + 1, np.int64)
            np.add.at(depth, first[of] + start + period, 1)
            np.add.at(depth, first[of] + start + length, -1)
            kept = np.cumsum(depth)[:-1] == 0
            source = source[kept]
            left = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])[first]
            texts = list(collapsed(words.data, words.start[source], words.end[source], left))
            count = np.bincount(of, minlength=n_docs)
            bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)]).tolist()
            lines = [b"%d,%d,%d\n" % x for x in zip(start.tolist(), length.tolist(), period.tolist(), strict=True)]
            best = np.lexsort((period, start, -(length / period), of))
            best = best[np.searchsorted(of[best], np.arange(n_docs))[count > 0]] if len(of) else best
            at = np.full(n_docs, -1)
            at[count > 0] = best
            none = pa.array(at < 0)
            pick = lambda x: pa.array(np.append(x, 0)[at], pa.int64(), mask=np.asarray(none))
            out = {
                "doc_id": batch.column("doc_id"), "n_runs": pa.array(count, pa.int64()), "start": pick(start), "length": pick(length), "period": pick(period),
                "exponent_milli": pick(1000 * length // np.maximum(period, 1)),
                "runs_sha256": pa.array([hashlib.sha256(b"".join(lines[a:b])).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string()),
                "collapsed_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            }
            if keep_text:
                out["collapsed"] = pa.array([t.decode() for t in texts], pa.string())
                spans = [{"start": s, "length": n, "period": q} for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True)]
                out["runs"] = pa.array([spans[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run


def word_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", planted: bool = False, keep_text: bool = False) -> DataFrame:
    """Runs of each document row: their number, the one of greatest exponent, and digests of all runs and of the collapsed text.

    ``keep_text`` adds the collapsed text and the runs themselves. ``planted`` first gives about a tenth
    of the documents (by the CRC of their ids) a periodic end.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fields = {**OUT, "doc_id": kind} | ({"collapsed": "string", "runs": "array<struct<start:bigint,length:bigint,period:bigint>>"} if keep_text else {})
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("id_text"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scanner(planted, keep_text), ", ".join(f"{k} {v}" for k, v in fields.items())).withColumnRenamed("doc_id", id_col)


@query("op12_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs(table(spark, sf_dir, "documents"), planted=True)
