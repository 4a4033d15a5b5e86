"""Runs of words against their definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from fixtures import odd_rows, table

from cohortloom.llm import registry, runs
from cohortloom.llm.common import mix

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if w[q:] == w[: len(w) - q])


def runs_of(w):
    """Every maximal stretch of every period, kept where that is its smallest."""
    names = {x: k for k, x in enumerate(dict.fromkeys(w))}
    ids, n, out = np.array([names[x] for x in w], int), len(w), []
    for q in range(1, n // 4 + 1):
        edge = np.diff(np.concatenate([[0], ids[q:] == ids[:-q], [0]]).astype(int))
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if j + q - i >= max(6, 4 * q) and smallest_period(w[i : j + q]) == q:
                out.append((i, j + q - i, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def answer(i, text, planted):
    w = SPACED.findall(text or "")
    n, h = len(w), zlib.crc32(str(i).encode()) if i is not None else 1
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = runs_of(w)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    best = min(found, key=lambda r: (-(r[1] * 10**12 // r[2]), r[0], r[2])) if found else (None, None, None)
    milli = 1000 * best[1] // best[2] if found else None
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(found), *best, milli, sha(lines), sha(kept))


def test_runs_of_random_words():
    rnd, total = random.Random(5), 0
    for _ in range(60):
        docs = []
        for _ in range(rnd.randrange(1, 10)):
            k = rnd.choice([1, 2, 3, 5, 30])
            w = [rnd.randrange(k) for _ in range(rnd.randrange(70))]
            for _ in range(rnd.randrange(3)):
                u = [rnd.randrange(k + 1) for _ in range(rnd.randrange(1, 9))] * rnd.randrange(2, 9)
                at = rnd.randrange(len(w) + 1)
                w = w[:at] + u[: rnd.randrange(1, len(u) + 1)] + w[at:]
            docs.append(w)
        first = np.cumsum([0] + [len(d) for d in docs])
        h = mix(np.array([x for d in docs for x in d], np.uint64) + np.uint64(3))
        got = [[] for _ in docs]
        for d, s, m, q in zip(*[x.tolist() for x in runs.find_runs(h, first)], strict=True):
            got[d].append((s, m, q))
        want = [runs_of(w) for w in docs]
        assert got == want
        total += sum(map(len, want))
    assert total > 100


def test_grammar_gives_the_words_back():
    rnd = random.Random(6)
    words = np.array([rnd.randrange(4) for _ in range(300)], np.uint64)
    doc = np.repeat(np.arange(3), 100)
    g = runs.Grammar(mix(words + np.uint64(1)), doc)
    assert g.n_rules > 5
    for k in range(g.n_rules):
        at = np.flatnonzero(g.rule == k)
        texts = {(int(g.left[i]), tuple(words[g.place[i] : g.place[i] + g.size[i]].tolist())) for i in at}
        assert len(at) > 1 and len(texts) == 1 and len(set(doc[g.place[at]])) == 1
    # Every boundary within a document is a nonterminal's, or one of those that remain.
    inner = set((g.place + g.left).tolist())
    assert inner | set(g.top.tolist()) == {i for i in range(1, 300) if i % 100}


@pytest.mark.parametrize("planted", [True, False])
def test_word_runs(spark, planted):
    rows = odd_rows() + [
        (400, "a " * 50, "s0"), (401, "x y z " * 9 + "x y", "s0"), (402, "q " * 5, "s0"), (403, "\v".join("abab" * 4) + "  b", "s0"),
        (404, "a b a b a b a b c c c c c c a b a b a b a b", "s0"), (404, "a b a b a b a b c c c c c c a b a b a b a b", "s0"),
    ]
    rows += [(10_000 + k, " ".join(f"w{j % 40}" for j in range(k)), "s1") for k in range(0, 240, 7)]
    got = runs.word_runs(table(spark, rows).repartition(3), planted=planted, keep_text=True).collect()
    have = sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in got), key=repr)
    want = sorted((answer(i, t, planted) for i, t, *_ in rows), key=repr)
    assert have == want and sum(r[1] for r in want) > 20
    one = next(r for r in got if r.doc_id == 400)
    assert one.collapsed == "a" and [tuple(x) for x in one.runs] == [(0, 50, 1)]


def test_no_rows_and_no_words(spark):
    assert runs.word_runs(table(spark, [])).count() == 0
    got = runs.word_runs(table(spark, [(1, None), (2, ""), (3, " \n")])).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.n_runs, r.start, r.runs_sha256, r.collapsed_sha256) == (0, None, empty, empty) for r in got)


def test_query_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = registry.QUERIES["op12_runs"](spark, sf).collect()
    few = [r for r in got if len(docs[r.doc_id] or "") < 6000]
    assert len(got) == len(docs) and len(few) > 150
    assert sorted(map(tuple, few)) == sorted(answer(r.doc_id, docs[r.doc_id], True) for r in few)
