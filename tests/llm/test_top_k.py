"""Exact search against all scores."""

import math
import random

import numpy as np
import pytest

from cohortloom.llm import top_k

SCHEMA = "vec_id bigint, embedding array<double>, number int, part string, v string, norm int, score int"


def brute(rows, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in whole:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, x, strict=False)), j) for j, x in whole if j != i)
            out += [(i, r + 1, j, max(min(-s, 2**63 - 1), -(2**63))) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def vectors(rnd, n, width, spread):
    return [(i, [rnd.gauss(0, 1) * (0.2 + spread * (c == 0)) for c in range(width)]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "p", "v", 2, 3) for i, v in rows], SCHEMA)


@pytest.mark.parametrize(("n", "width", "head", "block"), [(700, 16, 40, 16_384), (300, 5, 3, 4), (120, 1, 5, 2)])
def test_against_all_scores(spark, n, width, head, block, monkeypatch):
    monkeypatch.setattr(top_k, "TILE_VECTORS", 64)
    rnd = random.Random(n)
    rows = vectors(rnd, n, width, 2.0)
    rows += [(n + k, rows[7][1]) for k in range(60)] + [(0, rows[3][1]), (50, rows[50][1]), (-100, [0.0] * width)]
    rows += [(9000, None), (9050, [float("nan")] * width), (9100, [None] * width), (9150, [float("inf")] * width), (None, rows[0][1]), (9200, [])]
    got = top_k.top_k(frame(spark, rows).repartition(5), "vec_id % 50 = 0", head=head, block=block)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_few_rows_and_none(spark):
    assert top_k.top_k(frame(spark, []), "vec_id % 50 = 0").count() == 0
    assert top_k.top_k(frame(spark, [(0, [1.0, 2.0])]), "vec_id % 50 = 0").count() == 0
    rows = [(0, [1.0, 2.0]), (1, [0.5]), (2, [1e9, -1e9]), (3, [-3e30, 1.0]), (50, [2e30, 2e30])]
    got = top_k.top_k(frame(spark, rows), "vec_id % 50 = 0").collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)


def test_rotation_keeps_products_and_ends_early():
    rnd = np.random.default_rng(1)
    x = np.floor(rnd.normal(size=(400, 12)) * np.array([300, 200, 100] + [5] * 9))
    turn = top_k.rotation(x[:50], 12)
    assert np.allclose(turn @ turn.T, np.eye(12)) and ((x @ turn)[:, :3] ** 2).sum() > 0.99 * (x**2).sum()
    assert top_k.rotation(x[:0], 3).tolist() == np.eye(3).tolist()
    block = top_k.Block(np.arange(4), np.arange(4), x[:4], turn, 5)
    asked = []
    exact = top_k.dots
    top_k.dots = lambda q, v: asked.append(len(q)) or exact(q, v)
    try:
        block.add(np.arange(400), x)
    finally:
        top_k.dots = exact
    want = (x[:4] @ x.T).astype(int)
    want[np.arange(4), np.arange(4)] = -(10**9)
    assert (block.score == -np.sort(-want, axis=1)[:, :5]).all() and sum(asked) < 100
