"""Components of links: exact on chains and random graphs, and few written tables."""

import random

import pytest

from cohortloom.llm import components as components_of


def smallest_reached(links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for node in sorted(near):
        todo = [node] if node not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = node
                todo += near[x]
    return out


def found(spark, tmp_path, links):
    path = str(tmp_path / "links")
    spark.createDataFrame(links, "a bigint, b bigint").write.parquet(path)
    rows = components_of.components(spark.read.parquet(path)).collect()
    assert len({r.u for r in rows}) == len(rows)
    return {r.u: r.root for r in rows}


def chance():
    rng = random.Random(7)
    return [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(70)]


@pytest.mark.parametrize("links", [[(k, k + 1) for k in range(40)], [(k * 37 % 101, (k + 1) * 37 % 101) for k in range(90)], chance(), [(5, 5)], []])
def test_components(spark, tmp_path, links):
    assert found(spark, tmp_path, links) == {u: root for u, root in smallest_reached(links).items() if u != root}


def test_a_star_is_done_after_one_round(spark, tmp_path, monkeypatch):
    written = []
    plain = components_of.cut
    monkeypatch.setattr(components_of, "cut", lambda df, tag: written.append(tag) or plain(df, tag))
    assert found(spark, tmp_path, [(9, k) for k in (3, 12, 15, 20)]) == dict.fromkeys((9, 12, 15, 20), 3)
    assert len(written) == 2
