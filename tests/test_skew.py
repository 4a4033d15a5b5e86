"""Sliced heavy groups give the same answers as plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import folds, matrix, pathway, resolve, sets, skew


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(40)}", i, rnd.randrange(300), float(rnd.randrange(1000))) for i in range(6000)]
    return spark.createDataFrame(data, "k string, i bigint, tie int, v double").cache(), data


def test_ranked_matches_plain_order(rows):
    df, data = rows
    got = {r.i: r.rn for r in skew.ranked(df, ["k"], [F.col("tie"), F.col("i")], slice_rows=200).collect()}
    by = {}
    for k, i, tie, _ in data:
        by.setdefault(k, []).append((tie, i))
    want = {i: n for items in by.values() for n, (_, i) in enumerate(sorted(items), 1)}
    assert skew.hot_keys(df, ["k"], 200) and got == want


def test_running_sum_and_global_rank(rows):
    df, data = rows
    got = {r.i: r.s for r in skew.running(df, [], [F.col("i")], {"s": F.col("v")}, slice_rows=500).collect()}
    total, want = 0.0, {}
    for _, i, _, v in data:
        total += v
        want[i] = total
    assert got == want
    index = {r.i: r.at for r in matrix.axis_index(df, [F.col("i")], "at", slice_rows=500).collect()}
    assert index == {d[1]: d[1] for d in data}


def test_a_row_is_compared_with_few_of_many_cut_points(spark, monkeypatch):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("i"))
    monkeypatch.setattr(skew, "FAN_OUT", 4)
    out = skew.ranked(df, [], [F.col("i")], "rn", slice_rows=200)
    assert out.filter("rn <> i + 1").count() == 0 and out.count() == 20_000
    sliced = skew._slice(df, [], [F.col("i")], [(20_000,)], 200)
    assert sliced.agg(F.countDistinct("__slice").alias("n")).first().n > 200
    # About 400 cut points: five levels of four.
    assert sliced._jdf.queryExecution().analyzed().toString().count("__branch") >= 5


@pytest.mark.parametrize("slice_rows", [20, 1_000_000, None])
def test_percentiles_match_numpy(rows, slice_rows):
    df, data = rows
    q = {"q25": 0.25, "median": 0.5, "q99": 0.99}
    got = {r.k: r for r in skew.percentiles(df, ["k"], "v", q, slice_rows, {"n": F.count("v")}).collect()}
    for k in {d[0] for d in data}:
        vals = [d[3] for d in data if d[0] == k]
        assert got[k].n == len(vals)
        for name, x in q.items():
            assert got[k][name] == pytest.approx(np.quantile(vals, x), abs=1e-9)


def test_null_keys_are_a_group(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "a").alias("k"), "id")
    got = skew.ranked(df, ["k"], [F.col("id")], slice_rows=100).groupBy("k").agg(F.max("rn").alias("m"), F.countDistinct("rn").alias("n"))
    assert {(r.k, r.m, r.n) for r in got.collect()} == {("a", 500, 500), (None, 500, 500)}


def test_nest_pages_lose_nothing(rows):
    df, data = rows
    n = skew.nest(df, ["k"], [F.col("i")], ["i", "v"], "items", page_rows=64, slice_rows=300)
    got = {}
    for r in n.orderBy("k", "page").collect():
        assert len(r["items"]) <= 64 and r.offset == len(got.get(r.k, []))
        got.setdefault(r.k, []).extend(x.i for x in r["items"])
    want = {}
    for k, i, _, _ in data:
        want.setdefault(k, []).append(i)
    assert got == want
    whole = skew.nest(df, ["k"], [F.col("i")], ["i", "v"], "items")
    assert whole.columns == ["k", "items"] and {r.k: [x.i for x in r["items"]] for r in whole.collect()} == want


@pytest.mark.parametrize("page_rows", [None, 3, 10**6])
def test_pack_and_unpack_round_trip(spark, page_rows):
    long = spark.createDataFrame([(s, g, float(10 * s + g)) for s in range(4) for g in range(8)], "s int, i int, v double")
    packed = matrix.pack(long, "s", "i", "v", n_genes=8, page_rows=page_rows)
    genes = spark.createDataFrame([(g, f"g{g}") for g in range(8)], "gi int, name string")
    back = matrix.unpack(packed, "s", "values", genes, "gi", None if page_rows is None else "offset")
    assert {(r.s, r.name, r.value) for r in back.collect()} == {(s, f"g{g}", float(10 * s + g)) for s in range(4) for g in range(8)}
    with pytest.raises(Exception, match="incomplete"):
        matrix.pack(long.filter("s <> 1 or i <> 5"), "s", "i", "v", n_genes=8, page_rows=page_rows).collect()


@pytest.mark.parametrize("slice_rows", [20, 10**6])
def test_running_sum_over_nulls(spark, slice_rows):
    df = spark.range(100).select(F.lit("k").alias("k"), "id", F.when(F.col("id").isin(10, 60), 10).alias("v"))
    got = {r.id: r.s for r in skew.running(df, ["k"], [F.col("id")], {"s": F.col("v")}, slice_rows=slice_rows).collect()}
    assert got == {i: None if i < 10 else 10 if i < 60 else 20 for i in range(100)}


@pytest.mark.parametrize("page_rows", [None, 2])
def test_children_without_parent_are_refused(spark, page_rows):
    parents = spark.createDataFrame([(1,), (2,)], "p int")
    kids = spark.createDataFrame([(1, 5), (1, 6), (1, 7)], "p int, n int")
    got = resolve.nest_children(parents, kids, "p", "p", [F.col("n")], ["n"], "kids", page_rows).collect()
    assert sorted((r.p, len(r.kids)) for r in got) == ([(1, 3), (2, 0)] if page_rows is None else [(1, 1), (1, 2), (2, 0)])
    with pytest.raises(Exception, match="does not exist"):
        resolve.nest_children(parents, kids.union(spark.createDataFrame([(9, 1)], kids.schema)), "p", "p", [F.col("n")], ["n"], "kids", page_rows).collect()


def test_pick_by_takes_whole_rows(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, None)], "k int, o int, x string")
    assert {tuple(r) for r in skew.pick_by(df, ["k"], [F.col("o")]).collect()} == {(1, 1, "a"), (2, 5, None)}
    assert {tuple(r) for r in skew.pick_by(df, ["k"], [F.col("o")], last=True).collect()} == {(1, 2, "b"), (2, 5, None)}


def test_sliced_scores_equal_plain_scores(spark):
    rnd = random.Random(1)
    expr = spark.createDataFrame([(s, g, float(rnd.randrange(40))) for s in range(3) for g in range(400)], "sample_id int, gene_id int, value double")
    sets_ = spark.createDataFrame([(g, f"p{g % 7}") for g in range(0, 400, 2)], "gene_id int, pathway string")
    plain = {(r.sample_id, r.pathway): r.score_raw for r in pathway.ssgsea_scores(expr, sets_).collect()}
    sliced = {(r.sample_id, r.pathway): r.score_raw for r in pathway.ssgsea_scores(expr, sets_, slice_rows=50).collect()}
    assert plain.keys() == sliced.keys()
    assert all(plain[k] == pytest.approx(sliced[k], abs=1e-9) for k in plain)


def test_scores_take_text_gene_ids(spark):
    rnd = random.Random(6)
    data = [(s, g, f"ENSG{g:05d}", float(1 + rnd.randrange(30)) + g * 1e-12) for s in range(2) for g in range(200)]
    expr = spark.createDataFrame(data, "sample_id int, gene_id int, symbol string, value double")
    sets_ = spark.createDataFrame([(g, f"ENSG{g:05d}", f"p{g % 3}") for g in range(0, 200, 4)], "gene_id int, symbol string, pathway string")
    by_number = {(r.sample_id, r.pathway): r.score_raw for r in pathway.ssgsea_scores(expr, sets_.drop("symbol")).collect()}
    by_text = {(r.sample_id, r.pathway): r.score_raw for r in pathway.ssgsea_scores(expr.drop("gene_id"), sets_.drop("gene_id"), gene="symbol", gene_order="symbol").collect()}
    assert by_number == pytest.approx(by_text)
    # Differences below single precision are ties.
    tied = {(r.sample_id, r.pathway): r.score_raw for r in pathway.ssgsea_scores(expr.withColumn("value", F.round("value", 6)), sets_.drop("symbol")).collect()}
    assert by_number == pytest.approx(tied)


def test_sliced_deal_equals_plain_deal(spark):
    rnd = random.Random(2)
    st = ["event", "censored", "missing"]
    c = spark.createDataFrame([(f"c{i}", "hot" if i % 3 else f"p{i % 5}", rnd.choice(st), rnd.choice(st)) for i in range(1500)], "case_id string, project_id string, pfi_status string, os_status string")
    a = {r.case_id: r.fold_10 for r in folds.deal(c).collect()}
    b = {r.case_id: r.fold_10 for r in folds.deal(c.repartition(7), slice_rows=90).collect()}
    assert a == b


def test_digest_ignores_order(spark):
    a = spark.range(100).select((F.col("id") % 2).alias("g"), "id", F.md5(F.col("id").cast("string").cast("binary")).alias("m"))
    one = {tuple(r) for r in sets.source_digest(a, ["g"], "id", "m").collect()}
    two = {tuple(r) for r in sets.source_digest(a.orderBy(F.desc("id")), ["g"], "id", "m").collect()}
    assert one == two
    import hashlib
    lines = sorted(f"{i}\t{hashlib.md5(str(i).encode()).hexdigest()}\n" for i in range(0, 100, 2))
    assert (0, 50, hashlib.sha256("".join(lines).encode()).hexdigest()) in one


def test_scores_on_axis_do_not_grow_with_the_sets():
    rnd = np.random.default_rng(3)
    n = 5_000
    members = [rnd.choice(n, k, replace=False) for k in (1, 40, 900, 4_999, n)]
    block = pathway.SetBlock(list("abcde"), members, n)
    dense = pathway.SetBlock(list("abcde"), members, n)
    dense.names = range(10**9)  # So many sets that members are listed.
    for m in (0, 1, 30, 400):
        place = rnd.choice(n, m, replace=False)
        value = rnd.integers(-4, 5, m).astype(np.float32)
        assert np.allclose(block.scores(place, value), dense.scores(place, value), rtol=0, atol=1e-8, equal_nan=True)
    # Members are not read one by one: only the sums over them are at hand.
    block.places = range(len(block.places))
    assert len(block.scores(place, value)) == 5


def test_a_long_axis_is_cut_whatever_its_columns_are_called(spark):
    rnd = random.Random(7)
    expr = spark.createDataFrame([(s, g, float(rnd.randrange(-3, 9))) for s in range(3) for g in rnd.sample(range(300), 60)], "sample_id int, gene_id int, value double")
    axis = spark.range(300).select(F.col("id").cast("int").alias("gene_id"))
    sets_ = spark.createDataFrame([(g, f"p{g % 7}") for g in range(0, 300, 2)], "gene_id int, pathway string")
    scores = lambda **how: {(r.sample_id, r.pathway): (r.n_genes, r.score_raw) for r in pathway.ssgsea_scores_on_axis(expr, axis, sets_, **how).collect()}
    assert scores(slice_rows=40, memberships=50) == scores() and len(scores()) == 21
    named = spark.range(200).select(*[(F.lit(199) - F.col("id")).alias(n) for n in ("__o", "__node", "__at", "__cuts", "__branch")])
    got = skew.ranked(named, [], [F.col("__o")], "rn", 20)
    assert {tuple(r) for r in got.collect()} == {(k, k, k, k, k, k + 1) for k in range(200)}
