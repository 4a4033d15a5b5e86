"""Every check passes on clean data and fails on a planted fault."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.checks import quality as dq
from cohortloom.operators import compare, matrix, regions, timeline


def one(df):
    r = df.first()
    return r.passed, r.n_bad, list(r.examples)


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(0, "a", 1.0), (1, "b", 2.0), (2, "c", None)], "i int, k string, v double")


def test_rows(base):
    assert one(dq.check_rows(base, "x", F.col("i") >= 0, "k")) == (True, 0, [])
    assert one(dq.check_rows(base, "x", F.col("v") > 0, "k")) == (False, 1, ["c"])
    assert one(dq.check_rows(base.filter("i < 0"), "x", F.lit(True), "k", at_least=1))[0] is False


def test_examples_are_bounded(spark):
    r = dq.check_rows(spark.range(100), "x", F.lit(False), "id").first()
    assert r.n_bad == 100 and list(r.examples) == ["0", "1", "10", "11", "12"]


def test_same_rows(base):
    assert one(dq.same_rows(base, base, "x", ["i"], ["k", "v"])) == (True, 0, [])
    near = base.withColumn("v", F.col("v") + 1e-7)
    assert one(dq.same_rows(base, near, "x", ["i"], ["v"], 1e-6))[0] and not one(dq.same_rows(base, near, "x", ["i"], ["v"]))[0]
    filled = base.withColumn("v", F.coalesce("v", F.lit(0.0)))
    assert one(dq.same_rows(base, filled, "x", ["i"], ["v"], 1.0)) == (False, 1, ["2"])
    assert one(dq.same_rows(base, base.filter("i > 0"), "x", ["i"], ["k"])) == (False, 1, ["0"])
    assert one(dq.same_sets(base, base.filter("i < 2"), "x", "k")) == (False, 1, ["c"])
    assert one(dq.same_sets(base, base.unionByName(base), "x", "k"))[0]


def test_foreign_keys(base):
    dim = base.filter("i < 2")
    assert one(dq.foreign_keys({"t": dim, "other": base.drop("k")}, "k", dim, "x")) == (True, 0, [])
    assert one(dq.foreign_keys({"t": base}, "k", dim, "x")) == (False, 1, ["t:c"])


def test_coverage(spark):
    ref = spark.createDataFrame([("A", "u"), ("A", "u"), ("S", "u")], "ty string, url string")
    good = ref.filter("ty = 'A'")
    assert one(dq.coverage(good, ref, "x", "ty", "url", ["S"]))[0]
    assert one(dq.coverage(ref, ref, "x", "ty", "url", ["S"])) == (False, 1, ["S"])
    assert one(dq.coverage(good.withColumn("url", F.lit(None).cast("string")), ref, "x", "ty", "url", ["S"]))[0] is False
    assert one(dq.coverage(good.limit(1), ref, "x", "ty", "url", ["S"])) == (False, 1, ["A"])


def test_axis(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3, 4])], "i int, v array<int>")
    assert one(dq.axis(df, "i", "x", F.size("v"), 2))[0]
    assert one(dq.axis(df, "i", "x", F.size("v"), 3))[0] is False
    assert one(dq.axis(df.withColumn("i", F.col("i") * 2), "i", "x")) == (False, 1, ["2"])
    assert one(dq.axis(df.withColumn("i", F.lit(0)), "i", "x"))[0] is False


def test_faults_unique_share(base):
    faults = {"neg": F.col("v") < 0, "null": F.col("v").isNull()}
    assert one(dq.no_faults(base, "x", "k", faults)) == (False, 1, ["null:c"])
    assert one(dq.unique(base, "x", "k"))[0] and not one(dq.unique(base.unionByName(base.limit(1)), "x", "k"))[0]
    assert one(dq.share_at_most(base, "x", F.col("i") == 0, 0.5))[0] and not one(dq.share_at_most(base, "x", F.col("i") == 0, 0.1))[0]
    assert one(dq.one_value(base.withColumn("d", F.lit("z")), "x", "k", "d"))[0]
    assert one(dq.one_value(base.withColumn("d", F.col("k")), "x", "k", "d")) == (False, 2, ["b", "c"])


def test_hashes(spark):
    content = spark.createDataFrame([("a", b"one")], "f string, content binary")
    md5 = lambda b: spark.createDataFrame([("a", hashlib.md5(b).hexdigest())], "f string, m string")
    assert one(dq.rehash(content, md5(b"one"), "x", "f", "m"))[0] and not one(dq.rehash(content, md5(b"two"), "x", "f", "m"))[0]
    sha = lambda b: {"a": hashlib.sha256(b).hexdigest()}
    assert one(dq.pinned(content, "x", "f", sha(b"one")))[0] and not one(dq.pinned(content, "x", "f", sha(b"two")))[0]
    assert not one(dq.pinned(content.withColumn("f", F.lit("unlisted")), "x", "f", sha(b"one")))[0]


def test_suite_and_gate(base):
    ok = dq.check_rows(base, "fine", F.lit(True), "k")
    bad = dq.check_rows(base, "broken", F.col("i") > 0, "k")
    assert tuple(dq.gate(dq.suite([ok, bad])).first()) == (False, 2, 1, ["broken"])
    dq.require(dq.suite([ok, ok]))
    with pytest.raises(ValueError, match="broken"):
        dq.require(dq.suite([ok, bad]))


def test_schema_contract(base):
    dq.schema_contract(base, base.schema)
    with pytest.raises(ValueError, match="unknown v"):
        dq.schema_contract(base, T.StructType().add("i", T.IntegerType()).add("k", T.StringType()))


def test_matrix_guards(spark, base):
    with pytest.raises(Exception, match="incomplete sample"):
        matrix.pack(base, "k", "i", "v", n_genes=2).collect()
    wide = spark.createDataFrame([("g1", "1.5", "NA"), ("g2", "", "-2")], "gene string, `s.1` string, s2 string")
    got = {(r.gene, r.sample): r.value for r in matrix.wide_to_long(wide, ["gene"]).collect()}
    assert got == {("g1", "s.1"): 1.5, ("g2", "s2"): -2.0}
    assert matrix.wide_to_long(wide, ["gene"], keep_absent=True).count() == 4
    with pytest.raises(Exception, match="not a number"):
        matrix.wide_to_long(wide.withColumn("s2", F.lit("x")), ["gene"]).collect()
    back = matrix.unpack(matrix.pack(base, "k", "i", "v"), "k", "values", base.select(F.col("i").alias("g")), "g")
    assert back.count() == 3


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_segments_at(spark, width):
    segs = [("chr1", 0, 10, 1), ("1", 10, 25, 2), ("chrX", 5, 5, 3)]
    pos = [("1", 10), ("chr1", 11), ("X", 5), ("2", 5), ("chr1", 26)]
    s = spark.createDataFrame(segs, "chromosome string, start int, end int, cn int")
    p = spark.createDataFrame(pos, "chromosome string, at int")
    got = sorted((r.at, r.cn) for r in regions.segments_at(p, s, [], "chromosome", "at", bin_width=width).collect())
    bare = lambda c: c.removeprefix("chr")
    assert got == sorted((a, n) for c, a in pos for d, lo, hi, n in segs if bare(c) == bare(d) and lo <= a <= hi)


def test_agreement_classes(spark):
    rows = [(None, None, None, None, "both_na"), (None, None, 1, 5.0, "der_pop_cdr_na"), (1, 5.0, None, None, "cdr_pop_der_na"),
            (1, 5.0, 1, 5.4, "match"), (1, 5.0, 1, 5.5, "mismatch"), (1, None, 1, None, "match"), (1, 5.0, 0, 5.0, "mismatch")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, ce int, ct double, de int, dt double, want string")
    c = [F.col(x) for x in ("ce", "ct", "de", "dt")]
    out = df.select("want", compare.classify(*c).alias("got"), compare.within_days(*c, 30.0).alias("near")).collect()
    assert all(r.want == r.got for r in out)
    near = df.sparkSession.createDataFrame([(1, 10.0, 1, 40.0), (1, 10.0, 1, 41.0)], "ce int, ct double, de int, dt double")
    assert sorted(r[0] for r in near.select(compare.within_days(*c, 30.0)).collect()) == [False, True]


def test_timeline_drops_undated(spark):
    cases = spark.createDataFrame([("a", 5, "Dead"), ("b", None, "Alive")], "case_id string, d int, v string")
    out = timeline.timeline([timeline.events_of(cases, [timeline.Event("death", F.col("d"), F.col("v"), "closing"), timeline.Event("consent", F.lit(-3), F.lit("x"), "opening")])])
    assert [(r.case_id, r.day, r.category) for r in out.orderBy("case_id", *timeline.READING).collect()] == [("a", -3.0, "consent"), ("a", 5.0, "death"), ("b", -3.0, "consent")]


def test_foreign_keys_need_no_join(spark):
    a = spark.createDataFrame([(1,), (1,), (9,), (None,)], "id bigint")
    b = spark.createDataFrame([(2,), (9,)], "id bigint")
    dim = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id bigint")
    out = dq.foreign_keys({"a": a, "b": b, "none": spark.range(2).toDF("x")}, "id", dim, "fk")
    r = out.first()
    # Distinct ids: 1, 9 and null of the first, 2 and 9 of the second; a null is no key, even if the dimension has one.
    assert (r.n_checked, r.n_bad, r.passed, r.examples) == (5, 3, False, ["a:9", "b:9"])
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
