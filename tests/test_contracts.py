"""Tables with fixed schemas, checks that can fail."""

import pytest
from pyspark.sql import functions as F

from cohortloom.checks import quality as dq
from cohortloom.operators import matrix
from cohortloom.sinks.contracts import Contracts


def made(spark, calls):
    reg = Contracts()

    @reg.add("cases", "id bigint, x struct<a:string>")
    def _cases(_):
        calls.append("cases")
        return spark.range(3).select(F.struct(F.lit("v").alias("a")).alias("x"), "id")

    @reg.add("survival_derived", "id bigint, n int", needs=("cases", "inside"), flexible=("forms",))
    def _survival(need):
        calls.append("survival")
        return need["cases"].join(need["inside"], "id").select("id", F.lit(1).alias("n"), F.struct(F.lit(2).alias("any")).alias("forms"))

    @reg.add("inside", "id bigint", inner=True)
    def _inside(_):
        calls.append("inside")
        return spark.range(2).toDF("id")

    @reg.add("other", "id bigint")
    def _other(_):
        raise AssertionError("not wanted")

    return reg


def test_only_what_is_wanted_is_built(spark, tmp_path):
    calls = []
    reg = made(spark, calls)
    assert reg.order(["survival_derived"]) == ["cases", "inside", "survival_derived"]
    counts = reg.write(spark, str(tmp_path), ["survival_derived"])
    assert counts == {"cases": 3, "survival_derived": 2} and calls == ["cases", "inside", "survival"]
    assert sorted(f.name for f in tmp_path.iterdir()) == ["cases", "survival_derived"]
    assert spark.read.parquet(str(tmp_path / "survival_derived")).columns == ["id", "n", "forms"]
    with pytest.raises(ValueError, match="unknown tables: nope"):
        reg.write(spark, str(tmp_path), ["nope"])


def test_contracts_are_held_at_every_level(spark):
    for build in (
        lambda _: spark.range(1).select("id"), lambda _: spark.range(1).select("id", F.struct(F.lit(1).alias("a")).alias("x")),
        lambda _: spark.range(1).select("id", F.struct(F.lit("v").alias("a"), F.lit("w").alias("b")).alias("x")),
        lambda _: spark.range(1).select("id", F.struct(F.lit("v").alias("a")).alias("x"), F.lit(1).alias("more")),
    ):
        reg = Contracts()
        reg.add("cases", "id bigint, x struct<a:string>")(build)
        with pytest.raises(ValueError, match="table cases"):
            reg.build()
    reg = Contracts()
    reg.add("a", "id bigint", needs=("b",))(lambda n: n["b"])
    reg.add("b", "id bigint", needs=("a",))(lambda n: n["a"])
    with pytest.raises(ValueError, match="need each other"):
        reg.build()


def test_row_differences_names_the_rows(spark):
    want = spark.createDataFrame([(k, None if k % 5 == 0 else f"v{k}", "x") for k in range(200)] + [(3, "v3", "x")], "k int, a string, b string")
    assert dq.row_differences(want, want.repartition(7), ["k"], ["a", "b"], 8).count() == 0
    have = want.filter("k <> 17").withColumn("a", F.when(F.col("k") == 40, "was null").otherwise(F.col("a")))
    have = have.withColumn("b", F.when(F.col("k") == 60, None).otherwise(F.col("b"))).dropDuplicates().union(spark.createDataFrame([(900, "n", "x")], want.schema))
    got = {(r.key, r.kind) for r in dq.row_differences(want, have, ["k"], ["a", "b"], 8).collect()}
    assert got == {("17", "missing"), ("40", "changed"), ("60", "changed"), ("900", "extra"), ("3", "missing")}
    # A null in one column and text in the next is not the same as the other way round.
    a, b = (spark.createDataFrame([(1, *x)], "k int, a string, b string") for x in (("t", None), (None, "t")))
    assert dq.row_differences(a, b, ["k"], ["a", "b"]).collect()[0].kind == "changed"


def test_suites_by_name(spark):
    suites = dq.Suites()
    suites.add("one", *[dq.Check(f"c{k:03d}", "t", F.col("id") < 1000 - k, "id") for k in range(150)], dq.Check("many", "t", F.lit(True), "id", at_least=5000))
    df = spark.range(1000)
    rows = suites.run("one", {"t": df})
    assert rows.count() == 151 and [r.check for r in rows.filter("passed").collect()] == ["c000"]
    bad = rows.filter("check = 'c003'").first()
    assert (bad.n_checked, bad.n_bad, bad.examples) == (1000, 3, ["997"])
    with pytest.raises(ValueError) as e:
        dq.require(rows)
    assert all(f"c{k:03d}" in str(e.value) for k in range(1, 150)) and "many" in str(e.value)
    with pytest.raises(ValueError, match="unknown suite two"):
        suites.run("two", {})
    with pytest.raises(ValueError, match="no such tables: t"):
        suites.run("one", {})
    dq.require(suites.run("one", {"t": df}).filter("passed"))


def test_alignment_over_files(spark, tmp_path):
    for name, n in (("a", 3), ("b", 1)):
        spark.range(90).repartitionByRange(n, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / name))
    a, b = (dq.positions(spark, str(tmp_path / n), "id") for n in "ab")
    assert a.filter("at <> id").count() == 0
    assert dq.aligned({"a": a, "b": b}, "x", "at", "id").first().passed
    moved = b.withColumn("id", F.when(F.col("id") == 4, 5).when(F.col("id") == 5, 4).otherwise(F.col("id")))
    got = dq.aligned({"a": a, "b": moved, "c": a}, "x", "at", "id").first()
    assert (got.passed, got.n_bad, got.examples) == (False, 2, ["4:4/5", "5:4/5"])
    assert dq.aligned({"a": a, "b": b.filter("at < 89")}, "x", "at", "id").first().n_bad == 1


def test_currency_names_kinds(spark):
    old = spark.createDataFrame([("f1", "m", 1), ("f2", "m", 1), ("f3", "m", 1), ("f4", None, 1)], "id string, md5 string, v int")
    assert dq.current(old, old, "x", "id", ["md5", "v"], "md5").first().passed
    new = spark.createDataFrame([("f1", "m", 1), ("f3", "n", 1), ("f4", None, 2), ("f9", "m", 1)], old.schema)
    r = dq.current(old, new, "x", "id", ["md5", "v"], "md5").first()
    assert (r.passed, r.n_bad, r.examples) == (False, 4, ["added:f9", "changed:f3", "changed:f4", "withdrawn:f2"])


def test_matrix_build_refuses_incomplete_samples(spark):
    axis = spark.createDataFrame([("g0", 0), ("g1", 1)], "gene string, gene_index int")
    rows = spark.createDataFrame([("s", "g1", 1, 2.0), ("s", "g0", 3, 4.0), ("s", "N_x", 9, None), ("t", "g0", 5, 6.0), ("t", "g1", None, 0.0)], "sample string, gene string, n int, v double")
    got = {r["sample"]: r for r in matrix.build(rows, axis, "sample", "gene", ["n", "v"], tallies={"N_x": "x"}, tally="n", strands=("n", "v")).collect()}
    assert (got["s"].n, got["s"].v, got["s"].x, got["t"].n, got["t"].x) == ([3, 1], [4.0, 2.0], 9, [5, None], None)
    assert got["s"].strand_balance == pytest.approx(0.4)
    for bad, text in (([("u", "g0", 1, 1.0)], "incomplete sample u"), ([("s", "g0", 1, 1.0)], "incomplete sample s"), ([("s", "g7", 1, 1.0)], "gene off the axis in sample s: g7")):
        with pytest.raises(Exception, match=text):
            matrix.build(rows.union(spark.createDataFrame(bad, rows.schema)), axis, "sample", "gene", ["n", "v"], tallies={"N_x": "x"}, tally="n").collect()
