"""Real files in, real files out."""

import gzip
import hashlib
import json
import random
import tarfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions import scalars as sc
from cohortloom.operators import resolve, shards, tree
from cohortloom.sinks import writer
from cohortloom.sources import catalog, splits
from cohortloom.sources import text as tx
from cohortloom.sources import typed as ty
from cohortloom.sources.trees import read_case_tree


def lines_of(spark, body, order="no"):
    return spark.createDataFrame(list(enumerate(body.split("\n"))), f"{order} int, line string")


def test_case_tree_scan(spark, tmp_path):
    doc = [
        {"case_id": "a", "samples": [{"sample_id": "s1", "portions": [{"portion_id": "p", "analytes": [{"analyte_id": "n", "aliquots": [{"aliquot_id": "x"}, {"aliquot_id": "y"}]}]}]}, {"sample_id": "s2"}]},
        {"case_id": "b"},
    ]
    (tmp_path / "cases.json").write_text(json.dumps(doc))
    schema = "case_id string, demographic struct<vital_status string>, samples array<struct<sample_id string, portions array<struct<portion_id string, analytes array<struct<analyte_id string, aliquots array<struct<aliquot_id string>>>>>>>>"
    df = read_case_tree(spark, str(tmp_path / "cases.json"), schema)
    levels = [("samples", ["sample_id"]), ("portions", ["portion_id"]), ("analytes", ["analyte_id"]), ("aliquots", ["aliquot_id"])]
    rows = tree.explode_tree(df, ["case_id"], levels)
    assert {(r.case_id, r.sample_id, r.aliquot_id) for r in rows.collect()} == {("a", "s1", "x"), ("a", "s1", "y"), ("a", "s2", None), ("b", None, None)}
    assert tree.leaf_dim(rows, "aliquot_id", ["pos"]).count() == 2
    assert df.filter("demographic is null").count() == 2


def test_delimited_file(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("# gene-model: x\ngene_id\tgene_name\tvalue\nN_unmapped\t\t7\nN_ambiguous\t\t2\nE1\tA\t1.0\nE2\tB\tbad\nE3\t\t\n")
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as f:
        f.write("gene_id\tgene_name\tvalue\r\nE1\tA\t5\r\n")
    df = splits.read_delimited(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv.gz")], ["gene_id", "gene_name", "value"])
    df = tx.coerce(df, ["value"])
    genes = {(r.file_name, r.gene_id, r.gene_name, r.value) for r in tx.gene_rows(df).collect()}
    assert genes == {("a.tsv", "E1", "A", 1), ("a.tsv", "E2", "B", None), ("a.tsv", "E3", None, None), ("b.tsv.gz", "E1", "A", 5)}
    q = {r.file_name: r for r in tx.summary_rows(df, ["file_name"], "value").collect()}
    assert q["a.tsv"].N_unmapped == 7 and q["a.tsv"].N_noFeature is None


def test_headers_are_read_by_name_per_file(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("#c\na\tb\n1\t2\n#x\t4\na\tb\n")
    (tmp_path / "b.tsv").write_text("b\textra\ta\n2\t-\t1\n\t\t9\n")
    got = splits.read_delimited(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")], ["a", "b"]).drop("at")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("a.tsv", "1", "2"), ("a.tsv", "#x", "4"), ("a.tsv", "a", "b"), ("b.tsv", "1", "2"), ("b.tsv", "9", None)], key=repr)
    with pytest.raises(Exception, match="no column z"):
        splits.read_delimited(spark, str(tmp_path / "a.tsv"), ["a", "z"]).collect()


@pytest.mark.parametrize(("range_bytes", "block"), [(1, 1), (7, 3), (64, 1 << 20), (1 << 26, 5)])
def test_every_line_is_read_once(spark, tmp_path, monkeypatch, range_bytes, block):
    monkeypatch.setattr(splits, "BLOCK_BYTES", block)
    monkeypatch.setattr(splits, "LEAD_BYTES", 4)
    rnd = random.Random(range_bytes)
    want = []
    for k in range(4):
        lines = [[f"{k}-{i}", "é" * rnd.randrange(9), rnd.choice(["", "NA", "x y"])] for i in range(30)]
        text = "# top\n#\nid\tword\tnote\n" + "\n".join("\t".join(x) + rnd.choice(["", "\r"]) + rnd.choice(["", "", "\n"]) for x in lines)
        (tmp_path / f"f{k}.tsv").write_bytes((text + ("\n" if k % 2 else "")).encode())
        want += [(f"f{k}.tsv", i, w or None, None if n in ("", "NA") else n) for i, w, n in lines]
    (tmp_path / "empty.tsv").write_text("")
    (tmp_path / "top.tsv").write_text("#only\n")
    (tmp_path / "bare.tsv").write_text("id\tword\tnote")
    got = splits.read_delimited(spark, str(tmp_path), ["note", "id", "word"], nulls=("", "NA"), range_bytes=range_bytes, rename={"note": "n"})
    rows = got.collect()
    assert sorted((r.file_name, r.id, r.word or "", r.n or "") for r in rows) == sorted((f, i, w or "", n or "") for f, i, w, n in want)
    by_place = [r.id for r in sorted(rows, key=lambda r: (r.file_name, r["at"]))]
    assert by_place == [w[1] for w in want]


def test_files_without_header(spark, tmp_path):
    (tmp_path / "b.txt").write_text("cg1\t0.5\n#cg2\tNA\ncg3\n")
    got = splits.read_delimited(spark, str(tmp_path), ["probe", "beta"], header=["probe", "beta"], nulls=("NA",))
    assert [(r.probe, r.beta) for r in got.orderBy("at").collect()] == [("cg1", "0.5"), ("#cg2", None), ("cg3", None)]


def test_line_order_is_file_order(spark, tmp_path):
    (tmp_path / "x.txt").write_text("\n".join(str(i) for i in range(500)))
    got = [r.line for r in tx.read_lines(spark, str(tmp_path / "x.txt")).orderBy("block", "seq").collect()]
    assert got == [str(i) for i in range(500)]


def test_forms(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes("id\tnote\tx\na\tb\tc\nCDE\tCDE\tCDE\n1\tna\xefve \x96\t3\r\n\t\t\n2\t\"q \"\"r\"\" s\"\n".encode("latin-1"))
    (tmp_path / "short.txt").write_text("id\na\nCDE\n")
    got = {(r.file_name, r.row, r.column): r.value for r in tx.read_forms(spark, str(tmp_path)).collect()}
    assert got["f.txt", 0, "note"] == "na\xefve \x96" and got["f.txt", 0, "x"] == "3"
    assert got["f.txt", 2, "note"] == 'q "r" s' and got["f.txt", 2, "x"] == ""
    assert {k[0] for k in got} == {"f.txt"} and {k[1] for k in got} == {0, 2}


def test_forms_are_read_as_csv(spark):
    body = 'id\tnote\nx\ty\nCDE\tCDE\n1\t"p\tq"\n2\t"two\nlines ""x"""\n3\t5" pipe "a"\n4\t"" rest\n\n5\t"open\nend'
    files = spark.createDataFrame([("f", body.encode("latin-1"))], "file_name string, content binary")
    got = [(r.row, r.column, r.value) for r in tx.multi_header(files, "file_name").orderBy("row", "column").collect()]
    assert [v for _, k, v in got if k == "note"] == ["p\tq", 'two\nlines "x"', '5" pipe "a"', " rest", "open\nend"]
    assert [v for _, k, v in got if k == "id"] == list("12345")


def test_gene_sets(spark):
    body = "S1\turl\tA\tB\tA\nS2\turl\nS1\turl\tC\t\nS3\turl\tD"
    got = sorted((r.pathway, r.gene) for r in tx.gene_sets(lines_of(spark, body), ["no"]).collect())
    assert got == [("S1", "C"), ("S3", "D")]


def test_binary_documents(spark, tmp_path):
    (tmp_path / "d.pdf").write_bytes(b"%PDF-1")
    files = spark.read.format("binaryFile").load(str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")
    manifest = spark.createDataFrame([("d.pdf", "u1", hashlib.md5(b"%PDF-1").hexdigest())], "file_name string, uuid string, md5sum string")
    r = tx.binary_documents(files, manifest, "file_name").first()
    assert (r.uuid, r.n_bytes, r.md5_bytes) == ("u1", 6, r.md5sum)


@pytest.mark.parametrize("v,whole,exact", [
    ("7", True, True), ("-12", True, True), ("-0", False, True), ("007", False, False), (".5", False, False), ("1.", False, True), ("1.50", False, True),
    ("-4e-04", False, True), ("0.1", False, True), ("123456789012345678", True, False), ("0.12345678901234567890", False, False), ("1e400", False, False),
    ("99999999999999999999", False, False), ("NA", False, False), ("1.5x", False, False), ("100000000000000000000", False, True), ("1e-400", False, False), ("1.23456789012345e-310", False, False), ("0.000", False, True),
])
def test_lossless_numbers(spark, v, whole, exact):
    r = spark.createDataFrame([(v,)], "v string").select(ty.is_int(F.col("v")).alias("w"), ty.is_exact_float(F.col("v")).alias("e")).first()
    assert (bool(r.w), bool(r.e)) == (whole, exact)


def test_study_table(spark):
    body = "#Id\tScore\n#d\td\n#STRING\tNUMBER\n#1\t1\nPATIENT_ID\tGLEASON\nP1\t7\nP2\t\nP3\t-4e-04"
    df = ty.read_study_table(lines_of(spark, body), "clinical_patient", ["no"])
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "double"]
    assert df.schema["GLEASON"].metadata["display_name"] == "Score"
    assert [d[0] for d in ty.dictionary(df)] == ["PATIENT_ID", "GLEASON"]
    kept = ty.read_study_table(lines_of(spark, body + "\n#P4\t5\nPATIENT_ID\t6"), "clinical_patient", ["no"])
    assert [r.PATIENT_ID for r in kept.collect()] == ["P1", "P2", "P3", "#P4", "PATIENT_ID"]
    plain = ty.read_study_table(lines_of(spark, "a\tb.c\n1\tX\n2\t17"), "mutations", ["no"])
    assert dict(plain.dtypes) == {"a": "bigint", "b.c": "string"}
    assert dict(ty.read_study_table(lines_of(spark, "g\ts1\nA\t-1"), "cna", ["no"]).dtypes)["s1"] == "string"
    for bad, message in [("a\ta\n1\t2", "duplicate"), ("a\tb\n1", "cells other than"), ("#x\na\n1", "expected 0 or 4"), ("#a\n#a\n#NUMBER\n#1\na\nx", "non-numbers"), ("#a\n#a\n#DATE\n#1\na\nx", "unknown declared")]:
        with pytest.raises(ValueError, match=message):
            ty.read_study_table(lines_of(spark, bad), "clinical_patient", ["no"])


def test_typed_sheet(spark):
    ok = spark.createDataFrame([("1", "5", "a"), ("2", "#N/A", "b")], "no string, x string, y string")
    assert dict(ty.typed_sheet(ok, "no").dtypes) == {"x": "int", "y": "string"}
    for rows, message in [([("1", "5", "a"), ("2", "q", "b")], "mixed"), ([("1", "5", "a"), ("3", "6", "b")], "row number"), ([("1", "#REF!", "a")], "error cells")]:
        with pytest.raises(ValueError, match=message):
            ty.typed_sheet(spark.createDataFrame(rows, "no string, x string, y string"), "no")


def test_schema_contract():
    want = T.StructType().add("a", T.LongType()).add("n", T.ArrayType(T.StructType().add("x", T.StringType())))
    have = T.StructType().add("a", T.StringType()).add("n", T.ArrayType(T.StructType().add("x", T.StringType()).add("y", T.LongType()))).add("z", T.LongType())
    assert ty.schema_differences(want, want) == []
    assert ty.schema_differences(have, want) == ["type a: string is not bigint", "unknown n.y", "unknown z"]


def test_write_and_partial_rebuild(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(300).select("id", (F.col("id") % 3).cast("string").alias("project_id"))
    assert writer.write_table(df, path, "nested", partition_by="project_id") == 300
    new = spark.createDataFrame([(999, "1")], "id bigint, project_id string")
    writer.write_table(new, path, "nested", partition_by="project_id", only_named_partitions=True)
    assert spark.read.parquet(path).count() == 201
    import pyarrow.parquet as pq
    f = pq.ParquetFile(sorted((tmp_path / "t" / "project_id=0").glob("*.parquet"))[0])
    assert f.metadata.row_group(0).num_rows <= 50 and f.metadata.row_group(0).column(0).compression == "ZSTD"
    assert writer.write_table(df.filter("id < 0"), str(tmp_path / "none"), skip_empty=True) == 0 and not (tmp_path / "none").exists()
    assert writer.write_folds(df.withColumns({"fold_10": F.lit(1), "fold_5": F.lit(1)}), str(tmp_path / "folds")) == 300
    assert dict(spark.read.parquet(str(tmp_path / "folds")).dtypes)["fold_10"] == "tinyint"
    assert writer.write_bundle({"a": df, "b": new}, str(tmp_path / "bundle")) == {"a": 300, "b": 1}
    writer.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 300


def test_pinned_source(spark, tmp_path):
    (tmp_path / "s.bin").write_bytes(b"abc")
    writer.require_pinned(spark, str(tmp_path / "s.bin"), writer.pin(b"abc"))
    with pytest.raises(ValueError, match="not the pinned"):
        writer.require_pinned(spark, str(tmp_path / "s.bin"), writer.pin(b"abd"))


def test_registry_builds_only_what_is_wanted(spark):
    reg, calls = writer.TableRegistry(), []

    @reg.table("cases")
    def cases(_):
        calls.append("cases")
        return spark.range(1)

    @reg.table("survival_derived", needs=("cases",))
    def survival(needs):
        calls.append("survival")
        return needs["cases"]

    @reg.table("files")
    def files(_):
        calls.append("files")
        return spark.range(2)

    assert set(reg.build(["survival_derived"])) == {"cases", "survival_derived"} and calls == ["cases", "survival"]
    with pytest.raises(ValueError, match="unknown tables: nope"):
        reg.build(["nope"])


def brute_plan(sizes, target):
    shard, written, out = 0, 0, []
    for i, s in enumerate(sizes):
        if i and written >= target:
            shard, written = shard + 1, 0
        out.append(shard)
        written += s
    return out


@pytest.mark.parametrize(("chunk_shards", "group_chunks"), [(1, 2), (1, 3), (2, 1), (3, 4), (64, 1000)])
def test_shard_plan_is_the_sequential_fold(spark, chunk_shards, group_chunks):
    import random
    rnd = random.Random(9)
    sizes = {p: [rnd.choice([0, 0, 1, 5, 40, 300]) for _ in range(n)] for p, n in (("A", 150), ("B", 9), ("C", 1), ("D", 80))}
    sizes["E"] = [20] * 50
    sizes["F"] = [0] * 20
    sizes["G"] = [5000, 1, 1, 5000, 7]
    df = spark.createDataFrame([(p, f"{i:04d}", s) for p, ss in sizes.items() for i, s in enumerate(ss)], "p string, k string, s bigint")
    df = df.withColumn("s", F.when(F.col("s") > 0, F.col("s")))
    got = {}
    for r in shards.shard_plan(df, "p", "k", "s", 60, chunk_shards, group_chunks, slice_rows=40).orderBy("p", "k").collect():
        got.setdefault(r.p, []).append(r.shard)
    assert got == {p: brute_plan(ss, 60) for p, ss in sizes.items()}
    assert shards.shard_plan(df.limit(0), "p", "k", "s", 60).count() == 0


def test_archives_are_whole_or_absent(spark, tmp_path):
    rows = spark.createDataFrame([("A", k // 3, f"c{k}", f"m{k}", False, b"x" * k) for k in range(9)], "p string, shard bigint, case string, member string, gzipped boolean, content binary")
    index = shards.write_shards(rows, str(tmp_path / "ok"), "p", "case")
    times = {f: f.stat().st_mtime_ns for f in (tmp_path / "ok").rglob("*")}
    assert index.count() == 9 and [r.n for r in index.groupBy("tar").agg(F.count("*").alias("n")).collect()] == [3, 3, 3]
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "ok").rglob("*")} == times
    assert sorted(f.name for f in (tmp_path / "ok" / "A").iterdir()) == ["a-000000.tar", "a-000001.tar", "a-000002.tar"]
    assert not [f for f in (tmp_path / "ok").iterdir() if "staging" in f.name]
    broken = rows.drop("content").withColumn("path", F.when(F.col("case") == "c7", str(tmp_path / "none")).otherwise(str(tmp_path / "ok" / "A" / "a-000000.tar")))
    with pytest.raises(Exception):
        shards.write_shards(broken, str(tmp_path / "bad"), "p", "case")
    assert not [f for f in (tmp_path / "bad").rglob("*") if f.is_file()]
    assert shards.write_shards(rows.limit(0), str(tmp_path / "empty"), "p", "case").count() == 0


def test_files_index_refuses_files_without_shard(spark):
    plan = spark.createDataFrame([("A", "c1", 0)], "p string, case string, shard bigint")
    files = spark.createDataFrame([("c1", "f1", "m1"), ("c1", "f2", "m2")], "case string, file_id string, member string")
    got = shards.files_index(files, plan, "p", "case", "file_id", []).collect()
    assert sorted((r.p, r.file_id, r.shard) for r in got) == [("A", "f1", "data/A/a-000000.tar"), ("A", "f2", "data/A/a-000000.tar")]
    with pytest.raises(Exception, match="no shard holds case c9"):
        shards.files_index(files.withColumn("case", F.lit("c9")), plan, "p", "case", "file_id", []).collect()


def test_tar_shards(spark, tmp_path):
    files = spark.createDataFrame(
        [("A", 0, "c1", "m", "f1", "x.txt", b"one"), ("A", 0, "c2", "m", "f2", "x.maf.GZ", b"two"), ("A", 1, "c3", "m", "f3", "x.tsv", b"three")],
        "p string, shard bigint, case string, data_type string, file_id string, file_name string, content binary",
    )
    rows = shards.members(files, "case", "data_type", "file_id", "file_name")
    out = {r.member: r for r in shards.write_shards(rows, str(tmp_path), "p", "case").collect()}
    assert set(out) == {"c1.m.f1.txt.gz", "c2.m.f2.maf.gz", "c3.m.f3.tsv.gz"}
    assert out["c2.m.f2.maf.gz"].md5sum == out["c2.m.f2.maf.gz"].md5sum_member == hashlib.md5(b"two").hexdigest()
    with tarfile.open(tmp_path / "A" / "a-000000.tar") as t:
        assert t.getnames() == ["c1.m.f1.txt.gz", "c2.m.f2.maf.gz"] and gzip.decompress(t.extractfile("c1.m.f1.txt.gz").read()) == b"one"
    first = (tmp_path / "A" / "a-000000.tar").read_bytes()
    shards.write_shards(rows, str(tmp_path), "p", "case").collect()
    assert (tmp_path / "A" / "a-000000.tar").read_bytes() == first
    assert not list(tmp_path.rglob("*.tmp"))
    by_path = rows.drop("content").withColumn("path", F.lit(str(tmp_path / "A" / "a-000000.tar")))
    assert shards.write_shards(by_path, str(tmp_path / "again"), "p", "case").count() == 3


def test_guards(spark):
    kids = spark.createDataFrame([(1, 9)], "id int, parent int")
    parents = spark.createDataFrame([(1,)], "pid int")
    with pytest.raises(ValueError, match="does not exist"):
        resolve.refuse_orphans(parents, kids, "pid", "parent")
    empty = kids.filter("id < 0")
    resolve.require_both_or_neither(empty, empty)
    with pytest.raises(ValueError, match="half is empty"):
        resolve.require_both_or_neither(kids, empty)
    with pytest.raises(Exception, match="not in manifest"):
        resolve.with_provenance(kids, spark.createDataFrame([(5, "m")], "id int, md5 string"), "id", ["md5"]).collect()
    with pytest.raises(ValueError, match="unknown filter operator"):
        resolve.clause_column({"op": "!=", "content": {"field": "x", "value": 1}})


def test_scalars(spark):
    df = spark.createDataFrame([("data_cna_hg19.seg", "A.B.GZ", " ab "), ("data_x.txt", "plain", "")], "m string, f string, v string")
    r = df.select(sc.config_name(F.col("m")).alias("c"), sc.file_suffix(F.col("f")).alias("s"), sc.is_populated(F.col("v")).alias("p")).collect()
    assert [tuple(x) for x in r] == [("cna_hg19_seg", "b.gz", True), ("x", "dat", False)]


def test_catalog(spark, tmp_path):
    meta = {"display_name": "Id", "description": "d", "datatype": "STRING", "priority": "1"}
    df = spark.range(5).select(F.col("id").alias("PATIENT_ID", metadata=meta), (-F.col("id")).alias("x.y"))
    root = str(tmp_path / "study")
    writer.write_bundle({"clinical_patient": df, "timeline_labs": df, "timeline_surgery": df}, root)
    assert catalog.configs(spark, root) == ["clinical_patient", "timeline_labs", "timeline_surgery"]
    assert catalog.timelines(spark, root) == ["timeline_labs", "timeline_surgery"]
    back = catalog.table(spark, root, "clinical_patient", ["PATIENT_ID"])
    assert back.columns == ["PATIENT_ID"] and ty.dictionary(back)[0][2:] == ("Id", "d", "STRING", "1")
    assert [r["x.y"] for r in catalog.patients(catalog.table(spark, root, "timeline_labs"), "PATIENT_ID")] == [0, -1, -2, -3, -4]
    files = [r.file for r in catalog.listing(spark, root).collect()]
    assert files and all(f.split("/")[0] in ("clinical_patient", "timeline_labs", "timeline_surgery") for f in files)


def test_flat_assays_are_listed_by_tasks_and_never_broadcast(spark, tmp_path):
    from cohortloom.operators import assays as ay

    for i in (1, 2, 3):
        (tmp_path / f"file=iso_{i}" / "deep").mkdir(parents=True)
        (tmp_path / f"file=iso_{i}" / "deep" / "part.txt").write_text("\t".join(ay.ISOFORM) + "\n" + f"mir-{i}\tx:{i}\t{i}.0\t0.5\tY\tmature\n")
        (tmp_path / f"file=iso_{i}" / "_SUCCESS").write_text("")
    entity = F.array(F.struct(F.concat(F.lit("al-"), "id").alias("entity_id"), F.lit("AB").alias("entity_submitter_id"), F.lit("aliquot").alias("entity_type")))
    ids = spark.range(1, 5).select(F.col("id").cast("string").alias("id"))
    manifest = ids.select(F.concat(F.lit("iso_"), "id").alias("file_name"), F.concat(F.lit("f-"), "id").alias("file_id"), F.lit("c").alias("case_id"), F.lit("w").alias("workflow_type"), entity.alias("entities"))
    aliquots = ids.filter("id <> '3'").select(
        F.lit("c").alias("case_id"), F.lit("C").alias("case_submitter_id"), F.lit("s").alias("sample_id"), F.lit("S").alias("sample_submitter_id"), F.lit("t").alias("sample_type"),
        F.concat(F.lit("al-"), "id").alias("aliquot_id"), F.lit("AB").alias("aliquot_submitter_id"),
    )
    out = ay.isoforms(spark, str(tmp_path), manifest, aliquots, name=r"file=([^/]+)/", under="file=")
    got = {r.mirna_id: (r.aliquot_id, r.sample_id, r.source_file_id, r.read_count) for r in out.collect()}
    # The fourth file is not there.
    assert got == {"mir-1": ("al-1", "s", "f-1", 1), "mir-2": ("al-2", "s", "f-2", 2), "mir-3": ("al-3", None, "f-3", 3)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "binaryFile" not in plan


def test_texts_of_many_names_are_plain_files_whatever_the_batches(spark, tmp_path):
    from cohortloom.sinks.texts import NAMELESS, write_texts

    rows = [(f"n{i % 7}", f"{i}\tä") for i in range(100)] + [(None, "x"), ("empty", None), ("empty", "")]
    df = spark.createDataFrame(rows, "file string, line string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        # A second run puts its files in the place of the first one's.
        counts = [write_texts(df, f"file://{tmp_path}/out", "#c\nid\tw\n", "file=") for _ in range(2)]
        nothing = write_texts(df.limit(0), f"file://{tmp_path}/none")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert counts == [9, 9] and nothing == 0 and not list((tmp_path / "none").iterdir())
    want = {}
    for name, line in rows:
        want.setdefault(f"file={name or NAMELESS}", []).append(line or "")
    got = {p.name: p.read_text().split("\n") for p in (tmp_path / "out").iterdir()}
    assert all(v[:2] == ["#c", "id\tw"] and v[-1] == "" for v in got.values())
    assert {k: sorted(v[2:-1]) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_files_of_flat_assays_are_one_plain_file_each(spark, tmp_path, monkeypatch):
    from cohortloom.plans import q_assays
    from cohortloom.plans.views import Tables

    monkeypatch.setattr(q_assays, "shared_dir", lambda spark, purpose: str(tmp_path / purpose))
    rows = spark.range(40).select(F.concat(F.lit("a_"), (F.col("id") % 4).cast("string")).alias("file"), F.col("id").cast("string").alias("line"))
    path = q_assays.write_files(Tables(spark, "none"), rows, "id", "some")
    found = sorted(Path(path).rglob("*"))
    assert [p.name for p in found] == [f"file=a_{i}" for i in range(4)] and all(p.is_file() for p in found)


@pytest.mark.parametrize("small", [1 << 20, 60, 0])
def test_small_files_are_cut_together_and_listed_by_all_tasks(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(splits, "SMALL_BYTES", small)
    want = []
    for i in range(60):
        head = "id\tw" if i % 3 else "w\tx\tid"
        lines = [(f"{i}.{k}", f"w{k % 2}") for k in range(i % 5)]
        cells = [f"{a}\t{b}" if i % 3 else f"{b}\t\t{a}" for a, b in lines]
        body = "\n\n".join(cells) + ("\r\n" if i % 2 and lines else "")
        (tmp_path / f"file=f{i}").write_bytes((f"# {'c' * i}\n{head}\n" + body).encode())
        at = len(f"# {'c' * i}\n{head}\n")
        for (a, b), cell in zip(lines, cells, strict=True):
            want.append((f"f{i}", at, a, b))
            at += len(cell) + 2
    names = spark.range(70).select(F.concat(F.lit(f"{tmp_path}/file=f"), F.col("id").cast("string")).alias("path"))
    how = {"name": r"file=([^/]+)$"}
    assert sorted(map(tuple, splits.read_delimited(spark, names, ["id", "w"], **how).collect())) == sorted(want)
    values = splits.read_delimited(spark, names, ["w"], distinct=True, **how)
    assert {tuple(r) for r in values.collect()} == {(f, w) for f, _, _, w in want} and values.columns == ["file_name", "w"]
    assert splits._listed(names, 5).select(F.spark_partition_id()).distinct().count() == 5
    with pytest.raises(Exception, match="no column x"):
        splits.read_delimited(spark, names, ["x"], **how).collect()


def test_gene_level_files_meet_their_aliquots_in_shuffles(spark, tmp_path):
    from cohortloom.operators import assays as ay

    (tmp_path / "gene").mkdir()
    (tmp_path / "allele").mkdir()
    for i in (1, 2):
        (tmp_path / "gene" / f"g{i}").write_text("\t".join(["gene_id", *ay.GENE_LEVEL_VALUES]) + f"\nE{i}\t{i}.0\t1\t\n")
    # The second file's rows name two aliquots, so its pair stays open.
    (tmp_path / "allele" / "a1").write_text("# c\nGDC_Aliquot\nt1\nt1\n\n")
    (tmp_path / "allele" / "a2").write_text("GDC_Aliquot\nt2\nn2")
    entity = lambda p: F.struct(F.concat(F.lit(p), "id").alias("entity_id"), F.concat(F.lit(p.upper()), "id").alias("entity_submitter_id"), F.lit("aliquot").alias("entity_type"))
    ids = spark.range(1, 3).select(F.col("id").cast("string").alias("id"))
    files = [
        ids.select(F.concat(F.lit(p), "id").alias("file_name"), F.concat(F.lit(f"f-{p}"), "id").alias("file_id"), F.lit("c").alias("case_id"), F.lit("w").alias("workflow_type"),
                   F.lit("s").alias("experimental_strategy"), F.lit("p").alias("platform"), F.array(entity("n"), entity("t")).alias("entities")) for p in "ga"
    ]
    aliquots = ids.select(
        F.lit("c").alias("case_id"), F.lit("C").alias("case_submitter_id"), F.lit("s").alias("sample_id"), F.lit("S").alias("sample_submitter_id"), F.lit("t").alias("sample_type"),
        F.concat(F.lit("t"), "id").alias("aliquot_id"), F.concat(F.lit("T"), "id").alias("aliquot_submitter_id"),
    )
    out = ay.gene_level(spark, str(tmp_path / "gene"), files[0].unionByName(files[1]), aliquots, str(tmp_path / "allele"), under="")
    got = [(r.gene_id, r.aliquot_id, r.sample_id, r.matched_normal_aliquot_id, r.source_file_id, r.copy_number, r.max_copy_number) for r in out.collect()]
    assert got == [("E1", "t1", "s", "n1", "f-g1", 1, None)]
    # Files with their own values, pairs with their tumors, aliquots, measurements.
    assert out._jdf.queryExecution().sparkPlan().toString().count("ShuffledHashJoin") == 4
