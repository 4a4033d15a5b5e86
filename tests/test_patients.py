"""Whole patient rows."""

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import patients as pt


def test_lists_are_nested_in_order(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (3, "again")], "id int, name string")
    kids = spark.createDataFrame([(1, 5, "x"), (1, 2, "y"), (3, 1, None)], "parent int, t int, v string")
    other = spark.createDataFrame([(2, "z")], "parent int, w string")
    out = pt.nest_lists(parents, "id", {"kids": pt.Children(kids, "parent", [F.col("t")], ["t", "v"]), "other": pt.Children(other, "parent", [F.col("w")], ["w"])})
    got = sorted(((r.id, r.name, [tuple(k) for k in r.kids], [tuple(k) for k in r.other]) for r in out.collect()), key=repr)
    assert out.columns == ["id", "name", "kids", "other"]
    assert got == [(1, "a", [(2, "y"), (5, "x")], []), (2, "b", [], [("z",)]), (3, "again", [(1, None)], []), (3, None, [(1, None)], [])]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    with pytest.raises(Exception, match="children refer to a id that does not exist: 9"):
        pt.nest_lists(parents, "id", {"kids": pt.Children(kids.withColumn("parent", F.lit(9)), "parent", [F.col("t")], ["t"])}).collect()
    assert pt.nest_lists(parents.limit(0), "id", {"kids": pt.Children(kids.limit(0), "parent", [F.col("t")], ["t"])}).count() == 0


def test_patient_row_from_a_case_tree(spark):
    import json
    cases = [
        {"case_id": "c1", "submitter_id": "S1", "project": {"project_id": "P", "program": {"name": "N"}}, "primary_site": "lung",
         "diagnoses": [{"diagnosis_id": "d2", "days_to_diagnosis": None}, {"diagnosis_id": "d3", "days_to_diagnosis": 5, "treatments": [{"treatment_id": "t2", "days_to_treatment_start": 9}, {"treatment_id": "t1", "days_to_treatment_start": 9}, {"treatment_id": "t0"}]}, {"diagnosis_id": "d1", "days_to_diagnosis": 0}],
         "samples": [{"sample_id": "s", "portions": [{"portion_id": "p2", "analytes": [{"analyte_id": "a2", "aliquots": [{"aliquot_id": "q9"}, {"aliquot_id": "q1"}]}, {"analyte_id": "a1"}]}, {"portion_id": "p1"}]}],
         "summary": {"file_count": 3, "data_categories": [{"data_category": "z", "file_count": 1}, {"data_category": "b", "file_count": 2}]}},
        {"case_id": "c2", "submitter_id": None},
    ]
    df = spark.createDataFrame([(json.dumps(c),) for c in cases], "j string")
    schema = """case_id string, submitter_id string, project struct<project_id:string,program:struct<name:string>>, primary_site string,
      diagnoses array<struct<diagnosis_id:string,days_to_diagnosis:int,treatments:array<struct<treatment_id:string,days_to_treatment_start:int>>>>,
      samples array<struct<sample_id:string,days_to_collection:int,portions:array<struct<portion_id:string,analytes:array<struct<analyte_id:string,aliquots:array<struct<aliquot_id:string>>>>>>>>,
      exposures array<struct<exposure_id:string>>, summary struct<file_count:int,data_categories:array<struct<data_category:string,file_count:int>>>"""
    rows = {r.case_id: r for r in pt.patient_rows(df.select(F.from_json("j", schema).alias("c")).select("c.*"), "https://x/", ["h"]).collect()}
    one, two = rows["c1"], rows["c2"]
    assert [d.diagnosis_id for d in one.diagnoses] == ["d1", "d3", "d2"] and [x.treatment_id for x in one.diagnoses[1].treatments] == ["t1", "t2", "t0"]
    assert one.diagnoses[0].treatments == [] and [p.portion_id for p in one.samples[0].portions] == ["p1", "p2"]
    assert [a.analyte_id for a in one.samples[0].portions[1].analytes] == ["a1", "a2"] and [q.aliquot_id for q in one.samples[0].portions[1].analytes[1].aliquots] == ["q1", "q9"]
    assert [d.data_category for d in one.summary.data_categories] == ["b", "z"] and one.portal_url == "https://x/c1" and one.program.name == "N"
    assert two.diagnoses == [] == two.samples == two.exposures == two.samples_pathology_report == two.samples_ssgsea_h
    assert two.summary is None and two.project_id is None and two.case_submitter_id is None and one.survival_derived.os_time is None


def test_flex_column_has_the_forms_there_are(spark):
    df = spark.createDataFrame([(1, (1,), [(1,)], None), (2, None, None, None), (3, None, [], [])], "id int, p struct<x:int>, a array<struct<x:int>>, b array<struct<x:int>>")
    out = pt.flex_column(df, ["p", "a", "b"], "flex", single=["p"])
    assert out.schema["flex"].dataType.names == ["p", "a"]
    got = {r.id: r.flex for r in out.collect()}
    assert got[1].p.x == 1 and got[1].a[0].x == 1 and got[2] is None and got[3].p is None and got[3].a == []
    assert pt.flex_column(df.filter("id > 1"), ["p", "a", "b"], "flex", single=["p"]).columns == ["id"]


def test_lists_of_one_table_read_it_once(spark):
    rows = spark.createDataFrame([(1, "a", 2, "x"), (1, "b", 1, "y"), (1, "a", 1, None), (2, None, 5, "z")], "p int, kind string, n int, v string")
    parents = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    lists = {
        "a": pt.Children(rows, "p", ["n"], ["v"], F.col("kind") == "a"), "b": pt.Children(rows, "p", [F.col("n")], ["n", "v"], F.col("kind") == "b"),
        "down": pt.Children(rows, "p", [-F.col("n"), "v"], ["n"]),
    }
    out = pt.nest_lists(parents, "p", lists)
    got = {r.p: ([x.v for x in r.a], [tuple(x) for x in r.b], [x.n for x in r.down]) for r in out.collect()}
    assert got == {1: ([None, "x"], [(1, "y")], [2, 1, 1]), 2: ([], [], [5]), 3: ([], [], [])}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2
