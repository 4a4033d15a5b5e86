"""Rule cases of the survival derivation, Kaplan-Meier and pathway scores against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import survival as sv
from cohortloom.operators import km, pathway

TREE = """case_id string, project struct<project_id string>,
demographic struct<vital_status string, days_to_death bigint, cause_of_death string>,
diagnoses array<struct<diagnosis_id string, diagnosis_is_primary_disease boolean, days_to_diagnosis bigint,
 days_to_last_follow_up bigint, classification_of_tumor string, tissue_or_organ_of_origin string,
 residual_disease string, ajcc_pathologic_stage string,
 treatments array<struct<treatment_id string, treatment_outcome string, margin_status string, days_to_treatment_start bigint>>>>,
follow_ups array<struct<follow_up_id string, days_to_follow_up bigint, disease_response string, days_to_recurrence bigint,
 days_to_progression bigint, progression_or_recurrence string, progression_or_recurrence_type string>>"""


def dx(primary=True, day=0, last=None, kind="primary", tissue="Lung", residual=None, stage=None, treatments=(), ident="d1"):
    return (ident, primary, day, last, kind, tissue, residual, stage, list(treatments))


def fu(day=None, response=None, rec=None, prog=None, por=None, kind=None, ident="f1"):
    return (ident, day, response, rec, prog, por, kind)


def case(name, vital="Alive", death=None, cause=None, dxs=(), fus=(), project="TCGA-CHOL"):
    return (name, (project,), (vital, death, cause), list(dxs), list(fus))


CASES = {
    "with_tumor_at_death": (case("with_tumor_at_death", "Dead", 561, None, [dx()], [fu(561, "WT-With Tumor")]), dict(os=(1, 561), dss=(1, 561), pfi=(1, 561), dfi=None)),
    "progression_flag": (case("progression_flag", dxs=[dx(last=1127)], fus=[fu(355, por=" yes ")]), dict(pfi=(1, 355), os=(0, 1127))),
    "same_organ": (case("same_organ", dxs=[dx(residual="R0"), dx(False, 3076, None, "Subsequent Primary", ident="d2")], fus=[fu(3100)]), dict(dfi=(1, 3076))),
    "other_organ": (case("other_organ", dxs=[dx(residual="R0", last=854), dx(False, 110, None, "Subsequent Primary", "Skin", ident="d2")]), dict(dfi=(0, 854), pfi=(1, 110))),
    "new_primary_plus": (case("new_primary_plus", dxs=[dx(residual="R0", last=900)], fus=[fu(300, rec=300, kind="New Primary + Locoregional")]), dict(dfi=(1, 300))),
    "free_at_death": (case("free_at_death", "Dead", 500, "Cancer Related", [dx()], [fu(500, "TF-Tumor Free")]), dict(dss=(0, 500), pfi=(1, 500))),
    "no_status": (case("no_status", "Dead", 365, None, [dx()]), dict(dss=(1, 365), os=(1, 365))),
    "stage_iv": (case("stage_iv", dxs=[dx(residual="R0", last=10, stage=" Stage IVA")]), dict(dfi=None)),
    "stage_iii": (case("stage_iii", dxs=[dx(residual="R0", last=10, stage="Stage III")]), dict(dfi=(0, 10))),
    "margin_only": (case("margin_only", dxs=[dx(last=20, treatments=[("t1", None, "Uninvolved", None)])]), dict(dfi=(0, 20))),
    "margin_second": (case("margin_second", dxs=[dx(last=20, treatments=[("t1", None, "Involved", None), ("t2", None, "Uninvolved", None)])]), dict(dfi=None)),
    "outcome_any": (case("outcome_any", dxs=[dx(last=20, treatments=[("t1", "Stable Disease", None, None), ("t2", "Complete Response", None, None)])]), dict(dfi=(0, 20))),
    "sarc_residual_only": (case("sarc_residual_only", dxs=[dx(last=20, treatments=[("t1", "Complete Response", None, None)])], project="TCGA-SARC"), dict(dfi=None)),
    "no_field_project": (case("no_field_project", dxs=[dx(residual="R0", last=20)], project="TCGA-LAML"), dict(dfi=None)),
    "unknown_vital": (case("unknown_vital", "Not Reported", 5, None, [dx(last=3)], [fu(3, rec=2)]), dict(os=None, dss=None, pfi=None, dfi=None)),
    "same_day_with_wins": (case("same_day_with_wins", "Dead", 50, None, [dx()], [fu(40, "TF-Tumor Free", ident="a"), fu(40, "WT-With Tumor", ident="b")]), dict(dss=(1, 50), pfi=(1, 50))),
    "later_free_wins": (case("later_free_wins", "Dead", 90, None, [dx()], [fu(20, rec=20, ident="a"), fu(80, "Tumor Free", ident="b")]), dict(dss=(0, 90), pfi=(1, 20))),
    "flag_beats_earlier": (case("flag_beats_earlier", dxs=[dx(False, -10, 7, "Prior primary", ident="a"), dx(True, 0, 9, ident="b")]), dict(os=(0, 9))),
    "nothing": (case("nothing"), dict(os=None, dss=None, pfi=None, dfi=None)),
}


def test_rule_cases(spark):
    tree = spark.createDataFrame([v[0] for v in CASES.values()], TREE)
    out = {r.case_id: r.survival_derived for r in sv.derive(**sv.from_tree(tree)).collect()}
    assert out.keys() == CASES.keys()
    for name, (_, want) in CASES.items():
        for e, pair in want.items():
            got = (out[name][f"{e}_event"], out[name][f"{e}_time"])
            assert got == (pair or (None, None)), (name, e, got)
    flat = sv.flatten_endpoints(sv.derive(**sv.from_tree(tree)), ["case_id"])
    assert {r.case_id for r in flat.collect()} == CASES.keys() - {"nothing", "unknown_vital"}


def test_supplement_outcomes_count(spark):
    tree = spark.createDataFrame([case("a", dxs=[dx(last=20)]), case("b", dxs=[dx(last=20)])], TREE)
    supp = spark.createDataFrame([("a", 1, "Stable Disease"), ("a", 2, "Complete Remission/Response")], "case_id string, pos int, outcome string")
    out = {r.case_id: r for r in sv.derive(**sv.from_tree(tree), supplement=supp).collect()}
    assert out["a"].survival_derived.dfi_event == 0 and out["a"].first_outcome == "Stable Disease"
    assert out["b"].survival_derived.dfi_event is None


def brute_km(rows, h):
    rows = [r for r in rows if None not in r]
    surv = 1.0
    for t in sorted({t for t, e in rows if e == 1}):
        d = sum(1 for a, e in rows if a == t and e == 1)
        surv *= 1 - d / sum(1 for a, _ in rows if a >= t)
        if t >= h:
            return round(surv, 3)
    return None if max(t for t, _ in rows) < h else round(surv, 3)


def test_km_against_brute_force(spark):
    rnd = random.Random(3)
    data = [(g, rnd.randrange(1, 60) * 10 if rnd.random() > 0.05 else None, rnd.randrange(2)) for g in "abc" for _ in range(60)]
    data += [("on", 100, 1), ("on", 200, 0), ("after", 150, 1), ("after", 160, 0), ("before", 50, 0), ("zero", 100, 1)]
    df = spark.createDataFrame(data, "g string, t int, e int")
    hs = {"h100": 100, "h300": 300, "h590": 590}
    got = {(r.g, r.horizon): r.surv for r in km.km_horizon(df, "g", "t", "e", hs).collect()}
    for g in {d[0] for d in data}:
        for name, h in hs.items():
            want = brute_km([d[1:] for d in data if d[0] == g], h)
            assert got[g, name] == (pytest.approx(want, abs=1.1e-3) if want is not None else None), (g, name)


def brute_scores(expr, sets_):
    out = {}
    for s, values in expr.items():
        genes = sorted(values)
        n = len(genes)
        rank = {g: int(sum(values[x] < values[g] for x in genes) + (sum(values[x] == values[g] for x in genes) + 1) / 2) for g in genes}
        ordered = sorted(genes, key=lambda g: (-rank[g], g))
        p = {g: i for i, g in enumerate(ordered, 1)}
        for name, members in sets_.items():
            hit = [g for g in members if g in p]
            # The running walk itself, not its closed form.
            up, score, norm = 0.0, 0.0, sum(abs(rank[g]) ** 0.25 for g in hit)
            miss = 0
            for g in ordered:
                if g in hit:
                    up += abs(rank[g]) ** 0.25
                else:
                    miss += 1
                score += up / norm - miss / (n - len(hit))
            out[s, name] = score
    return out


def test_scores_against_running_walk(spark):
    rnd = random.Random(4)
    expr = {s: {g: float(rnd.randrange(15)) for g in range(40)} for s in range(4)}
    sets_ = {"p": [1, 4, 9, 16, 25, 36], "q": list(range(10, 30))}
    df = spark.createDataFrame([(s, g, v) for s, d in expr.items() for g, v in d.items()], "sample_id int, gene_id int, value double")
    sd = spark.createDataFrame([(g, n) for n, m in sets_.items() for g in m], "gene_id int, pathway string")
    got = {(r.sample_id, r.pathway): r.score_raw for r in pathway.ssgsea_scores(df, sd).collect()}
    for k, v in brute_scores(expr, sets_).items():
        assert got[k] == pytest.approx(v, rel=1e-9), k
    # A monotone transform keeps every rank and so every score.
    same = {(r.sample_id, r.pathway): r.score_raw for r in pathway.ssgsea_scores(df.withColumn("value", F.exp("value") * 3), sd).collect()}
    # Equal up to the order in which tasks add the same terms.
    assert same.keys() == got.keys() and all(same[k] == pytest.approx(got[k], rel=1e-12) for k in got)


@pytest.mark.parametrize("memberships", [5_000_000, 8])
def test_scores_on_an_axis_are_the_zero_filled_ones(spark, memberships):
    rnd = random.Random(11)
    axis = list(range(60))
    expr = {s: {g: float(rnd.choice([-2, -1, 0, 0, 1, 3, 8])) for g in rnd.sample(axis, rnd.choice([1, 9, 40, 60]))} for s in range(8)}
    sets_ = {"p": [1, 4, 9, 16, 25, 36, 99], "q": list(range(10, 30)), "all": axis, "one": [59]}
    rows = [(s, g, v) for s, d in expr.items() for g, v in d.items()]
    rows += [(0, g, v - 5) for g, v in expr[0].items()] + [(1, 500, 7.0), (2, None, 1.0), (3, 59, None) if 59 not in expr[3] else (3, 501, 1.0)]
    df = spark.createDataFrame(rows, "sample_id int, gene_id int, value double")
    sd = spark.createDataFrame([(g, n) for n, m in sets_.items() for g in [*m, m[0]]], "gene_id int, pathway string")
    got = pathway.ssgsea_scores_on_axis(df, spark.createDataFrame([(g,) for g in axis], "gene_id int"), sd, memberships=memberships)
    got = {(r.sample_id, r.pathway): (r.n_genes, r.score_raw) for r in got.collect()}
    filled = {s: {g: d.get(g, 0.0) for g in axis} for s, d in expr.items()}
    whole = {n: [g for g in m if g in axis] for n, m in sets_.items()}
    want = brute_scores(filled, {n: m for n, m in whole.items() if n != "all"})
    assert set(got) == {(s, n) for s in expr for n in sets_}
    for (s, n), (k, score) in got.items():
        assert k == len(whole[n]) and (score is None if n == "all" else score == pytest.approx(want[s, n], rel=1e-9))


def test_degenerate_range_is_refused(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "s string, v double")
    with pytest.raises(Exception, match="range is zero"):
        pathway.normalize_global(df, "v").collect()


def test_single_row_stats_have_no_sd(spark):
    df = spark.createDataFrame([("A", "t", "p", 1.0), ("B", "t", "p", 3.0), ("B", "n", "p", 5.0)], "proj string, st string, pw string, v double")
    got = {(r.population, r.type): r for r in pathway.score_stats(df, "proj", "st", "pw", "v").collect()}
    assert got["A", "t"].sd is None and got["pan", "all"].n == 3
    assert got["pan", "all"].sd == pytest.approx(2.0) and math.isclose(got["pan", "t"].median, 2.0)


def test_reference_distribution_against_sorted_lists(spark):
    import numpy as np
    rnd = random.Random(12)
    rows = [(rnd.choice("ABC"), rnd.choice(["t", "n", None]), rnd.choice(["p", "q", "r"]), rnd.choice([rnd.gauss(-3, 40), 0.0, 1e6, -1e-9, 5.0])) for _ in range(900)]
    rows += [("D", "t", "same", 7.1)] * 5 + [("D", "t", "none", None)]
    df = spark.createDataFrame(rows, "proj string, st string, pw string, v double")
    got = {(r.population, r.type, r.pw): r for r in pathway.score_stats(df, "proj", "st", "pw", "v").collect()}
    want = {}
    for p, t, g, v in rows:
        if v is not None:
            for key in {(p, t, g), ("pan", t, g), (p, "all", g), ("pan", "all", g)}:
                want.setdefault(key, []).append(v)
    assert got.keys() == want.keys()
    for key, x in want.items():
        r = got[key]
        assert (r.n, r.min, r.max) == (len(x), min(x), max(x)) and r["mean"] == pytest.approx(np.mean(x))
        assert [r.q25, r.median, r.q75] == pytest.approx(np.percentile(x, [25, 50, 75]).tolist(), rel=1e-12, abs=1e-15)
        assert r.sd is None if len(x) == 1 else r.sd == pytest.approx(np.std(x, ddof=1))
    assert got["D", "t", "same"].sd == 0.0


def test_treatments_lying_by_diagnosis_are_not_shuffled_again(spark):
    from cohortloom.functions import survival as sv

    cols = "case_id bigint, dx_id bigint, tx_id string, days_to_start bigint, outcome string, margin_status string"
    tx = spark.createDataFrame([(1, 10, "a", 3, "Complete Response", ""), (1, 10, "b", 1, "", "Involved"), (2, 10, "c", 0, "x", "y"), (1, 11, "d", 0, "x", "y")], cols)
    primary = spark.createDataFrame([(1, (10,)), (2, (20,))], "case_id bigint, primary struct<dx_id: bigint>")
    out = sv.treatment_facts(tx.repartition(4, "dx_id").hint("merge"), primary)
    assert [tuple(r) for r in out.collect()] == [(1, "Involved", "Complete Response", True)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [dx_id" in plan and "SortMergeJoin [case_id" not in plan
