"""Ranked differentials, scorecards, alerts, attribution and intake projections."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.intake import intake_to_panel
from riskloom.operators import attribution, triage


def _wide(spark, rows, diseases):
    ddl = "patient_id long, " + ", ".join(f"p_{d} double" for d in diseases)
    return spark.createDataFrame(rows, ddl)


def test_ties_keep_configuration_order(spark):
    ds = ["typhoid", "fever", "malaria"]
    w = _wide(spark, [(1, 0.5, 0.5, 0.2)], ds)
    top = triage.differential_top(w, ds, 5).orderBy("rank").collect()
    assert [r.disease_key for r in top] == ["fever", "typhoid", "malaria"]


def test_triage_emergency_only_for_critical(spark):
    ds = ["fever", "sepsis"]
    w = _wide(spark, [(1, 0.9, 0.1), (2, 0.1, 0.9), (3, None, None)], ds)
    r = {x.patient_id: x for x in triage.triage_report(w, ds).collect()}
    assert r[1].triage_level.startswith("Medical") and r[1].recommendation.startswith("Go")
    assert r[2].triage_level.startswith("Emergency")
    assert r[3].top_percentage is None and r[3].triage_level.startswith("Self")


def test_scorecard_and_alerts(spark):
    ds = ["fever", "stroke", "sepsis", "hypertensive_crisis"]
    w = _wide(spark, [(1, 0.2, 0.7, 0.65, 0.4), (2, 0.1, 0.1, 0.1, None)], ds)
    sc = {x.patient_id: x for x in triage.scorecard(w, ds).collect()}
    assert sc[1].high_count == 2 and sc[1].moderate_count == 1 and sc[1].scanned == 4
    assert sc[1].avg_risk_pct == pytest.approx((20 + 70 + 65 + 40) / 4)
    assert sc[2].scanned == 3
    al = triage.critical_alerts(w, ds).collect()
    assert [(a.patient_id, a.alert) for a in al] == [(1, "Stroke Risk, Sepsis & Septic Shock")]


def test_intake_a_flags(spark):
    row = dict(patient_id=1, age=40, sex="Male", rf_hbp=1, rf_hchol=0, rf_diab=0, rf_smoker=0, rf_heart=0,
               chief_complaint="🤒 Fever / High Body Temperature", duration="1 - 3 Days",
               notes="My skin looks Yellow", q1="No", q2="Unsure", q3="No", q4="Yes", q5="No")
    df = spark.createDataFrame([row])
    mal = intake_to_panel(df, "a", "malaria").first()
    assert mal.TempSpike == 39.5 and mal.Jaundice == 1 and mal.ShiveringParoxysm == 0
    cold = intake_to_panel(df, "a", "cold").first()
    assert cold.Rhinorrhea == 1 and cold.MildFever == 37.8
    liver = intake_to_panel(df, "a", "liver").first()
    assert liver.Gender == "Male" and liver.TotalBilirubin == 2.8
    dia = intake_to_panel(df, "a", "diabetes").first()
    assert dia.Age == 5 and dia.HighBP == 1


def test_intake_b_liver_direct_bilirubin_rounding(spark):
    df = spark.createDataFrame([(1, 0, 23.5, 40), (2, 1, 0.5, 40)], "patient_id long, sex int, bilirubin double, age int")
    got = {r.patient_id: r.DirectBilirubin for r in intake_to_panel(df, "b", "liver").collect()}
    assert got == {1: round(23.5 * 0.3, 1), 2: round(0.5 * 0.3, 1)}


def test_sampled_shapley_exact_for_additive_scores(spark):
    feats = ["Chills", "BodyAches", "Headache", "BodyTemp"]
    rows = [(i, i % 2, (i // 2) % 2, (i // 3) % 2, 36.5 + i * 0.3) for i in range(12)]
    df = spark.createDataFrame(rows, "patient_id long, Chills int, BodyAches int, Headache int, BodyTemp double")
    bg = [[0, 1, 0, 37.0], [1, 0, 1, 39.0]]
    sh = attribution.sampled_shapley(df, feats, lambda d: rules.rule_logit("fever"), bg, n_perm=8)
    got = {(r.patient_id, r.feature): r.phi for r in sh.collect()}
    coef = {"Chills": 0.8, "BodyAches": 0.6, "Headache": 0.5}
    for pid, c, a, h, t in rows:
        x = {"Chills": c, "BodyAches": a, "Headache": h}
        for f, k in coef.items():
            mean_bg = (bg[0][feats.index(f)] + bg[1][feats.index(f)]) / 2
            assert got[(pid, f)] == pytest.approx(k * (x[f] - mean_bg))
        ind = lambda v: 1.0 if v > 38.3 else 0.0
        assert got[(pid, "BodyTemp")] == pytest.approx(1.2 * (ind(t) - (ind(37.0) + ind(39.0)) / 2))


def test_linear_attribution_sums_to_logit_gap(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 1)], "patient_id long, a int, b int")
    terms = {"a": (2.0, F.col("a")), "b": (-1.0, F.col("b"))}
    out = attribution.linear_attribution(df, terms, df).groupBy("patient_id").agg(F.sum("phi").alias("s"))
    got = {r.patient_id: r.s for r in out.collect()}
    assert got[1] == pytest.approx(2 * (1 - 2 / 3) - (0 - 2 / 3))


def test_sampled_shapley_efficiency_for_any_model(spark):
    """Per row, the sampled values add up to f(x) − mean over permutations of f(background)."""
    feats = ["a", "b", "c"]
    rows = [(i, float(i % 3), float(i % 5), float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "patient_id long, a double, b double, c double")
    f = lambda d: F.when(F.col("a") > 1, F.col("b") * F.col("c")).otherwise(F.col("b") + 2 * F.col("c"))
    bg = [[0.0, 1.0, 0.0], [2.0, 4.0, 1.0], [1.0, 0.0, 1.0]]
    n_perm = 6
    sh = attribution.sampled_shapley(df, feats, f, bg, n_perm=n_perm)
    tot = {r.patient_id: r.s for r in sh.groupBy("patient_id").agg(F.sum("phi").alias("s")).collect()}

    def fx(a, b, c):
        return b * c if a > 1 else b + 2 * c
    base = sum(fx(*bg[m % len(bg)]) for m in range(n_perm)) / n_perm
    for pid, a, b, c in rows:
        assert tot[pid] == pytest.approx(fx(a, b, c) - base)


def test_kde_degenerate_inputs_give_no_density(spark):
    from riskloom.operators import distribution
    one = spark.createDataFrame([(1.0,)], "v double")
    const = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert distribution.kde(one, "v").count() == 0 and distribution.kde(const, "v").count() == 0
    two = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    d = distribution.kde(two, "v", grid=50).toPandas().sort_values("grid_index")
    assert len(d) == 50 and (d.density >= 0).all()
    step = d.x.iloc[1] - d.x.iloc[0]
    assert abs(d.density.sum() * step - 1.0) < 0.05


def test_sampled_attribution_of_rows_without_a_score_is_null(spark):
    from pyspark.sql import functions as F
    from riskloom.operators import attribution
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 1.0)], "patient_id long, a double, b double")
    got = {(r.patient_id, r.feature): r.phi for r in attribution.sampled_shapley(
        df, ["a", "b"], lambda d: F.col("a") * 2 + F.col("b"), [[0.0, 0.0], [1.0, 1.0]], n_perm=4).collect()}
    assert got[1, "a"] == 3.0 and got[1, "b"] == 2.5
    assert got[2, "a"] is None and got[2, "b"] is None


def test_single_disease_scoring_names_missing_columns(spark, sf):
    from riskloom.sources.panels import load_panel
    panel = load_panel(spark, sf, "malaria")
    assert triage.score_single(panel, "malaria").columns == ["patient_id", "percentage", "category"]
    with pytest.raises(ValueError, match="malaria: the panel has no column Jaundice"):
        triage.score_single(panel.drop("Jaundice"), "malaria")


def test_exact_attribution_matches_the_closed_form(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 2.0, 3.0, 1.0), (2, None, 1.0, 0.0)], "patient_id long, a double, b double, c double")
    bg = [[0.0, 0.0, 0.0], [1.0, 1.0, 1.0], [4.0, 0.5, 2.0]]
    got = {(r.patient_id, r.feature): r.phi for r in attribution.exact_shapley(
        df, ["a", "b", "c"], lambda x: x["a"] * 2 + x["b"] * x["c"], bg).collect()}
    assert abs(got[1, "a"] - 2 * (2.0 - 5 / 3)) < 1e-9
    value = lambda rows: sum(2 * a + b * c for a, b, c in rows) / len(rows)
    assert abs(sum(got[1, k] for k in "abc") - ((2 * 2 + 3) - value(bg))) < 1e-9
    assert got[2, "a"] is None and got[2, "c"] is None
