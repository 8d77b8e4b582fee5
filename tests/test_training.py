"""Learning on a rule-labelled panel: training, selection, artifacts and closed-form scoring."""

import dataclasses
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.recipes import engineer_features
from riskloom.operators import boosting
from riskloom.plans import report, train
from riskloom.sources.panels import load_intake, load_panel


@pytest.fixture(scope="module")
def trained(spark, sf):
    return train.train_disease(load_panel(spark, sf, "gastro"), "gastro",
                               models=["Logistic Regression (Balanced)", "Random Forest (Balanced)"], parallelism=4)


def test_train_compare_learns(trained):
    res, win = trained
    rows = {r.model_name: r for r in res.collect()}
    assert set(rows) == {"Logistic Regression (Balanced)", "Random Forest (Balanced)"}
    for r in rows.values():
        assert r.test_roc_auc > 0.6 and 0.0 <= r.cv_f1_mean <= 1.0 and r.training_seconds > 0
    best = max(rows.values(), key=lambda r: (r.test_f1, -r.training_order))
    assert win.name == best.model_name
    assert train.select_best(res).first().model_name == win.name


def test_artifacts_round_trip(spark, sf, trained):
    res, win = trained
    out = tempfile.mkdtemp(prefix="riskloom-art-")
    train.save_artifacts(win, res, out)
    loaded = train.load_artifacts(spark, out, "gastro")
    assert loaded.name == win.name and loaded.feature_names() == win.feature_names()
    a = {r.patient_id: r.probability_1 for r in win.score(load_panel(spark, sf, "gastro")).collect()}
    b = {r.patient_id: r.probability_1 for r in loaded.score(load_panel(spark, sf, "gastro")).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    assert train.load_artifacts(spark, out, "heart") is None


def test_a_writer_stopped_midway_leaves_the_version_before(spark, sf, trained, monkeypatch, tmp_path):
    res, win = trained
    out = str(tmp_path)
    first = train.save_artifacts(win, res, out)
    broken = train.Fitted(win.disease, "Gradient Boosting", win.preprocessor, win.model, win.metrics)

    def stop(*_):
        raise RuntimeError("stopped")
    monkeypatch.setattr(train, "_publish", stop)
    with pytest.raises(RuntimeError):
        train.save_artifacts(broken, res, out, win_background(spark, sf))
    monkeypatch.undo()
    assert train.current_version(spark, f"{out}/gastro") == first
    assert train.load_artifacts(spark, out, "gastro").name == win.name
    assert train.load_background(spark, out, "gastro") is None
    # a pointer whose write did not finish is not followed either
    (tmp_path / "gastro" / "current" / "00000009").mkdir()
    assert train.current_version(spark, f"{out}/gastro") == first
    second = train.save_artifacts(broken, res, out)
    assert train.current_version(spark, f"{out}/gastro") == second != first
    assert train.load_artifacts(spark, out, "gastro").name == "Gradient Boosting"


def win_background(spark, sf):
    return load_panel(spark, sf, "gastro").limit(5)


def test_diabetes_falls_back_to_the_root(spark, sf, trained, tmp_path):
    res, win = trained
    fit = train.Fitted("diabetes", win.name, win.preprocessor, win.model, win.metrics)
    train.save_artifacts(fit, res, str(tmp_path))
    (tmp_path / "diabetes" / "current").rename(tmp_path / "diabetes" / "gone")
    assert train.current_version(spark, f"{tmp_path}/diabetes") is None
    assert train.load_artifacts(spark, str(tmp_path), "diabetes").name == win.name
    assert train.load_artifacts(spark, str(tmp_path), "heart") is None


def test_scores_are_those_that_were_judged(spark, sf, trained):
    """The in-row expressions give the probabilities that the test metrics were computed from."""
    res, win = trained
    scores = {r.patient_id: r.probability_1 for r in win.score(load_panel(spark, sf, "gastro")).collect()}
    eng = engineer_features(load_panel(spark, sf, "gastro"), "gastro")
    x = eng.select("patient_id", F.array(*win.features()).alias("x")).collect()
    m = win.model.margins(np.array([r.x for r in x]))
    p = m if win.is_tree and win.model.link == "identity" else 1 / (1 + np.exp(-m))
    assert max(abs(scores[r.patient_id] - q) for r, q in zip(x, p)) < 1e-9


def test_all_twenty_winners_trained_together_score_in_one_row(spark, sf, tmp_path, monkeypatch):
    names = ["XGBoost (Balanced)", "Logistic Regression (Balanced)"]
    monkey = dataclasses.replace(boosting.XGBOOST, trees=3, depth=2)
    before, boosting.XGBOOST = boosting.XGBOOST, monkey
    try:
        fitted = report.saved_winners(spark, sf, str(tmp_path), models=names, max_train_rows=300)
    finally:
        boosting.XGBOOST = before
    assert len(fitted) == 20 and all(f.name in names for f in fitted.values())
    wide = report.score_wide(load_intake(spark, sf, "b"), "b", fitted)
    assert len([c for c in wide.columns if c.startswith("p_")]) == 20
    assert wide.where(" OR ".join(f"p_{d} IS NULL OR p_{d} < 0 OR p_{d} > 1" for d in fitted)).count() == 0
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    monkeypatch.setattr(report, "MAX_ROW_STEPS", 10_000)
    rows = report.score_wide(load_intake(spark, sf, "b"), "b", fitted)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString() and "InArrow" not in rows._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(report, "MAX_ROW_STEPS", 0)
    a, b = ({r.patient_id: r for r in x.collect()} for x in (rows, report.score_wide(load_intake(spark, sf, "b"), "b", fitted)))
    assert a.keys() == b.keys() and all(abs(a[i][f"p_{d}"] - b[i][f"p_{d}"]) < 1e-12 for i in a for d in fitted)
    top = report.explain_top_condition(spark, load_intake(spark, sf, "a").limit(50), "a", fitted, str(tmp_path))
    rows = top.collect()
    assert len({r.patient_id for r in rows}) == 50
    assert all(set(fitted[r.disease].feature_names()) >= {r.feature} for r in rows)
    # read again: nothing is trained
    again = report.saved_winners(spark, sf, str(tmp_path))
    assert all(again[d].model == fitted[d].model for d in fitted)
