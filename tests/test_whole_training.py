"""Fits on every training row: no cap on the winners' rows, trees grown where a group's rows lie, and groups of any size."""

import dataclasses
import math
import random

import numpy as np
import pytest

from riskloom.operators import boosting, fitting, forests, trees
from riskloom.operators.fitting import ALL, Frame, Layout
from riskloom.plans import report, train
from riskloom.queries import learning

GROUPS = {"a": 3, "b": 5}


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    rows = []
    for group, width in GROUPS.items():
        for i in range(600):
            x = [round(rng.gauss(0, 1 + j), 1) for j in range(width - 1)] + [float(rng.random() < 0.4)]
            p = 1 / (1 + math.exp(-(x[0] * 1.5 - x[1] * 0.5 + x[-1])))
            if rng.random() < 0.1:
                x[0] = float("nan")
            rows.append((group, i // 2 if i < 20 else i, float(rng.random() < p), None if i % 5 == 0 else i % 3, x))
    return rows


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame(data, "grp string, rid long, y double, fold int, x array<double>").repartition(3).cache()


@pytest.fixture(scope="module")
def frames(data):
    out = []
    for group in GROUPS:
        for f in (ALL, 0, 1, 2):
            own = [r for r in data if r[0] == group and r[3] is not None and r[3] != f]
            x = np.array([r[4] for r in own])
            fill = np.nanmedian(x, axis=0)
            full = np.where(np.isnan(x), fill, x)
            pos = sum(r[2] == 1 for r in own)
            out.append(Frame(group, f, fill, full.mean(axis=0), full.std(axis=0), len(own) - pos, pos))
    return out


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    """4000 orders of our own: more than any disease was trained on before."""
    out = str(tmp_path_factory.mktemp("orders"))
    spark.range(1, 4001).selectExpr("id * 4 + id % 3 AS o_orderkey", "id * 7 % 601 AS o_custkey").coalesce(1).write.parquet(f"{out}/orders.parquet")
    return out


def test_winners_are_fitted_on_every_training_row(spark, orders, monkeypatch):
    whole = report.saved_winners
    monkeypatch.setattr(report, "saved_winners", lambda spark, sf, out, **kw: whole(spark, sf, out, ["fever", "kidney"], models=[train.LOGISTIC], cv_folds=2, **kw))
    fitted = learning._winners(spark, orders)
    assert {d: (f.metrics["n_train"] + f.metrics["n_test"], abs(f.metrics["n_train"] - 3200) <= 1) for d, f in fitted.items()} == {
        "fever": (4000, True), "kidney": (4000, True)}


def test_a_disease_too_large_for_a_task_is_trained_whole(spark, orders, monkeypatch):
    small = dataclasses.replace(boosting.XGBOOST, trees=2, depth=2)
    monkeypatch.setattr(boosting, "XGBOOST", small)
    monkeypatch.setattr(fitting, "MAX_CELLS", 1000)
    grown = []
    monkeypatch.setattr(train, "forest_levels", lambda *a, **k: grown.append(len(a[1])) or forests.forest_levels(*a, trees=12, **k))
    res, win = train.train_disease(learning.load_panel(spark, orders, "gastro"), "gastro", models=[train.XGBOOST, train.FOREST], cv_folds=2)
    assert grown == [3] and abs(win.metrics["n_train"] - 3200) <= 1
    assert {r.model_name: r.test_roc_auc > 0.6 for r in res.collect()} == {train.XGBOOST: True, train.FOREST: True}


def test_fits_grown_in_one_task_are_those_of_the_levels(data, table, frames, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    models = [boosting.Boosting(5, 3, 0.3, share=0.8, l2=5.0, least_curvature=5.0, weighted=True), boosting.Boosting(3, 2, 0.5, second_order=False, prior=True)]
    whole = boosting.boosted_fits(table, frames, models)
    monkeypatch.setattr(fitting, "MAX_CELLS", 1)
    for other in (boosting.boosted_fits(table, frames, models), boosting.boosted_fits(table.repartition(2, "grp"), frames, models, Layout(2, True))):
        for frame, pairs in zip(frames, map(zip, whole, other)):
            x = frame.filled(np.array([r[4] for r in data if r[0] == frame.group and r[3] is not None and r[3] != frame.without]))
            assert all(np.allclose(a.margins(x), b.margins(x), atol=1e-9) for a, b in pairs)


def test_forests_grown_by_levels_learn_and_repeat(data, table, frames, monkeypatch):
    got = forests.forest_levels(table, frames, trees=25)
    assert got == forests.forest_levels(table.repartition(5), frames, trees=25, layout=Layout(5))
    monkeypatch.setattr(forests, "LEVEL_CELLS", 200_000)  # a few trees at a time
    few = forests.forest_levels(table.repartition(2, "grp"), frames, trees=25, layout=Layout(2, True))
    assert [f.feature.tolist() for f in few] == [f.feature.tolist() for f in got]
    aucs = []
    for frame, forest in zip(frames, got):
        assert len(forest.roots) == 25 and forest.link == "identity" and forest.depth <= 10
        held = [r for r in data if r[0] == frame.group and (r[3] if r[3] is not None else ALL) == frame.without]
        p = forest.probabilities(frame.filled(np.array([r[4] for r in held])))
        y = np.array([r[2] for r in held])
        assert p.min() >= 0 and p.max() <= 1
        aucs.append((p[y == 1][:, None] > p[y == 0][None]).mean())
    assert min(aucs) > 0.6 and np.mean(aucs) > 0.68, aucs
    one = Frame("a", ALL, np.zeros(3), np.zeros(3), np.ones(3), 0, 9)
    assert forests.forest_levels(table, [one])[0].margins(np.zeros((1, 3))).tolist() == [1.0]


def test_a_tree_by_levels_counts_every_drawn_row(data, table, frames):
    """The leaves hold the class shares of all rows of the frame, as many times as they are drawn."""
    frame = frames[0]
    (forest,) = forests.forest_levels(table, [frame], trees=1, depth=3)
    own = [r for r in data if r[0] == "a" and r[3] is not None]
    x, y, rid = frame.filled(np.array([r[4] for r in own])), np.array([r[2] for r in own]), np.array([r[1] for r in own])
    copies = forests._COPIES.searchsorted(boosting._uniform(rid, 43, 0), side="right")
    assert 0.8 < copies.mean() < 1.2
    w = frame.balanced(y) * copies
    leaf = []
    for row in x:
        n = 0
        while forest.feature[n] >= 0:
            n = forest.left[n] if row[forest.feature[n]] <= forest.threshold[n] else forest.right[n]
        leaf.append(n)
    leaf = np.array(leaf)
    assert len(set(leaf)) > 4
    for n in set(leaf[copies > 0]):
        assert abs(forest.value[n] - (w * y)[leaf == n].sum() / w[leaf == n].sum()) < 1e-9


def test_large_forests_travel_as_arrays_and_keep_their_paths(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 4)).round(1)
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 64), method="nearest")) for j in range(4)]
    bins = boosting._binned(x, edges)
    grown = [forests.grow_tree(bins, edges, y, np.bincount(rng.integers(0, 3000, 3000), minlength=3000) * 1.0, rng, 8, 2) for _ in range(6)]
    forest = forests._forest(grown, Frame("a", ALL, None, None, None, 1, 1), 6)
    assert isinstance(forest.feature, np.ndarray) and trees.Forest.from_json(forest.to_json()) == forest
    lists = trees.Forest(*[np.asarray(getattr(forest, c)).tolist() for c in ("feature", "threshold", "left", "right", "value", "roots")])
    assert lists == forest and lists.margins(x).tolist() == forest.margins(x).tolist()
    want = trees.ShapleyKernel(forest, x[:20].tolist(), 4).values(x[:50])
    monkeypatch.setattr(trees, "KNOWN_INTERVALS", 3)
    assert np.array_equal(trees.ShapleyKernel(forest, x[:20].tolist(), 4).values(x[:50]), want)
    assert np.allclose(want.sum(axis=1), forest.margins(x[:50]) - forest.margins(x[:20]).mean())
