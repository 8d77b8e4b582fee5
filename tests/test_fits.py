"""Shared fits: Newton steps against MLlib, boosted trees against brute force, logistic attribution against enumeration."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import attribution, boosting, fitting, forests, newton, trees
from riskloom.operators.fitting import ALL, Frame

GROUPS = {"a": 3, "b": 5}


@pytest.fixture(scope="module")
def data():
    """Rows (grp, rid, y, fold, x) of two groups of different widths, with missing values and test rows."""
    rng = random.Random(3)
    rows = []
    for group, width in GROUPS.items():
        for i in range(500):
            x = [round(rng.gauss(0, 1 + j), 1) for j in range(width - 1)] + [float(rng.random() < 0.4)]
            p = 1 / (1 + math.exp(-(x[0] * 1.5 - x[1] * 0.5 + x[-1])))
            if rng.random() < 0.1:
                x[0] = float("nan")
            rows.append((group, i, float(rng.random() < p), None if i % 5 == 0 else i % 3, x))
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


def own_rows(data, frame):
    own = [r for r in data if r[0] == frame.group and r[3] is not None and r[3] != frame.without]
    return np.array([r[4] for r in own]), np.array([r[2] for r in own]), np.array([r[1] for r in own])


def test_newton_steps_reach_the_coefficients_of_mllib(spark, data, table, frames):
    got = newton.logistic_fits(table, frames)
    assert all(np.allclose(a.coefficients, b.coefficients, atol=1e-9) for a, b in zip(got, newton.logistic_fits(table.repartition(2), frames, layout=fitting.Layout(2))))
    for frame, fit in list(zip(frames, got))[::3]:
        x, y, _ = own_rows(data, frame)
        z, w = newton.standardised(frame, x), frame.balanced(y)
        df = spark.createDataFrame([(float(t), float(v), r.tolist()) for t, v, r in zip(y, w, z)], "label double, w double, x array<double>")
        model = LogisticRegression(maxIter=500, regParam=1.0 / len(y), standardization=False, weightCol="w", tol=1e-12).fit(
            df.withColumn("features", array_to_vector("x")))
        assert np.allclose(fit.coefficients, model.coefficients.toArray(), atol=1e-6) and abs(fit.intercept - model.intercept) < 1e-6


def test_frames_of_one_class_or_without_rows_are_constant(table):
    empty = Frame("nobody", ALL, np.zeros(3), np.zeros(3), np.ones(3), 0, 0)
    ones = Frame("a", ALL, np.zeros(3), np.zeros(3), np.ones(3), 0, 9)
    a, b = newton.logistic_fits(table, [empty, ones])
    assert (a.intercept, a.coefficients) == (0.0, [0.0] * 3) and b.intercept > 20
    (forest,), = boosting.boosted_fits(table, [ones], [boosting.Boosting(2, 2, 0.1)])
    assert forest.margins(np.zeros((1, 3)))[0] > 20


def brute_boosting(x, y, rid, frame, edges, model):
    """The same trees by plain loops over all nodes, features and bounds; returns the margins."""
    w = np.where(y == 1, frame.positive_weight(), 1.0) if model.weighted else np.ones(len(y))
    margin = np.full(len(y), np.log(frame.n_pos / frame.n_neg) if model.prior else 0.0)
    for t in range(model.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        used = boosting._uniform(rid, model.seed, t) < model.share

        def grow(rows, depth):
            own = rows[used[rows]]
            G, H = g[own].sum(), h[own].sum()
            best = (1e-9, None)
            for j in range(x.shape[1]) if depth < model.depth else ():
                for e in edges[j]:
                    low = x[own, j] <= e
                    a, b = own[low], own[~low]
                    if min(len(a), len(b)) < 1 or min(h[a].sum(), h[b].sum()) < model.least_curvature:
                        continue

                    def part(r):
                        return g[r].sum() ** 2 / (h[r].sum() + model.l2 if model.second_order else len(r))
                    gain = part(a) + part(b) - part(own)
                    if gain > best[0] + 1e-9:
                        best = (gain, (j, e))
            if best[1] is None:
                margin[rows] += -model.rate * G / (H + model.l2)
                return
            j, e = best[1]
            grow(rows[x[rows, j] <= e], depth + 1)
            grow(rows[~(x[rows, j] <= e)], depth + 1)
        grow(np.arange(len(y)), 0)
    return margin


def test_trees_in_lockstep_are_those_of_plain_loops(data, table, frames, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    models = [boosting.Boosting(5, 3, 0.3, share=0.8, l2=1.0, least_curvature=1.0, weighted=True), boosting.Boosting(3, 2, 0.5, second_order=False, prior=True)]
    got = boosting.boosted_fits(table, frames, models)
    again = boosting.boosted_fits(table.repartition(2, "grp"), frames, models, fitting.Layout(2, True))
    edges = boosting.bin_edges(table, frames)
    for frame, e, fits, same in zip(frames, edges, got, again):
        x, y, rid = own_rows(data, frame)
        x = frame.filled(x)
        for model, forest, other in zip(models, fits, same):
            assert (forest.feature, forest.threshold) == (other.feature, other.threshold)
            assert len(forest.roots) == model.trees and forest.link == "logistic"
            assert np.allclose(forest.margins(x), brute_boosting(x, y, rid, frame, e, model), atol=1e-9)


def test_boosting_learns(data, table, frames):
    fits = boosting.boosted_fits(table, frames[:1], [boosting.Boosting(30, 3, 0.2, second_order=False, prior=True)])[0]
    test = [r for r in data if r[0] == "a" and r[3] is None]
    s = fits[0].margins(frames[0].filled(np.array([r[4] for r in test])))
    y = np.array([r[2] for r in test])
    auc = (s[y == 1][:, None] > s[y == 0][None]).mean()
    assert auc > 0.75


def test_forest_trees_split_where_impurity_falls_most():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (200, 2)).astype(float)
    y, w = (x[:, 0] > 2).astype(float), rng.integers(0, 3, 200).astype(float)
    edges = [np.arange(6.0), np.arange(6.0)]
    feature, threshold, left, right, value = forests.grow_tree(boosting._binned(x, edges), edges, y, w, rng, 3, 2)
    assert (feature[0], threshold[0]) == (0, 2.0) and len(feature) == 3
    assert (value[left[0]], value[right[0]]) == (0.0, 1.0)


def test_forests_learn_and_repeat(data, table, frames):
    got, again = forests.forest_fits(table, frames, trees=25), forests.forest_fits(table.repartition(5), frames, trees=25)
    assert got == again
    aucs = []
    for frame, forest in zip(frames, got):
        assert len(forest.roots) == 25 and forest.link == "identity" and forest.depth <= 10
        held = [r for r in data if r[0] == frame.group and (r[3] if r[3] is not None else ALL) == frame.without]
        p = forest.probabilities(frame.filled(np.array([r[4] for r in held])))
        y = np.array([r[2] for r in held])
        assert p.min() >= 0 and p.max() <= 1
        aucs.append((p[y == 1][:, None] > p[y == 0][None]).mean())
    assert min(aucs) > 0.6 and np.mean(aucs) > 0.68, aucs
    one = Frame("a", ALL, np.zeros(3), np.zeros(3), np.ones(3), 9, 0)
    assert forests.forest_fits(table, [one])[0].margins(np.zeros((1, 3))).tolist() == [0.0]


def test_a_table_too_large_to_send_is_refused(table, frames, monkeypatch):
    monkeypatch.setattr(forests, "MAX_CELLS", 100)
    with pytest.raises(ValueError):
        forests.forest_fits(table, frames)


def test_training_table_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "u"), (2, None, "v"), (3, 1.0, None), (4, float("nan"), "new")], "id long, n double, c string")
    rows = {r.id: r.x for r in df.select("id", fitting.x_column(["n"], {"c": ["u", "v"]}).alias("x")).collect()}
    assert rows[1] == [2.0, 1.0, 0.0] and rows[4][1:] == [0.0, 0.0]
    assert math.isnan(rows[2][0]) and rows[2][1:] == [0.0, 1.0]
    assert rows[3][0] == 1.0 and all(math.isnan(v) for v in rows[3][1:])


def test_logistic_attribution_equals_enumeration(spark):
    names = ["a", "b", "c", "d"]
    rng = random.Random(8)
    rows = [(i, *[rng.gauss(0, 1) for _ in names]) for i in range(30)] + [(99, None, 0.0, 0.0, 0.0)]
    background = [[rng.gauss(0, 1) for _ in names] for _ in range(12)]
    model = newton.Logistic(0.3, [1.2, -0.7, 0.0, 2.0])
    df = spark.createDataFrame(rows, "patient_id long, a double, b double, c double, d double")
    want = {(r.patient_id, r.feature): r.phi for r in attribution.exact_shapley(
        df, names, lambda c: model.probability([c[n] for n in names]), background).collect()}
    got = {(r.patient_id, r.feature): r.phi for r in attribution.logistic_shapley(
        df.withColumn("x", F.array(*names)), "x", names, model, background).collect()}
    assert set(got) == set(want)
    assert all(got[99, n] is None for n in names)
    assert max(abs(got[k] - want[k]) for k in want if k[0] != 99) < 1e-9


def test_drawn_coalitions_come_close_and_keep_the_sum(spark):
    f = 13
    z, w = attribution.coalitions(f, 600)
    assert len(z) <= 600 and abs(w.sum() - sum((f - 1) / (s * (f - s)) for s in range(1, f))) < 1e-9
    rng = random.Random(5)
    names = [f"n{j}" for j in range(f)]
    rows = [(i, [rng.gauss(0, 1) for _ in names]) for i in range(4)]
    background = [[rng.gauss(0, 1) for _ in names] for _ in range(5)]
    model = newton.Logistic(0.1, [rng.gauss(0, 0.6) for _ in names])
    df = spark.createDataFrame(rows, "patient_id long, x array<double>")

    def phis(limit):
        return {(r.patient_id, r.feature): r.phi for r in attribution.logistic_shapley(df, "x", names, model, background, limit=limit).collect()}
    full, some = phis(1 << f), phis(600)
    assert max(abs(full[k] - some[k]) for k in full) < 0.03
    for i, x in rows:
        total = attribution.expit(np.array([model.margins(np.array(x))]))[0] - attribution.expit(model.margins(np.array(background))).mean()
        for got in (full, some):
            assert abs(sum(got[i, n] for n in names) - total) < 1e-9


def test_one_feature_takes_all(spark):
    model = newton.Logistic(0.0, [2.0])
    df = spark.createDataFrame([(1, [1.0])], "patient_id long, x array<double>")
    (row,) = attribution.logistic_shapley(df, "x", ["only"], model, [[0.0], [1.0]]).collect()
    p = [1 / (1 + math.exp(-v)) for v in (2.0, 0.0)]
    assert abs(row.phi - (p[0] - (p[0] + p[1]) / 2)) < 1e-12
    assert trees.Forest([-1], [0.0], [-1], [-1], [0.5], [0]).margins(np.zeros((2, 1))).tolist() == [0.5, 0.5]
