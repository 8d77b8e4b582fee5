"""Work that must not grow with the background, a class or a group: results against plain versions, and plans."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import attribution, clean, metrics, split, trees
from riskloom.sources.panels import load_intake
from riskloom.sources.tables import TASKS_PER_CORE


def plan_of(df):
    return df._jdf.queryExecution().toString()


def random_forest(rng, n_trees, depth, features):
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def grow(level):
        at = len(feature)
        for column, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, 0.0)):
            column.append(v)
        if level < depth and rng.random() < 0.9:
            feature[at], threshold[at] = int(rng.integers(features)), float(rng.integers(1, 6)) / 6
            right[at] = grow(level + 1)  # children apart, the right one first
            left[at] = grow(level + 1)
        else:
            value[at] = float(rng.random()) / n_trees
        return at
    for _ in range(n_trees):
        roots.append(grow(0))
    return trees.Forest(feature, threshold, left, right, value, roots, 0.25)


def plain_margin(forest, x):
    total = forest.base
    for n in forest.roots:
        while forest.feature[n] >= 0:
            n = forest.left[n] if x[forest.feature[n]] <= forest.threshold[n] else forest.right[n]
        total += forest.value[n]
    return total


def some_rows(rng, n, features):
    x = rng.integers(0, 7, (n, features)) / 6  # many values lie on a threshold
    x[rng.random(x.shape) < 0.1] = math.nan
    return x


def test_all_trees_go_down_together():
    rng = np.random.default_rng(1)
    forest, x = random_forest(rng, 9, 6, 5), some_rows(rng, 700, 5)
    want = [plain_margin(forest, r) for r in x]
    assert forest.margins(x).tolist() == want
    word, _ = forest._walk()
    assert len(word) == len(forest.feature)
    old, trees.WALKED = trees.WALKED, 20  # two rows at a time
    try:
        assert forest.margins(x).tolist() == want
    finally:
        trees.WALKED = old
    assert forest.margins(x[:0]).tolist() == []


def test_shapley_values_of_rows_alike_are_computed_once():
    rng = np.random.default_rng(2)
    forest, x, background = random_forest(rng, 4, 5, 4), some_rows(rng, 60, 4), some_rows(rng, 15, 4)
    kernel = trees.ShapleyKernel(forest, background.tolist(), 4)
    got = kernel.values(x)

    def value(row, mask):
        return np.mean([plain_margin(forest, [row[j] if mask >> j & 1 else b[j] for j in range(4)]) for b in background])
    for row, phi in zip(x[:12], got):
        v = [value(row, m) for m in range(16)]
        for j in range(4):
            want = sum(math.factorial(bin(m).count("1")) * math.factorial(3 - bin(m).count("1")) / 24 * (v[m | 1 << j] - v[m])
                       for m in range(16) if not m >> j & 1)
            assert phi[j] == pytest.approx(want, abs=1e-12)
    known = len(kernel.known)
    near = np.where(np.isnan(x), x, x - 1e-3)  # other values between the same thresholds
    assert np.array_equal(kernel.values(near), got) and len(kernel.known) == known
    old, trees.TABLED_FEATURES = trees.TABLED_FEATURES, 1
    try:
        assert np.allclose(trees.ShapleyKernel(forest, background.tolist(), 4).values(x), got, atol=1e-14)
    finally:
        trees.TABLED_FEATURES = old


def test_mean_probabilities_are_read_from_a_table():
    rng = np.random.default_rng(3)
    offsets = rng.normal(0, 2, (5, 40))
    t = rng.normal(0, 3, (5, 3000))
    means = attribution.MeanProbabilities(offsets)
    want = attribution.expit(t[:, :, None] + offsets[:, None, :]).mean(axis=2)
    assert np.abs(means.at(t) - want).max() < 1e-12 and means.table is not None
    far = np.concatenate([t, np.array([[-5000.0, 90.0, 5000.0]] * 5)], axis=1)  # beyond any table
    want = attribution.expit(far[:, :, None] + offsets[:, None, :]).mean(axis=2)
    assert np.abs(means.at(far) - want).max() < 1e-12
    assert means.table.shape[2] <= attribution.MAX_NODES
    few = attribution.MeanProbabilities(offsets)
    assert np.abs(few.at(t[:, :3]) - want[:, :3]).max() < 1e-15 and few.table is None


def test_exact_shapley_meets_the_background_in_compiled_code(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (1, 0.0, 1.0), (2, None, 1.0), (None, 1.0, 1.0)], "patient_id int, a double, b double")
    background = [[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]]
    out = attribution.exact_shapley(df, ["a", "b"], lambda c: c["a"] * F.lit(2.0) + c["b"], background)
    assert "lambdafunction" not in plan_of(out)
    got = sorted(((r.patient_id, r.feature, None if r.phi is None else round(r.phi, 9)) for r in out.collect()), key=str)
    t = 1 / 3  # the background's means
    want = [(1, "a", 2 - 2 * t), (1, "b", -t), (1, "a", -2 * t), (1, "b", 1 - t), (2, "a", None), (2, "b", None), (None, "a", 2 - 2 * t), (None, "b", 1 - t)]
    assert got == sorted(((k, f, None if v is None else round(v, 9)) for k, f, v in want), key=str)


def test_medians_of_few_groups_are_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), (None, None)], "g string, v double")
        out = clean.group_median_fill(df, ["v"], "g")
        assert "SortMergeJoin" not in plan_of(out)
        assert sorted(map(str, out.collect())) == sorted(map(str, spark.createDataFrame(
            [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", None), (None, None)], "g string, v double").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("cap", [0, 1, 30, 300])
def test_test_rows_of_a_capped_split_are_not_ranked(spark, cap):
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 50 != 0, (F.col("id") % 3 == 0).cast("int")).alias("y"))
    part, rest = split.train_test_parts(df, "y", ["k"], max_train_rows=cap)
    assert "Exchange" not in plan_of(rest) and rest.where("fold IS NOT NULL").count() == 0
    got = {(r.k, r.fold) for r in part.unionByName(rest).collect()}
    order = {}
    for r in df.withColumn("h", split.hash_order(["k"])).orderBy("h").collect():
        order.setdefault(r.y, []).append(r.k)
    n_test = {y: int(0.2 * len(ks) + 0.5) for y, ks in order.items()}
    n = sum(len(ks) - n_test[y] for y, ks in order.items())
    want = set()
    for y, ks in order.items():
        want |= {(k, None) for k in ks[:n_test[y]]}
        want |= {(k, i % 3) for i, k in enumerate(ks[n_test[y]:n_test[y] + int((len(ks) - n_test[y]) * cap / n + 0.5)])}
    assert got == want and part.count() < 1500


def test_metrics_of_counted_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(["a", "b"][int(i % 2)], int(rng.random() < 0.4), float(rng.integers(0, 9)) / 8) for i in range(400)]
    df = spark.createDataFrame([(g, y, int(s > 0.5), s) for g, y, s in rows], "g string, y int, pred int, score double")
    counts = metrics.score_counts(df, by=["g"])
    assert sorted(metrics.classification_metrics(df, by=["g"]).collect()) == sorted(metrics.classification_of_counts(counts, by=["g"]).collect())
    assert sorted(metrics.ranking_metrics(df, by=["g"]).collect()) == sorted(metrics.ranking_of_counts(counts, ["g"]).collect())


def test_rows_are_dealt_over_all_cores(spark, sf):
    plain, dealt = load_intake(spark, sf, "b"), load_intake(spark, sf, "b", deal=True)
    assert dealt.rdd.getNumPartitions() >= TASKS_PER_CORE * spark.sparkContext.defaultParallelism > plain.rdd.getNumPartitions()
    assert dealt.exceptAll(plain).count() == 0 and plain.exceptAll(dealt).count() == 0
