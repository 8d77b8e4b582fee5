"""Metrics against brute-force definitions; splits disjoint, complete and exact in class shares."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from riskloom.operators import metrics, split


def brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    if not pos or not neg:
        return 0.5
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def brute_ap(ys, ss):
    P = sum(ys)
    if P == 0 or P == len(ys):
        return 0.5
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(ss), reverse=True):
        tp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(lambda x: x / 6)), min_size=1, max_size=40))
def test_auc_ap_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "y int, score double")
    ys, ss = [r[0] for r in rows], [r[1] for r in rows]
    assert metrics.roc_auc(df).first()[0] == pytest.approx(brute_auc(ys, ss))
    assert metrics.average_precision(df).first()[0] == pytest.approx(brute_ap(ys, ss))
    both = metrics.ranking_metrics(df).first()
    assert both.roc_auc == pytest.approx(brute_auc(ys, ss)) and both.avg_precision == pytest.approx(brute_ap(ys, ss))


def test_prf1_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, pred int")
    r = metrics.classification_metrics(df).first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)
    assert r.accuracy == pytest.approx(2 / 3)
    cm = {x.truth: (x.pred_0, x.pred_1) for x in metrics.confusion_matrix(df).collect()}
    assert cm == {0: (2, 0), 1: (1, 0)}


def test_stratified_split_exact_and_disjoint(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = split.stratified_split(df, "y", ["k"]).toPandas()
    assert len(out) == 1003 and out.k.is_unique
    for y, part in out.groupby("y"):
        assert (part.split == "test").sum() == round(len(part) * 0.2)
    again = split.stratified_split(df, "y", ["k"]).toPandas()
    assert out.sort_values("k").split.tolist() == again.sort_values("k").split.tolist()


def test_folds_balanced(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    out = split.stratified_folds(df, "y", ["k"], 3).toPandas()
    counts = out.groupby(["y", "fold"]).size().unstack()
    assert (counts.max(axis=1) - counts.min(axis=1)).max() <= 1


def test_stratified_cap_keeps_shares(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    out = split.stratified_cap(df, "y", ["k"], 100).toPandas()
    assert len(out) == 100 and (out.y == 1).sum() == 25
    assert split.stratified_cap(df, "y", ["k"], None).count() == 1000


def test_split_keeps_rows_with_null_label(spark):
    rows = [(i, None if i % 10 == 0 else i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, y int")
    out = split.stratified_split(df, "y", ["k"]).toPandas()
    assert len(out) == 200
    nulls = out[out.y.isna()]
    assert len(nulls) == 20 and (nulls.split == "test").sum() == 4


def test_confusion_matrix_has_both_truth_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (1, 1)], "y int, pred int")
    got = {x.truth: (x.pred_0, x.pred_1) for x in metrics.confusion_matrix(df).collect()}
    assert got == {0: (0, 0), 1: (1, 2)}


def test_value_counts_and_correlations_are_ranked(spark):
    from riskloom.operators import profile
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "v string")
    assert [(r.v, r["count"], r["rank"]) for r in profile.value_counts(df, "v").orderBy("rank").collect()] == [
        ("b", 2, 1), ("a", 1, 2), ("c", 1, 3)]
    num = spark.createDataFrame([(1.0, -1.0, 1), (2.0, -2.0, 2), (3.0, -3.5, 3)], "x double, z double, t int")
    got = [(r.feature, r["rank"]) for r in profile.corr_with_target(num, ["x", "z"], "t").orderBy("rank").collect()]
    assert got == [("t", 1), ("x", 2), ("z", 3)]


def test_density_of_values_far_from_zero(spark):
    from riskloom.operators import distribution
    df = spark.range(1000).select((F.lit(1e9) + F.col("id") / 1000.0).alias("v"))
    got = distribution.kde(df, "v").collect()
    assert len(got) == 200
    step = got[1].x - got[0].x
    assert abs(sum(r.density for r in got) * abs(step) - 1) < 0.01


def test_full_shuffle_is_the_same_for_any_partitioning(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    a, b = ({r.k: r.position for r in split.full_shuffle(x, ["k"]).collect()} for x in (df.repartition(1), df.repartition(7)))
    assert a == b and sorted(a.values()) == list(range(1, 301))
    assert a != {r.k: r.position for r in split.full_shuffle(df, ["k"], seed=7).collect()}
    assert [k for k, _ in sorted(a.items(), key=lambda x: x[1])] != list(range(300))
    assert split.full_shuffle(df.limit(0), ["k"]).collect() == []
