"""Forests as node arrays: scores against MLlib, Shapley values against enumeration of all coalitions."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import attribution, trees

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        x = [round(rng.gauss(0, 1), 2), float(rng.randint(0, 3)), rng.random() * 100, float(rng.randint(0, 1))]
        p = 1 / (1 + math.exp(-(x[0] * x[1] - x[2] / 30 + 2 * x[3])))
        rows.append((i, *x, float(rng.random() < p)))
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(
        spark.createDataFrame(rows, "patient_id long, a double, b double, c double, d double, label double")).cache()


@pytest.fixture(scope="module", params=["forest", "boosted"])
def fitted(request, spark, table, tmp_path_factory):
    est = RandomForestClassifier(numTrees=7, maxDepth=6, seed=3) if request.param == "forest" else GBTClassifier(maxIter=6, maxDepth=3, stepSize=0.3)
    model, path = est.fit(table), str(tmp_path_factory.mktemp("m") / "model")
    model.write().save(path)
    return model, trees.from_mllib(spark, model, path)


def test_score_is_that_of_mllib(table, fitted):
    model, forest = fitted
    rows = model.transform(table).withColumn("x", F.array(*NAMES)).select(
        vector_to_array("probability")[1].alias("want"), forest.probability("x").alias("got"), forest.score("x").alias("s"), "x").collect()
    assert max(abs(r.want - r.got) for r in rows) < 1e-12
    assert np.allclose([r.s for r in rows], forest.margins(np.array([r.x for r in rows])), atol=1e-12)
    assert len({round(r.got, 9) for r in rows}) > 20


def test_forest_survives_json(fitted):
    forest = fitted[1]
    again = trees.Forest.from_json(forest.to_json())
    assert again == forest and again.depth == forest.depth


def test_shapley_equals_enumeration(spark, table, fitted):
    forest = fitted[1]
    rows = [(r.patient_id, r.a, r.b, r.c, r.d) for r in table.limit(40).collect()]
    rows += [(1000, None, 1.0, 2.0, 0.0), (1001, float("nan"), None, None, None), (1002, 0.1, 1.0, 50.0, 1.0), (1002, 0.1, 1.0, 50.0, 1.0)]
    df = spark.createDataFrame(rows, "patient_id long, a double, b double, c double, d double").repartition(3)
    background = [[r.a, r.b, r.c, r.d] for r in table.orderBy(F.desc("patient_id")).limit(9).collect()] + [[None, 1.0, float("nan"), 0.0]]
    want = {(r.patient_id, r.feature): r.phi for r in attribution.exact_shapley(
        df, NAMES, lambda c: _score_of(forest, [c[n] for n in NAMES]), background).collect()}
    out = trees.tree_shapley(df.withColumn("x", F.array(*NAMES)), "x", NAMES, forest, background).collect()
    got = {(r.patient_id, r.feature): r.phi for r in out}
    assert len(out) == 4 * len(rows) and set(got) == set(want)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-10


def _score_of(forest, columns):
    """The forest's score as nested conditions (small forests only)."""
    def node(n):
        if forest.feature[n] < 0:
            return F.lit(forest.value[n])
        x = columns[forest.feature[n]]
        return F.when(x <= F.lit(forest.threshold[n]), node(forest.left[n])).otherwise(node(forest.right[n]))
    out = F.lit(forest.base)
    for r in forest.roots:
        out = out + node(r)
    return out


def test_phis_sum_to_the_score_minus_the_background(spark, table, fitted):
    forest = fitted[1]
    df = table.withColumn("x", F.array(*NAMES))
    background = [r.x for r in df.limit(100).collect()]
    out = trees.tree_shapley(df, "x", NAMES, forest, background).groupBy("patient_id").agg(F.sum("phi").alias("s"))
    base = forest.margins(np.array(background)).mean()
    rows = out.join(df.select("patient_id", forest.score("x").alias("score")), "patient_id").collect()
    assert len(rows) == 600 and max(abs(r.score - base - r.s) for r in rows) < 1e-9


def test_empty_forest_and_empty_table(spark, table):
    forest = trees.Forest([], [], [], [], [], [], 0.25)
    df = table.withColumn("x", F.array(*NAMES))
    assert {r.s for r in df.select(forest.score("x").alias("s")).collect()} == {0.25}
    assert {r.phi for r in trees.tree_shapley(df, "x", NAMES, forest, [[0.0] * 4]).collect()} == {0.0}
    assert trees.tree_shapley(df.limit(0), "x", NAMES, forest, [[0.0] * 4]).collect() == []
