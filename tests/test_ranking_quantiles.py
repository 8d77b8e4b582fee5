"""Distributed exact ranks and quantiles against brute force (pandas / numpy)."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from riskloom.operators import quantiles
from riskloom.operators.metrics import ranking_metrics
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.ranking import global_cumsum, global_row_number
from riskloom.session import ensure_checkpoint_dir


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(-5, 5).map(float))),
                min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.9, 1.0], ["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"]).dropna()
    for g, part in pdf.groupby("g"):
        for q in [0.0, 0.25, 0.5, 0.9, 1.0]:
            assert abs(got[(g, q)] - float(np.quantile(part.v.values, q))) < 1e-9
    assert {g for g, _ in got} == set(pdf.g)


@pytest.mark.parametrize("limits", [{}, {"SMALL_GROUP": 12, "MAX_BETWEEN": 12, "GRID": 10, "SKETCH_ACCURACY": 40, "MARGIN": 0.02}])
def test_narrowing_over_several_rounds(spark, monkeypatch, limits):
    """Small limits take many rounds; hot values, far outliers, infinities, NaN, nulls and a null group included."""
    for k, v in limits.items():
        monkeypatch.setattr(quantiles, k, v)
    rounds = []
    once = quantiles._round
    monkeypatch.setattr(quantiles, "_round", lambda *a: rounds.append(1) or once(*a))
    rng = np.random.RandomState(1)
    n = 6000
    group = rng.choice(np.array(["a", "b", None], object), n, p=[0.6, 0.3, 0.1])
    pdf = pd.DataFrame({"g": group, "x": rng.lognormal(0, 30, n), "y": rng.choice([7.0, 7.0, 8.0, -1.0], n), "z": rng.randn(n)})
    pdf.loc[rng.rand(n) < 0.4, "z"] = 0.25
    pdf.loc[:3, "x"], pdf.loc[4:6, "x"] = np.inf, -np.inf
    rows = [(g, x, None if i % 50 == 0 else y, float("nan") if i % 40 == 0 else z, None) for i, (g, x, y, z) in enumerate(pdf.itertuples(index=False))]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double, nothing double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.999, 1.0]
    for by in ([], ["g"]):
        got = {(*[r[c] for c in by], r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["x", "y", "z", "nothing"], probs, by).collect()}
        want, parts = {}, {(): rows}
        if by:
            parts = {(g,): [r for r in rows if r[0] == g] for g in ("a", "b", None)}
        for key, part in parts.items():
            for i, c in enumerate("xyz"):
                v = sorted(r[i + 1] for r in part if r[i + 1] is not None and r[i + 1] == r[i + 1])
                for q in probs:
                    h = (len(v) - 1) * q
                    lo, hi = v[int(h)], v[min(int(h) + 1, len(v) - 1)]
                    want[(*key, c, q)] = lo + (hi - lo) * (h - int(h))
        assert set(got) == set(want)
        assert {k: (got[k], want[k]) for k in want if got[k] != want[k] and not (np.isnan(got[k]) and np.isnan(want[k]))} == {}
    assert len(rounds) >= (6 if limits else 2)


def test_more_groups_than_the_driver_narrows(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_RANKS", 20)
    rows = [(i % 37, float(i * i % 101)) for i in range(2000)]
    got = {r.g: r.value for r in exact_quantiles(spark.createDataFrame(rows, "g long, v double"), ["v"], [0.5], ["g"]).collect()}
    assert got == {g: float(np.median([v for h, v in rows if h == g])) for g in range(37)}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1]), st.integers(0, 1000)), min_size=1, max_size=80, unique_by=lambda t: t[1]))
def test_global_row_number_matches_window(spark, rows):
    df = spark.createDataFrame(rows, "y int, k int")
    got = {r.k: r.rn for r in global_row_number(df, ["y"], ["k"], out="rn", num_partitions=3).collect()}
    pdf = pd.DataFrame(rows, columns=["y", "k"])
    pdf["rn"] = pdf.groupby("y")["k"].rank(method="first").astype(int)
    assert got == dict(zip(pdf.k, pdf.rn))


def test_row_number_with_bucket_matches(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("y"), F.md5(F.col("id").cast("string")).alias("h"))
    a = {r.h: r.rn for r in global_row_number(df, ["y"], ["h"], out="rn").collect()}
    b = {r.h: r.rn for r in global_row_number(df, ["y"], ["h"], out="rn",
                                                bucket=F.conv(F.substring("h", 1, 2), 16, 10)).collect()}
    assert a == b


def test_ranks_with_null_keys(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", None]), float(rnd.randint(0, 50)), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, i long")
    got = {r.i: r.rn for r in global_row_number(df, ["g"], ["v", "i"], out="rn", num_partitions=7).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v", "i"]).fillna({"g": "<null>"})
    pdf["rn"] = pdf.sort_values(["v", "i"]).groupby("g").cumcount() + 1
    assert {i: r for i, r in zip(pdf.i, pdf.rn)} == got


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_running_sums_of_600k_rows(spark, reuse):
    """Many distinct values after a shuffle, two weights (one fractional), extra columns, several keys."""
    n = 600_000
    df = spark.range(n).select(
        (F.col("id") % 3).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(1024.0)).alias("v"), "id",
        (F.col("id") % 7).alias("w"), (F.col("id") % 4 / F.lit(2.0)).alias("x"), F.lit("more").alias("extra")).repartition(5, "v")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = global_cumsum(df, ["g"], ["v", "id"], ["w", "x"], num_partitions=6).toPandas()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert len(got) == n and (got.extra == "more").all()
    got = got.sort_values(["g", "v", "id"])
    for w in ("w", "x"):
        by = got.groupby("g")[w]
        assert np.allclose(by.cumsum(), got[f"_cum_incl_{w}"])
        assert np.allclose(by.cumsum() - got[w], got[f"_cum_excl_{w}"])
        assert np.allclose(by.transform("sum"), got[f"_key_total_{w}"])


def test_auc_and_average_precision_of_600k_scores(spark):
    n = 600_000
    df = spark.range(n).select(
        (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40))).alias("u"), "id").select(
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0 < F.col("u"), 1).otherwise(0).alias("y"), F.col("u").alias("score"))
    pdf = df.toPandas().sort_values("score")
    y = pdf.y.to_numpy()
    pos, neg = y.sum(), (1 - y).sum()
    auc = (np.cumsum(1 - y) * y).sum() / (pos * neg)
    down = y[::-1]
    ap = (np.cumsum(down) / np.arange(1, n + 1) * down).sum() / pos
    got = ranking_metrics(df).first()
    assert abs(got.roc_auc - auc) < 1e-9 and abs(got.avg_precision - ap) < 1e-9


def test_quantiles_of_many_groups_stay_distributed(spark, monkeypatch):
    from riskloom.operators import quantiles
    monkeypatch.setattr(quantiles, "MAX_LOCAL_ROWS", 10)
    df = spark.range(600).select((F.col("id") % 50).alias("g"), F.col("id").cast("double").alias("v"))
    got = {r.g: r.value for r in exact_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    assert got == {g: g + 275.0 for g in range(50)}


def test_no_scratch_folder_on_a_cluster():
    from riskloom.session import is_one_machine
    assert is_one_machine("local") and is_one_machine("local[8]")
    assert not is_one_machine("local-cluster[2,1,1024]") and not is_one_machine("spark://host:7077") and not is_one_machine("yarn")

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
