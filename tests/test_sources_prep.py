"""Sources (CSV, read-or-build, registry), preprocessing fit/transform, the driver contract."""

import os
import tempfile

import pytest

from riskloom.operators import prep
from riskloom.operators.clean import rename_target, split_features_target
from riskloom.sources import files, registry


def _tmp():
    return tempfile.mkdtemp(prefix="riskloom-test-")


def test_csv_null_token_and_nan(spark):
    d = _tmp()
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write("1,?,2.5\n2,NaN,?\n")
    df = files.read_csv(spark, p, "id int, a double, b double", header=False, null_value="?")
    rows = {r.id: (r.a, r.b) for r in df.collect()}
    assert rows == {1: (None, 2.5), 2: (None, None)}


def test_materialize_reads_existing(spark):
    path = os.path.join(_tmp(), "t")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)
    assert files.materialize(spark, path, build).count() == 3
    assert files.materialize(spark, path, build).count() == 3
    assert len(calls) == 1


def test_registry_dispatch_and_error():
    assert registry.resolve_dataset("Hypertensive_Crisis") == "hypertensive_crisis"
    assert registry.resolve_dataset("vascular") == "hypertension"
    with pytest.raises(ValueError):
        registry.resolve_dataset("nope")


def test_load_all_in_training_order(spark, sf):
    frames = registry.load_all_datasets(spark, sf)
    assert list(frames)[:3] == ["diabetes", "heart", "kidney"] and len(frames) == 20


def test_rename_target_first_match(spark):
    df = spark.createDataFrame([(1, 0)], "Diabetes_01 int, target int")
    assert rename_target(df).columns == ["Outcome", "target"]
    with pytest.raises(KeyError):
        split_features_target(spark.createDataFrame([(1,)], "x int"))


def test_preprocessor_fit_on_train_only(spark):
    train = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, "b"), (5.0, None)], "x double, c string")
    m = prep.fit_preprocessor(train, ["x"], ["c"])
    assert m.medians["x"] == 3.0 and m.modes["c"] == "b" and m.categories["c"] == ["a", "b"]
    assert m.feature_names() == ["x", "c_a", "c_b"]
    test = spark.createDataFrame([(None, "zzz")], "x double, c string")
    r = m.transform(test).first()
    assert (r.c_a, r.c_b) == (0.0, 0.0)
    assert r.x == pytest.approx((3.0 - 3.0) / m.scales["x"])


def test_zero_variance_scale_is_one_and_mode_tie_smallest(spark):
    train = spark.createDataFrame([(2.0, "b"), (2.0, "a")], "x double, c string")
    m = prep.fit_preprocessor(train, ["x"], ["c"])
    assert m.scales["x"] == 1.0 and m.modes["c"] == "a"


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) > 100


def test_materialize_rebuilds_an_unfinished_folder(spark):
    path = os.path.join(_tmp(), "t")
    spark.range(5).write.parquet(path)
    os.remove(os.path.join(path, "_SUCCESS"))
    assert files.materialize(spark, path, lambda: spark.range(3)).count() == 3
    assert files.materialize(spark, path, lambda: spark.range(9)).count() == 3
