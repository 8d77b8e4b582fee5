"""Scalar operators, rules, tiers and triage levels at their edges."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.functions import rules
from riskloom.functions.scalar import (cdc_age_code, clip_zero, recommendation, risk_tier, round_tenth,
                                       triage_level)


def _one(spark, expr, value, ddl="x double"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("o")).first().o


@pytest.mark.parametrize("p,tier", [(0.0, "Low Risk"), (0.3499999, "Low Risk"), (0.35, "Moderate Risk"),
                                    (0.6499999, "Moderate Risk"), (0.65, "High Risk"), (1.0, "High Risk"),
                                    (None, None)])
def test_risk_tier_cuts(spark, p, tier):
    assert _one(spark, risk_tier("x"), p) == tier


@pytest.mark.parametrize("pct,tier,level", [
    (65.0, "CRITICAL EMERGENCY", "Medical Guidance"), (65.01, "CRITICAL EMERGENCY", "Emergency"),
    (80.0, "Severe Organic", "Medical Guidance"), (50.0, "Everyday Acute", "Self Care"),
    (50.01, "Everyday Acute", "Medical Guidance")])
def test_triage_level(spark, pct, tier, level):
    df = spark.createDataFrame([(pct, tier)], "pct double, tier string")
    assert df.select(triage_level("pct", "tier")).first()[0].startswith(level)


@pytest.mark.parametrize("pct,start", [(40.0, "Rest"), (40.01, "Book"), (65.0, "Book"), (65.01, "Go")])
def test_recommendation(spark, pct, start):
    assert _one(spark, recommendation("x"), pct).startswith(start)


@pytest.mark.parametrize("age,code", [(1, 1), (17, 1), (18, 1), (22, 1), (23, 2), (27, 2), (28, 3), (77, 12),
                                      (78, 13), (100, 13)])
def test_cdc_age_code_floor_division(spark, age, code):
    assert _one(spark, cdc_age_code("x"), age, "x int") == code


def test_clip_zero_keeps_null(spark):
    assert _one(spark, clip_zero("x"), None) is None
    assert _one(spark, clip_zero("x"), -2.0) == 0.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=60, allow_nan=False), min_size=1, max_size=30))
def test_round_tenth_matches_python(spark, xs):
    xs = [x * 0.3 for x in xs] + [7.05, 0.15, 0.35, 2.25, 23.5 * 0.3]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r.o for r in df.select(round_tenth("x").alias("o")).collect()]
    assert got == [round(x, 1) for x in xs]


def test_rule_null_comparison_is_false_null_term_is_null(spark):
    df = spark.createDataFrame([(None, 1, 1, 1), (39.0, None, 1, 1)],
                               "BodyTemp double, Chills int, BodyAches int, Headache int")
    a, b = [r.p for r in df.select(rules.rule_risk("fever").alias("p")).collect()]
    assert a == pytest.approx(1 / (1 + math.exp(-(-3.0 + 0.8 + 0.6 + 0.5))))
    assert b is None


def test_no_rule_for_model_diseases():
    with pytest.raises(ValueError):
        rules.rule_risk("heart")
