"""Bulk scoring of whole intake tables against every disease (X16, X17, X18 with the saved winners).

Every patient's 20 scores are computed inside one row: the intake columns
are renamed out of the way (Spark resolves names case-insensitively, and
``age`` would clash with a panel's ``Age``), then for each disease the panel
columns, recipe columns and the model's inputs are added, the winner's
probability becomes one expression (a closed form, or a few trees walked over
node arrays), and the intermediates are dropped. Forests of many steps score
whole Arrow batches, all of them in one pass. The whole thing is a chain of
narrow steps over the intake scan: no join, no shuffle, no vectors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import rules
from ..functions.intake import interview_flags, projection
from ..functions.recipes import recipe_columns
from ..operators import attribution, triage
from ..operators.trees import tree_shapley, with_scores
from ..sources.panels import load_panel
from .train import load_artifacts, load_background, train_many

P = "i__"
#: tree steps per row that a forest may take as an expression; larger ones score whole Arrow batches, which is cheaper
MAX_ROW_STEPS = 64


def saved_winners(spark: SparkSession, sf: str, out_dir: str, diseases=tuple(config.TRAINING_ORDER), **kw) -> dict:
    """The saved winner of each disease; those without artifacts are trained together, saved and loaded (read-or-build)."""
    found = {d: load_artifacts(spark, out_dir, d) for d in diseases}
    missing = [d for d in diseases if found[d] is None]
    if missing:
        train_many({d: load_panel(spark, sf, d) for d in missing}, out_dir=out_dir, **kw)
        found.update({d: load_artifacts(spark, out_dir, d) for d in missing})
    return found


def _renamed(intake: DataFrame, kind: str) -> DataFrame:
    if kind == "a" and "has_fever" not in intake.columns:
        intake = interview_flags(intake)
    return intake.select(F.col("patient_id"), *[F.col(c).alias(P + c) for c in intake.columns if c != "patient_id"])


def _engineered(df: DataFrame, kind: str, disease: str) -> tuple:
    """``df`` with the panel and recipe columns of a disease, and their names."""
    panel = projection(kind, disease, P)
    df = df.withColumns(dict(panel))
    recipe = recipe_columns(df.select(*[n for n, _ in panel]), disease)
    return df.withColumns(dict(recipe)), [n for n, _ in [*panel, *recipe]]


def score_wide(intake: DataFrame, kind: str, fitted: dict, rule_diseases=tuple(config.RULE_DISEASES)) -> DataFrame:
    """``patient_id`` + ``p_<disease>`` for every rule disease and every fitted model, in one row."""
    rule_diseases = [d for d in rule_diseases if d not in fitted]
    order = [f"p_{d}" for d in [*rule_diseases, *fitted]]
    df, batched = _renamed(intake, kind), {}
    for d in rule_diseases:
        df = df.withColumn(f"p_{d}", rules.rule_risk(d, dict(projection(kind, d, P))))
    for d, fit in fitted.items():
        df, added = _engineered(df, kind, d)
        if fit.is_tree and fit.model.steps() > MAX_ROW_STEPS:
            df = df.withColumn(f"x_{d}", F.array(*fit.features())).drop(*added)
            batched[f"p_{d}"] = f"x_{d}", fit.model
        else:
            df = fit.with_probability(df, f"p_{d}").drop(*added)
    if batched:
        df = with_scores(df, ["patient_id", *[p for p in order if p not in batched]], batched)
    return df.select("patient_id", *order)


def explain(eng: DataFrame, fit, background: DataFrame, keep=("patient_id",)) -> DataFrame:
    """Columns ``keep``, feature and phi of a disease's winner for every engineered row.

    Trees: exact Shapley values of the score. A logistic regression: Shapley values of its probability. Both take absent
    features from the saved background rows, at most ``train.BACKGROUND_ROWS`` training rows."""
    inputs, names = fit.features(), fit.feature_names()
    rows = [r["x"] for r in background.select(F.array(*inputs).alias("x")).collect()]
    if fit.is_tree:
        return tree_shapley(eng.withColumn("__x", F.array(*inputs)), "__x", names, fit.model, rows, keep)
    return attribution.logistic_shapley(eng.withColumn("__x", F.array(*inputs)), "__x", names, fit.model, rows, keep)


def explain_top_condition(spark: SparkSession, intake: DataFrame, kind: str, fitted: dict, out_dir: str) -> DataFrame:
    """Attributions of each patient's own top condition: patient_id, disease, feature, phi.

    The top condition comes from the row of all scores; each disease then explains its own patients."""
    diseases = list(fitted)
    wide = score_wide(intake, kind, fitted, ())
    top = triage.triage_report(wide, diseases).select("patient_id", F.col("top_disease_key").alias("disease"))
    # one written table: every disease's branch reads it, none scores all patients again
    base = _renamed(intake, kind).join(top, "patient_id").checkpoint(eager=True)
    out = None
    for d, fit in fitted.items():
        eng, _ = _engineered(base.where(F.col("disease") == d), kind, d)
        part = explain(eng, fit, load_background(spark, out_dir, d), ("patient_id", "disease"))
        out = part if out is None else out.unionByName(part)
    return out
