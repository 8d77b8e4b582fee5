"""Leakage-free preprocessing (X1-X6): fit on training rows, apply anywhere.

``fit_preprocessor`` runs a bounded number of aggregation jobs on the
training frame (exact medians, then mean / population std of the imputed
numerics, then modes and sorted category lists) and keeps the fitted values
on the driver — one number per numeric column and one short list per
categorical column, like any fitted MLlib model. ``transform`` is then a
single projection with those values as literals: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


def _q(c):
    return F.col(f"`{c}`")


@dataclass
class PreprocessorModel:
    numeric: list[str]
    categorical: list[str]
    medians: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)

    def feature_names(self) -> list[str]:
        """Numerics, then ``<column>_<category>`` per categorical column (categories sorted)."""
        return list(self.numeric) + [f"{c}_{v}" for c in self.categorical for v in self.categories[c]]

    def impute_exprs(self) -> dict:
        out = {c: F.coalesce(_q(c).cast("double"), F.lit(self.medians[c])) for c in self.numeric}
        out.update({c: F.coalesce(_q(c).cast("string"), F.lit(self.modes[c])) for c in self.categorical})
        return out

    def feature_exprs(self, scaled: bool = True, categories: dict | None = None) -> list:
        """``[(feature_name, Column)]`` in feature order (imputed numerics, scaled unless told otherwise, one-hot
        categoricals; ``categories``: other lists of categories to make columns of)."""
        out = []
        for c in self.numeric:
            x = F.coalesce(_q(c).cast("double"), F.lit(self.medians[c]))
            out.append((c, (x - F.lit(self.means[c])) / F.lit(self.scales[c]) if scaled else x))
        for c in self.categorical:
            x = F.coalesce(_q(c).cast("string"), F.lit(self.modes[c]))
            for v in (categories or self.categories)[c]:
                out.append((f"{c}_{v}", (x == F.lit(v)).cast("double")))
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Imputed + scaled numerics and one-hot categoricals (unknown category → all zeros)."""
        cols = [_q(k) for k in keep]
        for c in self.numeric:
            x = F.coalesce(_q(c).cast("double"), F.lit(self.medians[c]))
            cols.append(((x - F.lit(self.means[c])) / F.lit(self.scales[c])).alias(c))
        for c in self.categorical:
            x = F.coalesce(_q(c).cast("string"), F.lit(self.modes[c]))
            for v in self.categories[c]:
                cols.append((x == F.lit(v)).cast("double").alias(f"{c}_{v}"))
        return df.select(*cols)


def fit_medians(train: DataFrame, cols: Sequence[str]) -> dict:
    """Exact medians (interpolated) of the training rows."""
    if not cols:
        return {}
    rows = exact_quantiles(train, cols, [0.5]).select("column", "value").collect()
    got = {r["column"]: r["value"] for r in rows}
    return {c: got.get(c) for c in cols}


def fit_modes(train: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent value; ties go to the smallest.

    Counted as ``groupBy(column, value).count()`` (map-side combined, spread over the cluster) and
    reduced with two small aggregations, so no task ever holds every distinct value of a column
    (the built-in ``mode`` merges them all in one buffer)."""
    if not cols:
        return {}
    got = {r["column"]: r["mode"] for r in _top_values(_value_counts(train, cols)).collect()}
    return {c: got.get(c) for c in cols}


def _value_counts(train: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    long = train.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), _q(c).cast("string").alias("value")) for c in cols])))
    return long.where(F.col("value").isNotNull()).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def _top_values(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The most frequent value per column, the smallest of equals."""
    best = counts.groupBy(*by, "column", "n").agg(F.min("value").alias("value"))
    return best.groupBy(*by, "column").agg(F.max_by("value", "n").alias("mode"))


# a one-hot column per category: more than this many is a mistake in the column list, not a model
MAX_CATEGORIES = 100_000


def _check_categories(n: int) -> None:
    if n > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories to one-hot encode")


def fit_categories(train: DataFrame, cols: Sequence[str], modes: dict) -> dict:
    """Sorted distinct categories of each (mode-imputed) column, counted per value and checked before they come
    to the driver. The mode is a value of the column, so imputing adds none."""
    if not cols:
        return {}
    seen = _value_counts(train, cols).select("column", "value").limit(MAX_CATEGORIES + 1).collect()
    _check_categories(len(seen))
    return {c: sorted({r["value"] for r in seen if r["column"] == c}) for c in cols}


def fit_preprocessors(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], folds: int,
                      fold: str = "fold") -> dict:
    """X5 for the whole training frame (key ``None``) and for each frame without one fold (keys 0..folds−1).

    Every statistic of all frames comes from one job: a row counts for the whole frame and for each frame that
    does not leave its fold out, as one group each."""
    frames = [None, *range(folds)]
    key = F.array(F.lit(-1), *[F.when(F.col(fold) != F.lit(f), F.lit(f)) for f in range(folds)])
    rows = train.withColumn("_frame", F.explode(F.array_compact(key)))
    models = {f: PreprocessorModel(list(numeric), list(categorical)) for f in frames}
    name = {f: -1 if f is None else f for f in frames}
    if numeric:
        got = {(r["_frame"], r["column"]): r["value"]
               for r in exact_quantiles(rows, numeric, [0.5], ["_frame"]).select("_frame", "column", "value").collect()}
        for f, m in models.items():
            m.medians = {c: got.get((name[f], c)) for c in numeric}

        def imputed(c):
            med = F.lit(None).cast("double")
            for f, m in models.items():
                med = F.when(F.col("_frame") == name[f], F.lit(m.medians[c]).cast("double")).otherwise(med)
            return F.coalesce(_q(c).cast("double"), med)
        imp = rows.select("_frame", *[imputed(c).alias(f"_{i}") for i, c in enumerate(numeric)])
        stats = {r["_frame"]: r for r in imp.groupBy("_frame").agg(
            *[F.avg(f"_{i}").alias(f"m{i}") for i in range(len(numeric))],
            *[F.stddev_pop(f"_{i}").alias(f"s{i}") for i in range(len(numeric))]).collect()}
        for f, m in models.items():
            r = stats.get(name[f])
            for i, c in enumerate(numeric):
                s = r[f"s{i}"] if r else None
                m.means[c] = r[f"m{i}"] if r else None
                m.scales[c] = 1.0 if (s is None or s == 0.0) else s
    if categorical:
        counts = _value_counts(rows, categorical, ["_frame"])
        best = {(r["_frame"], r["column"]): r["mode"] for r in _top_values(counts, ["_frame"]).collect()}
        seen = counts.where(F.col("value").isNotNull()).select("_frame", "column", "value").limit(MAX_CATEGORIES + 1).collect()
        _check_categories(len(seen))
        for f, m in models.items():
            m.modes = {c: best.get((name[f], c)) for c in categorical}
            m.categories = {c: sorted({r["value"] for r in seen if r["_frame"] == name[f] and r["column"] == c}) for c in categorical}
    return models


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PreprocessorModel:
    """Median → standard scaling (population std, 0 → 1) for numerics; mode → one-hot for categoricals."""
    return fit_preprocessors(train, numeric, categorical, 0)[None]


def class_weight_balanced(df: DataFrame, label: str) -> DataFrame:
    """``n / (n_classes · n_c)`` per class, as a small ``(label, n_c, weight)`` frame."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    st = counts.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k")).first()
    n, k = F.lit(st["n"]).cast("long"), F.lit(st["k"]).cast("long")
    return counts.select(label, "n_c", (n / (k * F.col("n_c"))).alias("weight"))


def pos_weight(df: DataFrame, label: str) -> DataFrame:
    """``max(1, neg / max(1, pos))`` as a one-row frame."""
    c = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return c.select("pos", "neg", F.greatest(F.lit(1.0), F.col("neg") / F.greatest(F.lit(1), F.col("pos")))
                    .alias("scale_pos_weight"))
