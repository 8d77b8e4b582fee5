"""Per-prediction feature attribution.

* ``linear_attribution``: closed form for a linear score (a logistic rule or a
  logistic-regression margin): ``phi_j = coef_j · (x_j − mean_bg(x_j))``. One
  projection; the background means are one row computed once.
* ``sampled_shapley``: model-agnostic permutation sampling. Each row is
  exploded into ``n_perm × (F + 1)`` coalitions (features before position k of
  permutation m come from the row, the rest from background row m), scored
  in bulk by any per-row scorer (an expression or an MLlib model), and every
  score is credited ``±1/n_perm`` to the feature it adds or removes. The
  exploded rows of one input row stay in its task, so the per-row sums are
  combined map-side before the shuffle; the background is a bounded set of
  rows (default 100) held as literals.
* ``exact_shapley``: all coalitions of a few features against the whole background, row by background row, summed map-side.
* ``logistic_shapley``: Shapley values of a logistic regression's probability, by weighted least squares over coalitions.
* ``global_importance``: mean absolute attribution per feature.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_code
from .trees import matrix_of


def linear_attribution(df: DataFrame, terms: dict, background: DataFrame, key: str = "patient_id") -> DataFrame:
    """``terms``: feature name → (coefficient, Column giving the feature's value). Long output
    ``(key, feature, phi)``."""
    names = list(terms)
    bg = background.agg(*[F.avg(terms[n][1]).alias(f"_m{i}") for i, n in enumerate(names)]).first()
    rows = []
    for i, n in enumerate(names):
        coef, x = terms[n]
        phi = F.lit(float(coef)) * (x - F.lit(bg[f"_m{i}"]).cast("double"))
        rows.append(F.struct(F.lit(n).alias("feature"), phi.alias("phi")))
    return df.select(F.col(key), F.inline(F.array(*rows)))


def sampled_shapley(df: DataFrame, features: Sequence[str], scorer: Callable[[DataFrame], Column | DataFrame],
                    background_rows: Sequence[Sequence[float]], n_perm: int = 16, seed: int = 42,
                    key: str = "patient_id") -> DataFrame:
    """Permutation-sampled Shapley values of ``scorer`` (a function of the feature columns) per row.

    ``background_rows``: ≤ a few hundred reference rows (values in ``features`` order); permutation m
    uses background row ``m mod len(background_rows)``. ``scorer`` returns either a Column over the
    feature columns (a rule or linear margin) or the frame with a ``_v`` score column appended (e.g.
    an MLlib model's ``transform``). Output ``(key, feature, phi)``; ``phi`` is null for a row with a
    coalition whose score is null. ``key`` is unique."""
    f = len(features)
    rng = np.random.RandomState(seed)
    perms = [list(rng.permutation(f)) for _ in range(n_perm)]
    pos = [[p.index(j) for j in range(f)] for p in perms]  # position of feature j in permutation m
    bg = [list(background_rows[m % len(background_rows)]) for m in range(n_perm)]
    pos_lit = F.array(*[F.array(*[F.lit(int(v)) for v in row]) for row in pos])
    bg_lit = F.array(*[F.array(*[F.lit(None if v is None else float(v)).cast("double") for v in row]) for row in bg])
    ex = (df.select(F.col(key), *[F.col(f"`{c}`").cast("double").alias(f"_x{j}") for j, c in enumerate(features)])
          .withColumn("_m", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))))
          .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(f)))))
    m1 = F.col("_m") + F.lit(1)
    mixed = {}
    for j, c in enumerate(features):
        pj = F.element_at(F.element_at(pos_lit, m1), j + 1)
        bj = F.element_at(F.element_at(bg_lit, m1), j + 1)
        mixed[c] = F.when(pj < F.col("_k"), F.col(f"_x{j}")).otherwise(bj)
    scored = ex.select(F.col(key), "_m", "_k", *[v.alias(c) for c, v in mixed.items()])
    res = scorer(scored)
    if isinstance(res, DataFrame):
        scored = res.select(key, "_m", "_k", "_v")
    else:
        scored = scored.select(key, "_m", "_k", res.alias("_v"))
    credit = []
    for j in range(f):
        pj = F.element_at(F.element_at(pos_lit, m1), j + 1)
        sign = F.when(F.col("_k") == pj + 1, F.lit(1.0)).when(F.col("_k") == pj, F.lit(-1.0)).otherwise(F.lit(0.0))
        credit.append(F.sum(F.col("_v") * sign).alias(f"_phi{j}"))
    # a row with a coalition that has no score has no attribution
    agg = scored.groupBy(key).agg(*credit, F.count_if(F.col("_v").isNull()).alias("_unscored"))
    rows = [F.struct(F.lit(c).alias("feature"), F.when(F.col("_unscored") == 0, F.col(f"_phi{j}") / F.lit(float(n_perm))).alias("phi"))
            for j, c in enumerate(features)]
    return agg.select(F.col(key), F.inline(F.array(*rows)))


MAX_EXACT_FEATURES = 8


def exact_shapley(df: DataFrame, features: Sequence[str], scorer: Callable[[dict], Column],
                  background_rows: Sequence[Sequence[float]], key: str = "patient_id") -> DataFrame:
    """Exact Shapley values by enumerating all ``2^F`` coalitions of a few features.

    ``scorer`` maps a dict (feature → Column) to the score. A coalition's value is its mean score over the background
    rows (a bounded literal array), the other features taken from there. A row meets each background row in compiled
    code, all coalitions at once; its pairs lie in its task, which sums them before the shuffle, so that one small row
    of sums per input row is moved. (Higher-order functions over the background would be interpreted: 1600 scores a row
    of four features.) Output ``(key, feature, phi)``; ``phi`` is null for a row with a coalition that has no score."""
    f = len(features)
    if f > MAX_EXACT_FEATURES:
        raise ValueError(f"exact enumeration takes at most {MAX_EXACT_FEATURES} features; use sampled_shapley")
    bg = F.array(*[F.struct(*[F.lit(None if v is None else float(v)).cast("double").alias(f"_b{j}") for j, v in enumerate(row)])
                   for row in background_rows])
    own = df.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"),
                    *[F.col(f"`{c}`").cast("double").alias(f"_x{j}") for j, c in enumerate(features)])
    pairs = own.select("*", F.inline(bg))
    scored = pairs.select("_row", "_key", *[scorer({c: F.col(f"_x{j}" if m >> j & 1 else f"_b{j}") for j, c in enumerate(features)}).alias(f"_v{m}")
                                            for m in range(1 << f)])
    unscored, phis = F.lit(False), []
    for m in range(1 << f):
        unscored = unscored | F.col(f"_v{m}").isNull()
    for j in range(f):
        phi = F.lit(0.0)
        for m in range(1 << f):
            if not m >> j & 1:
                n = bin(m).count("1")
                weight = math.factorial(n) * math.factorial(f - n - 1) / math.factorial(f)
                phi = phi + F.lit(weight) * (F.col(f"_v{m | 1 << j}") - F.col(f"_v{m}"))
        phis.append(phi.alias(f"_phi{j}"))
    sums = scored.select("_row", "_key", *phis, unscored.alias("_unscored")).groupBy("_row", "_key").agg(
        *[F.sum(f"_phi{j}").alias(f"_phi{j}") for j in range(f)], F.max("_unscored").alias("_unscored"))
    rows = [F.struct(F.lit(c).alias("feature"), F.when(~F.col("_unscored"), F.col(f"_phi{j}") / F.lit(float(len(background_rows)))).alias("phi"))
            for j, c in enumerate(features)]
    return sums.select(F.col("_key").alias(key), F.inline(F.array(*rows)))


#: coalitions of the least squares, beyond two per feature; all of them where there are no more
COALITIONS = 2048


def coalitions(f: int, limit: int | None = None, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Coalitions of ``f`` features (rows of 0 and 1, neither empty nor full) and their Shapley kernel weights.

    All of them if they are at most ``limit`` (2 f + ``COALITIONS``). Otherwise whole sizes from both ends as long as they
    fit, and the rest drawn in complementary pairs, sizes by their weight."""
    limit = 2 * f + COALITIONS if limit is None else limit
    sizes = np.arange(1, f)
    mass = {int(s): (f - 1) / (s * (f - s)) for s in sizes}  # of all coalitions of a size
    if (1 << f) - 2 <= limit:
        masks = np.arange(1, (1 << f) - 1)
        rows = (masks[:, None] >> np.arange(f)) & 1
        return rows.astype(float), np.array([mass[s] / math.comb(f, s) for s in rows.sum(axis=1).tolist()])
    rows, weights, left = [], [], dict(mass)
    for s in range(1, f // 2 + 1):
        pair = {s, f - s}
        if len(rows) + sum(math.comb(f, k) for k in pair) > limit:
            break
        for k in pair:
            got = [[float(j in set(c)) for j in range(f)] for c in itertools.combinations(range(f), k)]
            rows += got
            weights += [mass[k] / len(got)] * len(got)
            left.pop(k)
    rng, total, count = np.random.RandomState(seed), sum(left.values()), limit - len(rows)
    if left and count > 1:
        share = np.array([left[s] for s in left]) / total
        drawn: dict = {}
        for s in rng.choice(list(left), count // 2, p=share):
            c = np.zeros(f)
            c[rng.permutation(f)[:s]] = 1.0
            for row in (c, 1.0 - c):
                drawn[tuple(row)] = drawn.get(tuple(row), 0) + 1
        n = sum(drawn.values())
        rows += [list(r) for r in drawn]
        weights += [total * k / n for k in drawn.values()]
    return np.array(rows), np.array(weights)


def logistic_shapley(df: DataFrame, x: str, names: Sequence[str], model, background: Sequence[Sequence[float]],
                     keep: Sequence[str] = ("patient_id",), limit: int | None = None) -> DataFrame:
    """Shapley values of a logistic regression's probability; columns ``keep``, feature and phi.

    A coalition's value is the mean probability with its features from the row and the others from each background row.
    The phis solve the least squares over the coalitions, weighted by the Shapley kernel, under the condition that they
    sum to the row's probability minus the background's mean. With all coalitions (``coalitions``) they are the exact
    Shapley values. The system's matrix is the same for every row and is inverted once; rows come in Arrow batches, a
    few at a time, so that memory stays bounded. A coalition's value depends on the row by one number only, its part of
    the margin, and is read from a table of that (``MeanProbabilities``), so that a row does not pay for the background.
    A row with a null or NaN feature has null phis."""
    ship_code(df.sparkSession)
    keep, f = list(keep), len(names)
    rows = df.select(*keep, F.col(x).cast("array<double>").alias("_x"))
    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField("_phi", T.ArrayType(T.DoubleType()))])
    beta, intercept = np.array(model.coefficients, float), float(model.intercept)
    back = np.array([list(b) for b in background], float) * beta

    def run(batches):
        if f > 1:
            z, w = coalitions(f, limit)
            # the last feature follows from the sum
            a = z[:, :-1] - z[:, -1:]
            solve = np.linalg.pinv(a.T @ (a * w[:, None])) @ (a * w[:, None]).T
            # margins of the background's part, per coalition and background row
            means = MeanProbabilities(intercept + (1.0 - z) @ back.T)
        base = expit(intercept + back.sum(axis=1)).mean()
        for batch in batches:
            own = matrix_of(batch.column("_x"), f) * beta
            missing = np.isnan(own).any(axis=1)
            own[missing] = 0.0
            total = expit(intercept + own.sum(axis=1)) - base
            phi = np.empty((len(own), f))
            if f == 1:
                phi[:, 0] = total
            else:
                step = max(1, 8_000_000 // len(z))
                for at in range(0, len(own), step):
                    value = means.at(z @ own[at:at + step].T) - base
                    value -= z[:, -1:] * total[at:at + step]
                    phi[at:at + step, :-1] = (solve @ value).T
                phi[:, -1] = total - phi[:, :-1].sum(axis=1)
            phi[missing] = np.nan
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * f)
            flat = pa.array(phi.ravel(), from_pandas=True)  # NaN: null
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.ListArray.from_arrays(offsets, flat)], names=[*keep, "_phi"])
    named = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("_phi").alias("phi"))
    return rows.mapInArrow(run, schema).select(*keep, F.inline(named))


#: distance of the nodes that mean probabilities are expanded at, and the terms: off by less than 1e-13
NODE, TERMS = 0.125, 8
#: nodes that a table may have; margins outside are computed directly
MAX_NODES = 1024


def _taylor() -> np.ndarray:
    """Row d: the d-th derivative of the sigmoid s over d!, as the coefficients of s, s^2, ..."""
    out, poly = np.zeros((TERMS, TERMS)), np.zeros(TERMS + 1)
    poly[0] = 1.0
    for d in range(TERMS):
        out[d] = poly[:TERMS] / math.factorial(d)
        n = np.arange(1, TERMS + 2)
        poly = n * poly - np.concatenate([[0.0], (n * poly)[:-1]])  # s^n has the slope n s^n - n s^(n+1)
    return out


class MeanProbabilities:
    """Per row of ``offsets`` the mean of ``expit(t + offset)`` as a function of t.

    The function is smooth, so it is expanded at evenly spaced nodes that cover the margins met so far; few margins, and
    those far from the others, are computed directly."""

    def __init__(self, offsets: np.ndarray):
        self.offsets, self.low, self.table = offsets, 0, None

    def at(self, t: np.ndarray) -> np.ndarray:
        """The means at ``t``, a row of values per row of the offsets."""
        low, high = (int(np.rint(x / NODE)) for x in (t.min(initial=np.inf), t.max(initial=-np.inf))) if t.size else (0, -1)
        size = 0 if self.table is None else self.table.shape[2]
        if low < self.low or high >= self.low + size:
            ends = (low, high + 1) if self.table is None else (min(low, self.low), max(high + 1, self.low + size))
            spare = (ends[1] - ends[0]) // 8 + 1
            low, high = ends[0] - spare, ends[1] + spare
            if high - low > MAX_NODES:  # all that lies around 0; what is outside stays direct
                low, high = -MAX_NODES // 2, MAX_NODES // 2
            if t.shape[1] >= high - low and (low, high) != (self.low, self.low + size):
                self.low, self.table = low, self._expanded(low, high)
                size = high - low
        out = np.empty(t.shape)
        if self.table is None:
            self._direct(t, np.arange(t.shape[1]), out)
            return out
        node, rest, term, place = *(np.empty(t.shape[1]) for _ in range(3)), np.empty(t.shape[1], np.int64)
        for row, coefficients, values in zip(t, self.table, out):
            np.rint(np.multiply(row, 1.0 / NODE, out=node), out=node)
            np.subtract(row, np.multiply(node, NODE, out=rest), out=rest)
            node -= self.low
            place[:] = node
            coefficients[-1].take(place, out=values, mode="clip")
            for c in coefficients[-2::-1]:
                values *= rest
                c.take(place, out=term, mode="clip")
                values += term
        if t.size and not (self.low <= t.min() / NODE and t.max() / NODE <= self.low + size - 1):
            self._direct(t, np.flatnonzero(((t < self.low * NODE) | (t > (self.low + size - 1) * NODE)).any(axis=0)), out)
        return out

    def _direct(self, t: np.ndarray, columns: np.ndarray, out: np.ndarray) -> None:
        step = max(1, 4_000_000 // self.offsets.size)
        for first in range(0, len(columns), step):
            some = columns[first:first + step]
            out[:, some] = expit(t[:, some, None] + self.offsets[:, None, :]).mean(axis=2)

    def _expanded(self, low: int, high: int) -> np.ndarray:
        """Per row and term the coefficients at the nodes ``low`` up to ``high`` (excluded)."""
        nodes, taylor = np.arange(low, high) * NODE, _taylor()
        out = np.empty((len(self.offsets), TERMS, high - low))
        for row, offsets in zip(out, self.offsets):
            s = expit(nodes[:, None] + offsets)
            power, moments = s, np.empty((TERMS, high - low))
            for d in range(TERMS):
                moments[d] = power.mean(axis=1)
                power = power * s
            row[:] = taylor @ moments
        return out


def expit(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700)))


def global_importance(attr: DataFrame) -> DataFrame:
    """Mean |phi| per feature (rows with a null phi are skipped)."""
    return attr.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"), F.count("phi").alias("n"))
