"""Tree ensembles as node arrays: scores as expressions (X16), exact Shapley values.

A ``Forest`` is a flat node table: per node a feature, a threshold and two
children (``x <= threshold`` goes left; anything else, null and NaN too, goes
right), per leaf a value, and the root of each tree. Its score is the sum of
the leaves that a row reaches; ``link`` says how it becomes a probability.

* ``score``: a column expression. The node arrays are literals that Spark folds
  once; a higher-order function walks each tree inside the row, without vectors
  or a model's ``transform``. A step costs a few interpreted array lookups.
* ``with_scores``: the scores of several forests for whole Arrow batches, one step of
  a tree for all rows at once; for forests of hundreds of steps.
* ``tree_shapley``: exact Shapley values of the score for every row, the absent
  features taken from each of a fixed set of background rows. A leaf is a set of
  intervals, one per feature on its path. A row and a background row either
  satisfy a feature's interval or not; the leaf counts in a coalition if every
  feature is satisfied by the side it comes from, so its share per feature
  depends only on which features the row alone (u of them) and the background
  alone (v) satisfy: ``(u-1)! v! / (u+v)!`` times the value for the former,
  ``-u! (v-1)! / (u+v)!`` for the latter. Background rows that satisfy the same
  features of a leaf are counted once, and rows of a batch that do so share one
  computation. Leaf by leaf this takes whole Arrow batches: the same sums by
  higher-order functions in the row need one interpreted step per leaf, feature
  and background pattern of every row. Nothing is shuffled or exploded.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_code

#: features on one path: a leaf's patterns are bits of one integer
MAX_PATH_FEATURES = 62
#: pairs of a row and a tree that go down together: what they need stays in the processor's cache
WALKED = 16_384
#: 16 bits of a node's word; more than any code of a feature
LARGEST = 0xFFFF
#: rows of Shapley values that a task keeps, by what the forest can tell of their features
KNOWN_ROWS = 200_000
#: features on a path up to which a leaf's shares of all patterns may be tabled
TABLED_FEATURES = 12
#: rows of Shapley values computed at a time
SHAPLEY_STEP = 4_096
#: intervals whose rows are kept while leaves are gone through: 32 KB each
KNOWN_INTERVALS = 2_000


_NODE_COLUMNS = {"feature": np.int32, "threshold": float, "left": np.int32, "right": np.int32, "value": float, "roots": np.int32}


@dataclass(eq=False)
class Forest:
    feature: list      # of each node; -1 at a leaf (lists or arrays)
    threshold: list
    left: list
    right: list
    value: list        # of each leaf, as it enters the sum
    roots: list
    base: float = 0.0  # added to the sum
    link: str = "identity"  # identity: the sum is P(1); logistic: 1 / (1 + exp(-sum))

    def __post_init__(self):
        self.depth = _depth(self)

    def __eq__(self, other) -> bool:
        return isinstance(other, Forest) and (self.base, self.link) == (other.base, other.link) and all(
            np.array_equal(getattr(self, c), getattr(other, c)) for c in _NODE_COLUMNS)

    __hash__ = None

    def to_json(self) -> str:
        return json.dumps({**{c: np.asarray(getattr(self, c)).tolist() for c in _NODE_COLUMNS}, "base": float(self.base), "link": self.link})

    @classmethod
    def from_json(cls, text: str) -> "Forest":
        read = json.loads(text)
        # arrays: a forest of many rows has some 100 000 nodes
        return cls(**{**read, **{c: np.array(read[c], kind) for c, kind in _NODE_COLUMNS.items()}})

    # ------------------------------------------------------------ scores
    def score(self, x: str) -> Column:
        """The sum of the reached leaves, for the name of an array column of the features."""
        if not len(self.roots):
            return F.lit(float(self.base))
        nodes = range(len(self.feature))
        feature = _literal([max(0, f) for f in self.feature], "int")
        # a leaf is its own child on both sides
        left = _literal([self.left[i] if self.feature[i] >= 0 else i for i in nodes], "int")
        right = _literal([self.right[i] if self.feature[i] >= 0 else i for i in nodes], "int")
        threshold, value, roots = _literal(self.threshold, "double"), _literal(self.value, "double"), _literal(self.roots, "int")
        # the array is bound as a lambda variable, so it is computed once a row, not once a step
        return F.expr(f"""transform(array({x}), f -> aggregate({roots}, cast('{float(self.base)!r}' AS double), (s, r) -> s + {value}[
            aggregate(array_repeat(0, {self.depth}), r, (n, z) -> if(f[{feature}[n]] <= {threshold}[n], {left}[n], {right}[n]))]))[0]""")

    def probability(self, x: str) -> Column:
        s = self.score(x)
        # a mean of shares may pass 1 by a rounding
        return F.least(s, F.lit(1.0)) if self.link == "identity" else F.lit(1.0) / (F.lit(1.0) + F.exp(-s))

    def steps(self) -> int:
        """Comparisons per row."""
        return len(self.roots) * self.depth

    def cuts(self) -> list:
        """The sorted thresholds of each feature that a node tests; a row's values matter only by where they lie among them."""
        if not hasattr(self, "_cuts"):
            feature, threshold = np.array(self.feature, np.int64), np.array(self.threshold, float)
            self._cuts = [np.unique(threshold[feature == f]) for f in range(feature.max(initial=-1) + 1)]
        return self._cuts

    def codes(self, x: np.ndarray) -> np.ndarray:
        """How many thresholds lie below each value (NaN: above all), a row of codes per feature: ``x <= cuts[k]`` is ``code <= k``."""
        return np.array([cuts.searchsorted(x[:, f]) for f, cuts in enumerate(self.cuts())], np.int64).reshape(len(self.cuts()), len(x))

    def _walk(self) -> tuple:
        """(node words, values, roots) of the trees with the two children of a node side by side.

        A word holds the left child (its upper half), the tested feature and the code of the threshold (16 bits each); a
        leaf is its own child whatever the code."""
        if not hasattr(self, "_nodes"):
            order, place = _levels(self)
            feature = np.array(self.feature, np.int64)[order]
            cut = np.full(len(order), LARGEST, np.int64)
            for f, cuts in enumerate(self.cuts()):
                cut[feature == f] = cuts.searchsorted(np.array(self.threshold, float)[order][feature == f])
            if max([len(self.cuts()), *map(len, self.cuts())]) >= LARGEST:
                raise ValueError(f"a forest with {LARGEST} features or thresholds of one feature")
            self._nodes = place << 32 | np.maximum(feature, 0) << 16 | cut, np.array(self.value, float)[order]
        return self._nodes

    def margins(self, x: np.ndarray) -> np.ndarray:
        """``score`` of the rows of a matrix (for tasks and tests): all trees go down together, a few rows at a time."""
        if not len(self.roots):
            return np.full(len(x), float(self.base))
        codes = self.codes(x)
        # rows between the same thresholds reach the same leaves
        some, back = _distinct(codes, [len(c) + 1 for c in self.cuts()])
        return self._sums(codes if some is None else codes[:, some])[back]

    def _sums(self, codes: np.ndarray) -> np.ndarray:
        """The sums of the leaves that rows of ``codes`` reach."""
        word, value = self._walk()
        (features, size), trees = codes.shape, len(self.roots)
        out, step, at = np.full(size, float(self.base)), max(1, WALKED // trees), ()
        for first in range(0, size, step) if features else ():
            part = np.ascontiguousarray(codes[:, first:first + step].T)
            if len(part) * trees != len(at):
                n = len(part)
                rows, at, here, there, right = np.tile(np.arange(n) * features, trees), *(np.empty(n * trees, np.int64) for _ in range(3)), np.empty(n * trees, bool)
            at.reshape(trees, n)[:] = np.arange(trees)[:, None]
            part = part.ravel()
            for _ in range(self.depth):
                word.take(at, out=here, mode="clip")
                np.right_shift(here, 16, out=there)
                there &= LARGEST
                there += rows
                part.take(there, out=at, mode="clip")
                np.bitwise_and(here, LARGEST, out=there)
                np.greater(at, there, out=right)
                np.right_shift(here, 32, out=at)
                at += right
            # tree after tree, as the expression adds them
            out[first:first + n] = np.concatenate([out[None, first:first + n], value.take(at, mode="clip").reshape(trees, n)]).sum(axis=0)
        for v in value if not features else ():
            out += v
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        s = self.margins(x)
        return np.minimum(s, 1.0) if self.link == "identity" else 1.0 / (1.0 + np.exp(-np.clip(s, -700, 700)))

    # ------------------------------------------------------------ paths
    def leaves(self) -> Iterator[tuple]:
        """(value, features, lower bounds, upper bounds) of each leaf: ``not x <= low and x <= high``, None: no bound."""
        stack = [(r, {}) for r in self.roots]
        while stack:
            n, path = stack.pop()
            f = self.feature[n]
            if f < 0:
                if self.value[n] != 0.0:
                    names = sorted(path)
                    yield self.value[n], names, [path[x][0] for x in names], [path[x][1] for x in names]
                continue
            low, high = path.get(f, (None, None))
            t = self.threshold[n]
            stack.append((self.left[n], {**path, f: (low, t if high is None else min(t, high))}))
            stack.append((self.right[n], {**path, f: (t if low is None else max(t, low), high)}))


def with_scores(df: DataFrame, keep: Sequence[str], forests: dict) -> DataFrame:
    """Columns ``keep`` and, per entry of ``forests`` {name: (array column, forest)}, the probability under that name."""
    ship_code(df.sparkSession)
    rows = df.select(*keep, *[F.col(x).cast("array<double>").alias(f"_x{i}") for i, (x, _) in enumerate(forests.values())])
    schema = T.StructType([*rows.select(*keep).schema.fields, *[T.StructField(name, T.DoubleType()) for name in forests]])
    models = [forest for _, forest in forests.values()]

    def run(batches):
        for batch in batches:
            scores = []
            for i, forest in enumerate(models):
                column = batch.column(f"_x{i}")
                width = int(column.offsets[1].as_py()) if len(column) else 0
                scores.append(pa.array(forest.probabilities(matrix_of(column, width))))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *scores], names=[*keep, *forests])
    return rows.mapInArrow(run, schema)


def _distinct(codes: np.ndarray, widths: Sequence[int]) -> tuple:
    """(places of distinct columns, place of each column among them); (None, all) where most differ anyway."""
    if not len(codes) or math.prod(widths) >= 1 << 62:
        return None, slice(None)
    key = np.zeros(codes.shape[1], np.int64)
    for row, width in zip(codes, widths):
        key = key * width + row
    _, some, back = np.unique(key, return_index=True, return_inverse=True)
    return (some, back) if len(some) < 0.8 * len(key) else (None, slice(None))


def _levels(forest: Forest) -> tuple:
    """(nodes, level after level, the two children of a node side by side; place of each one's left child, a leaf's own)."""
    feature, left, right = (np.asarray(v, np.int64) for v in (forest.feature, forest.left, forest.right))
    level, order, place, start = np.asarray(forest.roots, np.int64), [], [], 0
    while len(level):
        inner = feature[level] >= 0
        after = start + len(level)
        place.append(np.where(inner, after + 2 * (np.cumsum(inner) - 1), np.arange(start, after)))
        order.append(level)
        level, start = np.column_stack([left[level[inner]], right[level[inner]]]).ravel(), after
    return (np.concatenate(order), np.concatenate(place)) if order else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _depth(forest: Forest) -> int:
    feature, left, right = (np.asarray(v, np.int64) for v in (forest.feature, forest.left, forest.right))
    deepest, level = 0, np.asarray(forest.roots, np.int64)
    while True:
        level = level[feature[level] >= 0]
        if not len(level):
            return deepest
        level, deepest = np.concatenate([left[level], right[level]]), deepest + 1


def _literal(values: Sequence, kind: str) -> str:
    """An array literal as SQL text that Spark folds once: thousands of values without a plan node each."""
    text = ",".join(repr(float(v)) if kind == "double" else str(int(v)) for v in values)
    return f"cast(split('{text}', ',') AS array<{kind}>)"


# ---------------------------------------------------------------- from MLlib
def from_mllib(spark, model, path: str) -> Forest:
    """The forest of a fitted MLlib tree classifier, read from the model saved at ``path`` (a folder all machines share).

    A random forest's probability is the mean of its trees' class shares; boosted trees enter a margin whose double is
    the log-odds.
    """
    boosted = type(model).__name__ == "GBTClassificationModel"
    weights = [float(w) for w in model.treeWeights]
    nodes = spark.read.parquet(f"{path.rstrip('/')}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").select(
        "treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("split.numCategories").alias("categories")).collect()
    first = {}
    for i, r in enumerate(nodes):  # ids of a tree count from 0 without gaps
        first.setdefault(r["treeID"], i)
    feature, threshold, left, right, value = [], [], [], [], []
    for r in nodes:
        at, leaf = first[r["treeID"]], r["leftChild"] < 0
        if not leaf and r["categories"] != -1:
            raise ValueError("splits on category sets are not supported; one-hot encode")
        total = sum(r["impurityStats"])
        share = r["impurityStats"][1] / total if not boosted and total else 0.0
        feature.append(-1 if leaf else r["feature"])
        threshold.append(0.0 if leaf else r["threshold"])
        left.append(-1 if leaf else at + r["leftChild"])
        right.append(-1 if leaf else at + r["rightChild"])
        value.append(0.0 if not leaf else 2.0 * weights[r["treeID"]] * r["prediction"] if boosted else share / len(first))
    return Forest(feature, threshold, left, right, value, [first[t] for t in sorted(first)], 0.0, "logistic" if boosted else "identity")


# ---------------------------------------------------------------- Shapley values
class _Leaf:
    """One leaf with the background rows counted by which of its features they satisfy."""

    def __init__(self, value, features, lows, highs, cuts: list, background: np.ndarray, seen: dict):
        if len(features) > MAX_PATH_FEATURES:
            raise ValueError(f"a path with more than {MAX_PATH_FEATURES} features")
        self.value, self.features = value, features
        self.bounds = [(f, -1 if low is None else int(cuts[f].searchsorted(low)), LARGEST if high is None else int(cuts[f].searchsorted(high)))
                       for f, low, high in zip(features, lows, highs)]
        self.masks, self.counts = np.unique(self.satisfied(background, seen), return_counts=True)

    def satisfied(self, codes: np.ndarray, seen: dict) -> np.ndarray:
        """For each row the bits of the features whose interval it meets; ``seen`` keeps the rows of an interval."""
        out = np.zeros(codes.shape[1], np.int64)
        for bit, (f, low, high) in enumerate(self.bounds):
            if (bit, f, low, high) not in seen:
                if len(seen) >= KNOWN_INTERVALS:
                    seen.clear()
                seen[bit, f, low, high] = ((codes[f] > low) & (codes[f] <= high)).astype(np.int64) << bit
            out |= seen[bit, f, low, high]
        return out

    def shares(self, masks: np.ndarray, rows: int) -> np.ndarray:
        """The Shapley shares of the leaf's features (a row each) for rows that satisfy ``masks``, meaned over ``rows``
        background rows. Only a pair that together satisfies every feature counts: then the row alone satisfies what the
        background row lacks, and the other way round."""
        k = len(self.features)
        bits = np.arange(k)
        lacks, others = (~masks[:, None] >> bits) & 1, (~self.masks[:, None] >> bits) & 1
        v, u = lacks.sum(axis=1), others.sum(axis=1)
        gains, losses = _weights(k)
        whole = (masks[:, None] | self.masks) == (1 << k) - 1
        weight = whole * (self.value * self.counts / rows)
        return ((weight * gains[u[None, :], v[:, None]]) @ others - lacks * (weight * losses[u[None, :], v[:, None]]).sum(axis=1)[:, None]).T


@lru_cache(maxsize=None)
def _weights(k: int) -> tuple:
    """``(u-1)! v! / (u+v)!`` and ``u! (v-1)! / (u+v)!`` for u and v up to k (0 where there is no such feature)."""
    gains, losses = np.zeros((k + 1, k + 1)), np.zeros((k + 1, k + 1))
    for u in range(k + 1):
        for v in range(k + 1):
            gains[u, v] = math.factorial(u - 1) * math.factorial(v) / math.factorial(u + v) if u else 0.0
            losses[u, v] = math.factorial(u) * math.factorial(v - 1) / math.factorial(u + v) if v else 0.0
    return gains, losses


class ShapleyKernel:
    """Exact Shapley values of a forest's score for the rows of a matrix, against fixed background rows.

    The forest tells rows apart only by their ``codes``, so a batch's distinct codes are computed once and some are kept
    for later batches; leaf by leaf a row then takes a few vectorised steps."""

    def __init__(self, forest: Forest, background, n_features: int):
        background = np.array([[math.nan if v is None else float(v) for v in row] for row in background], float).reshape(len(background), n_features)
        self.forest, self.rows, self.n_features = forest, len(background), n_features
        codes, seen = forest.codes(background), {}
        self.leaves = [_Leaf(*leaf, forest.cuts(), codes, seen) for leaf in forest.leaves()]
        self.known: dict = {}

    def values(self, x: np.ndarray) -> np.ndarray:
        codes = self.forest.codes(x)
        if not len(codes):
            return np.zeros((len(x), self.n_features))
        unique, back = np.unique(codes.T, axis=0, return_inverse=True)
        keys = [row.tobytes() for row in unique]
        new = [i for i, key in enumerate(keys) if key not in self.known]
        if len(self.known) + len(new) > KNOWN_ROWS:
            self.known, new = {}, list(range(len(keys)))
        for first in range(0, len(new), SHAPLEY_STEP):
            some = new[first:first + SHAPLEY_STEP]
            self.known.update(zip([keys[i] for i in some], self._computed(np.ascontiguousarray(unique[some].T)).T.copy()))
        return np.array([self.known[key] for key in keys]).reshape(len(keys), self.n_features)[back.ravel()]

    def _computed(self, codes: np.ndarray) -> np.ndarray:
        """The values (a row per feature) of rows of ``codes``."""
        out, seen = np.zeros((self.n_features, codes.shape[1])), {}
        for leaf in self.leaves:
            masks, k = leaf.satisfied(codes, seen), len(leaf.features)
            if k <= TABLED_FEATURES:
                there = np.flatnonzero(np.bincount(masks, minlength=1 << k))
                shares = np.zeros((k, 1 << k))
                shares[:, there] = leaf.shares(there, self.rows)
            else:
                there, masks = np.unique(masks, return_inverse=True)
                shares = leaf.shares(there, self.rows)
            for f, share in zip(leaf.features, shares):
                out[f] += share.take(masks, mode="clip")
        return out


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column as a matrix; null values and null rows are NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.full((len(column), width), math.nan)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    out[there] = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
    return out


def tree_shapley(df: DataFrame, x: str, names: Sequence[str], forest: Forest, background, keep: Sequence[str] = ("patient_id",)) -> DataFrame:
    """Columns ``keep``, feature and phi; one row per row of ``df`` and feature.

    ``x``: an array column with the features in the order of ``names``; ``background``: a bounded list of such rows. The
    phis of a row sum to its score minus the mean score of the background. A null or NaN value takes the right branch, in
    a row and in the background, as it does in the score.
    """
    ship_code(df.sparkSession)
    keep, width = list(keep), len(names)
    rows = df.select(*keep, F.col(x).cast("array<double>").alias("_x"))
    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField("_phi", T.ArrayType(T.DoubleType()))])

    def run(batches):
        kernel = ShapleyKernel(forest, background, width)
        for batch in batches:
            phi = kernel.values(matrix_of(batch.column("_x"), width))
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.ListArray.from_arrays(offsets, pa.array(phi.ravel()))],
                                             names=[*keep, "_phi"])
    named = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("_phi").alias("phi"))
    return rows.mapInArrow(run, schema).select(*keep, F.inline(named))
