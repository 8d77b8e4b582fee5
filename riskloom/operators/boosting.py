"""Boosted trees of many frames and models in lockstep, by histograms.

Features are binned at the quantiles of a frame's own rows, at most ``BINS``
bins. A group whose rows one task may hold (``MAX_CELLS``) grows whole fits in
its tasks, all of them in one job. In larger groups a tree grows level by level, and a level of the current trees of all
frames and models is one job: each row adds its gradient and curvature to the
histogram of its node in every frame it trains; a fit's histograms meet in one
task, which returns the best split of each node. The driver holds trees only.

There, row margins live in the cached training table and are brought up to date every
``REFRESH`` trees; in between, the few trees since then are walked again.

* ``XGBoost (Balanced)``: gain ``G^2 / (H + lambda)``, leaves ``-G / (H + lambda)``,
  curvature of a child at least 1, positives weighted, each tree on a share of
  the rows that a hash of (seed, tree, row id) picks.
* ``Gradient Boosting``: gain ``G^2 / n``, leaves ``-G / H``, starts at the log-odds
  of the classes.

Every choice is a function of the rows, so a lost executor repeats its part.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fitting
from .fitting import Frame, Layout, by_group, cells, group_parts, sums
from .trees import Forest

BINS = 64
REFRESH = 10
SKETCH_ACCURACY = 2_000


@dataclass(frozen=True)
class Boosting:
    """Settings of a boosted model."""
    trees: int
    depth: int
    rate: float
    share: float = 1.0         # rows per tree
    l2: float = 0.0
    least_curvature: float = 0.0
    weighted: bool = False     # X7 weights
    second_order: bool = True  # gain by curvature, or by rows
    prior: bool = False        # start at the log-odds
    seed: int = 42


# --- fixed values: the compared boosted models and their settings.
XGBOOST = Boosting(trees=100, depth=4, rate=0.08, share=0.8, l2=1.0, least_curvature=1.0, weighted=True)
GRADIENT = Boosting(trees=80, depth=4, rate=0.1, second_order=False, prior=True)


@dataclass
class _Fit:
    frame: Frame
    place: int      # of the frame among its group's
    model: Boosting
    start: float
    edges: list     # of each feature
    trees: list = field(default_factory=list)
    grown: dict | None = None  # the tree that grows


# ---------------------------------------------------------------- bins
def bin_edges(rows: DataFrame, frames: list) -> list:
    """Per frame and feature the increasing upper bounds of the bins, from the frame's rows; one aggregate."""
    wide = max((len(f.fill) for f in frames), default=0)
    folds = sorted({f.without for f in frames})
    used = F.array_compact(F.array(*[F.when(F.col("fold") != F.lit(f), F.lit(f)) for f in folds]))
    rows = rows.where("fold IS NOT NULL").select("grp", F.explode(used).alias("frame"), "x")
    grid = [i / (BINS - 1) for i in range(BINS)]
    value = [F.nanvl(F.get("x", F.lit(j)), F.lit(None)) for j in range(wide)]
    got = {(r["grp"], r["frame"]): r for r in rows.groupBy("grp", "frame").agg(
        *[F.percentile_approx(v, grid, SKETCH_ACCURACY).alias(f"e{j}") for j, v in enumerate(value)]).collect()} if wide else {}
    return [[np.unique(got[f.key][f"e{j}"]) if f.key in got and got[f.key][f"e{j}"] else np.zeros(1) for j in range(len(f.fill))] for f in frames]


def _binned(x: np.ndarray, edges: list) -> np.ndarray:
    """Bin of each value: the number of edges below it, the last bin for values above all."""
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.minimum(np.searchsorted(e, x[:, j], side="left"), len(e) - 1)
    return out


# ---------------------------------------------------------------- rows
def _uniform(rid: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A number in [0, 1) of each row id, for one tree."""
    u = np.uint64
    with np.errstate(over="ignore"):
        x = rid.astype(np.int64).view(u) * u(0x9E3779B97F4A7C15) + u(seed * 1_000_003 + tree) * u(0xD1B54A32D192ED03)
        for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> u(shift))) * u(mult)
        return ((x ^ (x >> u(31))) >> u(11)).astype(float) / float(1 << 53)


def _walk(tree: dict, bins: np.ndarray, levels: int) -> np.ndarray:
    """The node that each row reaches within ``levels`` steps; children of ``i`` are ``2 i + 1`` and ``2 i + 2``."""
    feature, cut = tree["feature"], tree["bin"]
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        f = feature[at]
        at = np.where(f >= 0, 2 * at + 2 - (bins[rows, np.maximum(f, 0)] <= cut[at]), at)
    return at


def _caught_up(margin: np.ndarray, trees: list, bins: np.ndarray, model: Boosting) -> np.ndarray:
    for tree in trees:
        margin = margin + tree["value"][_walk(tree, bins, model.depth)]
    return margin


def _matrices(batch, fits_of: dict):
    """(group, row numbers, y, rid, fold, bins by frame, margins by fit) of each group in a batch of the state."""
    groups = batch.column("grp").dictionary_encode()
    codes = groups.indices.to_numpy()
    y, rid, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "rid", "fold"))
    raw = {}
    for c in ("bins", "margins"):
        column = batch.column(c)
        raw[c] = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1], np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for code, group in enumerate(groups.dictionary.to_pylist()):
        fits = fits_of.get(group)
        if not fits:
            continue
        at = np.flatnonzero(codes == code)
        n_frames, width = 1 + max(fit.place for _, fit in fits), len(fits[0][1].frame.fill)

        def block(c, size):
            offsets, data = raw[c]
            return data[offsets[at][:, None] + np.arange(size)]
        bins = block("bins", n_frames * width).reshape(len(at), n_frames, width)
        margins = np.ascontiguousarray(block("margins", 8 * len(fits))).view(np.float64)
        yield group, at, y[at], rid[at], fold[at], bins, margins


class Boosted:
    """The fits that grow in lockstep."""

    def __init__(self, rows: DataFrame, fits: list, layout: Layout = Layout()):
        self.layout = layout
        self.fits = fits
        self.fresh = 0  # trees that the margins of the state contain
        self.state = self._state(rows)

    def _of_group(self) -> dict:
        """The fits by group, with only the trees that the margins lack: what a task needs."""
        out: dict = {}
        for i, fit in enumerate(self.fits):
            out.setdefault(fit.frame.group, []).append((i, replace(fit, trees=fit.trees[self.fresh:])))
        return out

    def _state(self, rows: DataFrame) -> DataFrame:
        """The training rows with their bins in every frame and their margin in every fit (binary, fixed width)."""
        of_group = self._of_group()

        def run(batches):
            for batch in batches:
                bins, margins = [b""] * batch.num_rows, [b""] * batch.num_rows
                for group, at, _, _, _, x in group_parts(batch):
                    fits = of_group.get(group, [])
                    frames = {fit.place: fit for _, fit in fits}
                    b = np.concatenate([_binned(frames[k].frame.filled(x), frames[k].edges) for k in sorted(frames)], axis=1) if frames else x[:, :0]
                    m = np.tile(np.array([fit.start for _, fit in fits]), (len(at), 1))
                    for i, row in enumerate(at.tolist()):
                        bins[row], margins[row] = b[i].tobytes(), m[i].tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("grp", "rid", "y", "fold")] + [pa.array(bins, pa.binary()), pa.array(margins, pa.binary())],
                                                 names=["grp", "rid", "y", "fold", "bins", "margins"])
        rows = rows.where("fold IS NOT NULL").select("grp", "rid", "y", "fold", "x")
        return rows.mapInArrow(run, "grp string, rid long, y double, fold int, bins binary, margins binary").persist()

    # ------------------------------------------------------------ one level
    def _level(self, depth: int, number: int) -> None:
        """Split the nodes of one level of tree ``number`` of all fits that still grow."""
        growing = {i for i, fit in enumerate(self.fits) if fit.grown is not None and depth < fit.model.depth and fit.grown["open"][depth]}
        if not growing:
            return
        fits_of = self._of_group()
        first, nodes = (1 << depth) - 1, 1 << depth

        def part(batch):
            for group, _, y, rid, fold, bins, margins in _matrices(batch, fits_of):
                for k, (i, fit) in enumerate(fits_of[group]):
                    if i not in growing:
                        continue
                    pick = fit.frame.rows(fold)
                    if fit.model.share < 1.0:
                        pick &= _uniform(rid, fit.model.seed, number) < fit.model.share
                    pick = np.flatnonzero(pick)
                    b, t = bins[pick, fit.place], y[pick]
                    margin = _caught_up(margins[pick, k], fit.trees, b, fit.model)
                    at = _walk(fit.grown, b, depth) - first
                    here = at >= 0
                    p = 1.0 / (1.0 + np.exp(-margin[here]))
                    w = np.where(t[here] == 1, fit.frame.positive_weight(), 1.0) if fit.model.weighted else np.ones(int(here.sum()))
                    g, h = w * (p - t[here]), w * p * (1 - p)
                    width = b.shape[1]
                    cell = ((at[here][:, None] * width + np.arange(width)) * BINS + b[here]).ravel()
                    size = nodes * width * BINS
                    yield i, np.concatenate([np.bincount(cell, np.repeat(v, width), size) for v in (g, h)] + [np.bincount(cell, minlength=size).astype(float)])

        models = [fit.model for fit in self.fits]

        def finish(i, v):
            return best_splits(v.reshape(3, nodes, -1, BINS), models[i])
        for i, found in sums(self.state, part, finish, self.layout).items():
            _grow(self.fits[i], depth, found.reshape(nodes, 9))

    def _refresh(self) -> None:
        """Bring the margins up to date: a new cached state, from which the old one can be rebuilt if it is lost."""
        fits_of = self._of_group()

        def run(batches):
            for batch in batches:
                new = batch.column("margins").to_pylist()
                for group, at, _, _, _, bins, margins in _matrices(batch, fits_of):
                    out = np.column_stack([_caught_up(margins[:, k], fit.trees, bins[:, fit.place], fit.model)
                                           for k, (_, fit) in enumerate(fits_of[group])])
                    for j, row in enumerate(at.tolist()):
                        new[row] = out[j].tobytes()
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("grp", "rid", "y", "fold", "bins")], pa.array(new, pa.binary())],
                                                 names=["grp", "rid", "y", "fold", "bins", "margins"])
        old = self.state
        self.state = old.mapInArrow(run, old.schema).persist()
        self.state.count()
        old.unpersist()
        self.fresh = max(len(fit.trees) for fit in self.fits)

    def grow(self) -> None:
        """All trees of all fits."""
        for number in range(max((fit.model.trees for fit in self.fits), default=0)):
            if number - self.fresh >= REFRESH:
                self._refresh()
            for fit in self.fits:
                fit.grown = _seedling(fit.model) if number < fit.model.trees and fit.frame.n_pos and fit.frame.n_neg else None
            for depth in range(max(fit.model.depth for fit in self.fits)):
                self._level(depth, number)
            for fit in self.fits:
                # a finished fit takes an empty tree, so that all count the same number
                fit.trees.append(fit.grown if fit.grown is not None else _seedling(fit.model))
        self.state.unpersist()


# ---------------------------------------------------------------- whole fits in a task
def grow_alone(fit: _Fit, y: np.ndarray, rid: np.ndarray, x: np.ndarray) -> None:
    """All trees of one fit over its frame's rows: those that the levels of ``Boosted`` give."""
    model, width = fit.model, x.shape[1]
    bins = np.ascontiguousarray(_binned(fit.frame.filled(x), fit.edges).T)
    margin = np.full(len(y), fit.start)
    w = np.where(y == 1, fit.frame.positive_weight(), 1.0) if model.weighted else 1.0
    every = np.arange(len(y))
    for number in range(model.trees):
        fit.grown = tree = _seedling(model)
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        at = np.zeros(len(y), np.int64)
        used = every if model.share == 1.0 else np.flatnonzero(_uniform(rid, model.seed, number) < model.share)
        for depth in range(model.depth):
            if not tree["open"][depth]:
                break
            first, nodes = (1 << depth) - 1, 1 << depth
            here = used[at[used] >= first] if depth else used
            cell, gh, hh = (at[here] - first) * BINS, g[here], h[here]
            hist = np.empty((3, nodes, width, BINS))
            for j in range(width):
                place = cell + bins[j].take(here)
                for k, v in enumerate((gh, hh, None)):
                    hist[k, :, j] = np.bincount(place, v, nodes * BINS).reshape(nodes, BINS)
            _grow(fit, depth, best_splits(hist, model))
            feature = tree["feature"][at]
            down = feature >= 0 if not depth else (at >= first) & (feature >= 0)
            at = np.where(down, 2 * at + 2 - (bins[np.maximum(feature, 0), every] <= tree["bin"][at]), at)
        margin = margin + tree["value"][at]
        fit.trees.append(tree)
    fit.grown = None


def _grow_whole(rows: DataFrame, fits: list) -> None:
    """The trees of all ``fits``, each grown in one task; one job."""
    units: dict = {}
    for i, fit in enumerate(fits):
        if fit.frame.n_pos and fit.frame.n_neg:
            units.setdefault(fit.frame.group, []).append(i)

    def work(some, y, rid, fold, x):
        for i in some:
            fit = fits[i]
            pick = fit.frame.rows(fold)
            grow_alone(fit, y[pick], rid[pick], x[pick])
            parts = [np.concatenate([t[c] for t in fit.trees]).astype(float).tobytes() for c in ("feature", "bin", "value")]
            fit.trees = []
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array([v], pa.binary()) for v in parts]], names=["fit", "feature", "bin", "value"])
    got = by_group(rows, [f.frame for f in fits], units, work, "fit int, feature binary, bin binary, value binary")
    for r in got.to_pylist():
        fit = fits[r["fit"]]
        columns = {c: np.frombuffer(r[c], float).reshape(fit.model.trees, -1) for c in ("feature", "bin", "value")}
        fit.trees = [{"feature": columns["feature"][t].astype(int), "bin": columns["bin"][t].astype(int), "value": columns["value"][t]} for t in range(fit.model.trees)]
    for fit in fits:
        fit.trees = fit.trees or [_seedling(fit.model) for _ in range(fit.model.trees)]


def _seedling(model: Boosting) -> dict:
    nodes = (2 << model.depth) - 1
    return {"feature": np.full(nodes, -1), "bin": np.zeros(nodes, np.int64), "value": np.zeros(nodes), "open": [True] + [False] * model.depth}


def best_splits(hist: np.ndarray, model: Boosting) -> np.ndarray:
    """Per node: gain, feature and bin of the best split, then gradient, curvature and rows on its left and in the node."""
    left = hist.cumsum(axis=3)
    node = left[:, :, :1, -1:]
    right = node - left
    least = np.ones(left.shape[1:], bool)
    for side in (left, right):
        least &= (side[2] >= 1) & (side[1] >= model.least_curvature)

    def gain(s):
        below = s[1] + model.l2 if model.second_order else s[2]
        return np.where(below > 0, s[0] ** 2 / np.where(below > 0, below, 1.0), 0.0)
    score = np.where(least, gain(left) + gain(right) - gain(node), -np.inf)
    flat = score.reshape(score.shape[0], -1)
    at = flat.argmax(axis=1)
    rows = np.arange(len(at))
    f, b = at // hist.shape[3], at % hist.shape[3]
    return np.column_stack([flat[rows, at], f, b, *[left[k][rows, f, b] for k in range(3)], *[node[k][rows, 0, 0] for k in range(3)]])


def _leaf_value(model: Boosting, g: float, h: float) -> float:
    return -model.rate * g / (h + model.l2) if h + model.l2 > 0 else 0.0


def _grow(fit: _Fit, depth: int, found: np.ndarray) -> None:
    """Enter the splits of one level; nodes without a gain stay leaves."""
    tree, model = fit.grown, fit.model
    for k, (gain, feature, cut, gl, hl, _, g, h, n) in enumerate(found):
        at = (1 << depth) - 1 + k
        if n < 1:
            continue
        if not np.isfinite(gain) or gain <= 1e-9:
            tree["value"][at] = _leaf_value(model, g, h)
            continue
        tree["feature"][at], tree["bin"][at] = int(feature), int(cut)
        tree["value"][at] = 0.0
        tree["value"][2 * at + 1], tree["value"][2 * at + 2] = _leaf_value(model, gl, hl), _leaf_value(model, g - gl, h - hl)
        tree["open"][depth + 1] = True


def _forest(fit: _Fit) -> Forest:
    """The trees as a node table over filled, unscaled features."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(tree, at):
        me = len(feature)
        f = int(tree["feature"][at])
        for column, v in ((feature, f), (threshold, float(fit.edges[f][tree["bin"][at]]) if f >= 0 else 0.0), (left, -1), (right, -1),
                          (value, 0.0 if f >= 0 else float(tree["value"][at]))):
            column.append(v)
        if f >= 0:
            left[me], right[me] = add(tree, 2 * at + 1), add(tree, 2 * at + 2)
        return me
    for tree in fit.trees[:fit.model.trees]:
        roots.append(add(tree, 0))
    base = fit.start
    if not (fit.frame.n_pos and fit.frame.n_neg):  # one class only
        base = 30.0 if fit.frame.n_pos else -30.0
    return Forest(feature, threshold, left, right, value, roots, base, "logistic")


def boosted_fits(rows: DataFrame, frames: list, models: list, layout: Layout = Layout(), edges: list | None = None) -> list:
    """For each frame a list of forests, one per model; the scores are log-odds of filled features. ``edges``: of ``bin_edges``."""
    if not frames or not models:
        return [[] for _ in frames]
    fits, places, size = [], {}, cells(frames)
    for frame, e in zip(frames, bin_edges(rows, frames) if edges is None else edges):
        place = places[frame.group] = places.get(frame.group, -1) + 1
        for model in models:
            start = np.log(frame.n_pos / frame.n_neg) if model.prior and frame.n_pos and frame.n_neg else 0.0
            fits.append(_Fit(frame, place, model, float(start), e))
    whole, large = ([f for f in fits if (size[f.frame.group] <= fitting.MAX_CELLS) == small] for small in (True, False))
    if whole:
        _grow_whole(rows, whole)
    if large:
        Boosted(rows, large, layout).grow()
    grown = [_forest(fit) for fit in fits]
    return [grown[i * len(models):(i + 1) * len(models)] for i in range(len(frames))]
