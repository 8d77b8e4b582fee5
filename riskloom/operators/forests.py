"""Random forests of many frames.

A tree is grown on bootstrapped rows, weighted by balanced classes, level by
level: the class weights per node, feature and bin give the split with the
least Gini impurity among ``sqrt(features)`` features drawn for each node. The
draws are functions of (seed, frame, tree), so a repeated task grows the same.

A forest's trees need nothing of each other. ``forest_fits`` grows blocks of
them in tasks that hold all rows of one group, of groups up to ``MAX_CELLS``
numbers. ``forest_levels`` takes groups of any size: a few trees of all frames
grow at a time, and a level of them is one job in which each row adds its class
weights to its node in every tree (``fitting.sums``). There a row's copies in a
tree are a Poisson draw of (seed, tree, row id), as rows have no common place.
Both read every training row, and bins come from all of them.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .boosting import BINS, _binned, _uniform, bin_edges
from .fitting import MAX_CELLS, Layout, by_group, cells, group_parts, sums
from .trees import Forest

TREES, DEPTH, BLOCK = 100, 10, 10
#: numbers of the class weights that a task of ``forest_levels`` adds up
LEVEL_CELLS = 8_000_000
#: shares of rows with at most 0, 1, 2, ... copies in a bootstrapped tree
_COPIES = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(18)])


def _drawn_features(rng, k: int, width: int, m: int) -> np.ndarray:
    """The features, in order, that each of ``k`` nodes may split on."""
    drawn = rng.random((k, width)).argsort(axis=1).argsort(axis=1) < m
    return np.nonzero(drawn)[1].reshape(k, -1)


def _purity(one, every):
    some = every > 1e-12
    return np.where(some, (one ** 2 + (every - one) ** 2) / np.where(some, every, 1.0), 0.0)


def _histograms(node: np.ndarray, features: np.ndarray, bins: np.ndarray, rows: np.ndarray, weights) -> list:
    """Sums of each of ``weights`` (rows in order of ``rows``) by node, its drawn feature and bin."""
    k, m = features.shape
    out, flat, start, width = [np.empty((k, m, BINS)) for _ in weights], bins.ravel(), rows * bins.shape[1], node * BINS
    for s in range(m):
        cell = width + flat.take(start + features[:, s].take(node))
        for total, w in zip(out, weights):
            total[:, s] = np.bincount(cell, w, k * BINS).reshape(k, BINS)
    return out


def _splits(ones: np.ndarray, total: np.ndarray, a: np.ndarray, b: np.ndarray, features: np.ndarray) -> tuple:
    """(whether it splits, feature, bin, class weight and weight of its left) of each node."""
    a, b = a.cumsum(axis=2), b.cumsum(axis=2)
    t1, t, k = ones[:, None, None], total[:, None, None], len(ones)
    score = np.where((b > 1e-9) & (t - b > 1e-9), _purity(a, b) + _purity(t1 - a, t - b), -np.inf).reshape(k, -1)
    best, rows = score.argmax(axis=1), np.arange(k)
    slot, cut = best // BINS, best % BINS
    return score[rows, best] > _purity(ones, total) + 1e-9, features[rows, slot], cut, a[rows, slot, cut], b[rows, slot, cut]


class _Tree:
    """A growing tree: its nodes level by level, the children of a split side by side in the next level."""

    def __init__(self):
        self.levels, self.size = [], 1

    def add(self, shares: np.ndarray, splits: np.ndarray, feature: np.ndarray, cut: np.ndarray, edges: list) -> None:
        """The next level: nodes that split by ``feature`` and ``cut``, and leaves of ``shares``."""
        left = np.where(splits, self.size + 2 * (np.cumsum(splits) - 1), -1)
        bound = np.array([edges[f][c] if s else 0.0 for s, f, c in zip(splits.tolist(), feature.tolist(), cut.tolist())], float)
        self.levels.append((np.where(splits, feature, -1), bound, left, np.where(splits, left + 1, -1), np.where(splits, 0.0, shares), cut))
        self.size += 2 * int(splits.sum())

    def nodes(self) -> tuple:
        """(feature, threshold, left, right, share of class 1 at a leaf) of all nodes."""
        return tuple(np.concatenate([level[c] for level in self.levels]) for c in range(5))


def grow_tree(bins: np.ndarray, edges: list, y: np.ndarray, w: np.ndarray, rng, depth: int, m: int):
    """One tree as arrays (feature, threshold, left, right, share of class 1 at a leaf) over binned rows of weight ``w``."""
    rows, tree = np.flatnonzero(w > 0), _Tree()
    node, k, none = np.zeros(len(rows), np.int64), 1, np.zeros(0, np.int64)
    wy = w * y
    for level in range(depth + 1):
        if not k:
            break
        w1, w0 = wy[rows], w[rows]
        ones, total = np.bincount(node, w1, k), np.bincount(node, w0, k)
        shares = np.divide(ones, total, out=np.zeros(k), where=total > 0)
        if level == depth or not len(rows):
            tree.add(shares, np.zeros(k, bool), np.full(k, -1), np.zeros(k, np.int64), edges)
            break
        features = _drawn_features(rng, k, bins.shape[1], m)
        splits, feature, cut, _, _ = _splits(ones, total, *_histograms(node, features, bins, rows, (w1, w0)), features)
        tree.add(shares, splits, feature, cut, edges)
        stay = splits[node]
        rows, node = rows[stay], node[stay]
        node = 2 * (np.cumsum(splits) - 1)[node] + (bins[rows, feature[node]] > cut[node]) if len(rows) else none
        k = 2 * int(splits.sum())
    return tree.nodes()


def forest_fits(rows: DataFrame, frames: list, trees: int = TREES, depth: int = DEPTH, seed: int = 42, edges: list | None = None) -> list:
    """One ``Forest`` per frame: the mean of its trees' class shares over filled features. ``edges``: of ``bin_edges``."""
    if max(cells(frames).values(), default=0) > MAX_CELLS:
        raise ValueError(f"a group of more than {MAX_CELLS} numbers is not sent to one task")
    edges = bin_edges(rows, frames) if edges is None else edges
    units: dict = {}
    for i, f in enumerate(frames):
        if f.n_pos and f.n_neg:
            units.setdefault(f.group, []).extend((i, block) for block in range(-(-trees // BLOCK)))

    def work(some, y_all, rid, fold, x):
        for fit in sorted({i for i, _ in some}):
            frame = frames[fit]
            pick = frame.rows(fold)
            y, bins = y_all[pick], _binned(frame.filled(x[pick]), edges[fit])
            w, m = frame.balanced(y), max(1, int(math.sqrt(bins.shape[1])))
            for block in [b for i, b in some if i == fit]:
                grown = []
                for tree in range(block * BLOCK, min(trees, (block + 1) * BLOCK)):
                    rng = np.random.default_rng([seed, fit, tree])
                    drawn = np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y))
                    grown.append(grow_tree(bins, edges[fit], y, w * drawn, rng, depth, m))
                sizes = np.array([len(t[0]) for t in grown], float)
                joined = [np.concatenate([np.asarray(t[c], float) for t in grown]) for c in range(5)]
                yield pa.RecordBatch.from_arrays([pa.array([fit], pa.int32()), pa.array([block], pa.int32()), pa.array([sizes.tobytes()], pa.binary()),
                                                  pa.array([zlib.compress(np.concatenate(joined).tobytes(), 1)], pa.binary())],
                                                 names=["fit", "block", "sizes", "nodes"])
    got = by_group(rows, frames, units, work, "fit int, block int, sizes binary, nodes binary")
    by_fit: dict = {}
    for r in sorted(got.to_pylist(), key=lambda r: (r["fit"], r["block"])):
        nodes, ends = np.frombuffer(zlib.decompress(r["nodes"]), float).reshape(5, -1), np.cumsum(np.frombuffer(r["sizes"], float)).astype(int)[:-1]
        by_fit.setdefault(r["fit"], []).extend(zip(*[np.split(c, ends) for c in nodes]))
    return [_forest(by_fit.get(i), f, trees) for i, f in enumerate(frames)]


def _forest(grown: list | None, frame, trees: int) -> Forest:
    """The forest of grown trees; a frame of one class, or without rows, is a constant."""
    if not grown:
        return Forest([-1], [0.0], [-1], [-1], [1.0 if frame.n_pos and not frame.n_neg else 0.0], [0])
    sizes = np.array([len(t[0]) for t in grown])
    roots = np.cumsum(sizes) - sizes
    feature, threshold, left, right, value = (np.concatenate([t[c] for t in grown]) for c in range(5))
    shift, inner = np.repeat(roots, sizes), feature >= 0
    return Forest(feature.astype(np.int32), threshold, np.where(inner, left + shift, -1).astype(np.int32),
                  np.where(inner, right + shift, -1).astype(np.int32), value / trees, roots.astype(np.int32))


# ---------------------------------------------------------------- groups of any size
def _reached(levels: list, bins: np.ndarray) -> np.ndarray:
    """The place of each row in the level after ``levels``, -1 where it stays in a leaf."""
    at = np.zeros(len(bins), np.int64)
    there = np.arange(len(bins))
    for feature, cut, place in levels:
        node = at[there]
        stay = feature[node] >= 0
        at[there[~stay]] = -1
        there, node = there[stay], node[stay]
        at[there] = 2 * place[node] + (bins[there, feature[node]] > cut[node])
    return at


def forest_levels(rows: DataFrame, frames: list, trees: int = TREES, depth: int = DEPTH, seed: int = 42, layout: Layout = Layout(),
                  edges: list | None = None) -> list:
    """``forest_fits`` of groups of any size: no task holds more than a batch of rows and the sums of a few trees."""
    edges = bin_edges(rows, frames) if edges is None else edges
    open_frames = [i for i, f in enumerate(frames) if f.n_pos and f.n_neg]
    widest = max([len(frames[i].fill) for i in open_frames], default=1)
    per_tree = (1 << max(0, depth - 1)) * max(1, int(math.sqrt(widest))) * BINS * 2
    in_group = max([sum(frames[j].group == frames[i].group for j in open_frames) for i in open_frames], default=1)
    step = max(1, LEVEL_CELLS // (per_tree * in_group))
    by_fit: dict = {}
    for first in range(0, trees, step):
        some = range(first, min(trees, first + step))
        grown = _grow_levels(rows, frames, open_frames, some, depth, seed, layout, edges)
        for i in open_frames:
            by_fit.setdefault(i, []).extend(grown[i, t] for t in some)
    return [_forest(by_fit.get(i), f, trees) for i, f in enumerate(frames)]


def _grow_levels(rows: DataFrame, frames: list, open_frames: list, some: range, depth: int, seed: int, layout: Layout, edges: list) -> dict:
    """{(frame, tree): nodes} of a few trees of all frames, a level of all of them at a time."""
    keys = [(i, t) for i in open_frames for t in some]
    built, down, size = [_Tree() for _ in keys], [[] for _ in keys], [1] * len(keys)
    stats: list = [None] * len(keys)  # class weight and weight of the nodes of the level
    of_group: dict = {}
    for n, (i, _) in enumerate(keys):
        of_group.setdefault(frames[i].group, {}).setdefault(i, []).append(n)

    def drawn(n, level):
        i, t = keys[n]
        width = len(frames[i].fill)
        return _drawn_features(np.random.default_rng([seed, i, t, level]), size[n], width, max(1, int(math.sqrt(width))))
    for level in range(depth):
        growing = {n for n in range(len(keys)) if size[n]}
        if not growing:
            break

        def part(batch):
            for group, _, y, rid, fold, x in group_parts(batch):
                for i, trees_of in of_group.get(group, {}).items():
                    frame = frames[i]
                    pick = frame.rows(fold)
                    if not pick.any():
                        continue
                    t, r, bins = y[pick], rid[pick], _binned(frame.filled(x[pick]), edges[i])
                    for n in trees_of:
                        if n not in growing:
                            continue
                        copies = _COPIES.searchsorted(_uniform(r, seed + 1 + i, keys[n][1]), side="right")
                        there = np.flatnonzero(copies)
                        at = _reached(down[n], bins[there])
                        there, at = there[at >= 0], at[at >= 0]
                        # counts of copies are whole numbers: their sums are the same however the rows lie
                        zeros, ones = copies[there] * (1.0 - t[there]), copies[there] * t[there]
                        yield n, np.concatenate([*[np.bincount(at, v, size[n]) for v in (zeros, ones)],
                                                 *[v.ravel() for v in _histograms(at, drawn(n, level), bins, there, (zeros, ones))]])

        def finish(n, v):
            k, (w0, w1) = size[n], frames[keys[n][0]].balanced(np.array([0.0, 1.0]))
            ones, a = w1 * v[k:2 * k], w1 * v[2 * k:].reshape(2, k, -1, BINS)[1]
            total, b = ones + w0 * v[:k], a + w0 * v[2 * k:].reshape(2, k, -1, BINS)[0]
            return np.column_stack([ones, total, *_splits(ones, total, a, b, drawn(n, level))])
        found = sums(rows.where("fold IS NOT NULL"), part, finish, layout)
        for n in growing:
            k = size[n]
            ones, total, splits, feature, cut, left1, left = found[n].reshape(k, 7).T if n in found else np.zeros((7, k))
            splits, feature, cut = splits > 0, feature.astype(np.int64), cut.astype(np.int64)
            built[n].add(np.divide(ones, total, out=np.zeros(k), where=total > 0), splits, feature, cut, edges[keys[n][0]])
            down[n].append((np.where(splits, feature, -1), cut, np.cumsum(splits) - 1))
            size[n] = 2 * int(splits.sum())
            stats[n] = np.column_stack([left1, ones - left1])[splits].ravel(), np.column_stack([left, total - left])[splits].ravel()
    for n, k in enumerate(size):
        if k:  # the last level: leaves only
            ones, total = stats[n] if stats[n] is not None else (np.zeros(k), np.zeros(k))
            shares = np.clip(np.divide(ones, total, out=np.zeros(k), where=total > 0), 0.0, 1.0)
            built[n].add(shares, np.zeros(k, bool), np.full(k, -1), np.zeros(k, np.int64), edges[keys[n][0]])
    return {key: tree.nodes() for key, tree in zip(keys, built)}
