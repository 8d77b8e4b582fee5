"""Weighted logistic regressions of many frames by shared Newton steps.

The objective of a frame is ``sum of w * log loss + |coefficients|^2 / (2 C)``
over its imputed, standardised features, intercept free, rows weighted by
balanced classes. One step of all fits is one job: every row adds its gradient
and its part of the Gram matrix to the sums of each frame it trains. A step that
raises the objective is halved. A handful of steps reaches the optimum to
machine accuracy, whatever the number of rows or fits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fitting import Frame, Layout, group_parts, sums

MAX_STEPS = 60
TOLERANCE = 1e-9
#: log-odds of a frame with one class only
ONE_CLASS = 30.0


@dataclass
class Logistic:
    """``P(1) = 1 / (1 + exp(-(intercept + coefficients · x)))`` over standardised features."""
    intercept: float
    coefficients: list

    def margin(self, features) -> Column:
        out = F.lit(float(self.intercept))
        for x, c in zip(features, self.coefficients):
            if c != 0.0:
                out = out + F.lit(float(c)) * x
        return out

    def probability(self, features) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(features)))

    def margins(self, z: np.ndarray) -> np.ndarray:
        return self.intercept + z @ np.array(self.coefficients, float)


def standardised(frame: Frame, x: np.ndarray) -> np.ndarray:
    return (frame.filled(x) - frame.mean) / frame.scale


def _step(rows: DataFrame, frames: list, betas: dict, layout: Layout) -> dict:
    """{fit: (objective without the penalty, gradient, Gram matrix)} at the given coefficients, intercept first."""
    by_group: dict = {}
    for fit in betas:
        by_group.setdefault(frames[fit].group, []).append(fit)

    def part(batch):
        for group, _, y, _, fold, x in group_parts(batch):
            for fit in by_group.get(group, ()):
                frame, beta = frames[fit], betas[fit]
                pick = frame.rows(fold)
                if not pick.any():
                    continue
                z = np.column_stack([np.ones(int(pick.sum())), standardised(frame, x[pick])])
                t = y[pick]
                w, m = frame.balanced(t), z @ beta
                p = 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700)))
                loss = np.sum(w * (np.logaddexp(0, m) - t * m))
                yield fit, np.concatenate([[loss], z.T @ (w * (p - t)), ((z * (w * p * (1 - p))[:, None]).T @ z).ravel()])
    out = {}
    for fit, v in sums(rows, part, layout=layout).items():
        k = len(betas[fit])
        out[fit] = v[0], v[1:k + 1], v[k + 1:].reshape(k, k)
    return out


def logistic_fits(rows: DataFrame, frames: list, c: float = 1.0, layout: Layout = Layout()) -> list:
    """One ``Logistic`` per frame. A frame without rows, or with one class only, gives a constant."""
    betas, best, moves, open_fits = {}, {}, {}, []
    for fit, frame in enumerate(frames):
        betas[fit] = np.zeros(len(frame.fill) + 1)
        if frame.n_pos and frame.n_neg:
            open_fits.append(fit)
        else:
            betas[fit][0] = ONE_CLASS if frame.n_pos else -ONE_CLASS if frame.n_neg else 0.0
    for _ in range(MAX_STEPS):
        if not open_fits:
            break
        got = _step(rows, frames, {fit: betas[fit] for fit in open_fits}, layout)
        still = []
        for fit in open_fits:
            loss, gradient, gram = got[fit]
            penalty = np.full(len(gradient), 1.0 / c)
            penalty[0] = 0.0
            value = loss + 0.5 * np.sum(penalty * betas[fit] ** 2)
            if fit in best and value > best[fit] * (1 + 1e-12) + 1e-12:  # too far: halve the last step
                moves[fit] = moves[fit] / 2
                betas[fit] = betas[fit] - moves[fit]
            else:
                best[fit] = value
                moves[fit] = -np.linalg.lstsq(gram + np.diag(penalty), gradient + penalty * betas[fit], rcond=None)[0]
                betas[fit] = betas[fit] + moves[fit]
            if np.max(np.abs(moves[fit])) > TOLERANCE:
                still.append(fit)
        open_fits = still
    return [Logistic(float(betas[fit][0]), betas[fit][1:].tolist()) for fit in range(len(frames))]
