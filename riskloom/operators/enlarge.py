"""Class-conditional enlargement of a table.

Per class: mean vector and sample covariance (one aggregation pass, A13), a
Cholesky factor of the small ``F × F`` covariance on the driver, then
``n`` synthetic rows generated in parallel from ``spark.range`` as
``mean + L · z`` with seeded normal columns; values are clipped to the real
data's ``[max(0, min), 1.15 · max]`` (P14), integer columns rounded (P15),
rows tagged (P16), shuffled (T5) and unioned with the tagged real rows (T7).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import clip_to_bounds, round_to_int, tag_source, union_all


def _cholesky(cov: np.ndarray) -> np.ndarray:
    """Cholesky factor; a semi-definite covariance gets the smallest jitter that makes it work."""
    jitter = 0.0
    for _ in range(12):
        try:
            return np.linalg.cholesky(cov + jitter * np.eye(len(cov)))
        except np.linalg.LinAlgError:
            jitter = max(jitter * 10, 1e-10 * max(1.0, float(np.trace(cov))))
    w, v = np.linalg.eigh(cov)
    return v @ np.diag(np.sqrt(np.clip(w, 0, None)))


def enlarge(real: DataFrame, features: Sequence[str], label: str = "Outcome", total_rows: int = 100_000,
            int_cols: Sequence[str] = (), seed: int = 42, rows_per_partition: int = 1_000_000,
            real_tag: str = "real_pima", synth_tag: str = "synthetic_augmented") -> DataFrame:
    spark = real.sparkSession
    feats = list(features)
    clean = real.where(F.col(label).isin(0, 1))
    stats = clean.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"`{a}`").alias(f"m{i}") for i, a in enumerate(feats)],
        *[F.covar_samp(f"`{a}`", f"`{b}`").alias(f"c{i}_{j}") for i, a in enumerate(feats)
          for j, b in enumerate(feats) if i <= j]).collect()  # two rows: F means and F×F covariances per class
    by = {r[label]: r for r in stats}
    n_real = sum(r["n"] for r in stats)
    n_pos = int(total_rows * (by[1]["n"] / n_real)) if 1 in by else 0
    counts = {1: n_pos, 0: total_rows - n_pos}
    parts = []
    for cls, n in counts.items():
        if n <= 0 or cls not in by:
            continue
        r = by[cls]
        mean = np.array([r[f"m{i}"] for i in range(len(feats))], dtype=float)
        cov = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(len(feats))] for i in range(len(feats))])
        chol = _cholesky(cov)
        nparts = max(1, n // rows_per_partition)
        base = spark.range(0, n, numPartitions=nparts)
        z = base.select(*[F.randn(seed * 1000 + cls * 100 + i).alias(f"z{i}") for i in range(len(feats))])
        cols = []
        for i, a in enumerate(feats):
            expr = F.lit(float(mean[i]))
            for j in range(i + 1):
                if chol[i, j] != 0.0:
                    expr = expr + F.lit(float(chol[i, j])) * F.col(f"z{j}")
            cols.append(expr.alias(a))
        parts.append(z.select(*cols).withColumn(label, F.lit(cls)))
    synth = union_all(parts)
    synth = clip_to_bounds(synth, feats, ref=real)
    synth = synth.withColumns({c: round_to_int(c) for c in int_cols})
    synth = tag_source(synth, synth_tag)  # the union keeps no order: a sink that needs one sorts
    real_t = tag_source(real.select(*[F.col(f"`{a}`").cast("double" if a not in int_cols else "int").alias(a)
                                      for a in feats], F.col(label)), real_tag)
    synth = synth.select(*[F.col(f"`{a}`").cast("double" if a not in int_cols else "int").alias(a) for a in feats],
                         F.col(label).cast(real.schema[label].dataType), "data_source")
    return union_all([synth, real_t.select(*synth.columns)])
