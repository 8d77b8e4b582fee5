"""Distribution summaries behind the charts (D1-D3, D7): histograms, kernel density, box plots.

Chart drawing is not built; these are the tables a chart needs. Bounds and
bandwidths are one bounded row computed once and applied as literals (each
``scalar()`` subquery would re-read the table); the density grid is a
fixed-size vector of sums per task, added up by one small aggregate.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_code
from .quantiles import quantile_wide


def _q(c):
    return F.col(f"`{c}`")


def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width bins over ``[min, max]`` of the whole column; the last bin is closed on both
    ends (plain ``width_bucket`` would put the max into bin n+1). Bins of one class are counted
    separately when ``by`` is given. Output ``(by?, bin, bin_lo, bin_hi, count)``."""
    x = _q(col).cast("double")
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if st["lo"] is None:
        return df.sparkSession.createDataFrame([], ", ".join(
            ([f"{by} string"] if by else []) + ["bin int", "bin_lo double", "bin_hi double", "count bigint"]))
    lo, hi = F.lit(float(st["lo"])), F.lit(float(st["hi"]))
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(width == F.lit(0.0), F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    keys = ([by] if by else []) + ["bin"]
    counted = df.where(x.isNotNull()).select(*([_q(by).alias(by)] if by else []), b.alias("bin")) \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(*keys, (lo + F.col("bin") * width).alias("bin_lo"),
                          (lo + (F.col("bin") + F.lit(1)) * width).alias("bin_hi"), "count")


#: values whose kernels are evaluated together in a task
KERNEL_VALUES = 4096


def kde(df: DataFrame, col: str, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on ``grid`` points over ``[min − cut·h, max + cut·h]`` with Scott's
    bandwidth ``h = std · n^(−1/5)`` (sample std). Exact: every value contributes to every grid point. A task adds up
    its rows' kernels at the grid points, equal values of a batch at once, so ``grid`` rows leave it whatever it read.
    Output ``(grid_index, x, density)``."""
    ship_code(df.sparkSession)
    x = _q(col).cast("double")
    values = df.select(x.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    # sample variance over the rows (a centred, numerically stable aggregate)
    st = values.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.var_samp("v").alias("var")).first()
    if not (st["var"] or 0.0) > 0.0:  # fewer than two values, or a constant column: no bandwidth, no density
        return df.sparkSession.createDataFrame([], "grid_index int, x double, density double")
    h = math.sqrt(st["var"]) * float(st["n"]) ** -0.2
    start = st["lo"] - cut * h
    step = (st["hi"] + cut * h - start) / (grid - 1)
    points = start + np.arange(grid) * step

    def partial(batches):
        total = np.zeros(grid)
        for batch in batches:
            v, w = np.unique(batch.column(0).to_numpy(), return_counts=True)
            for at in range(0, len(v), KERNEL_VALUES):
                z = (points - v[at:at + KERNEL_VALUES, None]) / h
                total += w[at:at + KERNEL_VALUES] @ np.exp(-0.5 * z * z)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(grid, dtype=np.int32)), pa.array(total)], names=["grid_index", "k"])

    norm = st["n"] * h * math.sqrt(2 * math.pi)
    sums = values.mapInArrow(partial, "grid_index int, k double").groupBy("grid_index").agg(F.sum("k").alias("s"))
    return sums.select("grid_index", (F.lit(start) + F.col("grid_index") * F.lit(step)).alias("x"), (F.col("s") / F.lit(norm)).alias("density"))


def box_summary(df: DataFrame, col: str, by: str, k: float = 1.5) -> DataFrame:
    """D3: per class q1, median, q3, whiskers (most extreme values inside 1.5·IQR) and outlier count."""
    q = quantile_wide(df, [col], [0.25, 0.5, 0.75], [by], names=["q1", "median", "q3"]).drop("column")
    iqr = F.col("q3") - F.col("q1")
    q = q.select(by, "q1", "median", "q3", (F.col("q1") - F.lit(k) * iqr).alias("_lo"),
                 (F.col("q3") + F.lit(k) * iqr).alias("_hi"))
    x = _q(col)
    j = df.select(_q(by).alias(by), x.cast("double").alias("_x")).where(F.col("_x").isNotNull()) \
        .join(q, by)
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    return j.groupBy(by).agg(F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
                             F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
                             F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
                             F.count_if(~inside).alias("n_outliers"))
