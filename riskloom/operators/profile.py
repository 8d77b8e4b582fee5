"""Profiling operators (A1-A6, A10-A16): every statistic of a table in one aggregation pass.

Per-column statistics are computed in a single ``agg`` (partial aggregation on
each task, one small shuffle) and unpivoted with ``stack``/``inline`` into a
long ``(column, ...)`` frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _q(c):
    return F.col(f"`{c}`")


def shape(df: DataFrame) -> DataFrame:
    """A1: one row ``(n_rows, n_cols)``; the column count is plan-time metadata."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def schema_profile(df: DataFrame) -> DataFrame:
    """A2: ``(column, dtype, non_null)`` for every column, from one aggregation."""
    agg = df.agg(*[F.count(_q(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                     F.col(f"_{i}").alias("non_null")) for i, f in enumerate(df.schema.fields)]
    return agg.select(F.inline(F.array(*rows)))


def _per_column(df, cols, make, name):
    agg = df.agg(*[make(_q(c)).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias(name)) for i, c in enumerate(cols)]
    return agg.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: ``(column, null_count)`` in one pass."""
    return _per_column(df, cols or df.columns, lambda c: F.count_if(c.isNull()), "null_count")


def zero_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: ``(column, zero_count)`` in one pass."""
    return _per_column(df, cols, lambda c: F.count_if(c == F.lit(0)), "zero_count")


def _counts(df: DataFrame, col: str) -> DataFrame:
    return df.where(_q(col).isNotNull()).groupBy(_q(col).alias(col)).agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, col: str, labels: Sequence[str] | None = None) -> DataFrame:
    """A5: counts per value (nulls dropped). With ``labels``, every label is kept, absent ones at 0,
    and ``label_pos`` gives the requested order; otherwise ``rank`` is by count descending, then by value
    (ranked in ranges: the values may be many)."""
    counts = _counts(df, col)
    if labels is None:
        from .ranking import global_row_number
        ranked = global_row_number(counts.withColumn("_less", -F.col("count")), [], ["_less", col], out="rank")
        return ranked.select(col, "count", "rank")
    spark = df.sparkSession
    lab = spark.createDataFrame([(str(v), i) for i, v in enumerate(labels)], f"{col} string, label_pos int")
    return (F.broadcast(lab).join(counts, col, "left")
            .select(col, "label_pos", F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def value_share(df: DataFrame, col: str, scale: float = 1.0) -> DataFrame:
    """Share of each value among non-null rows (× ``scale``; 100 gives percent)."""
    counts = _counts(df, col)
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(col, "count", (F.col("count") * F.lit(scale) / total).alias("share"))


def group_median(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """A10: exact medians of ``cols`` per group ``by``."""
    from .quantiles import quantile_wide
    return quantile_wide(df, cols, [0.5], [by], names=["median"])


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long ``(col_a, col_b, corr)`` for every ordered pair, pairwise-complete rows, one pass.

    The matrix is symmetric: each unordered pair is aggregated once and mirrored."""
    cols = list(cols)
    idx = {}
    exprs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            # pairwise-complete: only rows where both values are present enter the pair's statistics
            both = _q(a).isNotNull() & _q(b).isNotNull()
            xa, xb = F.when(both, _q(a)), F.when(both, _q(b))
            k = len(exprs)
            exprs.append(F.try_divide(F.covar_pop(xa, xb), F.stddev_pop(xa) * F.stddev_pop(xb)).alias(f"_{k}"))
            idx[(a, b)] = idx[(b, a)] = k
    agg = df.agg(*exprs)
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"_{idx[(a, b)]}").alias("corr"))
            for a in cols for b in cols]
    return agg.select(F.inline(F.array(*rows)))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of every column (target included) with the target; ``rank`` is by correlation descending
    (undefined ones last), then by name. One row per column, so the ranking window is small."""
    cm = corr_matrix(df, list(cols) + [target]).where(F.col("col_b") == F.lit(target))
    order = Window.partitionBy("col_b").orderBy(F.desc_nulls_last("corr"), "col_a")
    return cm.select(F.col("col_a").alias("feature"), "corr", F.row_number().over(order).alias("rank"))


def class_mean_cov(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """Per class, the mean of each column and the sample covariance (ddof 1) of each pair."""
    exprs, rows = [], []
    for i, a in enumerate(cols):
        exprs.append(F.avg(_q(a)).alias(f"m_{i}"))
        rows.append(F.struct(F.lit("mean").alias("stat"), F.lit(a).alias("col_a"),
                             F.lit(None).cast("string").alias("col_b"), F.col(f"m_{i}").alias("value")))
        for j, b in enumerate(cols):
            if i <= j:  # the matrix is symmetric
                exprs.append(F.covar_samp(_q(a), _q(b)).alias(f"c_{i}_{j}"))
            rows.append(F.struct(F.lit("cov").alias("stat"), F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                 F.col(f"c_{min(i, j)}_{max(i, j)}").alias("value")))
    return df.groupBy(by).agg(*exprs).select(by, F.inline(F.array(*rows)))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """A15 + A16: class counts, positive ratio and number of distinct labels in one pass."""
    return df.agg(F.count_if(_q(label) == F.lit(1)).alias("n_pos"),
                  F.count_if(_q(label) == F.lit(0)).alias("n_neg"),
                  F.count(_q(label)).alias("n"),
                  F.count_distinct(_q(label)).alias("n_classes")) \
        .withColumn("pos_ratio", F.try_divide(F.col("n_pos").cast("double"), F.col("n")))
