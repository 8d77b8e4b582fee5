"""Cleaning operators (P1-P19, A9, W1/J4): nulls, duplicates, labels, sentinels, outlier filters.

Statistics that feed a row-level step (bounds, medians) are one-row or
few-row frames. A one-row statistic is attached as a scalar subquery
(``DataFrame.scalar()``), which Spark computes once and inlines, so no
join is planned. Per-group statistics with a bounded number of groups
(class labels) are broadcast-joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import MAX_LOCAL_ROWS, exact_quantiles

# --- fixed values: label column names renamed to ``Outcome`` (first match wins).
TARGET_CANDIDATES = ["Diabetes_binary", "Diabetes_01", "Outcome", "target"]
# --- fixed values: columns where 0 means "not measured" in the Pima-shaped table.
SENTINEL_ZERO_COLUMNS = ["Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI"]


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null (NaN counts as missing too)."""
    out = df.na.drop("any", subset=list(subset) if subset else None)
    for f in out.schema.fields:
        if (subset is None or f.name in subset) and f.dataType.typeName() in ("double", "float"):
            out = out.where(~F.isnan(F.col(f"`{f.name}`")))
    return out


def drop_duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicates removed (nulls compare equal); map-side combined, so a hot row costs one row."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical group, as a one-row frame."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.sum(F.col("_n") - F.lit(1)).alias("n_duplicates"), F.sum("_n").alias("n_rows")))


def rename_target(df: DataFrame, candidates: Sequence[str] = tuple(TARGET_CANDIDATES),
                  to: str = "Outcome") -> DataFrame:
    """Rename the first present candidate to ``Outcome`` (plan-time check, no job)."""
    for c in candidates:
        if c in df.columns:
            return df if c == to else df.withColumnRenamed(c, to)
    return df


def binarise_gt0(c) -> "F.Column":
    """P5: multi-grade label → 1 when > 0."""
    return (F.col(c) > F.lit(0)).cast("int")


def binarise_eq1(c) -> "F.Column":
    """Code 1 = case → 1, anything else → 0."""
    return (F.col(c) == F.lit(1)).cast("int")


def invert_label(c) -> "F.Column":
    """``1 - y``."""
    return F.lit(1) - F.col(c)


def split_features_target(df: DataFrame, target: str = "Outcome") -> tuple[DataFrame, str]:
    """Features without the target; a missing target raises ``KeyError`` before any job runs."""
    if target not in df.columns:
        raise KeyError(f"Target column '{target}' not found")
    return df.drop(target), target


def split_by_dtype(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """P10: (numeric, categorical) column names from the schema; strings and booleans are categorical."""
    cat, num = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (cat if f.dataType.typeName() in ("string", "boolean") else num).append(f.name)
    return num, cat


def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel=0) -> DataFrame:
    """``sentinel`` → null in the given columns."""
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit(sentinel)) for c in cols})


def group_median_fill(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """W1 + P17 + J4: fill nulls with the exact median of the column within ``by``.

    Medians come from ``exact_quantiles`` (no whole group in one task) and are joined back on the
    group key. Up to ``MAX_LOCAL_ROWS`` of them are broadcast: a join by few groups that shuffles
    would put each group's rows into one task.
    """
    found = exact_quantiles(df, cols, [0.5], [by])
    med = found.groupBy(by).pivot("column", list(cols)).agg(F.first("value"))
    med = med.select(by, *[F.col(f"`{c}`").alias(f"_med_{c}") for c in cols])
    if len(found.limit(MAX_LOCAL_ROWS + 1).select(by).collect()) <= MAX_LOCAL_ROWS:
        med = F.broadcast(med)
    joined = df.join(med, by, "left")
    return joined.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.col(f"_med_{c}")) for c in cols}) \
        .drop(*[f"_med_{c}" for c in cols])


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per column q1, q3, iqr, lower = q1 − k·iqr, upper = q3 + k·iqr."""
    long = exact_quantiles(df, cols, [0.25, 0.75])
    wide = long.groupBy("column").agg(F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
                                      F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return wide.select("column", "q1", "q3", iqr.alias("iqr"), (F.col("q1") - F.lit(k) * iqr).alias("lower"),
                       (F.col("q3") + F.lit(k) * iqr).alias("upper"))


def iqr_filter_sequential(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Keep rows inside ``[q1 − k·iqr, q3 + k·iqr]`` column by column; bounds are recomputed
    on the rows that survived the previous columns (``between`` is inclusive; null fails).

    Each step is one distributed quantile job whose result is two numbers; they come back to the
    driver (a fixed-size result, not data) and enter the next step as literals, so the plan stays
    a flat chain of ``len(cols)`` filters over the scan instead of nested subqueries that would
    recompute every earlier step.
    """
    cur = df
    for c in cols:
        row = iqr_bounds(cur, [c], k).select("lower", "upper").first()
        if row is None or row["lower"] is None:
            # no non-null values left: ``between`` with null bounds keeps nothing
            return cur.where(F.lit(False))
        cur = cur.where(F.col(f"`{c}`").between(F.lit(row["lower"]), F.lit(row["upper"])))
    return cur


def clip_to_bounds(df: DataFrame, cols: Sequence[str], ref: DataFrame | None = None,
                   headroom: float = 1.15) -> DataFrame:
    """Clip each column to ``[max(0, min_ref), max_ref × headroom]`` of a reference table
    (the table itself by default); null stays null. The bounds are one row, computed once and
    applied as literals."""
    ref = ref if ref is not None else df
    st = ref.agg(*[F.min(F.col(f"`{c}`")).cast("double").alias(f"mn_{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(f"`{c}`")).cast("double").alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        lo = F.greatest(F.lit(0.0), F.lit(st[f"mn_{i}"]).cast("double"))
        hi = F.lit(st[f"mx_{i}"]).cast("double") * F.lit(headroom)
        x = F.col(f"`{c}`").cast("double")
        out[c] = F.when(x.isNull(), x).when(x < lo, lo).when(x > hi, hi).otherwise(x)
    return df.withColumns(out)


def round_to_int(c) -> "F.Column":
    """Round half-to-even then cast to int."""
    return F.bround(F.col(c)).cast("int")


def tag_source(df: DataFrame, tag: str, col: str = "data_source") -> DataFrame:
    """Provenance literal."""
    return df.withColumn(col, F.lit(tag))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Row-wise union by column name (schemas must agree)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=False)
    return out
