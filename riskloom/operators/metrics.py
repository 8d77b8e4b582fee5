"""Evaluation metrics as aggregations over scored rows (M1-M6).

Confusion counts, accuracy, precision, recall and F1 are one aggregation
pass. ROC-AUC and average precision need running sums over the score order:
rows are first collapsed to one row per distinct score (map-side combined),
then ranked with ``global_cumsum`` (range partitioned), so no task ever holds
all scores. Both are exact and tie-aware.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import global_cumsum


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """M1: rows = truth (0 and 1, always both), columns = prediction (0/1); absent cells are 0."""
    y_, p = F.col(y), F.col(pred)
    cells = df.agg(*[F.count_if((y_ == t) & (p == q)).alias(f"_{t}{q}") for t in (0, 1) for q in (0, 1)])
    kind = df.schema[y].dataType
    return cells.select(F.inline(F.array(*[
        F.struct(F.lit(t).cast(kind).alias("truth"), F.col(f"_{t}0").alias("pred_0"), F.col(f"_{t}1").alias("pred_1"))
        for t in (0, 1)])))


def _zero_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def classification_metrics(df: DataFrame, y: str = "y", pred: str = "pred", by=()) -> DataFrame:
    """M2 + M3: accuracy, precision, recall, F1 of the positive class (0 when a denominator is 0); one row, or one per
    group of ``by``."""
    yc, pc, by = F.col(y), F.col(pred), list(by)
    return _classification(df.groupBy(*by).agg(
        F.count_if((yc == 1) & (pc == 1)).alias("tp"), F.count_if((yc == 0) & (pc == 1)).alias("fp"),
        F.count_if((yc == 1) & (pc == 0)).alias("fn"), F.count_if(yc == pc).alias("correct"), F.count(F.lit(1)).alias("n")), by)


def _classification(c: DataFrame, by) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision = _zero_div(tp, tp + fp)
    recall = _zero_div(tp, tp + fn)
    f1 = _zero_div(F.lit(2) * tp, F.lit(2) * tp + fp + fn)
    return c.select(*by, _zero_div(F.col("correct"), F.col("n")).alias("accuracy"), precision.alias("precision"),
                    recall.alias("recall"), f1.alias("f1"), "n")


def score_counts(df: DataFrame, y: str = "y", pred: str = "pred", score: str = "score", by=()) -> DataFrame:
    """Rows of class 1 and of class 0 (``pos``, ``neg``) per group of ``by``, predicted class and score ``s``, counted map-side:
    what both metrics of 0/1 labels need."""
    return df.groupBy(*by, pred, F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))


def classification_of_counts(counts: DataFrame, pred: str = "pred", by=()) -> DataFrame:
    """``classification_metrics`` of counted scores."""
    by, yes, no = list(by), F.col(pred) == 1, F.col(pred) == 0

    def total(when, n):
        return F.coalesce(F.sum(F.when(when, n)), F.lit(0))
    return _classification(counts.groupBy(*by).agg(
        total(yes, F.col("pos")).alias("tp"), total(yes, F.col("neg")).alias("fp"), total(no, F.col("pos")).alias("fn"),
        (total(yes, F.col("pos")) + total(no, F.col("neg"))).alias("correct"), F.sum(F.col("pos") + F.col("neg")).alias("n")), by)


def _by_score(df: DataFrame, y: str, score: str, by=()) -> DataFrame:
    return (df.where(F.col(score).isNotNull())
            .groupBy(*by, F.col(score).cast("double").alias("s"))
            .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")))


def ranking_metrics(df: DataFrame, y: str = "y", score: str = "score", by=()) -> DataFrame:
    """M4 + M5 from one ranking pass: ROC-AUC and average precision as one row, or one per group of ``by``.

    Null scores have no rank and are left out. With ascending running sums, the
    positives and negatives at or above a threshold ``s`` are ``P − pos_below(s)`` and ``N − neg_below(s)``, so one
    ``global_cumsum`` serves both metrics."""
    return _ranking(_by_score(df, y, score, by), list(by))


def ranking_of_counts(counts: DataFrame, by=()) -> DataFrame:
    """``ranking_metrics`` of counted scores; a score has one predicted class."""
    return _ranking(counts.where(F.col("s").isNotNull()).select(*by, "s", "pos", "neg"), list(by))


def _ranking(by_score: DataFrame, by: list) -> DataFrame:
    r = global_cumsum(by_score, by, ["s"], ["pos", "neg"])
    tp = F.col("_key_total_pos") - F.col("_cum_excl_pos")
    fp = F.col("_key_total_neg") - F.col("_cum_excl_neg")
    a = r.groupBy(*by).agg(F.sum(F.col("pos") * (F.col("_cum_excl_neg") + F.col("neg") / F.lit(2.0))).alias("auc_num"),
                           F.sum(F.try_divide(F.col("pos") * tp, tp + fp)).alias("ap_num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return a.select(*by, F.when(both, F.col("auc_num") / (F.col("P") * F.col("N"))).otherwise(F.lit(0.5)).alias("roc_auc"),
                    F.when(both, F.col("ap_num") / F.col("P")).otherwise(F.lit(0.5)).alias("avg_precision"))


def roc_auc(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """M4: ``Σ pos_s · (neg_below_s + neg_s / 2) / (P · N)`` over distinct scores; 0.5 with one class."""
    r = global_cumsum(_by_score(df, y, score), [], ["s"], ["pos", "neg"])
    a = r.agg(F.sum(F.col("pos") * (F.col("_cum_excl_neg") + F.col("neg") / F.lit(2.0))).alias("num"),
              F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / (F.col("P") * F.col("N")))
                    .otherwise(F.lit(0.5)).alias("roc_auc"))


def average_precision(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """M5: step-wise ``Σ (R_k − R_{k−1}) · P_k`` over distinct thresholds (not the trapezoid);
    0.5 with one class."""
    r = global_cumsum(_by_score(df, y, score).withColumn("ns", -F.col("s")), [], ["ns"], ["pos", "neg"])
    tp = F.col("_cum_incl_pos")
    fp = F.col("_cum_incl_neg")
    a = r.agg(F.sum(F.col("pos") * tp / (tp + fp)).alias("num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / F.col("P"))
                    .otherwise(F.lit(0.5)).alias("avg_precision"))


def positive_probability(prob_col: str = "probability", raw_col: str = "rawPrediction",
                         pred_col: str = "prediction", has_prob: bool = True, has_raw: bool = False) -> Column:
    """M6: P(y=1) from an MLlib output: probability vector → sigmoid of a raw margin → hard label."""
    from pyspark.ml.functions import vector_to_array
    if has_prob:
        return vector_to_array(F.col(prob_col))[1]
    if has_raw:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array(F.col(raw_col))[1]))
    return F.col(pred_col).cast("double")
