"""Split, preprocessing and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, metrics, prep, split
from ..sources.panels import load_panel
from ..sources.tables import table
from .scoring import _round_doubles
from .sqlutil import panel_cte

QUERIES = {}


def reg(name, sql):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _md5(*keys):
    parts = " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5({parts} || ':' || '42')"


_RANKED_ORDERS = f"""WITH r AS (SELECT o_orderkey, o_orderstatus,
  ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY {_md5('o_orderkey')}, o_orderkey) AS rn,
  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
"""


@reg("stratified_split", _RANKED_ORDERS + """SELECT o_orderkey, o_orderstatus,
  CASE WHEN rn <= round(n * 0.2e0) THEN 'test' ELSE 'train' END AS split FROM r""")
def stratified_split_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(o, "o_orderstatus", ["o_orderkey"])


@reg("stratified_kfold", _RANKED_ORDERS + "SELECT o_orderkey, CAST((rn - 1) % 3 AS INTEGER) AS fold FROM r")
def stratified_kfold_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_folds(o, "o_orderstatus", ["o_orderkey"], 3).select("o_orderkey", "fold")


@reg("stratified_cap", f"""WITH r AS (SELECT l_orderkey, l_linenumber,
  ROW_NUMBER() OVER (PARTITION BY l_linestatus ORDER BY {_md5('l_orderkey', 'l_linenumber')}, l_orderkey, l_linenumber)
    AS rn,
  count(*) OVER (PARTITION BY l_linestatus) AS nc, count(*) OVER () AS n FROM lineitem)
SELECT l_orderkey, l_linenumber FROM r
WHERE rn <= CASE WHEN n <= 20000 THEN nc ELSE round(nc * 20000.0e0 / n) END""")
def stratified_cap_q(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return split.stratified_cap(li, "l_linestatus", ["l_orderkey", "l_linenumber"], 20000) \
        .select("l_orderkey", "l_linenumber")


@reg("sample_fixed", f"SELECT o_orderkey FROM orders ORDER BY {_md5('o_orderkey')}, o_orderkey LIMIT 2000")
def sample_fixed_q(spark, sf):
    """T4: a fixed-size 2000-row sample (the limit is the operator)."""
    return split.fixed_sample(table(spark, sf, "orders").select("o_orderkey"), 2000, ["o_orderkey"])


@reg("class_weights", """SELECT quality, count(*) AS n_c,
  (SELECT count(*) FROM labels) * 1.0e0 / ((SELECT count(DISTINCT quality) FROM labels) * count(*)) AS weight
FROM labels GROUP BY quality""")
def class_weights_q(spark, sf):
    return prep.class_weight_balanced(table(spark, sf, "labels"), "quality")


@reg("pos_weight", """SELECT count(*) FILTER (WHERE quality = 1) AS pos, count(*) FILTER (WHERE quality = 0) AS neg,
  GREATEST(1.0e0, count(*) FILTER (WHERE quality = 0) / GREATEST(1, count(*) FILTER (WHERE quality = 1))) AS scale_pos_weight
FROM labels""")
def pos_weight_q(spark, sf):
    return prep.pos_weight(table(spark, sf, "labels"), "quality")


# ---- X1-X4 on the Pima-shaped panel and orders -----------------------------------------------------------

_PIMA_NUM = ["Pregnancies", "Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI", "DiabetesPedigreeFunction",
             "Age"]


def _pima_split(spark, sf):
    p = clean.sentinel_to_null(load_panel(spark, sf, "pima"), clean.SENTINEL_ZERO_COLUMNS)
    return split.stratified_split(p, "Outcome", ["patient_id"])


_PIMA_SPLIT_SQL = f"""WITH {panel_cte('pima')},
pn AS (SELECT patient_id, Pregnancies, nullif(Glucose, 0) AS Glucose, nullif(BloodPressure, 0) AS BloodPressure,
  nullif(SkinThickness, 0) AS SkinThickness, nullif(Insulin, 0) AS Insulin, nullif(BMI, 0) AS BMI,
  DiabetesPedigreeFunction, Age, Outcome FROM panel),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY Outcome ORDER BY {_md5('patient_id')}, patient_id) AS rn,
  count(*) OVER (PARTITION BY Outcome) AS n FROM pn),
sp AS (SELECT *, CASE WHEN rn <= round(n * 0.2e0) THEN 'test' ELSE 'train' END AS split FROM r),
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in _PIMA_NUM)} FROM sp WHERE split = 'train')
"""


@reg("median_impute", _PIMA_SPLIT_SQL + "SELECT patient_id, split, " + ", ".join(
    f"round(COALESCE({c}, m_{c}), 6) AS {c}" for c in clean.SENTINEL_ZERO_COLUMNS) + " FROM sp, med")
def median_impute_q(spark, sf):
    """Medians fitted on the training split only, applied to every row."""
    sp = _pima_split(spark, sf)
    med = prep.fit_medians(sp.where(F.col("split") == "train"), clean.SENTINEL_ZERO_COLUMNS)
    return _round_doubles(sp.select("patient_id", "split", *[F.coalesce(F.col(c).cast("double"), F.lit(med[c])).alias(c)
                                                           for c in clean.SENTINEL_ZERO_COLUMNS]))


_STATS = ", ".join(f"avg(COALESCE({c}, m_{c})) AS mu_{c}, stddev_pop(COALESCE({c}, m_{c})) AS sd_{c}" for c in _PIMA_NUM)


@reg("standard_scale", _PIMA_SPLIT_SQL + f""", st AS (SELECT {_STATS} FROM sp, med WHERE split = 'train')
SELECT patient_id, """ + ", ".join(
    f"round((COALESCE({c}, m_{c}) - mu_{c}) / CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL THEN 1.0e0 ELSE sd_{c} END, 6) AS {c}"
    for c in _PIMA_NUM) + " FROM sp, med, st")
def standard_scale_q(spark, sf):
    """X1 + X2 + X5: the numeric block of the preprocessor, fitted on train, applied to all rows."""
    sp = _pima_split(spark, sf)
    model = prep.fit_preprocessor(sp.where(F.col("split") == "train"), _PIMA_NUM, [])
    return _round_doubles(model.transform(sp, keep=["patient_id"]))


@reg("mode_impute", """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS seg
  FROM customer),
m AS (SELECT seg FROM (SELECT seg, count(*) AS k FROM c WHERE seg IS NOT NULL GROUP BY seg) ORDER BY k DESC, seg LIMIT 1)
SELECT c_custkey, COALESCE(c.seg, m.seg) AS segment FROM c, m""")
def mode_impute_q(spark, sf):
    """Most frequent segment (ties → smallest) fills the blanked segments."""
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("segment"))
    mode = prep.fit_modes(c, ["segment"])["segment"]
    return c.select("c_custkey", F.coalesce("segment", F.lit(mode)).alias("segment"))


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@reg("one_hot", _RANKED_ORDERS.replace("SELECT o_orderkey, o_orderstatus,", "SELECT o_orderkey, o_orderstatus, "
                                       "o_orderpriority,") + """, cats AS (SELECT DISTINCT o_orderpriority AS cat FROM r
  WHERE NOT (rn <= round(n * 0.2e0)))
SELECT o_orderkey, """ + ", ".join(
    f"""CASE WHEN (SELECT count(*) FROM cats WHERE cat = '{v}') > 0 THEN CAST(o_orderpriority = '{v}' AS DOUBLE) END
    AS "o_orderpriority_{v}\"""" for v in _PRIOS) + " FROM r")
def one_hot_q(spark, sf):
    """Categories fitted on the training split (sorted); unknown categories → all zeros."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    sp = split.stratified_split(o, "o_orderstatus", ["o_orderkey"])
    model = prep.fit_preprocessor(sp.where(F.col("split") == "train"), [], ["o_orderpriority"])
    return model.transform(sp, keep=["o_orderkey"])


# ---- M1-M5 on quality labels scored by document length ---------------------------------------------------

def _scored(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    s = lab.join(d, "doc_id").withColumn("score", F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0)))
    return s.withColumn("pred", (F.col("score") >= F.lit(0.5)).cast("int"))


_SCORED_SQL = """WITH s AS (SELECT l.doc_id, l.quality AS y, d.n_chars / (d.n_chars + 2000.0e0) AS score,
  CAST(d.n_chars / (d.n_chars + 2000.0e0) >= 0.5e0 AS INTEGER) AS pred
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""


@reg("confusion_matrix", _SCORED_SQL + """SELECT t.truth, count(*) FILTER (WHERE s.pred = 0) AS pred_0,
  count(*) FILTER (WHERE s.pred = 1) AS pred_1 FROM (VALUES (0), (1)) t(truth) LEFT JOIN s ON s.y = t.truth GROUP BY t.truth""")
def confusion_matrix_q(spark, sf):
    return metrics.confusion_matrix(_scored(spark, sf))


@reg("prf1", _SCORED_SQL + """, c AS (SELECT count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp,
  count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn,
  count(*) FILTER (WHERE y = pred) AS correct, count(*) AS n FROM s)
SELECT round(COALESCE(correct * 1.0e0 / nullif(n, 0), 0), 6) AS accuracy,
  round(COALESCE(tp * 1.0e0 / nullif(tp + fp, 0), 0), 6) AS precision,
  round(COALESCE(tp * 1.0e0 / nullif(tp + fn, 0), 0), 6) AS recall,
  round(COALESCE(2.0e0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, n FROM c""")
def prf1_q(spark, sf):
    return _round_doubles(metrics.classification_metrics(_scored(spark, sf)))


@reg("roc_auc", _SCORED_SQL + """, g AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos,
  count(*) FILTER (WHERE y = 0) AS neg FROM s GROUP BY score),
c AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM g)
SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0
  THEN sum(pos * (COALESCE(nb, 0) + neg / 2.0e0)) / (sum(pos) * sum(neg)) ELSE 0.5e0 END, 6) AS roc_auc FROM c""")
def roc_auc_q(spark, sf):
    return _round_doubles(metrics.roc_auc(_scored(spark, sf)))


@reg("avg_precision", _SCORED_SQL + """, g AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos,
  count(*) FILTER (WHERE y = 0) AS neg FROM s GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM g)
SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * tp * 1.0e0 / (tp + fp)) / sum(pos) ELSE 0.5e0 END, 6)
  AS avg_precision FROM c""")
def avg_precision_q(spark, sf):
    return _round_doubles(metrics.average_precision(_scored(spark, sf)))


# ---- W3 ------------------------------------------------------------------------------------------------

@reg("best_per_group", """WITH t AS (SELECT o_orderpriority, o_custkey, round(sum(o_totalprice), 6) AS total FROM orders
  GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY total DESC, o_custkey) AS rk FROM t)
SELECT o_orderpriority, o_custkey, total FROM r WHERE rk = 1""")
def best_per_group_q(spark, sf):
    """Winner per group (highest total, ties to the smaller key) as an aggregate, not a window:
    ``max(struct(total, -key))`` is combined map-side, so a huge group never sits in one task."""
    t = (table(spark, sf, "orders").groupBy("o_orderpriority", "o_custkey")
         .agg(F.round(F.sum("o_totalprice"), 6).alias("total")))
    best = t.groupBy("o_orderpriority").agg(F.max(F.struct("total", (-F.col("o_custkey")).alias("nk"))).alias("b"))
    return best.select("o_orderpriority", (-F.col("b.nk")).alias("o_custkey"), F.col("b.total").alias("total"))
