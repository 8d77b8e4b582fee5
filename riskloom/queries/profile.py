"""Cleaning, profiling and distribution queries (P1-P19, A1-A16, D1-D7) on driver tables and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, distribution, profile
from ..operators.quantiles import quantile_wide
from ..sources.panels import load_panel
from ..sources.tables import table
from .scoring import _round_doubles
from .sqlutil import panel_cte

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PIMA_ZERO = clean.SENTINEL_ZERO_COLUMNS


def _li(spark, sf):
    return table(spark, sf, "lineitem")


def _union(parts):
    return "\nUNION ALL ".join(parts)


QUERIES = {}


def reg(name, sql):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


# ---- A1, A2, P18, P19 -------------------------------------------------------------------------------

@reg("shape", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def shape_q(spark, sf):
    return profile.shape(_li(spark, sf))


_LI_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
             ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
             ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@reg("schema_profile", _union([f"SELECT '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null FROM lineitem"
                               for c, t in _LI_TYPES]))
def schema_profile_q(spark, sf):
    return profile.schema_profile(_li(spark, sf))


@reg("head", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_q(spark, sf):
    """First 5 rows in key order (a sort-limit: each task keeps its own top 5)."""
    return table(spark, sf, "orders").orderBy("o_orderkey").limit(5).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@reg("column_subset", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def column_subset_q(spark, sf):
    """Named columns only (the scan reads just these)."""
    return _li(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


# ---- A3, A4, P12, P1 on the Pima-shaped panel ----------------------------------------------------------

_PIMA_COLS = ["Pregnancies", "Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI",
              "DiabetesPedigreeFunction", "Age", "Outcome"]


def _pima_clean(spark, sf):
    return clean.sentinel_to_null(load_panel(spark, sf, "pima"), PIMA_ZERO)


_PIMA_NULLED = f"""WITH {panel_cte('pima')},
pn AS (SELECT patient_id, Pregnancies, nullif(Glucose, 0) AS Glucose, nullif(BloodPressure, 0) AS BloodPressure,
  nullif(SkinThickness, 0) AS SkinThickness, nullif(Insulin, 0) AS Insulin, nullif(BMI, 0) AS BMI,
  DiabetesPedigreeFunction, Age, Outcome FROM panel)
"""


@reg("null_profile", _PIMA_NULLED + _union(
    [f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM pn" for c in _PIMA_COLS]))
def null_profile_q(spark, sf):
    return profile.null_counts(_pima_clean(spark, sf), _PIMA_COLS)


@reg("zero_profile", _union([f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} = 0) AS zero_count FROM lineitem"
                             for c in NUM]))
def zero_profile_q(spark, sf):
    return profile.zero_counts(_li(spark, sf), NUM)


@reg("sentinel_to_null", _PIMA_NULLED + "SELECT patient_id, Glucose, BloodPressure, SkinThickness, Insulin, BMI FROM pn")
def sentinel_to_null_q(spark, sf):
    return _pima_clean(spark, sf).select("patient_id", *PIMA_ZERO)


@reg("drop_null_rows", _PIMA_NULLED + "SELECT patient_id FROM pn WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in _PIMA_COLS))
def drop_null_rows_q(spark, sf):
    return clean.drop_null_rows(_pima_clean(spark, sf)).select("patient_id")


# ---- W1 / P17 / J4 group median fill; A10 group median ---------------------------------------------------

_LI_NULLED = """WITH ln AS (SELECT l_orderkey, l_linenumber, l_linestatus, nullif(l_discount, 0.0e0) AS l_discount,
  nullif(l_tax, 0.0e0) AS l_tax FROM lineitem)
"""


def _li_nulled(spark, sf):
    return clean.sentinel_to_null(_li(spark, sf).select("l_orderkey", "l_linenumber", "l_linestatus", "l_discount",
                                                        "l_tax"), ["l_discount", "l_tax"], 0.0)


@reg("group_median_fill", _LI_NULLED + """, med AS (SELECT l_linestatus, quantile_cont(l_discount, 0.5) AS md,
  quantile_cont(l_tax, 0.5) AS mt FROM ln GROUP BY l_linestatus)
SELECT l_orderkey, l_linenumber, round(COALESCE(l_discount, md), 6) AS l_discount,
  round(COALESCE(l_tax, mt), 6) AS l_tax FROM ln JOIN med USING (l_linestatus)""")
def group_median_fill_q(spark, sf):
    filled = clean.group_median_fill(_li_nulled(spark, sf), ["l_discount", "l_tax"], "l_linestatus")
    return _round_doubles(filled.select("l_orderkey", "l_linenumber", "l_discount", "l_tax"))


@reg("group_median", _union([f"SELECT l_linestatus, '{c}' AS column, round(quantile_cont({c}, 0.5), 6) AS median "
                             f"FROM lineitem GROUP BY l_linestatus" for c in NUM]))
def group_median_q(spark, sf):
    return _round_doubles(profile.group_median(_li(spark, sf), NUM, "l_linestatus"))


# ---- P2, P3 ---------------------------------------------------------------------------------------------

def _events_with_repeats(spark, sf):
    """Whole event rows, those of even users twice."""
    ev = table(spark, sf, "events")
    return ev.unionByName(ev.where(F.col("user_id") % 2 == 0))


@reg("dedupe", "SELECT DISTINCT * FROM events")
def dedupe_q(spark, sf):
    return clean.drop_duplicate_rows(_events_with_repeats(spark, sf))


@reg("duplicate_count", """SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates, CAST(sum(n) AS BIGINT) AS n_rows
FROM (SELECT *, count(*) AS n FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE user_id % 2 = 0) GROUP BY ALL)""")
def duplicate_count_q(spark, sf):
    return clean.duplicate_count(_events_with_repeats(spark, sf))


# ---- A7, A8, A9 ------------------------------------------------------------------------------------------

@reg("quantile_iqr", _union([f"""SELECT '{c}' AS column, round(q1, 6) AS q1, round(q3, 6) AS q3,
  round(q3 - q1, 6) AS iqr, round(q1 - 1.5e0 * (q3 - q1), 6) AS lower, round(q3 + 1.5e0 * (q3 - q1), 6) AS upper,
  (SELECT count(*) FROM lineitem WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS n_outliers
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)""" for c in NUM]))
def quantile_iqr_q(spark, sf):
    li = _li(spark, sf)
    b = clean.iqr_bounds(li, NUM)
    # strict outliers of every column in one pass, with the bounds (one row per column) as literals
    bounds = {r["column"]: r for r in b.collect()}
    counted = li.agg(*[F.count_if((F.col(c) < F.lit(bounds[c]["lower"])) | (F.col(c) > F.lit(bounds[c]["upper"]))).alias(c)
                       for c in bounds])
    cnt = counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_outliers")) for c in bounds])))
    return _round_doubles(b.join(cnt, "column"))


_IQR_SEQ_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _iqr_seq_sql():
    ctes = ["s0 AS (SELECT l_orderkey, l_linenumber, " + ", ".join(_IQR_SEQ_COLS) + " FROM lineitem)"]
    for i, c in enumerate(_IQR_SEQ_COLS):
        prev = f"s{i}"
        ctes.append(f"b{i} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {prev})")
        ctes.append(f"s{i + 1} AS (SELECT {prev}.* FROM {prev}, b{i} WHERE {c} BETWEEN q1 - 1.5e0 * (q3 - q1) "
                    f"AND q3 + 1.5e0 * (q3 - q1))")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT l_orderkey, l_linenumber FROM s{len(_IQR_SEQ_COLS)}"


@reg("iqr_sequential_filter", _iqr_seq_sql())
def iqr_sequential_filter_q(spark, sf):
    li = _li(spark, sf).select("l_orderkey", "l_linenumber", *_IQR_SEQ_COLS)
    return clean.iqr_filter_sequential(li, _IQR_SEQ_COLS).select("l_orderkey", "l_linenumber")


# ---- A5, A6, D5 ------------------------------------------------------------------------------------------

@reg("value_counts", "SELECT o_orderpriority, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, "
                     "o_orderpriority) AS rank FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1")
def value_counts_q(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@reg("value_share", """SELECT c_mktsegment, count(*) AS count,
  round(count(*) * 100.0e0 / sum(count(*)) OVER (), 6) AS share FROM customer GROUP BY 1""")
def value_share_q(spark, sf):
    return _round_doubles(profile.value_share(table(spark, sf, "customer"), "c_mktsegment", 100.0))


_BANDS = ["q_low", "q_mid", "q_high", "q_top"]


@reg("count_in_label_order", """WITH b AS (SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'q_low'
  WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'q_mid' WHEN l_quantity > 25 AND l_quantity <= 50 THEN 'q_high'
  WHEN l_quantity > 50 AND l_quantity <= 100 THEN 'q_top' END AS band FROM lineitem),
labels AS (SELECT * FROM (VALUES ('q_low', 0), ('q_mid', 1), ('q_high', 2), ('q_top', 3)) t(band, label_pos))
SELECT labels.band, labels.label_pos, count(b.band) AS count FROM labels LEFT JOIN b ON labels.band = b.band
GROUP BY labels.band, labels.label_pos""")
def count_in_label_order_q(spark, sf):
    """Counts per label in a given order; empty labels kept at 0 (q_top never occurs)."""
    from ..functions.scalar import bin_right_closed
    b = _li(spark, sf).select(bin_right_closed("l_quantity", [0, 10, 25, 50, 100], _BANDS).alias("band"))
    return profile.value_counts(b, "band", _BANDS).select("band", "label_pos", "count")


# ---- A11, A12, A13, A15/A16 ------------------------------------------------------------------------------

def _corr_sql(a, b):
    return f"round(corr({a}, {b}), 6)"


@reg("corr_matrix", _union([f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_corr_sql(a, b)} AS corr FROM lineitem"
                            for a in NUM for b in NUM]))
def corr_matrix_q(spark, sf):
    return _round_doubles(profile.corr_matrix(_li(spark, sf), NUM))


@reg("corr_target", "WITH t AS (SELECT *, CAST(l_linestatus = 'F' AS INTEGER) AS is_f FROM lineitem),\nc AS (" + _union(
    [f"SELECT '{a}' AS feature, corr({a}, is_f) AS c FROM t" for a in NUM + ["is_f"]])
    + ")\nSELECT feature, round(c, 6) AS corr, CAST(row_number() OVER (ORDER BY c DESC NULLS LAST, feature) AS INTEGER) AS rank FROM c")
def corr_target_q(spark, sf):
    li = _li(spark, sf).withColumn("is_f", (F.col("l_linestatus") == F.lit("F")).cast("int"))
    return _round_doubles(profile.corr_with_target(li, NUM, "is_f"))


@reg("class_mean_cov", _union(
    [f"SELECT l_linestatus, 'mean' AS stat, '{a}' AS col_a, NULL::VARCHAR AS col_b, round(avg({a}), 6) AS value "
     f"FROM lineitem GROUP BY 1" for a in NUM] +
    [f"SELECT l_linestatus, 'cov' AS stat, '{a}' AS col_a, '{b}' AS col_b, round(covar_samp({a}, {b}), 6) AS value "
     f"FROM lineitem GROUP BY 1" for a in NUM for b in NUM]))
def class_mean_cov_q(spark, sf):
    return _round_doubles(profile.class_mean_cov(_li(spark, sf), NUM, "l_linestatus"))


@reg("class_balance", """SELECT count(*) FILTER (WHERE quality = 1) AS n_pos, count(*) FILTER (WHERE quality = 0) AS n_neg,
  count(quality) AS n, count(DISTINCT quality) AS n_classes,
  round(count(*) FILTER (WHERE quality = 1) * 1.0e0 / count(quality), 6) AS pos_ratio FROM labels""")
def class_balance_q(spark, sf):
    return _round_doubles(profile.class_balance(table(spark, sf, "labels"), "quality"))


# ---- P4-P8, P16, T7 --------------------------------------------------------------------------------------

@reg("label_binarise_gt0", "SELECT l_orderkey, l_linenumber, CAST(l_tax > 0 AS INTEGER) AS label FROM lineitem")
def label_binarise_gt0_q(spark, sf):
    """P5 on a graded column: tax rate > 0 → 1."""
    return _li(spark, sf).select("l_orderkey", "l_linenumber", clean.binarise_gt0("l_tax").alias("label"))


@reg("label_binarise_eq1", "SELECT doc_id, CAST(toxic = 1 AS INTEGER) AS label FROM labels")
def label_binarise_eq1_q(spark, sf):
    return table(spark, sf, "labels").select("doc_id", clean.binarise_eq1("toxic").alias("label"))


@reg("label_invert", "SELECT doc_id, 1 - quality AS Outcome FROM labels")
def label_invert_q(spark, sf):
    """P4 + P7 + P8: rename the first target candidate to Outcome, then invert it."""
    df = clean.rename_target(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("target")))
    return df.select("doc_id", clean.invert_label("Outcome").cast("int").alias("Outcome"))


@reg("union_tagged", """SELECT c_custkey AS party_key, c_acctbal AS balance, 'customer' AS data_source FROM customer
UNION ALL SELECT s_suppkey AS party_key, s_acctbal AS balance, 'supplier' AS data_source FROM supplier""")
def union_tagged_q(spark, sf):
    c = clean.tag_source(table(spark, sf, "customer").select(F.col("c_custkey").alias("party_key"),
                                                             F.col("c_acctbal").alias("balance")), "customer")
    s = clean.tag_source(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_key"),
                                                             F.col("s_acctbal").alias("balance")), "supplier")
    return clean.union_all([c, s])


@reg("class_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_linestatus = 'F' AS INTEGER) = 1")
def class_filter_q(spark, sf):
    """Rows of the positive class (pushed down to the scan)."""
    li = _li(spark, sf).withColumn("Outcome", (F.col("l_linestatus") == F.lit("F")).cast("int"))
    return li.where(F.col("Outcome") == F.lit(1)).select("l_orderkey", "l_linenumber")


# ---- P14, P15 --------------------------------------------------------------------------------------------

@reg("clip_bounds", """WITH b AS (SELECT GREATEST(0.0e0, min(c_acctbal)) AS lo, max(c_acctbal) * 1.15e0 AS hi FROM customer)
SELECT c_custkey, round(LEAST(GREATEST(c_acctbal, lo), hi), 6) AS balance,
  CAST(round_even(LEAST(GREATEST(c_acctbal, lo), hi) / 100.0e0, 0) AS INTEGER) AS balance_hundreds
FROM customer, b""")
def clip_bounds_q(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    clipped = clean.clip_to_bounds(cust, ["balance"])
    return clipped.select("c_custkey", F.round("balance", 6).alias("balance"),
                          F.bround(F.col("balance") / F.lit(100.0)).cast("int").alias("balance_hundreds"))


# ---- D1, D2, D3, D7 --------------------------------------------------------------------------------------

def _hist_sql(col, bins, by=None):
    g = f"{by}, " if by else ""
    return f"""WITH s AS (SELECT min({col}) AS lo, max({col}) AS hi FROM lineitem),
h AS (SELECT {g}CAST(CASE WHEN (hi - lo) / {bins}.0e0 = 0 THEN 0
  ELSE LEAST(floor(({col} - lo) / ((hi - lo) / {bins}.0e0)), {bins - 1}) END AS INTEGER) AS bin, lo, hi
  FROM lineitem, s WHERE {col} IS NOT NULL)
SELECT {g}bin, round(lo + bin * ((hi - lo) / {bins}.0e0), 6) AS bin_lo,
  round(lo + (bin + 1) * ((hi - lo) / {bins}.0e0), 6) AS bin_hi, count(*) AS count
FROM h GROUP BY {g}bin, lo, hi"""


@reg("hist30", _hist_sql("l_extendedprice", 30))
def hist30_q(spark, sf):
    return _round_doubles(distribution.histogram(_li(spark, sf), "l_extendedprice", 30))


@reg("hist_by_class", _hist_sql("l_extendedprice", 40, "l_linestatus"))
def hist_by_class_q(spark, sf):
    return _round_doubles(distribution.histogram(_li(spark, sf), "l_extendedprice", 40, by="l_linestatus"))


@reg("kde", """WITH v AS (SELECT l_quantity AS v, count(*) AS w FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1),
s AS (SELECT sum(w) * 1.0e0 AS n, min(v) AS lo, max(v) AS hi, (SELECT var_samp(l_quantity) FROM lineitem) AS var FROM v),
p AS (SELECT n, sqrt(var) * pow(n, -0.2e0) AS h, lo, hi FROM s),
g AS (SELECT CAST(i AS INTEGER) AS grid_index, lo - 3.0e0 * h + i * ((hi + 3.0e0 * h - (lo - 3.0e0 * h)) / 199.0e0) AS x,
  n, h FROM p, range(0, 200) t(i))
SELECT grid_index, round(x, 6) AS x, round(sum(w * exp(-0.5e0 * pow((x - v) / h, 2.0e0))) / (n * h * sqrt(2 * pi())), 6)
  AS density
FROM g, v GROUP BY grid_index, x, n, h""")
def kde_q(spark, sf):
    return _round_doubles(distribution.kde(_li(spark, sf), "l_quantity", 200))


@reg("box_summary", """WITH q AS (SELECT l_linestatus, quantile_cont(l_extendedprice, 0.25) AS q1,
  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
j AS (SELECT l.l_linestatus, l_extendedprice AS x, q1, median, q3, q1 - 1.5e0 * (q3 - q1) AS lo,
  q3 + 1.5e0 * (q3 - q1) AS hi FROM lineitem l JOIN q USING (l_linestatus) WHERE l_extendedprice IS NOT NULL)
SELECT l_linestatus, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min(x) FILTER (WHERE x >= lo AND x <= hi), 6) AS whisker_lo,
  round(max(x) FILTER (WHERE x >= lo AND x <= hi), 6) AS whisker_hi,
  count(*) FILTER (WHERE NOT (x >= lo AND x <= hi)) AS n_outliers
FROM j GROUP BY 1""")
def box_summary_q(spark, sf):
    return _round_doubles(distribution.box_summary(_li(spark, sf), "l_extendedprice", "l_linestatus"))


@reg("scatter_table", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_linestatus FROM lineitem")
def scatter_table_q(spark, sf):
    """The columns a scatter plot needs, whole table."""
    return _li(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus")


@reg("quantile_table", _union([f"SELECT '{c}' AS column, round(quantile_cont({c}, 0.1), 6) AS q10, "
                               f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.9), 6) AS q90 "
                               f"FROM lineitem" for c in NUM]))
def quantile_table_q(spark, sf):
    """Exact linear-interpolated quantiles of every numeric column."""
    return _round_doubles(quantile_wide(_li(spark, sf), NUM, [0.1, 0.5, 0.9]))
