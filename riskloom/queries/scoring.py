"""Scoring, ranking and triage queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import rules
from ..functions.intake import INTAKE_A, intake_to_panel
from ..functions.recipes import engineer_features
from ..functions.scalar import keyword_flag, risk_tier
from ..operators import triage
from ..sources.panels import load_intake, load_panel
from ..sources.tables import table
from .sqlutil import interview_cte, panel_cte, projection_sql, qid, rule_prob_sql, vitals_cte

RULE_DISEASES = config.RULE_DISEASES
DIM_SQL = config.dim_values_sql()


def _round_doubles(df, digits=6):
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# ---- minimum slice ---------------------------------------------------------------------------------

def fever_tier_summary(spark, sf):
    """Fever panel → recipe → rule score → tier → count and mean score per tier."""
    scored = (engineer_features(load_panel(spark, sf, "fever"), "fever")
              .withColumn("probability", rules.rule_risk("fever"))
              .withColumn("category", risk_tier("probability")))
    return scored.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_patients"),
        F.round(F.avg("probability"), 6).alias("mean_probability"),
        F.round(F.avg("Pyrexia_Index"), 6).alias("mean_pyrexia_index"))


_TIER_SQL = ("CASE WHEN {p} IS NULL THEN NULL WHEN {p} < 0.35e0 THEN 'Low Risk' "
             "WHEN {p} < 0.65e0 THEN 'Moderate Risk' ELSE 'High Risk' END")

FEVER_TIER_SUMMARY_SQL = f"""
WITH {panel_cte('fever')},
scored AS (
  SELECT *, {rule_prob_sql('fever')} AS probability,
    CASE WHEN BodyTemp - 37.0e0 < 0 THEN 0.0e0 ELSE BodyTemp - 37.0e0 END * (1 + Chills) AS Pyrexia_Index
  FROM panel
)
SELECT {_TIER_SQL.format(p='probability')} AS category,
       count(*) AS n_patients,
       round(avg(probability), 6) AS mean_probability,
       round(avg(Pyrexia_Index), 6) AS mean_pyrexia_index
FROM scored GROUP BY 1
"""

QUERIES = {"fever_tier_summary": (fever_tier_summary, FEVER_TIER_SUMMARY_SQL)}


# ---- L1-L10 on the rule panels ----------------------------------------------------------------------

def _rule_query(d):
    def q(spark, sf):
        return load_panel(spark, sf, d).select(
            "patient_id", F.round(rules.rule_risk(d), 6).alias("probability"), "Outcome")
    sql = f"WITH {panel_cte(d)}\nSELECT patient_id, round({rule_prob_sql(d)}, 6) AS probability, Outcome FROM panel"
    return q, sql


for _d in RULE_DISEASES:
    QUERIES[f"rule_risk_{_d}"] = _rule_query(_d)


# ---- I1-I20: intake projections ----------------------------------------------------------------------

def _intake_query(kind, d):
    def q(spark, sf):
        return intake_to_panel(load_intake(spark, sf, kind), kind, d)
    cols = ",\n  ".join(f"{e} AS {qid(n)}" for n, e in projection_sql(kind, d).items())
    cte = interview_cte() if kind == "a" else vitals_cte()
    return q, f"WITH {cte}\nSELECT patient_id,\n  {cols}\nFROM intake"


for _kind in ("a", "b"):
    for _d in INTAKE_A:
        QUERIES[f"intake_{_kind}_{_d}"] = _intake_query(_kind, _d)


# ---- X17 / X18: whole intake tables scored against the rule diseases ---------------------------------

def _wide(spark, sf, kind):
    return triage.score_rules_wide(load_intake(spark, sf, kind), kind)


def _scores_sql(kind):
    cte = interview_cte() if kind == "a" else vitals_cte()
    cols = ",\n  ".join(f"{rule_prob_sql(d, projection_sql(kind, d))} AS p_{d}" for d in RULE_DISEASES)
    union = "\n  UNION ALL ".join(
        f"SELECT patient_id, '{d}' AS disease_key, p_{d} AS probability FROM scores" for d in RULE_DISEASES)
    return (f"WITH {cte},\nscores AS (SELECT patient_id,\n  {cols}\nFROM intake),\n"
            f"dim AS {DIM_SQL},\n"
            f"long AS (SELECT l.patient_id, l.disease_key, d.config_pos, d.disease_name, d.category_tier,"
            f" l.probability, l.probability * 100.0e0 AS percentage,"
            f" {_TIER_SQL.format(p='l.probability')} AS category\n"
            f"  FROM ({union}) l JOIN dim d USING (disease_key)),\n"
            f"ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY patient_id ORDER BY round(probability, 12) DESC NULLS LAST,"
            f" config_pos) AS rk FROM long)\n")


def triage_report_q(spark, sf):
    return triage.triage_report(_wide(spark, sf, "a"), RULE_DISEASES)


TRIAGE_REPORT_SQL = _scores_sql("a") + f"""
SELECT patient_id, disease_key AS top_disease_key, disease_name AS top_disease_name, category_tier,
  round(percentage, 6) AS top_percentage, category AS top_category,
  CASE WHEN percentage > 65 AND contains(category_tier, 'CRITICAL')
       THEN 'Emergency Triage: Seek Immediate Emergency Care'
       WHEN percentage > 50 THEN 'Medical Guidance: Doctor Consultation Recommended (within 24h)'
       ELSE 'Self Care: Home Rest & Symptom Monitoring' END AS triage_level,
  CASE WHEN percentage > 65 THEN 'Go to the nearest emergency room or call emergency medical services immediately.'
       WHEN percentage > 40 THEN 'Book an appointment with a General Physician. Request a CBC blood panel and lab tests.'
       ELSE 'Rest, stay hydrated, monitor your temperature, and consult a doctor if symptoms persist past 3 days.'
  END AS recommendation
FROM ranked WHERE rk = 1
"""


def differential_top5_q(spark, sf):
    return triage.differential_top(_wide(spark, sf, "a"), RULE_DISEASES, 5)


DIFFERENTIAL_TOP5_SQL = _scores_sql("a") + """
SELECT patient_id, CAST(rk AS INTEGER) AS rank, disease_key, disease_name, round(percentage, 6) AS percentage,
  round(LEAST(1.0e0, percentage / 100.0e0), 6) AS progress
FROM ranked WHERE rk <= 5
"""


def scan_scorecard_q(spark, sf):
    return triage.scorecard(_wide(spark, sf, "b"), RULE_DISEASES)


SCAN_SCORECARD_SQL = _scores_sql("b") + """
SELECT patient_id, round(avg(percentage), 6) AS avg_risk_pct,
  CAST(count(*) FILTER (WHERE category = 'High Risk') AS INTEGER) AS high_count,
  CAST(count(*) FILTER (WHERE category = 'Moderate Risk') AS INTEGER) AS moderate_count,
  CAST(count(probability) AS INTEGER) AS scanned
FROM long GROUP BY patient_id
"""


def critical_alerts_q(spark, sf):
    return triage.critical_alerts(_wide(spark, sf, "b"), RULE_DISEASES)


CRITICAL_ALERTS_SQL = _scores_sql("b") + """
SELECT patient_id, string_agg(disease_name, ', ' ORDER BY config_pos) AS alert, CAST(count(*) AS INTEGER) AS n_critical
FROM long WHERE category = 'High Risk' AND contains(category_tier, 'CRITICAL')
GROUP BY patient_id
"""


def _long_b(spark, sf):
    return triage.long_scores(_wide(spark, sf, "b"), RULE_DISEASES, config.disease_dim(spark))


def bulk_rule_scores_q(spark, sf):
    return _long_b(spark, sf).select(
        "patient_id", "disease_key", "disease_name", "category_tier",
        F.round("probability", 6).alias("probability"), F.round("percentage", 6).alias("percentage"), "category")


BULK_RULE_SCORES_SQL = _scores_sql("b") + """
SELECT patient_id, disease_key, disease_name, category_tier, round(probability, 6) AS probability,
  round(percentage, 6) AS percentage, category
FROM long
"""


def risk_tier_q(spark, sf):
    return _long_b(spark, sf).groupBy("disease_key", "category").agg(F.count(F.lit(1)).alias("n_patients"))


RISK_TIER_SQL = _scores_sql("b") + """
SELECT disease_key, category, count(*) AS n_patients FROM long GROUP BY disease_key, category
"""


def tier_groups_q(spark, sf):
    long = _long_b(spark, sf)
    keys = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("config_pos", "disease_key"))),
                                    lambda e: e["disease_key"]), ", ")
    return long.groupBy("category_tier").agg(
        keys.alias("disease_keys"),
        F.count_if(F.col("category") == F.lit(config.HIGH)).alias("n_high"),
        F.round(F.avg("percentage"), 6).alias("avg_percentage"))


# DuckDB cannot order a DISTINCT aggregate by another column: take keys in configuration order via a subquery.
TIER_GROUPS_SQL = _scores_sql("b") + """
, keys AS (SELECT category_tier, string_agg(disease_key, ', ' ORDER BY config_pos) AS disease_keys
  FROM (SELECT DISTINCT category_tier, disease_key, config_pos FROM long) GROUP BY category_tier)
SELECT k.category_tier, k.disease_keys, s.n_high, s.avg_percentage FROM keys k JOIN (
  SELECT category_tier, count(*) FILTER (WHERE category = 'High Risk') AS n_high,
    round(avg(percentage), 6) AS avg_percentage FROM long GROUP BY category_tier) s USING (category_tier)
"""


def risk_bars_q(spark, sf):
    """Per-patient bar table, ascending by risk (ties in configuration order, missing scores last)."""
    return triage.ascending_bars(_wide(spark, sf, "b"), RULE_DISEASES)


RISK_BARS_SQL = _scores_sql("b") + """
SELECT patient_id,
  CAST(ROW_NUMBER() OVER (PARTITION BY patient_id ORDER BY round(probability, 12) ASC NULLS LAST, config_pos) AS INTEGER)
    AS bar_order,
  disease_name AS disease, round(percentage, 6) AS risk_pct, category, category_tier AS tier
FROM long
"""

QUERIES.update({
    "triage_report": (triage_report_q, TRIAGE_REPORT_SQL),
    "differential_top5": (differential_top5_q, DIFFERENTIAL_TOP5_SQL),
    "scan_scorecard": (scan_scorecard_q, SCAN_SCORECARD_SQL),
    "critical_alerts": (critical_alerts_q, CRITICAL_ALERTS_SQL),
    "bulk_rule_scores": (bulk_rule_scores_q, BULK_RULE_SCORES_SQL),
    "risk_tier": (risk_tier_q, RISK_TIER_SQL),
    "tier_groups": (tier_groups_q, TIER_GROUPS_SQL),
    "risk_bars": (risk_bars_q, RISK_BARS_SQL),
})


# ---- F9-F11 on documents; J1 feature/target join -----------------------------------------------------

_DOC_KEYWORDS = {k: v[0] for k, v in
                 {"fever": (("fever",),), "chills": (("chills",),), "joint_eye": (("joint",),),
                  "gastro": (("nausea", "vomit"),), "resp": (("breath", "cough"),),
                  "neuro": (("dizziness", "memory"),), "chest": (("chest pain",),), "yellow": (("yellow",),),
                  "lump": (("lump",),)}.items()}


def keyword_flags_q(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("t"))
    return docs.select("doc_id", *[keyword_flag("t", kws).cast("int").alias(f"has_{k}")
                                   for k, kws in _DOC_KEYWORDS.items()])


KEYWORD_FLAGS_SQL = "SELECT doc_id,\n  " + ",\n  ".join(
    "CAST(" + " OR ".join(f"COALESCE(contains(lower(text), '{w}'), FALSE)" for w in kws) + f" AS INTEGER) AS has_{k}"
    for k, kws in _DOC_KEYWORDS.items()) + "\nFROM documents"


def features_targets_join_q(spark, sf):
    """Every feature column glued to every target column."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


FEATURES_TARGETS_JOIN_SQL = """
SELECT d.*, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def single_disease_score_q(spark, sf):
    """P20: one disease's panel scored with a check of its columns."""
    return _round_doubles(triage.score_single(load_panel(spark, sf, "malaria"), "malaria"))


SINGLE_DISEASE_SCORE_SQL = f"""WITH {panel_cte('malaria')},
s AS (SELECT patient_id, 1 / (1 + exp(-(-2.5e0 + 1.1e0 * CAST(coalesce(TempSpike > 38.8e0, FALSE) AS INT) + ShiveringParoxysm
  + 0.9e0 * CAST(coalesce(PlateletCount < 100, FALSE) AS INT) + 0.8e0 * Jaundice))) AS p FROM panel)
SELECT patient_id, round(p * 100, 6) AS percentage, {_TIER_SQL.format(p='p')} AS category FROM s"""


QUERIES.update({
    "keyword_flags": (keyword_flags_q, KEYWORD_FLAGS_SQL),
    "features_targets_join": (features_targets_join_q, FEATURES_TARGETS_JOIN_SQL),
    "single_disease_score": (single_disease_score_q, SINGLE_DISEASE_SCORE_SQL),
})
