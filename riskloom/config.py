"""Disease dimension (J2) and shared constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: the 20 diseases in configuration order (key, display name, icon, colour, tier).
# Order matters: ties in a ranked differential keep this order.
DISEASES = [
    ("fever", "Fever & Viral Flu", "🤒", "#ef4444", "Everyday Acute"),
    ("malaria", "Malaria", "🦟", "#f97316", "Everyday Acute"),
    ("typhoid", "Typhoid Fever", "🦠", "#eab308", "Everyday Acute"),
    ("dengue", "Dengue Fever", "🩸", "#ec4899", "Everyday Acute"),
    ("cold", "Common Cold / URI", "🤧", "#06b6d4", "Everyday Acute"),
    ("gastro", "Gastroenteritis", "🫄", "#10b981", "Everyday Acute"),
    ("diabetes", "Diabetes Mellitus", "🩸", "#ef4444", "Chronic & Metabolic"),
    ("hypertension", "Hypertension", "🩸", "#8b5cf6", "Chronic & Metabolic"),
    ("anemia", "Anemia", "🩸", "#a855f7", "Chronic & Metabolic"),
    ("thyroid", "Thyroid Disorder", "🦋", "#64748b", "Chronic & Metabolic"),
    ("dementia", "Alzheimer's & Dementia", "⚡", "#64748b", "Chronic & Metabolic"),
    ("heart", "Coronary Heart Disease", "❤️", "#f97316", "Severe Organic"),
    ("kidney", "Chronic Kidney Disease", "🧪", "#eab308", "Severe Organic"),
    ("liver", "Hepatic Liver Disease", "🫀", "#10b981", "Severe Organic"),
    ("pneumonia", "Pneumonia", "🫁", "#06b6d4", "Severe Organic"),
    ("asthma", "Asthma", "🫁", "#38bdf8", "Severe Organic"),
    ("cancer", "Oncology / Tumor Risk", "🎗️", "#ec4899", "Severe Organic"),
    ("stroke", "Stroke Risk", "🧠", "#a855f7", "CRITICAL EMERGENCY"),
    ("sepsis", "Sepsis & Septic Shock", "🦠", "#dc2626", "CRITICAL EMERGENCY"),
    ("hypertensive_crisis", "Hypertensive Crisis", "💥", "#ef4444", "CRITICAL EMERGENCY"),
]

# --- fixed values: training order of the disease loop.
TRAINING_ORDER = [
    "diabetes", "heart", "kidney", "liver", "stroke",
    "cancer", "pneumonia", "hypertension", "sepsis", "dementia",
    "fever", "malaria", "typhoid", "dengue", "cold",
    "gastro", "anemia", "thyroid", "asthma", "hypertensive_crisis",
]

# --- fixed values: the ten diseases that carry an explicit logistic risk rule.
RULE_DISEASES = ["fever", "malaria", "typhoid", "dengue", "cold",
                 "gastro", "anemia", "thyroid", "asthma", "hypertensive_crisis"]

# --- fixed values: risk tier cut points and labels.
LOW_CUT = 0.35
HIGH_CUT = 0.65
LOW, MODERATE, HIGH = "Low Risk", "Moderate Risk", "High Risk"

DISEASE_KEYS = [d[0] for d in DISEASES]
DISEASE_POS = {k: i for i, k in enumerate(DISEASE_KEYS)}
DISEASE_NAME = {d[0]: d[1] for d in DISEASES}
DISEASE_TIER = {d[0]: d[4] for d in DISEASES}

DIM_SCHEMA = T.StructType([
    T.StructField("disease_key", T.StringType(), False),
    T.StructField("config_pos", T.IntegerType(), False),
    T.StructField("disease_name", T.StringType(), False),
    T.StructField("icon", T.StringType(), False),
    T.StructField("color", T.StringType(), False),
    T.StructField("category_tier", T.StringType(), False),
])


def disease_dim(spark: SparkSession) -> DataFrame:
    """20-row dimension; its size is fixed, so it is always safe to broadcast."""
    rows = [(k, i, n, ic, c, t) for i, (k, n, ic, c, t) in enumerate(DISEASES)]
    return spark.createDataFrame(rows, DIM_SCHEMA)


def dim_values_sql() -> str:
    """The same dimension as a SQL VALUES list (used by the DuckDB oracle)."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    rows = ",\n    ".join(
        f"({q(k)}, {i}, {q(n)}, {q(ic)}, {q(c)}, {q(t)})" for i, (k, n, ic, c, t) in enumerate(DISEASES))
    return (f"(SELECT * FROM (VALUES\n    {rows}\n) AS d(disease_key, config_pos, disease_name, icon, color, "
            f"category_tier))")
