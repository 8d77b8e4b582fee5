"""Feature recipe queries (R1-R20, F1, F2, F5, F8) on panels and driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.recipes import engineer_features, recipe_columns
from ..functions.scalar import bin_right_closed, cdc_age_code, clip_zero, row_sum_nulls_zero
from ..sources.panels import load_intake, load_panel
from ..sources.tables import table
from .scoring import _round_doubles
from .sqlutil import panel_cte, vitals_cte


def _clip(e):
    return f"(CASE WHEN ({e}) < 0 THEN 0.0e0 ELSE ({e}) END)"


def _bins(c, edges, labels, include_lowest):
    arms = []
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        left = f"{c} >= {lo}" if (i == 0 and include_lowest) else f"{c} > {lo}"
        arms.append(f"WHEN {left} AND {c} <= {hi} THEN '{lab}'")
    return "CASE " + " ".join(arms) + " END"


# --- oracle text of each recipe's output columns (same formulas written as SQL).
RECIPE_SQL = {
    "diabetes": {
        "BMI_Category": _bins("BMI", [0, 18.5, 24.9, 29.9, 100], ["Underweight", "Normal", "Overweight", "Obese"], True),
        "Age_Group": _bins("Age", [0, 3, 7, 10, 14], ["Young_Adult", "Middle_Aged", "Senior", "Elderly"], True),
        "Comorbidity_Index": ("COALESCE(HighBP, 0) + COALESCE(HighChol, 0) + COALESCE(HeartDiseaseorAttack, 0)"
                              " + COALESCE(Stroke, 0)"),
        "Lifestyle_Risk_Score": "0 + Smoker + (1 - PhysActivity) + HvyAlcoholConsump + (1 - Fruits) + (1 - Veggies)",
        "Health_Impairment_Days": "PhysHlth + MentHlth",
    },
    "heart": {
        "Atherogenic_Risk_Index": "Cholesterol / (RestingBP + 1e-5)",
        "HR_Reserve_Ratio": "MaxHR / (220 - Age + 1e-5)",
        "Ischemic_Severity_Score": "Oldpeak * (1 + ExerciseAngina)",
    },
    "kidney": {
        "BUN_Creatinine_Ratio": "BloodUrea / (SerumCreatinine + 1e-5)",
        "Anemia_Age_Risk": ("CAST(COALESCE(Hemoglobin < 12.0e0, FALSE) AS INT)"
                            " * CAST(COALESCE(Age > 50, FALSE) AS INT)"),
        "Renal_Vascular_Strain": "Albumin + 2 * Hypertension",
    },
    "liver": {
        "DeRitis_Ratio": "AspartateAminotransferase / (AlamineAminotransferase + 1e-5)",
        "Indirect_Bilirubin": _clip("TotalBilirubin - DirectBilirubin"),
        "Globulin_Level": _clip("TotalProteins - Albumin"),
    },
    "stroke": {
        "CardioMetabolic_Score": "(AvgGlucoseLevel / 100.0e0) * (BMI / 25.0e0)",
        "Vascular_Risk_Factor": "(Hypertension + HeartDisease) * (Age / 50.0e0)",
    },
    "cancer": {
        "Tumor_Density_Index": '"mean radius" * "mean texture"',
        "Nuclear_Atypia_Score": '"mean concavity" + 2.5e0 * "mean concave points"',
    },
    "pneumonia": {
        "Hypoxia_Tachypnea_Index": "(100.0e0 - SpO2) * (RespiratoryRate / 20.0e0)",
        "Systemic_Inflammation_Index": _clip("FeverTemp - 37.0e0") + " * WBC_Count",
    },
    "hypertension": {
        "Pulse_Pressure": "SystolicBP - DiastolicBP",
        "Mean_Arterial_Pressure": "DiastolicBP + (SystolicBP - DiastolicBP) / 3.0e0",
    },
    "sepsis": {
        "Shock_Index": "HeartRate / (SysBP + 1e-5)",
        "Metabolic_Crisis_Score": "Lactate * (WBC_Count / 10.0e0)",
    },
    "fever": {"Pyrexia_Index": _clip("BodyTemp - 37.0e0") + " * (1 + Chills)"},
    "malaria": {"Thrombocytopenic_Fever_Ratio": _clip("TempSpike - 37.0e0") + " / (PlateletCount / 100.0e0 + 1e-5)"},
    "typhoid": {"Enteric_Fever_Index": "StepladderFever * FeverDuration"},
    "dengue": {"Hemorrhagic_Risk_Score": _clip("HighFever - 37.0e0") + " * (150.0e0 / (PlateletCount + 1e-5))"},
    "cold": {"URI_Symptom_Count": ("COALESCE(Rhinorrhea, 0) + COALESCE(SoreThroat, 0) + COALESCE(Sneezing, 0)"
                                   " + COALESCE(NasalCongestion, 0)")},
    "gastro": {"Fluid_Loss_Severity": "VomitingEpisodes + 1.5e0 * DiarrheaEpisodes"},
    "anemia": {"MCH_Proxy": "Hemoglobin / (RBC_Count + 1e-5)"},
    "thyroid": {"TSH_FT4_Ratio": "TSH / (Free_T4 + 1e-5)"},
    "asthma": {"Airway_Obstruction_Score": "(100 - PeakExpiratoryFlow) * (1 + Wheezing)"},
    "hypertensive_crisis": {"Extreme_BP_Ratio": "(SystolicBP / 140.0e0) * (DiastolicBP / 90.0e0)"},
    "dementia": {
        "Cognitive_Dementia_Composite": "(30 - MMSE_Score) * (1 + 2 * CDR_Scale)",
        "Cognitive_Reserve_Ratio": "EducationYears / (Age / 50.0e0 + 1e-5)",
    },
}

_DOUBLE_HINT = ("Ratio", "Index", "Score", "Level", "Bilirubin", "Pressure", "Proxy", "Factor", "Severity",
                "Composite")


def _recipe_query(d):
    def q(spark, sf):
        panel = load_panel(spark, sf, d)
        out = engineer_features(panel, d)
        names = [n for n, _ in recipe_columns(panel, d)]
        return _round_doubles(out.select("patient_id", *names))

    def sql_col(name, expr):
        return f"round({expr}, 6) AS {name}" if name not in _INT_OUT else f"{expr} AS {name}"
    cols = ",\n  ".join(sql_col(n, e) for n, e in RECIPE_SQL[d].items())
    return q, f"WITH {panel_cte(d)}\nSELECT patient_id,\n  {cols}\nFROM panel"


# Recipe outputs that stay integer or string (everything else is a double and is rounded).
_INT_OUT = {"BMI_Category", "Age_Group", "Comorbidity_Index", "Lifestyle_Risk_Score", "Health_Impairment_Days",
            "Anemia_Age_Risk", "Renal_Vascular_Strain", "Pulse_Pressure", "Enteric_Fever_Index",
            "URI_Symptom_Count", "Airway_Obstruction_Score"}

QUERIES = {}
for _d in RECIPE_SQL:
    QUERIES[f"recipe_{_d}"] = _recipe_query(_d)


# ---- scalar operators on driver tables -----------------------------------------------------------------

def bin_right_closed_q(spark, sf):
    """F1 on l_quantity: right-closed bands, first band closed (include_lowest) vs open."""
    li = table(spark, sf, "lineitem")
    edges, labels = [0, 10, 20, 30, 40, 50], ["q1", "q2", "q3", "q4", "q5"]
    return (li.select(bin_right_closed("l_quantity", edges, labels, include_lowest=True).alias("band_closed"),
                      bin_right_closed("l_quantity", [1, 10, 20, 30, 40, 50], labels).alias("band_open"))
            .groupBy("band_closed", "band_open").agg(F.count(F.lit(1)).alias("n")))


BIN_RIGHT_CLOSED_SQL = f"""
SELECT {_bins('l_quantity', [0, 10, 20, 30, 40, 50], ['q1', 'q2', 'q3', 'q4', 'q5'], True)} AS band_closed,
       {_bins('l_quantity', [1, 10, 20, 30, 40, 50], ['q1', 'q2', 'q3', 'q4', 'q5'], False)} AS band_open,
       count(*) AS n
FROM lineitem GROUP BY 1, 2
"""


def row_sum_nulls_zero_q(spark, sf):
    """F2 after sentinel-to-null: discount + tax with missing values counted as 0."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("d"),
        F.nullif("l_tax", F.lit(0.0)).alias("t"))
    return li.select("l_orderkey", "l_linenumber", F.round(row_sum_nulls_zero(["d", "t"]), 6).alias("row_sum"))


ROW_SUM_SQL = """
SELECT l_orderkey, l_linenumber, round(COALESCE(nullif(l_discount, 0.0e0), 0) + COALESCE(nullif(l_tax, 0.0e0), 0), 6)
  AS row_sum FROM lineitem
"""


def clip_zero_keeps_null_q(spark, sf):
    """F5 on account balances (some negative); balances of one segment blanked to show nulls stay null."""
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != F.lit("BUILDING"), F.col("c_acctbal")).alias("bal"))
    return c.select("c_custkey", clip_zero("bal").alias("clipped"))


CLIP_ZERO_SQL = """
SELECT c_custkey, CASE WHEN bal < 0 THEN 0.0e0 ELSE bal END AS clipped
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS bal FROM customer)
"""


def cdc_age_code_q(spark, sf):
    """F8 on intake ages: years → CDC 5-year age code 1..13."""
    return (load_intake(spark, sf, "b").select(cdc_age_code("age").alias("age_code"), "age")
            .groupBy("age_code").agg(F.count(F.lit(1)).alias("n"), F.min("age").alias("min_age"),
                                     F.max("age").alias("max_age")))


CDC_AGE_SQL = f"""
WITH {vitals_cte()}
SELECT CAST(LEAST(GREATEST(floor((age - 18) / 5) + 1, 1), 13) AS INT) AS age_code, count(*) AS n,
  min(age) AS min_age, max(age) AS max_age
FROM intake GROUP BY 1
"""

QUERIES.update({
    "bin_right_closed": (bin_right_closed_q, BIN_RIGHT_CLOSED_SQL),
    "row_sum_nulls_zero": (row_sum_nulls_zero_q, ROW_SUM_SQL),
    "clip_zero_keeps_null": (clip_zero_keeps_null_q, CLIP_ZERO_SQL),
    "cdc_age_code": (cdc_age_code_q, CDC_AGE_SQL),
})
