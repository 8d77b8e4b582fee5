"""Disease feature recipes (R1-R20) and the recipe dispatcher.

Each recipe adds its columns only when all of its inputs exist (checked on
``df.columns``: plan-time metadata, no job) and emits every new column in one
projection. ``Lifestyle_Risk_Score`` is the one column that is always added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import bin_right_closed, clip_zero, col, flag_of, row_sum_nulls_zero, safe_ratio

Recipe = Callable[[set], list[tuple[str, Column]]]

# --- fixed values: body-mass-index bands and CDC age-code bands (right-closed, first bin closed).
BMI_EDGES = [0, 18.5, 24.9, 29.9, 100]
BMI_LABELS = ["Underweight", "Normal", "Overweight", "Obese"]
CDC_AGE_EDGES = [0, 3, 7, 10, 14]
CDC_AGE_LABELS = ["Young_Adult", "Middle_Aged", "Senior", "Elderly"]


def _has(cols: set, *names: str) -> bool:
    return all(n in cols for n in names)


def diabetes(cols: set) -> list[tuple[str, Column]]:
    out = []
    if "BMI" in cols:
        out.append(("BMI_Category", bin_right_closed("BMI", BMI_EDGES, BMI_LABELS, include_lowest=True)))
    if "Age" in cols:
        out.append(("Age_Group", bin_right_closed("Age", CDC_AGE_EDGES, CDC_AGE_LABELS, include_lowest=True)))
    comorb = [c for c in ["HighBP", "HighChol", "HeartDiseaseorAttack", "Stroke"] if c in cols]
    if comorb:
        out.append(("Comorbidity_Index", row_sum_nulls_zero(comorb)))
    score = F.lit(0)
    for c, inverted in [("Smoker", False), ("PhysActivity", True), ("HvyAlcoholConsump", False),
                        ("Fruits", True), ("Veggies", True)]:
        if c in cols:
            score = score + ((F.lit(1) - col(c)) if inverted else col(c))
    out.append(("Lifestyle_Risk_Score", score))
    if _has(cols, "PhysHlth", "MentHlth"):
        out.append(("Health_Impairment_Days", col("PhysHlth") + col("MentHlth")))
    return out


def heart(cols):
    out = []
    if _has(cols, "Cholesterol", "RestingBP"):
        out.append(("Atherogenic_Risk_Index", safe_ratio("Cholesterol", "RestingBP")))
    if _has(cols, "MaxHR", "Age"):
        out.append(("HR_Reserve_Ratio", safe_ratio("MaxHR", F.lit(220) - col("Age"))))
    if _has(cols, "Oldpeak", "ExerciseAngina"):
        out.append(("Ischemic_Severity_Score", col("Oldpeak") * (F.lit(1) + col("ExerciseAngina"))))
    return out


def kidney(cols):
    out = []
    if _has(cols, "SerumCreatinine", "BloodUrea"):
        out.append(("BUN_Creatinine_Ratio", safe_ratio("BloodUrea", "SerumCreatinine")))
    if _has(cols, "Hemoglobin", "Age"):
        out.append(("Anemia_Age_Risk", flag_of(col("Hemoglobin") < F.lit(12.0)) * flag_of(col("Age") > F.lit(50))))
    if _has(cols, "Albumin", "Hypertension"):
        out.append(("Renal_Vascular_Strain", col("Albumin") + F.lit(2) * col("Hypertension")))
    return out


def liver(cols):
    out = []
    if _has(cols, "AspartateAminotransferase", "AlamineAminotransferase"):
        out.append(("DeRitis_Ratio", safe_ratio("AspartateAminotransferase", "AlamineAminotransferase")))
    if _has(cols, "TotalBilirubin", "DirectBilirubin"):
        out.append(("Indirect_Bilirubin", clip_zero(col("TotalBilirubin") - col("DirectBilirubin"))))
    if _has(cols, "Albumin", "TotalProteins"):
        out.append(("Globulin_Level", clip_zero(col("TotalProteins") - col("Albumin"))))
    return out


def stroke(cols):
    out = []
    if _has(cols, "AvgGlucoseLevel", "BMI"):
        out.append(("CardioMetabolic_Score", (col("AvgGlucoseLevel") / F.lit(100.0)) * (col("BMI") / F.lit(25.0))))
    if _has(cols, "Hypertension", "HeartDisease", "Age"):
        out.append(("Vascular_Risk_Factor",
                    (col("Hypertension") + col("HeartDisease")) * (col("Age") / F.lit(50.0))))
    return out


def cancer(cols):
    out = []
    if _has(cols, "mean radius", "mean texture"):
        out.append(("Tumor_Density_Index", col("mean radius") * col("mean texture")))
    if _has(cols, "mean concavity", "mean concave points"):
        out.append(("Nuclear_Atypia_Score", col("mean concavity") + F.lit(2.5) * col("mean concave points")))
    return out


def pneumonia(cols):
    out = []
    if _has(cols, "SpO2", "RespiratoryRate"):
        out.append(("Hypoxia_Tachypnea_Index",
                    (F.lit(100.0) - col("SpO2")) * (col("RespiratoryRate") / F.lit(20.0))))
    if _has(cols, "FeverTemp", "WBC_Count"):
        out.append(("Systemic_Inflammation_Index", clip_zero(col("FeverTemp") - F.lit(37.0)) * col("WBC_Count")))
    return out


def hypertension(cols):
    if not _has(cols, "SystolicBP", "DiastolicBP"):
        return []
    pp = col("SystolicBP") - col("DiastolicBP")
    return [("Pulse_Pressure", pp), ("Mean_Arterial_Pressure", col("DiastolicBP") + pp / F.lit(3.0))]


def sepsis(cols):
    out = []
    if _has(cols, "SysBP", "HeartRate"):
        out.append(("Shock_Index", safe_ratio("HeartRate", "SysBP")))
    if _has(cols, "Lactate", "WBC_Count"):
        out.append(("Metabolic_Crisis_Score", col("Lactate") * (col("WBC_Count") / F.lit(10.0))))
    return out


def fever(cols):
    if not _has(cols, "BodyTemp", "Chills"):
        return []
    return [("Pyrexia_Index", clip_zero(col("BodyTemp") - F.lit(37.0)) * (F.lit(1) + col("Chills")))]


def malaria(cols):
    if not _has(cols, "TempSpike", "PlateletCount"):
        return []
    return [("Thrombocytopenic_Fever_Ratio",
             F.try_divide(clip_zero(col("TempSpike") - F.lit(37.0)),
                          col("PlateletCount") / F.lit(100.0) + F.lit(1e-5)))]


def typhoid(cols):
    if not _has(cols, "StepladderFever", "FeverDuration"):
        return []
    return [("Enteric_Fever_Index", col("StepladderFever") * col("FeverDuration"))]


def dengue(cols):
    if not _has(cols, "HighFever", "PlateletCount"):
        return []
    return [("Hemorrhagic_Risk_Score",
             clip_zero(col("HighFever") - F.lit(37.0)) * F.try_divide(F.lit(150.0), col("PlateletCount") + F.lit(1e-5)))]


def cold(cols):
    present = [c for c in ["Rhinorrhea", "SoreThroat", "Sneezing", "NasalCongestion"] if c in cols]
    return [("URI_Symptom_Count", row_sum_nulls_zero(present))] if present else []


def gastro(cols):
    if not _has(cols, "VomitingEpisodes", "DiarrheaEpisodes"):
        return []
    return [("Fluid_Loss_Severity", col("VomitingEpisodes") + F.lit(1.5) * col("DiarrheaEpisodes"))]


def anemia(cols):
    if not _has(cols, "Hemoglobin", "RBC_Count"):
        return []
    return [("MCH_Proxy", safe_ratio("Hemoglobin", "RBC_Count"))]


def thyroid(cols):
    if not _has(cols, "TSH", "Free_T4"):
        return []
    return [("TSH_FT4_Ratio", safe_ratio("TSH", "Free_T4"))]


def asthma(cols):
    if not _has(cols, "PeakExpiratoryFlow", "Wheezing"):
        return []
    return [("Airway_Obstruction_Score", (F.lit(100) - col("PeakExpiratoryFlow")) * (F.lit(1) + col("Wheezing")))]


def hypertensive_crisis(cols):
    if not _has(cols, "SystolicBP", "DiastolicBP"):
        return []
    return [("Extreme_BP_Ratio", (col("SystolicBP") / F.lit(140.0)) * (col("DiastolicBP") / F.lit(90.0)))]


def dementia(cols):
    out = []
    if _has(cols, "MMSE_Score", "CDR_Scale"):
        out.append(("Cognitive_Dementia_Composite",
                    (F.lit(30) - col("MMSE_Score")) * (F.lit(1) + F.lit(2) * col("CDR_Scale"))))
    if _has(cols, "Age", "EducationYears"):
        out.append(("Cognitive_Reserve_Ratio",
                    F.try_divide(col("EducationYears"), col("Age") / F.lit(50.0) + F.lit(1e-5))))
    return out


RECIPES: dict[str, Recipe] = {
    "diabetes": diabetes, "heart": heart, "kidney": kidney, "liver": liver, "stroke": stroke,
    "cancer": cancer, "pneumonia": pneumonia, "hypertension": hypertension, "sepsis": sepsis,
    "fever": fever, "malaria": malaria, "typhoid": typhoid, "dengue": dengue, "cold": cold,
    "gastro": gastro, "anemia": anemia, "thyroid": thyroid, "asthma": asthma,
    "hypertensive_crisis": hypertensive_crisis, "dementia": dementia,
}

# --- fixed values: dispatch order of the recipe lookup (first keyword hit on the lower-cased name wins).
DISPATCH = [
    (("diabetes",), "diabetes"),
    (("heart", "cardio"), "heart"),
    (("kidney", "ckd"), "kidney"),
    (("liver", "hepatic"), "liver"),
    (("stroke",), "stroke"),
    (("cancer", "oncology", "tumor"), "cancer"),
    (("pneumonia", "respiratory"), "pneumonia"),
    (("hypertension_crisis", "hypertensive_crisis"), "hypertensive_crisis"),
    (("hypertension", "vascular"), "hypertension"),
    (("sepsis", "critical"), "sepsis"),
    (("dementia", "alzheimer", "cognitive"), "dementia"),
    (("fever", "flu"), "fever"),
    (("malaria",), "malaria"),
    (("typhoid",), "typhoid"),
    (("dengue",), "dengue"),
    (("cold",), "cold"),
    (("gastro",), "gastro"),
    (("anemia",), "anemia"),
    (("thyroid",), "thyroid"),
    (("asthma",), "asthma"),
]


def resolve_recipe(name: str) -> str | None:
    """ordered substring match on the lower-cased name; ``None`` when nothing matches."""
    low = name.lower()
    for keys, recipe in DISPATCH:
        if any(k in low for k in keys):
            return recipe
    return None


def recipe_columns(df: DataFrame, disease: str) -> list[tuple[str, Column]]:
    key = resolve_recipe(disease)
    return [] if key is None else RECIPES[key](set(df.columns))


def engineer_features(df: DataFrame, disease: str) -> DataFrame:
    """Add the disease's domain features in one projection; an unknown name returns ``df`` unchanged."""
    new = recipe_columns(df, disease)
    return df.withColumns(dict(new)) if new else df
