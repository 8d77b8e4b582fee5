"""Intake-to-panel projections (I1-I20) for the two intake tables.

Intake A is an interview (age, sex, five history flags, chief complaint, free
notes, five Yes/No/Unsure answers); intake B is a vitals-and-labs panel.
Each disease's projection is one ``select`` of column expressions over the
intake row, so a whole intake table turns into 20 panel frames without a
shuffle. Interview flags are computed once (``interview_flags``) and shared by
all 20 projections.

A projection is described by a small table of cells:

* ``("k", v)``            constant
* ``("if", flag, a, b)``  ``a`` when ``flag`` else ``b`` (F12)
* ``("col", c)``          copy of an intake column
* ``("cmp", c, op, v)``   0/1 comparison of an intake column (null → 0)
* ``("and", f1, f2, a, b)`` ``a`` when both flags else ``b``
* ``("round", c, f)``     ``round(c * f, 1)`` half-to-even (F13)
* ``("gender", c)``       0/1 sex code → "Female"/"Male" (liver panel trains on the string)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import answer_yes, cdc_age_code, col, flag_of, keyword_flag, lower_concat, round_tenth_of

# --- fixed values: interview keywords behind each symptom flag (substring match on the lower-cased text).
FLAG_KEYWORDS = {
    "has_fever": (("fever",), "q1"),
    "has_chills": (("chills",), "q1"),
    "has_joint_eye": (("joint",), "q2"),
    "has_gastro": (("nausea", "vomit"), "q3"),
    "has_resp": (("breath", "cough"), "q4"),
    "has_neuro": (("dizziness", "memory"), "q5"),
}


def interview_flags(df: DataFrame) -> DataFrame:
    """Derive the interview flags once (common sub-expression for all 20 projections)."""
    text = lower_concat("chief_complaint", "notes")
    cols = {"full_text": text}
    t = F.col("full_text")
    flags = {}
    for name, (kws, q) in FLAG_KEYWORDS.items():
        flags[name] = keyword_flag(t, kws, answer_yes(q))
    flags["has_chest"] = keyword_flag(t, ["chest pain"], F.col("rf_heart") == F.lit(1))
    flags["has_yellow"] = keyword_flag(t, ["yellow"])
    flags["has_lump"] = keyword_flag(t, ["lump"])
    flags["rf_hbp_f"] = F.coalesce(F.col("rf_hbp") == F.lit(1), F.lit(False))
    flags["rf_hchol_f"] = F.coalesce(F.col("rf_hchol") == F.lit(1), F.lit(False))
    flags["rf_diab_f"] = F.coalesce(F.col("rf_diab") == F.lit(1), F.lit(False))
    flags["rf_smoker_f"] = F.coalesce(F.col("rf_smoker") == F.lit(1), F.lit(False))
    flags["rf_heart_f"] = F.coalesce(F.col("rf_heart") == F.lit(1), F.lit(False))
    derived = {"sex_val": F.when(F.col("sex") == F.lit("Male"), F.lit(1)).otherwise(F.lit(0)),
               "cdc_age": cdc_age_code("age")}
    return df.withColumns(cols).withColumns(flags).withColumns(derived)


def K(v):
    return ("k", v)


def IF(f, a, b):
    return ("if", f, a, b)


def C(c):
    return ("col", c)


def CMP(c, op, v):
    return ("cmp", c, op, v)


def B01(f):
    return ("if", f, 1, 0)


# --- fixed values: interview (A) projections, per disease, in panel column order.
INTAKE_A = {
    "fever": [("BodyTemp", IF("has_fever", 39.2, 37.0)), ("Chills", B01("has_chills")),
              ("BodyAches", B01("has_joint_eye")), ("FatigueLevel", IF("has_fever", 3, 1)),
              ("Headache", B01("has_fever")), ("Cough", B01("has_resp")), ("DurationDays", K(3))],
    "malaria": [("TempSpike", IF("has_fever", 39.5, 37.0)), ("ShiveringParoxysm", B01("has_chills")),
                ("SweatingStage", B01("has_chills")), ("PlateletCount", IF("has_chills", 70, 220)),
                ("Jaundice", B01("has_yellow")), ("Splenomegaly", K(0))],
    "typhoid": [("StepladderFever", B01("has_fever")), ("FeverDuration", K(6)), ("AbdominalPain", B01("has_gastro")),
                ("RelativeBradycardia", B01("has_fever")), ("RoseSpots", K(0)), ("WBC_Count", K(11.5))],
    "dengue": [("HighFever", IF("has_fever", 39.6, 37.0)), ("RetroOrbitalPain", B01("has_joint_eye")),
               ("SevereJointPain", B01("has_joint_eye")), ("PlateletCount", IF("has_joint_eye", 60, 180)),
               ("PetechiaeRash", B01("has_joint_eye")), ("Hematocrit", K(46.0))],
    "cold": [("Rhinorrhea", B01("has_resp")), ("SoreThroat", B01("has_resp")), ("Sneezing", B01("has_resp")),
             ("NasalCongestion", B01("has_resp")), ("MildFever", IF("has_fever", 37.8, 36.8))],
    "gastro": [("Nausea", B01("has_gastro")), ("VomitingEpisodes", IF("has_gastro", 3, 0)),
               ("DiarrheaEpisodes", IF("has_gastro", 4, 0)), ("AbdominalCramps", B01("has_gastro")),
               ("DehydrationScore", IF("has_gastro", 2, 0))],
    "anemia": [("Hemoglobin", IF("has_neuro", 9.0, 13.5)), ("RBC_Count", IF("has_neuro", 3.4, 4.5)),
               ("Ferritin", IF("has_neuro", 15, 80)), ("Fatigue", IF("has_neuro", 3, 1)), ("Pallor", B01("has_neuro"))],
    "thyroid": [("TSH", IF("has_neuro", 6.8, 2.1)), ("Free_T3", K(2.1)), ("Free_T4", K(0.8)), ("WeightChange", K(1)),
                ("RestingHR", K(72))],
    "diabetes": [("HighBP", B01("rf_hbp_f")), ("HighChol", B01("rf_hchol_f")), ("CholCheck", K(1)), ("BMI", K(29.0)),
                 ("Smoker", B01("rf_smoker_f")), ("Stroke", K(0)), ("HeartDiseaseorAttack", B01("rf_heart_f")),
                 ("PhysActivity", K(1)), ("Fruits", K(1)), ("Veggies", K(1)), ("HvyAlcoholConsump", K(0)),
                 ("AnyHealthcare", K(1)), ("NoDocbcCost", K(0)), ("GenHlth", K(3)), ("MentHlth", K(2)),
                 ("PhysHlth", K(2)), ("DiffWalk", K(0)), ("Sex", C("sex_val")), ("Age", C("cdc_age")),
                 ("Education", K(5)), ("Income", K(7))],
    "hypertension": [("Age", C("age")), ("SystolicBP", IF("rf_hbp_f", 160, 125)),
                     ("DiastolicBP", IF("rf_hbp_f", 95, 82)), ("BMI", K(28.5)), ("SodiumIntake", K(2)),
                     ("PhysicalInactivity", K(0)), ("FamilyHistory", K(1)), ("AlcoholUse", K(0)),
                     ("StressLevel", K(3))],
    "dementia": [("Age", C("age")), ("MMSE_Score", IF("has_neuro", 18, 29)), ("CDR_Scale", IF("has_neuro", 1.0, 0.0)),
                 ("FunctionalAssessment", IF("has_neuro", 6, 10)), ("MemoryLossScore", B01("has_neuro")),
                 ("BehavioralProblems", K(0)), ("EducationYears", K(14)), ("APOE4_Allele", K(0))],
    "heart": [("Age", C("age")), ("Sex", C("sex_val")), ("ChestPainType", IF("has_chest", 3, 0)),
              ("RestingBP", IF("rf_hbp_f", 145, 120)), ("Cholesterol", IF("rf_hchol_f", 240, 190)),
              ("FastingBS", B01("rf_diab_f")), ("RestingECG", B01("has_chest")), ("MaxHR", K(145)),
              ("ExerciseAngina", B01("has_chest")), ("Oldpeak", IF("has_chest", 1.5, 0.0)), ("ST_Slope", K(2)),
              ("ca", K(0)), ("thal", K(2))],
    "kidney": [("Age", C("age")), ("BloodPressure", IF("rf_hbp_f", 140, 120)), ("SpecificGravity", K(1.015)),
               ("Albumin", IF("rf_hbp_f", 2, 0)), ("Sugar", B01("rf_diab_f")),
               ("BloodGlucoseRandom", IF("rf_diab_f", 180, 100)), ("BloodUrea", IF("rf_hbp_f", 55, 30)),
               ("SerumCreatinine", IF("rf_hbp_f", 2.2, 0.9)), ("Hemoglobin", IF("has_neuro", 10.5, 13.0)),
               ("Hypertension", B01("rf_hbp_f")), ("DiabetesMellitus", B01("rf_diab_f"))],
    "liver": [("Age", C("age")), ("Gender", ("gender", "sex_val")), ("TotalBilirubin", IF("has_yellow", 2.8, 0.9)),
              ("DirectBilirubin", K(1.0)), ("AlkalinePhosphatase", K(230)), ("AlamineAminotransferase", K(65)),
              ("AspartateAminotransferase", K(75)), ("TotalProteins", K(6.5)), ("Albumin", K(3.2)),
              ("AlbuminAndGlobulinRatio", K(0.9))],
    "pneumonia": [("Age", C("age")), ("SpO2", IF("has_resp", 91.0, 98.0)), ("RespiratoryRate", IF("has_resp", 26, 18)),
                  ("FeverTemp", IF("has_fever", 38.8, 37.0)), ("WBC_Count", IF("has_fever", 15.5, 7.5)),
                  ("DyspneaSeverity", B01("has_resp")), ("CoughType", B01("has_resp")), ("ChestPain", B01("has_chest")),
                  ("Smoker", B01("rf_smoker_f"))],
    "asthma": [("Wheezing", B01("has_resp")), ("PeakExpiratoryFlow", IF("has_resp", 65, 95)),
               ("NocturnalCough", B01("has_resp")), ("AllergenTrigger", K(1)), ("ExertionalDyspnea", B01("has_resp"))],
    "cancer": [("mean radius", IF("has_lump", 16.2, 14.0)), ("mean texture", K(21.0)), ("mean perimeter", K(105.0)),
               ("mean area", K(800.0)), ("mean smoothness", K(0.11)), ("mean compactness", K(0.14)),
               ("mean concavity", K(0.12)), ("mean concave points", K(0.08)), ("mean symmetry", K(0.20)),
               ("mean fractal dimension", K(0.065))],
    "stroke": [("Gender", C("sex_val")), ("Age", C("age")), ("Hypertension", B01("rf_hbp_f")),
               ("HeartDisease", B01("rf_heart_f")), ("EverMarried", K(1)), ("AvgGlucoseLevel", IF("rf_diab_f", 200, 100)),
               ("BMI", K(29.0)), ("SmokingStatus", B01("rf_smoker_f"))],
    "sepsis": [("HeartRate", ("and", "has_fever", "has_chills", 115, 75)),
               ("SysBP", ("and", "has_fever", "has_chills", 88, 120)),
               ("RespRate", ("and", "has_fever", "has_chills", 26, 18)), ("BodyTemp", IF("has_fever", 39.2, 37.0)),
               ("WBC_Count", IF("has_fever", 17.5, 7.0)), ("Lactate", ("and", "has_fever", "has_chills", 4.2, 1.1)),
               ("Platelets", IF("has_chills", 80, 220)), ("Bilirubin", K(1.8)), ("Creatinine", K(1.8))],
    "hypertensive_crisis": [("SystolicBP", ("and", "rf_hbp_f", "has_chest", 190, 125)),
                            ("DiastolicBP", ("and", "rf_hbp_f", "has_chest", 115, 82)),
                            ("ChestPain", B01("has_chest")), ("BlurredVision", B01("has_neuro")),
                            ("SevereHeadache", B01("has_fever")), ("TargetOrganDamage", B01("has_chest"))],
}

# --- fixed values: vitals-and-labs (B) projections, per disease, in panel column order.
INTAKE_B = {
    "fever": [("BodyTemp", C("body_temp")), ("Chills", C("chills")), ("BodyAches", C("body_aches")),
              ("FatigueLevel", K(2)), ("Headache", K(1)), ("Cough", C("sore_throat")), ("DurationDays", K(3))],
    "malaria": [("TempSpike", C("body_temp")), ("ShiveringParoxysm", C("chills")), ("SweatingStage", C("chills")),
                ("PlateletCount", C("platelets")), ("Jaundice", CMP("bilirubin", ">", 2.0)), ("Splenomegaly", K(0))],
    "typhoid": [("StepladderFever", CMP("body_temp", ">", 38.5)), ("FeverDuration", K(6)),
                ("AbdominalPain", C("nausea_vomit")),
                ("RelativeBradycardia", ("both", CMP("heart_rate", "<", 80), CMP("body_temp", ">", 38.5))),
                ("RoseSpots", K(0)), ("WBC_Count", C("wbc"))],
    "dengue": [("HighFever", C("body_temp")), ("RetroOrbitalPain", K(1)), ("SevereJointPain", C("body_aches")),
               ("PlateletCount", C("platelets")), ("PetechiaeRash", K(0)), ("Hematocrit", K(44.0))],
    "cold": [("Rhinorrhea", C("sore_throat")), ("SoreThroat", C("sore_throat")), ("Sneezing", C("sore_throat")),
             ("NasalCongestion", C("sore_throat")), ("MildFever", C("body_temp"))],
    "gastro": [("Nausea", C("nausea_vomit")), ("VomitingEpisodes", ("ifcol", "nausea_vomit", 3, 0)),
               ("DiarrheaEpisodes", ("ifcol", "nausea_vomit", 4, 0)), ("AbdominalCramps", C("nausea_vomit")),
               ("DehydrationScore", K(1))],
    "anemia": [("Hemoglobin", C("hemoglobin")), ("RBC_Count", K(3.9)), ("Ferritin", K(25)), ("Fatigue", K(2)),
               ("Pallor", CMP("hemoglobin", "<", 11.0))],
    "thyroid": [("TSH", K(4.5)), ("Free_T3", K(3.0)), ("Free_T4", K(1.1)), ("WeightChange", K(1)),
                ("RestingHR", C("heart_rate"))],
    "diabetes": [("HighBP", CMP("systolic_bp", ">", 130)), ("HighChol", CMP("cholesterol", ">", 200)),
                 ("CholCheck", K(1)), ("BMI", K(28.0)), ("Smoker", K(0)), ("Stroke", K(0)),
                 ("HeartDiseaseorAttack", K(0)), ("PhysActivity", K(1)), ("Fruits", K(1)), ("Veggies", K(1)),
                 ("HvyAlcoholConsump", K(0)), ("AnyHealthcare", K(1)), ("NoDocbcCost", K(0)), ("GenHlth", K(3)),
                 ("MentHlth", K(2)), ("PhysHlth", K(2)), ("DiffWalk", K(0)), ("Sex", C("sex")), ("Age", ("cdc", "age")),
                 ("Education", K(5)), ("Income", K(7))],
    "hypertension": [("Age", C("age")), ("SystolicBP", C("systolic_bp")), ("DiastolicBP", C("diastolic_bp")),
                     ("BMI", K(28.0)), ("SodiumIntake", K(2)), ("PhysicalInactivity", K(0)), ("FamilyHistory", K(1)),
                     ("AlcoholUse", K(0)), ("StressLevel", K(3))],
    "dementia": [("Age", C("age")), ("MMSE_Score", C("mmse")), ("CDR_Scale", ("cmpv", "mmse", "<", 25, 0.5, 0.0)),
                 ("FunctionalAssessment", K(8)), ("MemoryLossScore", CMP("mmse", "<", 26)),
                 ("BehavioralProblems", K(0)), ("EducationYears", K(14)), ("APOE4_Allele", K(0))],
    "heart": [("Age", C("age")), ("Sex", C("sex")), ("ChestPainType", K(3)), ("RestingBP", C("systolic_bp")),
              ("Cholesterol", C("cholesterol")), ("FastingBS", CMP("glucose", ">", 120)), ("RestingECG", K(1)),
              ("MaxHR", C("heart_rate")), ("ExerciseAngina", K(0)), ("Oldpeak", K(1.0)), ("ST_Slope", K(2)),
              ("ca", K(0)), ("thal", K(2))],
    "kidney": [("Age", C("age")), ("BloodPressure", C("systolic_bp")), ("SpecificGravity", K(1.020)),
               ("Albumin", CMP("creatinine", ">", 1.3)), ("Sugar", CMP("glucose", ">", 140)),
               ("BloodGlucoseRandom", C("glucose")), ("BloodUrea", K(42)), ("SerumCreatinine", C("creatinine")),
               ("Hemoglobin", C("hemoglobin")), ("Hypertension", CMP("systolic_bp", ">", 130)),
               ("DiabetesMellitus", CMP("glucose", ">", 140))],
    "liver": [("Age", C("age")), ("Gender", ("gender", "sex")), ("TotalBilirubin", C("bilirubin")),
              ("DirectBilirubin", ("round", "bilirubin", 0.3)), ("AlkalinePhosphatase", K(210)),
              ("AlamineAminotransferase", K(38)), ("AspartateAminotransferase", K(45)), ("TotalProteins", K(6.8)),
              ("Albumin", K(3.4)), ("AlbuminAndGlobulinRatio", K(1.0))],
    "pneumonia": [("Age", C("age")), ("SpO2", C("spo2")), ("RespiratoryRate", K(20)), ("FeverTemp", C("body_temp")),
                  ("WBC_Count", C("wbc")), ("DyspneaSeverity", CMP("spo2", "<", 95)), ("CoughType", K(1)),
                  ("ChestPain", K(0)), ("Smoker", K(0))],
    "asthma": [("Wheezing", CMP("spo2", "<", 95)), ("PeakExpiratoryFlow", K(75)), ("NocturnalCough", K(1)),
               ("AllergenTrigger", K(1)), ("ExertionalDyspnea", K(1))],
    "cancer": [("mean radius", K(14.2)), ("mean texture", K(19.5)), ("mean perimeter", K(92.0)),
               ("mean area", K(650.0)), ("mean smoothness", K(0.095)), ("mean compactness", K(0.105)),
               ("mean concavity", K(0.088)), ("mean concave points", K(0.048)), ("mean symmetry", K(0.180)),
               ("mean fractal dimension", K(0.062))],
    "stroke": [("Gender", C("sex")), ("Age", C("age")), ("Hypertension", CMP("systolic_bp", ">", 130)),
               ("HeartDisease", K(0)), ("EverMarried", K(1)), ("AvgGlucoseLevel", C("glucose")), ("BMI", K(28.0)),
               ("SmokingStatus", K(0))],
    "sepsis": [("HeartRate", C("heart_rate")), ("SysBP", C("systolic_bp")), ("RespRate", K(20)),
               ("BodyTemp", C("body_temp")), ("WBC_Count", C("wbc")), ("Lactate", C("lactate")),
               ("Platelets", C("platelets")), ("Bilirubin", C("bilirubin")), ("Creatinine", C("creatinine"))],
    "hypertensive_crisis": [("SystolicBP", C("systolic_bp")), ("DiastolicBP", C("diastolic_bp")), ("ChestPain", K(0)),
                            ("BlurredVision", K(0)), ("SevereHeadache", CMP("systolic_bp", ">", 160)),
                            ("TargetOrganDamage", K(0))],
}

_OPS = {">": lambda a, b: a > b, "<": lambda a, b: a < b}


def _cmp(c, op, v) -> Column:
    return _OPS[op](col(c), F.lit(v))


def cell_column(cell, prefix: str = "") -> Column:
    """Column for one projection cell; ``prefix`` is prepended to every intake column it reads."""
    if prefix:
        cell = _prefixed(cell, prefix)
    kind = cell[0]
    if kind == "k":
        return F.lit(cell[1])
    if kind == "if":
        return F.when(F.col(cell[1]), F.lit(cell[2])).otherwise(F.lit(cell[3]))
    if kind == "and":
        return F.when(F.col(cell[1]) & F.col(cell[2]), F.lit(cell[3])).otherwise(F.lit(cell[4]))
    if kind == "col":
        return F.col(cell[1])
    if kind == "cmp":
        return flag_of(_cmp(cell[1], cell[2], cell[3]))
    if kind == "both":
        a, b = cell[1], cell[2]
        return flag_of(_cmp(*a[1:]) & _cmp(*b[1:]))
    if kind == "cmpv":
        _, c, op, v, a, b = cell
        return F.when(F.coalesce(_cmp(c, op, v), F.lit(False)), F.lit(a)).otherwise(F.lit(b))
    if kind == "ifcol":
        _, c, a, b = cell
        return F.when(F.coalesce(F.col(c) == F.lit(1), F.lit(False)), F.lit(a)).otherwise(F.lit(b))
    if kind == "round":
        return round_tenth_of(cell[1], cell[2])
    if kind == "gender":
        return F.when(F.col(cell[1]) == F.lit(1), F.lit("Male")).otherwise(F.lit("Female"))
    if kind == "cdc":
        return cdc_age_code(cell[1])
    raise ValueError(kind)


def _prefixed(cell, prefix):
    kind = cell[0]
    if kind == "k":
        return cell
    if kind == "if":
        return ("if", prefix + cell[1], cell[2], cell[3])
    if kind == "and":
        return ("and", prefix + cell[1], prefix + cell[2], cell[3], cell[4])
    if kind in ("col", "gender", "cdc"):
        return (kind, prefix + cell[1])
    if kind == "cmp":
        return ("cmp", prefix + cell[1], cell[2], cell[3])
    if kind == "both":
        return ("both", _prefixed(cell[1], prefix), _prefixed(cell[2], prefix))
    if kind == "cmpv":
        return ("cmpv", prefix + cell[1], *cell[2:])
    if kind == "ifcol":
        return ("ifcol", prefix + cell[1], cell[2], cell[3])
    if kind == "round":
        return ("round", prefix + cell[1], cell[2])
    raise ValueError(kind)


def projection(kind: str, disease: str, prefix: str = "") -> list[tuple[str, Column]]:
    spec = (INTAKE_A if kind == "a" else INTAKE_B)[disease]
    return [(name, cell_column(cell, prefix)) for name, cell in spec]


def intake_to_panel(intake: DataFrame, kind: str, disease: str, keep=("patient_id",)) -> DataFrame:
    """One projection: intake rows → the disease's panel columns (A needs ``interview_flags`` first)."""
    if kind == "a" and "has_fever" not in intake.columns:
        intake = interview_flags(intake)
    return intake.select(*[F.col(k) for k in keep], *[c.alias(n) for n, c in projection(kind, disease)])
