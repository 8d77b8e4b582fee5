"""Patient panels projected from ``orders``.

The driver tables hold no clinical columns, so every disease panel (and the
two intake tables) is a deterministic projection of ``orders``: one select
list written once as SQL text. Spark runs it with ``selectExpr`` (a narrow
projection: no shuffle, scan pruned to the two key columns) and the DuckDB
oracle embeds the same text, so checks compare the operators, not the data.

Column values come from ``U(i, n) = (o_orderkey*P_i + o_custkey*Q_i) % n``
with a distinct prime pair per column. ``patient_id = o_orderkey``. The
first two feature columns of every panel carry nulls (one key in 17).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from .tables import dealt, table


@lru_cache(maxsize=1)
def _primes() -> list[int]:
    """Primes from 1009 upward; two per generated column."""
    limit = 40000
    sieve = bytearray([1]) * (limit + 1)
    sieve[0:2] = b"\x00\x00"
    for i in range(2, int(limit ** 0.5) + 1):
        if sieve[i]:
            sieve[i * i::i] = bytearray(len(sieve[i * i::i]))
    return [p for p in range(1009, limit + 1) if sieve[p]]


def u(i: int, n: int) -> str:
    p = _primes()
    return f"((o_orderkey * {p[2 * i]} + o_custkey * {p[2 * i + 1]}) % {n})"


def _lit(x: float) -> str:
    return f"{x!r}e0" if "e" not in repr(x) else repr(x)


def flag(rate):
    return ("flag", rate)


def num(lo, hi, step):
    return ("num", lo, hi, step)


def intr(lo, hi):
    return ("int", lo, hi)


def pick(*values):
    return ("pick", values)


def _expr(i: int, spec) -> str:
    kind = spec[0]
    if kind == "flag":
        return f"CAST({u(i, 101)} < {_lit(round(spec[1] * 101, 6))} AS INT)"
    if kind == "num":
        lo, hi, step = spec[1:]
        n = int(round((hi - lo) / step)) + 1
        return f"(CAST({lo!r} AS DOUBLE) + CAST({u(i, n)} AS DOUBLE) * CAST({step!r} AS DOUBLE))"
    if kind == "int":
        lo, hi = spec[1:]
        return f"CAST({lo} + {u(i, hi - lo + 1)} AS INT)"
    if kind == "pick":
        vals = spec[1]
        arms = " ".join(f"WHEN {k} THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in enumerate(vals))
        return f"(CASE {u(i, len(vals))} {arms} END)"
    raise ValueError(kind)


def _quote(name: str) -> str:
    return f"`{name}`" if " " in name else name


# --- fixed values: value domains of each panel (lo..hi / step, or flag rate), from the reference's
# generators, shipped CSV ranges and intake form limits.
PANELS: dict[str, list[tuple[str, tuple]]] = {
    "fever": [("BodyTemp", num(36.5, 41.2, 0.1)), ("Chills", flag(.65)), ("BodyAches", flag(.75)),
              ("FatigueLevel", intr(1, 3)), ("Headache", flag(.7)), ("Cough", flag(.55)),
              ("DurationDays", intr(1, 13))],
    "malaria": [("TempSpike", num(37.0, 41.5, 0.1)), ("ShiveringParoxysm", flag(.7)), ("SweatingStage", flag(.65)),
                ("PlateletCount", intr(20, 350)), ("Jaundice", flag(.25)), ("Splenomegaly", flag(.3))],
    "typhoid": [("StepladderFever", flag(.6)), ("FeverDuration", intr(3, 20)), ("AbdominalPain", flag(.65)),
                ("RelativeBradycardia", flag(.35)), ("RoseSpots", flag(.15)), ("WBC_Count", num(2.0, 14.0, 0.1))],
    "dengue": [("HighFever", num(37.5, 41.5, 0.1)), ("RetroOrbitalPain", flag(.7)), ("SevereJointPain", flag(.8)),
               ("PlateletCount", intr(10, 300)), ("PetechiaeRash", flag(.45)), ("Hematocrit", num(30.0, 60.0, 0.1))],
    "cold": [("Rhinorrhea", flag(.85)), ("SoreThroat", flag(.75)), ("Sneezing", flag(.8)),
             ("NasalCongestion", flag(.85)), ("MildFever", num(36.5, 38.5, 0.1))],
    "gastro": [("Nausea", flag(.8)), ("VomitingEpisodes", intr(0, 9)), ("DiarrheaEpisodes", intr(1, 14)),
               ("AbdominalCramps", flag(.75)), ("DehydrationScore", intr(0, 3))],
    "anemia": [("Hemoglobin", num(4.0, 17.0, 0.1)), ("RBC_Count", num(1.8, 6.2, 0.01)), ("Ferritin", intr(3, 250)),
               ("Fatigue", intr(1, 3)), ("Pallor", flag(.45))],
    "thyroid": [("TSH", num(0.01, 45.0, 0.01)), ("Free_T3", num(0.8, 7.5, 0.1)), ("Free_T4", num(0.3, 3.5, 0.1)),
                ("WeightChange", intr(-1, 1)), ("RestingHR", intr(45, 130))],
    "asthma": [("Wheezing", flag(.7)), ("PeakExpiratoryFlow", intr(30, 100)), ("NocturnalCough", flag(.6)),
               ("AllergenTrigger", flag(.65)), ("ExertionalDyspnea", flag(.7))],
    "hypertensive_crisis": [("SystolicBP", intr(120, 260)), ("DiastolicBP", intr(70, 160)), ("ChestPain", flag(.35)),
                            ("BlurredVision", flag(.4)), ("SevereHeadache", flag(.55)),
                            ("TargetOrganDamage", flag(.25))],
    "diabetes": [("HighBP", flag(.4)), ("HighChol", flag(.4)), ("CholCheck", flag(.4)), ("BMI", num(12.0, 60.0, 0.1)),
                 ("Smoker", flag(.4)), ("Stroke", flag(.4)), ("HeartDiseaseorAttack", flag(.4)),
                 ("PhysActivity", flag(.4)), ("Fruits", flag(.4)), ("Veggies", flag(.4)),
                 ("HvyAlcoholConsump", flag(.4)), ("AnyHealthcare", flag(.4)), ("NoDocbcCost", flag(.4)),
                 ("GenHlth", intr(1, 5)), ("MentHlth", intr(0, 30)), ("PhysHlth", intr(0, 30)),
                 ("DiffWalk", flag(.4)), ("Sex", flag(.4)), ("Age", intr(1, 13)), ("Education", intr(1, 6)),
                 ("Income", intr(1, 8))],
    "heart": [("Age", num(29.0, 77.0, 1.0)), ("Sex", num(0.0, 1.0, 1.0)), ("ChestPainType", num(1.0, 4.0, 1.0)),
              ("RestingBP", num(94.0, 200.0, 1.0)), ("Cholesterol", num(126.0, 564.0, 1.0)),
              ("FastingBS", num(0.0, 1.0, 1.0)), ("RestingECG", num(0.0, 2.0, 1.0)), ("MaxHR", num(71.0, 202.0, 1.0)),
              ("ExerciseAngina", num(0.0, 1.0, 1.0)), ("Oldpeak", num(0.0, 6.2, 0.1)),
              ("ST_Slope", num(1.0, 3.0, 1.0)), ("ca", num(0.0, 3.0, 1.0)), ("thal", num(3.0, 7.0, 2.0))],
    "kidney": [("Age", intr(1, 100)), ("BloodPressure", intr(80, 250)), ("SpecificGravity", num(1.005, 1.025, 0.005)),
               ("Albumin", flag(.3)), ("Sugar", flag(.25)), ("BloodGlucoseRandom", intr(60, 400)),
               ("BloodUrea", intr(10, 120)), ("SerumCreatinine", num(0.4, 15.0, 0.1)),
               ("Hemoglobin", num(4.0, 18.0, 0.1)), ("Hypertension", flag(.4)), ("DiabetesMellitus", flag(.3))],
    "liver": [("Age", intr(4, 90)), ("Gender", pick("Female", "Male")), ("TotalBilirubin", num(0.4, 75.0, 0.1)),
              ("DirectBilirubin", num(0.1, 19.7, 0.1)), ("AlkalinePhosphatase", intr(63, 2110)),
              ("AlamineAminotransferase", intr(10, 2000)), ("AspartateAminotransferase", intr(10, 4929)),
              ("TotalProteins", num(2.7, 9.6, 0.1)), ("Albumin", num(0.9, 5.5, 0.1)),
              ("AlbuminAndGlobulinRatio", num(0.3, 2.8, 0.1))],
    "stroke": [("Gender", flag(.5)), ("Age", intr(1, 100)), ("Hypertension", flag(.3)), ("HeartDisease", flag(.15)),
               ("EverMarried", flag(.65)), ("AvgGlucoseLevel", intr(60, 400)), ("BMI", num(12.0, 60.0, 0.1)),
               ("SmokingStatus", flag(.3))],
    "cancer": [("mean radius", num(6.9, 28.1, 0.1)), ("mean texture", num(9.7, 39.3, 0.1)),
               ("mean perimeter", num(43.7, 188.5, 0.1)), ("mean area", num(143.0, 2501.0, 1.0)),
               ("mean smoothness", num(0.052, 0.163, 0.001)), ("mean compactness", num(0.019, 0.345, 0.001)),
               ("mean concavity", num(0.0, 0.427, 0.001)), ("mean concave points", num(0.0, 0.201, 0.001)),
               ("mean symmetry", num(0.106, 0.304, 0.001)), ("mean fractal dimension", num(0.05, 0.097, 0.001))],
    "pneumonia": [("Age", intr(1, 100)), ("SpO2", num(70.0, 100.0, 1.0)), ("RespiratoryRate", intr(12, 40)),
                  ("FeverTemp", num(35.0, 42.0, 0.1)), ("WBC_Count", num(1.0, 45.0, 0.5)),
                  ("DyspneaSeverity", flag(.35)), ("CoughType", flag(.5)), ("ChestPain", flag(.3)),
                  ("Smoker", flag(.3))],
    "hypertension": [("Age", intr(1, 100)), ("SystolicBP", intr(80, 250)), ("DiastolicBP", intr(50, 150)),
                     ("BMI", num(12.0, 60.0, 0.1)), ("SodiumIntake", intr(1, 3)), ("PhysicalInactivity", flag(.4)),
                     ("FamilyHistory", flag(.5)), ("AlcoholUse", flag(.3)), ("StressLevel", intr(1, 5))],
    "sepsis": [("HeartRate", intr(40, 200)), ("SysBP", intr(80, 250)), ("RespRate", intr(12, 40)),
               ("BodyTemp", num(35.0, 42.0, 0.1)), ("WBC_Count", num(1.0, 45.0, 0.5)), ("Lactate", num(0.5, 18.0, 0.1)),
               ("Platelets", intr(10, 600)), ("Bilirubin", num(0.3, 25.0, 0.1)), ("Creatinine", num(0.4, 15.0, 0.1))],
    "dementia": [("Age", intr(1, 100)), ("MMSE_Score", intr(8, 30)), ("CDR_Scale", num(0.0, 3.0, 0.5)),
                 ("FunctionalAssessment", intr(0, 10)), ("MemoryLossScore", flag(.4)),
                 ("BehavioralProblems", flag(.25)), ("EducationYears", intr(0, 20)), ("APOE4_Allele", flag(.25))],
    # Pima-shaped diabetes table for the exploratory analysis and the enlarger.
    "pima": [("Pregnancies", intr(0, 17)), ("Glucose", intr(0, 199)), ("BloodPressure", intr(0, 122)),
             ("SkinThickness", intr(0, 99)), ("Insulin", intr(0, 846)), ("BMI", num(0.0, 67.1, 0.1)),
             ("DiabetesPedigreeFunction", num(0.078, 2.42, 0.001)), ("Age", intr(21, 81))],
}

# Share of sentinel zeros written into the Pima columns where 0 means "missing".
PIMA_ZERO_RATE = {"Glucose": 0.01, "BloodPressure": 0.05, "SkinThickness": 0.3, "Insulin": 0.49, "BMI": 0.015}

# --- fixed values: the logistic risk rules (logit) of the ten rule-scored panels, as SQL text.
RULE_LOGIT_SQL = {
    "fever": "-3.0e0 + 1.2e0 * CAST(BodyTemp > 38.3e0 AS INT) + 0.8e0 * Chills + 0.6e0 * BodyAches + 0.5e0 * Headache",
    "malaria": ("-2.5e0 + 1.1e0 * CAST(TempSpike > 38.8e0 AS INT) + 1.0e0 * ShiveringParoxysm"
                " + 0.9e0 * CAST(PlateletCount < 100 AS INT) + 0.8e0 * Jaundice"),
    "typhoid": ("-3.2e0 + 1.3e0 * StepladderFever + 0.1e0 * FeverDuration + 0.7e0 * AbdominalPain"
                " + 0.8e0 * RelativeBradycardia"),
    "dengue": ("-3.0e0 + 1.0e0 * RetroOrbitalPain + 0.8e0 * SevereJointPain + 1.2e0 * CAST(PlateletCount < 100 AS INT)"
               " + 0.6e0 * PetechiaeRash"),
    "cold": "-2.0e0 + 0.8e0 * Rhinorrhea + 0.7e0 * SoreThroat + 0.7e0 * Sneezing + 0.6e0 * NasalCongestion",
    "gastro": ("-2.5e0 + 0.3e0 * VomitingEpisodes + 0.2e0 * DiarrheaEpisodes + 0.7e0 * AbdominalCramps"
               " + 0.8e0 * DehydrationScore"),
    "anemia": "-1.5e0 - 0.6e0 * (Hemoglobin - 12) - 0.03e0 * (Ferritin - 30) + 0.6e0 * Pallor",
    "thyroid": ("-2.0e0 + 0.2e0 * CAST(TSH > 4.5e0 AS INT) + 0.3e0 * CAST(TSH < 0.4e0 AS INT)"
                " + 0.5e0 * CAST(WeightChange <> 0 AS INT)"),
    "asthma": "-3.0e0 + 1.2e0 * Wheezing - 0.05e0 * (PeakExpiratoryFlow - 80) + 0.7e0 * NocturnalCough",
    "hypertensive_crisis": ("-5.0e0 + 0.08e0 * (SystolicBP - 140) + 0.09e0 * (DiastolicBP - 90)"
                            " + 1.5e0 * TargetOrganDamage + 0.8e0 * SevereHeadache"),
}

# Label rule of the panels without a logistic rule: a threshold on a domain ratio, 15% of labels flipped.
LABEL_SQL = {
    "diabetes": "HighBP + HighChol + CAST(BMI > 30 AS INT) >= 2",
    "heart": "Cholesterol / (RestingBP + 1e-5) > 2.0e0",
    "kidney": "SerumCreatinine > 3.0e0",
    "liver": "AspartateAminotransferase / (AlamineAminotransferase + 1e-5) > 1.0e0",
    "stroke": "(AvgGlucoseLevel / 100.0e0) * (BMI / 25.0e0) > 3.0e0",
    "cancer": "`mean radius` * `mean texture` > 350.0e0",
    "pneumonia": "(100.0e0 - SpO2) * (RespiratoryRate / 20.0e0) > 15.0e0",
    "hypertension": "SystolicBP - DiastolicBP > 60",
    "sepsis": "HeartRate / (SysBP + 1e-5) > 1.0e0",
    "dementia": "(30 - MMSE_Score) * (1 + 2 * CDR_Scale) > 20.0e0",
    "pima": "Glucose > 140",
}

_BASE = {name: 40 * k for k, name in enumerate(PANELS)}


def panel_columns(disease: str) -> list[str]:
    return [c for c, _ in PANELS[disease]]


def _feature_exprs(disease: str) -> list[str]:
    base = _BASE[disease]
    out = []
    for j, (col, spec) in enumerate(PANELS[disease]):
        e = _expr(base + j, spec)
        if disease == "pima" and col in PIMA_ZERO_RATE:
            zero = f"{u(base + 30 + j, 1000)} < {int(PIMA_ZERO_RATE[col] * 1000)}"
            e = f"(CASE WHEN {zero} THEN 0 ELSE {e} END)"
        if j < 2:
            e = f"(CASE WHEN o_orderkey % 17 = {(base + j) % 17} THEN NULL ELSE {e} END)"
        out.append((col, e))
    return out


def panel_inner_sql(disease: str) -> str:
    """Inner select list (patient_id + features) over ``orders``."""
    cols = ",\n  ".join(f"{e} AS {_quote(c)}" for c, e in _feature_exprs(disease))
    return f"SELECT o_orderkey AS patient_id,\n  {cols},\n  {u(98, 101)} AS _u98,\n  {u(99, 101)} AS _u99\nFROM orders"


def outcome_sql(disease: str) -> str:
    if disease in RULE_LOGIT_SQL:
        score = f"1.0e0 / (1.0e0 + exp(-({RULE_LOGIT_SQL[disease]})))"
        return f"CAST(COALESCE({score} * 101 > _u99, FALSE) AS INT)"
    return f"CAST(COALESCE({LABEL_SQL[disease]}, FALSE) <> (_u98 < 15) AS INT)"


def panel_sql(disease: str, dialect: str = "spark") -> str:
    """Full panel (patient_id, features..., Outcome) as one SQL query over ``orders``.

    ``dialect="duckdb"`` only swaps identifier quoting (backticks → double quotes).
    """
    feats = ", ".join(_quote(c) for c in panel_columns(disease))
    sql = (f"SELECT patient_id, {feats}, {outcome_sql(disease)} AS Outcome\n"
           f"FROM (\n{panel_inner_sql(disease)}\n) AS p")
    return sql.replace("`", '"') if dialect == "duckdb" else sql


def panel_projection(orders: DataFrame, disease: str, keep) -> DataFrame:
    """``keep`` and the panel's feature columns (with the two draws that its outcome uses) of every order."""
    return orders.selectExpr(*keep, *[f"{e} AS {_quote(c)}" for c, e in _feature_exprs(disease)],
                             f"{u(98, 101)} AS _u98", f"{u(99, 101)} AS _u99")


def _orders(spark: SparkSession, sf_dir: str, deal: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return dealt(orders.select("o_orderkey", "o_custkey")) if deal else orders


def load_panel(spark: SparkSession, sf_dir: str, disease: str, deal: bool = False) -> DataFrame:
    """Panel as a DataFrame: two narrow projections over the ``orders`` scan (``deal``: its rows dealt over all cores)."""
    inner = panel_projection(_orders(spark, sf_dir, deal), disease, ["o_orderkey AS patient_id"])
    return inner.selectExpr("patient_id", *[_quote(c) for c in panel_columns(disease)],
                            f"{outcome_sql(disease)} AS Outcome")


# --- intake tables --------------------------------------------------------------------------------

# --- fixed values: the nine chief-complaint options of the interview form, in form order.
COMPLAINTS = [
    "🤒 Fever / High Body Temperature",
    "🥶 Cold Chills & Shivering Paroxysms",
    "🤕 Headaches / Dizziness / Memory Issues",
    "🗣️ Sore Throat, Nasal Congestion & Cold",
    "😮‍💨 Cough, Shortness of Breath & Wheezing",
    "🤢 Nausea, Vomiting, Diarrhea & Stomach Cramps",
    "🫀 Chest Pain / Pressure / Palpitations",
    "🦴 Severe Joint Pain / Body Aches",
    "🩸 Unexplained Fatigue, Pallor or Low Platelet Symptoms",
]
# --- fixed values: the four duration options of the interview form.
DURATIONS = ["Less than 24 hours", "1 - 3 Days", "4 - 7 Days", "More than 1 week"]
ANSWERS = ["Yes", "No", "Unsure"]
# Free-text notes (ours): blank, or mentioning the keywords the interview looks for.
NOTES = ["", "My skin and eyes look Yellow", "I found a small lump", "",
         "Short of breath at night", "some dizziness and memory lapses", "", "vomit after meals"]

INTAKE_A = [("age", intr(1, 100)), ("sex", pick("Female", "Male")), ("rf_hbp", flag(.3)),
            ("rf_hchol", flag(.3)), ("rf_diab", flag(.2)), ("rf_smoker", flag(.25)), ("rf_heart", flag(.15)),
            ("chief_complaint", pick(*COMPLAINTS)), ("duration", pick(*DURATIONS)), ("notes", pick(*NOTES)),
            ("q1", pick(*ANSWERS)), ("q2", pick(*ANSWERS)), ("q3", pick(*ANSWERS)), ("q4", pick(*ANSWERS)),
            ("q5", pick(*ANSWERS))]

INTAKE_B = [("body_temp", num(35.0, 42.0, 0.1)), ("chills", flag(.4)), ("body_aches", flag(.4)),
            ("sore_throat", flag(.4)), ("nausea_vomit", flag(.4)), ("age", intr(1, 100)), ("sex", flag(.5)),
            ("systolic_bp", intr(80, 250)), ("diastolic_bp", intr(50, 150)), ("heart_rate", intr(40, 200)),
            ("glucose", intr(60, 400)), ("cholesterol", intr(100, 500)), ("hemoglobin", num(4.0, 18.0, 0.1)),
            ("platelets", intr(10, 600)), ("wbc", num(1.0, 45.0, 0.5)), ("creatinine", num(0.4, 15.0, 0.1)),
            ("bilirubin", num(0.3, 25.0, 0.1)), ("spo2", intr(70, 100)), ("lactate", num(0.5, 18.0, 0.1)),
            ("mmse", intr(8, 30))]

_INTAKE_BASE = {"a": 900, "b": 950}


def _intake_exprs(kind: str) -> list[tuple[str, str]]:
    spec = INTAKE_A if kind == "a" else INTAKE_B
    base = _INTAKE_BASE[kind]
    return [(c, _expr(base + j, s)) for j, (c, s) in enumerate(spec)]


def intake_sql(kind: str) -> str:
    cols = ",\n  ".join(f"{e} AS {c}" for c, e in _intake_exprs(kind))
    return f"SELECT o_orderkey AS patient_id,\n  {cols}\nFROM orders"


def load_intake(spark: SparkSession, sf_dir: str, kind: str, deal: bool = False) -> DataFrame:
    """Intake table ``a`` (interview answers) or ``b`` (vitals and labs), one row per patient (``deal``: as for panels)."""
    return _orders(spark, sf_dir, deal).selectExpr(
        "o_orderkey AS patient_id", *[f"{e} AS {c}" for c, e in _intake_exprs(kind)])
