"""Feature recipes: the reference's CDC fixture with every cell worked out, one-row fixtures, edges."""

import pytest
from pyspark.sql import Row

from riskloom.functions.recipes import engineer_features, resolve_recipe

CDC_COLS = ["HighBP", "HighChol", "CholCheck", "BMI", "Smoker", "Stroke", "HeartDiseaseorAttack", "PhysActivity",
            "Fruits", "Veggies", "HvyAlcoholConsump", "AnyHealthcare", "NoDocbcCost", "GenHlth", "MentHlth",
            "PhysHlth", "DiffWalk", "Sex", "Age", "Education", "Income", "Outcome"]
CDC_ROWS = [
    [1, 1, 1, 28.5, 1, 0, 0, 0, 1, 1, 0, 1, 0, 3, 0, 5, 0, 1, 9, 5, 7, 1],
    [0, 0, 1, 22.0, 0, 0, 0, 1, 1, 1, 0, 1, 0, 1, 0, 0, 0, 0, 3, 6, 8, 0],
    [1, 0, 1, 34.1, 1, 0, 1, 0, 0, 1, 0, 1, 0, 4, 10, 15, 1, 1, 11, 4, 5, 1],
    [0, 1, 1, 19.8, 0, 0, 0, 1, 1, 1, 0, 1, 0, 2, 0, 0, 0, 0, 4, 6, 8, 0],
    [1, 1, 1, 41.2, 0, 1, 1, 0, 0, 0, 0, 1, 0, 5, 25, 30, 1, 1, 13, 3, 2, 1],
]
CDC_EXPECTED = [
    ("Overweight", "Senior", 2, 2, 5),
    ("Normal", "Young_Adult", 0, 0, 0),
    ("Obese", "Elderly", 2, 3, 25),
    ("Normal", "Middle_Aged", 1, 0, 0),
    ("Obese", "Elderly", 4, 3, 55),
]


def _cdc(spark):
    ddl = ", ".join(f"{c} {'double' if c == 'BMI' else 'int'}" for c in CDC_COLS)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(CDC_ROWS)], "rid int, " + ddl)


def test_cdc_fixture_all_cells(spark):
    out = engineer_features(_cdc(spark), "diabetes").orderBy("rid").collect()
    got = [(r.BMI_Category, r.Age_Group, r.Comorbidity_Index, r.Lifestyle_Risk_Score, r.Health_Impairment_Days)
           for r in out]
    assert got == CDC_EXPECTED


def test_lifestyle_score_always_present(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert engineer_features(df, "diabetes").first().Lifestyle_Risk_Score == 0


@pytest.mark.parametrize("bmi,label", [(0.0, "Underweight"), (18.5, "Underweight"), (18.51, "Normal"),
                                       (24.9, "Normal"), (24.95, "Overweight"), (29.9, "Overweight"),
                                       (100.0, "Obese"), (100.1, None), (-1.0, None), (None, None)])
def test_bmi_edges_right_closed(spark, bmi, label):
    df = spark.createDataFrame([(bmi,)], "BMI double")
    assert engineer_features(df, "diabetes").first().BMI_Category == label


@pytest.mark.parametrize("age,label", [(0, "Young_Adult"), (3, "Young_Adult"), (4, "Middle_Aged"), (7, "Middle_Aged"),
                                       (10, "Senior"), (14, "Elderly"), (15, None)])
def test_cdc_age_bands(spark, age, label):
    df = spark.createDataFrame([(age,)], "Age int")
    assert engineer_features(df, "diabetes").first().Age_Group == label


ONE_ROW = [
    ("heart", dict(Cholesterol=240.0, RestingBP=120.0, MaxHR=150.0, Age=50.0, Oldpeak=1.5, ExerciseAngina=1.0),
     dict(Atherogenic_Risk_Index=2.0, HR_Reserve_Ratio=0.882, Ischemic_Severity_Score=3.0)),
    ("kidney", dict(SerumCreatinine=1.5, BloodUrea=45.0, Hemoglobin=11.0, Age=60, Albumin=2, Hypertension=1),
     dict(BUN_Creatinine_Ratio=30.0, Anemia_Age_Risk=1, Renal_Vascular_Strain=4)),
    ("liver", dict(AspartateAminotransferase=60, AlamineAminotransferase=40, TotalBilirubin=2.0, DirectBilirubin=0.8,
                   TotalProteins=7.0, Albumin=3.5),
     dict(DeRitis_Ratio=1.5, Indirect_Bilirubin=1.2, Globulin_Level=3.5)),
    ("stroke", dict(AvgGlucoseLevel=120.0, BMI=28.0, Hypertension=1, HeartDisease=0, Age=65),
     dict(CardioMetabolic_Score=1.344, Vascular_Risk_Factor=1.3)),
    ("cancer", {"mean radius": 14.0, "mean texture": 19.0, "mean concavity": 0.08, "mean concave points": 0.04},
     dict(Tumor_Density_Index=266.0, Nuclear_Atypia_Score=0.18)),
    ("pneumonia", dict(SpO2=92.0, RespiratoryRate=24, FeverTemp=38.5, WBC_Count=14.0),
     dict(Hypoxia_Tachypnea_Index=9.6, Systemic_Inflammation_Index=21.0)),
    ("hypertension", dict(SystolicBP=150, DiastolicBP=95), dict(Pulse_Pressure=55, Mean_Arterial_Pressure=113.333)),
    ("sepsis", dict(SysBP=90, HeartRate=110, Lactate=4.0, WBC_Count=16.0),
     dict(Shock_Index=1.222, Metabolic_Crisis_Score=6.4)),
    ("dementia", dict(MMSE_Score=22, CDR_Scale=1.0, Age=75, EducationYears=12),
     dict(Cognitive_Dementia_Composite=24, Cognitive_Reserve_Ratio=8.0)),
    ("fever", dict(BodyTemp=36.5, Chills=1), dict(Pyrexia_Index=0.0)),
    ("malaria", dict(TempSpike=39.0, PlateletCount=50), dict(Thrombocytopenic_Fever_Ratio=4.0)),
    ("typhoid", dict(StepladderFever=1, FeverDuration=7), dict(Enteric_Fever_Index=7)),
    ("dengue", dict(HighFever=40.0, PlateletCount=50), dict(Hemorrhagic_Risk_Score=9.0)),
    ("cold", dict(Rhinorrhea=1, Sneezing=1), dict(URI_Symptom_Count=2)),
    ("gastro", dict(VomitingEpisodes=2, DiarrheaEpisodes=4), dict(Fluid_Loss_Severity=8.0)),
    ("anemia", dict(Hemoglobin=9.0, RBC_Count=3.0), dict(MCH_Proxy=3.0)),
    ("thyroid", dict(TSH=5.0, Free_T4=1.0), dict(TSH_FT4_Ratio=5.0)),
    ("asthma", dict(PeakExpiratoryFlow=60, Wheezing=1), dict(Airway_Obstruction_Score=80)),
    ("hypertensive_crisis", dict(SystolicBP=210, DiastolicBP=135), dict(Extreme_BP_Ratio=2.25)),
]


@pytest.mark.parametrize("disease,row,expected", ONE_ROW, ids=[r[0] for r in ONE_ROW])
def test_one_row_recipes(spark, disease, row, expected):
    df = spark.createDataFrame([Row(**row)])
    out = engineer_features(df, disease).first().asDict()
    for k, v in expected.items():
        assert out[k] == pytest.approx(v, abs=1e-3), k


def test_row_sum_counts_null_as_zero(spark):
    df = spark.createDataFrame([(1, None, 1, None)], "Rhinorrhea int, SoreThroat int, Sneezing int, NasalCongestion int")
    assert engineer_features(df, "cold").first().URI_Symptom_Count == 2


def test_recipe_skips_missing_inputs(spark):
    df = spark.createDataFrame([(1.0,)], "Cholesterol double")
    assert engineer_features(df, "heart").columns == ["Cholesterol"]


def test_null_input_gives_null_and_clip_keeps_null(spark):
    df = spark.createDataFrame([(None, 0.5, 1.0, 2.0)], "TotalBilirubin double, DirectBilirubin double, "
                                                        "TotalProteins double, Albumin double")
    r = engineer_features(df, "liver").first()
    assert r.Indirect_Bilirubin is None and r.Globulin_Level == 0.0


def test_zero_denominator_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, -1e-5)], "Cholesterol double, RestingBP double")
    assert engineer_features(df, "heart").first().Atherogenic_Risk_Index is None


@pytest.mark.parametrize("name,expected", [
    ("Diabetes", "diabetes"), ("cardiovascular", "heart"), ("vascular", "hypertension"),
    ("hypertensive_crisis", "hypertensive_crisis"), ("hypertension_crisis", "hypertensive_crisis"),
    ("flu_malaria", "fever"), ("dengue fever", "fever"), ("CKD", "kidney"), ("tumor", "cancer"),
    ("critical", "sepsis"), ("cognitive", "dementia"), ("unknown", None)])
def test_dispatch_order(name, expected):
    assert resolve_recipe(name) == expected


def test_unknown_recipe_returns_input(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    assert engineer_features(df, "zzz").columns == ["x"]
