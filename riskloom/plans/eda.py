"""Exploratory analysis plan on the Pima-shaped diabetes table (section 3.3 of the survey).

zero-to-null → class-median fill (EDA only: it uses the target) → de-duplication
→ sequential IQR filter → BMI and age bands. The cleaned table is checkpointed
once (every summary reads it; the checkpoint also cuts the lineage of the
quantile jobs) and the summaries are returned as lazy frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import bin_right_closed
from ..operators import clean, distribution, profile
from ..session import ensure_checkpoint_dir

FEATURES = ["Pregnancies", "Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI", "DiabetesPedigreeFunction",
            "Age"]
# --- fixed values: EDA bands (right-closed, first band open on the left).
EDA_BMI_EDGES = [0, 18.5, 24.9, 29.9, 100]
EDA_BMI_LABELS = ["Underweight", "Normal", "Overweight", "Obese"]
EDA_AGE_EDGES = [0, 30, 45, 60, 120]
EDA_AGE_LABELS = ["Young", "Middle_Aged", "Senior", "Elderly"]


def clean_table(df: DataFrame, checkpoint: bool = False) -> DataFrame:
    """The cleaning chain; output has the features, Outcome, BMI_Category and Age_Group."""
    cols = clean.SENTINEL_ZERO_COLUMNS
    x = clean.sentinel_to_null(df.select(*FEATURES, "Outcome"), cols)
    x = clean.group_median_fill(x, cols, "Outcome")
    x = clean.drop_duplicate_rows(x)
    # the IQR steps each rank the surviving rows: cut the fill + de-duplication lineage once
    ensure_checkpoint_dir(df.sparkSession)
    x = x.checkpoint(eager=True)
    x = clean.iqr_filter_sequential(x, cols)
    x = x.withColumns({"BMI_Category": bin_right_closed("BMI", EDA_BMI_EDGES, EDA_BMI_LABELS),
                       "Age_Group": bin_right_closed("Age", EDA_AGE_EDGES, EDA_AGE_LABELS)})
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        x = x.checkpoint(eager=True)
    return x


def summaries(cleaned: DataFrame) -> dict[str, DataFrame]:
    num = FEATURES + ["Outcome"]
    return {
        "shape": profile.shape(cleaned),
        "outcome_counts": profile.value_counts(cleaned, "Outcome"),
        "outcome_share": profile.value_share(cleaned, "Outcome", 100.0),
        "bmi_bands": profile.value_counts(cleaned, "BMI_Category", EDA_BMI_LABELS),
        "age_bands": profile.value_counts(cleaned, "Age_Group", EDA_AGE_LABELS),
        "corr": profile.corr_matrix(cleaned, num),
        "corr_outcome": profile.corr_with_target(cleaned, FEATURES, "Outcome"),
        "glucose_hist": distribution.histogram(cleaned, "Glucose", 30),
        "glucose_by_class": distribution.histogram(cleaned, "Glucose", 40, by="Outcome"),
        "bmi_kde": distribution.kde(cleaned, "BMI"),
        "age_kde": distribution.kde(cleaned, "Age"),
        "glucose_box": distribution.box_summary(cleaned, "Glucose", "Outcome"),
        "bmi_box": distribution.box_summary(cleaned, "BMI", "Outcome"),
        "insulin_box": distribution.box_summary(cleaned, "Insulin", "Outcome"),
        "outliers_glucose": clean.iqr_bounds(cleaned, ["Glucose"]),
        "pair_sample": cleaned.select("Glucose", "BMI", "Age", "Outcome")
        .withColumn("_k", F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in ["Glucose", "BMI", "Age",
                                                                                       "Outcome"]])))
        .orderBy("_k", "Glucose", "BMI", "Age", "Outcome").limit(2000).drop("_k"),
    }
