"""Dataset registry (S6, S7): disease name → panel, with the loader's ordered substring match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .panels import load_panel, outcome_sql, panel_projection
from .tables import table

# --- fixed values: dataset lookup order (first keyword found in the lower-cased key wins).
LOADER_DISPATCH = [
    (("diabetes",), "diabetes"), (("heart",), "heart"), (("kidney",), "kidney"), (("liver",), "liver"),
    (("stroke",), "stroke"), (("cancer", "oncology"), "cancer"), (("pneumonia", "respiratory"), "pneumonia"),
    (("hypertensive_crisis",), "hypertensive_crisis"), (("hypertension", "vascular"), "hypertension"),
    (("sepsis", "critical"), "sepsis"), (("dementia", "alzheimer"), "dementia"), (("fever", "flu"), "fever"),
    (("malaria",), "malaria"), (("typhoid",), "typhoid"), (("dengue",), "dengue"), (("cold",), "cold"),
    (("gastro",), "gastro"), (("anemia",), "anemia"), (("thyroid",), "thyroid"), (("asthma",), "asthma"),
]


def resolve_dataset(key: str) -> str:
    low = key.lower()
    for kws, name in LOADER_DISPATCH:
        if any(k in low for k in kws):
            return name
    raise ValueError(f"Unknown disease key: {key}")


def load_disease_dataset(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """The panel for ``key`` (lazy: no job runs until an action)."""
    return load_panel(spark, sf_dir, resolve_dataset(key))


def load_all_datasets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All 20 panels in training order, as lazy DataFrames."""
    return {d: load_panel(spark, sf_dir, d) for d in config.TRAINING_ORDER}


def count_all_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and positives of every panel, ``(disease, n_rows, n_pos)``: one scan of the common source table, one
    outcome column per disease, one aggregation."""
    df = table(spark, sf_dir, "orders")
    kept = list(df.columns)
    for d in config.TRAINING_ORDER:
        df = panel_projection(df, d, kept).selectExpr(*kept, f"{outcome_sql(d)} AS _y_{d}")
        kept.append(f"_y_{d}")
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(f"_y_{d}") == 1).alias(d) for d in config.TRAINING_ORDER])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(d).alias("disease"), F.col("n_rows"), F.col(d).alias("n_pos")) for d in config.TRAINING_ORDER])))
