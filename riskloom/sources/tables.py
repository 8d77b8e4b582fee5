"""Driver tables (one parquet per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: tasks a core of work that is heavy for its rows
TASKS_PER_CORE = 4


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a scan dealt evenly over all cores, for work that is heavy a row: a scan is cut by its bytes, and a few
    MB of keys can mean hours. Only the columns that are read move."""
    wanted = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(wanted, df.rdd.getNumPartitions()))
