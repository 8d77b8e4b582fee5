"""Triage arriving intake rows as a stream (stateless: no watermark or state store is needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import triage
from ..sources.panels import _intake_exprs


def intake_stream(spark: SparkSession, source_dir: str, kind: str = "a", file_glob: str = "orders*.parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Intake rows projected from order files as they land in ``source_dir``."""
    schema = spark.read.parquet(f"{source_dir.rstrip('/')}/{file_glob}").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    orders = r.parquet(source_dir)
    return orders.selectExpr("o_orderkey AS patient_id", *[f"{e} AS {c}" for c, e in _intake_exprs(kind)])


def triage_stream(intake: DataFrame, kind: str = "a", diseases=None) -> DataFrame:
    """The batch triage report (X17) applied to a streaming intake frame."""
    from .. import config
    ds = list(diseases or config.RULE_DISEASES)
    return triage.triage_report(triage.score_rules_wide(intake, kind, ds), ds)


def start(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, kind: str = "a",
          available_now: bool = True):
    """Append triage rows to a Parquet sink; the checkpoint directory must be on shared storage."""
    q = (triage_stream(intake_stream(spark, source_dir, kind), kind).writeStream
         .format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
         .outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()
