"""File sources and sinks (S1-S5): CSV scans with explicit schemas, read-or-build, sinks.

Every scan takes an explicit schema (DDL string or StructType): no inference
pass over the data, and a NaN text token can be mapped to null at the source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema, header: bool = True, null_value: str | None = None,
             nan_to_null: bool = True) -> DataFrame:
    """S1 (header) / S2 (no header, names from the schema) / S3 (null token such as ``?``)."""
    r = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
    if null_value is not None:
        r = r.option("nullValue", null_value)
    df = r.csv(path)
    if nan_to_null:
        df = df.withColumns({f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType))
                             for f in df.schema.fields if f.dataType.typeName() in ("double", "float")})
    return df


def write_csv(df: DataFrame, path: str, header: bool = True, null_value: str | None = None,
              mode: str = "errorifexists") -> None:
    """CSV sink (one directory of part files; no index column)."""
    w = df.write.mode(mode).option("header", header)
    if null_value is not None:
        w = w.option("nullValue", null_value)
    w.csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list:
    """Names of the entries of a folder; none if it does not exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def materialize(spark: SparkSession, path: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """Read the Parquet table at ``path`` if a finished write left its success marker there, else
    build it, write it and read it back. A folder without the marker is an unfinished write: it is
    written anew. A missing folder is written with ``errorifexists``, so concurrent builders cannot
    silently overwrite each other."""
    if not _exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        mode = "overwrite" if _exists(spark, path) else "errorifexists"
        builder().write.mode(mode).parquet(path)
    return spark.read.parquet(path)
