"""Registered queries: one Spark job per operator plus its DuckDB oracle SQL.

``registry()`` returns ``{name: (spark_fn, oracle_sql_or_None)}`` where
``spark_fn(spark, sf_dir) -> DataFrame``. Every query reads the driver
tables (or panels Spark projects from them), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, tuple[QueryFn, str | None]]:
    from . import features, learning, modeling, profile, scoring
    out: dict[str, tuple[QueryFn, str | None]] = {}
    for mod in (scoring, features, profile, modeling, learning):
        for name, entry in mod.QUERIES.items():
            if name in out:
                raise ValueError(f"duplicate query {name}")
            out[name] = entry
    return out
