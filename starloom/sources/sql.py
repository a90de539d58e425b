"""Parameterised SQL over warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """Register tables as temporary views; returns the view name of each."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    return {name: prefix + name for name in tables}


def run_sql(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """Run SQL with named parameters (``:name``): values are bound, never pasted into the text."""
    return spark.sql(sql, args=dict(params or {}))
