"""Parquet table scans.  Projection and filters are left to Catalyst, so
only the referenced columns are read and predicates reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_HANDLES: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given input tables are read-only, so one resolved DataFrame per
    session and path is reused (no repeated listing and footer reads while
    a plan is being built)."""
    path = table_path(sf_dir, name)
    key = (str(id(spark)) + spark.sparkContext.applicationId, path)
    df = _HANDLES.get(key)
    if df is None:
        df = _HANDLES[key] = spark.read.parquet(path)
    return df
