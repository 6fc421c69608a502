"""Parquet table access (driver tables, staging and star tables)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(base: str, name: str) -> str:
    """``<base>/<name>.parquet`` if that exists, else ``<base>/<name>``."""
    p = os.path.join(base, f"{name}.parquet")
    if os.path.exists(p) or "://" in base:
        return p
    return os.path.join(base, name)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Columnar scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(base, name))
