"""Where every query and its equivalent SQL are registered."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FAMILIES = [
    "metrics", "sources", "clean", "functions", "star", "eda", "windows", "charts",
    "features", "text", "stats", "models", "tuning", "projects",
]


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``key``, with the SQL that must give the same rows."""

    def add(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"veldt.plans.{family}")
