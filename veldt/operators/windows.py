"""Sorting, top-k, returns and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldt.functions.columns import safe_ratio
from veldt.functions.ordered import with_preceding


def returns(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Previous value, change and simple return along ``order``."""
    out = with_preceding(df, keys, order, 1, {}, {"previous": F.lag(value)})
    change = F.col(value) - F.col("previous")
    return out.withColumns(
        {"change": change, "simple_return": safe_ratio(change, F.col("previous"))}
    )


def rolling_mean(
    df: DataFrame, keys: list[str], order: list[Column], value: str, rows: int
) -> DataFrame:
    """Mean over the last ``rows`` rows."""
    return with_preceding(df, keys, order, rows - 1, {"rolling_mean": F.avg(value)})


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_by(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key; each task keeps k rows per key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("position", place).filter(F.col("position") <= k)


def combine(a: DataFrame, b: DataFrame, op: str) -> DataFrame:
    """Set operations by name."""
    operations = {
        "union_all": lambda: a.unionByName(b),
        "union": lambda: a.unionByName(b).distinct(),
        "intersect": lambda: a.intersect(b),
        "intersect_all": lambda: a.intersectAll(b),
        "except": lambda: a.subtract(b),
        "except_all": lambda: a.exceptAll(b),
    }
    return operations[op]()
