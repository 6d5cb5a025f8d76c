"""Market-style series: ticks into bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ohlc(
    df: DataFrame, keys: list[str], ts: str, value: str, tiebreak: str, grain: str = "day"
) -> DataFrame:
    """Open, high, low, close per key and grain, as one map-side combined aggregate."""
    at = F.struct(ts, tiebreak)
    return df.groupBy(*keys, F.date_trunc(grain, ts).alias(grain)).agg(
        F.min_by(value, at).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, at).alias("close"),
        F.count(value).alias("ticks"),
    )
