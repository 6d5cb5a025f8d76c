"""The tables behind charts; drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.functions.columns import width_bin
from veldt.functions.ordered import same_keys
from veldt.functions.quantiles import exact_quantiles


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Rows per equal-width bin, by lower edge."""
    return df.groupBy(width_bin(F.col(column), width).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def boxplot(df: DataFrame, column: str, by: str) -> DataFrame:
    """Minimum, exact quartiles and maximum per group."""
    ends = df.groupBy(by).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    middle = exact_quantiles(df, [column], [0.25, 0.5, 0.75], [by]).select(
        F.col(by).alias("__of"), "p0", "p1", "p2"
    )
    return ends.join(middle, same_keys(ends, middle, [(by, "__of")])).select(
        by,
        "low",
        F.col("p0").alias("q25"),
        F.col("p1").alias("q50"),
        F.col("p2").alias("q75"),
        "high",
    )


def series(df: DataFrame, ts: str, grain: str, measures: dict[str, Column]) -> DataFrame:
    """Measures per calendar grain."""
    when = F.date_trunc(grain, ts).cast("timestamp_ntz").alias(grain)
    return df.groupBy(when).agg(*[c.alias(n) for n, c in measures.items()])


def bars(df: DataFrame, column: str, n: int, other: str = "other") -> DataFrame:
    """The ``n`` most frequent categories, and all the rest as one bar."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    best = counts.orderBy(F.col("n").desc(), F.col(column).asc_nulls_last()).limit(n)
    best = best.select(F.col(column).alias("__best"), F.lit(1).alias("__shown"))
    joined = counts.join(best, same_keys(counts, best, [(column, "__best")]), "left")
    name = F.when(F.col("__shown") == 1, F.col(column)).otherwise(other)
    return joined.groupBy(name.alias(column)).agg(F.sum("n").alias("n"))
