"""Aggregation and exploratory analysis."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.functions.comoments import comoments
from veldt.functions.fitting import literal
from veldt.functions.quantiles import exact_quantiles


def aggregate(
    df: DataFrame, by: list[str], measures: dict[str, Column], having: Column | None = None
) -> DataFrame:
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in measures.items()])
    return out if having is None else out.filter(having)


def moments(df: DataFrame, columns: list[str], stats: dict, by: list[str]) -> DataFrame:
    """Rows (by..., column, statistic...) from one aggregate over all columns."""
    wide = df.groupBy(*by).agg(
        *[
            F.struct(F.lit(c).alias("column"), *[fn(F.col(c)).alias(n) for n, fn in stats.items()])
            .alias(c)
            for c in columns
        ]
    )
    return wide.select(*by, F.explode(F.array(*columns)).alias("__s")).select(*by, "__s.*")


def describe(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum per column (and group)."""
    by = by or []
    stats = moments(
        df,
        columns,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(c.cast("double")),
            "max": lambda c: F.max(c.cast("double")),
        },
        by,
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by)
    return stats.join(quartiles, [*by, "column"], "left").select(
        *by,
        "column",
        "count",
        "mean",
        "std",
        "min",
        F.col("p0").alias("q25"),
        F.col("p1").alias("q50"),
        F.col("p2").alias("q75"),
        "max",
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value."""
    total = df.count()
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.try_divide(F.col("n"), literal(total)))


def profile_by(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Mean, deviation, minimum and maximum of each column per class."""
    stats = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return moments(df, columns, stats, [label])


def crosstab(df: DataFrame, a: str, b: str, values: list, shares: bool = False) -> DataFrame:
    """Contingency table with one column per value of ``b``; ``shares`` divides by all rows of ``a``."""
    cells = [F.count_if(F.col(b) == F.lit(v)) for v in values]
    if shares:
        cells = [F.try_divide(c, F.count(F.lit(1))) for c in cells]
    return df.groupBy(a).agg(*[c.alias(str(v)) for c, v in zip(cells, values)])


def corr(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, all in one pass over the rows; NULL for a constant column."""
    matrix = comoments(df, columns)[()].correlations()
    rows = [(columns[i], columns[j], number(matrix[i, j])) for i, j in combinations(range(len(columns)), 2)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def number(value: float) -> float | None:
    """NaN as None."""
    return None if value != value else float(value)


def shape(df: DataFrame, columns: list[str]) -> DataFrame:
    """Population skewness and excess kurtosis."""
    return moments(df, columns, {"skewness": F.skewness, "kurtosis": F.kurtosis}, [])


def subtotals(
    df: DataFrame, keys: list[str], measures: dict[str, Column], how: str = "rollup"
) -> DataFrame:
    """Rollup or cube; ``level`` is the grouping id, so a subtotal row is told from a NULL key."""
    grouped = df.rollup(*keys) if how == "rollup" else df.cube(*keys)
    return grouped.agg(
        F.grouping_id(*keys).alias("level"), *[c.alias(n) for n, c in measures.items()]
    )


def churn_features(
    orders: DataFrame, customers: DataFrame, customer: str, ts: str, amount: str, as_of, days: int
) -> DataFrame:
    """Recency, frequency and amount per customer; churned when nothing came in the last ``days``.

    Customers without any order are kept, with frequency 0, and count as churned.
    """
    per = orders.groupBy(customer).agg(
        F.datediff(F.lit(as_of).cast("date"), F.max(F.col(ts).cast("date"))).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(amount).alias("amount"),
    )
    joined = customers.join(per, customer, "left")
    return joined.withColumns(
        {
            "frequency": F.coalesce("frequency", F.lit(0)),
            "amount": F.coalesce("amount", F.lit(0.0)),
            "churned": F.coalesce((F.col("recency") > days).cast("int"), F.lit(1)),
        }
    )
