"""Statistics: intervals, tests, collinearity, odds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.functions.comoments import comoments
from veldt.functions.fitting import small_frame


def ci_mean(df: DataFrame, column: str, by: list[str], z: float = 1.96) -> DataFrame:
    """Mean with a normal-approximation interval."""
    half = F.lit(float(z)) * F.col("sd") / F.sqrt("n")
    return (
        df.groupBy(*by)
        .agg(
            F.count(column).alias("n"),
            F.avg(column).alias("mean"),
            F.stddev_samp(column).alias("sd"),
        )
        .select(
            *by,
            "n",
            "mean",
            (F.col("mean") - half).alias("low"),
            (F.col("mean") + half).alias("high"),
        )
    )


def welch_t(df: DataFrame, column: str, first: Column) -> DataFrame:
    """Welch t and degrees of freedom; ``first`` tells the rows of the first group."""
    value = F.col(column)
    one, two = F.when(first, value), F.when(~first, value)
    sums = df.agg(
        F.avg(one).alias("m1"),
        F.avg(two).alias("m2"),
        (F.var_samp(one) / F.count(one)).alias("e1"),
        (F.var_samp(two) / F.count(two)).alias("e2"),
        F.count(one).alias("n1"),
        F.count(two).alias("n2"),
    )
    e1, e2 = F.col("e1"), F.col("e2")
    return sums.select(
        "n1",
        "n2",
        ((F.col("m1") - F.col("m2")) / F.sqrt(e1 + e2)).alias("t"),
        (
            (e1 + e2) * (e1 + e2) / (e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1))
        ).alias("dof"),
    )


def chi2(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square of independence: n * (sum of O^2 / (row total * column total) - 1).

    In this form empty cells add nothing, so they need not be made.
    """
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy(a).agg(F.sum("o").alias("row_total"))
    columns = cells.groupBy(b).agg(F.sum("o").alias("column_total"))
    share = F.col("o") * F.col("o") / (F.col("row_total") * F.col("column_total"))
    return (
        cells.join(rows, a)
        .join(columns, b)
        .agg(
            (F.sum("o") * (F.sum(share) - 1)).alias("chi2"),
            ((F.count_distinct(a) - 1) * (F.count_distinct(b) - 1)).alias("dof"),
        )
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Pearson matrix: one pass over the rows, columns squared numbers to the driver."""
    matrix = comoments(df, columns)[()].correlations()
    np.fill_diagonal(matrix, 1.0)
    return matrix


def vif(df: DataFrame, columns: list[str]) -> DataFrame:
    """Variance inflation: the diagonal of the inverted correlation matrix.

    Infinite for a column that the others determine; NULL for a constant one, which the others do not count.
    """
    matrix = correlation_matrix(df, columns)
    varied = [i for i in range(len(columns)) if len(columns) < 2 or not np.isnan(np.delete(matrix[i], i)).all()]
    inner = matrix[np.ix_(varied, varied)]
    if varied and np.linalg.cond(inner) < 1e12:
        factors = dict(zip(varied, np.diag(np.linalg.inv(inner)), strict=True))
    else:
        factors = {}
        for k, i in enumerate(varied):
            r, rest = np.delete(inner[k], k), np.delete(np.delete(inner, k, 0), k, 1)
            left = 1 - r @ np.linalg.pinv(rest, rcond=1e-10) @ r
            factors[i] = 1 / left if left > 1e-10 else float("inf")
    rows = [(c, float(factors[i]) if i in factors else None) for i, c in enumerate(columns)]
    return small_frame(df.sparkSession, {"feature": "string", "vif": "double"}, rows)


def odds_table(df: DataFrame, exposed: Column, outcome: Column, z: float = 1.96) -> DataFrame:
    """Odds ratio of a 2x2 table, with its interval on the log scale."""
    counts = df.agg(
        F.count_if(exposed & outcome).alias("a"),
        F.count_if(exposed & ~outcome).alias("b"),
        F.count_if(~exposed & outcome).alias("c"),
        F.count_if(~exposed & ~outcome).alias("d"),
    )
    a, b, c, d = (F.col(n).cast("double") for n in "abcd")
    ratio = F.try_divide(a * d, b * c)
    inverse = sum((F.try_divide(F.lit(1.0), x) for x in (b, c, d)), F.try_divide(F.lit(1.0), a))
    half = F.lit(float(z)) * F.sqrt(inverse)
    return counts.select(
        "a",
        "b",
        "c",
        "d",
        ratio.alias("odds_ratio"),
        F.exp(F.log(ratio) - half).alias("low"),
        F.exp(F.log(ratio) + half).alias("high"),
    )
