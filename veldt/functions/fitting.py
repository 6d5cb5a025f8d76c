"""Fitted statistics: one aggregate over the training rows, returned as plain numbers.

The result is one row whatever the size of the table. Used as literals in the transform, it needs
no join and stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fit_row(train: DataFrame, stats: dict[str, Column]) -> dict:
    """Run one global aggregate and return its only row as a dict."""
    return train.agg(*[c.alias(n) for n, c in stats.items()]).first().asDict()


def literal(value) -> Column:
    """A fitted number as a double literal (NULL stays NULL)."""
    return F.lit(None if value is None else float(value)).cast("double")


def small_frame(spark: SparkSession, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A few fitted numbers as a DataFrame, built from literals (no Python workers)."""
    cells = [
        F.struct(*[F.lit(v).cast(kind).alias(n) for v, (n, kind) in zip(row, columns.items())])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*cells)))


def lookup(values: dict, kind: str, key: Column) -> Column:
    """A fitted value per category as a literal map; categories not fitted give NULL."""
    if not values:
        return F.lit(None).cast(kind)
    whole = all(isinstance(k, int) and not isinstance(k, bool) for k in values)
    key_kind = "bigint" if whole else None
    cells = []
    for k, v in values.items():
        cells += [F.lit(k).cast(key_kind) if key_kind else F.lit(k), F.lit(v).cast(kind)]
    return F.try_element_at(F.create_map(*cells), key.cast(key_kind) if key_kind else key)


MAX_CATEGORIES = 10_000


def fit_categories(train: DataFrame, column: str) -> list:
    """Sorted categories of a column that is used one category at a time; refuses free text."""
    rows = (
        train.filter(F.col(column).isNotNull())
        .select(column)
        .distinct()
        .limit(MAX_CATEGORIES + 1)
        .collect()
    )
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} categories")
    return sorted(r[0] for r in rows)


def fit_counts(train: DataFrame, column: str) -> dict:
    """Rows per class; the same guard on the number of classes."""
    counts = train.groupBy(column).count().limit(MAX_CATEGORIES + 1).collect()
    if len(counts) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} classes")
    return {r[0]: r["count"] for r in counts if r[0] is not None}
