"""Projection, filters and cleaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldt.functions.fitting import fit_row, literal
from veldt.functions.ordered import same_keys
from veldt.functions.quantiles import exact_quantiles


def project(df: DataFrame, exprs: dict[str, Column | str]) -> DataFrame:
    """Select columns by new name; a string value is an existing column."""
    return df.select(
        *[(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in exprs.items()]
    )


def where(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.filter(predicate)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing count and share per column, in one pass."""
    columns = columns or df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counts.unpivot(["rows"], columns, "column", "missing").select(
        "column", "missing", F.try_divide("missing", "rows").alias("rate")
    )


def drop_nulls(
    df: DataFrame, how: str = "any", thresh: int | None = None, subset: list[str] | None = None
) -> DataFrame:
    """Drop rows with missing values; ``thresh`` keeps rows with at least that many present."""
    return df.na.drop(how=how, thresh=thresh, subset=subset)


def drop_sparse_columns(df: DataFrame, max_rate: float) -> DataFrame:
    """Drop columns whose missing share is above ``max_rate``."""
    counts = fit_row(
        df, {"__rows": F.count(F.lit(1)), **{c: F.count_if(F.col(c).isNull()) for c in df.columns}}
    )
    rows = max(counts.pop("__rows"), 1)
    return df.select(*[c for c in df.columns if counts[c] / rows <= max_rate])


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Not-a-number becomes NULL in floating columns, so only NULL means missing."""
    floats = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(float("nan"))) for c in floats})


def fit_quantiles(
    train: DataFrame, columns: list[str], probabilities: list[float]
) -> dict[str, list[float]]:
    """Exact quantiles per column as numbers (None without any value); one row per column reaches the driver."""
    rows = exact_quantiles(train, columns, probabilities).collect()
    found = {r["column"]: [r[f"p{i}"] for i in range(len(probabilities))] for r in rows}
    return {c: found.get(c, [None] * len(probabilities)) for c in columns}


def fit_impute(train: DataFrame, columns: list[str], strategy: str) -> dict[str, object]:
    """Fill values from the training rows: mean, median or mode (smallest value on ties)."""
    if strategy == "mean":
        return fit_row(train, {c: F.avg(c) for c in columns})
    if strategy == "median":
        return {c: q[0] for c, q in fit_quantiles(train, columns, [0.5]).items()}
    if strategy == "mode":
        found = {}
        for c in columns:
            top = (
                train.filter(F.col(c).isNotNull())
                .groupBy(c)
                .count()
                .orderBy(F.col("count").desc(), F.col(c).asc())
                .first()
            )
            found[c] = top[c] if top else None
        return found
    raise ValueError(f"unknown strategy {strategy!r}")


def impute(train: DataFrame, df: DataFrame, columns: list[str], strategy: str) -> DataFrame:
    """Fill missing values of ``df`` with a statistic of ``train``."""
    values = fit_impute(train, columns, strategy)
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in values.items() if v is not None})


def impute_by(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Fill with the mean of the row's group.

    An aggregate joined back, not a window: the aggregate combines map-side, and adaptive
    execution can broadcast it or split the rows of a very large group.
    """
    means = df.groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys]).agg(
        F.avg(column).alias("__mean")
    )
    joined = df.join(means, same_keys(df, means, [(k, f"__of_{k}") for k in keys]), "left")
    return joined.withColumn(column, F.coalesce(column, "__mean")).select(*df.columns)


def normalize_categories(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Trim, lower, squeeze blanks and map known variants of a category."""
    tidy = F.regexp_replace(F.trim(F.lower(F.col(column))), " +", " ")
    if not mapping:
        return df.withColumn(column, tidy)
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return df.withColumn(column, F.coalesce(F.try_element_at(lookup, tidy), tidy))


def safe_cast(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast columns; values that do not fit become NULL."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in kinds.items()})


def cast_failures(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """How many present values of each column do not fit its new type."""
    lost = {
        c: F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull())
        for c, kind in kinds.items()
    }
    counts = df.agg(*[e.alias(c) for c, e in lost.items()])
    return counts.unpivot([], list(kinds), "column", "failures")


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule (a rule states what must hold; NULL does not break it)."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def dedup(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``; Spark keeps one row per key and task before shuffling."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__row", F.row_number().over(first)).filter("__row = 1").drop("__row")


def fit_iqr(train: DataFrame, columns: list[str], k: float = 1.5) -> dict[str, tuple]:
    quartiles = fit_quantiles(train, columns, [0.25, 0.75])
    fences = {c: (a - k * (b - a), b + k * (b - a)) for c, (a, b) in quartiles.items() if a is not None}
    return {c: fences.get(c, (None, None)) for c in columns}


def flag_iqr(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """``<column>_outlier`` marks values outside the quartile fences (a missing value is inside)."""
    fences = fit_iqr(df, columns, k)
    return df.withColumns(
        {
            f"{c}_outlier": F.coalesce(
                (F.col(c) < literal(low)) | (F.col(c) > literal(high)), F.lit(False)
            )
            for c, (low, high) in fences.items()
        }
    )


def flag_iqr_by(df: DataFrame, column: str, keys: list[str], k: float = 1.5) -> DataFrame:
    """As ``flag_iqr``, with fences per group."""
    fences = exact_quantiles(df, [column], [0.25, 0.75], keys).select(
        *[F.col(key).alias(f"__of_{key}") for key in keys], "p0", "p1"
    )
    joined = df.join(fences, same_keys(df, fences, [(key, f"__of_{key}") for key in keys]), "left")
    reach = F.lit(float(k)) * (F.col("p1") - F.col("p0"))
    outside = (F.col(column) < F.col("p0") - reach) | (F.col(column) > F.col("p1") + reach)
    flag = F.coalesce(outside, F.lit(False))
    return joined.select(*df.columns, flag.alias(f"{column}_outlier"))


def flag_z(df: DataFrame, columns: list[str], z: float = 3.0) -> DataFrame:
    """``<column>_z`` and ``<column>_outlier`` by distance in sample deviations."""
    stats = fit_row(
        df,
        {
            **{f"m_{c}": F.avg(c) for c in columns},
            **{f"s_{c}": F.stddev_samp(c) for c in columns},
        },
    )
    out = df
    for c in columns:
        score = F.try_divide(F.col(c) - literal(stats[f"m_{c}"]), literal(stats[f"s_{c}"]))
        out = out.withColumn(f"{c}_z", score)
        out = out.withColumn(f"{c}_outlier", F.coalesce(F.abs(F.col(f"{c}_z")) > z, F.lit(False)))
    return out


def winsorize(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Clip to two exact quantiles."""
    a, b = fit_quantiles(df, [column], [low, high])[column]
    clipped = F.least(F.greatest(F.col(column), literal(a)), literal(b))
    return df.withColumn(column, F.when(F.col(column).isNotNull(), clipped))


def clean(df: DataFrame, steps: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Chain cleaning steps."""
    for step in steps:
        df = df.transform(step)
    return df
