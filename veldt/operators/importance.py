"""What a feature is worth to a model: the loss of accuracy when the feature is permuted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.functions.fitting import small_frame
from veldt.functions.ordered import hashed_positions

AS_IS = -1


def donors(df: DataFrame, key: str, columns: list[str], salt: str) -> DataFrame:
    """``df`` with ``__donor_<column>``: the values of another row, drawn so that every row gives once and takes once.

    Row number r in the order of md5(key) takes from row number r in the order of md5(key and salt). The numbers come
    from counts per hash prefix, so neither order is ever in one task. ``key`` must be unique.
    """
    taking = hashed_positions(df, [], key).drop("group_rows")
    salted = df.select(F.concat(F.col(key).cast("string"), F.lit(salt)).alias("__salted"), *[F.col(c).alias(f"__donor_{c}") for c in columns])
    giving = hashed_positions(salted, [], "__salted").drop("group_rows", "__salted")
    return taking.join(giving, "position").drop("position")


def variants(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every row once as it is (``variant`` -1) and once for each column with that column's donated value."""
    every = df.withColumn("variant", F.explode(F.array(*[F.lit(i) for i in range(AS_IS, len(columns))])))
    changed = {c: F.when(F.col("variant") == i, F.col(f"__donor_{c}")).otherwise(F.col(c)) for i, c in enumerate(columns)}
    return every.withColumns(changed).drop(*[f"__donor_{c}" for c in columns])


def permutation_importance(
    df: DataFrame,
    key: str,
    y: str,
    columns: list[str],
    predict: Callable[[DataFrame], DataFrame],
    prediction: str = "prediction",
    salt: str = "-donor",
    hit: Column | None = None,
) -> DataFrame:
    """(feature, accuracy, importance) per column: the accuracy with the column permuted, and what it costs.

    ``predict`` adds ``prediction`` to a frame; it is applied once, to all variants of a row, which are made and scored
    without a shuffle. ``hit`` may replace the share of right predictions by another mean per row, from columns of the
    predicted frame. A NULL prediction is wrong; an empty table gives NULL.
    """
    kept = df.select(key, y, *[c for c in columns if c not in (key, y)])
    scored = predict(variants(donors(kept, key, columns, salt), columns))
    right = hit if hit is not None else F.coalesce((F.col(y) == F.col(prediction)).cast("double"), F.lit(0.0))
    found = {r["variant"]: r["accuracy"] for r in scored.groupBy("variant").agg(F.avg(right).alias("accuracy")).collect()}
    base = found.get(AS_IS)
    rows = [(c, found.get(i), base - found[i] if base is not None and found.get(i) is not None else None) for i, c in enumerate(columns)]
    return small_frame(df.sparkSession, {"feature": "string", "accuracy": "double", "importance": "double"}, rows)
