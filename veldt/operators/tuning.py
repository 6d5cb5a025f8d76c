"""Cross validation, parameter grids and model comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldt.functions.fitting import small_frame
from veldt.operators.metrics import accuracy
from veldt.operators.models import FEATURES, LABEL, assemble
from veldt.session import training_cache


def evaluator(metric: str):
    """A Spark evaluator by metric name."""
    if metric in ("areaUnderROC", "areaUnderPR"):
        return BinaryClassificationEvaluator(labelCol=LABEL, metricName=metric)
    if metric in ("rmse", "mae", "r2", "mse"):
        return RegressionEvaluator(labelCol=LABEL, metricName=metric)
    return MulticlassClassificationEvaluator(labelCol=LABEL, metricName=metric)


def grid_search(
    df: DataFrame,
    estimator,
    y: str,
    xs: list[str],
    params: dict[str, list],
    metric: str,
    fold: str,
    folds: int,
    parallelism: int = 2,
) -> tuple[CrossValidatorModel, list[tuple[str, float, float]]]:
    """All parameter combinations over the given folds; (fitted search, [(params, mean, sd)])."""
    return grid_search_vectors(
        assemble(df, xs), estimator, y, FEATURES, params, metric, fold, folds, parallelism
    )


def grid_search_vectors(
    df: DataFrame,
    estimator,
    y: str,
    vector: str,
    params: dict[str, list],
    metric: str,
    fold: str,
    folds: int,
    parallelism: int = 2,
) -> tuple[CrossValidatorModel, list[tuple[str, float, float]]]:
    """As ``grid_search``, for a frame that already holds the feature vector."""
    estimator = estimator.copy().setLabelCol(LABEL).setFeaturesCol(FEATURES)
    builder = ParamGridBuilder()
    for name, values in params.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    grid = builder.build()
    data = df.select(
        F.col(vector).alias(FEATURES),
        F.col(y).cast("double").alias(LABEL),
        F.col(fold).cast("int").alias(fold),
    )
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator(metric),
        numFolds=folds,
        foldCol=fold,
        parallelism=parallelism,
    )
    with training_cache(data) as cached:
        search = search.fit(cached)
    rows = []
    for combo, mean, sd in zip(grid, search.avgMetrics, search.stdMetrics):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(combo.items(), key=lambda x: x[0].name))
        rows.append((text, float(mean), float(sd)))
    return search, rows


def cross_validate(
    df: DataFrame, estimator, y: str, xs: list[str], metric: str, fold: str, folds: int
) -> tuple[float, float]:
    """Mean and deviation of a metric over the folds."""
    _, rows = grid_search(df, estimator, y, xs, {}, metric, fold, folds)
    return rows[0][1], rows[0][2]


def score_table(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """(params, mean, sd) rows as a frame."""
    return small_frame(
        df.sparkSession, {"params": "string", "mean": "double", "sd": "double"}, rows
    )


def overfit_report(df: DataFrame, label: str, prediction: str, side: str) -> DataFrame:
    """Train accuracy, test accuracy and their gap, in one pass over both sides."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(
        F.avg(F.when(F.col(side) == "train", hit)).alias("train_accuracy"),
        F.avg(F.when(F.col(side) == "test", hit)).alias("test_accuracy"),
    ).withColumn("gap", F.col("train_accuracy") - F.col("test_accuracy"))


def compare(models: dict[str, DataFrame], label: str, prediction: str) -> DataFrame:
    """One accuracy row per model."""
    rows = [
        accuracy(f, label, prediction).select(F.lit(n).alias("model"), "accuracy", "n")
        for n, f in models.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def compare_columns(df: DataFrame, label: str, predictions: list[str]) -> DataFrame:
    """As ``compare``, for predictions held in columns of one frame: a single pass."""
    hits = [F.avg((F.col(label) == F.col(p)).cast("double")).alias(p) for p in predictions]
    return df.agg(*hits).unpivot([], predictions, "model", "accuracy")
