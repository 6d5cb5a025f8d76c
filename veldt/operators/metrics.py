"""Model evaluation over distributed (label, prediction) or (label, score) columns.

Score-based metrics first count positives and negatives per distinct score, so ties become one
point and everything after the first aggregate works on distinct scores only.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldt.functions.fitting import fit_row, literal
from veldt.functions.ordered import running_totals


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts for every (label, prediction) pair of known classes, zeros included; NULL is a class where it occurs."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    known = (
        cells.select(F.explode(F.array(F.struct(F.col(label).alias("c")), F.struct(F.col(prediction).alias("c")))).alias("s"))
        .groupBy()
        .agg(F.sort_array(F.collect_set("s")).alias("classes"))
    )
    # one row holding the class list, unfolded on both axes: classes squared rows, no join
    grid = known.select(F.explode("classes").alias("a"), "classes").select("a", F.explode("classes").alias("b"))
    grid = grid.select(F.col("a.c").alias("__label"), F.col("b.c").alias("__prediction"))
    same = F.col("__label").eqNullSafe(F.col(label)) & F.col("__prediction").eqNullSafe(F.col(prediction))
    return grid.join(cells, same, "left").select(
        F.col("__label").alias(label), F.col("__prediction").alias(prediction), F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def precision_recall_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from confusion cells."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col(label).alias("class"),
                    F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).alias("tp"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("long").alias("predicted"),
                ),
                F.struct(
                    F.col(prediction).alias("class"),
                    F.lit(0).cast("long").alias("tp"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("n").alias("predicted"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("actual").alias("support"), F.sum("predicted").alias("picked")
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("tp", "picked"), zero)
    recall = F.coalesce(F.try_divide("tp", "support"), zero)
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("picked")), zero)
    return sums.select(
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        "support",
    )


def macro_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Unweighted means of the per-class scores."""
    return precision_recall_f1(df, label, prediction).agg(
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
    )


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score; NaN counts as NULL, which ranks below every score."""
    positive = F.col(label).cast("long")
    known = F.when(~F.isnan(F.col(score).cast("double")), F.col(score))
    return df.groupBy(known.alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )


def _descending(df: DataFrame, label: str, score: str) -> tuple[DataFrame, int, int]:
    counts = score_counts(df, label, score)
    sizes = fit_row(
        df,
        {
            "p": F.sum(F.col(label).cast("long")),
            "n": F.sum(1 - F.col(label).cast("long")),
            "scores": F.approx_count_distinct(score),
        },
    )
    running = running_totals(
        counts,
        [],
        [F.col("score").desc_nulls_last()],
        {"tp": F.col("pos"), "fp": F.col("neg")},
        sizes["scores"],
    )
    return running, sizes["p"] or 0, sizes["n"] or 0


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """True and false positive rate at each distinct score."""
    running, p, n = _descending(df, label, score)
    return running.select(
        F.col("score").alias("threshold"),
        F.try_divide("tp", literal(p)).alias("tpr"),
        F.try_divide("fp", literal(n)).alias("fpr"),
    )


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall at each distinct score."""
    running, p, _ = _descending(df, label, score)
    return running.select(
        F.col("score").alias("threshold"),
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", literal(p)).alias("recall"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Chance that a positive outranks a negative; ties count one half."""
    running, p, n = _descending(df, label, score)
    above = literal(n) - F.col("fp")  # negatives strictly below this score
    wins = F.sum(F.col("pos") * (above + F.col("neg") / 2.0))
    return running.agg(F.try_divide(wins, literal(p) * literal(n)).alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Sum of precision times recall step, without interpolation."""
    running, p, _ = _descending(df, label, score)
    step = F.col("pos") * F.try_divide("tp", F.col("tp") + F.col("fp"))
    return running.agg(F.try_divide(F.sum(step), literal(p)).alias("average_precision"))


def threshold_sweep(df: DataFrame, label: str, score: str, grid: list[float]) -> DataFrame:
    """Confusion counts and rates when predicting positive at score >= threshold.

    A row is counted once, in the highest grid step it reaches (found by binary search); suffix sums over the grid
    (never larger than the grid itself) give the counts. No row is repeated per threshold.
    """
    grid = sorted(set(grid))
    bucketizer = Bucketizer(
        splits=[-float("inf"), *grid, float("inf")],
        inputCol="__score",
        outputCol="__bucket",
        handleInvalid="keep",
    )
    scores = df.select(F.col(label).cast("long").alias("__y"), F.col(score).cast("double").alias("__score"))
    # not-a-number lands in a bucket past the last one, NULL in none; neither reaches a threshold
    step = F.coalesce(F.col("__bucket") % (len(grid) + 1), F.lit(0)).cast("int")
    steps = (
        bucketizer.transform(scores)
        .groupBy(step.alias("step"))
        .agg(F.sum("__y").alias("pos"), F.sum(1 - F.col("__y")).alias("neg"))
    )
    axis = F.array(F.lit(None).cast("double"), *[F.lit(float(t)) for t in grid])
    thresholds = df.sparkSession.range(1).select(F.posexplode(axis).alias("step", "threshold"))
    from_top = Window.orderBy(F.col("step").desc())
    all_rows = Window.partitionBy()
    sums = (
        thresholds.join(steps, "step", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("pos", "neg")})
        .select(
            "step",
            "threshold",
            F.sum("pos").over(from_top).alias("tp"),
            F.sum("neg").over(from_top).alias("fp"),
            F.sum("pos").over(all_rows).alias("p"),
            F.sum("neg").over(all_rows).alias("n"),
        )
        .filter("step > 0")
    )
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("p") - tp, F.col("n") - fp
    zero = F.lit(0.0)
    return sums.select(
        "threshold",
        "tp",
        "fp",
        fn.alias("fn"),
        tn.alias("tn"),
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )


def cost_curve(
    df: DataFrame, label: str, score: str, grid: list[float], cost_fp: float, cost_fn: float
) -> DataFrame:
    """Cost of each threshold; ``is_best`` marks the cheapest, the lower one on ties."""
    sweep = threshold_sweep(df, label, score, grid)
    cost = F.col("fp") * F.lit(float(cost_fp)) + F.col("fn") * F.lit(float(cost_fn))
    cheapest = Window.orderBy("cost", "threshold")
    return sweep.select("threshold", "tp", "fp", "fn", "tn", cost.alias("cost")).withColumn(
        "is_best", (F.row_number().over(cheapest) == 1).cast("int")
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MAE, RMSE and R squared in one pass."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    spread = F.var_pop(y) * F.count(y)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
    )


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column, for comparisons across engines."""

    def one(name: str, kind: str) -> Column:
        return F.round(name, places).alias(name) if kind == "double" else F.col(name)

    return df.select(*[one(n, k) for n, k in df.dtypes])
