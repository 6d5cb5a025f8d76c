"""Cross-validation from sums per fold: the rows are read once, whatever the number of folds and penalties.

A model that is a function of sums needs no refit. The sums of every fold are taken in one pass; those of a training
side are the other folds' put together, and where the test score is a function of sums too (squared errors), it is read
from the fold's own. All results equal those of fitting anew on each training side.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.functions.comoments import Comoments, comoments
from veldt.functions.fitting import literal, small_frame

#: share of the largest variance that is added to every variance of the Bayes classifier
SMOOTHING = 1e-9


def others(per_fold: dict, fold) -> Comoments | None:
    """The sums of all folds but one."""
    rest = [m for f, m in per_fold.items() if f != fold]
    return reduce(Comoments.plus, rest) if rest else None


# --- least squares with a penalty -------------------------------------------------------------


def ridge_from(train: Comoments, alpha: float) -> tuple[float, np.ndarray]:
    """Intercept and slopes that minimise the sum of squares + alpha * |slopes|^2; the last column is the label.

    Without a penalty and with dependent columns, the shortest solution.
    """
    gram, cross = train.product[:-1, :-1], train.product[:-1, -1]
    penalty = alpha * np.eye(len(cross))
    slopes = np.linalg.lstsq(gram + penalty, cross, rcond=None)[0]
    return float(train.means[-1] - slopes @ train.means[:-1]), slopes


def squared_errors(test: Comoments, intercept: float, slopes: np.ndarray) -> tuple[float, float]:
    """Sum of squared errors of a linear model on rows known by their sums alone, and the label's own."""
    gram, cross, own = test.product[:-1, :-1], test.product[:-1, -1], test.product[-1, -1]
    n, means = test.sizes[-1], test.means
    offset = means[-1] - intercept - slopes @ means[:-1]
    return float(own - 2 * slopes @ cross + slopes @ gram @ slopes + n * offset * offset), float(own)


def ridge_folds(df: DataFrame, y: str, xs: list[str], fold: str, alphas: list[float]) -> list[tuple]:
    """(alpha, fold, n, rmse, r2) of every penalty and fold, from one pass; rows with a missing value are left out.

    r2 is None where the label does not vary in the fold. A table with a single fold has no training side and gives no
    rows.
    """
    sums = comoments(df, [*xs, y], [fold], complete=True)
    out = []
    for alpha in alphas:
        for (f,), test in sorted(sums.items(), key=lambda item: (item[0][0] is None, item[0][0])):
            train = others(sums, (f,))
            if train is None:
                continue
            error, own = squared_errors(test, *ridge_from(train, alpha))
            n = int(test.sizes[-1])
            out.append((float(alpha), f, n, math.sqrt(max(error, 0.0) / n), 1 - error / own if own > 0 else None))
    return out


def ridge_search(df: DataFrame, y: str, xs: list[str], fold: str, alphas: list[float]) -> DataFrame:
    """(alpha, folds, mean_rmse, sd_rmse, mean_r2, is_best) per penalty; the least mean error is best, of equal ones the
    smaller penalty."""
    rows = ridge_folds(df, y, xs, fold, alphas)
    out = []
    for alpha in dict.fromkeys(float(a) for a in alphas):
        errors = [r[3] for r in rows if r[0] == alpha]
        shares = [r[4] for r in rows if r[0] == alpha and r[4] is not None]
        if errors:
            out.append((alpha, len(errors), float(np.mean(errors)), float(np.std(errors)), float(np.mean(shares)) if shares else None))
    best = min(out, key=lambda r: (r[2], r[0]))[0] if out else None
    kinds = {"alpha": "double", "folds": "int", "mean_rmse": "double", "sd_rmse": "double", "mean_r2": "double", "is_best": "int"}
    frame = small_frame(df.sparkSession, kinds, [(*r, int(r[0] == best)) for r in out] or [(None,) * 6])
    return frame.filter("alpha IS NOT NULL")


# --- recursive elimination of columns ---------------------------------------------------------


def without(sums: Comoments, keep: list[int]) -> Comoments:
    """The sums of some of the columns."""
    at = np.ix_(keep, keep)
    return Comoments(sums.n[at], sums.mean[at], sums.square[at], sums.product[at])


def eliminate(df: DataFrame, y: str, xs: list[str], fold: str, alpha: float = 0.0) -> tuple[list[tuple], list[str]]:
    """Drop the least important column again and again, judged on left-out folds: ([(columns, mean error, dropped
    next)], the columns kept).

    A column's importance is its slope times its deviation in a fit to all folds. Every fit and every score comes from
    the sums of one pass. Kept are the columns with the least mean error, of equal ones the fewest; of equally
    important columns the later one goes first. No complete rows, or a single fold, keep every column.
    """
    sums = comoments(df, [*xs, y], [fold], complete=True)
    left, path = list(range(len(xs))), []
    if len(sums) < 2:
        return [], list(xs)
    while left:
        own = {f: without(m, [*left, len(xs)]) for f, m in sums.items()}
        errors = []
        for f, test in own.items():
            error, _ = squared_errors(test, *ridge_from(others(own, f), alpha))
            errors.append(math.sqrt(max(error, 0.0) / test.sizes[-1]))
        total = reduce(Comoments.plus, own.values())
        weight = np.abs(ridge_from(total, alpha)[1]) * np.sqrt(total.variances[:-1])
        least = len(left) - 1 - int(np.argmin(weight[::-1]))
        path.append(([xs[i] for i in left], float(np.mean(errors)), xs[left[least]]))
        left.pop(least)
    best = min(path, key=lambda p: (p[1], len(p[0])))
    return path, best[0]


def select_recursively(df: DataFrame, y: str, xs: list[str], fold: str, alpha: float = 0.0) -> tuple[DataFrame, list[str]]:
    """``df`` without the columns that ``eliminate`` drops, and the names of those kept."""
    _, kept = eliminate(df, y, xs, fold, alpha)
    return df.drop(*[x for x in xs if x not in kept]), kept


# --- Gaussian Bayes ---------------------------------------------------------------------------


def bayes_scores(classes: dict, xs: list[str]) -> dict:
    """The log-likelihood of a row under each class, as columns: priors and normal densities from the class's sums."""
    total = sum(m.sizes[0] for m in classes.values())
    # the smoothing follows the largest variance over all rows of the training side
    spread = reduce(Comoments.plus, classes.values()).variances.max()
    out = {}
    for name, moments in classes.items():
        variance = moments.variances + SMOOTHING * spread
        score: Column = literal(math.log(moments.sizes[0] / total))
        for x, mean, var in zip(xs, moments.means, variance, strict=True):
            if var <= 0:
                continue  # no column varies anywhere
            gap = F.col(x) - literal(mean)
            score = score - literal(0.5 * math.log(2 * math.pi * var)) - gap * gap / literal(2 * var)
        out[name] = score
    return out


def most_likely(scores: dict) -> Column:
    """The class with the highest score; of equal scores the least class."""
    ordered = sorted(scores)
    best = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    return F.coalesce(*[F.when(scores[c] == best, F.lit(c)) for c in ordered])


def bayes_out_of_fold(df: DataFrame, y: str, xs: list[str], fold: str, name: str = "prediction") -> DataFrame:
    """Add the class that Bayes models, one per fold and fitted on the other folds, give each row of their fold.

    One pass takes the sums of every fold and class; the models are literals. A class that the training side lacks
    cannot be predicted there; rows with a missing value are not learned from and predicted NULL, and so is all of a
    single fold.
    """
    sums = comoments(df.filter(F.col(y).isNotNull()), xs, [fold, y], complete=True)
    chosen: Column = F.lit(None).cast(df.schema[y].dataType)
    for f in sorted({g[0] for g in sums}, key=lambda v: (v is None, v)):
        classes: dict = {}
        for (g, c), moments in sums.items():
            if g != f:
                classes[c] = classes[c].plus(moments) if c in classes else moments
        if classes:
            present = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in xs])
            here = F.col(fold).eqNullSafe(F.lit(f)) & present
            chosen = F.when(here, most_likely(bayes_scores(classes, xs))).otherwise(chosen)
    return df.withColumn(name, chosen)


def fold_accuracy(df: DataFrame, y: str, prediction: str, fold: str) -> DataFrame:
    """(fold, n, accuracy) from out-of-fold predictions."""
    hit = F.coalesce((F.col(y) == F.col(prediction)).cast("double"), F.lit(0.0))
    return df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def bayes_cross_validate(df: DataFrame, y: str, xs: list[str], fold: str) -> DataFrame:
    """(folds, mean, sd) of the accuracy over folds, sd by the number of folds; two passes over the rows."""
    folds = fold_accuracy(bayes_out_of_fold(df, y, xs, fold), y, "prediction", fold)
    return folds.agg(F.count(F.lit(1)).alias("folds"), F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("sd"))
