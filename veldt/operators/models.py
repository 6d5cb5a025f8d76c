"""Regression, classification and clustering models, on Spark ML where it has them.

``train_*`` style functions return fitted Spark models; ``predict`` adds their output to a frame.
Feature columns are plain doubles; they are assembled here.
"""

from __future__ import annotations

import warnings
from functools import reduce

import numpy as np
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import regression as R
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.functions.comoments import comoments
from veldt.functions.fitting import fit_counts, fit_row, literal, small_frame
from veldt.functions.ordered import hashed_positions
from veldt.operators.features import standardize
from veldt.operators.metrics import cost_curve
from veldt.session import ROWS_PER_TASK, tasks_for, training_cache

FEATURES = "__features"
LABEL = "__label"


def assemble(df: DataFrame, xs: list[str]) -> DataFrame:
    """Add the feature vector column."""
    return VectorAssembler(inputCols=xs, outputCol=FEATURES).transform(df)


def fit(estimator, train: DataFrame, xs: list[str], y: str | None = None, weight: str | None = None):
    """Fit on the needed columns, assembled.

    Iterative fits get a cached copy; those that read the rows once are given the rows as they come.
    """
    others = []
    if y is not None:
        others.append(F.col(y).cast("double").alias(LABEL))
        estimator = estimator.copy().setLabelCol(LABEL)
    if weight is not None:
        others.append(F.col(weight))
        estimator = estimator.copy().setWeightCol(weight)
    estimator = estimator.copy().setFeaturesCol(FEATURES)
    if isinstance(estimator, C.RandomForestClassifier):
        # plain numbers are grouped and moved for much less than vectors
        plain = {f"__x{i}": F.col(x).cast("double") for i, x in enumerate(xs)}
        dealt = in_fixed_layout(train.select(*[c.alias(n) for n, c in plain.items()], *others))
        data = assemble(dealt, list(plain)).drop(*plain)
    else:
        data = assemble(train, xs).select(FEATURES, *others)
    if isinstance(estimator, C.NaiveBayes) or isinstance(estimator, R.LinearRegression) and estimator.getSolver() == "normal":
        return estimator.fit(data)
    with training_cache(data) as rows:
        return estimator.fit(rows)


#: equal rows that are made in one go when a layout is dealt
COPIES = 10_000


def in_fixed_layout(data: DataFrame) -> DataFrame:
    """Rows dealt and sorted by their values, so that draws made per partition do not depend on how a table was read.

    The number of partitions follows the rows. Equal rows are counted before they move and dealt by their number, so a
    row that a third of the table repeats fills no partition.
    """
    plain = data.select(*[vector_to_array(F.col(c)).alias(c) if c == FEATURES else F.col(c) for c in data.columns])
    parts = tasks_for(data.count(), ROWS_PER_TASK)
    counted = plain.groupBy(*data.columns).agg(F.count(F.lit(1)).alias("__n"))
    runs = counted.withColumn("__run", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / COPIES)))).withColumn("__run", F.col("__run") * COPIES)
    copies = runs.withColumn("__copy", F.explode(F.sequence(F.col("__run"), F.least(F.col("__n"), F.col("__run") + COPIES) - 1)))
    place = F.xxhash64(*data.columns, "__copy")
    dealt = copies.repartition(parts, place).sortWithinPartitions(place)
    return dealt.select(*[array_to_vector(F.col(c)).alias(c) if c == FEATURES else F.col(c) for c in data.columns])


def predict(
    model, df: DataFrame, xs: list[str], name: str = "prediction", score: str | None = None
) -> DataFrame:
    """Add ``name``; with ``score`` also the positive-class probability (or margin, if no probability)."""
    out = predict_vectors(model, assemble(df, xs), name, score)
    return out.drop(FEATURES)


def predict_vectors(model, df: DataFrame, name: str, score: str | None = None) -> DataFrame:
    """As ``predict``, for a frame that already holds the feature vector."""
    if isinstance(model, C.OneVsRestModel):
        return _predict_rest(model, df, name)
    model = model.copy().setPredictionCol(name)
    for parameter, setter in (
        ("probabilityCol", "setProbabilityCol"),
        ("rawPredictionCol", "setRawPredictionCol"),
    ):
        if model.hasParam(parameter) and hasattr(model, setter):
            getattr(model, setter)(f"__{parameter}")
    out = model.transform(df)
    added = [c for c in out.columns if c not in df.columns and c != name]
    if score is not None:
        source = "__probabilityCol" if "__probabilityCol" in added else "__rawPredictionCol"
        out = out.withColumn(score, vector_to_array(F.col(source))[1])
    return out.drop(*added)


def _predict_rest(model, df: DataFrame, name: str) -> DataFrame:
    """One-against-rest by the largest member margin, compared inside Spark (Spark's own wrapper
    would call a Python function per row)."""
    out = df
    for i, member in enumerate(model.models):
        member = member.copy().setRawPredictionCol(f"__raw{i}").setPredictionCol(f"__class{i}")
        if member.hasParam("probabilityCol"):
            member.setProbabilityCol("")
        out = member.transform(out)
    margins = F.array(*[vector_to_array(F.col(f"__raw{i}"))[1] for i in range(len(model.models))])
    best = F.array_position(margins, F.array_max(margins)) - 1
    return out.withColumn(name, best.cast("double")).select(*df.columns, name)


def coefficients(model, xs: list[str]) -> list[tuple[str, float]]:
    """(term, value) pairs, the intercept first."""
    return [("intercept", float(model.intercept))] + [
        (x, float(v)) for x, v in zip(xs, model.coefficients)
    ]


def coefficient_frame(df: DataFrame, model, xs: list[str]) -> DataFrame:
    return small_frame(
        df.sparkSession, {"term": "string", "value": "double"}, coefficients(model, xs)
    )


# --- regression -------------------------------------------------------------------------------


def linear(train: DataFrame, y: str, xs: list[str]):
    """Ordinary least squares: in one pass up to 4,096 features, step by step above."""
    solver = "normal" if len(xs) <= 4096 else "l-bfgs"
    return fit(R.LinearRegression(regParam=0.0, solver=solver, maxIter=500, tol=1e-9), train, xs, y)


def penalized(train: DataFrame, y: str, xs: list[str], l1: float, l2: float):
    """Least squares / (2n) + l1 * |b| + l2 / 2 * |b|^2, on unscaled features.

    Spark fits against the label divided by its population deviation, which leaves the L1 weight
    as given and divides the L2 weight by that deviation; the parameters undo it. The normal solver
    reads the rows once, into the matrix of feature products, and optimizes on that; above its
    4,096 features the rows are read per step, and Spark divides by the sample deviation.
    """
    one_pass = len(xs) <= 4096
    spread = F.stddev_pop if one_pass else F.stddev_samp
    deviation = fit_row(train, {"sd": spread(y)})["sd"] or 1.0
    total = l1 + l2 * deviation
    estimator = R.LinearRegression(
        regParam=total,
        elasticNetParam=(l1 / total) if total else 0.0,
        standardization=False,
        solver="normal" if one_pass else "l-bfgs",
        maxIter=500,
        tol=1e-12 if one_pass else 1e-6,
    )
    return fit(estimator, train, xs, y)


def ridge(train: DataFrame, y: str, xs: list[str], alpha: float):
    """Sum of squares + alpha * |b|^2."""
    return penalized(train, y, xs, 0.0, alpha / train.count())


def lasso(train: DataFrame, y: str, xs: list[str], alpha: float):
    """Mean squares / 2 + alpha * |b|."""
    return penalized(train, y, xs, alpha, 0.0)


def elastic(train: DataFrame, y: str, xs: list[str], alpha: float, l1_ratio: float):
    """Mean squares / 2 + alpha * (l1_ratio * |b| + (1 - l1_ratio) / 2 * |b|^2)."""
    return penalized(train, y, xs, alpha * l1_ratio, alpha * (1 - l1_ratio))


# --- classification ---------------------------------------------------------------------------


def logistic(
    train: DataFrame,
    y: str,
    xs: list[str],
    reg: float = 0.0,
    weight: str | None = None,
    tol: float = 1e-6,
):
    """Logistic regression, two or more classes; ``reg`` weighs half the squared coefficients."""
    estimator = C.LogisticRegression(
        regParam=reg, elasticNetParam=0.0, standardization=False, maxIter=200, tol=tol
    )
    return fit(estimator, train, xs, y, weight)


def odds_ratios(model, xs: list[str]) -> list[tuple[str, float]]:
    """exp(coefficient) per feature."""
    return [(x, float(np.exp(v))) for x, v in zip(xs, model.coefficients)]


def bayes(
    train: DataFrame, df: DataFrame, y: str, xs: list[str], name: str = "prediction"
) -> DataFrame:
    """Gaussian naive Bayes; classes are 0, 1, ...

    Spark adds 1e-9 of the largest feature variance to every variance.
    """
    return predict(fit(C.NaiveBayes(modelType="gaussian"), train, xs, y), df, xs, name)


def tree(train: DataFrame, y: str, xs: list[str], depth: int, bins: int = 64):
    return fit(C.DecisionTreeClassifier(maxDepth=depth, maxBins=bins, seed=7), train, xs, y)


def forest(
    train: DataFrame,
    y: str,
    xs: list[str],
    trees: int = 20,
    depth: int = 5,
    seed: int = 7,
    weight: str | None = None,
):
    estimator = C.RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)
    return fit(estimator, train, xs, y, weight)


def boosted(
    train: DataFrame, y: str, xs: list[str], rounds: int = 10, depth: int = 3, rate: float = 0.1
):
    """Gradient boosted trees; one binary model per class when there are more than two."""
    estimator = C.GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=7)
    return _binary_or_rest(estimator, train, y, xs)


def svm(train: DataFrame, y: str, xs: list[str], reg: float = 0.01):
    """Linear support vector machine; one against the rest when there are more than two classes."""
    return _binary_or_rest(machine(reg), train, y, xs)


def _binary_or_rest(estimator, train: DataFrame, y: str, xs: list[str]):
    if len(fit_counts(train, y)) > 2:
        estimator = C.OneVsRest(classifier=estimator)
    return fit(estimator, train, xs, y)


def fit_vectors(estimator, train: DataFrame, vector: str, y: str):
    """As ``fit``, for a frame that already holds the feature vector."""
    columns = [F.col(vector).alias(FEATURES), F.col(y).cast("double").alias(LABEL)]
    with training_cache(train.select(*columns)) as rows:
        model = estimator.copy().setFeaturesCol(FEATURES).setLabelCol(LABEL).fit(rows)
    if isinstance(model, C.LinearSVCModel) and not converged(model):
        warnings.warn(f"the machine did not converge in {model.getMaxIter()} steps", stacklevel=2)
    return model


def converged(model: C.LinearSVCModel) -> bool:
    """Whether training ended by the tolerance, not by the step limit."""
    return model.summary().totalIterations < model.getMaxIter()


def machine(reg: float = 0.01, steps: int = 100, tol: float = 1e-3) -> C.LinearSVC:
    """An unfitted linear support vector machine for two classes.

    The hinge loss has kinks, where the optimizer tries many step lengths, each a pass over the
    rows. Trained until the loss changes by less than ``tol``; ``fit_vectors`` warns where
    ``steps`` steps were not enough.
    """
    return C.LinearSVC(regParam=reg, maxIter=steps, tol=tol)


def sigmoid(margins: DataFrame, y: str, margin: str = "margin") -> tuple[float, float]:
    """Slope and offset of the logistic curve that maps margins to probabilities."""
    model = logistic(margins, y, [margin])
    return float(model.coefficients[0]), float(model.intercept)


def out_of_fold(
    df: DataFrame, estimator, y: str, vector: str, fold: str, folds: int, score: str = "margin"
) -> DataFrame:
    """(y, score): every row scored by a model that did not see its fold."""
    parts = []
    for i in range(folds):
        model = fit_vectors(estimator, df.filter(F.col(fold) != i), vector, y)
        held = df.filter(F.col(fold) == i).withColumnRenamed(vector, FEATURES)
        parts.append(predict_vectors(model, held, "__class", score).select(y, score))
    return reduce(DataFrame.unionByName, parts)


def calibrated(
    train: DataFrame, df: DataFrame, y: str, vector: str, fold: str, folds: int, estimator=None
) -> DataFrame:
    """Add ``p_<class>`` per class: a sigmoid per one-against-rest machine, scaled to sum to 1.

    With two classes one machine is enough and the other probability is its complement. ``train``
    holds fold numbers; margins for the sigmoid come from machines that did not see their rows.
    """
    estimator = estimator or machine()
    classes = sorted(fit_counts(train, y))
    targets = [classes[-1]] if len(classes) == 2 else classes
    out = df.withColumnRenamed(vector, FEATURES)
    for c in targets:
        binary = train.withColumn("__is", (F.col(y) == F.lit(c)).cast("int"))
        a, b = sigmoid(out_of_fold(binary, estimator, "__is", vector, fold, folds), "__is")
        model = fit_vectors(estimator, binary, vector, "__is")
        out = predict_vectors(model, out, "__class", "__margin")
        out = out.withColumn(f"p_{c}", 1 / (1 + F.exp(-(F.lit(a) * F.col("__margin") + F.lit(b)))))
        out = out.drop("__class", "__margin")
    out = out.withColumnRenamed(FEATURES, vector)
    if len(classes) == 2:
        return out.withColumn(f"p_{classes[0]}", 1 - F.col(f"p_{classes[1]}"))
    total = reduce(lambda a, b: a + b, [F.col(f"p_{c}") for c in classes])
    return out.withColumns({f"p_{c}": F.col(f"p_{c}") / total for c in classes})


def calibrated_svm(
    train: DataFrame, df: DataFrame, y: str, xs: list[str], key: str, folds: int = 3
) -> DataFrame:
    """``calibrated`` linear machines over plain columns."""
    placed = assemble(stratified_folds(train, key, y, folds), xs)
    placed = placed.select(y, "fold", F.col(FEATURES).alias("__vector"))
    scored = assemble(df, xs).withColumnRenamed(FEATURES, "__vector")
    with training_cache(placed) as rows:
        return calibrated(rows, scored, y, "__vector", "fold", folds).drop("__vector")


def importance(model, xs: list[str]) -> list[tuple[str, float]]:
    """(feature, share): tree importances, or absolute linear coefficients scaled to sum to 1.

    ``importance.permutation_importance`` works for every model, boosted trees included.
    """
    if hasattr(model, "featureImportances"):
        raw = [float(v) for v in model.featureImportances.toArray()]
    else:
        raw = [abs(float(v)) for v in model.coefficients]
    total = sum(raw) or 1.0
    return [(x, v / total) for x, v in zip(xs, raw)]


def baseline(train: DataFrame, df: DataFrame, y: str, name: str = "prediction") -> DataFrame:
    """Always the most frequent training class (the smallest one on ties)."""
    counts = fit_counts(train, y)
    return df.withColumn(name, F.lit(min(counts, key=lambda c: (-counts[c], c))))


def soft_vote(df: DataFrame, scores: list[str], name: str = "score") -> DataFrame:
    """Mean of member probabilities held in columns of one frame."""
    return weighted_vote(df, {s: 1.0 for s in scores}, name)


def weighted_vote(df: DataFrame, weights: dict[str, float], name: str = "score") -> DataFrame:
    total = float(sum(weights.values()))
    terms = [F.col(c) * F.lit(float(w)) for c, w in weights.items()]
    return df.withColumn(name, reduce(lambda a, b: a + b, terms) / F.lit(total))


def join_scores(frames: dict[str, DataFrame], key: str, score: str) -> DataFrame:
    """Scores of several members, given as separate frames, side by side."""
    named = [f.select(key, F.col(score).alias(n)) for n, f in frames.items()]
    return reduce(lambda a, b: a.join(b, key), named)


def risk_vote(
    train: DataFrame,
    df: DataFrame,
    label: str,
    weights: dict[str, float],
    grid: list[float],
    cost_fp: float,
    cost_fn: float,
) -> tuple[DataFrame, float]:
    """Weighted member mean, cut at the threshold that costs least on ``train``."""
    curve = cost_curve(weighted_vote(train, weights), label, "score", grid, cost_fp, cost_fn)
    threshold = curve.filter("is_best = 1").first()["threshold"]
    scored = weighted_vote(df, weights)
    return scored.withColumn(
        "prediction", (F.col("score") >= F.lit(threshold)).cast("int")
    ), threshold


def stratified_folds(df: DataFrame, key: str, y: str, folds: int, name: str = "fold") -> DataFrame:
    """Fold numbers 0..folds-1 that keep class shares, dealt in md5(key) order."""
    placed = hashed_positions(df, [y], key)
    number = ((F.col("position") - 1) % folds).cast("int")
    return placed.withColumn(name, number).drop("position", "group_rows")


# --- components and clusters ------------------------------------------------------------------


def pca(
    train: DataFrame, df: DataFrame, xs: list[str], k: int
) -> tuple[DataFrame, list[list[float]], list[float]]:
    """Principal components of standardised columns: (scores pc1..pck, loadings, explained shares).

    The products of all columns come from one pass over the complete rows of ``train``; a column
    that does not vary has no part in any component. Each component is turned so that its largest
    loading (the first one on ties) is positive.
    """
    products = comoments(train, xs, complete=True)[()].correlations()
    varied = ~np.isnan(np.diagonal(products))
    values, vectors = np.linalg.eigh(np.where(varied[:, None] & varied, products, 0.0))
    values, matrix = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    loadings = []
    for j in range(k):
        column = matrix[:, j]
        size = np.abs(column)
        lead = int(np.flatnonzero(size >= size.max() - 1e-9)[0])
        loadings.append([float(v) for v in (column if column[lead] >= 0 else -column)])
    scored = standardize(train, df, xs)
    components = {
        f"pc{j + 1}": reduce(lambda a, b: a + b, [F.col(x) * F.lit(w) for x, w in zip(xs, ws)])
        for j, ws in enumerate(loadings)
    }
    explained = [float(v / (values.sum() or 1.0)) for v in values[:k]]
    return scored.withColumns(components), loadings, explained


def nearest_center(xs: list[str], centers: list[list[float]]) -> Column:
    """Index of the closest centre; the lower index on ties."""
    distances = []
    for i, center in enumerate(centers):
        gaps = [(F.col(x) - F.lit(float(v))) * (F.col(x) - F.lit(float(v))) for x, v in zip(xs, center)]
        distances.append(F.struct(reduce(lambda a, b: a + b, gaps).alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*distances))["i"]


def kmeans(
    df: DataFrame, xs: list[str], start: list[list[float]], steps: int, places: int | None = None
) -> list[list[float]]:
    """Lloyd steps from given centres.

    Centres are literals in the assign expression and each step is one map-side combined
    aggregate, so neither the plan nor the driver grows with rows or steps. A centre that loses
    all its rows stays where it was.
    """
    centers = [list(c) for c in start]
    with training_cache(df.select(*xs)) as rows:
        for _ in range(steps):
            cluster = nearest_center(xs, centers).alias("cluster")
            means = rows.groupBy(cluster).agg(*[F.avg(x).alias(x) for x in xs]).collect()
            for mean in means:
                centers[mean["cluster"]] = [_rounded(mean[x], places) for x in xs]
    return centers


def _rounded(value: float, places: int | None) -> float:
    return value if places is None else float(np.floor(value * 10**places + 0.5) / 10**places)


def assign(df: DataFrame, xs: list[str], centers: list[list[float]]) -> DataFrame:
    return df.withColumn("cluster", nearest_center(xs, centers))


def centroids(df: DataFrame, cluster: str, xs: list[str]) -> DataFrame:
    """Size and mean of each cluster."""
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(x) for x in xs]
    )


def segment_profile(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """Share of rows, and per column the cluster mean over the overall mean."""
    overall = fit_row(df, {"__n": F.count(F.lit(1)), **{c: F.avg(c) for c in columns}})
    return df.groupBy(cluster).agg(
        (F.count(F.lit(1)) / literal(overall["__n"])).alias("share"),
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.try_divide(F.avg(c), literal(overall[c])).alias(f"lift_{c}") for c in columns],
    )


def choose_k(df: DataFrame, xs: list[str], ks: list[int], seed: int = 7) -> list[tuple]:
    """(k, inertia, silhouette) for each k; the silhouette is Spark's, from cluster moments."""
    judge = ClusteringEvaluator(featuresCol=FEATURES, predictionCol="cluster")
    scores = []
    with training_cache(assemble(df, xs).select(FEATURES)) as rows:
        for k in ks:
            estimator = K.KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol="cluster")
            model = estimator.fit(rows)
            inertia = float(model.summary.trainingCost)
            scores.append((k, inertia, float(judge.evaluate(model.transform(rows)))))
    return scores
