"""Folds, searches and comparisons."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from veldt.functions.fitting import small_frame
from veldt.operators import features as f
from veldt.operators import folds as fo
from veldt.operators import models as mo
from veldt.operators import tuning as t
from veldt.operators.metrics import rounded
from veldt.plans.models import noisy_purchases
from veldt.plans.registry import query, table


@query(
    "kfold_stratified",
    """SELECT o_orderkey, o_orderstatus, ((row_number() OVER (PARTITION BY o_orderstatus
ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) - 1) % 5)::INTEGER AS fold FROM orders""",
)
def kfold_stratified(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return mo.stratified_folds(rows, "o_orderkey", "o_orderstatus", 5)


# all folds of a Bayes model: the training side of a fold is every other fold
FOLDED = """WITH e AS (SELECT event_id, value / 100 AS x, json_extract_string(props, '$.k')::DOUBLE / 10 AS z,
((value > 60) <> (event_id % 4 = 0))::INTEGER AS y FROM events),
d AS (SELECT *, ((row_number() OVER (PARTITION BY y ORDER BY md5(event_id::VARCHAR), event_id) - 1) % 5)::INTEGER AS fold FROM e)
"""
BAYES_FOLDS = FOLDED + """, g AS (SELECT DISTINCT fold AS f FROM d),
t AS (SELECT f, y AS c, count(*) AS n, avg(x) AS mx, var_pop(x) AS vx, avg(z) AS mz, var_pop(z) AS vz
FROM d JOIN g ON fold <> f GROUP BY ALL),
w AS (SELECT f, count(*) AS total, 1e-9 * greatest(var_pop(x), var_pop(z)) AS extra FROM d JOIN g ON fold <> f GROUP BY f),
s AS (SELECT event_id, fold, y, c, ln(n / total) - 0.5 * ln(2 * pi() * (vx + extra)) - pow(x - mx, 2) / (2 * (vx + extra))
- 0.5 * ln(2 * pi() * (vz + extra)) - pow(z - mz, 2) / (2 * (vz + extra)) AS score
FROM d JOIN t ON fold = t.f JOIN w ON fold = w.f),
p AS (SELECT fold, y, c AS prediction FROM s QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY score DESC, c) = 1),
a AS (SELECT fold, count(*) AS n, avg((y = prediction)::INT) AS accuracy FROM p GROUP BY fold)
"""


def folded(spark, folder):
    k = F.get_json_object("props", "$.k").cast("double") / 10
    rows = noisy_purchases(spark, folder).join(table(spark, folder, "events").select("event_id", k.alias("z")), "event_id")
    return mo.stratified_folds(rows, "event_id", "y", 5)


@query(
    "cross_validate",
    BAYES_FOLDS
    + "SELECT count(*) AS folds, round(avg(accuracy), 6) AS mean, round(stddev_pop(accuracy), 6) AS sd FROM a",
)
def cross_validate(spark, folder):
    return rounded(fo.bayes_cross_validate(folded(spark, folder), "y", ["x", "z"], "fold"))


@query("cross_validate_folds", BAYES_FOLDS + "SELECT fold, n, round(accuracy, 6) AS accuracy FROM a")
def cross_validate_folds(spark, folder):
    scored = fo.bayes_out_of_fold(folded(spark, folder), "y", ["x", "z"], "fold")
    return rounded(fo.fold_accuracy(scored, "y", "prediction", "fold"))


ALPHAS = [0.0, 1000.0, 100000.0, 10000000.0]


@query(
    "grid_search",
    """WITH d AS (SELECT (l_orderkey % 5)::INTEGER AS fold, l_quantity AS x, l_discount * 100 AS z,
l_extendedprice / 1000 + l_quantity - l_discount * 300 AS y FROM lineitem),
g AS (SELECT DISTINCT fold AS f FROM d),
t AS (SELECT f, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, count(*) * var_pop(x) AS xx, count(*) * var_pop(z) AS zz,
count(*) * covar_pop(x, z) AS xz, count(*) * covar_pop(x, y) AS xy, count(*) * covar_pop(z, y) AS zy
FROM d JOIN g ON fold <> f GROUP BY f),
q AS (SELECT f, alpha, mx, mz, my, (xy * (zz + alpha) - zy * xz) / ((xx + alpha) * (zz + alpha) - xz * xz) AS bx,
(zy * (xx + alpha) - xy * xz) / ((xx + alpha) * (zz + alpha) - xz * xz) AS bz
FROM t, unnest([0.0, 1000.0, 100000.0, 10000000.0]::DOUBLE[]) AS u(alpha)),
e AS (SELECT alpha, fold, sqrt(avg(pow(y - my - bx * (x - mx) - bz * (z - mz), 2))) AS rmse,
1 - sum(pow(y - my - bx * (x - mx) - bz * (z - mz), 2)) / (count(*) * var_pop(y)) AS r2
FROM d JOIN q ON fold = f GROUP BY alpha, fold),
r AS (SELECT alpha, count(*)::INTEGER AS folds, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS sd_rmse, avg(r2) AS mean_r2 FROM e GROUP BY alpha)
SELECT alpha, folds, round(mean_rmse, 6) AS mean_rmse, round(sd_rmse, 6) AS sd_rmse, round(mean_r2, 6) AS mean_r2,
(row_number() OVER (ORDER BY mean_rmse, alpha) = 1)::INTEGER AS is_best FROM r""",
)
def grid_search(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 5).cast("int").alias("fold"),
        F.col("l_quantity").alias("x"),
        (F.col("l_discount") * 100).alias("z"),
        (F.col("l_extendedprice") / 1000 + F.col("l_quantity") - F.col("l_discount") * 300).alias("y"),
    )
    return rounded(fo.ridge_search(rows, "y", ["x", "z"], "fold", ALPHAS))


@query("feature_select_recursive")
def feature_select_recursive(spark, folder):
    """Columns of a planted rent in the order in which they go, and whether the best set keeps them."""
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 5).cast("int").alias("fold"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        (F.crc32(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").cast("binary")) % 1000).cast("double").alias("noise"),
        (F.col("l_extendedprice") / 1000 + F.col("l_quantity") - F.col("l_discount") * 300).alias("y"),
    )
    path, kept = fo.eliminate(rows, "y", ["quantity", "discount", "tax", "noise"], "fold")
    out = [(i + 1, gone, len(columns), error, int(gone in kept)) for i, (columns, error, gone) in enumerate(path)]
    kinds = {"step": "int", "feature": "string", "columns": "int", "mean_rmse": "double", "kept": "int"}
    return rounded(small_frame(spark, kinds, out))


@query("cross_validate_refit")
def cross_validate_refit(spark, folder):
    rows = mo.stratified_folds(noisy_purchases(spark, folder), "event_id", "y", 3)
    mean, sd = t.cross_validate(rows, LogisticRegression(), "y", ["x"], "accuracy", "fold", 3)
    return rounded(t.score_table(rows, [("default", mean, sd)]))


@query("grid_search_refit")
def grid_search_refit(spark, folder):
    rows = mo.stratified_folds(noisy_purchases(spark, folder), "event_id", "y", 3)
    params = {"maxDepth": [1, 3], "minInstancesPerNode": [1, 20]}
    _, scores = t.grid_search(
        rows, DecisionTreeClassifier(seed=7), "y", ["x"], params, "accuracy", "fold", 3
    )
    return rounded(t.score_table(rows, scores))


# a deterministic prediction for the reports: the value against a cut that depends on the side
SCORED = """WITH e AS (SELECT event_id, ((value > 60) <> (event_id % 4 = 0))::INTEGER AS y, value,
CASE WHEN row_number() OVER (ORDER BY md5(event_id::VARCHAR), event_id) <= ceil(0.25 * count(*) OVER ())
THEN 'test' ELSE 'train' END AS split FROM events),
p AS (SELECT y, split, (value > CASE split WHEN 'train' THEN 60 ELSE 80 END)::INTEGER AS prediction,
(value > 40)::INTEGER AS low_cut, 1 AS always FROM e)
"""


def scored(spark, folder):
    both = f.split(noisy_purchases(spark, folder), "event_id", 0.25)
    cut = F.when(F.col("split") == "train", 60).otherwise(80)
    return both.withColumns(
        {
            "prediction": (F.col("value") > cut).cast("int"),
            "low_cut": (F.col("value") > 40).cast("int"),
            "always": F.lit(1),
        }
    )


@query(
    "overfit_report",
    SCORED
    + """SELECT round(avg((y = prediction)::INT) FILTER (split = 'train'), 6) AS train_accuracy,
round(avg((y = prediction)::INT) FILTER (split = 'test'), 6) AS test_accuracy,
round(avg((y = prediction)::INT) FILTER (split = 'train') - avg((y = prediction)::INT)
FILTER (split = 'test'), 6) AS gap FROM p""",
)
def overfit_report(spark, folder):
    return rounded(t.overfit_report(scored(spark, folder), "y", "prediction", "split"))


@query(
    "compare_models",
    SCORED
    + """SELECT 'prediction' AS model, round(avg((y = prediction)::INT), 6) AS accuracy FROM p
UNION ALL SELECT 'low_cut', round(avg((y = low_cut)::INT), 6) FROM p
UNION ALL SELECT 'always', round(avg((y = always)::INT), 6) FROM p""",
)
def compare_models(spark, folder):
    names = ["prediction", "low_cut", "always"]
    return rounded(t.compare_columns(scored(spark, folder), "y", names))
