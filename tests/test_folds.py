"""Moments in one pass, cross-validation from sums per fold, permutation importance."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from veldt.functions import comoments as cm
from veldt.operators import eda, features, folds, importance
from veldt.operators import models as mo
from veldt.operators import stats

COLUMNS = ["a", "b", "c", "d"]


def numbers(n=900):
    r = random.Random(11)
    rows = []
    for i in range(n):
        a = r.gauss(1e6, 1)
        rows.append((i, i % 5, a, a * 2 + r.gauss(0, 1) if i % 4 else None, r.choice([None, r.gauss(0, 3)]), 0.1))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(numbers(), "id int, fold int, a double, b double, c double, d double").repartition(7)


def test_pairwise_moments(table):
    data = np.array([[np.nan if v is None else v for v in r[2:]] for r in numbers()], float)
    found = cm.comoments(table, COLUMNS)[()]
    for i in range(4):
        for j in range(4):
            both = data[~np.isnan(data[:, [i, j]]).any(axis=1)]
            assert found.n[i, j] == len(both)
            x, y = both[:, i] - both[:, i].mean(), both[:, j] - both[:, j].mean()
            assert math.isclose(found.product[i, j], x @ y, rel_tol=1e-7, abs_tol=1e-5)
            assert math.isclose(found.square[i, j], x @ x, rel_tol=1e-7, abs_tol=1e-5)
    r = {(x["a"], x["b"]): x["r"] for x in eda.corr(table, COLUMNS).collect()}
    assert r["a", "d"] is None and r["c", "d"] is None
    want = np.ma.corrcoef(np.ma.masked_invalid(data[:, 0]), np.ma.masked_invalid(data[:, 1]))[0, 1]
    assert abs(r["a", "b"] - want) < 1e-6


def test_groups_hold_the_null_key_and_no_rows_give_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (2, 5.0), (2, None)], "g int, x double")
    found = cm.comoments(df, ["x"], ["g"])
    assert {g: (m.sizes[0], m.means[0]) for g, m in found.items()} == {(None,): (2, 2.0), (2,): (1, 5.0)}
    assert cm.comoments(df.limit(0), ["x"], ["g"]) == {}
    assert cm.comoments(df.limit(0), ["x"])[()].sizes[0] == 0


def test_two_hundred_columns_in_one_stage(spark):
    wide = spark.range(400).select(*[F.rand(i).alias(f"x{i}") for i in range(200)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("wide", "")
    matrix = stats.correlation_matrix(wide, wide.columns)
    jobs = tracker.getJobIdsForGroup("wide")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert matrix.shape == (200, 200) and np.allclose(matrix, matrix.T) and len(jobs) == 1


def test_ridge_folds_equal_refits(table):
    rows = table.withColumn("c", F.coalesce("c", F.lit(0.0))).filter("b IS NOT NULL").withColumn("a", F.col("a") - 1e6)
    data = np.array([[r["a"], r["c"], r["b"], r["fold"]] for r in rows.collect()])
    for alpha, f, n, rmse, r2 in folds.ridge_folds(rows, "b", ["a", "c"], "fold", [0.0, 10.0, 1e4]):
        train, test = data[data[:, 3] != f], data[data[:, 3] == f]
        x, y = train[:, :2] - train[:, :2].mean(axis=0), train[:, 2] - train[:, 2].mean()
        slopes = np.linalg.solve(x.T @ x + alpha * np.eye(2), x.T @ y)
        error = test[:, 2] - train[:, 2].mean() - (test[:, :2] - train[:, :2].mean(axis=0)) @ slopes
        assert n == len(test) and math.isclose(rmse, math.sqrt((error**2).mean()), rel_tol=1e-6)
        assert math.isclose(r2, 1 - (error**2).sum() / ((test[:, 2] - test[:, 2].mean()) ** 2).sum(), abs_tol=1e-6)
    best = folds.ridge_search(rows, "b", ["a", "c"], "fold", [0.0, 10.0, 1e4]).filter("is_best = 1").collect()
    assert len(best) == 1 and best[0]["folds"] == 5


def test_ridge_edges(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 2.0), (0, None, 3.0)], "fold int, x double, y double")
    assert folds.ridge_search(df, "y", ["x"], "fold", [0.0]).count() == 0  # one fold has no other side
    twin = spark.createDataFrame([(i % 2, float(i), float(i), 3.0 * i) for i in range(8)], "fold int, x double, z double, y double")
    assert folds.ridge_search(twin, "y", ["x", "z"], "fold", [0.0]).first()["mean_rmse"] < 1e-6


def test_bayes_folds_equal_refits(spark):
    r = random.Random(2)
    rows = [(i, i % 3, r.choice("uvw"), r.gauss(0, 1), r.gauss(0, 2)) for i in range(300)]
    rows = [(i, f, y, x + ord(y) - 118, None if i == 7 else z) for i, f, y, x, z in rows] + [(900, 0, None, 0.1, 0.1), (901, None, "u", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id int, fold int, y string, x double, z double").repartition(4)
    found = {r["id"]: r["prediction"] for r in folds.bayes_out_of_fold(df, "y", ["x", "z"], "fold").collect()}
    assert found[7] is None
    for i, f, _, x, z in rows:
        if z is None:
            continue
        side = [s for s in rows if s[1] != f and s[2] is not None and s[4] is not None]
        spread = 1e-9 * np.var([[s[3], s[4]] for s in side], axis=0).max()
        best = None
        for c in "uvw":
            own = np.array([[s[3], s[4]] for s in side if s[2] == c])
            var = own.var(axis=0) + spread
            score = math.log(len(own) / len(side)) - (0.5 * np.log(2 * np.pi * var) + (np.array([x, z]) - own.mean(axis=0)) ** 2 / (2 * var)).sum()
            best = (score, c) if best is None or score > best[0] + 1e-12 else best
        assert found[i] == best[1]


def test_permutation_takes_every_donor_once(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(500)], "id int, x double, y int").repartition(6)
    moved = importance.donors(df, "id", ["x"], "-s").collect()
    assert sorted(r["__donor_x"] for r in moved) == [float(i) for i in range(500)]
    assert sum(r["__donor_x"] != r["x"] for r in moved) > 480


def test_importance_of_boosted_trees(spark):
    r = random.Random(4)
    rows = [(i, r.random(), r.random(), r.random()) for i in range(800)]
    df = spark.createDataFrame([(i, a, b, c, int(a + 0.3 * b > 0.7)) for i, a, b, c in rows], "id int, a double, b double, noise double, y int")
    model = mo.fit(GBTClassifier(maxIter=8, maxDepth=3, seed=1), df, ["a", "b", "noise"], "y")
    found = {x["feature"]: x["importance"] for x in importance.permutation_importance(df, "id", "y", ["a", "b", "noise"], lambda d: mo.predict(model, d, ["a", "b", "noise"])).collect()}
    assert found["a"] > found["b"] > found["noise"] and abs(found["noise"]) < 0.05
    empty = importance.permutation_importance(df.limit(0), "id", "y", ["a"], lambda d: d.withColumn("prediction", F.lit(1)))
    assert empty.first()["importance"] is None


def test_rank_features_by_matrix(table):
    found = {r["feature"]: r["score"] for r in features.rank_features(table, "a", ["b", "c", "d"], "correlation").collect()}
    assert found["d"] is None and found["b"] > 0.8 > found["c"]


def test_elimination_drops_planted_noise_first(spark):
    r = random.Random(9)
    rows = []
    for i in range(600):
        a, b, n1, n2 = r.gauss(0, 1), r.gauss(5, 2), r.gauss(0, 1), r.gauss(100, 30)
        rows.append((i % 4, a, b, n1, n2, 3 * a - b + r.gauss(0, 0.5)))
    df = spark.createDataFrame(rows, "fold int, a double, b double, n1 double, n2 double, y double").repartition(3)
    path, kept = folds.eliminate(df, "y", ["n1", "a", "n2", "b"], "fold")
    assert {gone for _, _, gone in path[:2]} == {"n1", "n2"} and {"a", "b"} <= set(kept)
    data = np.array(rows)
    at = {"a": 1, "b": 2, "n1": 3, "n2": 4}
    for columns, error, _ in path:
        errors = []
        for f in range(4):
            train, test = data[data[:, 0] != f], data[data[:, 0] == f]
            x = np.column_stack([np.ones(len(train)), train[:, [at[c] for c in columns]]])
            w = np.linalg.lstsq(x, train[:, 5], rcond=None)[0]
            z = np.column_stack([np.ones(len(test)), test[:, [at[c] for c in columns]]])
            errors.append(math.sqrt(((test[:, 5] - z @ w) ** 2).mean()))
        assert math.isclose(error, np.mean(errors), rel_tol=1e-9)
    smaller, names = folds.select_recursively(df, "y", ["n1", "a", "n2", "b"], "fold")
    assert set(smaller.columns) == {"fold", "y", *names}
    assert folds.eliminate(df.filter("fold = 1"), "y", ["a", "b"], "fold") == ([], ["a", "b"])
