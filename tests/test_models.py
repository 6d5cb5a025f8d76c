"""Properties of models, on planted labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veldt.operators import metrics as m
from veldt.operators import models as mo
from veldt.operators import projects as p
from veldt.operators import tuning as t


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select(
        F.col("id").alias("key"),
        (F.col("id") * 17 % 101 / 10.0).alias("a"),
        (F.col("id") * 29 % 53 / 10.0).alias("b"),
        (F.col("id") * 7 % 31 / 10.0).alias("noise"),
    )
    return df.withColumns(
        {
            "y": ((F.col("a") + F.col("b") > 8) != (F.col("key") % 25 == 0)).cast("int"),
            "band": F.when(F.col("a") < 3, 0).when(F.col("a") < 7, 1).otherwise(2),
            "target": 3 * F.col("a") - F.col("b") + F.col("key") % 3,
        }
    ).cache()


def hits(scored, label):
    return m.accuracy(scored, label, "prediction").first()["accuracy"]


@pytest.mark.parametrize("fit", [mo.logistic, mo.tree, mo.forest, mo.boosted, mo.svm])
def test_two_classes_beat_the_baseline(rows, fit):
    xs = ["a", "b"]
    args = (3,) if fit is mo.tree else ()
    guess = hits(mo.baseline(rows, rows, "y"), "y")
    assert hits(mo.predict(fit(rows, "y", xs, *args), rows, xs), "y") > guess + 0.1


@pytest.mark.parametrize("fit", [mo.logistic, mo.boosted, mo.svm])
def test_three_classes_beat_the_baseline(rows, fit):
    guess = hits(mo.baseline(rows, rows, "band"), "band")
    assert hits(mo.predict(fit(rows, "band", ["a", "b"]), rows, ["a", "b"]), "band") > guess


def test_lasso_drops_more_as_the_penalty_grows(rows):
    xs = ["a", "b", "noise"]
    zeros = [
        sum(abs(c) < 1e-9 for c in mo.lasso(rows, "target", xs, alpha).coefficients)
        for alpha in (0.0, 1.0, 50.0)
    ]
    assert zeros == sorted(zeros) and zeros[-1] == 3


@pytest.mark.parametrize("ratio", [0.0, 0.5, 1.0])
def test_elastic_net_is_a_minimum(rows, ratio):
    """No small step from the fitted coefficients lowers the stated objective."""
    xs, alpha = ["a", "b", "noise"], 0.7
    model = mo.elastic(rows, "target", xs, alpha, ratio)
    data = rows.select(*xs, "target").toPandas()
    x, y = data[xs].to_numpy(), data["target"].to_numpy()

    def objective(b):
        left = (y - y.mean()) - (x - x.mean(axis=0)) @ b
        penalty = ratio * np.abs(b).sum() + (1 - ratio) / 2 * (b**2).sum()
        return (left**2).mean() / 2 + alpha * penalty

    best = np.array(model.coefficients)
    for i in range(3):
        for step in (-1e-3, 1e-3):
            moved = best.copy()
            moved[i] += step
            assert objective(moved) >= objective(best) - 1e-9


def test_calibrated_scores(rows):
    scored = mo.calibrated_svm(rows, rows, "y", ["a", "b"], "key").cache()
    ends = scored.agg(F.min("p_1").alias("low"), F.max("p_1").alias("high")).first()
    assert 0 <= ends.low < ends.high <= 1
    auc = m.roc_auc(scored, "y", "p_1").first()["roc_auc"]
    assert auc > 0.85
    three = mo.calibrated_svm(rows, rows, "band", ["a", "b"], "key", 2)
    total = three.select((F.col("p_0") + F.col("p_1") + F.col("p_2")).alias("t"))
    assert total.filter(F.abs(F.col("t") - 1) > 1e-9).count() == 0


def test_same_seed_same_forest(rows):
    xs = ["a", "b", "noise"]
    one, two = (mo.importance(mo.forest(rows, "y", xs), xs) for _ in range(2))
    assert one == two
    assert sum(v for _, v in one) == pytest.approx(1)
    assert dict(one)["noise"] == min(v for _, v in one)


def test_components(rows):
    xs = ["a", "b", "noise"]
    scored, loadings, explained = mo.pca(rows, rows, xs, 3)
    matrix = np.array(loadings)
    assert np.allclose(matrix @ matrix.T, np.eye(3), atol=1e-9)
    assert sum(explained) == pytest.approx(1)
    means = scored.agg(*[F.avg(f"pc{i}") for i in (1, 2, 3)]).first()
    assert np.allclose(means, 0, atol=1e-9)


def test_kmeans_steps_never_raise_the_inertia(rows):
    xs, start = ["a", "b"], [[0.0, 0.0], [5.0, 5.0], [10.0, 0.0]]

    def inertia(centers):
        parts = mo.assign(rows, xs, centers)
        own = [F.element_at(F.array(*[F.lit(c[i]) for c in centers]), F.col("cluster") + 1) for i in (0, 1)]
        gap = sum((F.col(x) - o) * (F.col(x) - o) for x, o in zip(xs, own))
        return parts.agg(F.sum(gap)).first()[0]

    costs = [inertia(mo.kmeans(rows, xs, start, n)) for n in range(4)]
    assert costs == sorted(costs, reverse=True)
    kept = mo.kmeans(rows, xs, [[0.0, 0.0], [1e9, 1e9]], 2)
    assert kept[1] == [1e9, 1e9]


def test_folds_keep_class_shares(rows):
    folds = mo.stratified_folds(rows, "key", "y", 4)
    counts = folds.groupBy("y", "fold").count().toPandas().groupby("y")["count"]
    assert (counts.max() - counts.min() <= 1).all()


def test_grid_search_finds_the_deeper_tree(rows):
    from pyspark.ml.classification import DecisionTreeClassifier

    folded = mo.stratified_folds(rows, "key", "band", 3)
    search, scores = t.grid_search(
        folded, DecisionTreeClassifier(seed=7), "band", ["a", "b"], {"maxDepth": [1, 4]}, "accuracy", "fold", 3
    )
    assert dict((p, mean) for p, mean, _ in scores)["maxDepth=4"] > 0.9
    assert search.bestModel.depth > 1


def test_risk_vote_takes_the_cheapest_cut(spark):
    df = spark.createDataFrame([(1, 0.9, 0.7), (0, 0.2, 0.4), (0, 0.6, 0.1)], "y int, p double, q double")
    scored, cut = mo.risk_vote(df, df, "y", {"p": 1.0, "q": 3.0}, [0.1, 0.4, 0.9], 1.0, 5.0)
    assert cut == 0.4
    assert sorted(r.prediction for r in scored.collect()) == [0, 0, 1]


def test_machines_end_by_tolerance(spark):
    rng = np.random.default_rng(3)
    xs = rng.normal(size=(800, 30)) * np.geomspace(1, 20, 30)
    y = (xs @ rng.normal(size=30) + rng.normal(size=800) * 20 > 0).astype(int)
    names = [f"x{i}" for i in range(30)]
    df = spark.createDataFrame([(int(b), *map(float, a)) for a, b in zip(xs, y)], ["y", *names])
    model = mo.fit_vectors(mo.machine(), mo.assemble(df, names).withColumnRenamed(mo.FEATURES, "v"), "v", "y")
    assert 15 < model.summary().totalIterations and mo.converged(model)


def test_terms_do_not_share_places(spark):
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    texts = [(d, " ".join(name(i) for i in range(d * 1000, d * 1000 + 1000))) for d in range(40)]
    df = spark.createDataFrame([*texts, (40, name(0) + " zzzzzz")], "doc_id long, text string")
    vectors = [r.term_vector for r in p.term_vectors(df.filter("doc_id < 40"), df, "text").orderBy("doc_id").collect()]
    places = [i for v in vectors[:40] for i in v.indices]
    assert len(places) == len(set(places)) == vectors[0].size == 40_000
    assert len(vectors[40].indices) == 1 and vectors[40].indices[0] in vectors[0].indices


def test_layout_deals_equal_rows_and_keeps_them_all(spark, monkeypatch):
    monkeypatch.setattr(mo, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(mo, "COPIES", 7)
    rows = [(1.0, 2.0, 1)] * 900 + [(float(i), 0.5, 0) for i in range(100)]
    df = mo.assemble(spark.createDataFrame(rows, "x double, z double, y int"), ["x", "z"]).select(mo.FEATURES, "y")
    dealt = [mo.in_fixed_layout(df.repartition(n)).rdd.glom().collect() for n in (1, 3, 20)]
    assert dealt[0] == dealt[1] == dealt[2]
    assert sum(map(len, dealt[0])) == 1000 and len(dealt[0]) == 10 and max(map(len, dealt[0])) < 200
    assert sum(r["y"] for part in dealt[0] for r in part) == 900


def test_a_forest_moves_plain_numbers_and_is_the_same(spark, monkeypatch):
    rows = [(float(i % 97), i % 13, int(i % 97 > 60 or i % 13 == 4), 1.0 + i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, z int, y int, w double")
    moved, layout = [], mo.in_fixed_layout
    monkeypatch.setattr(mo, "in_fixed_layout", lambda d: moved.append(dict(d.dtypes)) or layout(d))
    model = mo.forest(df, "y", ["x", "z"], trees=3, weight="w")
    assert not any(kind == "vector" or kind.startswith("array") for kind in moved[0].values())
    vectors = mo.assemble(df, ["x", "z"]).select(mo.FEATURES, F.col("y").cast("double").alias(mo.LABEL), "w")
    estimator = mo.C.RandomForestClassifier(numTrees=3, maxDepth=5, seed=7, featuresCol=mo.FEATURES, labelCol=mo.LABEL, weightCol="w")
    assert estimator.fit(layout(vectors)).toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]


def test_tasks_of_a_fit_grow_slower_than_its_rows():
    from veldt.session import EVEN_TASKS, MOST_ROWS_PER_TASK, ROWS_PER_TASK, tasks_for

    assert [tasks_for(n) for n in (0, 1, ROWS_PER_TASK, ROWS_PER_TASK + 1)] == [1, 1, 1, 2]
    assert tasks_for(EVEN_TASKS * ROWS_PER_TASK) == tasks_for(EVEN_TASKS * MOST_ROWS_PER_TASK) == EVEN_TASKS
    assert tasks_for(10 * EVEN_TASKS * MOST_ROWS_PER_TASK) == 10 * EVEN_TASKS


def test_a_training_cache_of_many_rows_has_few_partitions(spark, monkeypatch):
    from veldt import session

    monkeypatch.setattr(session, "EVEN_TASKS", 4)
    with session.training_cache(spark.range(0, 10 * session.ROWS_PER_TASK, 1, 16)) as rows:
        assert rows.rdd.getNumPartitions() == 4 and rows.count() == 10 * session.ROWS_PER_TASK
