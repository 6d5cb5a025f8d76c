"""Published counts, bounds and edge cases of the metrics."""

import pytest
from pyspark.sql import functions as F

from veldt.operators import metrics as m


def test_published_counts(spark):
    """82 found, 16 missed, 21 false alarms give 83.67 % recall, 79.61 % precision, 81.59 % F1."""
    rows = [(1, 1)] * 82 + [(1, 0)] * 16 + [(0, 1)] * 21 + [(0, 0)] * 500
    df = spark.createDataFrame(rows, "y int, p int")
    one = m.precision_recall_f1(df, "y", "p").filter("class = 1").first()
    assert round(one["recall"] * 100, 2) == 83.67
    assert round(one["precision"] * 100, 2) == 79.61
    assert round(one["f1"] * 100, 2) == 81.59
    cells = {(r.y, r.p): r.n for r in m.confusion(df, "y", "p").collect()}
    assert cells == {(1, 1): 82, (1, 0): 16, (0, 1): 21, (0, 0): 500}


def test_a_class_never_predicted_scores_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "y string, p string")
    scores = {r["class"]: r for r in m.precision_recall_f1(df, "y", "p").collect()}
    assert scores["b"]["precision"] == scores["b"]["recall"] == scores["b"]["f1"] == 0


def test_ties_count_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "y int, s double")
    assert m.roc_auc(df, "y", "s").first()["roc_auc"] == 0.5
    assert m.average_precision(df, "y", "s").first()["average_precision"] == 0.5
    assert m.roc_curve(df, "y", "s").count() == 1


def test_perfect_and_reversed(spark):
    df = spark.range(100).select((F.col("id") > 70).cast("int").alias("y"), F.col("id").alias("s"))
    assert m.roc_auc(df, "y", "s").first()["roc_auc"] == 1
    assert m.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first()["roc_auc"] == 0


def test_row_order_does_not_matter(spark):
    df = spark.range(500).select(
        (F.col("id") % 7 == 0).cast("int").alias("y"), (F.col("id") * 31 % 97).alias("s")
    )
    mixed = df.orderBy(F.rand(3)).repartition(5)
    for fn in (m.roc_auc, m.average_precision):
        assert fn(df, "y", "s").first()[0] == pytest.approx(fn(mixed, "y", "s").first()[0], abs=1e-12)


def test_cheapest_threshold_prefers_the_lower_on_ties(spark):
    df = spark.createDataFrame([(1, 0.95), (0, 0.05)], "y int, s double")
    best = m.cost_curve(df, "y", "s", [0.2, 0.5, 0.8], 1, 10).filter("is_best = 1").collect()
    assert [r["threshold"] for r in best] == [0.2]


def test_rows_without_a_score_are_never_picked(spark):
    df = spark.createDataFrame([(1, None), (1, 0.5), (0, float("nan")), (0, 1.0)], "y int, s double")
    rows = {r.threshold: r for r in m.threshold_sweep(df, "y", "s", [0.5, 0.9]).collect()}
    assert (rows[0.5].tp, rows[0.5].fp, rows[0.5].fn, rows[0.5].tn) == (1, 1, 1, 1)
    assert (rows[0.9].tp, rows[0.9].fp, rows[0.9].fn, rows[0.9].tn) == (0, 1, 2, 1)
