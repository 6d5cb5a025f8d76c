"""Fitted steps learn from the training side only; balancing and splits keep their promises."""

import pytest
from pyspark.sql import functions as F

from veldt.operators import clean, stats
from veldt.operators import features as f


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).select(
        F.col("id").alias("key"),
        (F.col("id") % 10 == 0).cast("int").alias("y"),
        (F.col("id") * 17 % 101).cast("double").alias("a"),
        (F.col("id") * 29 % 53).cast("double").alias("b"),
    )


def test_scaling_uses_the_training_side(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "a double")
    test = spark.createDataFrame([(20.0,)], "a double")
    assert f.minmax(train, test, ["a"]).first()["a"] == 2.0
    assert f.standardize(train, test, ["a"]).first()["a"] == 3.0


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "a double")
    assert {r.a for r in f.minmax(df, df, ["a"]).collect()} == {0.0}
    assert {r.a for r in f.standardize(df, df, ["a"]).collect()} == {0.0}


def test_unseen_category(spark):
    train = spark.createDataFrame([("x",), ("y",)], "c string")
    test = spark.createDataFrame([("z",)], "c string")
    assert f.label_encode(train, test, "c", "code").first()["code"] == -1
    assert f.one_hot(train, test, "c").first()[1:] == (0, 0)
    assert f.one_hot(train, test, "c", drop_last=True).columns == ["c", "c_x"]


def test_stratified_split(rows):
    both = f.split(rows, "key", 0.25, "y")
    counts = {(r.y, r.split): r["count"] for r in both.groupBy("y", "split").count().collect()}
    assert counts == {(0, "test"): 90, (0, "train"): 270, (1, "test"): 10, (1, "train"): 30}


def test_balancing(rows):
    under = f.undersample(rows, "y", "key").groupBy("y").count().collect()
    assert {r["count"] for r in under} == {40}
    over = f.oversample(rows, "y", "key")
    assert {r["count"] for r in over.groupBy("y").count().collect()} == {360}
    assert over.filter("y = 0 AND copy > 1").count() == 0
    weights = {r.y: r.weight for r in f.class_weights(rows, "y").select("y", "weight").distinct().collect()}
    assert weights[1] == pytest.approx(400 / (2 * 40))


def test_smote_stays_between_minority_rows(rows):
    new = f.smote(rows, "y", 1, ["a", "b"], "key", 3)
    assert new.count() == 320
    low = rows.filter("y = 1").agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    out = new.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert out[0] >= low[0] and out[1] <= low[1] and out[2] >= low[2] and out[3] <= low[3]
    again = f.smote(rows.repartition(7), "y", 1, ["a", "b"], "key", 3)
    assert sorted(new.collect()) == sorted(again.collect())


def test_leakage_report(spark, rows):
    told = rows.withColumn("hint", F.col("y") * 5)
    report = {(r.check, r.subject): r.n for r in f.leakage_report(told, told, "key", ["hint", "a"], "y").collect()}
    assert report["shared_keys", "key"] == 400
    assert report["mixed_values", "hint"] == 0
    assert report["mixed_values", "a"] > 0


def test_imputation_and_gaps(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (4.0,), (None,)], "a double")
    assert clean.fit_impute(df, ["a"], "median") == {"a": 3.0}
    assert clean.fit_impute(df, ["a"], "mean") == {"a": 4.0}
    assert clean.fit_impute(df, ["a"], "mode") == {"a": 1.0}
    odd = spark.createDataFrame([(float("nan"), 1), (1.0, 2)], "a double, b int")
    assert clean.nan_to_null(odd).filter("a IS NULL").count() == 1
    assert clean.drop_sparse_columns(clean.nan_to_null(odd), 0.4).columns == ["b"]


def test_vif_of_independent_columns_is_near_one(rows):
    factors = {r.feature: r.vif for r in stats.vif(rows, ["a", "b"]).collect()}
    assert all(1 <= v < 1.1 for v in factors.values())


@pytest.mark.parametrize("empty", [False, True])
def test_null_is_a_class_for_balancing(spark, empty):
    rows = [(i, None if i < 20 else ("a" if i < 50 else "b")) for i in range(100)]
    df = spark.createDataFrame(rows, "key int, y string")
    if empty:
        df = df.limit(0)
        assert f.undersample(df, "y", "key").count() == f.oversample(df, "y", "key").count() == f.class_weights(df, "y").count() == 0
        return
    under = {r["y"]: r["count"] for r in f.undersample(df, "y", "key").groupBy("y").count().collect()}
    over = {r["y"]: r["count"] for r in f.oversample(df, "y", "key").groupBy("y").count().collect()}
    assert under == {None: 20, "a": 20, "b": 20} and over == {None: 50, "a": 50, "b": 50}
    weights = {r["y"]: r["weight"] for r in f.class_weights(df, "y").select("y", "weight").distinct().collect()}
    assert weights == {None: 100 / 60, "a": 100 / 90, "b": 100 / 150}
