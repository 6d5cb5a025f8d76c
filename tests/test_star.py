"""Outer joins with a very frequent key, dimensions and facts."""

import pytest
from pyspark.sql import functions as F

from veldt.functions import ordered
from veldt.operators import star as s


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(200).select(
        F.when(F.col("id") < 120, 1).when(F.col("id") % 7 != 0, F.col("id")).alias("k"),
        F.col("id").alias("a"),
    )
    right = spark.range(150).select(
        F.when(F.col("id") < 90, 1).when(F.col("id") % 5 != 0, F.col("id") + 60).alias("k"),
        F.col("id").alias("b"),
    )
    return left, right


@pytest.mark.parametrize("how", ["full", "left", "right", "inner", "left_semi", "left_anti"])
def test_frequent_keys_change_nothing(spark, sides, how):
    left, right = sides
    plain = left.join(right, "k", how)
    spark.conf.set(ordered.LIMIT_SETTING, "40")
    split = s.join(left, right, ["k"], how)
    spark.conf.unset(ordered.LIMIT_SETTING)
    assert sorted(map(str, split.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_reconcile(spark, sides):
    left, right = sides
    plain = s.reconcile(left, right, ["k"]).groupBy("side").count().collect()
    spark.conf.set(ordered.LIMIT_SETTING, "40")
    split = s.reconcile(left, right, ["k"]).groupBy("side").count().collect()
    spark.conf.unset(ordered.LIMIT_SETTING)
    assert sorted(plain) == sorted(split)


def test_unknown_member(spark):
    dim = s.dimension(spark.createDataFrame([("b",), ("a",), ("a",)], "n string"), ["n"], [], "sk")
    assert sorted(dim.collect()) == [(1, "a"), (2, "b")]
    facts = spark.createDataFrame([("a", 1.0), ("z", 2.0), (None, 3.0)], "n string, v double")
    rows = s.fact(facts, [(dim, {"n": "n"}, "sk")], ["v"]).collect()
    assert sorted(rows) == [(-1, 2.0), (-1, 3.0), (1, 1.0)]


def test_numbering_a_large_dimension(spark):
    rows = spark.range(500).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("n"))
    spark.conf.set(ordered.LIMIT_SETTING, "40")
    dim = s.dimension(rows, ["n"], [], "sk").collect()
    spark.conf.unset(ordered.LIMIT_SETTING)
    assert [r.n for r in sorted(dim, key=lambda r: r.sk)] == sorted(r.n for r in rows.collect())
    assert sorted(r.sk for r in dim) == list(range(1, 501))
