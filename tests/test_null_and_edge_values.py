"""Values the reviews found wrong: NULLs over split groups, unknown members, constants, entities."""

import math

import pytest
from pyspark.sql import functions as F

from veldt.functions.ordered import LIMIT_SETTING, first_by_hash, running_totals
from veldt.operators import clean, eda, features, metrics, star, stats
from veldt.sources import payloads


@pytest.fixture
def tiny_limit(spark):
    spark.conf.set(LIMIT_SETTING, "40")
    yield
    spark.conf.unset(LIMIT_SETTING)


def test_running_totals_carry_over_nulls(spark, tiny_limit):
    rows = spark.range(200).withColumn("v", F.when(F.col("id") % 70 == 3, 1.0)).withColumn("g", F.lit("a"))
    got = running_totals(rows, ["g"], [F.col("id").asc()], {"total": F.col("v")}).orderBy("id").collect()
    seen, want = 0, []
    for i in range(200):
        seen += i % 70 == 3
        want.append(float(seen) if seen else None)
    assert [r.total for r in got] == want


@pytest.mark.parametrize("how", ["full", "full_outer", "outer", "fullouter", "left", "left_outer", "leftouter", "right", "right_outer"])
def test_split_outer_join_with_equal_names(spark, tiny_limit, how):
    left = spark.createDataFrame([(1, f"l{i}") for i in range(60)] + [(2, "x"), (None, "n")], "k int, v string")
    right = spark.createDataFrame([(1, f"r{i}") for i in range(3)] + [(3, "y"), (None, "m")], "k int, v string")
    right = right.unionByName(spark.range(50).selectExpr("4 AS k", "'z' AS v"))
    got = star.join(left, right, ["k"], how)
    assert got.columns == ["k", "v", "v"]
    text = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert text(got) == text(left.join(right, ["k"], how))


def test_null_class_in_splits(spark):
    rows = spark.range(100).selectExpr("id", "CASE WHEN id % 5 = 0 THEN NULL ELSE id % 2 END AS y")
    split = features.split(rows, key="id", test_share=0.25, label="y")
    sizes = {r.y: r.n for r in split.filter("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sizes == {None: 5, 0: 10, 1: 10}
    assert rows.filter(first_by_hash(rows, "y", "id", F.lit(3))).groupBy("y").count().filter("count <> 3").isEmpty()


def test_star_keeps_unknown_members(spark):
    dim = spark.createDataFrame([(1, "a")], "sk long, name string")
    facts = spark.createDataFrame([(1, 1.0), (-1, 3.0), (-1, 5.0)], "sk long, v double")
    got = star.star(facts, [(dim, "sk")], ["name"], {"total": F.sum("v"), "mean": F.avg("v")}).collect()
    assert {r.name: (r.total, r["mean"]) for r in got} == {"a": (1.0, 1.0), None: (8.0, 4.0)}


def test_confusion_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, 1), (0, None), (None, 1)], "y int, p int")
    got = {(r.y, r.p): r.n for r in metrics.confusion(rows, "y", "p").collect()}
    assert sum(got.values()) == 3 and len(got) == 9 and got[0, None] == got[None, 1] == 1


def test_nan_scores_rank_last(spark):
    rows = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, float("nan")), (0, 0.1), (0, None)], "y int, s double")
    assert metrics.roc_auc(rows, "y", "s").first().roc_auc == 1.0


def test_constant_and_collinear_columns(spark):
    rows = spark.range(50).selectExpr("id * 1.0 AS a", "id * 2.0 AS b", "1.0 AS c", "double((id * 7) % 11) AS d", "id % 2 AS y")
    got = {(r.a, r.b): r.r for r in eda.corr(rows, ["a", "b", "c"]).collect()}
    assert got["a", "c"] is None and math.isclose(got["a", "b"], 1.0)
    factors = {r.feature: r.vif for r in stats.vif(rows, ["a", "b", "c", "d"]).collect()}
    assert factors["a"] == factors["b"] == math.inf and factors["c"] is None and 1 <= factors["d"] < 2
    assert features.rank_features(rows, "y", ["a", "c"], "correlation").filter("feature = 'c'").first().score is None
    assert features.select_features(rows, "y", ["a", "c", "d"], "variance", 2)[1] == ["a", "d"]


def test_all_null_columns(spark):
    rows = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert [r.b for r in clean.winsorize(rows, "b", 0.1, 0.9).collect()] == [None, None]
    flagged = clean.flag_iqr(rows, ["a", "b"])
    assert {"a_outlier", "b_outlier"} <= set(flagged.columns) and flagged.filter("b_outlier").isEmpty()


def test_crosstab_shares_count_every_row(spark):
    rows = spark.createDataFrame([("u", "x"), ("u", "y"), ("u", "z"), ("u", None)], "a string, b string")
    row = eda.crosstab(rows, "a", "b", ["x", "y"], shares=True).first()
    assert (row.x, row.y) == (0.25, 0.25)


def test_page_entities_and_links(spark):
    page = "<title>A &amp; B</title><body>&copy; &#8364;&#x41;&#xZ; &amp;lt; caf&#233;<a href='one'>1</a><a class=c href=two>2</a><A HREF=\"a?x=1&amp;y\">3</A>"
    row = payloads.extract_html(spark.createDataFrame([(page,), (None,)], "html string"), "html").first()
    assert row.title == "A & B" and row.links == ["one", "two", "a?x=1&y"]
    assert row.text == "A & B © €A&#xZ; &lt; café 1 2 3"
