"""Physical plans: filters and columns reach the scan, and hot paths avoid needless shuffles."""

from pyspark.sql import functions as F

from veldt.operators import features as f
from veldt.operators import metrics as m
from veldt.operators import models as mo
from veldt.operators.clean import dedup, where
from veldt.operators.text import tfidf
from veldt.plans.registry import table

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    df = where(table(spark, FOLDER, "lineitem"), F.col("l_quantity") > 40).select("l_orderkey")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_scaling_and_splitting_do_not_shuffle(spark):
    orders = table(spark, FOLDER, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    scaled = f.standardize(orders, orders, ["o_totalprice"])
    both = f.split(scaled, "o_orderkey", 0.25, "o_orderstatus")
    weighted = f.class_weights(both, "o_orderstatus")
    assert "Exchange" not in plan_of(weighted)


def test_first_row_per_key_is_limited_before_the_shuffle(spark):
    orders = table(spark, FOLDER, "orders")
    plan = plan_of(dedup(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]))
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_sweep_counts_each_row_once(spark):
    scores = table(spark, FOLDER, "events").select(
        (F.col("value") > 50).cast("int").alias("y"), (F.col("value") / 500).alias("s")
    )
    plan = plan_of(m.threshold_sweep(scores, "y", "s", [i / 20 for i in range(1, 20)]))
    # the only generator unfolds the grid itself
    assert plan.count("Generate ") == plan.count("Generate posexplode") == 1
    assert "NestedLoop" not in plan


def test_term_counts_are_shuffled_once(spark):
    docs = table(spark, FOLDER, "documents")
    weights = tfidf(docs, "doc_id", "text")
    rows = weights.collect()
    assert rows
    final = weights._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final


def test_penalised_regression_reads_rows_once(spark):
    lines = table(spark, FOLDER, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    model = mo.ridge(lines, "l_extendedprice", ["l_quantity", "l_discount"], 10.0)
    assert model.getSolver() == "normal"


def test_credit_tree_sums_the_orders_once(spark, monkeypatch):
    from veldt.plans import projects

    seen, split = [], projects.f.split
    monkeypatch.setattr(projects.f, "split", lambda df, *a: seen.append(df) or split(df, *a))
    projects.p_credit_tree(spark, FOLDER)
    assert "Aggregate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
