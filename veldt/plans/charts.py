"""Chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.operators import charts
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table


@query(
    "viz_histogram",
    "SELECT floor(o_totalprice / 25000) * 25000 AS bin, count(*) AS n FROM orders GROUP BY 1",
)
def viz_histogram(spark, folder):
    return charts.histogram(table(spark, folder, "orders"), "o_totalprice", 25000)


@query(
    "viz_boxplot",
    """SELECT l_returnflag, min(l_extendedprice) AS low,
round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
round(quantile_cont(l_extendedprice, 0.75), 6) AS q75, max(l_extendedprice) AS high
FROM lineitem GROUP BY 1""",
)
def viz_boxplot(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(charts.boxplot(lines, "l_extendedprice", "l_returnflag"))


@query(
    "viz_timeseries",
    """SELECT date_trunc('month', o_orderdate) AS month, round(sum(o_totalprice), 2) AS total,
count(*) AS n FROM orders GROUP BY 1""",
)
def viz_timeseries(spark, folder):
    return charts.series(
        table(spark, folder, "orders"),
        "o_orderdate",
        "month",
        {"total": F.round(F.sum("o_totalprice"), 2), "n": F.count(F.lit(1))},
    )


@query(
    "viz_bar_topn",
    """WITH c AS (SELECT p_brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS r
FROM part GROUP BY 1)
SELECT CASE WHEN r <= 8 THEN p_brand ELSE 'other' END AS p_brand, sum(n)::BIGINT AS n FROM c GROUP BY 1""",
)
def viz_bar_topn(spark, folder):
    return charts.bars(table(spark, folder, "part"), "p_brand", 8)
