"""Aggregation and exploration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.operators import eda
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "group_agg",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity,
round(sum(l_extendedprice * (1 - l_discount)), 4) AS net, round(avg(l_discount), 6) AS discount,
count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-02'
GROUP BY 1, 2 HAVING count(*) > 10""",
)
def group_agg(spark, folder):
    lines = table(spark, folder, "lineitem").filter(
        F.col("l_shipdate") <= F.lit("2000-09-02").cast("timestamp_ntz")
    )
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return eda.aggregate(
        lines,
        ["l_returnflag", "l_linestatus"],
        {
            "quantity": F.sum("l_quantity"),
            "net": F.round(F.sum(net), 4),
            "discount": F.round(F.avg("l_discount"), 6),
            "n": F.count(F.lit(1)),
        },
        F.col("n") > 10,
    )


@query(
    "agg_distinct",
    """SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers,
count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1""",
)
def agg_distinct(spark, folder):
    return eda.aggregate(
        table(spark, folder, "orders"),
        ["o_orderstatus"],
        {"customers": F.count_distinct("o_custkey"), "days": F.count_distinct("o_orderdate")},
    )


def _describe_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", round(avg({column}), 6) AS mean,
round(stddev_samp({column}), 6) AS std, min({column})::DOUBLE AS "min",
round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50,
round(quantile_cont({column}, 0.75), 6) AS q75, max({column})::DOUBLE AS "max" FROM {source}"""


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe", " UNION ALL ".join(_describe_sql("lineitem", c) for c in LINE_COLUMNS))
def describe(spark, folder):
    return rounded(eda.describe(table(spark, folder, "lineitem"), LINE_COLUMNS))


@query(
    "value_counts",
    """SELECT p_brand, count(*) AS n, round(count(*) / (SELECT count(*) FROM part), 6) AS share
FROM part GROUP BY 1""",
)
def value_counts(spark, folder):
    return rounded(eda.value_counts(table(spark, folder, "part"), "p_brand"))


def _profile_sql(column: str) -> str:
    return f"""SELECT l_returnflag, '{column}' AS "column", count({column}) AS n, round(avg({column}), 6) AS mean,
round(stddev_samp({column}), 6) AS std, min({column}) AS "min", max({column}) AS "max"
FROM lineitem GROUP BY 1"""


@query("group_profile", " UNION ALL ".join(_profile_sql(c) for c in LINE_COLUMNS))
def group_profile(spark, folder):
    return rounded(eda.profile_by(table(spark, folder, "lineitem"), "l_returnflag", LINE_COLUMNS))


@query(
    "crosstab",
    "SELECT user_id, "
    + ", ".join(
        f"round(count(*) FILTER (event_type = '{t}') / count(*), 6) AS {t}" for t in EVENT_TYPES
    )
    + " FROM events GROUP BY 1",
)
def crosstab(spark, folder):
    events = table(spark, folder, "events")
    return rounded(eda.crosstab(events, "user_id", "event_type", EVENT_TYPES, shares=True))


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for i, a in enumerate(LINE_COLUMNS)
        for b in LINE_COLUMNS[i + 1 :]
    ),
)
def corr_matrix(spark, folder):
    return rounded(eda.corr(table(spark, folder, "lineitem"), LINE_COLUMNS))


def _shape_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", round(avg(pow(({column} - m) / s, 3)), 5) AS skewness,
round(avg(pow(({column} - m) / s, 4)) - 3, 5) AS kurtosis FROM lineitem,
(SELECT avg({column}) AS m, stddev_pop({column}) AS s FROM lineitem)"""


@query("shape_stats", " UNION ALL ".join(_shape_sql(c) for c in LINE_COLUMNS))
def shape_stats(spark, folder):
    return rounded(eda.shape(table(spark, folder, "lineitem"), LINE_COLUMNS), 5)


@query(
    "mart_subtotals",
    """SELECT coalesce(n_name, 'all') AS n_name, coalesce(c_mktsegment, 'all') AS c_mktsegment,
grouping(n_name, c_mktsegment)::BIGINT AS level, round(sum(o_totalprice), 2) AS total, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY ROLLUP (n_name, c_mktsegment)""",
)
def mart_subtotals(spark, folder):
    rows = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    out = eda.subtotals(
        rows,
        ["n_name", "c_mktsegment"],
        {"total": F.round(F.sum("o_totalprice"), 2), "n": F.count(F.lit(1))},
    )
    return out.na.fill("all", ["n_name", "c_mktsegment"])


CHURN_DAY, CHURN_WINDOW = "2001-08-01", 200


@query(
    "churn_features",
    f"""SELECT c_custkey, c_mktsegment, datediff('day', max(o_orderdate)::DATE, DATE '{CHURN_DAY}')::INTEGER
AS recency, count(*) AS frequency, round(sum(o_totalprice), 2) AS amount,
CASE WHEN datediff('day', max(o_orderdate)::DATE, DATE '{CHURN_DAY}') > {CHURN_WINDOW} THEN 1 ELSE 0 END
AS churned FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""",
)
def churn_features(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return rounded(
        eda.churn_features(
            orders, customers, "c_custkey", "o_orderdate", "o_totalprice", CHURN_DAY, CHURN_WINDOW
        ),
        2,
    )
