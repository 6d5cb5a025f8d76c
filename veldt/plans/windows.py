"""Windows, sorting, top-k, set operations, subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.functions.columns import case
from veldt.functions.ordered import ranks, running_totals, with_preceding
from veldt.operators import windows as w
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table
from veldt.sources.tabular import register


def by_time():
    return [F.asc_nulls_last("ts"), F.asc_nulls_last("event_id")]


@query(
    "win_rank",
    """SELECT c_custkey, c_nationkey,
row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS row_number,
rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rank,
dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS dense_rank,
round(percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC), 6) AS percent_rank,
ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS ntile FROM customer""",
)
def win_rank(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    ranked = ranks(rows, ["c_nationkey"], "c_acctbal", "c_custkey", 4, descending=True)
    return rounded(ranked.drop("c_acctbal"))


@query(
    "win_lag_return",
    """WITH l AS (SELECT event_type, event_id, value,
lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous FROM events)
SELECT event_type, event_id, coalesce(previous, 0) AS previous,
round(coalesce(value - previous, 0), 6) AS change,
round(coalesce((value - previous) / nullif(previous, 0), 0), 6) AS simple_return FROM l""",
)
def win_lag_return(spark, folder):
    ticks = table(spark, folder, "events").select("event_type", "event_id", "ts", "value")
    out = w.returns(ticks, ["event_type"], by_time(), "value")
    return rounded(
        out.na.fill(0.0, ["previous", "change", "simple_return"]).drop("ts", "value")
    )


@query(
    "win_rolling",
    """SELECT event_type, event_id, round(avg(value) OVER (PARTITION BY event_type
ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS mean_7,
max(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
AS max_7 FROM events""",
)
def win_rolling(spark, folder):
    ticks = table(spark, folder, "events").select("event_type", "event_id", "ts", "value")
    out = with_preceding(
        ticks, ["event_type"], by_time(), 6, {"mean_7": F.avg("value"), "max_7": F.max("value")}
    )
    return rounded(out.drop("ts", "value"))


@query(
    "win_running",
    """SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey
ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS total,
row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders""",
)
def win_running(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    out = running_totals(
        rows,
        ["o_custkey"],
        [F.asc_nulls_last("o_orderdate"), F.asc_nulls_last("o_orderkey")],
        {"total": F.col("o_totalprice"), "n": F.lit(1).cast("long")},
    )
    return rounded(out.drop("o_orderdate", "o_totalprice"), 2)


@query(
    "sort_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def sort_limit(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    order = [F.desc_nulls_last("o_totalprice"), F.asc_nulls_last("o_orderkey")]
    return w.top(rows, order, 20)


@query(
    "topk_group",
    """SELECT p_brand, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_brand
ORDER BY p_retailprice DESC, p_partkey) AS position FROM part QUALIFY position <= 5""",
)
def topk_group(spark, folder):
    parts = table(spark, folder, "part").select("p_brand", "p_partkey", "p_retailprice")
    order = [F.desc_nulls_last("p_retailprice"), F.asc_nulls_last("p_partkey")]
    return w.top_by(parts, ["p_brand"], order, 5).withColumn(
        "position", F.col("position").cast("long")
    )


@query(
    "set_ops",
    """WITH a AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT o_custkey AS k FROM orders WHERE o_totalprice > 400000)
SELECT 'union_all' AS op, k FROM (FROM a UNION ALL FROM b)
UNION ALL SELECT 'union', k FROM (FROM a UNION FROM b)
UNION ALL SELECT 'intersect', k FROM (FROM a INTERSECT FROM b)
UNION ALL SELECT 'intersect_all', k FROM (FROM a INTERSECT ALL FROM b)
UNION ALL SELECT 'except', k FROM (FROM a EXCEPT FROM b)
UNION ALL SELECT 'except_all', k FROM (FROM a EXCEPT ALL FROM b)""",
)
def set_ops(spark, folder):
    orders = table(spark, folder, "orders")
    key = F.col("o_custkey").alias("k")
    a = orders.filter("o_orderstatus = 'F'").select(key)
    b = orders.filter("o_totalprice > 400000").select(key)
    out = None
    for op in ("union_all", "union", "intersect", "intersect_all", "except", "except_all"):
        rows = w.combine(a, b, op).select(F.lit(op).alias("op"), "k")
        out = rows if out is None else out.unionByName(rows)
    return out


SUBQUERIES = """
WITH totals AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_mktsegment, round(total, 2) AS total FROM customer c JOIN totals ON c_custkey = o_custkey
WHERE total > (SELECT avg(total) FROM totals)
  AND c_acctbal > (SELECT avg(d.c_acctbal) FROM customer d WHERE d.c_mktsegment = c.c_mktsegment)
  AND EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')"""


@query("subqueries", SUBQUERIES)
def subqueries(spark, folder):
    register(spark, folder, ["orders", "customer"])
    return spark.sql(SUBQUERIES)


@query(
    "case_when",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium'
ELSE 'small' END AS size, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done FROM orders""",
)
def case_when(spark, folder):
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        case([(price > 400000, "large"), (price > 100000, "medium")], "small").alias("size"),
        case([(F.col("o_orderstatus") == "F", 1)], 0).alias("done"),
    )
