"""Joins and the e-commerce star schema. Both sides are filtered so that unmatched rows exist."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.operators import star as s
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table


def rich_customers(spark, folder):
    return (
        table(spark, folder, "customer")
        .filter(F.col("c_acctbal") > 4000)
        .select("c_custkey", "c_name", "c_mktsegment")
    )


def open_orders(spark, folder):
    return (
        table(spark, folder, "orders")
        .filter((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 300000))
        .select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    )


SIDES = """WITH c AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 4000),
o AS (SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice FROM orders
      WHERE o_orderstatus = 'O' AND o_totalprice > 300000)
"""
ALL = "SELECT c_custkey, coalesce(c_name, '-') AS c_name, coalesce(o_orderkey, -1) AS o_orderkey"


def _joined(spark, folder, how):
    out = s.join(rich_customers(spark, folder), open_orders(spark, folder), ["c_custkey"], how)
    return out.select(
        "c_custkey",
        F.coalesce("c_name", F.lit("-")).alias("c_name"),
        F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"),
    )


@query("join_full_outer", SIDES + ALL + " FROM c FULL JOIN o USING (c_custkey)")
def join_full_outer(spark, folder):
    return _joined(spark, folder, "full")


@query("join_inner", SIDES + ALL + " FROM c JOIN o USING (c_custkey)")
def join_inner(spark, folder):
    return _joined(spark, folder, "inner")


@query("join_left", SIDES + ALL + " FROM c LEFT JOIN o USING (c_custkey)")
def join_left(spark, folder):
    return _joined(spark, folder, "left")


@query("join_right", SIDES + ALL + " FROM c RIGHT JOIN o USING (c_custkey)")
def join_right(spark, folder):
    return _joined(spark, folder, "right")


@query(
    "join_reconcile",
    SIDES
    + """SELECT coalesce(c.c_custkey, o.c_custkey) AS c_custkey,
CASE WHEN c.c_custkey IS NULL THEN 'right' WHEN o.c_custkey IS NULL THEN 'left' ELSE 'both' END AS side,
count(*) AS n, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM c FULL JOIN o ON c.c_custkey = o.c_custkey GROUP BY 1, 2""",
)
def join_reconcile(spark, folder):
    sides = s.reconcile(rich_customers(spark, folder), open_orders(spark, folder), ["c_custkey"])
    return sides.groupBy("c_custkey", "side").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)), 2).alias("total"),
    )


@query("join_semi", SIDES + "SELECT * FROM c WHERE EXISTS (FROM o WHERE o.c_custkey = c.c_custkey)")
def join_semi(spark, folder):
    customers, orders = rich_customers(spark, folder), open_orders(spark, folder)
    return s.join(customers, orders, ["c_custkey"], "left_semi")


@query(
    "join_anti", SIDES + "SELECT * FROM c WHERE NOT EXISTS (FROM o WHERE o.c_custkey = c.c_custkey)"
)
def join_anti(spark, folder):
    customers, orders = rich_customers(spark, folder), open_orders(spark, folder)
    return s.join(customers, orders, ["c_custkey"], "left_anti")


def dim_customer(spark, folder):
    customers = table(spark, folder, "customer").filter(F.col("c_acctbal") > 0)
    return s.dimension(customers, ["c_custkey"], ["c_mktsegment", "c_nationkey"], "customer_sk")


def dim_part(spark, folder):
    parts = table(spark, folder, "part")
    return s.dimension(parts, ["p_partkey"], ["p_brand", "p_type"], "part_sk")


def dim_date(spark, folder):
    days = table(spark, folder, "orders").select(
        F.col("o_orderdate").alias("day"), F.year("o_orderdate").alias("order_year")
    )
    return s.dimension(days, ["day"], ["order_year"], "date_sk")


def sales_dimensions(spark, folder) -> dict:
    """Surrogate key -> (dimension, its keys on the fact side)."""
    return {
        "customer_sk": (dim_customer(spark, folder), {"o_custkey": "c_custkey"}),
        "part_sk": (dim_part(spark, folder), {"l_partkey": "p_partkey"}),
        "date_sk": (dim_date(spark, folder), {"o_orderdate": "day"}),
    }


def sales_fact(spark, folder, dimensions: dict):
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return s.fact(
        lines.withColumn("revenue", revenue),
        [(dim, pairs, key) for key, (dim, pairs) in dimensions.items()],
        ["l_quantity", "revenue"],
    )


DIMS = """WITH dc AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey,
 c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 0),
dp AS (SELECT row_number() OVER (ORDER BY p_partkey) AS part_sk, p_partkey, p_brand, p_type FROM part),
dd AS (SELECT row_number() OVER (ORDER BY day) AS date_sk, day, year(day)::INTEGER AS order_year
 FROM (SELECT DISTINCT o_orderdate AS day FROM orders)),
f AS (SELECT coalesce(customer_sk, -1) AS customer_sk, coalesce(part_sk, -1) AS part_sk,
 coalesce(date_sk, -1) AS date_sk, l_quantity, l_extendedprice * (1 - l_discount) AS revenue
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN dc ON o_custkey = c_custkey
 LEFT JOIN dp ON l_partkey = p_partkey LEFT JOIN dd ON o_orderdate = day)
"""


@query("build_dimension", DIMS + "SELECT * FROM dc")
def build_dimension(spark, folder):
    return dim_customer(spark, folder)


@query(
    "build_fact",
    DIMS
    + """SELECT customer_sk, part_sk, date_sk, l_quantity, round(revenue, 4) AS revenue FROM f""",
)
def build_fact(spark, folder):
    return rounded(sales_fact(spark, folder, sales_dimensions(spark, folder)), 4)


STAR_SQL = (
    DIMS
    + """SELECT c_mktsegment, p_brand, order_year, round(sum(revenue), 4) AS revenue,
sum(l_quantity) AS quantity, count(*) AS n FROM f LEFT JOIN dc USING (customer_sk) LEFT JOIN dp USING (part_sk)
LEFT JOIN dd USING (date_sk) GROUP BY 1, 2, 3"""
)


@query("star_query", STAR_SQL)
def star_query(spark, folder):
    dimensions = sales_dimensions(spark, folder)
    out = s.star(
        sales_fact(spark, folder, dimensions),
        [(dim, key) for key, (dim, _) in dimensions.items()],
        ["c_mktsegment", "p_brand", "order_year"],
        {
            "revenue": F.sum("revenue"),
            "quantity": F.sum("l_quantity"),
            "n": F.count(F.lit(1)),
        },
    )
    return rounded(out, 4)


@query(
    "ri_check",
    """SELECT l_partkey AS p_partkey, count(*) AS "rows" FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1""",
)
def ri_check(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    parts = table(spark, folder, "part").filter("p_size > 10").select("p_partkey")
    return s.orphans(lines, parts, "p_partkey")
