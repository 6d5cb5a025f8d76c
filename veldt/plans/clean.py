"""Cleaning queries. The given tables have no gaps, so ``gappy`` plants some by rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.operators import clean as c
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table


def gappy(spark, folder):
    """All events, with every 7th value and every 11th type missing."""
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )


GAPPY = """WITH g AS (SELECT event_id, ts, user_id,
CASE WHEN event_id % 11 <> 0 THEN event_type END AS event_type,
CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)
"""


@query(
    "df_project",
    """SELECT l_orderkey AS order_id, l_quantity AS quantity,
round(l_extendedprice * (1 - l_discount), 4) AS net, upper(l_returnflag) AS flag FROM lineitem""",
)
def df_project(spark, folder):
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    return c.project(
        table(spark, folder, "lineitem"),
        {
            "order_id": "l_orderkey",
            "quantity": "l_quantity",
            "net": net,
            "flag": F.upper("l_returnflag"),
        },
    )


@query(
    "df_filter",
    """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_discount BETWEEN 0.02 AND 0.06
AND l_shipdate >= TIMESTAMP '1997-01-01' AND regexp_matches(l_linestatus, '^[FO]$')""",
)
def df_filter(spark, folder):
    keep = (
        F.col("l_returnflag").isin("A", "R")
        & F.col("l_discount").between(0.02, 0.06)
        & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & F.col("l_linestatus").rlike("^[FO]$")
    )
    return c.where(table(spark, folder, "lineitem"), keep).select(
        "l_orderkey", "l_linenumber", "l_shipdate"
    )


@query(
    "null_profile",
    GAPPY
    + """, n AS (SELECT count(*) AS r, count(*) - count(event_type) AS t, count(*) - count(value) AS v,
count(*) - count(ts) AS s FROM g)
SELECT 'event_type' AS "column", t AS missing, round(t / r, 6) AS rate FROM n
UNION ALL SELECT 'value', v, round(v / r, 6) FROM n UNION ALL SELECT 'ts', s, round(s / r, 6) FROM n""",
)
def null_profile(spark, folder):
    return rounded(c.null_profile(gappy(spark, folder), ["event_type", "value", "ts"]))


@query(
    "null_drop",
    GAPPY
    + """SELECT event_id, event_type, value FROM g
WHERE (event_id IS NOT NULL)::INT + (event_type IS NOT NULL)::INT + (value IS NOT NULL)::INT >= 3""",
)
def null_drop(spark, folder):
    return c.drop_nulls(gappy(spark, folder).select("event_id", "event_type", "value"), thresh=3)


@query(
    "null_fill_const",
    GAPPY
    + """SELECT event_id, coalesce(event_type, 'unknown') AS event_type,
coalesce(value, 0) AS value FROM g""",
)
def null_fill_const(spark, folder):
    rows = gappy(spark, folder).select("event_id", "event_type", "value")
    return c.fill(rows, {"event_type": "unknown", "value": 0.0})


@query(
    "impute_stat",
    GAPPY
    + """, f AS (SELECT avg(value) AS mean, quantile_cont(value, 0.5) AS med FROM g),
k AS (SELECT event_type AS top FROM g WHERE event_type IS NOT NULL GROUP BY 1
      ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT event_id, round(coalesce(value, mean), 6) AS by_mean, round(coalesce(value, med), 6) AS by_median,
coalesce(event_type, top) AS by_mode FROM g, f, k""",
)
def impute_stat(spark, folder):
    rows = gappy(spark, folder).select(
        "event_id",
        F.col("value").alias("by_mean"),
        F.col("value").alias("by_median"),
        F.col("event_type").alias("by_mode"),
    )
    out = c.impute(rows, rows, ["by_mean"], "mean")
    out = c.impute(rows, out, ["by_median"], "median")
    return rounded(c.impute(rows, out, ["by_mode"], "mode"))


@query(
    "impute_group",
    GAPPY
    + """SELECT event_id, event_type,
round(coalesce(value, avg(value) OVER (PARTITION BY event_type)), 6) AS value FROM g""",
)
def impute_group(spark, folder):
    rows = gappy(spark, folder).select("event_id", "event_type", "value")
    return rounded(c.impute_by(rows, "value", ["event_type"]))


@query(
    "fix_categories",
    """WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0
THEN '  ' || upper(substr(o_orderpriority, 3)) || ' ' ELSE lower(substr(o_orderpriority, 3)) END AS p
FROM orders), t AS (SELECT o_orderkey, regexp_replace(trim(lower(p)), ' +', ' ', 'g') AS p FROM m)
SELECT o_orderkey, CASE p WHEN 'not specified' THEN 'unknown' WHEN 'urgent' THEN 'high' ELSE p END AS priority
FROM t""",
)
def fix_categories(spark, folder):
    name = F.substring("o_orderpriority", 3, 100)
    messy = F.when(
        F.col("o_orderkey") % 3 == 0, F.concat(F.lit("  "), F.upper(name), F.lit(" "))
    ).otherwise(F.lower(name))
    rows = table(spark, folder, "orders").select("o_orderkey", messy.alias("priority"))
    return c.normalize_categories(
        rows, "priority", {"not specified": "unknown", "urgent": "high"}
    )


@query(
    "safe_cast",
    """WITH m AS (SELECT CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE value::VARCHAR END AS value,
event_type, event_id::VARCHAR AS event_id FROM events)
SELECT 'value' AS "column", count(*) FILTER (value IS NOT NULL AND try_cast(value AS DOUBLE) IS NULL)
AS failures FROM m
UNION ALL SELECT 'event_type', count(*) FILTER (try_cast(event_type AS INT) IS NULL) FROM m
UNION ALL SELECT 'event_id', count(*) FILTER (try_cast(event_id AS BIGINT) IS NULL) FROM m""",
)
def safe_cast(spark, folder):
    text = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("value").cast("string"))
    rows = table(spark, folder, "events").select(
        text.alias("value"), "event_type", F.col("event_id").cast("string").alias("event_id")
    )
    return c.cast_failures(rows, {"value": "double", "event_type": "int", "event_id": "bigint"})


@query(
    "rule_violations",
    """SELECT 'discount_small' AS rule, count(*) FILTER (NOT l_discount <= 0.08) AS violations FROM lineitem
UNION ALL SELECT 'price_covers_quantity', count(*) FILTER (NOT l_extendedprice >= l_quantity * 100) FROM lineitem
UNION ALL SELECT 'flag_known', count(*) FILTER (NOT l_returnflag IN ('A', 'N')) FROM lineitem""",
)
def rule_violations(spark, folder):
    rules = {
        "discount_small": F.col("l_discount") <= 0.08,
        "price_covers_quantity": F.col("l_extendedprice") >= F.col("l_quantity") * 100,
        "flag_known": F.col("l_returnflag").isin("A", "N"),
    }
    return c.check_rules(table(spark, folder, "lineitem"), rules)


@query(
    "dedup_latest",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def dedup_latest(spark, folder):
    orders = table(spark, folder, "orders")
    newest = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc_nulls_last()]
    return c.dedup(orders, ["o_custkey"], newest).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "outlier_iqr",
    GAPPY
    + """, q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b
FROM g WHERE value IS NOT NULL GROUP BY 1),
w AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM g)
SELECT event_id, coalesce(value < w.a - 1.5 * (w.b - w.a) OR value > w.b + 1.5 * (w.b - w.a), false) AS overall,
coalesce(value < q.a - 1.5 * (q.b - q.a) OR value > q.b + 1.5 * (q.b - q.a), false) AS within_type
FROM g LEFT JOIN q ON g.event_type IS NOT DISTINCT FROM q.event_type CROSS JOIN w""",
)
def outlier_iqr(spark, folder):
    rows = gappy(spark, folder).select("event_id", "event_type", "value")
    overall = c.flag_iqr(rows, ["value"]).withColumnRenamed("value_outlier", "overall")
    return c.flag_iqr_by(overall, "value", ["event_type"]).select(
        "event_id", "overall", F.col("value_outlier").alias("within_type")
    )


@query(
    "outlier_zscore",
    """WITH f AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
SELECT event_id, round((value - m) / s, 6) AS value_z, abs((value - m) / s) > 2 AS value_outlier
FROM events, f""",
)
def outlier_zscore(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "value")
    return rounded(c.flag_z(rows, ["value"], 2.0).drop("value"))


@query(
    "winsorize",
    """WITH f AS (SELECT quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.95) AS b FROM events)
SELECT event_id, round(least(greatest(value, a), b), 6) AS value FROM events, f""",
)
def winsorize(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "value")
    return rounded(c.winsorize(rows, "value", 0.05, 0.95))


@query(
    "clean_table",
    GAPPY
    + """, d AS (SELECT event_id, user_id, ts, coalesce(event_type, 'unknown') AS event_type, value FROM g),
i AS (SELECT event_id, user_id, ts, event_type, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM g)) AS value FROM d),
b AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM i)
SELECT user_id, event_type, event_id, round(least(greatest(value, lo), hi), 6) AS value FROM i, b
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def clean_table(spark, folder):
    rows = gappy(spark, folder)
    newest = [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]
    steps = [
        lambda df: c.fill(df, {"event_type": "unknown"}),
        lambda df: c.impute(rows, df, ["value"], "median"),
        lambda df: c.winsorize(df, "value", 0.01, 0.99),
        lambda df: c.dedup(df, ["user_id", "event_type"], newest),
    ]
    return rounded(c.clean(rows, steps).select("user_id", "event_type", "event_id", "value"))
