"""Statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.operators import stats as s
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table


@query(
    "stat_ci_mean",
    """WITH m AS (SELECT event_type, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS sd
FROM events GROUP BY 1)
SELECT event_type, n, round(mean, 6) AS mean, round(mean - 1.96::DOUBLE * sd / sqrt(n), 6) AS low,
round(mean + 1.96::DOUBLE * sd / sqrt(n), 6) AS high FROM m""",
)
def stat_ci_mean(spark, folder):
    return rounded(s.ci_mean(table(spark, folder, "events"), "value", ["event_type"]))


@query(
    "stat_ttest",
    """WITH g AS (SELECT CASE WHEN event_type = 'error' THEN value END AS x,
CASE WHEN event_type <> 'error' THEN value END AS y FROM events),
m AS (SELECT avg(x) AS m1, avg(y) AS m2, var_samp(x) / count(x) AS e1, var_samp(y) / count(y) AS e2,
count(x) AS n1, count(y) AS n2 FROM g)
SELECT n1, n2, round((m1 - m2) / sqrt(e1 + e2), 6) AS t,
round((e1 + e2) * (e1 + e2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)), 4) AS dof FROM m""",
)
def stat_ttest(spark, folder):
    out = s.welch_t(table(spark, folder, "events"), "value", F.col("event_type") == "error")
    return out.select("n1", "n2", F.round("t", 6).alias("t"), F.round("dof", 4).alias("dof"))


@query(
    "stat_chi2",
    """WITH c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS o FROM orders GROUP BY 1, 2),
f AS (SELECT x.a, y.b, coalesce(o, 0) AS o FROM (SELECT DISTINCT a FROM c) x CROSS JOIN
      (SELECT DISTINCT b FROM c) y LEFT JOIN c ON c.a = x.a AND c.b = y.b),
e AS (SELECT a, b, o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM f)
SELECT round(sum((o - e) * (o - e) / e), 6) AS chi2,
((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1))::BIGINT AS dof FROM e""",
)
def stat_chi2(spark, folder):
    return rounded(s.chi2(table(spark, folder, "orders"), "o_orderstatus", "o_orderpriority"))


def customer_features(spark, folder):
    return (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum("o_totalprice").alias("total"),
            F.max("o_totalprice").alias("largest"),
        )
    )


CUSTOMERS = """WITH p AS (SELECT o_custkey, count(*)::DOUBLE AS n, sum(o_totalprice) AS total,
max(o_totalprice) AS largest FROM orders GROUP BY 1)
"""


@query(
    "vif",
    CUSTOMERS
    + """, r AS (SELECT corr(n, total) AS a, corr(n, largest) AS b, corr(total, largest) AS c FROM p)
SELECT 'n' AS feature, round(1 / (1 - (a * a + b * b - 2 * a * b * c) / (1 - c * c)), 5) AS vif FROM r
UNION ALL SELECT 'total', round(1 / (1 - (a * a + c * c - 2 * a * b * c) / (1 - b * b)), 5) FROM r
UNION ALL SELECT 'largest', round(1 / (1 - (b * b + c * c - 2 * a * b * c) / (1 - a * a)), 5) FROM r""",
)
def vif(spark, folder):
    return rounded(s.vif(customer_features(spark, folder), ["n", "total", "largest"]), 5)


@query(
    "odds_ratio",
    """WITH x AS (SELECT n_chars > 1000 AS e, quality = 1 AS y FROM labels JOIN documents USING (doc_id)),
c AS (SELECT count(*) FILTER (e AND y) AS a, count(*) FILTER (e AND NOT y) AS b,
count(*) FILTER (NOT e AND y) AS c, count(*) FILTER (NOT e AND NOT y) AS d FROM x),
r AS (SELECT *, a * d / (b * c) AS ratio, 1.96::DOUBLE * sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS half FROM c)
SELECT a, b, c, d, round(ratio, 6) AS odds_ratio, round(exp(ln(ratio) - half), 6) AS low,
round(exp(ln(ratio) + half), 6) AS high FROM r""",
)
def odds_ratio(spark, folder):
    rows = table(spark, folder, "labels").join(
        table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    return rounded(s.odds_table(rows, F.col("n_chars") > 1000, F.col("quality") == 1))
