"""Evaluation queries, on two score tables derived from the given data.

``fraud_scores``: one row per event; errors with a large value are the rare positive class.
``quality_scores``: labelled documents, scored by their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldt.operators import metrics as m
from veldt.plans.registry import query, table

GRID = [i / 20 for i in range(1, 20)]
COST_FP, COST_FN = 1.0, 25.0


def fraud_scores(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    weight = (
        F.when(F.col("event_type") == "error", 1.0)
        .when(F.col("event_type") == "purchase", 0.8)
        .otherwise(0.6)
    )
    raw = F.col("value") / (F.col("value") + F.lit(100.0)) * weight
    label = (F.col("event_type") == "error") & (F.col("value") > 150)
    return events.select(
        "event_id",
        label.cast("int").alias("label"),
        (F.floor(raw * 10000) / 10000.0).alias("score"),
    )


FRAUD = """
WITH s AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' AND value > 150 THEN 1 ELSE 0 END AS label,
         floor(value / (value + 100.0) * CASE event_type WHEN 'error' THEN 1.0
               WHEN 'purchase' THEN 0.8 ELSE 0.6 END::DOUBLE * 10000) / 10000.0 AS score
  FROM events)
"""


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    raw = F.lit(400.0) / (F.col("n_chars") + F.lit(400.0))
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("toxic").alias("label"), (F.floor(raw * 10000) / 10000.0).alias("score")
    )


QUALITY = """
WITH s AS (
  SELECT doc_id, toxic AS label, floor(400.0::DOUBLE / (n_chars + 400.0) * 10000) / 10000.0 AS score
  FROM labels JOIN documents USING (doc_id))
"""


def band(name: str):
    c = F.col(name)
    return F.when(c < 0.2, "low").when(c < 0.4, "mid").otherwise("high")


def banded(spark: SparkSession, folder: str) -> DataFrame:
    """Three true bands against three predicted ones, shifted so that they disagree."""
    scores = fraud_scores(spark, folder).withColumn("shifted", F.col("score") * 1.2 - 0.05)
    return scores.select(band("score").alias("label"), band("shifted").alias("prediction"))


BANDED = (
    FRAUD
    + """,
b AS (SELECT CASE WHEN score < 0.2 THEN 'low' WHEN score < 0.4 THEN 'mid' ELSE 'high' END AS label,
             CASE WHEN score * 1.2 - 0.05 < 0.2 THEN 'low'
                  WHEN score * 1.2 - 0.05 < 0.4 THEN 'mid' ELSE 'high' END AS prediction FROM s)
"""
)

CURVE = """,
g AS (SELECT score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM s GROUP BY score),
c AS (SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
             sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g)
"""

SWEEP = """,
t AS (SELECT range / 20.0::DOUBLE AS threshold FROM range(1, 20)),
w AS (SELECT threshold,
             count(*) FILTER (score >= threshold AND label = 1) AS tp,
             count(*) FILTER (score >= threshold AND label = 0) AS fp,
             count(*) FILTER (score < threshold AND label = 1) AS fn,
             count(*) FILTER (score < threshold AND label = 0) AS tn
      FROM t, s GROUP BY threshold)
"""


@query(
    "m_confusion",
    BANDED
    + """, k AS (SELECT label AS c FROM b UNION SELECT prediction FROM b)
SELECT x.c AS label, y.c AS prediction, count(b.label) AS n
FROM k x CROSS JOIN k y LEFT JOIN b ON b.label = x.c AND b.prediction = y.c GROUP BY 1, 2""",
)
def m_confusion(spark, folder):
    return m.confusion(banded(spark, folder), "label", "prediction")


PRF = """, k AS (SELECT label AS c FROM b UNION SELECT prediction FROM b),
f AS (SELECT c AS class, count(*) FILTER (label = c AND prediction = c) AS tp,
             count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS picked
      FROM k, b GROUP BY c),
q AS (SELECT class, coalesce(tp / nullif(picked, 0), 0) AS precision,
             coalesce(tp / nullif(support, 0), 0) AS recall,
             coalesce(2 * tp / nullif(support + picked, 0), 0) AS f1, support FROM f)
"""


@query(
    "m_precision_recall_f1",
    BANDED
    + PRF
    + """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
round(f1, 6) AS f1, support FROM q
UNION ALL SELECT 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
sum(support)::BIGINT FROM q""",
)
def m_precision_recall_f1(spark, folder):
    per_class = m.precision_recall_f1(banded(spark, folder), "label", "prediction")
    macro = per_class.agg(
        F.lit("macro").alias("class"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.sum("support").alias("support"),
    )
    return m.rounded(per_class.unionByName(macro))


@query(
    "m_accuracy",
    BANDED
    + """SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
count(*) AS n FROM b""",
)
def m_accuracy(spark, folder):
    return m.rounded(m.accuracy(banded(spark, folder), "label", "prediction"))


@query(
    "m_roc_curve",
    FRAUD
    + CURVE
    + "SELECT score AS threshold, round(tp / p, 6) AS tpr, round(fp / n, 6) AS fpr FROM c",
)
def m_roc_curve(spark, folder):
    return m.rounded(m.roc_curve(fraud_scores(spark, folder), "label", "score"))


@query(
    "m_roc_auc",
    FRAUD
    + CURVE
    + "SELECT round(sum(pos * (n - fp + neg / 2)) / (max(p) * max(n)), 6) AS roc_auc FROM c",
)
def m_roc_auc(spark, folder):
    return m.rounded(m.roc_auc(fraud_scores(spark, folder), "label", "score"))


@query(
    "m_pr_curve",
    FRAUD
    + CURVE
    + """SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision,
round(tp / p, 6) AS recall FROM c""",
)
def m_pr_curve(spark, folder):
    return m.rounded(m.pr_curve(fraud_scores(spark, folder), "label", "score"))


@query(
    "m_average_precision",
    FRAUD
    + CURVE
    + "SELECT round(sum(pos * (tp / (tp + fp))) / max(p), 6) AS average_precision FROM c",
)
def m_average_precision(spark, folder):
    return m.rounded(m.average_precision(fraud_scores(spark, folder), "label", "score"))


@query(
    "m_threshold_sweep",
    FRAUD
    + SWEEP
    + """SELECT threshold, tp, fp, fn, tn,
round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM w""",
)
def m_threshold_sweep(spark, folder):
    return m.rounded(m.threshold_sweep(fraud_scores(spark, folder), "label", "score", GRID))


@query(
    "m_cost_curve",
    QUALITY
    + SWEEP
    + """SELECT threshold, tp, fp, fn, tn, fp * 1.0::DOUBLE + fn * 25.0::DOUBLE AS cost,
CASE WHEN row_number() OVER (ORDER BY fp * 1.0 + fn * 25.0, threshold) = 1
     THEN 1 ELSE 0 END AS is_best FROM w""",
)
def m_cost_curve(spark, folder):
    scores = quality_scores(spark, folder)
    return m.cost_curve(scores, "label", "score", GRID, COST_FP, COST_FN)


@query(
    "m_regression",
    """WITH r AS (SELECT l_extendedprice AS y, 1000 * l_quantity + 20000 AS f FROM lineitem)
SELECT round(avg(abs(y - f)), 6) AS mae, round(sqrt(avg((y - f) * (y - f))), 6) AS rmse,
round(1 - sum((y - f) * (y - f)) / (var_pop(y) * count(y)), 6) AS r2 FROM r""",
)
def m_regression(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (1000 * F.col("l_quantity") + 20000).alias("f")
    )
    return m.rounded(m.regression_metrics(rows, "y", "f"))
