"""Model queries. Labels are planted where the given columns hold no signal.

Where a fit has a closed form, or a fixed number of steps, the SQL computes it.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldt.functions.fitting import small_frame
from veldt.operators import features as f
from veldt.operators import importance as imp
from veldt.operators import metrics as m
from veldt.operators import models as mo
from veldt.operators.metrics import rounded
from veldt.plans.features import transactions
from veldt.plans.metrics import COST_FN, COST_FP, GRID, SWEEP
from veldt.plans.registry import query, table
from veldt.plans.stats import CUSTOMERS, customer_features
from veldt.sources.marts import scratch_path

# --- regression: a planted rent, linear in price and quantity ---------------------------------


def rents(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000 + F.col("l_quantity")).alias("y"),
    )


RENTS = """WITH r AS (SELECT l_quantity AS x, l_extendedprice / 1000 + l_quantity AS y FROM lineitem),
m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx FROM r)
"""


def one_slope(slope: str) -> str:
    """SQL for the two terms of a one-feature fit, given its slope."""
    return f"""SELECT 'x' AS term, round({slope}, 5) AS value FROM m
UNION ALL SELECT 'intercept', round(my - ({slope}) * mx, 5) FROM m"""


def terms(df: DataFrame, model, xs: list[str], places: int = 5) -> DataFrame:
    return rounded(mo.coefficient_frame(df, model, xs), places)


@query("reg_linear", RENTS + one_slope("sxy / sxx"))
def reg_linear(spark, folder):
    rows = rents(spark, folder)
    return terms(rows, mo.linear(rows, "y", ["x"]), ["x"])


@query(
    "reg_polynomial",
    """WITH r AS (SELECT l_quantity AS x, l_quantity * l_quantity AS z,
 l_extendedprice / 1000 + l_quantity * l_quantity / 10 AS y FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz,
 covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy FROM r),
b AS (SELECT *, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b1, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS b2 FROM m)
SELECT 'x' AS term, round(b1, 5) AS value FROM b UNION ALL SELECT 'x*x', round(b2, 5) FROM b
UNION ALL SELECT 'intercept', round(my - b1 * mx - b2 * mz, 5) FROM b""",
)
def reg_polynomial(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000 + F.col("l_quantity") * F.col("l_quantity") / 10).alias("y"),
    )
    rows = f.poly(rows, ["x"], 2)
    return terms(rows, mo.linear(rows, "y", ["x", "x*x"]), ["x", "x*x"])


@query("reg_ridge", RENTS + one_slope("sxy / (sxx + 50000.0 / n)"))
def reg_ridge(spark, folder):
    rows = rents(spark, folder)
    return terms(rows, mo.ridge(rows, "y", ["x"], 50000.0), ["x"])


@query("reg_lasso", RENTS + one_slope("sign(sxy) * greatest(abs(sxy) - 20.0, 0) / sxx"))
def reg_lasso(spark, folder):
    rows = rents(spark, folder)
    return terms(rows, mo.lasso(rows, "y", ["x"], 20.0), ["x"])


@query(
    "reg_elasticnet",
    RENTS + one_slope("sign(sxy) * greatest(abs(sxy) - 10.0, 0) / (sxx + 10.0)"),
)
def reg_elasticnet(spark, folder):
    rows = rents(spark, folder)
    return terms(rows, mo.elastic(rows, "y", ["x"], 20.0, 0.5), ["x"])


# --- classification ---------------------------------------------------------------------------


def noisy_purchases(spark, folder) -> DataFrame:
    """A label that follows the value, with one row in four turned over."""
    events = table(spark, folder, "events")
    flipped = F.col("event_id") % 4 == 0
    return events.select(
        "event_id",
        "value",
        (F.col("value") / 100).alias("x"),
        ((F.col("value") > 60) != flipped).cast("int").alias("y"),
    )


def newton_sql(steps: int) -> str:
    """Unrolled Newton steps of a one-feature logistic fit."""
    parts = [
        """WITH e AS (SELECT value / 100 AS x,
((value > 60) <> (event_id % 4 = 0))::INTEGER AS y FROM events),
b0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"""
    ]
    for i in range(steps):
        parts.append(
            f"""g{i} AS (SELECT sum(y - p) AS ga, sum((y - p) * x) AS gb, sum(p * (1 - p)) AS h,
sum(p * (1 - p) * x) AS hx, sum(p * (1 - p) * x * x) AS hxx
FROM (SELECT x, y, 1 / (1 + exp(-(a + b * x))) AS p FROM e, b{i})),
b{i + 1} AS (SELECT a + (hxx * ga - hx * gb) / (h * hxx - hx * hx) AS a,
b + (h * gb - hx * ga) / (h * hxx - hx * hx) AS b FROM b{i}, g{i})"""
        )
    return ",\n".join(parts) + (
        f"\nSELECT 'intercept' AS term, round(a, 4) AS value, round(exp(a), 4) AS odds FROM b{steps}"
        f" UNION ALL SELECT 'x', round(b, 4), round(exp(b), 4) FROM b{steps}"
    )


@query("clf_logistic", newton_sql(9))
def clf_logistic(spark, folder):
    rows = noisy_purchases(spark, folder)
    frame = mo.coefficient_frame(rows, mo.logistic(rows, "y", ["x"], tol=1e-12), ["x"])
    return rounded(frame.withColumn("odds", F.exp("value")), 4)


def credit(spark, folder) -> DataFrame:
    """Customers in three bands of total spend."""
    rows = customer_features(spark, folder)
    band = F.when(F.col("total") < 1500000, 0).when(F.col("total") < 3000000, 1).otherwise(2)
    return rows.withColumn("band", band)


CREDIT = (
    CUSTOMERS
    + """, d AS (SELECT *, CASE WHEN total < 1500000 THEN 0 WHEN total < 3000000 THEN 1 ELSE 2 END AS band FROM p),
k AS (SELECT band AS class, count(*) / (SELECT count(*) FROM d) AS prior, avg(n) AS m1,
 var_pop(n) + 1e-9 * (SELECT greatest(var_pop(n), var_pop(largest)) FROM d) AS v1, avg(largest) AS m2,
 var_pop(largest) + 1e-9 * (SELECT greatest(var_pop(n), var_pop(largest)) FROM d) AS v2 FROM d GROUP BY 1),
s AS (SELECT o_custkey, band, class, ln(prior) - 0.5 * ln(2 * pi() * v1) - (n - m1) * (n - m1) / (2 * v1)
 - 0.5 * ln(2 * pi() * v2) - (largest - m2) * (largest - m2) / (2 * v2) AS score FROM d, k)
"""
)


@query(
    "clf_naive_bayes",
    CREDIT
    + """SELECT o_custkey, band, arg_max(class, score)::INTEGER AS prediction FROM s GROUP BY 1, 2""",
)
def clf_naive_bayes(spark, folder):
    rows = credit(spark, folder)
    scored = mo.bayes(rows, rows, "band", ["n", "largest"])
    return scored.select("o_custkey", "band", F.col("prediction").cast("int").alias("prediction"))


@query(
    "clf_decision_tree",
    """WITH d AS (SELECT l_quantity AS x, CASE WHEN l_quantity + 200 * l_discount < 20 THEN 0
 WHEN l_quantity + 200 * l_discount < 40 THEN 1 ELSE 2 END AS y FROM lineitem),
v AS (SELECT x, count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1, count(*) FILTER (y = 2) AS n2
 FROM d GROUP BY x),
c AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(n0) OVER w AS l0, sum(n1) OVER w AS l1, sum(n2) OVER w AS l2,
 sum(n0) OVER () AS t0, sum(n1) OVER () AS t1, sum(n2) OVER () AS t2 FROM v WINDOW w AS (ORDER BY x)),
g AS (SELECT (x + nx) / 2 AS cut, l0, l1, l2, t0 - l0 AS r0, t1 - l1 AS r1, t2 - l2 AS r2,
 (l0 * l0 + l1 * l1 + l2 * l2) / (l0 + l1 + l2) + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1)
 + (t2 - l2) * (t2 - l2)) / (t0 + t1 + t2 - l0 - l1 - l2) AS purity FROM c WHERE nx IS NOT NULL),
b AS (SELECT *, CASE WHEN l0 >= l1 AND l0 >= l2 THEN 0 WHEN l1 >= l2 THEN 1 ELSE 2 END AS lp,
 CASE WHEN r0 >= r1 AND r0 >= r2 THEN 0 WHEN r1 >= r2 THEN 1 ELSE 2 END AS rp
 FROM g ORDER BY purity DESC, cut LIMIT 1)
SELECT y AS label, CASE WHEN d.x <= cut THEN lp ELSE rp END AS prediction, count(*) AS n
FROM d, b GROUP BY 1, 2""",
)
def clf_decision_tree(spark, folder):
    total = F.col("l_quantity") + 200 * F.col("l_discount")
    rows = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("x"),
        F.when(total < 20, 0).when(total < 40, 1).otherwise(2).alias("label"),
    )
    scored = mo.predict(mo.tree(rows, "label", ["x"], 1), rows, ["x"])
    return scored.groupBy("label", F.col("prediction").cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


FRAUD_XS = ["value", "k"]


def fraud_split(spark, folder) -> tuple[DataFrame, DataFrame]:
    both = f.split(transactions(spark, folder), "event_id", 0.25, "fraud")
    return both.filter("split = 'train'"), both.filter("split = 'test'")


FULL_XS = ["value", "k", "is_error"]


def tested(scored: DataFrame, label: str) -> DataFrame:
    """Confusion counts of a test side."""
    return m.confusion(scored.select(label, F.col("prediction").cast("int").alias("prediction")), label, "prediction")


@query("clf_random_forest")
def clf_random_forest(spark, folder):
    train, test = fraud_split(spark, folder)
    return tested(mo.predict(mo.forest(train, "fraud", FULL_XS), test, FULL_XS), "fraud")


@query("clf_gbt")
def clf_gbt(spark, folder):
    train, test = fraud_split(spark, folder)
    return tested(mo.predict(mo.boosted(train, "fraud", FULL_XS), test, FULL_XS), "fraud")


@query("clf_svm")
def clf_svm(spark, folder):
    rows = credit(spark, folder)
    rows = f.standardize(rows, rows, ["n", "largest"])
    return tested(mo.predict(mo.svm(rows, "band", ["n", "largest"]), rows, ["n", "largest"]), "band")


@query("clf_calibrated")
def clf_calibrated(spark, folder):
    rows = noisy_purchases(spark, folder)
    return rounded(
        mo.calibrated_svm(rows, rows, "y", ["x"], "event_id").select("event_id", "y", "p_0", "p_1")
    )


# a given score: a purchase is expected of a high value, of a low one only with a high k
RULE = "value + 4 * k > 100"
PERMUTED = f"""WITH e AS (SELECT event_id, value, json_extract_string(props, '$.k')::DOUBLE AS k, (event_id % 7)::DOUBLE AS w,
((value > 60) <> (event_id % 4 = 0))::INTEGER AS y FROM events),
a AS (SELECT *, row_number() OVER (ORDER BY md5(event_id::VARCHAR), event_id) AS r FROM e),
b AS (SELECT value AS dv, k AS dk, row_number() OVER (ORDER BY md5(event_id::VARCHAR || '-donor'), event_id::VARCHAR || '-donor') AS r FROM e),
j AS (SELECT y, ({RULE})::INT AS base, (dv + 4 * k > 100)::INT AS pv, (value + 4 * dk > 100)::INT AS pk FROM a JOIN b USING (r)),
s AS (SELECT avg((y = base)::INT) AS base, avg((y = pv)::INT) AS v, avg((y = pk)::INT) AS k FROM j)
SELECT 'value' AS feature, round(v, 6) AS accuracy, round(base - v, 6) AS importance FROM s
UNION ALL SELECT 'k', round(k, 6), round(base - k, 6) FROM s UNION ALL SELECT 'w', round(base, 6), 0.0 FROM s"""


@query("feature_importance", PERMUTED)
def feature_importance(spark, folder):
    """By permutation, for a given score that does not use one of the features."""
    k = F.get_json_object("props", "$.k").cast("double")
    flipped = F.col("event_id") % 4 == 0
    rows = table(spark, folder, "events").select(
        "event_id", "value", k.alias("k"), (F.col("event_id") % 7).cast("double").alias("w"),
        ((F.col("value") > 60) != flipped).cast("int").alias("y"),
    )
    expected = F.expr(RULE).cast("int")
    return rounded(
        imp.permutation_importance(rows, "event_id", "y", ["value", "k", "w"], lambda d: d.withColumn("prediction", expected))
    )


@query("feature_importance_boosted")
def feature_importance_boosted(spark, folder):
    """By permutation, for boosted trees, on rows that they did not see."""
    train, test = fraud_split(spark, folder)
    model = mo.boosted(train, "fraud", FULL_XS)
    return rounded(
        imp.permutation_importance(test, "event_id", "fraud", FULL_XS, lambda d: mo.predict(model, d, FULL_XS))
    )


@query("feature_importance_shares")
def feature_importance_shares(spark, folder):
    train, _ = fraud_split(spark, folder)
    rows = [("forest", *r) for r in mo.importance(mo.forest(train, "fraud", FULL_XS), FULL_XS)]
    scaled = f.standardize(train, train, FULL_XS)
    rows += [("svm", *r) for r in mo.importance(mo.svm(scaled, "fraud", FULL_XS), FULL_XS)]
    columns = {"model": "string", "feature": "string", "share": "double"}
    return rounded(small_frame(spark, columns, rows))


# --- ensembles over given scores --------------------------------------------------------------


def members(spark, folder) -> DataFrame:
    """Three member scores per event, computed from its columns."""
    events = table(spark, folder, "events")
    value, k = F.col("value"), F.get_json_object("props", "$.k").cast("double")
    is_error = F.when(F.col("event_type") == "error", 0.9).otherwise(0.2)
    return events.select(
        "event_id",
        ((F.col("event_type") == "error") & (value > 150)).cast("int").alias("label"),
        (value / (value + 100)).alias("s1"),
        is_error.alias("s2"),
        ((k + 1) / (k + 101)).alias("s3"),
    )


MEMBERS = """WITH v AS (SELECT event_id, event_type, value, json_extract_string(props, '$.k')::DOUBLE AS k FROM events),
i AS (SELECT event_id, CASE WHEN event_type = 'error' AND value > 150 THEN 1 ELSE 0 END AS label,
value / (value + 100) AS s1, CASE WHEN event_type = 'error' THEN 0.9 ELSE 0.2 END::DOUBLE AS s2,
(k + 1) / (k + 101) AS s3 FROM v)
"""


@query(
    "ens_soft_vote",
    MEMBERS + "SELECT event_id, round((s1 + s2 + s3) / 3, 6) AS score FROM i",
)
def ens_soft_vote(spark, folder):
    rows = members(spark, folder)
    frames = {s: rows.select("event_id", F.col(s).alias("score")) for s in ("s1", "s2", "s3")}
    joined = mo.join_scores(frames, "event_id", "score")
    return rounded(mo.soft_vote(joined, ["s1", "s2", "s3"]).select("event_id", "score"))


WEIGHTS = {"s1": 2.0, "s2": 2.0, "s3": 1.0}


@query(
    "ens_risk",
    MEMBERS
    + ", s AS (SELECT event_id, label, (s1 * 2.0::DOUBLE + s2 * 2.0::DOUBLE + s3 * 1.0::DOUBLE) / 5.0::DOUBLE AS score FROM i)"
    + SWEEP
    + """, b AS (SELECT threshold AS cut FROM w ORDER BY fp * 1.0 + fn * 25.0, threshold LIMIT 1)
SELECT event_id, label, round(score, 6) AS score, CASE WHEN score >= cut THEN 1 ELSE 0 END AS prediction
FROM s, b""",
)
def ens_risk(spark, folder):
    rows = members(spark, folder)
    scored, _ = mo.risk_vote(rows, rows, "label", WEIGHTS, GRID, COST_FP, COST_FN)
    return rounded(scored.select("event_id", "label", "score", "prediction"))


@query("ml_pipeline")
def ml_pipeline(spark, folder):
    """Preparation and model as one fitted object, saved, loaded and used."""
    train, test = fraud_split(spark, folder)
    chain = Pipeline(
        stages=[
            VectorAssembler(inputCols=FULL_XS, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
            LogisticRegression(featuresCol="scaled", labelCol="fraud", maxIter=50),
        ]
    ).fit(train)
    path = scratch_path(spark, "chain")
    chain.write().save(path)
    return tested(PipelineModel.load(path).transform(test), "fraud")


@query(
    "baseline_model",
    """WITH t AS (SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1),
b AS (SELECT event_type AS guess FROM t ORDER BY n DESC, event_type LIMIT 1)
SELECT event_type AS label, guess AS prediction, count(*) AS n FROM events, b
WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1, 2""",
)
def baseline_model(spark, folder):
    events = table(spark, folder, "events")
    day = F.lit("2024-01-20").cast("timestamp_ntz")
    train, test = events.filter(F.col("ts") < day), events.filter(F.col("ts") >= day)
    scored = mo.baseline(train, test, "event_type")
    return scored.groupBy(F.col("event_type").alias("label"), "prediction").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- components and clusters ------------------------------------------------------------------


@query(
    "pca",
    CUSTOMERS
    + """, s AS (SELECT avg(n) AS a, stddev_pop(n) AS b, avg(total) AS c, stddev_pop(total) AS d FROM p),
z AS (SELECT o_custkey, (n - a) / b AS x, (total - c) / d AS y FROM p, s)
SELECT o_custkey, round((x + y) / sqrt(2), 5) AS pc1, round((x - y) / sqrt(2), 5) AS pc2,
round((1 + (SELECT corr(n, total) FROM p)) / 2, 6) AS explained FROM z""",
)
def pca(spark, folder):
    rows = customer_features(spark, folder)
    scored, _, explained = mo.pca(rows, rows, ["n", "total"], 2)
    return scored.select(
        "o_custkey",
        F.round("pc1", 5).alias("pc1"),
        F.round("pc2", 5).alias("pc2"),
        F.round(F.lit(explained[0]), 6).alias("explained"),
    )


START = [[5.0, 10.0], [10.0, 25.0], [15.0, 40.0]]
STEPS = 4


def shoppers(spark, folder) -> DataFrame:
    rows = customer_features(spark, folder)
    return rows.select("o_custkey", "n", (F.col("total") / 100000).alias("spend"), "largest")


def kmeans_sql(source: str, xs: tuple[str, str], start: list, steps: int) -> str:
    """Unrolled Lloyd steps for two features, ending in a CTE ``a`` with the cluster of each row."""
    x, y = xs

    def assign(i: int) -> str:
        d = [f"(({x} - x{j}) * ({x} - x{j}) + ({y} - y{j}) * ({y} - y{j}))" for j in range(3)]
        return f"""(SELECT s.*, CASE WHEN {d[0]} <= {d[1]} AND {d[0]} <= {d[2]} THEN 0
WHEN {d[1]} <= {d[2]} THEN 1 ELSE 2 END AS cluster FROM {source} s, c{i})"""

    first = ", ".join(
        f"{float(v[0])}::DOUBLE AS x{j}, {float(v[1])}::DOUBLE AS y{j}" for j, v in enumerate(start)
    )
    parts = [f"c0 AS (SELECT {first})"]
    for i in range(steps):
        means = ", ".join(
            f"floor(avg({x}) FILTER (cluster = {j}) * 1000000 + 0.5) / 1000000 AS x{j}, "
            f"floor(avg({y}) FILTER (cluster = {j}) * 1000000 + 0.5) / 1000000 AS y{j}"
            for j in range(3)
        )
        parts.append(f"c{i + 1} AS (SELECT {means} FROM {assign(i)})")
    parts.append(f"a AS {assign(steps)}")
    return ",\n".join(parts) + "\n"


SHOPPERS = (
    CUSTOMERS + ", q AS (SELECT o_custkey, n, total / 100000 AS spend, largest FROM p),\n"
)
CLUSTERED = SHOPPERS + kmeans_sql("q", ("n", "spend"), START, STEPS)


def clustered(spark, folder) -> DataFrame:
    rows = shoppers(spark, folder)
    centers = mo.kmeans(rows, ["n", "spend"], START, STEPS, 6)
    return mo.assign(rows, ["n", "spend"], centers)


@query("kmeans", CLUSTERED + "SELECT o_custkey, cluster FROM a")
def kmeans(spark, folder):
    return clustered(spark, folder).select("o_custkey", "cluster")


@query(
    "kmeans_centroids",
    CLUSTERED
    + "SELECT cluster, count(*) AS n_rows, round(avg(n), 6) AS n, round(avg(spend), 6) AS spend FROM a GROUP BY 1",
)
def kmeans_centroids(spark, folder):
    rows = clustered(spark, folder).withColumnRenamed("n", "orders")
    out = mo.centroids(rows, "cluster", ["orders", "spend"])
    return rounded(out.withColumnRenamed("n", "n_rows").withColumnRenamed("orders", "n"))


PROFILE = ", ".join(
    f"round(avg({c}), 6) AS mean_{c}, round(avg({c}) / (SELECT avg({c}) FROM a), 6) AS lift_{c}"
    for c in ("n", "spend", "largest")
)


@query(
    "segment_profile",
    CLUSTERED
    + f"SELECT cluster, round(count(*) / (SELECT count(*) FROM a), 6) AS share, {PROFILE} FROM a GROUP BY 1",
)
def segment_profile(spark, folder):
    rows = clustered(spark, folder)
    return rounded(mo.segment_profile(rows, "cluster", ["n", "spend", "largest"]))


@query("kmeans_choose_k")
def kmeans_choose_k(spark, folder):
    rows = mo.choose_k(shoppers(spark, folder), ["n", "spend"], [2, 3, 4, 5])
    columns = {"k": "int", "inertia": "double", "silhouette": "double"}
    return rounded(small_frame(spark, columns, rows), 4)
