"""Whole projects on the given tables."""

from __future__ import annotations

from pyspark.ml import classification as C
from pyspark.sql import functions as F

from veldt.functions.fitting import fit_categories, small_frame
from veldt.operators import clean, eda
from veldt.operators import features as f
from veldt.operators import metrics as m
from veldt.operators import models as mo
from veldt.operators import projects as p
from veldt.operators import stats as s
from veldt.operators import tuning as t
from veldt.operators.metrics import rounded
from veldt.plans.features import transactions
from veldt.plans.metrics import COST_FN, COST_FP, GRID
from veldt.plans.models import (
    CREDIT,
    FULL_XS,
    SHOPPERS,
    credit,
    fraud_split,
    kmeans_sql,
    shoppers,
)
from veldt.plans.registry import query, table
from veldt.plans.star import STAR_SQL, star_query
from veldt.session import stored, training_cache
from veldt.sources.marts import scratch_path, write_mart


@query("p_fraud")
def p_fraud(spark, folder):
    report = p.risk_report(transactions(spark, folder), "fraud", FULL_XS, "event_id", GRID, COST_FP, COST_FN)
    return rounded(report)


@query("p_fraud_curves")
def p_fraud_curves(spark, folder):
    """The curves and the confusion table behind the figures of ``p_fraud``."""
    return rounded(p.risk_curves(transactions(spark, folder), "fraud", FULL_XS, "event_id", GRID, COST_FP, COST_FN))


@query("p_news_topics")
def p_news_topics(spark, folder):
    """Language of whole documents: logistic regression and linear machines over term weights, searched and compared."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    langs = fit_categories(docs, "lang")
    docs = f.ordinal(docs, "lang", langs, "label").filter("label IS NOT NULL")
    return rounded(p.topic_report(docs, "doc_id", "text", "label", len(langs)))


@query("p_online_purchase")
def p_online_purchase(spark, folder):
    """Heavy buyers: gaps filled, columns scaled and encoded, models with and without components."""
    events = table(spark, folder, "events")
    kinds = ["click", "error", "signup", "view"]
    users = f.engineer(events, "user_id", "ts", "value", "event_type", kinds)
    buys = events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("buys")
    )
    middle = clean.fit_quantiles(buys, ["buys"], [0.5])["buys"][0]
    users = users.join(buys, "user_id").withColumns(
        {
            "y": (F.col("buys") > middle).cast("int"),
            "total": F.when(F.col("user_id") % 9 != 0, F.col("total")),
            "tier": F.when(F.col("n") > 68, "busy").otherwise("calm"),
        }
    )
    users = f.split(users, "user_id", 0.25, "y")
    numbers = ["total", "mean_value", "n_click", "n_view"]
    steps = {**{x: "standard" for x in numbers}, "tier": "onehot"}
    rows = []
    with training_cache(users.select("split", "y", *steps)) as cached:
        train, test = cached.filter("split = 'train'"), cached.filter("split = 'test'")
        gaps = clean.fit_impute(train, ["total"], "median")
        train, test = clean.fill(train, gaps), clean.fill(test, gaps)
        train, test = f.column_transform(train, train, steps), f.column_transform(train, test, steps)
        xs = [*numbers, *[c for c in train.columns if c.startswith("tier_")]]
        train_pc, _, _ = mo.pca(train, train, numbers, 2)
        test_pc, _, _ = mo.pca(train, test, numbers, 2)
        for view, left, right, names in (
            ("plain", train, test, xs),
            ("components", train_pc, test_pc, ["pc1", "pc2"]),
        ):
            models = {
                "logistic": mo.logistic(left, "y", names, reg=0.01),
                "forest": mo.forest(left, "y", names),
            }
            for name, model in models.items():
                scored = mo.predict(model, right, names, "prediction", "score")
                picked = F.col("prediction").cast("int").alias("prediction")
                with training_cache(scored.select("y", picked, "score")) as judged:
                    ones = m.precision_recall_f1(judged, "y", "prediction")
                    ones = ones.filter("class = 1").first()
                    auc = m.roc_auc(judged, "y", "score").first()["roc_auc"]
                rows.append((name, view, ones["recall"], ones["f1"], auc))
    columns = {
        "model": "string", "view": "string", "recall": "double", "f1": "double", "roc_auc": "double",
    }
    return rounded(small_frame(spark, columns, rows))


CHURN_COLUMNS = ["recency", "frequency", "amount", "c_acctbal"]


@query(
    "p_churn_prep",
    """WITH r AS (SELECT c_custkey, c_acctbal, datediff('day', max(o_orderdate)::DATE, DATE '2001-08-01')::DOUBLE AS recency,
count(o_orderkey)::DOUBLE AS frequency, coalesce(sum(o_totalprice) / 1000, 0) AS amount
FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-10-01') ON c_custkey = o_custkey
GROUP BY 1, 2), d AS (SELECT *, (recency IS NULL OR recency > 200)::INTEGER AS churned FROM r),
l AS (SELECT churned, "column", v FROM (SELECT churned, recency, frequency, amount, c_acctbal FROM d)
UNPIVOT INCLUDE NULLS (v FOR "column" IN (recency, frequency, amount, c_acctbal)))
SELECT churned, "column", count(v) AS n, count(*) - count(v) AS missing, round((count(*) - count(v)) / count(*), 5) AS missing_rate,
round(avg(v), 5) AS mean, round(stddev_samp(v), 5) AS std,
round(min(v), 5) AS "min", round(max(v), 5) AS "max" FROM l GROUP BY 1, 2""",
)
def p_churn_prep(spark, folder):
    """The churn base with all customers, those without a recent order too: gaps and summary per class and column."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    orders = table(spark, folder, "orders").filter("o_orderdate >= TIMESTAMP_NTZ '2000-10-01'")
    orders = orders.select(
        F.col("o_custkey").alias("c_custkey"),
        "o_orderdate",
        (F.col("o_totalprice") / 1000).alias("spend"),
    )
    base = eda.churn_features(orders, customers, "c_custkey", "o_orderdate", "spend", "2001-08-01", 200)
    base = base.withColumns({c: F.col(c).cast("double") for c in ("recency", "frequency")})
    return rounded(p.churn_profile(base, "churned", CHURN_COLUMNS), 5)


@query(
    "p_credit_score",
    CREDIT
    + """, r AS (SELECT o_custkey, band, arg_max(class, score)::INTEGER AS prediction FROM s GROUP BY 1, 2)
SELECT band, prediction, count(*) AS n FROM r GROUP BY 1, 2""",
)
def p_credit_score(spark, folder):
    """Bands by naive Bayes over the whole base (see p_credit_tree for the tree)."""
    rows = credit(spark, folder)
    scored = mo.bayes(rows, rows, "band", ["n", "largest"])
    prediction = F.col("prediction").cast("int").alias("prediction")
    return scored.groupBy("band", prediction).agg(F.count(F.lit(1)).alias("n"))


@query("p_credit_tree")
def p_credit_tree(spark, folder):
    """Split, balance the training side with new rows, fit the tree, and check for leaks."""
    xs = ["n", "largest", "mean_spend"]
    # some thirty jobs read the rows below; the orders are summed once for all of them
    rows = stored(credit(spark, folder).withColumn("mean_spend", F.col("total") / F.col("n")))
    both = f.split(rows, "o_custkey", 0.25, "band")
    train, test = both.filter("split = 'train'"), both.filter("split = 'test'")
    balanced = train.select("band", *xs)
    for band in (0, 1, 2):
        new = f.smote(train, "band", band, xs, "o_custkey", 5)
        balanced = balanced.unionByName(new.select(F.lit(band).alias("band"), *xs))
    model = mo.tree(balanced, "band", xs, 5)
    reports = {
        side: mo.predict(model, part, xs).withColumn(
            "prediction", F.col("prediction").cast("int")
        )
        for side, part in (("train", train), ("test", test))
    }
    leaks = f.leakage_report(train, test, "o_custkey", ["n"], "band")
    shared = leaks.filter("check = 'shared_keys'").first()["n"]
    out = t.compare(reports, "band", "prediction")
    return rounded(out.withColumn("shared_keys", F.lit(shared)))


RIDGE_ALPHA, LASSO_ALPHA = 50000.0, 20.0


@query(
    "p_rent_regression",
    """WITH r AS (SELECT l_orderkey % 4 = 0 AS held, l_quantity AS x, l_extendedprice / 1000 + l_quantity AS y FROM lineitem),
m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx FROM r WHERE NOT held),
b AS (SELECT 'linear' AS model, sxy / sxx AS b, mx, my FROM m UNION ALL
 SELECT 'ridge', sxy / (sxx + 50000.0 / n), mx, my FROM m UNION ALL
 SELECT 'lasso', sign(sxy) * greatest(abs(sxy) - 20.0, 0) / sxx, mx, my FROM m UNION ALL
 SELECT 'elastic', sign(sxy) * greatest(abs(sxy) - 10.0, 0) / (sxx + 10.0), mx, my FROM m),
q AS (SELECT avg(x) AS mx, avg(x * x) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(x * x) AS zz,
 covar_pop(x, x * x) AS xz, covar_pop(x, y) AS xy, covar_pop(x * x, y) AS zy, 1 / (1 - pow(corr(x, x * x), 2)) AS vif FROM r WHERE NOT held),
w AS (SELECT mx, mz, my, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b1,
 (xx * zy - xz * xy) / (xx * zz - xz * xz) AS b2 FROM q),
t AS (SELECT model, held, y, my + b * (x - mx) AS p FROM r, b UNION ALL
 SELECT 'polynomial', held, y, my + b1 * (x - mx) + b2 * (x * x - mz) FROM r, w),
s AS (SELECT model, held, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2 FROM t GROUP BY 1, 2)
SELECT a.model, round(a.rmse, 4) AS train_rmse, round(b.rmse, 4) AS rmse, round(b.rmse - a.rmse, 4) AS gap, round(b.mae, 4) AS mae,
round(b.r2, 4) AS r2, round(CASE WHEN a.model = 'polynomial' THEN vif ELSE 1 END, 4) AS vif
FROM s a JOIN s b ON a.model = b.model AND NOT a.held AND b.held, q""",
)
def p_rent_regression(spark, folder):
    """Five regressions fitted on one side and judged on the other, with the gap and the columns' collinearity."""
    rents = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 4 == 0).alias("held"),
        F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000 + F.col("l_quantity")).alias("y"),
    )
    return rounded(p.regression_report(rents, "held", "y", "x", RIDGE_ALPHA, LASSO_ALPHA), 4)


@query("p_ecommerce_mart", STAR_SQL)
def p_ecommerce_mart(spark, folder):
    """The star aggregate, written as a partitioned mart and read back."""
    return write_mart(star_query(spark, folder), scratch_path(spark, "sales"), ["order_year"])


@query("p_cardio")
def p_cardio(spark, folder):
    """Planted long-document class: balanced, standardised logistic regression with odds ratios."""
    words = F.size(F.split("text", " "))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.log1p(F.col("n_chars").cast("double")).alias("size"),
        F.log1p(words.cast("double")).alias("words"),
        ((F.col("n_chars") > 1000) != (F.col("doc_id") % 6 == 0)).cast("int").alias("y"),
    )
    xs = ["size", "words"]
    both = f.split(docs, "doc_id", 0.25, "y")
    train, test = both.filter("split = 'train'"), both.filter("split = 'test'")
    scaled, scaled_test = f.standardize(train, train, xs), f.standardize(train, test, xs)
    balanced = scaled.select("y", *xs)
    for label in (0, 1):
        new = f.smote(scaled, "y", label, xs, "doc_id", 5)
        balanced = balanced.unionByName(new.select(F.lit(label).alias("y"), *xs))
    model = mo.logistic(balanced, "y", xs, reg=0.001)
    inflation = {r["feature"]: r["vif"] for r in s.vif(scaled, xs).collect()}
    scored = mo.predict(model, scaled_test, xs, "prediction", "score")
    auc = m.roc_auc(scored, "y", "score").first()["roc_auc"]
    # the cut is chosen on the training side; the test side only judges
    learned = mo.predict(model, scaled, xs, "prediction", "score")
    best = m.cost_curve(learned, "y", "score", GRID, 1.0, 2.0).filter("is_best = 1").first()
    rows = [
        (x, odds, inflation[x], auc, best["threshold"]) for x, odds in mo.odds_ratios(model, xs)
    ]
    columns = {
        "feature": "string", "odds_ratio": "double", "vif": "double", "roc_auc": "double",
        "threshold": "double",
    }
    return rounded(small_frame(spark, columns, rows), 4)


MALL_START = [[-1.0, -1.0], [0.0, 0.0], [1.0, 1.0]]


@query(
    "p_mall_segments",
    SHOPPERS
    + """w AS (SELECT avg(n) a, stddev_pop(n) b, avg(spend) c, stddev_pop(spend) d FROM q),
z AS (SELECT o_custkey, n, spend, (n - a) / b AS zn, (spend - c) / d AS zs FROM q, w),
"""
    + kmeans_sql("z", ("zn", "zs"), MALL_START, 6)
    + """SELECT cluster, round(count(*) / (SELECT count(*) FROM a), 6) AS share, round(avg(n), 6) AS mean_n,
round(avg(n) / (SELECT avg(n) FROM a), 6) AS lift_n, round(avg(spend), 6) AS mean_spend,
round(avg(spend) / (SELECT avg(spend) FROM a), 6) AS lift_spend FROM a GROUP BY 1""",
)
def p_mall_segments(spark, folder):
    rows = shoppers(spark, folder).select("o_custkey", "n", "spend")
    rows = rows.withColumns({"zn": F.col("n"), "zs": F.col("spend")})
    scaled = f.standardize(rows, rows, ["zn", "zs"])
    centers = mo.kmeans(scaled, ["zn", "zs"], MALL_START, 6, 6)
    parts = mo.assign(scaled, ["zn", "zs"], centers)
    return rounded(mo.segment_profile(parts, "cluster", ["n", "spend"]))


@query("p_iot_alarms")
def p_iot_alarms(spark, folder):
    """Event types as alarm classes: cross-validated forest grid, with importances."""
    events = table(spark, folder, "events")
    kinds = fit_categories(events, "event_type")
    rows = f.ordinal(events, "event_type", kinds, "label").select(
        "event_id",
        "label",
        (F.col("value") + 100.0 * F.col("label")).alias("sensor"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
    )
    xs = ["sensor", "k", "hour"]
    rows = mo.stratified_folds(rows, "event_id", "label", 3)
    search, scores = t.grid_search(
        rows,
        C.RandomForestClassifier(numTrees=10, seed=7),
        "label",
        xs,
        {"maxDepth": [3, 6]},
        "accuracy",
        "fold",
        3,
    )
    out = [("accuracy", params, mean) for params, mean, _ in scores]
    out += [("importance", x, v) for x, v in mo.importance(search.bestModel, xs)]
    columns = {"kind": "string", "name": "string", "value": "double"}
    return rounded(small_frame(spark, columns, out), 4)


@query("p_fetal_health")
def p_fetal_health(spark, folder):
    """Several classifiers for three planted classes of embeddings, compared on a held-out side."""
    wide = table(spark, folder, "embeddings")
    xs = [f"e{i}" for i in range(64)]
    planted = (F.col("embedding")[0] > 0).cast("int") + (F.col("embedding")[1] > 0).cast("int")
    rows = wide.select(
        "vec_id",
        planted.alias("label"),
        *[F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(xs)],
    )
    both = f.split(rows, "vec_id", 0.25, "label")
    train, test = both.filter("split = 'train'"), both.filter("split = 'test'")
    out = test
    models = {
        "logistic": mo.logistic(train, "label", xs, reg=0.01),
        "tree": mo.tree(train, "label", xs, 4),
        "forest": mo.forest(train, "label", xs),
    }
    for name, model in models.items():
        out = mo.predict(model, out, xs, name)
    out = mo.bayes(train, out, "label", xs, "bayes")
    out = mo.baseline(train, out, "label", "baseline")
    return rounded(t.compare_columns(out, "label", [*models, "bayes", "baseline"]))


@query("p_boost_svm_vote")
def p_boost_svm_vote(spark, folder):
    """Boosted trees, a calibrated machine and logistic regression, and their soft vote."""
    train, test = fraud_split(spark, folder)
    xs = FULL_XS
    train, test = f.standardize(train, train, xs), f.standardize(train, test, xs)
    out = mo.predict(mo.boosted(train, "fraud", xs), test, xs, "__a", "boosted").drop("__a")
    line = mo.logistic(train, "fraud", xs, reg=0.001)
    out = mo.predict(line, out, xs, "__b", "logistic").drop("__b")
    out = mo.calibrated_svm(train, out, "fraud", xs, "event_id").withColumnRenamed("p_1", "svm")
    out = mo.soft_vote(out, ["boosted", "logistic", "svm"], "vote")
    out = out.select("fraud", "boosted", "logistic", "svm", "vote")
    with training_cache(out) as scored:
        rows = [
            (
                name,
                m.roc_auc(scored, "fraud", name).first()["roc_auc"],
                m.average_precision(scored, "fraud", name).first()["average_precision"],
            )
            for name in ("boosted", "logistic", "svm", "vote")
        ]
    columns = {"model": "string", "roc_auc": "double", "average_precision": "double"}
    return rounded(small_frame(spark, columns, rows))
