"""Feature preparation queries. Fitted steps learn from orders before 1999 and apply to all."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.operators import features as f
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table

CUTOFF = "1999-01-01"


def orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_orderdate",
        "o_totalprice",
        F.month("o_orderdate").cast("double").alias("month"),
    )


def early(df):
    return df.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))


ORDERS = f"""WITH o AS (SELECT *, month(o_orderdate)::DOUBLE AS month FROM orders),
e AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '{CUTOFF}')
"""


@query(
    "scale_minmax",
    ORDERS
    + """, s AS (SELECT min(o_totalprice) a, max(o_totalprice) b, min(month) c, max(month) d FROM e)
SELECT o_orderkey, round((o_totalprice - a) / (b - a), 6) AS o_totalprice,
round((month - c) / (d - c), 6) AS month FROM o, s""",
)
def scale_minmax(spark, folder):
    rows = orders(spark, folder)
    out = f.minmax(early(rows), rows, ["o_totalprice", "month"])
    return rounded(out.select("o_orderkey", "o_totalprice", "month"))


@query(
    "scale_standard",
    ORDERS
    + """, s AS (SELECT avg(o_totalprice) a, stddev_pop(o_totalprice) b, avg(month) c,
stddev_pop(month) d FROM e)
SELECT o_orderkey, round((o_totalprice - a) / b, 6) AS o_totalprice,
round((month - c) / d, 6) AS month FROM o, s""",
)
def scale_standard(spark, folder):
    rows = orders(spark, folder)
    out = f.standardize(early(rows), rows, ["o_totalprice", "month"])
    return rounded(out.select("o_orderkey", "o_totalprice", "month"))


@query(
    "encode_label",
    """SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::BIGINT AS code FROM orders""",
)
def encode_label(spark, folder):
    rows = orders(spark, folder)
    return f.label_encode(rows, rows, "o_orderpriority", "code").select("o_orderkey", "code")


@query(
    "encode_onehot",
    """SELECT o_orderkey, (o_orderstatus = 'F')::INTEGER AS "o_orderstatus_F",
(o_orderstatus = 'O')::INTEGER AS "o_orderstatus_O", (o_orderstatus = 'P')::INTEGER AS "o_orderstatus_P"
FROM orders""",
)
def encode_onehot(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "o_orderstatus")
    return f.one_hot(rows, rows, "o_orderstatus").drop("o_orderstatus")


PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query(
    "encode_ordinal",
    """SELECT o_orderkey, (5 - substr(o_orderpriority, 1, 1)::INTEGER)::INTEGER AS urgency FROM orders""",
)
def encode_ordinal(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "o_orderpriority")
    return f.ordinal(rows, "o_orderpriority", PRIORITIES, "urgency").drop("o_orderpriority")


@query(
    "transform_feature",
    """SELECT c_custkey, round(sign(c_acctbal) * ln(1 + abs(c_acctbal)), 6) AS log_balance,
round(sign(c_acctbal) * sqrt(abs(c_acctbal)), 6) AS root_balance,
round(pow(c_acctbal, 2.0), 3) AS square_balance, floor(c_acctbal / 1000.0) * 1000.0::DOUBLE AS bin_balance
FROM customer""",
)
def transform_feature(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    out = f.transform_features(
        rows,
        {
            "log_balance": ("c_acctbal", "log", None),
            "root_balance": ("c_acctbal", "sqrt", None),
            "square_balance": ("c_acctbal", "power", 2),
            "bin_balance": ("c_acctbal", "bin", 1000),
        },
    ).drop("c_acctbal")
    return rounded(out.withColumn("square_balance", F.round("square_balance", 3)))


@query(
    "column_transformer",
    ORDERS
    + """, s AS (SELECT avg(o_totalprice) a, stddev_pop(o_totalprice) b, min(month) c, max(month) d FROM e)
SELECT o_orderkey, round((o_totalprice - a) / b, 6) AS o_totalprice, round((month - c) / (d - c), 6) AS month,
(o_orderstatus = 'F')::INTEGER AS "o_orderstatus_F", (o_orderstatus = 'O')::INTEGER AS "o_orderstatus_O",
(o_orderstatus = 'P')::INTEGER AS "o_orderstatus_P",
(dense_rank() OVER (ORDER BY o_orderpriority) - 1)::BIGINT AS "o_orderpriority_code" FROM o, s""",
)
def column_transformer(spark, folder):
    rows = orders(spark, folder)
    out = f.column_transform(
        early(rows),
        rows,
        {
            "o_totalprice": "standard",
            "month": "minmax",
            "o_orderstatus": "onehot",
            "o_orderpriority": "label",
        },
    )
    return rounded(out.drop("o_custkey", "o_orderdate"))


@query(
    "poly_features",
    """SELECT l_orderkey, l_quantity AS q, l_discount AS d, round(l_quantity * l_quantity, 6) AS "q*q",
round(l_quantity * l_discount, 6) AS "q*d", round(l_discount * l_discount, 6) AS "d*d" FROM lineitem""",
)
def poly_features(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_quantity").alias("q"), F.col("l_discount").alias("d")
    )
    return f.poly(rows, ["q", "d"], 2).select(
        "l_orderkey",
        "q",
        "d",
        *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in ("q*q", "q*d", "d*d")],
    )


@query(
    "split_train_test",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR), o_orderkey)
<= ceil(0.25 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def split_train_test(spark, folder):
    return f.split(orders(spark, folder).select("o_orderkey"), "o_orderkey", 0.25)


@query(
    "split_stratified",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus
ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) <= ceil(0.25 * count(*) OVER (PARTITION BY o_orderstatus))
THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def split_stratified(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "o_orderstatus")
    return f.split(rows, "o_orderkey", 0.25, "o_orderstatus")


LABELLED = """WITH d AS (SELECT doc_id, toxic, n_chars FROM labels JOIN documents USING (doc_id))
"""


def labelled(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return table(spark, folder, "labels").select("doc_id", "toxic").join(docs, "doc_id")


@query(
    "class_weights",
    LABELLED
    + """SELECT doc_id, toxic, round(count(*) OVER () / ((SELECT count(DISTINCT toxic) FROM d)
* count(*) OVER (PARTITION BY toxic)), 6) AS weight FROM d""",
)
def class_weights(spark, folder):
    return rounded(f.class_weights(labelled(spark, folder), "toxic").drop("n_chars"))


@query(
    "balance_undersample",
    LABELLED
    + """, r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic
ORDER BY md5(doc_id::VARCHAR), doc_id) AS p FROM d)
SELECT doc_id, toxic FROM r WHERE p <= (SELECT min(n) FROM (SELECT count(*) AS n FROM d GROUP BY toxic))""",
)
def balance_undersample(spark, folder):
    return f.undersample(labelled(spark, folder).drop("n_chars"), "toxic", "doc_id")


@query(
    "balance_oversample",
    LABELLED
    + """, m AS (SELECT max(n) AS big FROM (SELECT count(*) AS n FROM d GROUP BY toxic)),
r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5(doc_id::VARCHAR), doc_id) AS p,
count(*) OVER (PARTITION BY toxic) AS n FROM d)
SELECT doc_id, toxic, unnest(range(1, (big // n + CASE WHEN p <= big % n THEN 1 ELSE 0 END + 1)::BIGINT))::INTEGER AS copy
FROM r, m""",
)
def balance_oversample(spark, folder):
    return f.oversample(labelled(spark, folder).drop("n_chars"), "toxic", "doc_id")


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "feature_select",
    "WITH x AS (SELECT *, (l_quantity > 25 OR l_discount > 0.08)::INTEGER AS y FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, 'correlation' AS method, round(abs(corr({c}, y)), 6) AS score FROM x "
        f"UNION ALL SELECT '{c}', 'variance', round(var_pop({c}), 4) FROM x"
        for c in LINE_FEATURES
    ),
)
def feature_select(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn(
        "y", ((F.col("l_quantity") > 25) | (F.col("l_discount") > 0.08)).cast("int")
    )
    tables = []
    for method, places in (("correlation", 6), ("variance", 4)):
        scores = f.rank_features(lines, "y", LINE_FEATURES, method)
        tables.append(
            scores.select("feature", F.lit(method).alias("method"), F.round("score", places).alias("score"))
        )
    return tables[0].unionByName(tables[1])


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "feature_engineer",
    "SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, max(value) AS largest, "
    + ", ".join(f"count(*) FILTER (event_type = '{t}') AS n_{t}" for t in EVENT_TYPES)
    + """, round(sum(value) / count(*), 6) AS mean_value,
datediff('day', min(ts)::DATE, max(ts)::DATE)::INTEGER AS active_span, """
    + ", ".join(
        f"round(count(*) FILTER (event_type = '{t}') / count(*), 6) AS share_{t}"
        for t in EVENT_TYPES
    )
    + " FROM events GROUP BY 1",
)
def feature_engineer(spark, folder):
    events = table(spark, folder, "events")
    out = f.engineer(events, "user_id", "ts", "value", "event_type", EVENT_TYPES)
    return rounded(out.withColumn("total", F.round("total", 4)))


@query(
    "leakage_guard",
    ORDERS
    + """, b AS (SELECT *, (o_totalprice > 250000)::INTEGER AS y, floor(o_totalprice / 50000) AS price_band FROM o),
t AS (SELECT * FROM b WHERE o_orderdate < TIMESTAMP '1999-01-01'),
v AS (SELECT * FROM b WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
p AS (SELECT 'price_band' AS subject, price_band::VARCHAR AS x, y FROM t
      UNION ALL SELECT 'o_orderstatus', o_orderstatus, y FROM t UNION ALL SELECT 'o_custkey', o_custkey::VARCHAR, y FROM t),
q AS (SELECT subject, x, min(y) <> max(y) AS mixed FROM p GROUP BY 1, 2)
SELECT 'shared_keys' AS "check", 'o_custkey' AS subject, count(DISTINCT o_custkey) AS n FROM v
WHERE o_custkey IN (SELECT o_custkey FROM t)
UNION ALL SELECT 'mixed_values', subject, count(*) FILTER (mixed) FROM q GROUP BY subject
UNION ALL SELECT 'values', subject, count(*) FROM q GROUP BY subject""",
)
def leakage_guard(spark, folder):
    rows = orders(spark, folder).withColumns(
        {
            "y": (F.col("o_totalprice") > 250000).cast("int"),
            "price_band": F.floor(F.col("o_totalprice") / 50000),
        }
    )
    late = rows.filter(F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp_ntz"))
    return f.leakage_report(
        early(rows), late, "o_custkey", ["price_band", "o_orderstatus", "o_custkey"], "y"
    )


def transactions(spark, folder):
    """Events with a rare planted class and three numeric features."""
    events = table(spark, folder, "events")
    fraud = (F.col("event_type") == "error") & (F.col("value") > 150)
    return events.select(
        "event_id",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        fraud.cast("int").alias("fraud"),
        (F.col("event_type") == "error").cast("double").alias("is_error"),
    )


@query(
    "smote",
    """WITH e AS (SELECT event_id, value, json_extract_string(props, '$.k')::DOUBLE AS k,
CASE WHEN event_type = 'error' AND value > 150 THEN 1 ELSE 0 END AS fraud FROM events),
c AS (SELECT count(*) FILTER (fraud = 1) AS s, count(*) FILTER (fraud = 0) - count(*) FILTER (fraud = 1) AS lack FROM e),
m AS (SELECT event_id, value, k, row_number() OVER (ORDER BY md5(event_id::VARCHAR), event_id) AS p
FROM e WHERE fraud = 1),
n AS (SELECT a.event_id, b.value AS nv, b.k AS nk, row_number() OVER (PARTITION BY a.event_id
ORDER BY (a.value - b.value) * (a.value - b.value) + (a.k - b.k) * (a.k - b.k), b.value, b.k) AS r
FROM m a JOIN m b ON a.event_id <> b.event_id QUALIFY r <= 5),
d AS (SELECT event_id, value, k,
unnest(range(1, (lack // s + CASE WHEN p <= lack % s THEN 1 ELSE 0 END + 1)::BIGINT))::INTEGER AS copy
FROM m, c),
g AS (SELECT *, ('0x' || substr(md5(event_id || ':' || copy), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS gap,
('0x' || substr(md5(event_id || ':' || copy), 9, 8))::BIGINT % 5 + 1 AS r FROM d)
SELECT event_id, copy, round(value + gap * (nv - value), 6) AS value, round(k + gap * (nk - k), 6) AS k
FROM g JOIN n USING (event_id, r)""",
)
def smote(spark, folder):
    rows = transactions(spark, folder)
    return rounded(f.smote(rows, "fraud", 1, ["value", "k"], "event_id", 5))
