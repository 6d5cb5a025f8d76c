"""Scalar functions and user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.functions import columns as fc
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table


@query(
    "fn_string",
    r"""SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, upper(p_name) AS upper_name,
replace(p_brand, 'Brand#', 'B-') AS brand, split_part(p_name, ' ', 2) AS noun,
regexp_replace(p_name, '[aeiou]', '*', 'g') AS masked, regexp_extract(p_brand, '([0-9]+)', 1) AS digits,
length(p_name)::INTEGER AS size, lpad(p_partkey::VARCHAR, 8, '0') AS padded, contains(p_name, 'ring') AS has_ring,
substr(p_type, 1, 3) AS short_type, concat_ws('/', p_type, p_brand) AS joined FROM part""",
)
def fn_string(spark, folder):
    name = F.col("p_name")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.upper(name).alias("upper_name"),
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("B-")).alias("brand"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("noun"),
        F.regexp_replace(name, "[aeiou]", "*").alias("masked"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).alias("digits"),
        F.length(name).alias("size"),
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("padded"),
        F.contains(name, F.lit("ring")).alias("has_ring"),
        F.substring("p_type", 1, 3).alias("short_type"),
        F.concat_ws("/", "p_type", "p_brand").alias("joined"),
    )


@query(
    "fn_math",
    """SELECT c_custkey, round(sign(c_acctbal) * ln(1 + abs(c_acctbal)), 6) AS slog,
round(sqrt(abs(c_acctbal)), 6) AS root, round(pow(c_acctbal / 1000, 2), 6) AS square,
floor(c_acctbal)::BIGINT AS low, ceil(c_acctbal)::BIGINT AS high, abs(c_acctbal) AS size,
sign(c_acctbal)::DOUBLE AS sgn, round(exp(c_acctbal / 10000), 6) AS growth,
c_custkey % 13 AS remainder, greatest(c_acctbal, 0) AS positive,
round(100 / nullif(c_nationkey, 0), 6) AS ratio,
floor(c_acctbal / 500) * 500 AS bin FROM customer""",
)
def fn_math(spark, folder):
    v = F.col("c_acctbal")
    return rounded(
        table(spark, folder, "customer").select(
            "c_custkey",
            fc.signed_log(v).alias("slog"),
            F.sqrt(F.abs(v)).alias("root"),
            F.pow(v / 1000, 2).alias("square"),
            F.floor(v).alias("low"),
            F.ceil(v).alias("high"),
            F.abs(v).alias("size"),
            F.signum(v).alias("sgn"),
            F.exp(v / 10000).alias("growth"),
            (F.col("c_custkey") % 13).alias("remainder"),
            F.greatest(v, F.lit(0.0)).alias("positive"),
            fc.safe_ratio(F.lit(100), F.col("c_nationkey")).alias("ratio"),
            fc.width_bin(v, 500).alias("bin"),
        )
    )


@query(
    "fn_date",
    """SELECT o_orderkey, date_trunc('month', o_orderdate) AS month, year(o_orderdate)::INTEGER AS yr,
quarter(o_orderdate)::INTEGER AS qtr, month(o_orderdate)::INTEGER AS mon, day(o_orderdate)::INTEGER AS dom,
(dayofweek(o_orderdate) + 1)::INTEGER AS dow, dayofyear(o_orderdate)::INTEGER AS doy,
datediff('day', o_orderdate::DATE, DATE '2001-08-01')::INTEGER AS age_days,
strftime(o_orderdate, '%Y-%m-%d') AS text, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end,
strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS due FROM orders""",
)
def fn_date(spark, folder):
    d = F.col("o_orderdate")
    end = F.lit("2001-08-01").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_trunc("month", d).cast("timestamp_ntz").alias("month"),
        F.year(d).alias("yr"),
        F.quarter(d).alias("qtr"),
        F.month(d).alias("mon"),
        F.dayofmonth(d).alias("dom"),
        F.dayofweek(d).alias("dow"),
        F.dayofyear(d).alias("doy"),
        F.datediff(end, d).alias("age_days"),
        F.date_format(d, "yyyy-MM-dd").alias("text"),
        F.last_day(d).cast("string").alias("month_end"),
        F.date_add(d, 30).cast("string").alias("due"),
    )


TOKENS_SQL = r"""WITH t AS (SELECT doc_id,
string_split(trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')), ' ') AS w FROM documents)
"""


@query(
    "fn_array",
    TOKENS_SQL
    + """SELECT doc_id, len(w)::INTEGER AS tokens, len(list_filter(w, lambda x: length(x) > 6))::INTEGER AS long_tokens,
len(list_distinct(w))::INTEGER AS distinct_tokens, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS letters,
list_contains(w, 'the') AS has_the, w[1] AS first_token FROM t""",
)
def fn_array(spark, folder):
    words = F.split(fc.letters_only(F.col("text")), " ")
    return table(spark, folder, "documents").select("doc_id", words.alias("w")).select(
        "doc_id",
        F.size("w").alias("tokens"),
        F.size(F.filter("w", lambda x: F.length(x) > 6)).alias("long_tokens"),
        F.size(F.array_distinct("w")).alias("distinct_tokens"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("letters"),
        F.array_contains("w", "the").alias("has_the"),
        F.get("w", F.lit(0)).alias("first_token"),
    )


@query(
    "fn_json",
    """SELECT event_type, count(json_extract_string(props, '$.k')) AS n,
sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS total,
count(json_extract_string(props, '$.missing')) AS absent FROM events GROUP BY 1""",
)
def fn_json(spark, folder):
    k = F.get_json_object("props", "$.k")
    return table(spark, folder, "events").groupBy("event_type").agg(
        F.count(k).alias("n"),
        F.sum(k.try_cast("long")).alias("total"),
        F.count(F.get_json_object("props", "$.missing")).alias("absent"),
    )


@query(
    "lambda_apply",
    TOKENS_SQL
    + """SELECT doc_id, array_to_string(list_transform(w, lambda x: length(x)), ' ') AS lengths,
length(text) * 2 + 1 AS doubled, length(text) % 10 AS last_digit FROM t JOIN documents USING (doc_id)""",
)
def lambda_apply(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.split(fc.letters_only(F.col("text")), " ").alias("w"),
        F.length("text").cast("long").alias("n"),
    )
    out = fc.apply_each(docs, "w", lambda x: F.length(x).cast("string"), "letters")
    out = fc.apply(out, "n", lambda n: n * 2 + 1, "doubled")
    out = fc.apply_python(out, "n", lambda s: s % 10, "bigint", "last_digit")
    return out.select(
        "doc_id", F.array_join("letters", " ").alias("lengths"), "doubled", "last_digit"
    )
