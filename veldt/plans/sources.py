"""Queries over the readers and the mart writer."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table
from veldt.sources import marts, payloads, prices, tabular


@query(
    "src_tabular",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def src_tabular(spark, folder):
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return tabular.load(spark, f"{folder}/customer.parquet", "parquet", schema)


@query(
    "src_api_json",
    "SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events",
)
def src_api_json(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props")
    return payloads.parse_payload(events, "props", "k int").drop("props")


def _unescape_sql() -> str:
    """The named entities, written for SQL; the pages hold no numeric ones."""
    out = "{0}"
    for name, shown in payloads.ENTITIES.items():
        quoted = shown.replace("'", "''")
        out = f"replace({out}, '{name}', '{quoted}')"
    return out


UNESCAPE = _unescape_sql()


def _sql_text(expr: str) -> str:
    return f"trim(regexp_replace({UNESCAPE.format(expr)}, '[ \\t\\r\\n]+', ' ', 'g'))"


@query(
    "src_html_extract",
    "SELECT page_id, "
    + _sql_text(r"regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
    + " AS title, "
    + r"""array_to_string(regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1), ' ') AS links, """
    + _sql_text(
        r"regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>"
        r"|<head\b.*?</head>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
    )
    + " AS text FROM pages",
)
def src_html_extract(spark, folder):
    pages = table(spark, folder, "pages")
    return payloads.extract_html(pages, "html").select(
        "page_id", "title", F.array_join("links", " ").alias("links"), "text"
    )


@query(
    "src_prices_daily",
    """SELECT event_type AS symbol, date_trunc('day', ts) AS day,
arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
count(value) AS ticks FROM events GROUP BY 1, 2""",
)
def src_prices_daily(spark, folder):
    ticks = table(spark, folder, "events").withColumnRenamed("event_type", "symbol")
    return prices.ohlc(ticks, ["symbol"], "ts", "value", "event_id")


SQL_VIEW = """
SELECT n_name, c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'F' GROUP BY n_name, c_mktsegment"""


@query("src_sql_view", SQL_VIEW)
def src_sql_view(spark, folder):
    tabular.register(spark, folder, ["orders", "customer", "nation"])
    return spark.sql(SQL_VIEW)


@query(
    "sink_bi_mart",
    """SELECT year(o_orderdate)::INTEGER AS order_year, o_orderstatus, o_custkey,
count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2, 3""",
)
def sink_bi_mart(spark, folder):
    mart = (
        table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("order_year"), "o_orderstatus", "o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"))
    )
    path = marts.scratch_path(spark, "mart")
    return rounded(marts.write_mart(mart, path, ["order_year"]), 2)
