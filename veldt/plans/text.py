"""Text queries, over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldt.operators import text as t
from veldt.operators.metrics import rounded
from veldt.plans.registry import query, table
from veldt.session import scattered

STOP = sorted({w for words in t.STOP_WORDS.values() for w in words})
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)

TOKENS = rf"""WITH w AS (SELECT doc_id, unnest(string_split(trim(regexp_replace(lower(text), '[^\p{{L}}]+',
' ', 'g')), ' ')) AS term FROM documents),
k AS (SELECT doc_id, term FROM w WHERE length(term) >= 2 AND term NOT IN ({STOP_SQL}))
"""

TFIDF = (
    TOKENS
    + """, c AS (SELECT doc_id, term, count(*) AS tf FROM k GROUP BY 1, 2),
i AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM c GROUP BY 1),
r AS (SELECT doc_id, term, tf * idf AS raw FROM c JOIN i USING (term)),
v AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM r)
"""
)


def documents(spark, folder):
    return scattered(table(spark, folder, "documents").select("doc_id", "lang", "text"))


@query(
    "text_clean",
    r"""SELECT doc_id, trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) AS text FROM documents""",
)
def text_clean(spark, folder):
    return t.clean_text(documents(spark, folder).drop("lang"), "text")


@query("text_tokens", TOKENS + "SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM k GROUP BY 1")
def text_tokens(spark, folder):
    return (
        t.tokens(documents(spark, folder), "doc_id", "text", STOP)
        .groupBy("term", "doc_id")
        .count()
        .groupBy("term")
        .agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("docs"))
    )


@query("tfidf", TFIDF + "SELECT doc_id, term, round(weight, 6) AS weight FROM v")
def tfidf(spark, folder):
    return rounded(t.tfidf(documents(spark, folder), "doc_id", "text", STOP))


@query(
    "tfidf_topterms",
    TFIDF
    + """, m AS (SELECT lang, term, round(sum(weight) / max(n), 9) AS mean_weight FROM v
JOIN documents USING (doc_id) JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY 1) USING (lang)
GROUP BY 1, 2)
SELECT lang, term, round(mean_weight, 6) AS mean_weight, row_number() OVER (PARTITION BY lang
ORDER BY mean_weight DESC, term)::INTEGER AS position FROM m QUALIFY position <= 15""",
)
def tfidf_topterms(spark, folder):
    docs = documents(spark, folder)
    weights = t.tfidf_cells(docs, "doc_id", "text", STOP)
    return rounded(t.top_terms(weights, docs, "doc_id", "lang", 15))
