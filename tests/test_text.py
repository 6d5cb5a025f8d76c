"""TF-IDF by blocks of documents, against a plain count."""

import math
from collections import Counter

from pyspark.sql import functions as F

from veldt.operators import text as t


def plain(rows):
    counts = {}
    for key, text in rows:
        counts.setdefault(key, Counter()).update(w for w in (text or "").lower().split() if len(w) >= 2 and w != "the")
    df = Counter(w for c in counts.values() for w in c)
    raw = {(k, w): n * (math.log((1 + len(rows)) / (1 + df[w])) + 1) for k, c in counts.items() for w, n in c.items()}
    length = Counter()
    for (k, _), x in raw.items():
        length[k] += x * x
    return {at: x / math.sqrt(length[at[0]]) for at, x in raw.items()}


def test_blocks_give_what_a_plain_count_gives(spark, monkeypatch):
    monkeypatch.setattr(t, "BLOCK_BYTES", 40)
    rows = [(i, " ".join(f"w{'abcdefgh'[(i * j) % 8] * 2} the common" for j in range(i % 5))) for i in range(30)]
    rows = [(k, x.replace("waa", "sun")) for k, x in rows]
    # a repeated key is one document, as is the null key; texts without a term give nothing
    rows += [(3, "sun moon"), (None, "sun sand"), (None, "sea sand"), (50, None), (51, ""), (52, "a the")]
    docs = spark.createDataFrame(rows, "id int, text string")
    want = plain(rows)
    got = {(r["id"], r["term"]): r["weight"] for r in t.tfidf(docs, "id", "text", ["the"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    cells = t.tfidf_cells(docs, "id", "text", ["the"])
    assert sorted(map(str, (r["id"] for r in cells.collect()))) == sorted({str(k) for k, _ in want})

    # a row per document and block meets the others, not a row per document and term
    shuffled = cells._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(key" not in shuffled and "Exchange hashpartitioning(id" not in shuffled

    classes = docs.select("id", (F.col("id") % 2).alias("side"))
    both = [{tuple(r) for r in t.top_terms(w, classes, "id", "side", 4).collect()} for w in (cells, t.tfidf(docs, "id", "text", ["the"]))]
    assert both[0] == both[1] and len(both[0]) == 8


def test_no_documents(spark):
    assert t.tfidf(spark.createDataFrame([], "id int, text string"), "id", "text").count() == 0
    assert t.tfidf(spark.createDataFrame([(1, "a")], "id int, text string"), "id", "text").count() == 0
