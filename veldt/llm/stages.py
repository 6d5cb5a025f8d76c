"""The stages of the corpus pipeline; each takes (spark, docs, folder) and returns a DataFrame.

Rows are told apart by their id and text together, so null ids, empty texts and repeated ids are handled like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from veldt.llm import contamination, minhash, pieces, repeats, toxicity
from veldt.llm.common import map_rows, source
from veldt.llm.queries import piece_model

REJECTED_FROM = 0.5


def sheltered(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with every column but doc_id and text under a name that no operator uses, and the way back."""
    names = {c: c if c in ("doc_id", "text") else f"_kept_{i}" for i, c in enumerate(docs.columns)}

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(n).alias(c) for c, n in names.items()])

    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), back


def toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without documents that are more likely toxic, of any grade, than not."""
    docs, back = sheltered(docs)
    model = toxicity.fit_from_flags(docs, source(spark, folder, "labels"))
    scored = toxicity.severity(docs.withColumn("_text", F.col("text")), model, "_text")
    return back(scored.filter(F.col("p_toxic") < REJECTED_FROM))


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, that with the least id; of rows alike in id and text, one."""
    docs, back = sheltered(docs)
    found = minhash.near_duplicates(docs)
    kept = found.filter("kept").select(F.col("row").alias("_row")).distinct()
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    return back(keyed.join(kept, "_row", "left_semi").dropDuplicates(["_row"]))


def repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without repeated passages; a character that a cut has split goes too; n_chars is counted anew."""
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    docs, back = sheltered(docs)
    found = repeats.without_repeats(docs)

    def make():
        return lambda kept: ([k.decode(errors="ignore") for k in kept],)

    found = back(map_rows(found, make, ["kept"], [("text", StringType())]))
    return found if kind is None else found.withColumn("n_chars", F.char_length("text").cast(kind))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    docs, back = sheltered(docs)
    found = contamination.contamination(docs, source(spark, folder, "benchmark"))
    hit = found.filter("contaminated").select(F.col("doc").alias("_row")).distinct()
    return back(docs.withColumn("_row", F.xxhash64("doc_id", "text")).join(hit, "_row", "left_anti"))


def encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every text that is left, and whether they decode to it again; a column of the input that is named
    like one of these three is replaced."""
    both = pieces.decode(pieces.encode(docs.drop("ids", "n_tokens", "round_trip"), piece_model(), ids="_ids"), piece_model(), "_ids", "_decoded")
    return both.withColumns({
        "ids": F.col("_ids"),
        "n_tokens": pieces.token_count(F.col("_ids")),
        "round_trip": F.col("_decoded") == F.coalesce("text", F.lit("")),
    }).drop("_ids", "_decoded")
