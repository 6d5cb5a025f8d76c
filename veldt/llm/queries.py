"""The registered queries of this folder, over whole tables, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldt.llm import (
    byte_bpe,
    contamination,
    fingerprint,
    languages,
    middle,
    minhash,
    mixing,
    oracles,
    pieces,
    repeats,
    tag_paths,
    tools,
    toxicity,
    whitening,
)
from veldt.llm.common import source, split_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def piece_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


@query("op4_pieces")
def op4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = source(spark, folder, "documents").select("doc_id", "text")
    ids = pieces.encode(docs, piece_model()).select("doc_id", "ids")
    return pieces.decode(ids, piece_model()).select(
        "doc_id",
        pieces.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_minhash", oracles.NEAR_DUPLICATES)
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(source(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op3_contamination", oracles.CONTAMINATION)
def op3_contamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(source(spark, folder, "documents"), source(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op5_repeats")
def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.without_repeats(source(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = source(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit_from_flags(docs, source(spark, folder, "labels"))
    found = toxicity.severity(docs, model).drop("text")
    return found.withColumn("rejected", F.col("p_toxic") >= 0.5)


@query("op9_fingerprint")
def op9_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.with_edits(source(spark, folder, "documents"))


@query("op8_tag_paths")
def op8_tag_paths(spark: SparkSession, folder: str) -> DataFrame:
    pages = source(spark, folder, "pages").select("page_id", "url", "html")
    return tag_paths.extract(pages).drop("html").withColumn("n_chars", F.char_length("text").cast("long"))


@query("op2_languages")
def op2_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = source(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", split_of("doc_id", 4) == 2)
    model = languages.fit(docs.filter("NOT held_out"))
    return languages.label(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


@query("op7_tool_calls", oracles.TOOL_CALLS)
def op7_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """The tables hold no tool calls, so every turn is read as one: a turn that is not the assistant's calls a tool
    named after its role with its text, and refers to the call two turns before; an assistant's turn is the result of
    the call one turn before."""
    turns = source(spark, folder, "conversations")
    name = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    calls = turns.filter("role <> 'assistant' OR role IS NULL").select(
        "conv_id",
        name(F.col("turn")).alias("call_id"),
        F.col("role").alias("name"),
        F.to_json(F.struct("turn", F.col("text").alias("query"), (F.col("turn") > 0).alias("follows"))).alias("arguments"),
        name(F.col("turn") - 2).alias("after"),
    )
    results = turns.filter("role = 'assistant'").select("conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    schemas = spark.createDataFrame(
        [("user", "query", "string", True), ("user", "turn", "integer", True), ("user", "follows", "boolean", False),
         ("system", "query", "string", True), ("system", "turn", "integer", True)],
        "name string, field string, type string, required boolean",
    )
    return tools.linked(calls, results, schemas).withColumn("errors", F.concat_ws(",", "errors"))


@query("op1_mixing")
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = source(spark, folder, "documents").select("doc_id", "text")
    found = mixing.score(docs.withColumn("held_out", split_of("doc_id", 7) == 2))
    return found.drop("n_bytes")


@query("op11_whitening")
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(source(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query("op12_middle")
def op12_middle(spark: SparkSession, folder: str) -> DataFrame:
    return middle.digests(source(spark, folder, "documents").select("doc_id", "text"))


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encode(source(spark, folder, "documents").select("doc_id", "text"), ranks, pattern).drop("text")
    return byte_bpe.decode(ids, ranks, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
