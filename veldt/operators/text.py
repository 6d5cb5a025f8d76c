"""Text cleaning and weighted terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veldt.functions.columns import letters_only
from veldt.functions.fitting import literal

# fixed values: small stop-word lists for the languages of the texts
STOP_WORDS = {
    "en": ["a", "and", "are", "as", "for", "in", "is", "it", "of", "on", "that", "the", "to", "with"],
    "fr": ["dans", "de", "des", "du", "elle", "est", "et", "la", "le", "les", "pour", "que", "un", "une"],
    "de": ["das", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "und", "von", "zu"],
    "es": ["con", "de", "el", "en", "es", "la", "las", "los", "para", "por", "que", "un", "una", "y"],
}

#: bytes of text that are counted at once
BLOCK_BYTES = 8 << 20


def clean_text(df: DataFrame, column: str) -> DataFrame:
    """Lower case, letters and single blanks only."""
    return df.withColumn(column, letters_only(F.col(column)))


def tokens(
    df: DataFrame, key: str, column: str, stop_words: list[str] = (), min_length: int = 2
) -> DataFrame:
    """One row per term occurrence, without stop words and very short terms."""
    words = F.split(letters_only(F.col(column)), " ")
    kept = F.filter(
        words,
        lambda w: (F.length(w) >= min_length) & ~w.isin(list(stop_words))
        if stop_words
        else F.length(w) >= min_length,
    )
    return df.select(key, F.explode(kept).alias("term"))


def tfidf(
    df: DataFrame, key: str, column: str, stop_words: list[str] = (), min_length: int = 2
) -> DataFrame:
    """(key, term, weight): tf * (ln((1 + n) / (1 + df)) + 1), each document scaled to length 1."""
    return tfidf_cells(df, key, column, stop_words, min_length).select(key, F.inline("cells"))


def tfidf_cells(
    df: DataFrame, key: str, column: str, stop_words: list[str] = (), min_length: int = 2
) -> DataFrame:
    """(key, cells): as ``tfidf``, a row per key with an array of its (term, weight); keys without a term are left out.

    Cleaned texts are dealt into blocks by key, in one shuffle that both uses share. Each block counts its documents per
    term; one row per block and term, not per document, meets the rows of other blocks and comes back with the term's
    weight. A vocabulary of any size is never whole in one place. Rows with equal keys are one document.
    """
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("bytes")).first()
    blocks = max(1, -(-(size["bytes"] or 0) // BLOCK_BYTES))
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block")
    texts = df.select(block, F.col(key).alias("key"), letters_only(F.col(column)).alias("text")).filter("text <> ''")
    split = F.split("text", " ")
    kept = F.filter(split, lambda w: (F.length(w) >= min_length) & ~w.isin(list(stop_words)) if stop_words else F.length(w) >= min_length)
    words = texts.repartition("block").select("block", "key", kept.alias("words"))
    counted = words.groupBy("block").applyInArrow(_documents_per_term, "block int, term string, docs long")
    spread = F.sum("docs").over(Window.partitionBy("term"))
    idf = counted.select("block", "term", (F.log(literal(1 + size["n"]) / (1 + spread)) + 1).alias("idf"))
    kind = df.schema[key].dataType.simpleString()
    cells = f"key {kind}, cells array<struct<term: string, weight: double>>"
    weighed = words.groupBy("block").cogroup(idf.groupBy("block")).applyInArrow(_weights, cells)
    return weighed.select(F.col("key").alias(key), "cells")


def _term_counts(table: pa.Table) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The rows' keys as numbers, the distinct terms, and for each (key, term) that occurs both numbers and the count."""
    words = table.column("words").combine_chunks()
    keys = pc.dictionary_encode(table.column("key").combine_chunks(), null_encoding="encode").indices.to_numpy()
    terms = words.flatten().dictionary_encode()
    width = max(len(terms.dictionary), 1)
    rows = np.repeat(keys.astype(np.int64), words.value_lengths().to_numpy())
    pairs, counts = np.unique(rows * width + terms.indices.to_numpy(), return_counts=True)
    return keys, terms.dictionary, pairs // width, pairs % width, counts


def _documents_per_term(table: pa.Table) -> pa.Table:
    _, terms, _, term, _ = _term_counts(table)
    docs = np.bincount(term, minlength=len(terms))
    block = pa.array(np.full(len(terms), table.column("block")[0].as_py() if table.num_rows else 0), pa.int32())
    return pa.table({"block": block, "term": terms, "docs": docs})


def _weights(texts: pa.Table, idf: pa.Table) -> pa.Table:
    keys, terms, key, term, tf = _term_counts(texts)
    place = pc.index_in(terms, value_set=idf.column("term").combine_chunks()).to_numpy(zero_copy_only=False)
    raw = tf * idf.column("idf").to_numpy()[place[term]] if len(term) else np.zeros(0)
    lengths = np.sqrt(np.bincount(key, raw * raw))
    found, starts = np.unique(key, return_index=True)
    cells = pa.StructArray.from_arrays([terms.take(pa.array(term)), pa.array(raw / lengths[key])], ["term", "weight"])
    offsets = pa.array(np.append(starts, len(key)), pa.int32())
    first = np.unique(keys, return_index=True)[1]
    return pa.table({"key": texts.column("key").take(pa.array(first[found])), "cells": pa.ListArray.from_arrays(offsets, cells)})


def top_terms(weights: DataFrame, classes: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """The ``k`` terms of largest mean weight per class; documents without the term count as 0.

    ``weights``: rows of ``tfidf``, or of ``tfidf_cells``, of which only one row per key meets the classes.
    """
    sizes = classes.groupBy(label).agg(F.count(F.lit(1)).alias("__docs"))
    labelled = weights.join(classes.select(key, label), key)
    if "cells" in weights.columns:
        labelled = labelled.select(label, F.inline("cells"))
    means = (
        labelled.groupBy(label, "term")
        .agg(F.sum("weight").alias("__sum"))
        .join(sizes, label)
        .select(label, "term", F.round(F.col("__sum") / F.col("__docs"), 9).alias("mean_weight"))
    )
    place = F.row_number().over(
        Window.partitionBy(label).orderBy(F.col("mean_weight").desc(), F.col("term"))
    )
    return means.withColumn("position", place).filter(F.col("position") <= k)
