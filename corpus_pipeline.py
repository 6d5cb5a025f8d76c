"""The corpus pipeline: stages over the documents, each calling one operator of ``veldt.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veldt.llm import stages
from veldt.llm.common import discarded, written

STAGES = [
    ("toxicity", stages.toxic),
    ("minhash_near_dedup", stages.near_dedup),
    ("suffix_array_dedup", stages.repeated_passages),
    ("benchmark_decontamination", stages.decontamination),
    ("sentencepiece", stages.encoding),
]

#: No SQL expresses a fitted model or token ids; the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over all documents; each stage's rows are stored, and removed when the next are."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            discarded(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
