"""Writing modelled tables for reporting tools."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from veldt.session import use_checkpoints


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    use_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def write_mart(df: DataFrame, path: str, partition_by: list[str]) -> DataFrame:
    """Write partitioned parquet and read it back.

    The rebalance hint gathers each partition value for few, even files, and lets adaptive
    execution split a value that holds most of the rows.
    """
    df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
