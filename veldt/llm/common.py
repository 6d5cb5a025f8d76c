"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType

from veldt.session import checkpointed, small_batches, use_checkpoints

__all__ = ["checkpointed", "claim", "discarded", "integer_lists", "lower_ascii", "map_rows", "parts_for", "small_batches", "source", "split_of", "written"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROWS_PER_CHUNK = 512


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower case for A-Z only; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def split_of(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: compressed, and read by column; survives lost executors.

    The shuffle files of the write go when it ends, instead of when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    small_batches(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame) -> None:
    """Remove a table that ``written`` made and nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0].rpartition("/")[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def parts_for(df: DataFrame, at_least: int = 1) -> int:
    """A partition count that follows the input: the session's own, or the number of its splits if larger."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


_remembered: dict[str, Callable[[], None]] = {}


def claim(owner: str, forget: Callable[[], None] | None = None) -> None:
    """Called in a worker when a task of module ``owner`` begins: what other modules' tasks remembered there goes.

    Workers outlive tasks, and caches that serve the next task of one operator would add up over the operators of a
    pipeline. ``forget`` drops what the owner itself keeps. Freed Arrow buffers go back to the system.
    """
    for other in [o for o in _remembered if o != owner]:
        _remembered.pop(other)()
    if forget is not None:
        _remembered[owner] = forget
    pa.default_memory_pool().release_unused()


def integer_lists(column: pa.ListArray) -> list[np.ndarray | None]:
    """Lists of integers as numpy arrays, without a Python number for each; a null entry counts as -1."""
    values, at = column.values.fill_null(-1).to_numpy(), column.offsets.to_pylist()
    spans = zip(at[:-1], at[1:], column.is_valid().to_pylist(), strict=True)
    return [values[a:b] if given else None for a, b, given in spans]


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[..., tuple]],
    inputs: list[str],
    outputs: list[tuple[str, DataType]],
    chunk: int = ROWS_PER_CHUNK,
    read: Callable[[pa.Array], list] = pa.Array.to_pylist,
) -> DataFrame:
    """Add columns computed in Python from ``inputs``, in small Arrow batches; one pass, no shuffle.

    ``make`` runs once per task and returns a function of the input columns as lists that returns the output
    columns as lists; ``read`` turns an Arrow column into such a list. Other columns pass through; an input column named like an output is replaced by it.
    """
    names = [n for n, _ in outputs]
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = StructType(kept + [StructField(n, t) for n, t in outputs])
    arrow = [to_arrow_type(t) for _, t in outputs]
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(make.__module__)
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                made = fn(*(read(part.column(c)) for c in inputs))
                columns = [part.column(f.name) for f in kept]
                columns += [pa.array(v, t) for v, t in zip(made, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)
