"""Whitening of embeddings with distributed block matrices.

Vectors are scaled to whole numbers and packed into blocks of rows, stored once. The fit list, every distinct vector
once, is centred block by block into a ``BlockMatrix``; its transpose times itself is the scatter, with the long inner
dimension dealt over all tasks. The scatter is dimension by dimension large, so its eigenvectors are found on the
driver, and a second block multiplication by the whitening matrix projects the rows of all vectors.

Blocks are numbered within the partitions that wrote them and filled up with rows of zeros, which add nothing; so
neither matrix needs a shuffle to be built. A block multiplication lists the blocks' coordinates on the driver, so the
number of rows in a block grows with the table once there would be more than ``MAX_BLOCKS``.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are rows of
another length than most (of equally frequent lengths, the greatest stays); repeated rows and repeated ids give a row
each; a null id is an id like others; an empty table gives an empty table. A component without variance (all vectors
equal, or fewer distinct ones than dimensions) has whitened NULL and does not count for the identity error; explained is
NULL where nothing varies. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from veldt.llm.common import parts_for, written

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS, BLOCK_COLUMNS = 1024, 1024
MAX_BLOCKS = 1 << 18
#: a component's share of the greatest variance from which on it counts as varying
RANK_TOLERANCE = 1e-12


def scaled(df: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, x): whole-number vectors of the rows that are complete and finite."""
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(embedding, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    return df.filter(F.coalesce(finite & (F.size(embedding) > 0), F.lit(False))).select(F.col(vec_id).alias("vec_id"), whole.alias("x"))


def packed(rows: DataFrame, block_rows: int) -> DataFrame:
    """Stored blocks (part, at, n, x, ids) of rows (x, vec_id) or (x): the at-th block of a partition holds the numbers
    of n vectors, row by row."""
    ids = rows.schema["vec_id"].dataType if "vec_id" in rows.columns else LongType()
    schema = StructType([
        StructField("part", IntegerType()), StructField("at", IntegerType()), StructField("n", IntegerType()),
        StructField("x", BinaryType()), StructField("ids", ArrayType(ids)),
    ])
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            x = table.column("x").combine_chunks().flatten().to_numpy().astype("<i8").tobytes()
            names = table.column("vec_id").to_pylist() if "vec_id" in table.column_names else None
            values = ([part], [at], [table.num_rows], [x], [names])
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=schema.names)

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block_rows:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, block_rows))
                at += 1
                held = table.slice(block_rows).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return written(rows.mapInArrow(run, schema))


def numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """The blocks with a column ``block``, from 0 on without gaps, and their number."""
    counts = sorted((r["part"], r["count"]) for r in blocks.groupBy("part").count().collect())
    first, total = {}, 0
    for part, count in counts:
        first[part] = total
        total += count
    if not first:
        return blocks.withColumn("block", F.lit(0)), 0
    # one entry per partition that wrote blocks
    offset = F.broadcast(blocks.sparkSession.createDataFrame(list(first.items()), "part int, first int"))
    return blocks.join(offset, "part").withColumn("block", F.col("first") + F.col("at")), total


def sums(blocks: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """How many vectors there are and the sum of each dimension, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for batch in batches:
            for x in batch.column("x"):
                rows = np.frombuffer(x.as_buffer(), "<i8").reshape(-1, width)
                n += len(rows)
                total += rows.sum(axis=0)
        columns = [pa.array(np.arange(-1, width), pa.int32()), pa.array([n, *total.tolist()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["dimension", "total"])

    found = blocks.select("x").mapInArrow(run, "dimension int, total long").groupBy("dimension").agg(F.sum("total").alias("total"))
    by_dimension = {r["dimension"]: r["total"] for r in found.collect()}
    return by_dimension.get(-1, 0), np.array([by_dimension.get(j, 0) for j in range(width)], np.int64)


def centred(blocks: DataFrame, count: int, width: int, block_rows: int, means: np.ndarray) -> BlockMatrix:
    """The block matrix of the vectors less their means; rows that fill up a block are zero."""

    def entries(row) -> list:
        rows = np.zeros((block_rows, width))
        rows[: row["n"]] = np.frombuffer(row["x"], "<i8").reshape(-1, width) - means
        out = []
        for j, at in enumerate(range(0, width, BLOCK_COLUMNS)):
            piece = rows[:, at : at + BLOCK_COLUMNS]
            out.append(((row["block"], j), DenseMatrix(*piece.shape, piece.ravel(order="F"))))
        return out

    made = blocks.select("block", "n", "x").rdd.flatMap(entries)
    matrix = BlockMatrix(made, block_rows, BLOCK_COLUMNS, count * block_rows, width)
    return matrix.persist(StorageLevel.MEMORY_AND_DISK)


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left x right with the inner dimension dealt over ``splits`` tasks; the Python method lacks that parameter."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def local_blocks(spark, matrix: np.ndarray) -> BlockMatrix:
    """A small matrix (a row per dimension) as a block matrix."""
    rows, columns = matrix.shape
    pieces = [matrix[at : at + BLOCK_COLUMNS] for at in range(0, rows, BLOCK_COLUMNS)]
    blocks = [((i, 0), DenseMatrix(*p.shape, p.ravel(order="F"))) for i, p in enumerate(pieces)]
    return BlockMatrix(spark.sparkContext.parallelize(blocks, 1), BLOCK_COLUMNS, columns, rows, columns)


def principal(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues in falling order and their unit eigenvectors as columns; each vector's largest entry is
    positive, so reruns agree."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * sign


def identity_error(projected: BlockMatrix, n: int, size: int) -> float:
    """Largest absolute entry of the projected fit list's covariance minus the identity."""

    def gram(entry) -> np.ndarray:
        z = entry[1].toArray()
        return z.T @ z

    total = projected.blocks.map(gram).treeReduce(lambda a, b: a + b)
    return float(np.abs(total / n - np.eye(size)).max())


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[Decimal]:
    """Sum over dimensions of (n x - total)^2 for each row, exact at any size."""
    total = [int(t) for t in total]
    bound = x.shape[1] * int(np.abs(x).max(initial=0)) * max(map(abs, total))
    own = x if x.shape[1] * int(np.abs(x).max(initial=0)) ** 2 < 1 << 62 else x.astype(object)
    cross = x if bound < 1 << 62 else x.astype(object)
    square = (own * own).sum(axis=1).tolist()
    mixed = (cross * np.array(total, dtype=cross.dtype)).sum(axis=1).tolist()
    rest = sum(t * t for t in total)
    return [Decimal(n * n * s - 2 * n * m + rest) for s, m in zip(square, mixed, strict=True)]


def whiten(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """One row per remaining row and component: vec_id, component (from 1), n (length of the fit list), deviation (exact,
    decimal), whitened, explained, identity_error."""
    spark = df.sparkSession
    rows = scaled(df, vec_id, embedding, scale)
    kind = rows.schema["vec_id"].dataType
    schema = StructType([
        StructField("vec_id", kind), StructField("component", IntegerType()), StructField("n", LongType()),
        StructField("deviation", DecimalType(38, 0)), StructField("whitened", DoubleType()),
        StructField("explained", DoubleType()), StructField("identity_error", DoubleType()),
    ])
    most = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if most is None:
        return spark.createDataFrame([], schema)
    width, count = most["width"], most["count"]
    rows = rows.filter(F.size("x") == width)
    block_rows = max(BLOCK_ROWS, -(-count // MAX_BLOCKS))

    fit, fit_blocks = numbered(packed(rows.select("x").distinct(), block_rows))
    every, every_blocks = numbered(packed(rows, block_rows))
    n, total = sums(fit, width)
    means = total / n

    matrix = centred(fit, fit_blocks, width, block_rows, means)
    splits = min(fit_blocks, parts_for(fit))
    scatter = product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()
    covariance = scatter / n
    values, vectors = principal(covariance, components)
    varying = values > RANK_TOLERANCE * max(values[0], 0)
    size = int(varying.sum())
    trace = float(np.trace(covariance))
    shares = [float(v / trace) if trace > 0 else None for v in values]
    error = None
    whitening = np.zeros((width, max(size, 1)))
    if size:
        whitening[:] = vectors[:, :size] / np.sqrt(values[:size])
        error = identity_error(matrix.multiply(local_blocks(spark, whitening)), n, size)
    matrix.blocks.unpersist()

    projected = centred(every, every_blocks, width, block_rows, means).multiply(local_blocks(spark, whitening))
    last = len(values)

    def values_of(entry) -> tuple[int, list[list[float | None]]]:
        z = entry[1].toArray().tolist()
        return entry[0][0], [[*row[:size], *[None] * (last - size)] for row in z]

    whitened = spark.createDataFrame(projected.blocks.map(values_of), "block int, whitened array<array<double>>", verifySchema=False)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [deviations(np.frombuffer(x.as_buffer(), "<i8").reshape(-1, width), n, total) for x in batch.column("x")]
            made = pa.array(found, pa.list_(pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("ids"), made], names=["block", "ids", "deviation"])

    named = every.select("block", "ids", "x").mapInArrow(
        measure, StructType([StructField("block", IntegerType()), StructField("ids", ArrayType(kind)), StructField("deviation", ArrayType(DecimalType(38, 0)))])
    )
    shares_of = F.array(*[F.lit(s).cast("double") for s in shares])
    joined = named.join(whitened, "block").select("ids", "deviation", F.slice("whitened", 1, F.size("ids")).alias("whitened"))
    single = joined.select(F.inline(F.arrays_zip("ids", "deviation", "whitened")))
    by_component = single.select("ids", "deviation", F.posexplode("whitened").alias("at", "value"))
    return by_component.select(
        F.col("ids").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        shares_of[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
