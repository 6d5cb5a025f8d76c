"""Session helpers: a local session for tests and benches, and reliable checkpoints."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = 8, memory: str = "12g") -> SparkSession:
    """A single-JVM session; a cluster job brings its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("veldt")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoints(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="veldt-checkpoint-")
    context.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so it survives lost executors."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, **options: object) -> DataFrame:
    """``df`` as a table of its own in the checkpoint folder, read back from there; it survives lost executors.

    ``options`` are the writer's.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstored(df: DataFrame) -> None:
    """Remove a table that ``stored`` made and nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0].rpartition("/")[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: most rows of a batch that goes to a Python worker, and most bytes
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def small_batches(spark: SparkSession) -> None:
    """Rows meet Python workers in small batches, unless the session was given sizes of its own.

    By default a batch has 10,000 rows: with whole texts a partition is one batch, held in full by the executor, by the
    stream to the worker and by the worker, and again by the next operator of the same task.
    """
    given = spark.conf.getAll
    for name, most in BATCH.items():
        if name not in given:
            spark.conf.set(name, most)


def scattered(df: DataFrame) -> DataFrame:
    """A table just read, over all cores, when its files have fewer splits than there are cores.

    For steps that multiply rows (words of a text) right after a scan. A large table has splits
    enough and is returned unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


ROWS_PER_TASK = 25_000
EVEN_TASKS = 40
MOST_ROWS_PER_TASK = 1_000_000


def tasks_for(rows: int, per_task: int = ROWS_PER_TASK) -> int:
    """How many tasks an iterative fit reads its rows in: one for each ``per_task`` rows up to ``EVEN_TASKS``, which then
    grow to ``MOST_ROWS_PER_TASK`` each before there are more of them.

    Every step of a fit sends some 9 KB per task to the driver, whatever the task read; in tasks of ``per_task`` rows a
    few hundred steps over a large table would send gigabytes. The number depends on nothing but the rows.
    """
    return max(1, min(-(-rows // per_task), EVEN_TASKS), -(-rows // max(per_task, MOST_ROWS_PER_TASK)))


@contextmanager
def training_cache(df: DataFrame):
    """A cached copy of ``df`` for an iterative fit, in a number of partitions that suits its rows.

    Every optimizer step is a job over all partitions. A one-file table would leave cores idle, so
    it is spread; a table too small to fill its partitions is coalesced (no shuffle).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    data = df.persist()
    held = [data]
    try:
        wanted = tasks_for(data.count())
        parts = data.rdd.getNumPartitions()
        if wanted < parts:
            data = data.coalesce(wanted)
        elif parts < min(wanted, cores):
            data = data.repartition(min(wanted, cores)).persist()
            held.append(data)
        yield data
    finally:
        for frame in held:
            frame.unpersist()
