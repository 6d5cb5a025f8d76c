"""Reading tables and naming them for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from veldt.operators.clean import nan_to_null

CORRUPT = "_corrupt_record"


def load(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    header: bool = True,
) -> DataFrame:
    """Load parquet, csv, json or orc. Text formats need a schema, so nothing is scanned to infer it.

    NaN becomes NULL, the only mark of a missing value. Rows that do not fit stay in the result, with the raw text in ``_corrupt_record``.
    """
    reader = spark.read.format(fmt)
    if fmt in ("csv", "json"):
        if schema is None:
            raise ValueError(f"a schema is required for {fmt}")
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        if CORRUPT not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if fmt == "csv":
            reader = reader.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.load(path))


def register(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Name parquet tables of a folder as temporary views."""
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
