"""Compare a Spark result with its SQL on the same files."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pandas as pd

FOLDER = os.environ.get("VELDT_TEST_FOLDER", "/root/testdata/sf0.01")


def connect(folder: str = FOLDER) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value."""

    def text(value) -> str:
        if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and getattr(value, "ndim", 0):
            return "[" + ",".join(text(v) for v in value) + "]"
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return "NULL"
        if isinstance(value, float):
            return repr(value + 0.0)
        return str(value)

    out = pd.DataFrame({c: [text(v) for v in frame[c]] for c in sorted(frame.columns)})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when equal, else a short description."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    if not len(spark_frame):
        return "both empty"
    kinds = {
        c: (spark_frame[c].dtype.kind, sql_frame[c].dtype.kind)
        for c in spark_frame
        if spark_frame[c].dtype.kind != sql_frame[c].dtype.kind
    }
    left, right = canonical(spark_frame), canonical(sql_frame)
    if left.equals(right):
        return f"types {kinds}" if kinds else None
    bad = [c for c in left if not left[c].equals(right[c])]
    where = (left[bad[0]] != right[bad[0]]).to_numpy().nonzero()[0]
    i = where[0]
    return f"values in {bad} ({len(where)} rows), e.g. {dict(left.loc[i])} != {dict(right.loc[i])}"
