"""Means and products of many columns in one pass, as one matrix instead of an aggregate per pair.

Each batch of rows is centred by its own means and multiplied once; batches, tasks and groups are put together by the
exact rule for joining centred sums, so large means do not cost digits. NULLs are handled pair by pair: a pair counts the
rows that have both values. What reaches the driver is a few numbers per pair of columns and group, whatever the rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a grouped pass keeps this many matrices on the driver at most
MAX_GROUPS = 10_000


@dataclass
class Comoments:
    """Over the rows where i and j are both present: n[i,j], mean[i,j] of i, square[i,j] of i and product[i,j], both
    centred."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    product: np.ndarray

    @staticmethod
    def empty(width: int) -> Comoments:
        return Comoments(*(np.zeros((width, width)) for _ in range(4)))

    @staticmethod
    def of(rows: np.ndarray) -> Comoments:
        """Of a block of rows; a missing value is NaN."""
        there = ~np.isnan(rows)
        count = there.sum(axis=0)
        shift = np.where(there, rows, 0.0).sum(axis=0) / np.maximum(count, 1)
        x, m = np.where(there, rows - shift, 0.0), there.astype(float)
        n = m.T @ m
        held = np.maximum(n, 1.0)
        total = x.T @ m
        mean = total / held
        square = (x * x).T @ m - total * mean
        product = x.T @ x - total * mean.T
        return Comoments(n, np.where(n > 0, mean + shift[:, None], 0.0), square, product)

    def plus(self, other: Comoments) -> Comoments:
        n = self.n + other.n
        held = np.maximum(n, 1.0)
        gap = other.mean - self.mean
        weight = self.n * other.n / held
        return Comoments(
            n,
            np.where(n > 0, (self.mean * self.n + other.mean * other.n) / held, 0.0),
            self.square + other.square + gap * gap * weight,
            self.product + other.product + gap * gap.T * weight,
        )

    def correlations(self) -> np.ndarray:
        """Pairwise Pearson correlation; NaN where a column does not vary or fewer than two rows have both values."""
        # what rounding leaves of a column that does not vary
        square = np.where(self.square > self.n * (4e-15 * np.abs(self.mean)) ** 2, self.square, 0.0)
        spread = np.sqrt(square) * np.sqrt(square).T
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where((self.n > 1) & (spread > 0), np.clip(self.product / spread, -1, 1), np.nan)

    @property
    def means(self) -> np.ndarray:
        """Mean of each column over all its values."""
        return np.diagonal(self.mean)

    @property
    def sizes(self) -> np.ndarray:
        return np.diagonal(self.n)

    @property
    def variances(self) -> np.ndarray:
        """Population variance of each column over all its values."""
        return np.diagonal(self.square) / np.maximum(self.sizes, 1)


def joined(left: dict, right: dict) -> dict:
    out = dict(left)
    for key, value in right.items():
        out[key] = out[key].plus(value) if key in out else value
    return out


def groups_of(keys: list[pa.Array], rows: np.ndarray) -> Iterator[tuple[tuple, np.ndarray]]:
    """Each combination of keys and those of ``rows`` that hold it; NULL is a key like others."""
    if not keys:
        if len(rows):
            yield (), rows
        return
    code = np.zeros(len(keys[0]), np.int64)
    for key in keys:
        coded = key.dictionary_encode(null_encoding="encode")
        code = code * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False)
    order = rows[np.argsort(code[rows], kind="stable")]
    cuts = np.flatnonzero(np.diff(code[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield tuple(key[int(part[0])].as_py() for key in keys), part


def reduced(df: DataFrame, make: Callable[[np.ndarray], Comoments], columns: list[str], by: list[str], complete: bool) -> dict:
    """One pass: the moments of every group of ``by``, put together task by task in a tree."""
    values = [F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(columns)]
    data = df.select(*[F.col(b).alias(f"__g{i}") for i, b in enumerate(by)], *values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            x = np.column_stack([batch.column(len(by) + i).to_numpy(zero_copy_only=False) for i in range(len(columns))]).astype(float)
            keep = ~np.isnan(x).any(axis=1) if complete else np.ones(len(x), bool)
            for group, rows in groups_of([batch.column(i) for i in range(len(by))], np.flatnonzero(keep)):
                found = joined(found, {group: make(x[rows])})
        if len(found) > MAX_GROUPS:
            raise ValueError(f"more than {MAX_GROUPS} groups")
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["found"])

    parts = data.mapInArrow(run, "found binary").rdd.map(lambda row: pickle.loads(row["found"]))
    return parts.treeAggregate({}, joined, joined)


def comoments(df: DataFrame, columns: list[str], by: list[str] | None = None, complete: bool = False) -> dict:
    """``Comoments`` of the columns per group of ``by``, as {group: ...}; without ``by`` the only key is ().

    NULL and NaN are missing. With ``complete``, rows with a missing value are left out altogether.
    """
    found = reduced(df, Comoments.of, columns, by or [], complete)
    return found if by or found else {(): Comoments.empty(len(columns))}
