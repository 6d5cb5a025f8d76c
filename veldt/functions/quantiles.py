"""Exact quantiles by narrowing: values are counted where they are, only a thin slice of them is ever shuffled.

One aggregate sketches the distribution of each column map-side and so brackets every wanted rank between two values.
While a bracket may hold more than a bounded number of values, one more aggregate counts what lies below and inside and
sketches the inside only. At last the distinct values inside the brackets are counted (map-side combined) and the ranks
read off; the count below a bracket and the count inside prove that it holds the rank. Should one not hold it, which the
sketch's error bound rules out, all values are counted instead, so the result never rests on the sketch.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from veldt.functions.ordered import counted_quantiles, same_keys

#: relative rank error of a sketch, as its inverse
ACCURACY = 10_000
#: steps of the sketched distribution that are read, over all brackets of a pass
GRID_CELLS = 200_000
#: values inside brackets that may be collected, over all brackets
INSIDE = 400_000
#: of one bracket; a sketch of fewer values hardly narrows them
LEAST = 100
MAX_GROUPS = 1_000


class Lost(Exception):
    """A bracket does not hold its rank."""


@dataclass
class Bracket:
    """The values between which one order statistic of one column and group lies, both ends included."""

    rank: int
    low: float
    high: float
    inside: float
    counts: dict[float | None, int] = field(default_factory=dict)

    def read(self) -> float:
        """The value at the rank, from the counted values."""
        at = self.counts.get(None, 0)
        if self.rank >= at:
            for value in sorted(v for v in self.counts if v is not None):
                at += self.counts[value]
                if self.rank < at:
                    return value
        raise Lost


def steps_for(brackets: int) -> int:
    return max(20, min(1000, GRID_CELLS // max(1, brackets)))


def sketch(value: Column, steps: int) -> Column:
    return F.percentile_approx(value, [i / steps for i in range(steps + 1)], ACCURACY)


def narrowed(bracket: Bracket, grid: list[float], below: int, inside: int) -> None:
    """Close in on the rank by a sketch of the ``inside`` values above the ``below`` lowest."""
    steps = len(grid) - 1
    slack = 2 / ACCURACY + 2 / inside
    place = (bracket.rank - below) / inside
    first, last = math.floor((place - slack) * steps), math.ceil((place + 1 / inside + slack) * steps)
    if first >= 0:
        bracket.low = max(bracket.low, grid[first])
    if last <= steps:
        bracket.high = min(bracket.high, grid[last])
    bracket.inside = inside * ((last - first) / steps + 2 * slack)


def bounded(df: DataFrame, by: list[str], brackets: dict[tuple, dict[tuple[str, int], Bracket]]) -> tuple[DataFrame, dict]:
    """``df`` with the ends of each group's brackets at hand, and the ends as columns by (column, rank index)."""
    names = sorted({k for found in brackets.values() for k in found})
    if not by:
        only = brackets[()]
        return df, {k: (F.lit(only[k].low), F.lit(only[k].high)) for k in names}
    rows = []
    for group, found in brackets.items():
        ends = [e for k in names for e in ((found[k].low, found[k].high) if k in found else (None, None))]
        rows.append((*group, *ends))
    fields = [StructField(f"__of_{k}", df.schema[k].dataType) for k in by]
    fields += [StructField(f"__{side}{i}", DoubleType()) for i in range(len(names)) for side in ("low", "high")]
    # at most MAX_GROUPS rows
    frame = F.broadcast(df.sparkSession.createDataFrame(rows, StructType(fields)))
    joined = df.join(frame, same_keys(df, frame, [(k, f"__of_{k}") for k in by]))
    return joined, {k: (F.col(f"__low{i}"), F.col(f"__high{i}")) for i, k in enumerate(names)}


def grouped(df: DataFrame, by: list[str], stats: list[Column]) -> list:
    return (df.groupBy(*by).agg(*stats) if by else df.agg(*stats)).collect()


def narrow(df: DataFrame, by: list[str], brackets: dict) -> None:
    """One pass over ``df``: every bracket shrinks to about a step of a sketch of its inside."""
    joined, ends = bounded(df, by, brackets)
    steps = steps_for(sum(map(len, brackets.values())))
    stats = []
    for i, ((column, _), (low, high)) in enumerate(ends.items()):
        value = F.col(column)
        inside = (value >= low) & (value <= high)
        stats += [
            F.count_if(value < low).alias(f"__below{i}"),
            F.count_if(inside).alias(f"__inside{i}"),
            sketch(F.when(inside, value), steps).alias(f"__grid{i}"),
        ]
    for row in grouped(joined, by, stats):
        found = brackets[tuple(row[k] for k in by)]
        for i, key in enumerate(ends):
            if key in found:
                bracket, below, inside = found[key], row[f"__below{i}"], row[f"__inside{i}"]
                if not below <= bracket.rank < below + inside:
                    raise Lost
                before = bracket.low, bracket.high
                narrowed(bracket, row[f"__grid{i}"], below, inside)
                if before == (bracket.low, bracket.high):
                    bracket.inside = 0  # ties: as narrow as it gets


def count_inside(df: DataFrame, by: list[str], brackets: dict) -> None:
    """One pass over ``df``: how often each value inside a bracket occurs, and how many are below (under None)."""
    joined, ends = bounded(df, by, brackets)
    cells = []
    for i, ((column, _), (low, high)) in enumerate(ends.items()):
        value = F.col(column)
        cell = F.struct(F.lit(i).alias("i"), F.when(value >= low, value).alias("value"))
        cells.append(F.when(value <= high, cell))
    kept = F.filter(F.array(*cells), lambda cell: cell.isNotNull())
    counted = joined.select(*by, F.inline(kept)).groupBy(*by, "i", "value").count()
    keys = list(ends)
    for row in counted.collect():
        brackets[tuple(row[k] for k in by)][keys[row["i"]]].counts[row["value"]] = row["count"]


def select_ranks(df: DataFrame, by: list[str], wanted: dict[tuple, dict[tuple[str, int], Bracket]]) -> dict:
    """The value at each wanted rank, as {group: {(column, rank index): value}}."""
    wanted = {group: found for group, found in wanted.items() if found}
    if not wanted:
        return {}
    most = max(LEAST, INSIDE // sum(map(len, wanted.values())))
    while True:
        wide = {g: {k: b for k, b in found.items() if b.low < b.high and b.inside > most} for g, found in wanted.items()}
        wide = {g: found for g, found in wide.items() if found}
        if not wide:
            break
        narrow(df, by, wide)
    count_inside(df, by, wanted)
    return {group: {key: bracket.read() for key, bracket in found.items()} for group, found in wanted.items()}


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], by: list[str] | None = None
) -> DataFrame:
    """Interpolated quantiles as rows (by..., column, p0, p1, ...), exact at any size; one row per group and column
    that has a value.

    NULL is no value and NaN ranks above all others. More than ``MAX_GROUPS`` groups are ranked by counting all their
    values (``counted_quantiles``), with the same result.
    """
    by = by or []
    plain = {c: f"__v{i}" for i, c in enumerate(columns)}
    # adding 0.0 makes one zero of both
    data = df.select(*by, *[(F.col(c).cast("double") + 0.0).alias(v) for c, v in plain.items()])
    number = {v: F.when(~F.isnan(v), F.col(v)) for v in plain.values()}
    steps = steps_for(len(columns) * len(probabilities))
    stats = []
    for v in plain.values():
        stats += [F.count(v).alias(f"{v}_all"), F.count(number[v]).alias(f"{v}_n"), sketch(number[v], steps).alias(f"{v}_grid")]
    first = data.groupBy(*by).agg(*stats) if by else data.agg(*stats)
    rows = first.limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        return counted_quantiles(df, columns, probabilities, by)

    wanted: dict[tuple, dict[tuple[str, int], Bracket]] = {}
    sizes = {}
    for row in rows:
        group = tuple(row[k] for k in by)
        wanted[group] = {}
        for v in plain.values():
            sizes[group, v] = row[f"{v}_all"], row[f"{v}_n"]
            for rank in {r for p in probabilities for r in ranks_of(p, row[f"{v}_all"])} if row[f"{v}_all"] else ():
                if rank < row[f"{v}_n"]:
                    bracket = Bracket(rank, -math.inf, math.inf, math.inf)
                    narrowed(bracket, row[f"{v}_grid"], 0, row[f"{v}_n"])
                    wanted[group][v, rank] = bracket
    held = data.select(*by, *[c.alias(v) for v, c in number.items()])
    try:
        values = select_ranks(held, by, wanted)
    except Lost:
        return counted_quantiles(df, columns, probabilities, by)

    out = []
    for group in wanted:
        for c, v in plain.items():
            size = sizes[group, v][0]
            if not size:
                continue
            found = []
            for p in probabilities:
                low, high = (values.get(group, {}).get((v, rank), math.nan) for rank in ranks_of(p, size))
                place = (size - 1) * float(p)
                found.append(low + (high - low) * (place - math.floor(place)))
            out.append((*group, c, *found))
    fields = [StructField(k, df.schema[k].dataType) for k in by] + [StructField("column", StringType())]
    fields += [StructField(f"p{i}", DoubleType()) for i in range(len(probabilities))]
    return df.sparkSession.createDataFrame(out, StructType(fields))


def ranks_of(probability: float, size: int) -> tuple[int, int]:
    """The two order statistics, from 0 on, between which a quantile is interpolated."""
    place = (size - 1) * float(probability)
    return math.floor(place), math.ceil(place)
