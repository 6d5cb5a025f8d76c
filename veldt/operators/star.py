"""Joins and dimensional modelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.functions.ordered import group_limit, row_numbers, split_by_size

UNKNOWN = -1


# sides whose frequent keys adaptive execution cannot split, per join type
UNSPLIT = {"full": "both", "left": "right", "right": "left"}
# other names Spark has for the same joins, without underscores
SAME_JOIN = {"outer": "full", "fullouter": "full", "leftouter": "left", "rightouter": "right"}


def _has_large_key(df: DataFrame, keys: list[str]) -> bool:
    """Whether one (present) key covers more rows than one task should hold.

    Keys are counted only where the side itself has more rows than that.
    """
    if df.count() <= group_limit(df.sparkSession):
        return False
    known = df.dropna(subset=keys).select(*keys)
    return split_by_size(known, keys)[1] is not None


def join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Equi join on columns of equal names.

    No hints: adaptive execution broadcasts a side by its measured size, and splits the partitions
    of a very frequent key when both sides are large. It cannot split every side of an outer join;
    if such a side has a very frequent key, the join is put together from an inner join and anti
    joins, which it can split.
    """
    kind = how.lower().replace("_", "")
    kind = SAME_JOIN.get(kind, kind)
    unsplit = UNSPLIT.get(kind)
    sides = {"left": [left], "right": [right], "both": [left, right], None: []}[unsplit]
    if not any(_has_large_key(side, on) for side in sides):
        return left.join(right, on, how)
    # names of their own, so that columns of equal names on both sides stay apart in the unions
    names = [*on, *(c for c in left.columns if c not in on), *(c for c in right.columns if c not in on)]
    left = left.select(*on, *(F.col(c).alias(f"__left_{c}") for c in left.columns if c not in on))
    right = right.select(*on, *(F.col(c).alias(f"__right_{c}") for c in right.columns if c not in on))
    parts = left.join(right, on, "inner")
    if kind != "right":
        parts = parts.unionByName(left.join(right, on, "left_anti"), allowMissingColumns=True)
    if kind != "left":
        parts = parts.unionByName(right.join(left, on, "left_anti"), allowMissingColumns=True)
    return parts.toDF(*names)


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with ``side`` = both, left or right; keys are coalesced."""
    a = left.withColumn("__in_left", F.lit(1))
    b = right.withColumn("__in_right", F.lit(1))
    side = (
        F.when(F.col("__in_left").isNull(), "right")
        .when(F.col("__in_right").isNull(), "left")
        .otherwise("both")
    )
    return join(a, b, keys, "full").withColumn("side", side).drop("__in_left", "__in_right")


def dimension(df: DataFrame, natural_key: list[str], attributes: list[str], name: str) -> DataFrame:
    """One row per natural key with a surrogate key ``name`` (1, 2, ... in natural key order).

    If attributes differ within a key, the smallest combination is kept. Numbering is distributed,
    so a dimension with very many members does not pass through one task.
    """
    members = df.groupBy(*natural_key)
    if attributes:
        rows = members.agg(F.min(F.struct(*attributes)).alias("__a")).select(*natural_key, "__a.*")
    else:
        rows = members.agg(F.lit(1).alias("__one")).drop("__one")
    order = [F.col(k).asc_nulls_last() for k in natural_key]
    return row_numbers(rows, [], order, name).select(name, *natural_key, *attributes)


def fact(
    df: DataFrame, dimensions: list[tuple[DataFrame, dict[str, str], str]], measures: list[str]
) -> DataFrame:
    """Swap natural keys for surrogate keys and keep the measures.

    Each dimension is (frame, {fact column: dimension column}, surrogate key column). A key that
    the dimension does not know becomes -1.
    """
    out = df
    surrogates = []
    for i, (dim, pairs, surrogate) in enumerate(dimensions):
        lookup = dim.select(
            F.col(surrogate).alias(f"__sk{i}"),
            *[F.col(d).alias(f"__nk{i}_{f}") for f, d in pairs.items()],
        )
        match = None
        for f in pairs:
            test = F.col(f) == F.col(f"__nk{i}_{f}")
            match = test if match is None else match & test
        out = out.join(lookup, match, "left")
        surrogates.append(
            F.coalesce(f"__sk{i}", F.lit(UNKNOWN).cast("long")).alias(surrogate)
        )
    return out.select(*surrogates, *measures)


def star(
    fact_table: DataFrame,
    dimensions: list[tuple[DataFrame, str]],
    by: list[str],
    measures: dict[str, Column],
) -> DataFrame:
    """Aggregate a fact by dimension attributes.

    The attributes are looked up first and the aggregate is partial before its shuffle, so what is shuffled is one
    row per attribute combination and task; any aggregate is right as a measure. Facts whose member is unknown (-1)
    keep their measures, under NULL attributes.
    """
    out = fact_table
    for dim, key in dimensions:
        kept = [c for c in dim.columns if c == key or c in by]
        out = out.join(dim.select(*kept), key, "left")
    return out.groupBy(*by).agg(*[c.alias(n) for n, c in measures.items()])


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row, counted per key."""
    return facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).join(dim, key, "left_anti")
