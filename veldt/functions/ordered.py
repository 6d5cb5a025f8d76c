"""Order-dependent columns that stay distributed when one group holds most of the rows.

A plain window puts a whole partition-by group into one task. Every function here first counts
rows per group (map-side combined). Groups under the limit take the plain window. Larger groups
are range-partitioned by (keys, order), written to the checkpoint folder, handled segment by
segment, and joined with per-segment offsets. A key that spans several segments owns whole
segments except at its two ends, so the offset table holds at most two rows per segment: that is
what makes it safe to broadcast whatever the size of the data.

``order`` must be a total order (end it with a unique column) wherever rows are numbered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veldt.functions.fitting import MAX_CATEGORIES, lookup
from veldt.session import checkpointed

LIMIT_SETTING = "spark.veldt.window.maxGroupRows"
DEFAULT_LIMIT = 2_000_000
SEGMENT = "__segment"


def group_limit(spark: SparkSession) -> int:
    """Rows one window group may hold before it is split."""
    return int(spark.conf.get(LIMIT_SETTING, str(DEFAULT_LIMIT)))


def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality of key columns, so a NULL group is a group like any other."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def split_by_size(
    df: DataFrame, keys: list[str], sizes: DataFrame | int | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of groups within the limit, rows of larger groups); None stands for "no such rows".

    ``sizes`` gives the group sizes when the caller has a cheaper way to them than counting
    ``df``: rows (keys..., __rows), or one number where there are no keys.
    """
    limit = group_limit(df.sparkSession)
    if not keys:
        rows = df.count() if sizes is None else sizes
        return (None, df) if rows > limit else (df, None)
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    large = (
        sizes.filter(F.col("__rows") > limit)
        .select(*[F.col(k).alias(f"__large_{k}") for k in keys])
    )
    if large.isEmpty():
        return df, None
    match = same_keys(df, large, [(k, f"__large_{k}") for k in keys])
    return df.join(large, match, "left_anti"), df.join(large, match, "left_semi")


def segments(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows in even, ordered segments of about the group limit, at least one for each shuffle partition.

    The checkpoint fixes the segment numbers for good.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // group_limit(spark)))
    ranged = df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
    return checkpointed(ranged.withColumn(SEGMENT, F.spark_partition_id()))


def _both(small: DataFrame | None, large: DataFrame | None) -> DataFrame:
    if small is None or large is None:
        return small if large is None else large
    return small.unionByName(large)


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    totals: dict[str, Column],
    sizes: DataFrame | int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``totals`` within ``keys`` along ``order``.

    ``sizes``: see ``split_by_size``.
    """
    small, large = split_by_size(df, keys, sizes)
    if small is not None:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        small = small.withColumns({n: F.sum(c).over(upto) for n, c in totals.items()})
    if large is not None:
        large = _segmented_totals(large, keys, order, totals)
    return _both(small, large)


def _segmented_totals(
    df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, Column]
) -> DataFrame:
    rows = segments(df, keys, order)
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, SEGMENT)
        .agg(*[F.sum(c).alias(f"__sum_{n}") for n, c in totals.items()])
        .select(
            *[F.col(k).alias(f"__of_{k}") for k in keys],
            F.col(SEGMENT).alias("__of_segment"),
            *[F.sum(f"__sum_{n}").over(before).alias(f"__before_{n}") for n in totals],
            F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("__spans"),
        )
        .filter("__spans > 1")
    )
    match = same_keys(
        rows, offsets, [(k, f"__of_{k}") for k in keys] + [(SEGMENT, "__of_segment")]
    )
    inside = (
        Window.partitionBy(*keys, SEGMENT)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )


    def carried(name: str) -> Column:
        """NULL only while neither this segment nor an earlier one has had a value."""
        here, before = F.col(name), F.col(f"__before_{name}")
        return F.when(here.isNull(), before).when(before.isNull(), here).otherwise(here + before)

    return (
        rows.withColumns({n: F.sum(c).over(inside) for n, c in totals.items()})
        .join(F.broadcast(offsets), match, "left")
        .withColumns({n: carried(n) for n in totals})
        .select(*df.columns, *totals)
    )


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """1-based position of every row within its keys."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("long")})


def ranks(
    df: DataFrame,
    keys: list[str],
    by: str,
    tiebreak: str,
    buckets: int,
    descending: bool = False,
) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank and ntile of ``by`` within ``keys``.

    Large groups: tied values are counted first, ranked as values, then joined back.
    """
    direction = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    total_order = [direction, F.col(tiebreak).asc_nulls_last()]
    small, large = split_by_size(df, keys)
    if small is not None:
        exact = Window.partitionBy(*keys).orderBy(*total_order)
        tied = Window.partitionBy(*keys).orderBy(direction)
        small = small.select(
            "*",
            F.row_number().over(exact).cast("long").alias("row_number"),
            F.rank().over(tied).cast("long").alias("rank"),
            F.dense_rank().over(tied).cast("long").alias("dense_rank"),
            F.percent_rank().over(tied).alias("percent_rank"),
            F.ntile(buckets).over(exact).cast("long").alias("ntile"),
        )
    if large is not None:
        numbered = _segmented_totals(
            large, keys, total_order, {"row_number": F.lit(1).cast("long")}
        )
        values = large.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("__ties"))
        ranked = _segmented_totals(
            values,
            keys,
            [direction],
            {"__upto": F.col("__ties"), "dense_rank": F.lit(1).cast("long")},
        ).select(
            *[F.col(k).alias(f"__of_{k}") for k in keys],
            F.col(by).alias("__of_value"),
            (F.col("__upto") - F.col("__ties") + 1).alias("rank"),
            "dense_rank",
        )
        sizes = large.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
        sizes = sizes.select(*[F.col(k).alias(f"__in_{k}") for k in keys], "__size")
        joined = numbered.join(
            ranked,
            same_keys(numbered, ranked, [(k, f"__of_{k}") for k in keys] + [(by, "__of_value")]),
        )
        if keys:
            joined = joined.join(sizes, same_keys(joined, sizes, [(k, f"__in_{k}") for k in keys]))
        else:
            joined = joined.withColumn("__size", F.lit(large.count()))
        row, size = F.col("row_number"), F.col("__size")
        base, extra = F.floor(size / buckets), size % buckets
        wide = extra * (base + 1)
        large = joined.select(
            *df.columns,
            "row_number",
            "rank",
            "dense_rank",
            F.when(size > 1, (F.col("rank") - 1) / (size - 1)).otherwise(0.0).alias("percent_rank"),
            F.when(row <= wide, F.floor((row - 1) / (base + 1)) + 1)
            .otherwise(extra + F.floor((row - 1 - wide) / F.greatest(base, F.lit(1))) + 1)
            .alias("ntile"),
        )
    return _both(small, large)


def with_preceding(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    rows_back: int,
    columns: dict[str, Column],
    ordered: dict[str, Column] | None = None,
) -> DataFrame:
    """Window columns that look at most ``rows_back`` rows back.

    ``columns`` are aggregates over the frame (rows_back preceding .. current row); ``ordered``
    are offset functions such as ``lag`` reaching no further than ``rows_back``. Large groups are
    cut into numbered blocks, and the last rows of a block are repeated at the head of the next.
    """
    ordered = ordered or {}

    def add(part: DataFrame, partition: list[str], sort: list[Column]) -> DataFrame:
        plain = Window.partitionBy(*partition).orderBy(*sort)
        frame = plain.rowsBetween(-rows_back, 0)
        return part.withColumns(
            {
                **{n: c.over(frame) for n, c in columns.items()},
                **{n: c.over(plain) for n, c in ordered.items()},
            }
        )

    small, large = split_by_size(df, keys)
    if small is not None:
        small = add(small, keys, order)
    if large is not None:
        block_rows = max(group_limit(df.sparkSession), rows_back)
        numbered = _segmented_totals(large, keys, order, {"__row": F.lit(1).cast("long")})
        block = F.floor((F.col("__row") - 1) / block_rows)
        tail = (F.col("__row") - 1) % block_rows >= block_rows - rows_back
        copies = F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))
        blocks = numbered.withColumn("__block", F.explode(copies))
        done = add(blocks, [*keys, "__block"], [F.col("__row")])
        large = done.filter(F.col("__block") == block).select(*df.columns, *columns, *ordered)
    return _both(small, large)


def hashed_positions(df: DataFrame, groups: list[str], key: str) -> DataFrame:
    """Adds ``position`` (1-based, in md5(key) order) and ``group_rows`` within ``groups``.

    A class label may cover a third of the table, so the class is cut into 65536 even pieces by
    the leading hash digits; ``key`` must be unique. Counts per piece give the offsets.
    """
    hashed = df.withColumn("__hash", F.md5(F.col(key).cast("string")))
    hashed = hashed.withColumn("__piece", F.substring("__hash", 1, 4))
    pieces = hashed.groupBy(*groups, "__piece").agg(F.count(F.lit(1)).alias("__rows"))
    everything = Window.partitionBy(*groups)
    before = everything.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *[F.col(g).alias(f"__of_{g}") for g in groups],
        F.col("__piece").alias("__of_piece"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(everything).alias("group_rows"),
    )
    match = same_keys(hashed, offsets, [(g, f"__of_{g}") for g in groups]) if groups else F.lit(True)
    match = match & (hashed["__piece"] == offsets["__of_piece"])
    inside = Window.partitionBy(*groups, "__piece").orderBy("__hash", key)
    return (
        hashed.join(offsets, match)
        .withColumn("position", F.col("__before") + F.row_number().over(inside))
        .select(*df.columns, "position", "group_rows")
    )


def first_by_hash(df: DataFrame, label: str | None, key: str, wanted: Column) -> Column:
    """A condition that holds for the first ``wanted`` rows of each class in md5(key) order.

    ``wanted`` is an expression of ``group_rows``, the size of the class; ``key`` must be unique.
    The hash at which each class is cut is found by two small jobs (counts per hash prefix, then
    only the rows of the prefix that holds the cut). The condition itself compares a row's hash
    with a literal, so rows are neither shuffled nor ranked.
    """
    # classes as text, NULL as a class of its own
    group = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")) if label else F.lit("")
    hashed = df.select(group.alias("__group"), F.md5(F.col(key).cast("string")).alias("__hash"))
    hashed = hashed.withColumn("__piece", F.substring("__hash", 1, 4))
    pieces = hashed.groupBy("__group", "__piece").agg(F.count(F.lit(1)).alias("__rows"))
    everything = Window.partitionBy("__group")
    before = everything.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    held = pieces.select(
        "__group",
        "__piece",
        "__rows",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(everything).alias("group_rows"),
    ).withColumn(
        "__place", F.least(wanted.cast("long"), F.col("group_rows")) - F.col("__before")
    )
    found = held.filter("__place > 0 AND __place <= __rows").limit(MAX_CATEGORIES + 1).collect()
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"{label} has more than {MAX_CATEGORIES} classes")
    if not found:
        return F.lit(False)

    places = {r["__group"]: r["__place"] for r in found}
    near = hashed.filter(
        F.col("__piece") == lookup({r["__group"]: r["__piece"] for r in found}, "string", F.col("__group"))
    )
    place = F.row_number().over(Window.partitionBy("__group").orderBy("__hash"))
    cuts = near.withColumn("__row", place).filter(
        F.col("__row") == lookup(places, "long", F.col("__group"))
    )
    last = {r["__group"]: r["__hash"] for r in cuts.collect()}
    own = F.md5(F.col(key).cast("string"))
    return F.coalesce(own <= lookup(last, "string", group), F.lit(False))


def counted_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], by: list[str] | None = None
) -> DataFrame:
    """Interpolated quantiles as rows (by..., column, p0, p1, ...), exact at any size.

    Values are counted first (map-side combined) and located by running counts, so no task keeps
    every distinct value of a column in memory as the ``percentile`` aggregate would.
    """
    by = by or []
    long = df.select(
        *by,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        ).alias("__cell"),
    ).select(*by, "__cell.column", "__cell.value")
    keys = [*by, "column"]
    known = long.filter("value IS NOT NULL")
    counts = known.groupBy(*keys, "value").count()
    # sketches, not the counts themselves, tell the large groups: a pass without a big shuffle
    distinct = known.groupBy(*keys).agg(F.approx_count_distinct("value").alias("__rows"))
    located = running_totals(
        counts, keys, [F.col("value").asc()], {"__upto": F.col("count")}, distinct
    )
    sizes = counts.groupBy(*keys).agg(F.sum("count").alias("__size"))
    sizes = sizes.select(*[F.col(k).alias(f"__of_{k}") for k in keys], "__size")
    joined = located.join(sizes, same_keys(located, sizes, [(k, f"__of_{k}") for k in keys]))
    picks = []
    for i, p in enumerate(probabilities):
        place = (F.col("__size") - 1) * F.lit(float(p))
        picks.append(
            F.min(F.when(F.col("__upto") > F.floor(place), F.col("value"))).alias(f"__low{i}")
        )
        picks.append(
            F.min(F.when(F.col("__upto") > F.ceil(place), F.col("value"))).alias(f"__high{i}")
        )
    picked = joined.groupBy(*keys, "__size").agg(*picks)
    results = []
    for i, p in enumerate(probabilities):
        place = (F.col("__size") - 1) * F.lit(float(p))
        low, high = F.col(f"__low{i}"), F.col(f"__high{i}")
        results.append((low + (high - low) * (place - F.floor(place))).alias(f"p{i}"))
    return picked.select(*keys, *results)
