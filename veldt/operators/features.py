"""Feature preparation. Fitted steps take (train, df): statistics come from ``train`` only."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.functions.columns import signed_log, width_bin
from veldt.functions.comoments import comoments
from veldt.functions.fitting import fit_categories, fit_counts, fit_row, literal, lookup, small_frame
from veldt.functions.neighbours import nearest
from veldt.functions.ordered import first_by_hash, row_numbers, same_keys
from veldt.session import checkpointed


def minmax(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Scale to [0, 1] by the training range; a constant column becomes 0."""
    stats = fit_row(
        train,
        {f"{s}_{c}": f(c) for c in columns for s, f in (("low", F.min), ("high", F.max))},
    )
    out = {}
    for c in columns:
        low, high = stats[f"low_{c}"], stats[f"high_{c}"]
        width = (high - low) if low is not None and high != low else 1.0
        out[c] = (F.col(c) - literal(low)) / literal(width)
    return df.withColumns(out)


def standardize(train: DataFrame, df: DataFrame, columns: list[str], ddof: int = 0) -> DataFrame:
    """Zero mean and unit deviation (population by default); a constant column becomes 0."""
    deviation = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = fit_row(
        train,
        {f"{s}_{c}": f(c) for c in columns for s, f in (("mean", F.avg), ("sd", deviation))},
    )
    return df.withColumns(
        {
            c: (F.col(c) - literal(stats[f"mean_{c}"])) / literal(stats[f"sd_{c}"] or 1.0)
            for c in columns
        }
    )


def label_encode(train: DataFrame, df: DataFrame, column: str, name: str) -> DataFrame:
    """Category to its 0-based place in sorted order, for any number of categories.

    Categories not seen in ``train`` give -1.
    """
    distinct = train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1).alias("__one"))
    codes = row_numbers(distinct, [], [F.col(column).asc()], "__code")
    codes = codes.select(F.col(column).alias("__category"), (F.col("__code") - 1).alias("__code"))
    joined = df.join(codes, F.col(column) == F.col("__category"), "left")
    code = F.coalesce("__code", F.lit(-1).cast("long"))
    return joined.select(*df.columns, code.alias(name))


def one_hot(train: DataFrame, df: DataFrame, column: str, drop_last: bool = False) -> DataFrame:
    """One 0/1 column per training category; an unseen category is all zeros."""
    categories = fit_categories(train, column)
    if drop_last:
        categories = categories[:-1]
    return df.withColumns(
        {
            f"{column}_{c}": F.coalesce((F.col(column) == F.lit(c)).cast("int"), F.lit(0))
            for c in categories
        }
    )


def ordinal(df: DataFrame, column: str, order: list, name: str) -> DataFrame:
    """Category to its place in a given order."""
    return df.withColumn(name, lookup({c: i for i, c in enumerate(order)}, "int", F.col(column)))


def transform_features(df: DataFrame, spec: dict[str, tuple]) -> DataFrame:
    """New columns from (source, kind, argument): log, sqrt, power or bin."""
    kinds = {
        "log": lambda c, _: signed_log(c),
        "sqrt": lambda c, _: F.signum(c) * F.sqrt(F.abs(c)),
        "power": lambda c, p: F.pow(c, F.lit(float(p))),
        "bin": lambda c, w: width_bin(c, w),
    }
    return df.withColumns({n: kinds[k](F.col(c), arg) for n, (c, k, arg) in spec.items()})


def column_transform(train: DataFrame, df: DataFrame, steps: dict[str, str]) -> DataFrame:
    """A step per column: standard, minmax, onehot, label or keep."""
    by_step: dict[str, list[str]] = {}
    for column, step in steps.items():
        by_step.setdefault(step, []).append(column)
    out = df
    if "standard" in by_step:
        out = standardize(train, out, by_step["standard"])
    if "minmax" in by_step:
        out = minmax(train, out, by_step["minmax"])
    for column in by_step.get("onehot", []):
        out = one_hot(train, out, column).drop(column)
    for column in by_step.get("label", []):
        out = label_encode(train, out, column, f"{column}_code").drop(column)
    return out


def poly(df: DataFrame, columns: list[str], degree: int) -> DataFrame:
    """All products of the columns up to ``degree``, named like ``a*a*b``."""
    new = {}
    for d in range(2, degree + 1):
        for combo in combinations_with_replacement(columns, d):
            product = F.col(combo[0])
            for c in combo[1:]:
                product = product * F.col(c)
            new["*".join(combo)] = product
    return df.withColumns(new)


def split(df: DataFrame, key: str, test_share: float, label: str | None = None) -> DataFrame:
    """``split`` = test for the first ceil(share * rows) rows in md5(key) order, else train.

    With ``label`` the shares hold within every class.
    """
    wanted = F.ceil(F.lit(float(test_share)) * F.col("group_rows"))
    taken = first_by_hash(df, label, key, wanted)
    return df.withColumn("split", F.when(taken, "test").otherwise("train"))


def class_name(label: str) -> Column:
    """A class as text; NULL is a class of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))


def class_sizes(df: DataFrame, label: str) -> dict[str, int]:
    """Rows of each class by ``class_name``."""
    return fit_counts(df.select(class_name(label).alias(label)), label)


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """rows / (classes * rows of the class); NULL is a class like others."""
    counts = class_sizes(df, label)
    total = sum(counts.values())
    weights = {c: total / (len(counts) * n) for c, n in counts.items()}
    return df.withColumn(name, lookup(weights, "double", class_name(label)))


def undersample(df: DataFrame, label: str, key: str) -> DataFrame:
    """Cut every class, NULL among them, to the size of the smallest, keeping the first rows in md5(key) order."""
    smallest = min(class_sizes(df, label).values(), default=0)
    return df.filter(first_by_hash(df, label, key, F.lit(smallest)))


def oversample(df: DataFrame, label: str, key: str) -> DataFrame:
    """Repeat rows until every class, NULL among them, has the size of the largest; ``copy`` counts from 1."""
    counts = class_sizes(df, label)
    largest = max(counts.values(), default=0)
    whole = lookup({c: largest // n for c, n in counts.items()}, "int", class_name(label))
    extra = first_by_hash(df, label, key, F.lit(largest) % F.col("group_rows"))
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), whole + extra.cast("int"))))


def rank_features(df: DataFrame, label: str, columns: list[str], method: str) -> DataFrame:
    """Rows (feature, score): variance, or absolute correlation with a numeric label."""
    if method not in ("variance", "correlation"):
        raise ValueError(f"unknown method {method!r}")
    if method == "variance":
        return df.agg(*[F.var_pop(c).alias(c) for c in columns]).unpivot([], columns, "feature", "score")
    matrix = comoments(df, [*columns, label])[()].correlations()
    scores = [None if r != r else abs(float(r)) for r in matrix[-1, :-1]]
    return small_frame(df.sparkSession, {"feature": "string", "score": "double"}, list(zip(columns, scores, strict=True)))


def select_features(
    df: DataFrame, label: str, columns: list[str], method: str, k: int
) -> tuple[DataFrame, list[str]]:
    """Keep the ``k`` best features; other columns stay."""
    best = rank_features(df, label, columns, method).orderBy(
        F.desc_nulls_last("score"), F.asc("feature")
    )
    kept = [r["feature"] for r in best.limit(k).collect()]
    return df.drop(*[c for c in columns if c not in kept]), kept


def engineer(
    df: DataFrame, entity: str, ts: str, value: str, kind: str, kinds: list[str]
) -> DataFrame:
    """Counts, shares, amounts and activity dates per entity, in one aggregate."""
    per = df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.max(value).alias("largest"),
        F.min(ts).alias("__first"),
        F.max(ts).alias("__last"),
        *[F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds],
    )
    span = F.datediff(F.col("__last").cast("date"), F.col("__first").cast("date"))
    return per.withColumns(
        {
            "mean_value": F.try_divide("total", "n"),
            "active_span": span,
            **{f"share_{k}": F.try_divide(f"n_{k}", "n") for k in kinds},
        }
    ).drop("__first", "__last")


def leakage_report(
    train: DataFrame, test: DataFrame, key: str, columns: list[str], label: str
) -> DataFrame:
    """Rows (check, subject, n).

    ``shared_keys``: keys found on both sides. ``mixed_values``: per feature, how many of its
    training values occur with more than one label; 0 on a repeated value means that the feature
    gives the label away. ``values``: distinct values of the feature, to read the former against.
    """
    shared = (
        test.select(key)
        .distinct()
        .join(train.select(key), key, "left_semi")
        .agg(
            F.lit("shared_keys").alias("check"),
            F.lit(key).alias("subject"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    cells = train.select(
        F.col(label).alias("__label"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("subject"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("cell"),
    )
    per_value = cells.groupBy("cell").agg(
        F.min("__label").alias("lowest"), F.max("__label").alias("highest")
    )
    per_feature = per_value.groupBy(F.col("cell.subject").alias("subject")).agg(
        F.count_if(F.col("lowest") != F.col("highest")).alias("mixed_values"),
        F.count(F.lit(1)).alias("values"),
    )
    long = per_feature.unpivot(["subject"], ["mixed_values", "values"], "check", "n")
    return shared.unionByName(long)


def smote(
    df: DataFrame, label: str, minority, columns: list[str], key: str, k: int = 5
) -> DataFrame:
    """New minority rows, as many as it lacks to the largest class.

    Each lies between a minority row and one of its k nearest minority rows. Which neighbour and
    how far along comes from md5(key:copy), so a rerun gives the same rows. Run it on training
    rows only. Result: key, copy, columns.
    """
    counts = fit_counts(df, label)
    size, largest = counts[minority], max(counts.values())
    rows = df.filter(F.col(label) == F.lit(minority)).select(
        key, *[F.col(c).cast("double").alias(c) for c in columns]
    )
    reach = min(k, size - 1)
    if reach < 1 or largest == size:
        return rows.withColumn("copy", F.lit(0)).select(key, "copy", *columns).limit(0)
    lacking = largest - size
    rows = checkpointed(rows)  # read by several jobs below
    extra = first_by_hash(rows, None, key, F.lit(lacking % size))
    copies = F.lit(lacking // size) + extra.cast("int")
    drawn = rows.filter(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    seed = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col("copy").cast("string")))

    def hex_number(start: int) -> Column:
        return F.conv(F.substring(seed, start, 8), 16, 10).cast("long")

    drawn = drawn.withColumns(
        {"__gap": hex_number(1) / F.lit(4294967296.0), "__rank": hex_number(9) % reach + 1}
    )
    near = nearest(rows, columns, reach).select(
        *[F.col(c).alias(f"__at_{c}") for c in columns],
        *[f"near_{c}" for c in columns],
        "from_rank",
        "to_rank",
    )
    match = same_keys(drawn, near, [(c, f"__at_{c}") for c in columns])
    match = match & F.col("__rank").between(F.col("from_rank"), F.col("to_rank"))
    return drawn.join(near, match).select(
        key,
        "copy",
        *[(F.col(c) + F.col("__gap") * (F.col(f"near_{c}") - F.col(c))).alias(c) for c in columns],
    )
