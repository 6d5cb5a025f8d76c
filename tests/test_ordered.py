"""Order-dependent columns: the split path for large groups gives what a plain window gives."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from veldt.functions import ordered
from veldt.operators import metrics as m


@pytest.fixture()
def small_limit(spark):
    spark.conf.set(ordered.LIMIT_SETTING, "40")
    yield
    spark.conf.unset(ordered.LIMIT_SETTING)


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds most rows, one value most of those; some keys are NULL."""
    return spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 != 0, "hot")
        .when(F.col("id") % 9 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("key"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") * 37 % 101).alias("value"),
    ).cache()


def by_order():
    return [F.asc_nulls_last("value"), F.asc_nulls_last("id")]


def same(a, b):
    columns = sorted(a.columns)
    left = sorted(map(tuple, a.select(columns).collect()), key=str)
    right = sorted(map(tuple, b.select(columns).collect()), key=str)
    assert left == right


@pytest.mark.parametrize("keys", [["key"], []])
def test_running_totals(small_limit, rows, keys):
    got = ordered.running_totals(
        rows, keys, by_order(), {"total": F.col("value"), "n": F.lit(1).cast("long")}
    )
    frame = Window.partitionBy(*keys).orderBy(*by_order()).rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.withColumns(
        {"total": F.sum("value").over(frame), "n": F.count(F.lit(1)).over(frame)}
    )
    same(got, plain)


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks(spark, rows, keys, descending):
    spark.conf.set(ordered.LIMIT_SETTING, "40")
    got = ordered.ranks(rows, keys, "value", "id", 7, descending)
    got = got.withColumn("percent_rank", F.round("percent_rank", 9)).toPandas()
    spark.conf.unset(ordered.LIMIT_SETTING)
    plain = ordered.ranks(rows, keys, "value", "id", 7, descending)
    plain = plain.withColumn("percent_rank", F.round("percent_rank", 9)).toPandas()
    got, plain = (x.sort_values("id").reset_index(drop=True) for x in (got, plain))
    for c in plain:
        assert (got[c].fillna("-").astype(str) == plain[c].fillna("-").astype(str)).all(), c


@pytest.mark.parametrize("back", [1, 6, 60])
def test_with_preceding(small_limit, rows, back):
    got = ordered.with_preceding(
        rows, ["key"], by_order(), back, {"total": F.sum("value")}, {"before": F.lag("value")}
    )
    plain_order = Window.partitionBy("key").orderBy(*by_order())
    plain = rows.withColumns(
        {
            "total": F.sum("value").over(plain_order.rowsBetween(-back, 0)),
            "before": F.lag("value").over(plain_order),
        }
    )
    same(got, plain)


def test_hashed_positions_and_first_rows(rows):
    placed = ordered.hashed_positions(rows, ["key"], "id")
    order = Window.partitionBy("key").orderBy(F.md5(F.col("id").cast("string")))
    whole = Window.partitionBy("key")
    plain = rows.select(
        "*",
        F.row_number().over(order).cast("long").alias("position"),
        F.count(F.lit(1)).over(whole).alias("group_rows"),
    )
    same(placed, plain)
    for wanted in (F.lit(3), F.ceil(F.col("group_rows") * 0.3), F.lit(10_000), F.lit(0)):
        known = rows.filter("key IS NOT NULL")
        got = known.filter(ordered.first_by_hash(known, "key", "id", wanted))
        same(
            got,
            plain.filter("key IS NOT NULL").filter(F.col("position") <= wanted).select(rows.columns),
        )


def test_counted_quantiles(small_limit, rows):
    got = ordered.counted_quantiles(rows, ["value", "id"], [0.1, 0.5, 0.99], ["key"])
    plain = rows.groupBy("key").agg(
        *[
            F.percentile(c, F.lit(p)).alias(f"{c}_{i}")
            for c in ("value", "id")
            for i, p in enumerate((0.1, 0.5, 0.99))
        ]
    )
    expected = {r["key"]: r for r in plain.collect()}
    for r in got.collect():
        for i in range(3):
            assert r[f"p{i}"] == pytest.approx(expected[r["key"]][f"{r['column']}_{i}"])


def test_curves(spark, rows):
    scores = rows.select((F.col("id") % 5 == 0).cast("int").alias("y"), (F.col("id") * 7919 % 613).alias("s"))
    plain = [fn(scores, "y", "s").toPandas() for fn in (m.roc_auc, m.average_precision)]
    curve = m.roc_curve(scores, "y", "s").toPandas().sort_values("threshold")
    spark.conf.set(ordered.LIMIT_SETTING, "40")
    split = [fn(scores, "y", "s").toPandas() for fn in (m.roc_auc, m.average_precision)]
    split_curve = m.roc_curve(scores, "y", "s").toPandas().sort_values("threshold")
    spark.conf.unset(ordered.LIMIT_SETTING)
    for a, b in zip(plain, split):
        assert a.iloc[0, 0] == pytest.approx(b.iloc[0, 0], abs=1e-12)
    assert curve.reset_index(drop=True).equals(split_curve.reset_index(drop=True))
