"""Exact quantiles by narrowing, against sorted values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from veldt.functions import quantiles
from veldt.functions.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.501, 0.75, 0.999, 1.0]


def plain(values, p):
    """NaN last, NULL never, linear between neighbours."""
    known = sorted((v for v in values if v is not None and not math.isnan(v))) + [v for v in values if v is not None and math.isnan(v)]
    place = (len(known) - 1) * p
    low, high = known[math.floor(place)], known[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


def shapes(n=3000):
    r = random.Random(7)
    return {
        "even": [r.random() for _ in range(n)],
        "ties": [float(r.choice([1, 1, 1, 1, 2, 5])) for _ in range(n)],
        "one": [4.0] * n,
        "tail": [math.exp(r.gauss(0, 9)) for _ in range(n)],
        "gaps": [r.choice([None, None, r.gauss(0, 1)]) for _ in range(n)],
        "odd": [r.choice([float("nan"), float("inf"), -float("inf"), 0.0, -0.0, r.gauss(0, 1)]) for _ in range(n)],
        "none": [None] * n,
    }


@pytest.fixture(scope="module")
def table(spark):
    columns = shapes()
    rows = [(i % 3 or None, *(columns[c][i] for c in columns)) for i in range(len(columns["even"]))]
    return spark.createDataFrame(rows, "g int, " + ", ".join(f"{c} double" for c in columns)).repartition(6)


@pytest.fixture(params=["at once", "many passes"])
def passes(request, monkeypatch):
    if request.param == "many passes":
        monkeypatch.setattr(quantiles, "INSIDE", 300)
        monkeypatch.setattr(quantiles, "GRID_CELLS", 1)


def agree(found, values, probabilities=PROBABILITIES):
    for i, p in enumerate(probabilities):
        want, got = plain(values, p), found[f"p{i}"]
        assert got == want or math.isnan(got) and math.isnan(want), (p, got, want)


def test_whole_columns(table, passes):
    columns = shapes()
    found = {r["column"]: r for r in exact_quantiles(table, list(columns), PROBABILITIES).collect()}
    assert set(found) == set(columns) - {"none"}
    for c, row in found.items():
        agree(row, columns[c])


def test_groups_and_the_null_group(table, passes):
    columns = shapes()
    for r in exact_quantiles(table, ["tail", "gaps"], PROBABILITIES, ["g"]).collect():
        agree(r, [v for i, v in enumerate(columns[r["column"]]) if (i % 3 or None) == r["g"]])


def test_many_groups_are_counted_instead(table, monkeypatch):
    want = {(r["g"], r["column"]): r for r in exact_quantiles(table, ["even", "ties"], [0.1, 0.5], ["g"]).collect()}
    monkeypatch.setattr(quantiles, "MAX_GROUPS", 2)
    got = {(r["g"], r["column"]): r for r in exact_quantiles(table, ["even", "ties"], [0.1, 0.5], ["g"]).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k][p], want[k][p]) for k in got for p in ("p0", "p1"))


def test_a_wrong_sketch_is_noticed(table, monkeypatch):
    monkeypatch.setattr(quantiles, "sketch", lambda value, steps: F.array(*[F.lit(0.5)] * (steps + 1)))
    monkeypatch.setattr(quantiles, "GRID_CELLS", 1)
    agree(exact_quantiles(table, ["even"], [0.3, 0.9]).first(), shapes()["even"], [0.3, 0.9])


def test_sizes_of_a_few_rows(spark):
    for n in range(1, 9):
        values = [float((7 * i) % 5) for i in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        agree(exact_quantiles(df, ["v"], PROBABILITIES).first(), values)
    assert exact_quantiles(spark.createDataFrame([], "v double"), ["v"], [0.5]).count() == 0


def test_only_a_slice_is_shuffled(spark, monkeypatch):
    """The counting pass gets a small part of the rows, whatever the ranks."""
    rows = spark.range(200_000).select((F.hash("id") / 1e6).alias("v"), (F.hash("id", F.lit(1)) % 1000).alias("w"))
    held = []
    count_inside = quantiles.count_inside

    def watched(df, by, brackets):
        count_inside(df, by, brackets)
        held.append(sum(n for found in brackets.values() for b in found.values() for v, n in b.counts.items() if v is not None))

    monkeypatch.setattr(quantiles, "count_inside", watched)
    exact_quantiles(rows, ["v"], [0.25, 0.5, 0.75])
    assert len(held) == 1 and held[0] < 6_000
    exact_quantiles(rows, ["w"], [0.5])  # heavy ties: few distinct values, counted map-side
    assert len(held) == 2
