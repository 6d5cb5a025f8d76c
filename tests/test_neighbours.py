"""Exact neighbours against brute force, with many leaves and many identical points."""

import numpy as np
import pytest

from veldt.functions import neighbours


def brute_force(points, k):
    """Distances to the k nearest other points, per distinct point."""
    distances = {}
    for i, p in enumerate(points):
        d2 = np.zeros(len(points))
        for d in range(points.shape[1]):
            d2 += (p[d] - points[:, d]) * (p[d] - points[:, d])
        others = sorted((d2[j], *points[j]) for j in range(len(points)) if j != i)
        distances[tuple(p)] = [x[1:] for x in others[:k]]
    return distances


@pytest.mark.parametrize("leaf_points", [20, 100_000])
def test_same_as_brute_force(spark, monkeypatch, leaf_points):
    monkeypatch.setattr(neighbours, "LEAF_POINTS", leaf_points)
    monkeypatch.setattr(neighbours, "ASKED_PER_TASK", 5)
    rng = np.random.default_rng(3)
    points = np.concatenate(
        [rng.normal(size=(250, 2)).round(1), np.tile([[0.5, 0.5]], (120, 1)), rng.normal(8, 3, (30, 2))]
    )
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double")
    found = {}
    for r in neighbours.nearest(df, ["x", "y"], 5).collect():
        for place in range(r.from_rank, min(r.to_rank, 5) + 1):
            found.setdefault((r.x, r.y), {})[place] = (r.near_x, r.near_y)
    expected = brute_force(points, 5)
    assert {p: [n[i] for i in range(1, 6)] for p, n in found.items()} == expected
