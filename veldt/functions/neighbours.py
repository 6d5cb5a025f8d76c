"""Exact nearest neighbours among many points, without pairing every point with every other.

Identical points are merged first, with a count. A k-d tree cut from a bounded sample only says
where to look: points are grouped by leaf, neighbours are found within the leaf, and a point whose
search ball reaches into other leaves is sent to just those. The two candidate lists are merged,
so the result is that of a brute-force search whatever the sample was.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veldt.session import checkpointed

LEAF_POINTS = 2_000
MAX_LEAVES = 16_384
ASKED_PER_TASK = 50_000
SAMPLE_PER_LEAF = 16
CHUNK = 256


class Cuts:
    """Nested cuts: halve the fullest box along its widest side until there are enough boxes."""

    def __init__(self, sample: np.ndarray, leaves: int):
        dims = sample.shape[1]
        self.axis, self.cut, self.below, self.above, self.leaf = [], [], [], [], []
        self.boxes: list[np.ndarray] = []
        everything = np.stack([np.full(dims, -np.inf), np.full(dims, np.inf)], axis=1)
        heap = [(-len(sample), self._node(), sample, everything)]
        done = []
        while heap and len(heap) + len(done) < leaves:
            _, node, points, box = heapq.heappop(heap)
            axis = int(np.ptp(points, axis=0).argmax()) if len(points) else 0
            values = points[:, axis]
            if len(points) == 0 or values.min() == values.max():
                done.append((node, box))
                continue
            cut = float(np.median(values))
            if not (values < cut).any():
                cut = float(values[values > cut].min())
            sides = []
            for part, side in ((points[values < cut], 1), (points[values >= cut], 0)):
                smaller = box.copy()
                smaller[axis, side] = cut
                sides.append(self._node())
                heapq.heappush(heap, (-len(part), sides[-1], part, smaller))
            self.axis[node], self.cut[node] = axis, cut
            self.below[node], self.above[node] = sides
        for node, box in done + [(h[1], h[3]) for h in heap]:
            self.leaf[node] = len(self.boxes)
            self.boxes.append(box)
        names = ("axis", "cut", "below", "above", "leaf", "boxes")
        self.__dict__.update({n: np.array(getattr(self, n)) for n in names})

    def _node(self) -> int:
        for values, blank in (
            (self.axis, 0), (self.cut, 0.0), (self.below, -1), (self.above, -1), (self.leaf, -1)
        ):
            values.append(blank)
        return len(self.axis) - 1

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """Box number of each point, one cut per step for all points at once."""
        at = np.zeros(len(points), dtype=int)
        open_ = np.arange(len(points))
        while len(open_):
            node = at[open_]
            open_ = open_[self.leaf[node] < 0]
            node = at[open_]
            under = points[open_, self.axis[node]] < self.cut[node]
            at[open_] = np.where(under, self.below[node], self.above[node])
        return self.leaf[at].astype(np.int32)

    def reached(self, point: np.ndarray, squared: float) -> np.ndarray:
        """Boxes that a ball around the point touches."""
        gaps = np.maximum(self.boxes[:, :, 0] - point, point - self.boxes[:, :, 1]).clip(min=0)
        return np.flatnonzero((gaps**2).sum(axis=1) <= squared)


def _closest(queries: np.ndarray, points: np.ndarray, counts: np.ndarray, k: int, own: bool):
    """Yield (query index, squared distances, point rows, copies) of the first k neighbours.

    Ties go to the smaller coordinates. With ``own`` a query finds itself, less one copy.
    """
    order = np.lexsort(points.T[::-1])
    points, counts = points[order], counts[order]
    for i in range(0, len(queries), CHUNK):
        chunk = queries[i : i + CHUNK]
        total = np.zeros((len(chunk), len(points)))
        for d in range(points.shape[1]):
            gap = chunk[:, d, None] - points[None, :, d]
            total = total + gap * gap
        ranked = np.argsort(total, axis=1, kind="stable")[:, : k + 1]
        for j in range(len(chunk)):
            rows = ranked[j]
            copies = counts[rows].copy()
            if own:
                copies[(points[rows] == chunk[j]).all(axis=1)] -= 1
            rows, copies = rows[copies > 0], copies[copies > 0]
            needed = np.cumsum(copies) - copies < k
            rows, copies = rows[needed], copies[needed]
            yield i + j, total[j, rows], points[rows], copies


def nearest(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """Neighbours of each distinct point: columns, then ``near_<column>``, ``from_rank``, ``to_rank``.

    Of a point's neighbours number 1..k, those from ``from_rank`` to ``to_rank`` are at that place.
    """
    coordinates = [F.col(c).cast("double").alias(c) for c in columns]
    points = df.select(*coordinates).groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    size = points.count()
    leaves = int(min(MAX_LEAVES, max(1, -(-size // LEAF_POINTS))))
    share = min(1.0, leaves * SAMPLE_PER_LEAF / max(size, 1))
    sample = points.select(*columns).sample(fraction=share, seed=11).limit(leaves * SAMPLE_PER_LEAF * 2)
    sampled = np.array([list(r) for r in sample.collect()], dtype=float).reshape(-1, len(columns))
    cuts = Cuts(sampled, leaves)
    near = [f"near_{c}" for c in columns]
    doubles = ", ".join(f"{c} double" for c in columns)

    def place(frames):
        for frame in frames:
            yield frame.assign(leaf=cuts.leaf_of(frame[columns].to_numpy()))

    placed = points.mapInPandas(place, f"{doubles}, copies long, leaf int")

    found_schema = (
        f"{doubles}, {', '.join(f'{n} double' for n in near)}, d2 double, copies long, search int"
    )

    def rows_of(queries, found) -> pd.DataFrame:
        """A row per (query, neighbour); ``found`` has (query, squared distances, neighbours, copies) of each query."""
        if not found:
            return pd.DataFrame(columns=[*columns, *near, "d2", "copies", "search"])
        query, d2, at, copies = zip(*found)
        here, at = queries[np.repeat(query, [len(d) for d in d2])], np.concatenate(at)
        data = {c: here[:, j] for j, c in enumerate(columns)} | {n: at[:, j] for j, n in enumerate(near)}
        return pd.DataFrame(data | {"d2": np.concatenate(d2), "copies": np.concatenate(copies), "search": np.int32(-1)})

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        here = frame[columns].to_numpy()
        leaf = int(frame["leaf"].iloc[0])
        found, reached = list(_closest(here, here, frame["copies"].to_numpy(), k, True)), []
        for i, d2, _, copies in found:
            others = cuts.reached(here[i], d2[-1] if copies.sum() >= k else np.inf)
            reached.append(others[others != leaf])
        out = [rows_of(here, found)]
        if sum(map(len, reached)):
            asking = here[np.repeat([i for i, *_ in found], [len(r) for r in reached])]
            search = np.concatenate(reached).astype(np.int32)
            out.append(pd.DataFrame({c: asking[:, j] for j, c in enumerate(columns)} | {"search": search}))
        return pd.concat(out).reindex(columns=[*columns, *near, "d2", "copies", "search"])

    def across(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(there):
            return rows_of(None, [])
        queries = asked[columns].to_numpy()
        return rows_of(queries, list(_closest(queries, there[columns].to_numpy(), there["copies"].to_numpy(), k, False)))

    first = checkpointed(placed.groupBy("leaf").applyInPandas(within, found_schema))
    asked = first.filter("search >= 0").select(*columns, F.col("search").alias("leaf"))
    # a leaf that very many balls reach is answered in several tasks; one row per leaf here
    asks = asked.groupBy("leaf").agg(
        F.ceil(F.count(F.lit(1)) / ASKED_PER_TASK).cast("int").alias("parts")
    )
    asked = asked.join(F.broadcast(asks), "leaf").select(
        *columns, "leaf", F.pmod(F.xxhash64(*columns), F.col("parts")).cast("int").alias("part")
    )
    there = placed.join(F.broadcast(asks), "leaf").select(
        *columns, "copies", "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    second = (
        asked.groupBy("leaf", "part")
        .cogroup(there.groupBy("leaf", "part"))
        .applyInPandas(across, found_schema)
    )
    merged = first.filter("search < 0").unionByName(second)
    by_distance = (
        Window.partitionBy(*columns)
        .orderBy("d2", *near)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = merged.withColumn("to_rank", F.sum("copies").over(by_distance))
    return ranked.withColumn("from_rank", F.col("to_rank") - F.col("copies") + 1).filter(
        F.col("from_rank") <= k
    ).select(*columns, *near, "from_rank", "to_rank")
