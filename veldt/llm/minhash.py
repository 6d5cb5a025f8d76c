"""Near duplicates by circulant MinHash.

Two permutations make all coordinates of a signature: the first spreads the shingles over 32 bits, the second is used
again for every coordinate after a circular shift. Bands of coordinates give buckets. Documents with equal sets are one
class from the start. In a bucket, classes are first compared with one pivot, chosen in an order of the bucket's own, so
that a class of a large group meets different pivots in its buckets; what is then still apart is compared class by class, unless bitmaps of their shingles show that too few can be in common for a link
(a bit that only one map has stands for a shingle that only one set has). So every pair that
meets in a bucket is compared, ruled out or already connected, and a large group costs a few comparisons per member. Links are confirmed on the full shingle sets.

Defined results: a null or wordless text has an empty set and is linked with nothing; with fewer words than a shingle,
the whole sequence is one shingle; a null id is linked with nothing, its component is null and it is kept; repeated
rows give repeated rows; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from veldt.llm.common import checkpointed, claim, map_rows, written
from veldt.llm.words import blocks, mixed, shingle_sets

WORDS = 5
SIMILARITY = (3, 4)
BANDS, ROWS = 32, 4
PIVOT_ROUNDS = 1
SET_BYTES = 6
BITMAP_BITS = 2048
FILTER_BITS, FILTER_PROBES = 1 << 26, 4
STEP = 2048


def spread(x: np.ndarray) -> np.ndarray:
    """The permutation of 32-bit integers that all coordinates share, in place."""
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """Coordinate k is the least image of the set under the shared permutation, shifted circularly by k."""
    first = (mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    shifts = (np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B1)).astype(np.uint32)[:, None]
    best = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(first), STEP):
        np.minimum(best, spread(first[None, at : at + STEP] + shifts).min(axis=1), out=best)
    return best


def band_keys(sig: np.ndarray, bands: int, rows: int) -> list[int]:
    weights = mixed(np.arange(7, 7 + rows, dtype=np.uint64))
    keys = (sig.reshape(bands, rows).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
    return mixed(keys ^ mixed(np.arange(bands, dtype=np.uint64))).view(np.int64).tolist()


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name the set."""
    other = mixed(shingles ^ np.uint64(0xD6E8FEB86659FD93))
    return np.array([shingles.sum(dtype=np.uint64) + np.uint64(len(shingles)), other.sum(dtype=np.uint64)]).tobytes()


def signed(df: DataFrame, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """Add each text's set size, set key and band keys."""

    def make():
        def run(texts):
            sizes, keys, banded = [], [], []
            for run_of in blocks(texts):
                for s in shingle_sets(run_of, words):
                    sizes.append(len(s))
                    keys.append(set_key(s))
                    banded.append(band_keys(signature(s, bands * rows), bands, rows) if len(s) else [])
            return sizes, keys, banded

        return run

    outputs = [("set_size", LongType()), ("set_key", BinaryType()), ("bands", ArrayType(LongType()))]
    return map_rows(df, make, [text], outputs)


def packed(shingles: np.ndarray) -> bytes:
    """The low bytes of a set's hashes; enough to tell the shingles of two texts apart."""
    return shingles.view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    whole = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    whole[:, :SET_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    return whole.view(np.uint64)[:, 0]


def bitmap(shingles: np.ndarray) -> list[int]:
    bits = np.zeros(BITMAP_BITS, dtype=bool)
    bits[(shingles & np.uint64(BITMAP_BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64).tolist()


def only_in(x: str, y: str) -> Column:
    """How many bits of map ``x`` map ``y`` lacks."""
    lacking = F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))))
    return F.aggregate(lacking, F.lit(0), lambda total, k: total + k)


def probes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of a filter of ``size`` bits that stand for a hash, a row each."""
    steps = np.arange(FILTER_PROBES, dtype=np.uint64)[:, None]
    return ((mixed(hashes) + steps * (mixed(~hashes) | np.uint64(1))) & np.uint64(size - 1)).astype(np.int64)


def filter_of(keys: DataFrame) -> np.ndarray:
    """A filter of the hashes in column ``hash``: a flag per bit, 16 bits a hash, ``FILTER_BITS`` at most."""
    size = min(FILTER_BITS, 1 << max(10, (16 * keys.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(size, dtype=bool)
        for batch in batches:
            flags[probes(batch.column("hash").to_numpy().view(np.uint64), size)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags).tobytes()], pa.binary())], names=["flags"])

    parts = keys.mapInArrow(run, "flags binary").rdd.map(lambda row: np.frombuffer(row["flags"], np.uint8))
    return np.unpackbits(parts.treeAggregate(np.zeros(size // 8, np.uint8), np.bitwise_or, np.bitwise_or)).astype(bool)


def sets_of(docs: DataFrame, keys: DataFrame, words: int) -> DataFrame:
    """(set_key, shingles, bits) of documents whose id's hash is among ``keys``, and of a few others.

    Texts are passed over where they are instead of being joined with the wanted ids. The filter is bounded; where it
    fills up (some ten million ids), more sets than wanted are made, and the join on their keys drops those.
    """
    flags = docs.sparkSession.sparkContext.broadcast(np.packbits(filter_of(keys)))
    schema = StructType([StructField("set_key", BinaryType()), StructField("shingles", BinaryType()), StructField("bits", ArrayType(LongType()))])
    kinds = [pa.binary(), pa.binary(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        held = np.unpackbits(flags.value).astype(bool)
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            texts = batch.column("text").take(pa.array(np.flatnonzero(held[probes(hashes, len(held))].all(axis=0))))
            for at in range(0, len(texts), 128):
                sets = [s for run_of in blocks(texts.slice(at, 128).to_pylist()) for s in shingle_sets(run_of, words)]
                made = [set_key(s) for s in sets], [packed(s) for s in sets], [bitmap(s) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(m, k) for m, k in zip(made, kinds, strict=True)], names=schema.names)

    return docs.select(F.xxhash64("doc_id").alias("hash"), "text").mapInArrow(run, schema)


def close(df: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Of rows (a, b, left, right), the pairs whose sets are similar enough."""
    part, whole = similarity

    def make():
        def run(left, right):
            out = []
            for x, y in zip(left, right, strict=True):
                n = (len(x) + len(y)) // SET_BYTES
                if whole * min(len(x), len(y)) < part * max(len(x), len(y)):
                    out.append(False)
                    continue
                both = np.sort(np.concatenate([unpacked(x), unpacked(y)]))
                shared = int((both[1:] == both[:-1]).sum())
                out.append(whole * shared >= part * (n - shared))
            return (out,)

        return run

    checked = map_rows(df, make, ["left", "right"], [("close", BooleanType())], chunk=128)
    return checked.filter("close").select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of undirected edges (a, b); root is the least node of its component.

    Alternates stars around larger and smaller neighbours until nothing changes; only counts reach the driver.
    """
    edges = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    while True:
        # done when every node points at one root and no root points further
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
        if ends.filter("up > 1 OR up = 1 AND root = 1").isEmpty():
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(small.union(low.select("a", F.col("m").alias("b"))).distinct())
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, row (hash of id and text), n_shingles, set_key, component_id,
    kept.

    ``similarity`` is a fraction (numerator, denominator), so the threshold is exact.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    base = written(signed(plain, "text", words, bands, rows).drop("text"))
    classes = (
        base.filter("set_size > 0 AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.first("set_size").alias("n"), F.first("bands").alias("bands"))
    )
    members = classes.select(F.explode("bands").alias("band"), F.col("set_key").alias("node"), "rep", "n")
    shared = members.groupBy("band").agg(F.count("*").alias("many")).filter("many > 1").select("band")
    members = written(members.join(shared, "band"))

    wanted = members.select("node").distinct()
    sets = sets_of(plain.filter("doc_id IS NOT NULL"), members.select(F.xxhash64("rep").alias("hash")).distinct(), words)
    sets = sets.join(wanted, sets["set_key"] == wanted["node"], "left_semi")
    sets = written(sets.groupBy("set_key").agg(F.first("shingles").alias("shingles"), F.first("bits").alias("bits")))

    part, whole = similarity
    sized = F.least("n", "m") * whole >= F.greatest("n", "m") * part
    common = F.least(F.col("n") - only_in("bits", "bits2"), F.col("m") - only_in("bits2", "bits"))
    possible = common * whole >= (F.col("n") + F.col("m") - common) * part
    maps = sets.select(F.col("set_key").alias("a"), "bits", (F.octet_length("shingles") / SET_BYTES).cast("long").alias("n"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among pairs (a, b): ruled out by bitmaps where these suffice, so that few sets are shipped."""
        pairs = pairs.join(maps, "a").join(maps.toDF("b", "bits2", "m"), "b").filter(possible).select("a", "b")
        left = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("right"))
        return close(pairs.join(left, "a").join(right, "b"), similarity)

    edges = None
    placed = members.withColumn("root", F.col("node"))
    for turn in range(PIVOT_ROUNDS + 1):
        if turn < PIVOT_ROUNDS:
            first = F.xxhash64("node", "band", F.lit(turn))
            pivots = placed.groupBy("band").agg(F.min(F.struct(first.alias("first"), "node", "root", "n")).alias("p"))
            other = pivots.select("band", "p.node", "p.root", "p.n").toDF("band", "b", "other", "m")
            pairs = placed.join(other, "band").filter((F.col("root") != F.col("other")) & sized)
        else:
            mapped = placed.join(sets.select(F.col("set_key").alias("node"), "bits"), "node").select("band", "node", "root", "n", "bits")
            other = mapped.toDF("band", "b", "other", "m", "bits2")
            pairs = mapped.join(other, (mapped["band"] == other["band"]) & (F.col("root") < F.col("other")) & sized & possible)
        found = confirmed(pairs.select(F.col("node").alias("a"), "b").distinct())
        edges = checkpointed(found if edges is None else edges.union(found))
        roots = checkpointed(components(edges))
        if turn == PIVOT_ROUNDS:
            break
        placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
        placed = checkpointed(placed.join(apart.select("band"), "band"))
        if not placed.take(1):
            break

    named = classes.select("set_key", "rep").join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
    named = named.withColumn("root", F.coalesce("root", "set_key"))
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    named = named.join(least, "root").select("set_key", "least")
    out = base.drop("bands").join(named, "set_key", "left")
    component = F.when(F.col("set_size") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select(
        "doc_id",
        "row",
        F.col("set_size").alias("n_shingles"),
        "set_key",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
