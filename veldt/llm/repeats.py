"""Repeated byte strings of a corpus, by enhanced suffix arrays over content-chosen anchors.

A string of ``length`` bytes that occurs twice holds the same anchors both times: an anchor is a short substring whose
hash is least among all that start in some window of ``length`` bytes. So suffixes are compared only where anchors are.
All suffixes that start with the same anchor form a group. A group is sorted (a suffix array with common-prefix
lengths), a stack scan walks its common-prefix intervals as a tree, and in each interval the suffixes are ordered by
what stands to their left: members whose left and right extensions together reach ``length`` form a repeat group, with
all its occurrences. An interval whose members differ on the left is thereby split into its maximal repeats.

Occurrences with the same surroundings are one member of a group, so exact copies cost nothing. What a document loses
is judged on the input, not on what other documents lose.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; repeated rows count as occurrences
of each other; a null id is an id like others; an empty table gives an empty table; extra columns pass through, and
columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from veldt.llm.common import claim, map_rows, parts_for, written
from veldt.llm.words import U, mixed, prefix_hashes, span_hashes

LENGTH = 200
ANCHOR = 32


def sliding_least(x: np.ndarray, width: int, ufunc=np.minimum) -> np.ndarray:
    """Least (or greatest) of every ``width`` neighbours, from running values within blocks."""
    n = len(x)
    full = -(-n // width) * width
    fill = x[-1:].repeat(full - n)
    grid = np.concatenate([x, fill]).reshape(-1, width)
    ahead = ufunc.accumulate(grid, axis=1).ravel()
    behind = ufunc.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, length: int, size: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, surroundings' hash, position, bytes to the left, to the right) of each anchor of one text."""
    n, width = len(data), length - size + 1
    h = prefix_hashes(data)
    at = np.arange(n - size + 1)
    grams = span_hashes(h, at, at + size)
    order = (grams >> U(32)).astype(np.uint32)
    least = sliding_least(order, width)
    rim = np.zeros(width - 1, dtype=np.uint32)
    chosen = sliding_least(np.concatenate([rim, least, rim]), width, np.maximum) == order
    pos = np.flatnonzero(chosen)
    left = np.minimum(pos, length - size)
    right = np.minimum(n - pos, length)
    around = mixed(span_hashes(h, pos - left, pos + right) ^ mixed((left * 1024 + right).astype(U)))
    return grams[pos].view(np.int64), around.view(np.int64), pos, left, right


#: position, bytes to the left and to the right in one number, to keep the rows of the largest shuffle narrow
OCCURRENCE = StructType([StructField(c, LongType()) for c in ("doc", "a", "ctx", "at")])
SIDE_BITS = 9
SIDE = (1 << SIDE_BITS) - 1


def unpacked(at: Column) -> tuple[Column, Column, Column]:
    """Position, left, right."""
    return F.shiftright(at, 2 * SIDE_BITS), F.shiftright(at, SIDE_BITS).bitwiseAND(SIDE), at.bitwiseAND(SIDE)


def occurrences(rows: DataFrame, length: int, size: int) -> DataFrame:
    """(doc, a, ctx, at) for each anchor of each text."""
    if length > SIDE:
        raise ValueError(f"repeats longer than {SIDE} bytes need more bits for the sides of an anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        schema = pa.schema([(c, pa.int64()) for c in ("doc", "a", "ctx", "at")])
        for batch in batches:
            docs, texts = batch.column("doc"), batch.column("text")
            out: list[tuple] = []
            held = 0
            for i in range(batch.num_rows):
                data = np.frombuffer(texts[i].as_buffer() or b"", np.uint8) if texts[i].is_valid else ()
                if len(data) >= length:
                    grams, around, pos, left, right = anchors(data, length, size)
                    at = (pos << 2 * SIDE_BITS) | (left << SIDE_BITS) | right
                    out.append((np.full(len(pos), docs[i].as_py()), grams, around, at))
                    held += len(pos)
                if held > 100_000 or i == batch.num_rows - 1 and out:
                    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
                    out, held = [], 0

    return rows.mapInArrow(run, OCCURRENCE)


def surroundings(rows: DataFrame, length: int, size: int) -> DataFrame:
    """(a, ctx, many, left reversed, right) of wanted positions [(pos, a, ctx, many)] in each text."""
    fields = [StructField("a", LongType()), StructField("ctx", LongType()), StructField("many", LongType()),
              StructField("left", BinaryType()), StructField("right", BinaryType())]
    names = [f.name for f in fields]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out: list[list] = [[] for _ in names]
                for text, wanted in zip(part.column("text").to_pylist(), part.column("wanted").to_pylist(), strict=True):
                    data = text.encode()
                    for w in wanted:
                        p = w["pos"]
                        row = (w["a"], w["ctx"], w["many"], data[max(0, p - length + size) : p][::-1], data[p : p + length])
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return rows.mapInArrow(run, StructType(fields))


def shared_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    differ = int.from_bytes(x[:n]) ^ int.from_bytes(y[:n])
    return n - (differ.bit_length() + 7) // 8


def repeat_groups(members: list[tuple[bytes, bytes]], length: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """Walk the common-prefix intervals of a group of (left reversed, right) members.

    Yields (common right extension, members in order of their left sides, left extension shared by each with the next)
    for each run of at least two members in an interval whose two extensions together reach ``length``.
    """
    n = len(members)
    array = sorted(range(n), key=lambda i: members[i][1])
    lcp = [shared_prefix(members[x][1], members[y][1]) for x, y in zip(array, array[1:], strict=False)]
    lefts = sorted(range(n), key=lambda i: members[i][0])
    place = {m: r for r, m in enumerate(lefts)}
    shared = [shared_prefix(members[x][0], members[y][0]) for x, y in zip(lefts, lefts[1:], strict=False)]

    def runs(right: int, interval: list[int]) -> Iterator[tuple[int, list[int], list[int]]]:
        need = length - right
        ranks = sorted(place[m] for m in interval)
        run, ext = [lefts[ranks[0]]], []
        for x, y in zip(ranks, ranks[1:], strict=False):
            left = shared[x] if y == x + 1 else min(shared[x:y])
            if left < need:
                if ext:
                    yield right, run, ext
                run, ext = [], []
            else:
                ext.append(left)
            run.append(lefts[y])
        if ext:
            yield right, run, ext

    stack: list[tuple[int, int]] = []
    for i, right in enumerate([*lcp, 0]):
        start = i
        while stack and stack[-1][0] > right:
            depth, start = stack.pop()
            yield from runs(depth, array[start : i + 1])
        if right and (not stack or stack[-1][0] < right):
            stack.append((right, start))


def cover(members: list[tuple[bytes, bytes]], length: int) -> list[tuple[int, int]]:
    """How far to the left and right of its anchor each member is covered by repeats; (0, 0) for not at all."""
    out = [[0, 0] for _ in members]
    for right, run, ext in repeat_groups(members, length):
        for k, m in enumerate(run):
            best = max(ext[k - 1] if k else 0, ext[k] if k < len(ext) else 0)
            out[m][0], out[m][1] = max(out[m][0], best), max(out[m][1], right)
    return [tuple(x) for x in out]


def covered(rows: DataFrame, length: int) -> DataFrame:
    """(a, ctx, left, right) for the members of groups; rows of a group arrive next to each other."""
    schema = StructType([StructField("a", LongType()), StructField("ctx", LongType()), StructField("left", LongType()), StructField("right", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(anchor, group, out):
            keys = list(group)
            for key, (left, right) in zip(keys, cover([group[k][:2] for k in keys], length), strict=True):
                if group[key][2] > 1:
                    left, right = len(group[key][0]), len(group[key][1])
                if right:
                    out.append((anchor, key, left, right))

        claim(__name__)
        anchor, group, out = None, {}, []
        for batch in batches:
            for a, ctx, many, left, right in zip(*(batch.column(c).to_pylist() for c in ("a", "ctx", "many", "left", "right")), strict=True):
                if a != anchor:
                    if group:
                        done(anchor, group, out)
                    anchor, group = a, {}
                group[ctx] = (left, right, many)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=arrow)
                out = []
        if group:
            done(anchor, group, out)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=arrow)

    arrow = pa.schema([("a", pa.int64()), ("ctx", pa.int64()), ("left", pa.int64()), ("right", pa.int64())])
    return rows.mapInArrow(run, schema)


def repeated_spans(rows: DataFrame, length: int = LENGTH, size: int = ANCHOR) -> DataFrame:
    """(doc, start, end): overlapping spans of the keyed texts (doc, text) that repeats cover."""
    marks = occurrences(rows, length, size)
    twice = marks.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
    marks = written(marks.join(twice, "a", "left_semi"))
    places = marks.groupBy("a", "ctx").agg(F.count("*").alias("many"), F.min(F.struct("doc", "at")).alias("rep"))
    places = written(places.select("a", "ctx", "many", "rep.doc", "rep.at"))
    pos, left, right = unpacked(F.col("at"))
    varied = places.groupBy("a").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("a")
    alike = places.join(varied, "a", "left_anti").filter("many > 1").select("a", "ctx", left.alias("left"), right.alias("right"))
    wanted = places.join(varied, "a", "left_semi").select("doc", F.struct(pos.alias("pos"), "a", "ctx", "many").alias("w"))
    wanted = wanted.groupBy("doc").agg(F.collect_list("w").alias("wanted"))
    around = surroundings(rows.join(wanted, "doc").select("text", "wanted"), length, size)
    groups = around.repartition(parts_for(rows), "a").sortWithinPartitions("a")
    found = covered(groups, length).unionByName(alike)
    spans = marks.join(found, ["a", "ctx"])
    return spans.select("doc", (pos - F.col("left")).alias("start"), (pos + F.col("right")).alias("end"))


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, size: int = ANCHOR
) -> DataFrame:
    """Rows of ``docs`` with n_bytes, spans (removed runs as [start, end)) and kept (the remaining bytes)."""
    names = ["n_bytes", "spans", "kept"]
    keyed = docs.drop(*names).withColumn("_doc", F.xxhash64(doc_id, text))
    rows = keyed.select(F.col("_doc").alias("doc"), F.col(text).alias("text"))
    spans = repeated_spans(rows, length, size)
    spans = spans.groupBy(F.col("doc").alias("_doc")).agg(F.collect_set(F.struct("start", "end")).alias("_spans"))

    def make():
        def run(texts, found):
            sizes, runs, kept = [], [], []
            for t, s in zip(texts, found, strict=True):
                data = (t or "").encode()
                merged: list[list[int]] = []
                for span in sorted((x["start"], x["end"]) for x in s or ()):
                    if merged and span[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span[1])
                    else:
                        merged.append(list(span))
                sizes.append(len(data))
                runs.append(merged)
                edges = [0, *(x for m in merged for x in m), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            return sizes, runs, kept

        return run

    outputs = [("n_bytes", LongType()), ("spans", ArrayType(ArrayType(LongType()))), ("kept", BinaryType())]
    return map_rows(keyed.join(spans, "_doc", "left"), make, [text, "_spans"], outputs, chunk=128).drop("_doc", "_spans")
