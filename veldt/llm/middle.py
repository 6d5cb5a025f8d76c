"""Fill-in-the-middle texts by a secondary sort of pieces.

A text is cut into units, a prefix, a middle and a suffix are drawn from a hash of its id, and each part leaves the
reader as pieces of at most ``UNITS`` units, keyed by document and by their place in the output. One
``repartitionAndSortWithinPartitions`` brings the pieces of a document together in output order, so that a digest of the
output grows piece by piece and no task joins a whole text. The same pieces, told apart by the marks between them, are
then keyed by their place in the original and sorted again; the partitioner is the same, so this needs no second
shuffle. The sorts spill to disk where a partition is larger than the worker's memory.

Defined results: a null text is empty and plain; a null id counts as the text '' in the draw and comes back as null; an
empty table gives an empty table; rows that are equal in id and text travel once (per batch of a reader) with their
number and give as many equal result rows; other columns are ignored. Ids of any type that casts to a string are drawn
by that string.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from veldt.llm.common import parts_for

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = re.compile("<[PSM]>")
#: order of the parts in the original
ORIGINAL = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
UNITS = 4096
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
BATCH = 1000
PART_CHARACTERS = 1 << 26


class Plan(NamedTuple):
    """How one text is rearranged; the character counts are None where it stays plain."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None


def unit_starts(text: str) -> np.ndarray:
    """Where the units of a text begin: runs of A-Z and a-z, and every other character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) | 32
    letter = (codes >= 97) & (codes <= 122)
    inside = letter[1:] & letter[:-1]
    return np.flatnonzero(np.concatenate([[True], ~inside])) if len(codes) else np.zeros(0, np.int64)


def draws(doc_id: str) -> list[int]:
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def arranged(doc_id: str, text: str) -> tuple[Plan, list[tuple[str, np.ndarray]]]:
    """The plan of a text and its parts in output order: the mark before each, and the edges of its units."""
    starts = unit_starts(text)
    n = len(starts)
    edges = np.append(starts, len(text))
    h1, h2, h3, h4 = draws(doc_id)
    if not text or MARKS.search(text) or h3 % 100 >= PLAIN_FROM:
        return Plan(n, "plain", None, None), [("", edges)]
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    parts = {PREFIX: edges[: a + 1], MIDDLE: edges[a : b + 1], SUFFIX: edges[b:]}
    suffix_first = h4 % 100 < SUFFIX_FIRST_BELOW
    order = (SUFFIX, PREFIX, MIDDLE) if suffix_first else (PREFIX, SUFFIX, MIDDLE)
    plan = Plan(n, "spm" if suffix_first else "psm", int(edges[a]), int(edges[b] - edges[a]))
    return plan, [(mark, parts[mark]) for mark in order]


def owner(key: tuple) -> int:
    """The partition of a piece depends on its document alone: the row's hash, the first part of the key."""
    return key[0]


def emitted(rows: Iterable[Row]) -> Iterator[tuple[tuple, tuple]]:
    """The pieces of rows (row, id, text), as ((row, id, place), (number of equal rows, plan or None, text))."""

    def pieces(found: Counter) -> Iterator[tuple[tuple, tuple]]:
        for (row, doc_id, text), many in found.items():
            plan, parts = arranged(doc_id or "", text or "")
            # a null id must sort, so the key holds a pair
            key = (row, (doc_id is not None, doc_id or ""))
            yield (*key, 0), (many, tuple(plan), "")
            place = 0
            for mark, edges in parts:
                if mark:
                    place += 1
                    yield (*key, place), (many, None, mark)
                for at in range(0, len(edges) - 1, UNITS):
                    place += 1
                    yield (*key, place), (many, None, text[edges[at] : edges[min(at + UNITS, len(edges) - 1)]])

    found: Counter = Counter()
    size = 0
    for row in rows:
        found[tuple(row)] += 1
        size += len(row[2] or "")
        if found.total() >= BATCH or size > 1 << 22:
            yield from pieces(found)
            found, size = Counter(), 0
    yield from pieces(found)


def merged(pieces: Iterable[tuple[tuple, tuple]]) -> Iterator[tuple[tuple, int, tuple | None, str]]:
    """Pieces in order, each once, with the number of rows that it stands for."""
    last, total, held = None, 0, None
    for key, (many, plan, text) in pieces:
        if key == last:
            total += many
            continue
        if last is not None:
            yield last, total, *held
        last, total, held = key, many, (plan, text)
    if last is not None:
        yield last, total, *held


def output_order(docs: DataFrame, doc_id: str, text: str) -> RDD:
    """All pieces, in output order within their document, on the document's partition."""
    rows = docs.select(
        F.xxhash64(doc_id, text).alias("row"), F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")
    )
    # a partition is sorted as a whole, so their number follows the characters
    characters = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    parts = parts_for(docs, -(-characters // PART_CHARACTERS))
    return rows.rdd.mapPartitions(emitted).repartitionAndSortWithinPartitions(parts, owner)


def original_order(pieces: RDD, parts: int) -> RDD:
    """The pieces of ``output_order`` keyed by their place in the original, from the marks and the form alone.

    The first piece of a document carries the digest of its output instead of nothing.
    """

    def run(found: Iterable) -> Iterator[tuple[tuple, tuple]]:
        def closed():
            return (*key[:2], (-1, 0)), (many, plan, digest.hexdigest())

        key = plan = None
        for (row, doc, place), number, opened, piece in merged(found):
            if opened is not None:
                if plan is not None:
                    yield closed()
                key, many, plan, digest, section = (row, doc), number, opened, hashlib.sha256(), 0
                continue
            digest.update(piece.encode("utf-8", "surrogatepass"))
            if plan[1] != "plain" and piece in ORIGINAL:
                section = ORIGINAL[piece]
            else:
                yield (row, doc, (section, place)), (1, None, piece)
        if plan is not None:
            yield closed()

    return pieces.mapPartitions(run, preservesPartitioning=True).repartitionAndSortWithinPartitions(parts, owner)


FIELDS = [
    StructField("id", StringType()), StructField("n", LongType()), StructField("form", StringType()),
    StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
]


def with_id_of(found: DataFrame, docs: DataFrame, doc_id: str) -> DataFrame:
    """Column ``id`` as ``doc_id``, with its type in ``docs``."""
    return found.select(F.col("id").cast(docs.schema[doc_id].dataType).alias("doc_id"), *found.columns[1:])


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, and the digests of the output and of
    the text rebuilt from it."""
    pieces = output_order(docs, doc_id, text)

    def run(found: Iterable) -> Iterator[tuple]:
        head = None
        for (_, doc, _), (many, plan, piece) in found:
            if plan is not None:
                if head is not None:
                    yield from [(*head[0], digest.hexdigest())] * head[1]
                head = ((doc[1] if doc[0] else None, *plan, piece), many)
                digest = hashlib.sha256()
            else:
                digest.update(piece.encode("utf-8", "surrogatepass"))
        if head is not None:
            yield from [(*head[0], digest.hexdigest())] * head[1]

    rows = original_order(pieces, pieces.getNumPartitions()).mapPartitions(run)
    schema = StructType([*FIELDS, StructField("output_sha256", StringType()), StructField("restored_sha256", StringType())])
    return with_id_of(docs.sparkSession.createDataFrame(rows, schema, verifySchema=False), docs, doc_id)


def outputs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars and the whole output text."""

    def run(found: Iterable) -> Iterator[tuple]:
        head: tuple | None = None
        for (_, doc, _), many, plan, piece in merged(found):
            if plan is not None:
                if head is not None:
                    yield from [(*head, "".join(out))] * number
                head, number, out = (doc[1] if doc[0] else None, *plan), many, []
            else:
                out.append(piece)
        if head is not None:
            yield from [(*head, "".join(out))] * number

    rows = output_order(docs, doc_id, text).mapPartitions(run)
    schema = StructType([*FIELDS, StructField("output", StringType())])
    return with_id_of(docs.sparkSession.createDataFrame(rows, schema, verifySchema=False), docs, doc_id)
