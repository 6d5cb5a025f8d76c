"""Document fingerprints as homomorphic multiset hashes.

Each paragraph (line) of a text gives a wide vector; a fingerprint is the sum of its paragraphs' vectors, each lane
modulo a power of two. So the order of paragraphs does not matter, equal multisets have equal fingerprints, and
paragraphs are inserted or deleted by adding or subtracting their vectors, without the rest of the text.

The vector has two parts: 32 lanes modulo 2**32, uniform, for equality; and 256 lanes modulo 2**32 that count the
paragraph's byte windows with random signs, for likeness (a lane of any text that a row can hold is far from its
modulus): the inner product of two fingerprints' second parts estimates
how many windows they share.

Defined results: a null text is empty; an empty text is one empty paragraph; two empty texts are alike (1.0). Rows are
ordered by descending id, nulls last, rows with the same id by the hash of their text. A table of one row is its own
neighbour, an empty table gives an empty table, extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from veldt.llm.common import map_rows, parts_for
from veldt.llm.words import U, prefix_hashes, span_hashes

EQUAL_LANES, ALIKE_LANES = 32, 256
GRAM = 12


class Fingerprint:
    """The two lane vectors; supports + and - of paragraph multisets."""

    __slots__ = ("alike", "equal")

    def __init__(self, equal: np.ndarray, alike: np.ndarray):
        self.equal, self.alike = equal, alike

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal + other.equal, self.alike + other.alike)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal - other.equal, self.alike - other.alike)

    def text(self) -> str:
        return base64.b64encode(self.equal.tobytes() + self.alike.tobytes()).decode()

    @staticmethod
    def parse(text: str) -> Fingerprint:
        data = base64.b64decode(text)
        return Fingerprint(np.frombuffer(data[: 4 * EQUAL_LANES], "<u4"), np.frombuffer(data[4 * EQUAL_LANES :], "<u4"))


def of_paragraphs(data: bytes) -> Fingerprint:
    """The sum over the paragraphs of ``data``."""
    paragraphs = data.split(b"\n")
    digests = b"".join([hashlib.shake_128(p).digest(4 * EQUAL_LANES) for p in paragraphs])
    equal = np.frombuffer(digests, "<u4").reshape(-1, EQUAL_LANES).sum(axis=0, dtype=np.uint32)
    x = np.frombuffer(data, np.uint8)
    h = prefix_hashes(x)
    breaks = np.flatnonzero(x == 10)
    first, last = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(x)]])
    short = (last - first < GRAM) & (last > first)
    inside = np.ones(max(0, len(x) - GRAM + 1), dtype=bool)
    for k in range(GRAM):
        at = breaks - k
        inside[at[(at >= 0) & (at < len(inside))]] = False
    start = np.flatnonzero(inside)
    windows = np.concatenate([span_hashes(h, start, start + GRAM), span_hashes(h, first[short], last[short])])
    signs = ((windows >> U(40)) & U(1)).astype(np.float64) * 2 - 1
    counts = np.bincount((windows & U(ALIKE_LANES - 1)).astype(np.int64), signs, minlength=ALIKE_LANES)
    return Fingerprint(equal, counts.astype(np.int64).astype(np.uint32))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """1 for equal fingerprints; otherwise the estimated share of byte windows in common, 0 to 1."""
    if np.array_equal(a.equal, b.equal) and np.array_equal(a.alike, b.alike):
        return 1.0
    x, y = a.alike.view(np.int32).astype(np.float64), b.alike.view(np.int32).astype(np.float64)
    size = x @ x + y @ y
    return float(min(1.0, max(0.0, 2 * (x @ y) / size))) if size else 0.0


def edited(text: str, after: str) -> tuple[str, str, str]:
    """The edited text, and the tails of old and new that differ, from the start of the paragraph of the first change."""
    n = len(text) // 3
    cut = len(text) - n
    start = text.rfind("\n", 0, cut) + 1
    new = text[start:cut] + after[:n]
    return text[:start] + new, text[start:], new


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add each text's fingerprint."""

    def make():
        return lambda texts: ([of_paragraphs((t or "").encode()).text() for t in texts],)

    return map_rows(docs, make, [text], [(name, StringType())])


def next_in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Texts in buckets of neighbouring ids, in order, each bucket followed by the first row of the next (``extra``).

    Only bucket bounds and the greatest id of each bucket reach the driver; texts are shuffled once.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    count = 4 * parts_for(docs)
    bounds = rows.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10 * count)).first()[0] or []
    bounds = sorted(set(bounds))
    at = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(at))
    tops = [(r.bucket, r.top) for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).orderBy(F.desc("bucket")).collect()]
    before = [(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)]
    kind = docs.schema[doc_id].dataType.simpleString()
    tops_df = docs.sparkSession.createDataFrame(before, f"top {kind}, ahead int")
    firsts = rows.join(F.broadcast(tops_df), F.col("doc_id").eqNullSafe(F.col("top")))  # one row per bucket
    firsts = firsts.select("doc_id", "text", F.col("ahead").alias("bucket"), F.lit(1).alias("extra"))
    both = rows.withColumn("extra", F.lit(0)).unionByName(firsts).repartition(parts_for(docs), "bucket")
    order = [F.col("bucket"), F.col("extra"), F.desc_nulls_last("doc_id"), F.xxhash64("text")]
    return both.sortWithinPartitions(*order)


def with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, n_chars, edited_text's sha256, both fingerprints, near_edited, near_next.

    The edited text has its last third replaced by the beginning of the next document. Its fingerprint is the text's,
    less the paragraphs from the first change on, plus the new ones.
    """
    ordered = next_in_order(docs, doc_id, text)
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, names = None, [], None
        for batch in batches:
            names = names or pa.schema([("doc_id", batch.column("doc_id").type), ("n_chars", pa.int64())]
                + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
                + [(c, pa.float64()) for c in ("near_edited", "near_next")])
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if held and held[2] == row["bucket"] and held[3]:
                        continue
                    body = row["text"] or ""
                    print_ = of_paragraphs(body.encode())
                    if held and held[2] == row["bucket"]:
                        i, old, _, _, own = held
                        new, gone, come = edited(old, body)
                        changed = own - of_paragraphs(gone.encode()) + of_paragraphs(come.encode())
                        digest = hashlib.sha256(new.encode()).hexdigest()
                        out.append((i, len(old), digest, own.text(), changed.text(), likeness(own, changed), likeness(own, print_)))
                    held = (row["doc_id"], body, row["bucket"], row["extra"], print_)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), names, strict=True)], schema=names)
                    out = []

    return ordered.mapInArrow(run, schema)
