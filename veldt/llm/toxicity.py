"""Severity grades by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = 1 / (1 + exp(s - t_k)): one score s = w.x for all thresholds t_0 < t_1 < ..., so the weights are shared.
Features are the distinct words of a text and the beginnings of its words, hashed; an L1 penalty chooses few of them, whose
weights are then fitted again under a light one. The fit uses at most ``MAX_ROWS`` labelled rows (those with the least hash of their id); scoring covers every whole text.

Defined results: a null or wordless text has no features and gets the grade shares that the thresholds alone imply;
rows without a grade are not learned from; where a text has several grades, the highest counts; with no labelled rows
every text has grade 0; with grade 0 only, too. Extra columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType

from veldt.llm.common import map_rows

MAX_ROWS = 10_000
BUCKETS = 1 << 22
BEGINNINGS = (3, 4, 5, 6)
LEAST_TEXTS = 5
PENALTY, LIGHT_PENALTY = 2.0, 0.1
STEPS = 150
WORD = re.compile(r"[^\W\d_]+")
#: words of a generation that a task remembers; when one is full it becomes the old one, and that goes
KNOWN_WORDS = 100_000


def features_of(word: str) -> list[int]:
    """Buckets of one lower-case word: itself and its beginnings."""
    names = [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) >= n)]
    return [zlib.crc32(x.encode()) % BUCKETS for x in names]


@dataclass
class Severity:
    """Weights by bucket and the ordered thresholds."""

    weights: dict[int, float]
    thresholds: list[float]

    def grades(self, score: np.ndarray) -> np.ndarray:
        """A row of grade probabilities for each score."""
        below = 1 / (1 + np.exp(np.clip(score[:, None] - np.array(self.thresholds)[None, :], -500, 500)))
        ends = np.hstack([np.zeros((len(score), 1)), below, np.ones((len(score), 1))])
        return np.diff(ends, axis=1)


def fit_rows(sizes: np.ndarray, buckets: np.ndarray, grades: np.ndarray) -> Severity:
    """Fit texts given as runs of feature buckets; proximal gradient steps with a rate for each weight."""
    levels = int(grades.max(initial=0))
    if levels == 0:
        return Severity({}, [])
    often = np.bincount(buckets, minlength=BUCKETS) >= LEAST_TEXTS
    number = (np.cumsum(often) - 1).astype(np.int32)
    inside = often[buckets]
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[inside]
    column, used = number[buckets[inside]], np.flatnonzero(often)
    del number, often, inside
    share = np.clip([np.mean(grades <= k) for k in range(levels)], 1e-4, 1 - 1e-4)
    first = np.log(share / (1 - share))
    t0, gaps = first[0], np.log(np.maximum(np.diff(first), 1e-3))
    w = np.zeros(len(used))
    pick = np.arange(len(grades))
    for penalty in (PENALTY, LIGHT_PENALTY):
        if penalty == LIGHT_PENALTY:
            chosen = w != 0
            number = np.cumsum(chosen) - 1
            inside = chosen[column]
            row, column, used, w = row[inside], number[column[inside]], used[chosen], w[chosen]
        seen, seen_t = np.full(len(used), 1e-8), np.full(levels, 1e-8)
        for _ in range(STEPS):
            t = t0 + np.concatenate([[0], np.cumsum(np.exp(gaps))])
            score = np.bincount(row, w[column], minlength=len(sizes))
            below = 1 / (1 + np.exp(np.clip(score[:, None] - t[None, :], -500, 500)))
            ends = np.hstack([np.zeros((len(score), 1)), below, np.ones((len(score), 1))])
            upper, lower = ends[pick, grades + 1], ends[pick, grades]
            p = np.maximum(upper - lower, 1e-12)
            slope = np.bincount(column, (1 - upper - lower)[row], minlength=len(used))
            by_t = np.zeros(levels + 2)
            np.add.at(by_t, grades + 1, -upper * (1 - upper) / p)
            np.add.at(by_t, grades, lower * (1 - lower) / p)
            tail = np.cumsum(by_t[1:-1][::-1])[::-1]
            by_param = np.concatenate([tail[:1], tail[1:] * np.exp(gaps)])
            seen += slope**2
            seen_t += by_param**2
            rate = 0.5 / np.sqrt(seen)
            w = w - rate * slope
            w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
            step = 0.2 * by_param / np.sqrt(seen_t)
            t0, gaps = t0 - step[0], gaps - step[1:]
    t = t0 + np.concatenate([[0], np.cumsum(np.exp(gaps))])
    kept = np.flatnonzero(w)
    return Severity(dict(zip(used[kept].tolist(), w[kept].tolist(), strict=True)), t.tolist())


def sampled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, grade: str, max_rows: int) -> tuple:
    """Feature runs and grades of at most ``max_rows`` labelled texts."""
    graded = labels.filter(F.col(grade).isNotNull() & F.col(doc_id).isNotNull())
    graded = graded.groupBy(F.col(doc_id).alias("_id")).agg(F.max(grade).cast("int").alias("_grade"))
    chosen = F.broadcast(graded.orderBy(F.xxhash64("_id"), "_id").limit(max_rows))  # bounded by max_rows
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(chosen, "_id").select("_grade", "_text")

    def make():
        def run(texts):
            out = []
            for t in texts:
                found: set[int] = set()
                for word in set(WORD.findall((t or "").lower())):
                    found.update(features_of(word))
                out.append(sorted(found))
            return (out,)

        return run

    table = map_rows(rows, make, ["_text"], [("_features", ArrayType(IntegerType()))], chunk=128).drop("_text").toArrow()
    lists = table.column("_features").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    return sizes, lists.values.to_numpy(), table.column("_grade").to_numpy().astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "grade",
        max_rows: int = MAX_ROWS) -> Severity:
    """Fit grades 0, 1, 2, ... given in ``labels`` to the texts of ``docs``."""
    return fit_rows(*sampled(docs, labels, doc_id, text, grade, max_rows))


def fit_from_flags(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", flag: str = "toxic",
                   max_rows: int = MAX_ROWS) -> Severity:
    """Fit grades where only a flag is given: 0 for clean, 1 and 2 for flagged texts.

    A first fit to the flag finds the telling features. Flagged texts with at least the median number of them are
    grade 2, the others grade 1; the second fit has both thresholds.
    """
    sizes, buckets, flags = sampled(docs, labels, doc_id, text, flag, max_rows)
    model = fit_rows(sizes, buckets, flags)
    if not model.weights:
        return model
    telling = np.zeros(BUCKETS, bool)
    telling[[b for b, w in model.weights.items() if w > 0]] = True
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    found = np.bincount(row[telling[buckets]], minlength=len(sizes))
    del row
    middle = np.median(found[flags > 0])
    grades = np.where(flags > 0, 1 + (found > middle), 0)
    return fit_rows(sizes, buckets, grades)


def severity(docs: DataFrame, model: Severity, text: str = "text") -> DataFrame:
    """Add grade (most likely), p_toxic (grade 1 or more), expected_severity and score to every row."""

    def make():
        weights = model.weights
        known: dict[str, tuple[int, ...]] = {}
        old: dict[str, tuple[int, ...]] = {}

        def run(texts):
            nonlocal known, old
            scores = np.zeros(len(texts))
            for i, t in enumerate(texts):
                found: set[int] = set()
                for word in set(WORD.findall((t or "").lower())):
                    telling = known.get(word)
                    if telling is None:
                        telling = old.get(word)
                        if telling is None:
                            telling = tuple(f for f in features_of(word) if f in weights)
                        if len(known) >= KNOWN_WORDS:
                            known, old = {}, known
                        known[word] = telling
                    if telling:
                        found.update(telling)
                scores[i] = sum(weights[f] for f in found)
            p = model.grades(scores)
            return p.argmax(axis=1).tolist(), (1 - p[:, 0]).tolist(), (p @ np.arange(p.shape[1])).tolist(), scores.tolist()

        return run

    outputs = [("grade", LongType()), ("p_toxic", DoubleType()), ("expected_severity", DoubleType()), ("score", DoubleType())]
    return map_rows(docs, make, [text], outputs)
