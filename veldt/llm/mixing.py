"""Language-model scores by online logistic context mixing over corpus counts.

A text is a sequence of words and an end. Each token is coded by binary decisions: was it seen after the word before it
in the training texts; if not, is it a known word; then which of them it is; and if it is unknown, the bits of its bytes.
A word seen after another is named by its place among all that were, the most frequent first; a known word by the
magnitude of its count and its place among the words of that magnitude. A place is a class of five bits and the bits
within the class. Every decision's probability comes from several bit predictors, each a table of outcomes under a
hashed context; a logistic mixer combines them with weights that a gate selects, and an adaptive map refines the result.
The sum of the decisions' costs gives the bits per byte of a text.

Counts of words and of word pairs cover all training texts and grow with them. They are not broadcast: texts are dealt
into blocks, each block asks for its own distinct words and pairs, and gets counts and places back by a shuffle on
hashed keys, as packed arrays. What follows a very frequent word is cut into slices by hash, each in a bucket of its own,
and the slice is named first. A training text never profits from itself: one occurrence is taken off each count, and
places are those without it. Predictor tables, mixer and map are learned online (predict, then update) on all training
texts; each block learns on its own, tables are summed and weights averaged. The pass that learns also stores what
scoring needs of a text, so that texts meet their counts once.

Defined results: a null or empty text is the end token alone; a null id is an id like others; without training texts
every word is unknown; repeated rows give repeated rows; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldt.llm.common import discarded, map_rows, small_batches, written
from veldt.llm.words import U, blocks, mixed, prefix_hashes, span_hashes, word_spans

BLOCK_BYTES = 6 << 20
END = U(0x51ED270B4D2C7A9B)
TABLE_BITS, SPELL_BITS = 16, 18
GATES = 16
STEP = 1 << 14
RATE = 0.02
MAP_BINS = 33
SLICE = 1 << 17
RUN_TOKENS = 1 << 18
LEAST = np.float32(1e-6)
RUN_WORDS = 4_000
RUN_NAMED = 1 << 14
CLASS_BITS = 5
CLASSES = 1 << CLASS_BITS
CELLS = 1 << TABLE_BITS
#: tokens after one hashed word that make a slice
HEAD_TOKENS = 1 << 18
RANK_BITS = 29
RANKS = (1 << RANK_BITS) - 1


def opinion(counts: np.ndarray) -> np.ndarray:
    """The logit of a one, from zeros and ones side by side."""
    return np.log((counts[1::2] + np.float32(0.4)) / (counts[::2] + np.float32(0.4)))


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


@dataclass
class Mixer:
    """Bit predictors over hashed contexts, a gated logistic mixer and an adaptive map."""

    inputs: int
    bits: int
    counts: np.ndarray = field(default=None)
    weights: np.ndarray = field(default=None)
    map_seen: np.ndarray = field(default=None)
    map_ones: np.ndarray = field(default=None)
    said: list[np.ndarray] | None = field(default=None)

    def __post_init__(self):
        if self.counts is None:
            # zeros and ones seen in each context, side by side
            self.counts = np.zeros((self.inputs, 2 << self.bits), np.float32)
            self.weights = np.full((GATES, self.inputs + 1), 0.4, np.float64)
            centre = squash(np.linspace(-8, 8, MAP_BINS))
            self.map_seen = np.full((GATES, MAP_BINS), 20.0)
            self.map_ones = centre[None, :] * self.map_seen

    def stretched(self) -> list[np.ndarray]:
        """What every predictor says in each of its contexts; kept until the next step of learning."""
        if self.said is None:
            self.said = [opinion(n) for n in self.counts]
        return self.said

    def weighed(self, x: list[np.ndarray], gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mixed probability of predictions ``x``, and its place in the map."""
        weights = np.ascontiguousarray(self.weights.T, np.float32)
        dot = np.float32(0.3) * weights[-1][gate]
        for w, v in zip(weights, x, strict=False):
            dot += w.take(gate) * v
        dot = np.clip(dot, -12, 12)
        at = np.rint((np.clip(dot, -8, 8) + 8) * np.float32((MAP_BINS - 1) / 16)).astype(np.int64)
        return 1 / (1 + np.exp(-dot)), at

    def predict(self, contexts: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
        """Probability that each bit is one."""
        out, tables = np.empty(len(gate), np.float32), self.stretched()
        refined = (self.map_ones / self.map_seen).ravel().astype(np.float32)
        for i in range(0, len(gate), STEP):
            part = slice(i, i + STEP)
            g = gate[part]
            p, at = self.weighed([t.take(c[part]) for t, c in zip(tables, contexts, strict=True)], g)
            out[part] = np.clip((p + refined.take(g * MAP_BINS + at)) / 2, LEAST, 1 - LEAST)
        return out

    def learn(self, contexts: list[np.ndarray], gate: np.ndarray, bit: np.ndarray) -> None:
        """Online: each step of bits is predicted first, then weights, map and tables move towards it."""
        one, self.said = np.float32(1), None
        for i in range(0, len(gate), STEP):
            cs, g, b = [c[i : i + STEP] for c in contexts], gate[i : i + STEP], bit[i : i + STEP]
            y = b.astype(np.float32)
            x = [opinion(n.view(np.complex64).take(c).view(np.float32)) for c, n in zip(cs, self.counts, strict=True)]
            p, at = self.weighed(x, g)
            cell = g * MAP_BINS + at
            seen = np.bincount(cell, minlength=GATES * MAP_BINS).reshape(GATES, MAP_BINS)
            rate = RATE / np.sqrt(np.maximum(seen.sum(axis=1), 1))
            off = y - p
            for k, v in enumerate(x):
                self.weights[:, k] += rate * np.bincount(g, off * v, minlength=GATES)
            self.weights[:, -1] += rate * 0.3 * np.bincount(g, off, minlength=GATES)
            self.map_seen += seen
            self.map_ones += np.bincount(cell, y, minlength=GATES * MAP_BINS).reshape(GATES, MAP_BINS)
            for c, n in zip(cs, self.counts, strict=True):
                np.add.at(n, 2 * c + b, one)

    def learnt(self) -> np.ndarray:
        """What was learned, as one array whose sum over blocks does not depend on their order."""
        new = Mixer(self.inputs, self.bits)
        maps = [np.rint(self.map_seen - new.map_seen), np.rint(self.map_ones - new.map_ones)]
        weights = np.rint(self.weights * (1 << 28)) / (1 << 28)
        return np.concatenate([a.ravel() for a in (self.counts, weights, *maps)]).astype("<f4")

    @staticmethod
    def joined(inputs: int, bits: int, total: np.ndarray, count: int) -> Mixer:
        """From the sum of ``learnt`` over ``count`` blocks: tables and maps summed, weights averaged."""
        out = Mixer(inputs, bits)
        if count:
            shapes = [out.counts.shape, out.weights.shape, out.map_seen.shape, out.map_ones.shape]
            pieces = np.split(total, np.cumsum([int(np.prod(s)) for s in shapes])[:-1])
            counts, weights, map_seen, map_ones = (p.reshape(s) for p, s in zip(pieces, shapes, strict=True))
            out.counts = counts.astype(np.float32)
            out.weights, out.map_seen, out.map_ones = weights / count, out.map_seen * count + map_seen, out.map_ones * count + map_ones
        return out


SEEN, KNOWN, SPELL, CLASS, PLACE = (4, TABLE_BITS), (3, TABLE_BITS), (4, SPELL_BITS), (3, TABLE_BITS), (2, TABLE_BITS)
SHAPES = (SEEN, KNOWN, SPELL, CLASS, PLACE)


@dataclass
class Tokens:
    """The tokens of a block: word hashes, context hashes, bytes of words, and the text each belongs to."""

    word: np.ndarray
    before: np.ndarray
    text: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray


def tokens_of(texts: list[str | None]) -> Tokens:
    words, owner, buffers, starts, ends = [], [], [], [], []
    base = first = 0
    for run in blocks(texts):
        data, start, end, at = word_spans(run)
        hashes = span_hashes(prefix_hashes(data), start, end)
        n = np.diff(at)
        place = at[1:]
        words.append(np.insert(hashes, place, END))
        starts.append(np.insert(start, place, 0) + base)
        ends.append(np.insert(end, place, 0) + base)
        owner.append(np.repeat(np.arange(len(run)), n + 1) + first)
        buffers.append(data)
        base += len(data)
        first += len(run)
    word, text = np.concatenate(words), np.concatenate(owner)
    before = np.concatenate([[END], word[:-1]])
    return Tokens(word, before, text, np.concatenate(buffers), np.concatenate(starts), np.concatenate(ends))


def cell_of(words: np.ndarray) -> np.ndarray:
    return (mixed(words + U(1)) & U(CELLS - 1)).astype(np.int64)


def slices_of(rows: DataFrame) -> np.ndarray:
    """Into how many slices each hashed word's followers are cut: one for every ``HEAD_TOKENS`` of them in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(CELLS, np.int64)
        for batch in batches:
            for run in blocks(batch.column("text").to_pylist()):
                data, start, end, _ = word_spans(run)
                often += np.bincount(cell_of(span_hashes(prefix_hashes(data), start, end)), minlength=CELLS)
                often[cell_of(np.array([END]))] += len(run)
        at = np.flatnonzero(often)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(often[at])], names=["cell", "n"])

    small_batches(rows.sparkSession)
    out = np.ones(CELLS, np.int64)
    found = rows.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for r in found.filter(F.col("n") > HEAD_TOKENS).collect():
        out[r["cell"]] = -(-r["n"] // HEAD_TOKENS)
    return out


@dataclass
class Pairs:
    """A block's distinct words, and its distinct pairs by bucket, then by head: the word before and a slice.

    ``heads`` are hashed, ``sizes`` their pairs, ``tails`` the halves of the hashes of the words that follow.
    """

    words: np.ndarray
    word_at: np.ndarray
    pair_at: np.ndarray
    heads: np.ndarray
    sizes: np.ndarray
    tails: np.ndarray
    buckets: np.ndarray


def pairs_of(t: Tokens, slices: np.ndarray, count: int) -> Pairs:
    words, word_at = np.unique(t.word, return_inverse=True)
    before = np.concatenate([[np.searchsorted(words, END)], word_at[:-1]]).astype(np.uint64)
    keys, pair_at = np.unique(before << U(32) | t.word >> U(32), return_inverse=True)
    owner, tails = (keys >> U(32)).astype(np.int64), keys & U(0xFFFFFFFF)
    part = tails * slices[cell_of(words)][owner].astype(np.uint64) >> U(32)
    start = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])]))
    heads = mixed(words[owner[start]] + part[start] * U(0x9E3779B97F4A7C15))
    sizes = np.diff(np.append(start, len(keys)))
    buckets = ((heads >> U(32)) * U(count) >> U(32)).astype(np.int64)
    order = np.argsort(buckets, kind="stable")
    old, sizes = start[order], sizes[order]
    moved = np.repeat(old - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(keys))
    place = np.empty(len(keys), np.int64)
    place[moved] = np.arange(len(keys))
    return Pairs(words, word_at, place[pair_at], heads[order], sizes, tails[moved].astype("<u4"), buckets[order])


REQUEST = "block int, bucket int, kind int, keys binary, counts binary, heads binary, sizes binary"
ANSWER = "block int, bucket int, kind int, counts binary, places binary, more binary, total long, distinct long"
HELD = 1 << 31


def requests(count: int, slices: np.ndarray):
    """A block's distinct words and pairs with their counts in its training texts, cut by bucket of key."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        t = tokens_of(list(group["text"]))
        train = ~group["held_out"].to_numpy(bool)[t.text]
        block, rows = int(group["block"].iloc[0]), []
        p = pairs_of(t, slices, count)
        own = np.bincount(p.word_at, train, minlength=len(p.words)).astype("<u4")
        cuts = np.searchsorted(((p.words >> U(32)) * U(count)) >> U(32), np.arange(count + 1))
        for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if y > x:
                rows.append((block, b, 0, p.words[x:y].tobytes(), own[x:y].tobytes(), b"", b""))
        own = np.bincount(p.pair_at, train, minlength=len(p.tails)).astype("<u4")
        own |= np.where(np.bincount(p.pair_at, ~train, minlength=len(own)) > 0, HELD, 0).astype("<u4")
        cuts, ends = np.searchsorted(p.buckets, np.arange(count + 1)), np.concatenate([[0], np.cumsum(p.sizes)])
        for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if y > x:
                part = slice(ends[x], ends[y])
                rows.append((block, b, 1, p.tails[part].tobytes(), own[part].tobytes(), p.heads[x:y].tobytes(), p.sizes[x:y].astype("<u4").tobytes()))
        return pd.DataFrame(rows, columns=["block", "bucket", "kind", "keys", "counts", "heads", "sizes"])

    return run


def magnitude(counts: np.ndarray) -> np.ndarray:
    """The logarithm to base 2, rounded down, of counts of one or more; 0 for others."""
    return np.frexp(np.maximum(counts, 1).astype(np.float64))[1].astype(np.int64) - 1


def moves(counts: np.ndarray) -> np.ndarray:
    """Counts whose magnitude falls when one is taken off."""
    return (counts > 1) & (counts & (counts - 1) == 0)


def known_places(total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted words: places among those of their magnitude, places one magnitude lower, words per magnitude."""
    size, place, lower = magnitude(total), np.zeros(len(total), "<u4"), np.zeros(len(total), "<u4")
    often, falls = np.zeros(CLASSES, "<i8"), moves(total)
    for k in range(int(size.max(initial=0)) + 1):
        own = np.flatnonzero((size == k) & (total > 0))
        often[k], place[own] = len(own), np.arange(len(own))
        fall = np.flatnonzero(falls & (size == k + 1))
        lower[fall] = np.searchsorted(own, fall)
    return place, lower, often


def packed(rank: np.ndarray, most: np.ndarray, all_of: np.ndarray) -> np.ndarray:
    """A rank from 1, and three bits of how seldom the most frequent follower is."""
    seldom = np.minimum(magnitude(all_of // np.maximum(most, 1)), 7)
    return (seldom << RANK_BITS | np.minimum(rank, RANKS)).astype("<u4")


def follower_ranks(head: np.ndarray, total: np.ndarray, heads: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pairs sorted by head: ranks by falling count, ranks without one occurrence of the pair, both packed and 0 for
    unseen pairs, and the magnitude of each head's number of followers."""
    with_, without = np.zeros(len(total), "<u4"), np.zeros(len(total), "<u4")
    at = np.flatnonzero(total > 0)
    h, c = head[at], total[at].astype(np.int64)
    followers = np.bincount(h, minlength=heads)
    first = np.cumsum(followers) - followers
    order = np.lexsort((-c, h))
    rank = np.empty(len(at), np.int64)
    rank[order] = np.arange(len(at)) - first[h[order]]
    sums = np.bincount(h, c, minlength=heads).astype(np.int64)
    sorted_counts = np.append(c[order], [0, 0])
    top, second = sorted_counts[first], np.where(followers > 1, sorted_counts[np.minimum(first + 1, len(at))], 0)
    with_[at] = packed(rank + 1, top[h], sums[h])
    # places of pairs once their count is one less: between those of other counts, in the order of words among equal ones
    kinds = np.unique(c)
    fall = np.flatnonzero(c > 1)
    near = np.searchsorted(kinds, c[fall] - 1)
    code = lambda i: 2 * (len(kinds) - i)
    width, n = 2 * len(kinds) + 2, len(at) + 1
    places = ((h * width + code(np.searchsorted(kinds, c))) * n + np.arange(len(at)))[order]
    wanted = (h[fall] * width + code(near) + (kinds[near] != c[fall] - 1)) * n + fall
    lower = np.searchsorted(places, wanted) - first[h[fall]] - 1
    most = np.where(rank[fall] == 0, np.maximum(c[fall] - 1, second[h[fall]]), top[h[fall]])
    without[at[fall]] = packed(lower + 1, most, sums[h[fall]] - 1)
    return with_, without, magnitude(followers).astype("u1")


def answers(group: pd.DataFrame) -> pd.DataFrame:
    """Counts over all blocks of the words that each block asked for, places of words and pairs, and totals of words."""
    rows = []
    part = group[group["kind"] == 0]
    if not part.empty:
        lists = [np.frombuffer(k, np.uint64) for k in part["keys"]]
        own = np.concatenate([np.frombuffer(c, "<u4") for c in part["counts"]])
        found, inverse = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.bincount(inverse, own, minlength=len(found)).astype(np.int64)
        place, lower, often = known_places(total)
        at = np.cumsum([0] + [len(x) for x in lists])
        for block, bucket, x, y in zip(part["block"], part["bucket"], at[:-1], at[1:], strict=True):
            i = inverse[x:y]
            rows.append((block, bucket, 0, total[i].astype("<u4").tobytes(), place[i].tobytes(), lower[i][moves(total[i])].tobytes(), 0, 0))
        rows.append((-1, int(part["bucket"].iloc[0]), 0, b"", often.tobytes(), b"", int(total.sum()), int((total > 0).sum())))
    part = group[group["kind"] == 1]
    if not part.empty:
        tails = [np.frombuffer(k, "<u4") for k in part["keys"]]
        asked = [np.frombuffer(c, "<u4") for c in part["counts"]]
        heads, owner = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in part["heads"]]), return_inverse=True)
        sizes = [np.frombuffer(x, "<u4") for x in part["sizes"]]
        head_at = np.cumsum([0] + [len(x) for x in sizes])
        keys = np.repeat(owner, np.concatenate(sizes)).astype(np.uint64) << U(32) | np.concatenate(tails).astype(np.uint64)
        found, inverse = np.unique(keys, return_inverse=True)
        del keys
        total = np.bincount(inverse, np.concatenate(asked) & (HELD - 1), minlength=len(found)).astype(np.int64)
        with_, without, followers = follower_ranks((found >> U(32)).astype(np.int64), total, len(heads))
        at = np.cumsum([0] + [len(x) for x in tails])
        for k, (block, bucket) in enumerate(zip(part["block"], part["bucket"], strict=True)):
            i, own = inverse[at[k] : at[k + 1]], asked[k]
            rows.append((
                block, bucket, 1, with_[i[own >= HELD]].tobytes(), without[i[own & (HELD - 1) > 0]].tobytes(),
                followers[owner[head_at[k] : head_at[k + 1]]].tobytes(), 0, 0,
            ))
    return pd.DataFrame(rows, columns=["block", "bucket", "kind", "counts", "places", "more", "total", "distinct"])


@dataclass
class Corpus:
    """What every block needs of the whole corpus: training tokens and words, words per magnitude with the place of each
    bucket's first, and the slices of hashed words."""

    tokens: int
    words: int
    firsts: np.ndarray
    often: np.ndarray
    slices: np.ndarray

    @cached_property
    def slice_bits(self) -> np.ndarray:
        return bits_for(self.slices)

    @cached_property
    def place_bits(self) -> np.ndarray:
        """For each magnitude; a word that falls into one has a place there too."""
        return bits_for(self.often + 1)


def bits_for(n: np.ndarray) -> np.ndarray:
    """Bits that tell ``n`` things apart."""
    return np.where(n > 1, magnitude(n - 1) + 1, 0)


@dataclass
class Counted:
    """A block's tokens with raw word counts, the counts that its own texts may use, and what names each token."""

    tokens: Tokens
    raw: np.ndarray
    word: np.ndarray
    before: np.ndarray
    train: np.ndarray
    rank: np.ndarray
    followers: np.ndarray
    place: np.ndarray


def counted(texts: list[str | None], held_out: np.ndarray, found: pd.DataFrame, corpus: Corpus) -> Counted:
    t = tokens_of(texts)
    train, count = ~held_out[t.text], corpus.firsts.shape[1]
    p = pairs_of(t, corpus.slices, count)
    found = found.sort_values(["kind", "bucket"])
    read = lambda k, column, kind: np.frombuffer(b"".join(found.loc[found["kind"] == k, column]), kind)
    raw = read(0, "counts", "<u4").astype(np.int64)
    bucket = (((p.words >> U(32)) * U(count)) >> U(32)).astype(np.int64)
    size, place = magnitude(raw), read(0, "places", "<u4").astype(np.int64)
    fall, lower = moves(raw), place.copy()
    lower[fall] = read(0, "more", "<u4")
    place += corpus.firsts[size, bucket]
    lower += corpus.firsts[size - fall, bucket]
    place = np.where(train, lower[p.word_at], place[p.word_at])
    own, held = (np.bincount(p.pair_at, x, minlength=len(p.tails)) > 0 for x in (train, ~train))
    with_, without = np.zeros(len(own), "<u4"), np.zeros(len(own), "<u4")
    with_[held], without[own] = read(1, "counts", "<u4"), read(1, "places", "<u4")
    rank = np.where(train, without[p.pair_at], with_[p.pair_at])
    followers = np.repeat(read(1, "more", "u1"), p.sizes)[p.pair_at]
    raw = raw[p.word_at]
    before = np.concatenate([[0], raw[:-1]])
    before[0] = raw[np.argmax(t.word == END)]
    return Counted(t, raw, raw - train, before - train, train, rank, followers, place)


@dataclass
class Coded:
    """What the decisions of tokens look at: four bits of the word before, the outcomes, a hashed context, the text; what
    is told of the followers (five bits of their number, three of the most frequent), a class and the place in it, and
    the slice."""

    level: np.ndarray
    seen: np.ndarray
    known: np.ndarray
    hashed: np.ndarray
    text: np.ndarray
    about: np.ndarray
    size: np.ndarray
    place: np.ndarray
    part: np.ndarray

    def unknown(self) -> np.ndarray:
        """Places of the words to be spelled; the last token of a text is its end."""
        last = np.concatenate([self.text[1:] != self.text[:-1], [True]])
        return np.flatnonzero(~self.seen & ~self.known & ~last)


def coded(c: Counted, corpus: Corpus) -> Coded:
    level = np.minimum(np.log2(np.maximum(c.before, 0) + 1), GATES - 1).astype(np.int64)
    hashed = cell_of(c.tokens.before)
    rank = (c.rank & RANKS).astype(np.int64)
    seen, known = rank > 0, c.word > 0
    size = np.where(seen, magnitude(rank), np.where(known, magnitude(c.word), 0))
    place = np.where(seen, rank - (1 << size), np.where(known, c.place, 0))
    about = np.where(seen, c.followers.astype(np.int64) << 3 | c.rank >> RANK_BITS, 0)
    part = ((c.tokens.word >> U(32)) * corpus.slices[hashed].astype(np.uint64) >> U(32)).astype(np.int64)
    return Coded(level, seen, known, hashed, c.tokens.text, about, size, place, np.where(seen, part, 0))


def name_bits(seen: np.ndarray, known: np.ndarray, size: np.ndarray, hashed: np.ndarray, corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """How many bits name the slice of each token, and its place within the class."""
    return np.where(seen, corpus.slice_bits[hashed], 0), np.where(seen, size, np.where(known, corpus.place_bits[size], 0))


def tree_bits(value: np.ndarray, count: np.ndarray):
    """The bits of values of ``count`` bits each, highest first: the value's number, depth, node of the tree, and bit."""
    owner = np.repeat(np.arange(len(value)), count)
    depth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    ahead = value[owner] >> (count[owner] - 1 - depth)
    return owner, depth, (1 << depth) | (ahead >> 1), ahead & 1


def cell_for(*parts: np.ndarray) -> np.ndarray:
    """A table cell for each combination of values."""
    out = np.zeros(len(parts[0]), np.uint32)
    for x in parts:
        out = (out + x.astype(np.uint32)) * np.uint32(0x9E3779B1)
        out ^= out >> np.uint32(15)
    return (out * np.uint32(0x85EBCA77) >> np.uint32(32 - TABLE_BITS)).astype(np.int64)


def names(c: Coded, corpus: Corpus, chosen: np.ndarray):
    """The decisions that name the chosen tokens among followers or known words: model, contexts, gates, bits, and the
    number of each decision's token. The slice comes first, then the class, then the place in it."""
    before = np.maximum(chosen - 1, 0)
    fresh = (chosen == 0) | (c.text[before] != c.text[chosen])
    last = np.where(fresh, 0, 1 + c.seen[before] * 2 + c.known[before] + 4 * c.size[before])
    seen, size, hashed = c.seen[chosen], c.size[chosen], c.hashed[chosen]
    slice_bits, place_bits = name_bits(seen, c.known[chosen], size, hashed, corpus)
    owner, depth, node, bit = tree_bits(c.part[chosen], slice_bits)
    yield 4, [cell_for(node, depth), cell_for(hashed[owner], node)], np.minimum(depth, 7), bit, owner

    most = np.where(seen, c.about[chosen] >> 3, np.flatnonzero(corpus.often).max(initial=0))
    left = np.arange(CLASS_BITS - 1, -1, -1)
    tree = (CLASSES | size)[:, None] >> (left + 1)
    unsure = ((2 * tree + 1 << left) - CLASSES) <= most[:, None]  # the other decisions have one outcome only
    owner, depth = np.nonzero(unsure)
    node, bit = tree[unsure], (size[:, None] >> left & 1)[unsure]
    kind, cell = seen[owner], hashed[owner]
    about = np.where(kind, 256 + c.about[chosen][owner], c.level[chosen][owner])
    yield 3, [about * CLASSES + node, cell_for(cell * 2 + kind, node), cell_for(last[owner] * 2 + kind, node)], kind * 8 + depth, bit, owner

    owner, depth, node, bit = tree_bits(c.place[chosen], place_bits)
    kind = size[owner] * 2 + seen[owner] + 1
    shallow = np.where(depth < 12, node, depth)
    yield 4, [cell_for(kind, shallow, depth), cell_for(hashed[owner], kind, node)], 8 + np.minimum(depth, 7), bit, owner


def named(c: Coded) -> Iterator[np.ndarray]:
    """The tokens that are named, not spelled, some at a time."""
    chosen = np.flatnonzero(c.seen | c.known)
    for i in range(0, len(chosen), RUN_NAMED):
        yield chosen[i : i + RUN_NAMED]


def decisions(c: Coded):
    """For every token: the contexts of both decisions, and the gate of the second; ``level`` is that of the first."""
    n = len(c.seen)
    fresh = np.concatenate([[True], c.text[1:] != c.text[:-1]])
    since = np.arange(n) - np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    history, doubts = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, 7):
        inside = since >= k
        history[k:] |= (inside[k:] & c.seen[:-k]).view(np.uint8) << (k - 1)
        doubts[k:] |= (inside[k:] & ~c.known[:-k]).view(np.uint8) << (k - 1)
    history, doubts = history.astype(np.int64), doubts.astype(np.int64)
    begun = np.minimum(since, 3)
    by_seen = [c.level * 64 + history, (c.level * 4 + begun) * 4 + (history & 3), c.hashed, history * 64 + doubts]
    by_known = [doubts * 64 + history, c.hashed, c.level * 4 + begun]
    return by_seen, by_known, np.minimum(history & 15, GATES - 1)


def closed(t: Tokens, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the chosen tokens, each word closed by a space, and the length of each with it."""
    length = t.end[chosen] - t.start[chosen] + 1
    owner = np.repeat(np.arange(len(chosen)), length)
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    place = t.start[chosen][owner] + within
    return np.where(within == length[owner] - 1, 32, t.data[np.minimum(place, len(t.data) - 1)]).astype(np.uint8), length


def speller(data: np.ndarray, length: np.ndarray):
    """For closed words, a function of chosen bytes: contexts, gates, bits and words of their bits, byte by byte."""
    owner = np.repeat(np.arange(len(length), dtype=np.int32), length)
    begun = np.minimum(np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length), 4).astype(np.uint8)
    k = np.arange(8, dtype=np.uint64)

    def run(place: np.ndarray):
        value, within = data[place].astype(np.uint64), begun[place]
        node = ((U(1) << k) | (value[:, None] >> (U(8) - k))) * U(0x9E3779B97F4A7C15)
        contexts, past = [], np.zeros(len(place), np.uint64)
        for back in (1, 2, 3, 4):
            past |= np.where(within >= back, data[np.maximum(place - back, 0)], 0).astype(np.uint64) << U(8 * (back - 1))
            root = mixed(past * U(8) + U(back - 1))
            contexts.append(((root[:, None] + node) >> U(20) & U((1 << SPELL_BITS) - 1)).astype(np.int64).ravel())
        bits = ((value[:, None] >> (U(7) - k)) & U(1)).astype(np.int64).ravel()
        gates = (k.astype(np.int64) + 8 * (within > 2)[:, None]).ravel()
        return contexts, gates, bits, np.repeat(owner[place], 8)

    return run


def runs_of_words(data: np.ndarray, length: np.ndarray):
    """Closed words in runs of ``RUN_WORDS``: the first word of a run, its bytes and lengths."""
    at = np.concatenate([[0], np.cumsum(length)])
    for i in range(0, len(length), RUN_WORDS):
        part = length[i : i + RUN_WORDS]
        yield i, data[at[i] : at[i + len(part)]], part


def learned(c: Coded, corpus: Corpus, train: np.ndarray, data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What the decision models learn from one block's training texts, and a one for the block."""
    models = [Mixer(*s) for s in SHAPES]
    by_seen, by_known, gate = decisions(c)
    models[0].learn([x[train] for x in by_seen], c.level[train], c.seen[train])
    use = train & ~c.seen
    models[1].learn([x[use] for x in by_known], gate[use], c.known[use])
    del by_seen, by_known, gate, use
    for chosen in named(c):
        for k, contexts, gates, bits, _ in names(c, corpus, chosen[train[chosen]]):
            models[k].learn(contexts, gates, bits)
    own = train[c.unknown()]
    data, length = data[np.repeat(own, length)], length[own]
    order = np.arange(len(data), dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    np.random.default_rng(3).shuffle(order)
    spelled = speller(data, length)
    for i in range(0, len(order), STEP):
        contexts, gates, bits, _ = spelled(order[i : i + STEP])
        models[2].learn(contexts, gates, bits)
    return np.concatenate([m.learnt() for m in models] + [np.ones(1, "<f4")])


def sliced(values: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """The entries other than zero, by slice: the gaps between their places in it, and their values."""
    out = []
    for k in range(0, len(values), SLICE):
        part = values[k : k + SLICE]
        at = np.flatnonzero(part)
        if len(at):
            out.append((k // SLICE, np.diff(at, prepend=0).astype("<u4").tobytes(), part[at].tobytes()))
    return out


def added(total: np.ndarray, row) -> np.ndarray:
    total[np.cumsum(np.frombuffer(row[0], "<u4"))] += np.frombuffer(row[1], "<f4")
    return total


def binaries(values: np.ndarray, count: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut into binary values of ``count`` entries each."""
    offsets = np.concatenate([[0], np.cumsum(count * values.itemsize)]).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def bytes_of(value: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of ``bits`` bits each in as many bytes as they need, lowest first, and how many bytes those are."""
    count = (bits + 7) >> 3
    owner = np.repeat(np.arange(len(value)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return (value[owner] >> (8 * within) & 255).astype(np.uint8), count


def values_of(data: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The values that ``bytes_of`` wrote."""
    count = (bits + 7) >> 3
    out, first = np.zeros(len(bits), np.int64), np.cumsum(count) - count
    for k in range(int(count.max(initial=0))):
        own = count > k
        out[own] |= data[first[own] + k].astype(np.int64) << (8 * k)
    return out


DIGEST = (
    "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, n_bytes long, "
    "codes binary, cells binary, abouts binary, classes binary, places binary, spelt binary, slice int, at binary, learnt binary"
)


def digested(corpus: Corpus):
    """A block's texts as the codes of their tokens, one row each, and what its training texts teach, in slices."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        names = ["doc_id", *(f.split()[0] for f in DIGEST.split(", "))]
        held = docs["held_out"].to_numpy().astype(bool)
        order = np.lexsort((held, docs["place"].to_numpy()))
        docs, held, n = docs.take(order), held[order], len(docs)
        c = counted(docs["text"].to_pylist(), held, found.to_pandas(), corpus)
        t, code, train = c.tokens, coded(c, corpus), c.train
        base = np.log10((c.raw + 1) / (corpus.tokens + corpus.words + 1))
        slice_bits, place_bits = name_bits(code.seen, code.known, code.size, code.hashed, corpus)
        told, n_told = bytes_of(code.part << place_bits | code.place, slice_bits + place_bits)
        chosen = code.unknown()
        data, length = closed(t, chosen)
        size = np.bincount(t.text, minlength=n)
        made = {
            "doc_id": docs["doc_id"], "held_out": held, "n_tokens": size,
            "n_known": np.bincount(t.text, c.raw > 0, minlength=n).astype(np.int64), "train_tokens": np.full(n, corpus.tokens),
            "base_score": np.bincount(t.text, base, minlength=n),
            "n_bytes": pc.fill_null(pc.binary_length(docs["text"]), 0).cast(pa.int64()),
            "codes": binaries((code.level | code.seen << 4 | code.known << 5).astype(np.uint8), size),
            "cells": binaries(code.hashed.astype("<u2"), size),
            "abouts": binaries(code.about[code.seen].astype(np.uint8), np.bincount(t.text, code.seen, minlength=n).astype(np.int64)),
            "classes": binaries(code.size[code.seen | code.known].astype(np.uint8), np.bincount(t.text, code.seen | code.known, minlength=n).astype(np.int64)),
            "places": binaries(told, np.bincount(t.text, n_told, minlength=n).astype(np.int64)),
            "spelt": binaries(data, np.bincount(t.text[chosen], length, minlength=n).astype(np.int64)),
        }
        made = pa.table(made)
        del docs, c, t, base, chosen, told, n_told, slice_bits, place_bits
        taught = sliced(learned(code, corpus, train, data, length)) if train.any() else []
        more = {k: pa.array([x[i] for x in taught], y) for i, (k, y) in enumerate([("slice", pa.int32()), ("at", pa.binary()), ("learnt", pa.binary())])}
        more = pa.table(more)
        made = made.select([k for k in names if k in made.column_names])
        return pa.concat_tables([made, more], promote_options="default").select(names)

    return run


def cost_of(p: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Log10 of the probability of each bit."""
    return np.log(np.where(bit, p, 1 - p)).astype(np.float64) * (1 / np.log(10))


def scored(models: list[Mixer], corpus: Corpus, code: Coded, data: np.ndarray) -> np.ndarray:
    """The cost of every token's decisions."""
    by_seen, by_known, gate = decisions(code)
    p = models[0].predict(by_seen, code.level)
    cost = cost_of(p, code.seen)
    left = np.flatnonzero(~code.seen)
    p = models[1].predict([x[left] for x in by_known], gate[left])
    cost[left] += cost_of(p, code.known[left])
    for chosen in named(code):
        for k, contexts, gates, bits, owner in names(code, corpus, chosen):
            p = models[k].predict(contexts, gates)
            cost[chosen] += np.bincount(owner, cost_of(p, bits), minlength=len(chosen))
    chosen = code.unknown()
    length = np.diff(np.flatnonzero(data == 32), prepend=-1)
    for i, part, sizes in runs_of_words(data, length):
        contexts, gates, bits, owner = speller(part, sizes)(np.arange(len(part)))
        p = models[2].predict(contexts, gates)
        cost[chosen[i : i + len(sizes)]] += np.bincount(owner, cost_of(p, bits), minlength=len(sizes))
    return cost


def scorer(models: list[Mixer], corpus: Corpus):
    def texts(codes: list[bytes], cells: list[bytes], abouts: list[bytes], classes: list[bytes], places: list[bytes], spelt: list[bytes]) -> list[float]:
        value = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
        text = np.repeat(np.arange(len(codes)), [len(x) for x in codes])
        hashed = np.frombuffer(b"".join(cells), "<u2").astype(np.int64)
        seen, known = value & 16 > 0, value & 32 > 0
        about, size = np.zeros(len(value), np.int64), np.zeros(len(value), np.int64)
        about[seen], size[seen | known] = np.frombuffer(b"".join(abouts), np.uint8), np.frombuffer(b"".join(classes), np.uint8)
        slice_bits, place_bits = name_bits(seen, known, size, hashed, corpus)
        told = values_of(np.frombuffer(b"".join(places), np.uint8), slice_bits + place_bits)
        code = Coded(value & 15, seen, known, hashed, text, about, size, told & ((1 << place_bits) - 1), told >> place_bits)
        cost = scored(models, corpus, code, np.frombuffer(b"".join(spelt), np.uint8))
        return np.bincount(text, cost, minlength=len(codes)).tolist()

    def make():
        def run(*columns):
            out, first, size = [], 0, 0
            for i, x in enumerate(columns[0]):
                size += len(x)
                if size >= RUN_TOKENS or i == len(columns[0]) - 1:
                    out += texts(*(c[first : i + 1] for c in columns))
                    first, size = i + 1, 0
            return (out,)

        return run

    return make


def joined(digest: DataFrame) -> list[Mixer]:
    """The models that all blocks taught; slices are added up in tasks, then across them."""
    sizes = [len(Mixer(*s).learnt()) for s in SHAPES]
    ends = np.cumsum([*sizes, 1])
    rows = digest.filter("slice IS NOT NULL").select("slice", "at", "learnt").rdd.map(lambda r: (r[0], (r[1], r[2])))
    slices = -(-int(ends[-1]) // SLICE)
    total = np.zeros(slices * SLICE)
    for k, part in rows.aggregateByKey(np.zeros(SLICE), added, np.add, slices).collect():
        total[k * SLICE : (k + 1) * SLICE] = part
    count = int(total[ends[-1] - 1])
    return [Mixer.joined(*s, total[e - n : e], count) for s, n, e in zip(SHAPES, sizes, ends[:-1], strict=True)]


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: str = "held_out") -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the
    model's probability), n_bytes, bits_per_byte. Learns from rows whose ``held_out`` is false."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(held_out).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    place = F.xxhash64("doc_id", "text")
    rows = rows.withColumn("place", place).withColumn("block", F.pmod(place, F.lit(count)).cast("int"))
    slices = slices_of(rows)
    asked = rows.select("block", "text", "held_out").groupBy("block").applyInPandas(requests(count, slices), REQUEST)
    found = written(asked.groupBy("bucket").applyInPandas(answers, ANSWER))
    often, tokens, words = np.zeros((CLASSES, count), np.int64), 0, 0
    for r in found.filter("block = -1").select("bucket", "places", "total", "distinct").collect():
        often[:, r["bucket"]] = np.frombuffer(r["places"], "<i8")
        tokens, words = tokens + r["total"], words + r["distinct"]
    corpus = Corpus(tokens, words, np.cumsum(often, axis=1) - often, often.sum(axis=1), slices)
    counts = found.filter("block >= 0").select("block", "bucket", "kind", "counts", "places", "more")
    digest = rows.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(digested(corpus), f"doc_id {kind}, {DIGEST}")
    digest = written(digest)
    discarded(found)
    texts = digest.filter("slice IS NULL").drop("slice", "at", "learnt")
    inputs = ["codes", "cells", "abouts", "classes", "places", "spelt"]
    corpus = Corpus(tokens, words, corpus.firsts[:, :1], corpus.often, slices)
    out = map_rows(texts, scorer(joined(digest), corpus), inputs, [("score", T.DoubleType())])
    bits = -F.col("score") * float(np.log2(10))
    out = out.withColumn("bits_per_byte", F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
