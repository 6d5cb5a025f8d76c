"""Byte-level merges with a rank queue, for pre-tokens of any length.

A text is split by the vocabulary's pattern; each pre-token is merged on its own. The bytes of a pre-token form a linked
list. Every neighbouring pair whose joined bytes are a token waits in the bucket of that token's rank. A hierarchy of
bitmaps has a bit for each bucket that holds something, and a bit above for each word that is not zero, so the least
rank is found by the lowest set bit of a word on each of its two levels. A merge changes two pairs; their old entries stay where they
are and are skipped when they come up. New pre-tokens of a run of texts are merged in one list and one queue. A pre-token of n bytes costs n log n at most, however it merges.
Those of up to 32 bytes, nearly all, are rows of one matrix instead: in each step every row makes its own next merge.

Defined results: a null text counts as empty and has no ids; null ids decode to no bytes; a null id and an id without a
token decode to the replacement character; an empty table gives an empty table; repeated rows give repeated rows; extra columns pass
through, and columns named like an output are replaced.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from pathlib import Path

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from veldt.llm.common import claim, integer_lists, map_rows

CACHED_CUTS = 300_000
CACHED_BYTES = 64
RUN_CHARACTERS = 1 << 18
CUTS_AT_ONCE = 20_000
ROW_BYTES = (12, 32)  # widths of the matrices for short pre-tokens
NO_MERGE = np.iinfo(np.int32).max
WORD = 8
LOW = (1 << WORD) - 1
BIT = [1 << i for i in range(1 << WORD)]
EDGE = "\u0100"  # beyond the 256 bytes
UNASSIGNED, TOP = "\u0378", "\U0010ffff"


def newer_characters() -> str:
    """Letters and numbers of a later Unicode version than the one that the rank files' own library splits by."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    own = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=single, special_tokens={})
    known = set(bytes(own.encode_ordinary(every)).decode())
    return "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if c not in known)


class RankQueue:
    """Positions by rank: least rank first, then leftmost position. An emptied queue can be used again."""

    def __init__(self, ranks: int):
        self.words = [0] * ((ranks >> WORD) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word = rank >> WORD
        self.words[word] |= BIT[rank & LOW]
        self.top |= 1 << word

    def least(self) -> int:
        """The least rank that waits; not to be asked while ``top`` is zero."""
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        return (word << WORD) + (bits & -bits).bit_length() - 1

    def drop(self, rank: int) -> None:
        """The emptied bucket of a rank goes."""
        del self.buckets[rank]
        word = rank >> WORD
        self.words[word] ^= BIT[rank & LOW]
        if not self.words[word]:
            self.top ^= 1 << word

    def pop(self) -> tuple[int, int]:
        """The next (rank, position)."""
        rank = self.least()
        bucket = self.buckets[rank]
        at = heappop(bucket)
        if not bucket:
            self.drop(rank)
        return rank, at


class Merges(dict):
    """A vocabulary of ranks; as a dict it remembers the packed ids of short pre-tokens, in two generations."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        lines = (line.split() for line in Path(path).read_bytes().splitlines())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every byte needs a token of its own")
        self.by_text = {token.decode("latin-1"): rank for token, rank in self.ranks.items()}
        # one entry more, for every id without a token
        self.shown = np.full(max(self.ranks.values()) + 2, b"\xef\xbf\xbd", object)
        for token, rank in self.ranks.items():
            self.shown[rank] = token
        self.filler = len(self.shown) - 1
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        halves = [(self.ranks.get(t[:i]), self.ranks.get(t[i:]), rank) for t, rank in self.ranks.items() for i in range(1, len(t))]
        pairs = np.array(sorted((a * len(self.shown) + b, rank) for a, b, rank in halves if a is not None and b is not None), np.int64).reshape(-1, 2)
        #: neighbours whose joined bytes are a token, in order, and that token's rank; one key more, beyond all others
        self.pair_keys = np.append(pairs[:, 0], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(pairs[:, 1], NO_MERGE).astype(np.int32)
        self.pattern = regex.compile(pattern)
        newer = newer_characters()
        self.plain = dict.fromkeys(map(ord, newer), UNASSIGNED)
        self.later = re.compile(f"[{min(newer, default=TOP)}-{TOP}]")
        self.queue = RankQueue(len(self.shown))

    def cuts(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        if text.isascii() or not self.later.search(text) or self.plain.keys().isdisjoint(map(ord, set(text))):
            return self.pattern.findall(text)
        spans = (m.span() for m in self.pattern.finditer(text.translate(self.plain)))
        return [text[a:b] for a, b in spans]

    def merged(self, cuts: list[str]) -> list[list[int]]:
        """The ids of each pre-token. All stand in one linked list with an edge around each, which no token holds, so
        that a bucket is opened and closed once for the positions of many."""
        data = EDGE.join(["", *(c.encode().decode("latin-1") for c in cuts), ""])
        n, rank_of, queue = len(data), self.by_text.get, self.queue
        push, buckets = queue.push, queue.buckets
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        waiting: list[int | None] = [None] * n  # rank of the pair that starts here
        for at in range(n - 1):
            rank = rank_of(data[at : at + 2])
            if rank is not None:
                waiting[at] = rank
                bucket = buckets.get(rank)
                if bucket is None:
                    push(rank, at)
                else:
                    bucket.append(at)  # positions rise, so the bucket stays a heap
        while queue.top:
            rank = queue.least()
            bucket, lower = buckets[rank], False
            while bucket and not lower:
                at = heappop(bucket)
                if waiting[at] != rank:
                    continue
                middle = after[at]
                start, end = before[at], after[middle]
                after[at], before[end], waiting[middle] = end, at, None
                waiting[at] = made = rank_of(data[at : after[end]])
                if made is not None:
                    push(made, at)
                    lower = made < rank
                waiting[start] = made = rank_of(data[start:end])
                if made is not None:
                    push(made, start)
                    lower = lower or made < rank
            if not bucket:
                queue.drop(rank)
        out, own, at = [], [], 1
        while at < n:
            rank = rank_of(data[at : after[at]])
            if rank is None:
                out.append(own)
                own = []
            else:
                own.append(rank)
            at = after[at]
        return out

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each two neighbours make."""
        keys = left.astype(np.int64) * len(self.shown) + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.int32(NO_MERGE))

    def merged_rows(self, cuts: list[bytes], width: int) -> list[bytes]:
        """The packed ids of each pre-token of at most ``width`` bytes; a row of ids each, filled up on the right."""
        columns, filler = np.arange(width), np.int32(self.filler)
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        data = np.frombuffer(b"".join([c.ljust(width, b"\0") for c in cuts]), np.uint8).reshape(-1, width)
        ids = np.where(columns < sizes[:, None], self.single[data], filler)
        left, own = np.arange(len(cuts)), ids
        ranks = self.joined(own[:, :-1], own[:, 1:])
        while len(left):
            at = ranks.argmin(axis=1)
            made = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            open_ = made < NO_MERGE
            if not open_.all():
                ids[left[~open_]] = own[~open_]
                left, own, ranks, at, made = left[open_], own[open_], ranks[open_], at[open_], made[open_]
            rows, later = np.arange(len(left)), columns > at[:, None]
            own = np.column_stack([np.where(later[:, :-1], own[:, 1:], own[:, :-1]), np.full(len(left), filler)])
            own[rows, at] = made
            ranks = np.column_stack([np.where(later[:, :-2], ranks[:, 1:], ranks[:, :-1]), np.full(len(left), np.int32(NO_MERGE))])
            ranks[rows, at] = self.joined(made, own[rows, at + 1])
            inner = np.flatnonzero(at)
            before = at[inner] - 1
            ranks[inner, before] = self.joined(own[inner, before], made[inner])
        given = ids != filler
        ends = (given.sum(axis=1).cumsum() * ids.itemsize).tolist()
        packed = ids[given].astype(np.intc).tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, cuts: Iterable[str]) -> None:
        """Remember the ids of short pre-tokens, merged together where they are new."""
        new = []
        for cut in cuts:
            if cut not in self and len(cut) <= CACHED_BYTES:
                ids = self.older.pop(cut, None)
                if ids is None:
                    new.append(cut)
                else:
                    self[cut] = ids
        for at in range(0, len(new), CUTS_AT_ONCE):
            rest, least = new[at : at + CUTS_AT_ONCE], 0
            for width in ROW_BYTES:
                part = [c for c in rest if least < len(c.encode()) <= width]
                if part:
                    self.update(zip(part, self.merged_rows([c.encode() for c in part], width), strict=True))
                least = width
            part = [c for c in rest if len(c.encode()) > least]
            if part:
                self.update(zip(part, (array("i", ids).tobytes() for ids in self.merged(part)), strict=True))

    def __missing__(self, cut: str) -> bytes:
        rank = self.ranks.get(cut.encode())
        return array("i", self.merged([cut])[0] if rank is None else [rank]).tobytes()

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; texts are cut in runs of bounded length, a longer text is a run of its own."""
        run, size = [], 0
        for text in texts:
            if run and size + len(text or "") > RUN_CHARACTERS:
                yield from self._encoded(run)
                run, size = [], 0
            run.append(text or "")
            size += len(text or "")
        yield from self._encoded(run)

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self) > CACHED_CUTS:
            # what has not come up since the last time goes
            self.older = dict(self)
            self.clear()
        cuts = [self.cuts(t) for t in texts]
        self.learn(set().union(*cuts))
        for own in cuts:
            yield np.frombuffer(b"".join(map(self.__getitem__, own)), np.intc)

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray | list[int] | None) -> bytes:
        if ids is None or not len(ids):
            return b""
        ids, unknown = np.asarray(ids), len(self.shown) - 1
        return b"".join(self.shown[np.where((ids < 0) | (ids > unknown), unknown, ids)].tolist())


@lru_cache(maxsize=1)
def vocabulary(path: str, pattern: str) -> Merges:
    """One vocabulary for a Python worker; what it remembers is bounded and serves the tasks that follow."""
    return Merges(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the text's token ids by the rank file at ``path``, an array of integers."""

    def make():
        claim(__name__, vocabulary.cache_clear)
        merges = vocabulary(path, pattern)
        return lambda texts: (list(merges.encode_all(texts)),)

    return map_rows(df, make, [text], [(ids, ArrayType(IntegerType()))], chunk=128)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes that the ids stand for."""

    def make():
        claim(__name__, vocabulary.cache_clear)
        merges = vocabulary(path, pattern)
        return lambda lists: ([merges.decode(i) for i in lists],)

    return map_rows(df, make, [ids], [(decoded, BinaryType())], chunk=128, read=integer_lists)
