"""Subword encoding and decoding with a merge table of scored pieces.

Encoding never replays merges over a text. A text is cut where a word-start mark follows another character (no piece
crosses such a place, which is checked when the vocabulary is read). In each cut, the last token of every prefix is
unique: among the pieces that an automaton finds ending there, it is the one that can stand after the last token of
the prefix before it. Two tokens can stand side by side if merging their joined characters gives them back. The
tokens are then read off backwards.

Defined results: a null text counts as empty and encodes to the begin and end ids only; null ids decode to ''.
Characters without a piece become their bytes. Extra columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType
from sentencepiece import SentencePieceProcessor

from veldt.llm.common import claim, map_rows

MARK = "▁"
CUT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
TAIL = re.compile(r"(.*\w)(\W+)", re.DOTALL)
#: entries of a generation of remembered cuts and pairs; when one is full it becomes the old one, and that goes
CACHED_CUTS = 150_000
CACHED_PAIRS = 250_000


class Pieces:
    """The vocabulary of a model file: piece ids, merge ranks, byte ids, begin and end ids."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.shown: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.shown.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.shown.append(b"")
            elif model.is_unknown(i):
                self.shown.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.rank[piece] = -model.get_score(i)
                self.shown.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses a word start; this vocabulary cannot be cut there")
        #: neighbouring characters inside pieces; a text can be cut between any others
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.old_pairs: dict[tuple[str, str], bool] = {}
        self.cuts: dict[str, bytes] = {}
        self.old_cuts: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Best-ranked, then leftmost merge first, for the few characters of a pair test."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def side_by_side(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            known = self.old_pairs.get((left, right))
            if known is None:
                known = self.merged(left + right) == ([left, right] if left else [right])
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs, self.old_pairs = {}, self.pairs
            self.pairs[left, right] = known
        return known

    def tokens(self, cut: str) -> list[str]:
        """The tokens of one cut, from the unique last token of each of its prefixes."""
        ending: list[list[str]] = [[] for _ in range(len(cut) + 1)]
        for at, piece in self.automaton.iter(cut):
            ending[at + 1].append(piece)
        last = [""] * (len(cut) + 1)
        for end in range(1, len(cut) + 1):
            for piece in ending[end]:
                before = last[end - len(piece)]
                if before or end == len(piece):
                    known = self.pairs.get((before, piece))
                    if known or known is None and self.side_by_side(before, piece):
                        last[end] = piece
                        break
            else:
                last[end] = cut[end - 1]
        out, end = [], len(cut)
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def packed(self, cut: str) -> bytes:
        """Ids of one cut; a short one is remembered, and so is its stem without closing punctuation."""
        ids = self.cuts.get(cut)
        if ids is not None:
            return ids
        ids = self.old_cuts.get(cut)
        if ids is not None:
            return self.remembered(cut, ids)
        tail = TAIL.fullmatch(cut)
        if tail and tail[1][-1] + tail[2][0] not in self.joined:
            ids = self.packed(tail[1]) + self.packed(tail[2])
        else:
            found: list[int] = []
            for token in self.tokens(cut):
                known = self.ids.get(token)
                if known is None:
                    found.extend(self.byte_ids[b] for b in token.encode())
                else:
                    found.append(known)
            ids = np.array(found, "<u4").tobytes()
        return self.remembered(cut, ids) if len(cut) <= 64 else ids

    def remembered(self, cut: str, ids: bytes) -> bytes:
        if len(self.cuts) >= CACHED_CUTS:
            self.cuts, self.old_cuts = {}, self.cuts
        self.cuts[cut] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """All ids of a text, as little-endian unsigned 32-bit integers."""
        out = [np.array([self.begin], "<u4").tobytes()]
        for cut in CUT.findall(MARK + text.replace(" ", MARK)) if text else ():
            out.append(self.cuts.get(cut) or self.packed(cut))
        out.append(np.array([self.end], "<u4").tobytes())
        return b"".join(out)

    def decode(self, ids: bytes | None) -> str:
        """The text of packed ids; the space that encoding puts in front is taken away again."""
        shown = b"".join(map(self.shown.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
        return shown[shown[:1] == b" " :].decode(errors="replace")


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Pieces:
    """One vocabulary for a Python worker; its caches are bounded and serve the tasks that follow."""
    return Pieces(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the text's token ids with begin and end id, packed (see ``unpacked``)."""

    def make():
        claim(__name__, vocabulary.cache_clear)
        pieces = vocabulary(path)
        return lambda texts: ([pieces.encode(t) for t in texts],)

    return map_rows(df, make, [text], [(ids, BinaryType())])


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: what the packed ids stand for."""

    def make():
        claim(__name__, vocabulary.cache_clear)
        pieces = vocabulary(path)
        return lambda packed: ([pieces.decode(p) for p in packed],)

    return map_rows(df, make, [ids], [(text, StringType())])


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def unpacked(df: DataFrame, ids: str = "ids", name: str = "id_list") -> DataFrame:
    """Add the packed ids as an array of integers."""
    from pyspark.sql.types import ArrayType, LongType

    def make():
        return lambda packed: ([np.frombuffer(p or b"", "<u4").tolist() for p in packed],)

    return map_rows(df, make, [ids], [(name, ArrayType(LongType()))])
