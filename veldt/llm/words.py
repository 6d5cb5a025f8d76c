"""Words of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
MIX_A, MIX_B = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
BLOCK_BYTES = 1 << 18
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64; kept for the next call."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + (1 << 18))
        both = [np.full(size, b, dtype=U) for b in (BASE, BASE_INVERSE)]
        for p in both:
            p[0] = 1
            np.cumprod(p, out=p)
        _powers[:] = both
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """h with one entry more than ``data``; ``span_hashes`` reads any substring's hash from it."""
    h = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * powers(len(data))[0], out=h[1:])
    return h


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((h[end] - h[start]) * powers(len(h))[1][start])


def blocks(texts: list[str | None]) -> Iterator[list[bytes]]:
    """The texts as UTF-8, in runs of about a quarter of a megabyte; a longer text is a run of its own."""
    out: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if out and size + len(data) > BLOCK_BYTES:
            yield out
            out, size = [], 0
        out.append(data)
        size += len(data) + 1
    if out:
        yield out


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A run of texts as one buffer with A-Z lowered, where its words start and end, and where each text's words begin
    (one entry more)."""
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    texts_at = np.cumsum([0] + [len(t) + 1 for t in texts])
    return data, start, end, np.searchsorted(start, texts_at)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a run of texts, and where each text's words begin (one entry more)."""
    data, start, end, at = word_spans(texts)
    return span_hashes(prefix_hashes(data), start, end), at


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the whole sequence is one where it has fewer words, none is none."""
    words, at = word_hashes(texts)
    weights = mixed(np.arange(1, size + 1, dtype=U))
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, dtype=U)
    for j in range(size):
        rolled += words[j : j + n] * weights[j]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            out.append(mixed((words[a:b] * weights[: b - a]).sum(keepdims=True) + U(b - a)))
        else:
            out.append(np.zeros(0, dtype=U))
    return out
