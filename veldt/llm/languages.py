"""Language of words and texts by a linear-chain conditional random field.

Every word (run of letters) gets a label. Its features are beginnings and endings, letter trigrams and the lexicons of
words that the training texts of one language use; transitions between labels are learned with them, on sequences that
splice pieces of texts of different languages, as in code-switched text. Forward-backward gives the probability of
each label of each word; a text's language is the label with the largest share. Long chains are cut into segments:
the product of each segment's transfer matrices gives the messages at its borders, so no step is left out.

The fit uses about ``MAX_TEXTS`` texts of each language (those with the least hash of their id) and at most
``TEXT_WORDS`` words of each; labelling covers every whole text.

Defined results: a null text and one without a letter is ``und`` with score 0; rows without a language are not learned
from; without any, every text is ``und``. Equal shares go to the label that sorts first. Extra columns pass through;
columns named like an output are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from veldt.llm.common import map_rows

MAX_TEXTS, TEXT_WORDS = 500, 200
BUCKETS = 1 << 16
SEQUENCES, SEQUENCE_WORDS, EPOCHS, BATCH = 4000, 48, 4, 200
SEGMENT = 96
KNOWN_WORDS = 300_000
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def words_in(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


@dataclass
class ChainModel:
    """Labels, feature weights (bucket x label), transition scores (from x to), and the lexicons."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)

    def features(self, word: str) -> list[int]:
        padded = f"^{word}$"
        names = [f"t{padded[i : i + 3]}" for i in range(len(padded) - 2)]
        for n in (1, 2, 3):
            names += [f"b{word[:n]}", f"e{word[-n:]}"]
        known = self.lexicon.get(word)
        if known is not None:
            names.append(f"l{known}")
        return [zlib.crc32(x.encode()) % BUCKETS for x in names]


def transfer(emit: np.ndarray, moves: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Scaled product of the transfer matrices of each segment."""
    labels = moves.shape[0]
    out = np.broadcast_to(np.eye(labels), (len(at), labels, labels)).copy()
    for t in range(int(length.max())):
        live = np.flatnonzero(length > t)
        step = out[live] @ moves * emit[at[live] + t][:, None, :]
        out[live] = step / step.sum(axis=(1, 2), keepdims=True)
    return out


def posteriors(emit: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of several chains; ``emit`` and ``moves`` are exponentials of scores,
    ``starts`` holds where each chain begins (one entry more)."""
    labels = moves.shape[0]
    lengths = np.diff(starts)
    parts = -(-lengths // SEGMENT)
    chain = np.repeat(np.arange(len(lengths)), parts)
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    at = starts[:-1][chain] + number * SEGMENT
    length = np.minimum(SEGMENT, starts[1:][chain] - at)
    first = np.cumsum(parts) - parts
    ahead = np.full((len(at), labels), 1 / labels)
    behind = np.full((len(at), labels), 1 / labels)
    if parts.max(initial=0) > 1:
        matrix = transfer(emit, moves, at, length)
        for k in range(1, int(parts.max())):
            live = first[parts > k] + k
            x = (ahead[live - 1][:, None, :] @ matrix[live - 1])[:, 0]
            ahead[live] = x / x.sum(axis=1, keepdims=True)
        for k in range(1, int(parts.max())):
            live = (first + parts - 1)[parts > k] - k
            x = (matrix[live + 1] @ behind[live + 1][:, :, None])[:, :, 0]
            behind[live] = x / x.sum(axis=1, keepdims=True)
    forward = np.empty_like(emit)
    x = ahead.copy()
    opening = number == 0
    for t in range(int(length.max(initial=0))):
        live = np.flatnonzero(length > t)
        y = x[live] @ moves
        if t == 0:
            y[opening[live]] = 1 / labels
        y = y * emit[at[live] + t]
        x[live] = forward[at[live] + t] = y / y.sum(axis=1, keepdims=True)
    x = behind.copy()
    for t in range(int(length.max(initial=0)) - 1, -1, -1):
        live = np.flatnonzero(length > t)
        here = at[live] + t
        y = forward[here] * x[live]
        y /= y.sum(axis=1, keepdims=True)
        back = (emit[here] * x[live]) @ moves.T
        x[live] = back / back.sum(axis=1, keepdims=True)
        forward[here] = y
    return forward


def fit_words(texts: list[list[str]], langs: list[str]) -> ChainModel:
    """Fit to the words of labelled texts."""
    labels = sorted(set(langs))
    count = len(labels)
    model = ChainModel(labels, np.zeros((BUCKETS, count)), np.zeros((count, count)))
    if count < 2:
        return model
    by_word: dict[str, Counter] = {}
    for words, lang in zip(texts, langs, strict=True):
        for w in words:
            by_word.setdefault(w, Counter())[lang] += 1
    for w, c in by_word.items():
        lang, most = c.most_common(1)[0]
        if most >= 5 and most >= 0.8 * c.total():
            model.lexicon[w] = labels.index(lang)
    rng = np.random.default_rng(7)
    pool = [[t for t, x in zip(texts, langs, strict=True) if x == lang and t] for lang in labels]
    pool_labels = [i for i, p in enumerate(pool) if p]
    cache: dict[str, list[int]] = {}
    sequences = []
    for _ in range(SEQUENCES):
        words, truth = [], []
        while len(words) < SEQUENCE_WORDS:
            label = pool_labels[rng.integers(len(pool_labels))]
            text = pool[label][rng.integers(len(pool[label]))]
            n, start = int(rng.integers(4, SEQUENCE_WORDS)), int(rng.integers(len(text)))
            piece = text[start : start + n][: SEQUENCE_WORDS - len(words)]
            words += piece
            truth += [label] * len(piece)
        sequences.append((words, truth))
    seen, seen_moves = np.full_like(model.weights, 1e-6), np.full_like(model.moves, 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(sequences))
        for b in range(0, len(order), BATCH):
            chosen = [sequences[i] for i in order[b : b + BATCH]]
            lists = []
            for words, _ in chosen:
                for w in words:
                    f = cache.get(w)
                    if f is None:
                        f = cache[w] = model.features(w)
                    lists.append(f)
            truth = np.array([t for _, ts in chosen for t in ts])
            sizes = np.fromiter(map(len, lists), int, len(lists))
            flat = np.fromiter((f for fs in lists for f in fs), int, sizes.sum())
            row = np.repeat(np.arange(len(lists)), sizes)
            emit = np.exp(np.add.reduceat(model.weights[flat], np.cumsum(sizes) - sizes))
            moves = np.exp(model.moves)
            starts = np.arange(len(chosen) + 1) * SEQUENCE_WORDS
            p = posteriors(emit, moves, starts)
            slope = p.copy()
            slope[np.arange(len(truth)), truth] -= 1
            inner = np.setdiff1d(np.arange(len(truth)), starts)
            # expected moves: pair posteriors from the neighbours' messages
            pair = pair_posteriors(emit, moves, starts)
            by_move = pair.sum(axis=0)
            np.add.at(by_move, (truth[inner - 1], truth[inner]), -1)
            grad = np.column_stack([np.bincount(flat, slope[row, k], minlength=BUCKETS) for k in range(count)])
            grad += 1e-3 * model.weights
            seen += grad**2
            model.weights -= 0.3 * grad / np.sqrt(seen)
            seen_moves += by_move**2
            model.moves -= 0.3 * by_move / np.sqrt(seen_moves)
    return model


def pair_posteriors(emit: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """P(label of word i-1, label of word i) for the inner words of chains of equal length."""
    chains, length, labels = len(starts) - 1, int(starts[1] - starts[0]), moves.shape[0]
    e = emit.reshape(chains, length, labels)
    forward, backward = np.empty_like(e), np.empty_like(e)
    x = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    forward[:, 0] = x
    for t in range(1, length):
        x = (x @ moves) * e[:, t]
        x /= x.sum(axis=1, keepdims=True)
        forward[:, t] = x
    x = np.full((chains, labels), 1 / labels)
    backward[:, -1] = x
    for t in range(length - 2, -1, -1):
        x = (e[:, t + 1] * x) @ moves.T
        x /= x.sum(axis=1, keepdims=True)
        backward[:, t] = x
    pair = forward[:, :-1, :, None] * moves * (e[:, 1:] * backward[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return pair.reshape(-1, labels, labels)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> ChainModel:
    """Fit to a bounded sample of labelled documents."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    place = F.pmod(F.xxhash64(F.lit("languages"), doc_id), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.lit(False)
    for value, n in counts.items():
        chosen = chosen | ((F.col(lang) == value) & (place < MAX_TEXTS / n))
    rows = rows.filter(chosen).select(F.col(lang).alias("_lang"), F.col(text).alias("_text"), place.alias("_place"))

    def make():
        def run(texts):
            out = []
            for t in texts:
                words = words_in(t)
                start = max(0, (len(words) - TEXT_WORDS) // 2)
                out.append(words[start : start + TEXT_WORDS])
            return (out,)

        return run

    table = map_rows(rows, make, ["_text"], [("_words", ArrayType(StringType()))]).drop("_text").toPandas()
    table = table.sort_values(["_place", "_lang"], kind="stable")
    return fit_words([list(w) for w in table["_words"]], list(table["_lang"]))


RUNS = ArrayType(StructType([StructField("lang", StringType()), StructField("words", LongType())]))


def label(docs: DataFrame, model: ChainModel, text: str = "text") -> DataFrame:
    """Add lang_pred, score and lang_runs (languages of consecutive words, in order) to every row."""

    def make():
        labels, count = model.labels, len(model.labels)
        moves = np.exp(model.moves)
        known: dict[str, int] = {}
        scores = np.zeros((1024, max(1, count)))

        def numbers(words: list[str]) -> list[int]:
            nonlocal scores
            new = list(dict.fromkeys(w for w in words if w not in known))
            if new:
                lists = [model.features(w) for w in new]
                sizes = np.fromiter(map(len, lists), int, len(lists))
                flat = np.fromiter((f for fs in lists for f in fs), int, sizes.sum())
                found = np.add.reduceat(model.weights[flat], np.cumsum(sizes) - sizes)
                while len(known) + len(new) > len(scores):
                    scores = np.concatenate([scores, np.zeros_like(scores)])
                scores[len(known) : len(known) + len(new)] = found
                for w in new:
                    known[w] = len(known)
            return [known[w] for w in words]

        def run(texts):
            if len(known) > KNOWN_WORDS:
                known.clear()
            chains = [words_in(t) for t in texts]
            sizes = np.array([len(c) for c in chains], dtype=np.int64)
            preds, shares, runs = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
            if count == 0 or sizes.sum() == 0:
                return preds, shares, runs
            flat = np.array(numbers([w for c in chains for w in c]), dtype=np.int64)
            emit = scores[flat]
            emit = np.exp(emit - emit.max(axis=1, keepdims=True)) + 1e-12
            full = np.flatnonzero(sizes)
            starts = np.concatenate([[0], np.cumsum(sizes[full])])
            p = posteriors(emit, moves, starts)
            share = np.add.reduceat(p, starts[:-1]) / sizes[full][:, None]
            best = p.argmax(axis=1)
            for i, a, b, s in zip(full.tolist(), starts[:-1].tolist(), starts[1:].tolist(), share, strict=True):
                preds[i] = labels[int(s.argmax())]
                shares[i] = float(min(1.0, s.max()))
                cuts = np.concatenate([[a], np.flatnonzero(np.diff(best[a:b])) + a + 1, [b]])
                runs[i] = [{"lang": labels[best[x]], "words": int(y - x)} for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            return preds, shares, runs

        return run

    return map_rows(docs, make, [text], [("lang_pred", StringType()), ("score", DoubleType()), ("lang_runs", RUNS)], chunk=256)
