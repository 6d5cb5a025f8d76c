"""Whitening, fill-in-the-middle and byte-level encoding against brute force and their libraries."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from veldt.llm import byte_bpe, fingerprint, middle, whitening

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# byte-level merges


@pytest.fixture(scope="module")
def merges():
    return byte_bpe.Merges(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(merges):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges.ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(text=st.lists(st.sampled_from(["a", "b", " ", "\n", "é", "漢", "😀", "'s", "1", "१", "՘", "\x1c", "　", ".", "th", "ing", " the", "<|endoftext|>"]), max_size=40).map("".join) | st.text(max_size=60))
def test_ids_equal_the_library(merges, library, text):
    ids = merges.encode(text).tolist()
    assert ids == library.encode_ordinary(text)
    assert merges.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 100_000, "ab" * 30_000, " " * 20_000 + "x", "\n " * 9_000, "abcdefgh" * 9_000, "=" * 50_001])
def test_very_long_pretokens(merges, library, text):
    assert merges.encode(text).tolist() == library.encode_ordinary(text)


def test_short_pretokens_need_no_queue(library, monkeypatch):
    merges = byte_bpe.Merges(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(merges.queue, "push", lambda *pair: pytest.fail("a short pre-token went through the queue"))
    words = [hashlib.sha256(str(i).encode()).hexdigest()[: 1 + i % 32].translate(str.maketrans("0123456789", "ghijklmnop")) for i in range(3000)]
    cuts = {w for word in words for w in (word, f" {word[:31]}", f"{word[:9]}é", word[:5] * 6)}
    merges.learn(cuts)
    for cut in cuts:
        assert np.frombuffer(dict.get(merges, cut), np.intc).tolist() == library._encode_single_piece(cut)


@settings(max_examples=300, deadline=None)
@given(cuts=st.lists(st.text(min_size=1, max_size=40) | st.text("ab the", min_size=1, max_size=33), min_size=1, max_size=30, unique=True))
def test_rows_and_queue_merge_alike(merges, cuts):
    short = [c for c in cuts if len(c.encode()) <= 32]
    rows = [np.frombuffer(ids, np.intc).tolist() for ids in merges.merged_rows([c.encode() for c in short], 32)] if short else []
    assert rows == [merges.merged([c])[0] for c in short]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 70_000), st.integers(0, 50)), max_size=80), st.data())
def test_queue_gives_least_rank_then_leftmost(pairs, data):
    queue, held = byte_bpe.RankQueue(70_001), []
    for pair in pairs:
        queue.push(*pair)
        held.append(pair)
        if data.draw(st.booleans()):
            held.sort()
            assert queue.pop() == held.pop(0)
    for pair in sorted(held):
        assert queue.pop() == pair
    assert not queue.top and not queue.buckets and not any(queue.words)


def test_byte_bpe_edges(edges, nothing, library):
    both = byte_bpe.decode(byte_bpe.encode(edges, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    rows = both.collect()
    assert len(rows) == edges.count() and {"lang", "score", "label"} <= set(both.columns)
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_foreign_ids(spark):
    found = byte_bpe.decode(spark.createDataFrame([([99_999_999, 0],), (None,)], "ids array<int>"), RANKS, public_tokenizers.PATTERN)
    first = {base64.b64decode(line.split()[0]) for line in open(RANKS, "rb") if line.split()[1] == b"0"}.pop()
    assert [bytes(r.decoded) for r in found.collect()] == ["�".encode() + first, b""]


# fill in the middle


def rearranged(doc_id, text):
    """The contract, told plainly."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}", text
    return doc_id, len(units), "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}", text


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def middle_rows():
    parts = ["ab", "C", " ", ".", "é", "漢", "\n", "1", "<P", "word", "😀", "<", ">", "<S>", "M>"]
    rows = [(i, "".join(parts[(i * 7 + k * k * (i + 3)) % (len(parts) if i % 4 == 0 else 13)] for k in range(i % 57))) for i in range(400)]
    rows += [(7001, "x y " * 30_000), (7002, None), (7003, ""), (None, "no id, some text"), (None, None)]
    return rows + [(7004, "the same row again")] * 6 + rows[:4]


def test_middle_against_brute_force(spark, monkeypatch):
    rows = middle_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(((*r[:5], sha(r[5]), sha(r[6])) for r in (rearranged(*x) for x in rows)), key=repr)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    assert sorted(map(tuple, middle.digests(df).collect()), key=repr) == want
    shown = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, sha(r.output)) for r in middle.outputs(df).collect()]
    assert sorted(shown, key=repr) == [w[:6] for w in want]


def test_middle_in_pieces_of_any_size(spark):
    rows = [r for r in middle_rows() if r[1] and len(r[1]) < 500]
    text = {r[0]: rearranged(*r)[5] for r in rows}
    for size in (1, 3):
        old, middle.UNITS = middle.UNITS, size
        try:
            for (doc_id, body) in rows[:60]:
                found = list(middle.emitted([(1, str(doc_id), body)]))
                keys = [k for k, _ in found]
                assert keys == sorted(keys) and "".join(p for _, (_, _, p) in found) == text[doc_id]
        finally:
            middle.UNITS = old


def test_middle_edges(edges, nothing):
    found = middle.digests(edges).collect()
    want = sorted((sha(r[5]), sha(r[6])) for r in (rearranged(x.doc_id, x.text) for x in edges.collect()))
    assert sorted((r.output_sha256, r.restored_sha256) for r in found) == want
    assert middle.digests(nothing).count() == 0
    assert middle.digests(edges.withColumn("doc_id", edges.doc_id.cast("string"))).schema["doc_id"].dataType.simpleString() == "string"


# whitening


def whitened(rows, k=4):
    """The contract by numpy, over rows (id, vector) of one length."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * float(np.float32(c)))) for c in v] for _, v in good])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for (i, _), r in zip(good, x, strict=True):
        out[i] = (n, sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, total, strict=True)), np.abs((r - total / n) @ u / np.sqrt(e)), e / np.trace(cov))
    return out, len(good)


def vectors(n=600):
    rng = np.random.default_rng(5)
    made = rng.normal(size=(n, 7)) @ np.diag([3, 2, 1.4, 1, 0.5, 0.4, 0.2])
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(made)]
    rows += [(9000 + i, rows[5][1]) for i in range(300)]  # a vector that a third of all rows hold
    rows += [(8000, None), (8001, [1.0, None] + [0.0] * 5), (8002, [float("nan")] * 7), (8003, [float("-inf")] * 7), (8004, [])]
    return rows + [(None, rows[7][1])] + rows[:3]


def test_whitening_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = whitening.whiten(df).collect()
    want, many = whitened(rows)
    assert len(found) == 4 * many
    for r in found:
        n, deviation, values, shares = want[r.vec_id]
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert abs(abs(r.whitened) - values[r.component - 1]) < 1e-8
        assert abs(r.explained - shares[r.component - 1]) < 1e-9
        assert r.identity_error < 1e-9
    first = {r.whitened for r in found if r.component == 1 and r.vec_id is not None and (r.vec_id == 5 or r.vec_id >= 9000)}
    assert len({round(v, 9) for v in first}) == 1  # one sign for all rows


def test_whitening_does_not_send_all_blocks_to_one_task(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").repartition(6)
    calls = []
    product = whitening.product
    monkeypatch.setattr(whitening, "product", lambda a, b, splits: calls.append(splits) or product(a, b, splits))
    whitening.whiten(df).count()
    assert calls[0] > 1


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>, n string, whitened string, x int"
    rows = [(1, [1.0, 2.0], "a", "b", 1), (2, [1.0, 2.0], "a", "b", 1), (3, None, None, None, None)]
    found = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert [(r.whitened, r.explained, r.identity_error, int(r.deviation), r.n) for r in found] == [(None, None, None, 0, 1)] * 4
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    mixed = [(i, [float(i), 0.5 * i * i], None, None, None) for i in range(9)] + [(50, [1.0], None, None, None)]
    found = whitening.whiten(spark.createDataFrame(mixed, schema)).collect()
    assert sorted({r.vec_id for r in found}) == list(range(9)) and {r.component for r in found} == {1, 2}


def test_deviation_is_exact_beyond_64_bits():
    x = np.array([[10**9, -(10**9)], [0, 5]], np.int64)
    total = np.array([7 * 10**15, 3], np.int64)
    n = 10**9
    want = [(n * int(r[0]) - int(total[0])) ** 2 + (n * int(r[1]) - int(total[1])) ** 2 for r in x]
    assert [int(d) for d in whitening.deviations(x, n, total)] == want


# fingerprints of long repetitive texts


@pytest.mark.parametrize("n", [3_000, 60_000, 100_000, 400_000])
def test_likeness_of_long_repetitive_texts(n):
    old, new = "a" * n, fingerprint.edited("a" * n, "b" * n)[0]
    prints = [fingerprint.of_paragraphs(t.encode()) for t in (old, new)]
    assert abs(fingerprint.likeness(*prints) - 6 / 7) < 0.02  # 2 * 2/3 / (1 + 4/9 + 1/9)
    assert fingerprint.Fingerprint.parse(prints[1].text()).text() == prints[1].text()


def test_edits_against_plain_strings(spark):
    rows = [(i, f"text {i}\n" * (i % 7) + "é漢" * i) for i in range(40)]
    order = sorted(rows, reverse=True)
    found = {r.doc_id: r for r in fingerprint.with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        n = len(text) // 3
        new = text[: len(text) - n] + after[:n]
        assert found[i].edited_sha256 == sha(new)
        assert found[i].edited_fingerprint == fingerprint.of_paragraphs(new.encode()).text()
        assert found[i].fingerprint == fingerprint.of_paragraphs(text.encode()).text()
