"""Operators that compare texts with each other, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from veldt.llm import contamination, minhash, mixing, repeats
from veldt.llm.words import prefix_hashes, span_hashes

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split((text or "").translate(LOWER)) if w]


def corpus(spark, seed, n=120):
    """Random texts with exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "Stu", "é") for b in ("x", "yy", "zzz", "q", "漢")]
    make = lambda k: " ".join(rng.choices(vocabulary, k=k))
    passage, texts = make(60), []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.5 or not texts:
            texts.append(make(rng.randint(0, 80)))
        elif kind < 0.6:
            texts.append(rng.choice(texts))
        elif kind < 0.8:
            copy = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
        else:
            texts.append(make(rng.randint(0, 20)) + " " + passage + "\n" + make(rng.randint(0, 20)))
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("bands,rounds", [(32, 2), (128, 1)])
def test_near_duplicates(spark, monkeypatch, bands, rounds):
    """Against all pairs; with many narrow bands the buckets are mixed and the residual comparison runs."""
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", rounds)
    table = corpus(spark, 3)
    sets = {r.doc_id: shingles(r.text) for r in table.collect()}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = minhash.near_duplicates(table, bands=bands, rows=4 if bands == 32 else 1).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_duplicates_on_edges(edges, nothing):
    got = minhash.near_duplicates(edges).collect()
    assert len(got) == edges.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].component_id == 5 and not by_id[6].kept and by_id[5].kept
    assert by_id[2].n_shingles == by_id[3].n_shingles == by_id[9].n_shingles == 0
    assert by_id[2].component_id == 2 and by_id[3].component_id == 3 and by_id[1].n_shingles == 1
    assert [(r.component_id, r.kept) for r in got if r.doc_id == 8] == [(8, True)] * 2
    assert {(r.component_id, r.kept) for r in got if r.doc_id is None} == {(None, True)}
    assert minhash.near_duplicates(nothing).count() == 0


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, 400, dtype=np.int64).view(np.uint64) for _ in range(2))
    both = np.concatenate([a[:300], b])
    same = (minhash.signature(a, 512) == minhash.signature(both, 512)).mean()
    assert abs(same - 300 / 800) < 0.08


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1040)]
    table = spark.createDataFrame(pairs, "a long, b long").filter("a <> b")
    root = {x: x for p in pairs if p[0] != p[1] for x in p}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = minhash.components(table).collect()
    assert len(got) == len(root) and {r.node: r.root for r in got} == {i: find(i) for i in root}


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if starts[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("seed,length,size", [(1, 200, 32), (2, 40, 8), (4, 12, 4)])
def test_repeats(spark, seed, length, size):
    table = corpus(spark, seed, 60)
    extra = ["For " * 400, "For " * 300 + "end", "aaaa" * 90, None, "", "abcabcabc" * 30]
    texts = [r.text for r in table.orderBy("doc_id").collect()] + extra
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.without_repeats(table, length=length, size=size).orderBy("doc_id").collect()
    found = [(r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in got]
    assert found == brute_repeats(texts, length)


def test_repeats_on_edges(edges, nothing):
    out = repeats.without_repeats(edges).collect()
    texts = [r.text for r in out]
    assert [bytes(r.kept) for r in out] == [x[3] for x in brute_repeats(texts, 200)] and len(out) == edges.count()
    assert repeats.without_repeats(nothing).count() == 0


def test_interval_scan_finds_all_groups():
    rng = random.Random(3)
    for _ in range(200):
        members = list({(bytes(rng.choices(b"ab", k=6)), b"A" + bytes(rng.choices(b"ab", k=7))) for _ in range(rng.randint(2, 9))})
        got = repeats.cover(members, 9)
        for i, (left, right) in enumerate(members):
            pairs = [(repeats.shared_prefix(left, m[0]), repeats.shared_prefix(right, m[1])) for k, m in enumerate(members) if k != i]
            pairs = [p for p in pairs if sum(p) >= 9]
            assert got[i] == (max((p[0] for p in pairs), default=0), max((p[1] for p in pairs), default=0))


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(texts, items):
    split = lambda t: ITEM_WORD.findall((t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    out = []
    for text in texts:
        w, hit, found = split(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                names = windows.get(tuple(w[i : i + size]))
                if names:
                    hit.update(range(i, i + size))
                    found |= names
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_contamination(spark, edges, nothing):
    table = corpus(spark, 7)
    texts = [r.text for r in table.orderBy("doc_id").collect()]
    rng = random.Random(9)
    items = [(k, t[: rng.randint(20, 400)]) for k, t in enumerate(rng.sample(texts, 20))] + [(50, "kax loyy"), (51, None), (52, "..."), (53, texts[0]), (54, texts[0])]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    got = contamination.contamination(table, bench).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, list(r["items"])) for r in got] == brute_contamination(texts, items)
    on_edges = contamination.contamination(edges, bench.limit(0)).collect()
    assert len(on_edges) == edges.count() and not any(r.contaminated for r in on_edges)
    own = spark.createDataFrame([(1, "Passage of some LENGTH that stands in more than one"), (None, "without any id")], "item_id long, text string")
    hit = {r.doc_id: list(r["items"]) for r in contamination.contamination(edges, own).filter("contaminated").collect()}
    assert hit == {10: ["1"], 11: ["1"], None: [""]}
    assert contamination.contamination(nothing, bench).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "rare a b c unusual"), (2, "unusual " + "a " * 30 + "rare"), (3, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a unusual rare")], "item_id long, text string")
    assert [tuple(r) for r in contamination.proximity_matches(docs, items, within=5).collect()] == [(1, "7")]


def test_proximity_passes_over_words_that_no_document_holds(spark):
    docs = spark.createDataFrame([(1, "rare a b c unusual"), (2, "rare alone")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "rare unusual neverseen"), (8, "neverseen rare"), (9, "nothing known")], "item_id long, text string")
    assert [tuple(r) for r in contamination.proximity_matches(docs, items, within=5).collect()] == [(1, "7")]


def test_mixing_counts_and_scores(spark, edges, nothing):
    table = corpus(spark, 11, 300).unionByName(edges.select("doc_id", "text"))
    table = table.withColumn("held_out", table["doc_id"] % 5 == 2).fillna(False, ["held_out"])
    got = mixing.score(table).collect()
    rows = [(r.doc_id, r.text, r.held_out) for r in table.collect()]
    counts = Counter(w for _, t, h in rows if not h for w in [*words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    wanted = Counter()
    for i, t, h in rows:
        w = [*words(t), None]
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w)
        wanted[i, h, len(w), sum(counts[x] > 0 for x in w), total, round(base, 5)] += 1
    assert wanted == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert mixing.score(nothing.selectExpr("doc_id", "text", "false AS held_out")).count() == 0
    none = mixing.score(table.filter("held_out")).collect()
    assert {r.n_known for r in none} == {0} and all(math.isfinite(r.score) for r in none)


def test_mixing_learns(spark):
    """Repeated phrases are cheaper than the word counts alone, and probabilities of all next bytes sum to one."""
    rng = random.Random(4)
    phrases = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=12)) for _ in range(20)]
    rows = [(i, " ".join(rng.choices(phrases, k=8)), i % 7 == 2) for i in range(700)]
    got = mixing.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).toPandas()
    held = got[got.held_out]
    assert held.score.sum() > 0.5 * held.base_score.sum()
    mixer = mixing.Mixer(*mixing.SPELL)
    rng = np.random.default_rng(0)
    ctx = [rng.integers(0, 1 << mixing.SPELL_BITS, 5000) for _ in range(4)]
    bits = (ctx[0] & 1) == 1
    mixer.learn(ctx, np.zeros(5000, np.int64), bits)
    p = mixer.predict(ctx, np.zeros(5000, np.int64))
    assert ((p > 0) & (p < 1)).all() and p[bits].mean() > 0.8 > 0.2 > p[~bits].mean()


def test_mixing_learns_from_every_block(spark, monkeypatch):
    """Fifty blocks teach about what one block of the same texts does, whatever partitions the texts came in."""
    rng = random.Random(5)
    syllables = ["".join(rng.choices("abcdefghijklmnop", k=4)) for _ in range(60)]
    word = lambda: "".join(rng.choices(syllables, k=4))
    rows = [(i, " ".join(word() for _ in range(6)), i % 7 == 2) for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")

    def scores(docs):
        return {r.doc_id: r.score for r in mixing.score(docs).filter("held_out").collect()}

    one = scores(table)
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 1200)
    many, dealt = scores(table.repartition(1)), scores(table.repartition(7))
    assert many == dealt
    assert sum(many.values()) > 1.25 * sum(one.values())


def test_mixing_codes_known_words_by_mixed_decisions(spark):
    """Which of two equally frequent words follows ``mid`` depends on the word before it: counts of pairs cannot tell."""
    rng = random.Random(6)
    phrases = [["one", "mid", "left"], ["two", "mid", "right"], ["two", "other", "x"], ["two", "other", "y"]]
    rows = [(i, " ".join(" ".join(rng.choice(phrases)) for _ in range(60)), i % 7 == 2) for i in range(400)]
    got = {r.doc_id: r.score for r in mixing.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()}
    sequences = [(i, h, [None, *words(t), None]) for i, t, h in rows]
    pairs = Counter(p for _, h, w in sequences if not h for p in zip(w[:-1], w[1:], strict=True))
    heads = Counter(a for _, h, w in sequences if not h for a in w[:-1])
    for i, h, w in sequences:
        if h:
            assert got[i] > sum(math.log10(pairs[p] / heads[p[0]]) for p in zip(w[:-1], w[1:], strict=True))


def test_mixing_names_are_a_prefix_code():
    """The probabilities of all followers that a place can name sum to one, and those of known words to one at most."""
    rng = np.random.default_rng(3)
    corpus = mixing.Corpus(100, 40, np.zeros((32, 1), np.int64), np.array([5, 3, 0, 1] + [0] * 28), np.ones(mixing.CELLS, np.int64))
    models = [mixing.Mixer(*s) for s in mixing.SHAPES]
    for k in (3, 4):
        contexts = [rng.integers(0, mixing.CELLS, 40_000) for _ in range(models[k].inputs)]
        models[k].learn(contexts, rng.integers(0, 16, 40_000), rng.integers(0, 2, 40_000))

    def total(seen, names, about):
        n = len(names)
        size, place = np.array(names).T
        same = np.full(n, 77)
        code = mixing.Coded(np.full(n, 3), np.full(n, seen), np.full(n, True), same, np.arange(n), np.full(n, about), size, place, 0 * same)
        cost = np.zeros(n)
        for k, contexts, gates, bits, owner in mixing.names(code, corpus, np.arange(n)):
            cost += np.bincount(owner, mixing.cost_of(models[k].predict(contexts, gates), bits), minlength=n)
        return (10**cost).sum()

    assert abs(total(True, [(c, p) for c in range(4) for p in range(1 << c)], 3 << 3 | 5) - 1) < 1e-4
    assert 0 < total(False, [(c, p) for c in range(4) for p in range(corpus.often[c])], 0) <= 1


def test_mixing_places_by_brute_force():
    """Ranks of followers with and without one occurrence, and places of words of one magnitude."""
    rng = random.Random(8)
    head = np.array(sorted(rng.choices(range(9), k=300)))
    total = np.array([rng.choice([0, 1, 1, 2, 2, 3, 5, 8]) for _ in head])
    with_, without, followers = mixing.follower_ranks(head, total, 10)
    for h in range(10):
        own = [(int(i), int(total[i])) for i in np.flatnonzero(head == h) if total[i]]
        assert followers[h] == (len(own).bit_length() - 1 if own else 0)
        for i, c in own:
            for counts, found in ((own, with_[i]), ([(j, n - (j == i)) for j, n in own if n > (j == i)], without[i])):
                order = [j for j, _ in sorted(counts, key=lambda x: (-x[1], x[0]))]
                assert (int(found) & mixing.RANKS) == (order.index(i) + 1 if i in order else 0)
                if i in order:
                    share = sum(n for _, n in counts) // max(n for _, n in counts)
                    assert int(found) >> mixing.RANK_BITS == min(7, share.bit_length() - 1)
    place, lower, often = mixing.known_places(total)
    size = [int(c).bit_length() - 1 for c in total]
    for i, c in enumerate(total.tolist()):
        if c:
            assert place[i] == sum(size[j] == size[i] for j in range(i)) and often[size[i]] == size.count(size[i])
        if c > 1 and (c - 1).bit_length() < c.bit_length():
            assert lower[i] == sum(size[j] == size[i] - 1 for j in range(i))


def test_mixing_cuts_followers_of_frequent_words(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice([f"often w{rng.randrange(40)}", f"w{rng.randrange(40)}"]) for _ in range(40)), i % 7 == 2) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    whole = mixing.score(table).toPandas()
    monkeypatch.setattr(mixing, "HEAD_TOKENS", 1000)
    assert mixing.slices_of(table).max() > 2
    cut = mixing.score(table).toPandas()
    assert 0.9 < cut.score.sum() / whole.score.sum() < 1.1 and (cut.n_known.sum() == whole.n_known.sum())


def test_hashes_of_spans():
    data = np.frombuffer(b"abcabc", np.uint8)
    h = prefix_hashes(data)
    got = span_hashes(h, np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert got[0] == got[1] != got[2]


def test_digest_columns(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.sql("SELECT sha2('', 256)").first()[0]
    assert zlib.crc32(b"12") == spark.sql("SELECT crc32(cast('12' as binary))").first()[0]


def test_shingles_of_many_texts_need_little_memory_at_once():
    import tracemalloc

    from veldt.llm import words

    texts = [" ".join(f"w{(i * 7919 + j * j) % 5000}" for j in range(600)) for i in range(1200)]
    words.powers(1)
    tracemalloc.start()
    sizes = [len(s) for run in words.blocks(texts) for s in words.shingle_sets(run, 5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [len(s) for t in texts for s in words.shingle_sets([t.encode()], 5)]
    assert peak < 12 << 20
