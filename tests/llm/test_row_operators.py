"""Operators that work row by row: subwords, severity, languages, main text, fingerprints."""

import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from veldt.llm import fingerprint, languages, pieces, tag_paths, toxicity

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def true_ids(text):
    return MODEL.encode(text or "", add_bos=True, add_eos=True)


def test_pieces_on_edges(edges, nothing):
    out = pieces.decode(pieces.encode(edges, PATH), PATH)
    assert out.select("source", "score").columns == ["source", "score"]
    for row in out.select("text", "ids", "decoded").collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == true_ids(row.text)
        assert row.decoded == MODEL.decode(true_ids(row.text))
    assert pieces.encode(nothing, PATH).count() == 0
    assert pieces.unpacked(pieces.encode(edges, PATH)).filter("text IS NULL").first().id_list == [1, 2]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeinrst ▁\n\t.,-0é漢😀<>x/"), max_size=40))
def test_pieces_equal_the_library(text):
    own = pieces.vocabulary(PATH)
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == true_ids(text)
    assert own.decode(ids) == MODEL.decode(true_ids(text))


def test_what_pieces_remember_is_bounded_within_a_text(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_CUTS", 50)
    monkeypatch.setattr(pieces, "CACHED_PAIRS", 40)
    own, text = pieces.Pieces(PATH), " ".join(f"word{i % 300}, ne{i % 7}xt" for i in range(2000))
    for t in (text, "short", text[::-1]):
        assert np.frombuffer(own.encode(t), "<u4").tolist() == true_ids(t)
        assert len(own.cuts) <= 50 and len(own.pairs) <= 40


def test_scores_do_not_depend_on_what_is_remembered(spark, edges, monkeypatch):
    model = toxicity.Severity({b: 0.5 for w in ("word3", "passage", "text", "and") for b in toxicity.features_of(w)}, [0.2])
    monkeypatch.setattr(toxicity, "KNOWN_WORDS", 1 << 20)
    plain = toxicity.severity(edges, model).select("score").collect()
    monkeypatch.setattr(toxicity, "KNOWN_WORDS", 2)
    assert toxicity.severity(edges, model).select("score").collect() == plain


def test_severity_grades(spark, edges, nothing, labels):
    rng = random.Random(1)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    rows = []
    for i in range(900):
        grade = i % 3
        text = rng.choices(words, k=30) + rng.choices(["vilely", "vileness"], k=(0, 1, 4)[grade]) + ["foulest"] * (grade == 2)
        rows.append((i, " ".join(text), grade))
    table = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = toxicity.fit(table.filter("doc_id < 600"), table)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    out = toxicity.severity(table.filter("doc_id >= 600").withColumnRenamed("grade", "truth"), model).toPandas()
    assert (out.grade == out.truth).mean() > 0.95
    assert out.groupby("truth").expected_severity.mean().is_monotonic_increasing
    on_edges = toxicity.severity(edges, model)
    assert on_edges.count() == edges.count() and on_edges.filter("p_toxic IS NULL").count() == 0
    for fitted in (toxicity.fit_from_flags(edges, labels), toxicity.fit_from_flags(nothing, labels.limit(0))):
        assert toxicity.severity(edges, fitted).filter("p_toxic NOT BETWEEN 0 AND 1").count() == 0
    assert toxicity.severity(edges, toxicity.Severity({}, [])).filter("grade <> 0 OR expected_severity <> 0").count() == 0
    assert toxicity.severity(nothing, model).count() == 0


def test_languages(spark, edges, nothing):
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["str", "ung", "heit"], "zz": ["eau", "oi", "que"]}
    rng = random.Random(2)
    word = lambda lang: "".join(rng.choices(parts[lang], k=rng.randint(1, 3)))
    rows = [(i, " ".join(word(lang) for _ in range(40)), lang) for i, lang in enumerate(list(parts) * 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.fit(table.filter("doc_id % 4 <> 2"))
    out = languages.label(table.filter("doc_id % 4 = 2"), model).toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()
    switched = " ".join(word("xx") for _ in range(15)) + " " + " ".join(word("yy") for _ in range(15))
    runs = languages.label(spark.createDataFrame([(switched,)], "text string"), model).first().lang_runs
    assert [r.lang for r in runs] == ["xx", "yy"] and abs(runs[0].words - 15) <= 1
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in languages.label(edges, model).collect()}
    assert got[2, None] == got[3, ""] == got[9, "  \n\t "] == got[12, "123 456"] == ("und", 0.0)
    none = languages.fit(nothing)
    assert {r.lang_pred for r in languages.label(edges, none).collect()} == {"und"}
    assert languages.label(nothing, model).count() == 0


def test_segments_change_nothing(monkeypatch):
    rng = np.random.default_rng(0)
    emit, moves, starts = rng.random((700, 3)) + 0.01, rng.random((3, 3)), np.array([0, 1, 97, 400, 700])
    cut = languages.posteriors(emit, moves, starts)
    monkeypatch.setattr(languages, "SEGMENT", 10**6)
    assert np.allclose(cut, languages.posteriors(emit, moves, starts))
    pair = languages.pair_posteriors(emit[:96], moves, np.array([0, 48, 96]))
    assert np.allclose(pair.sum(axis=1)[:47], languages.posteriors(emit[:48], moves, np.array([0, 48]))[1:])


def test_main_text(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a>"
        "</ul></nav><!-- x --><div class='ad'>Buy this, now!</div><article><h1>A &quot;title&quot;</h1><p>First <b>part,"
        "&nbsp;with</b>\n more.<p>a &lt; b &#233;.<aside>Related: things.</aside><div id=\"comments\"><p>Great, really!</p></div>"
        "</article><footer>&copy; us</footer></body>"
    )
    rows = spark.createDataFrame([(1, page, "t"), (2, None, "t"), (3, "", "t"), (3, "", "t"), (4, "<p>cut <b", "t")], "page_id long, html string, text string")
    out = [r.text for r in tag_paths.extract(rows).orderBy("page_id").collect()]
    assert out == ['A "title"\nFirst part, with more.\na < b é.', "", "", "", "cut"]
    assert tag_paths.extract(rows.limit(0)).count() == 0
    assert len(tag_paths.main_text("<p>" + "very long, " * 50_000)) > 500_000


def test_main_text_keeps_short_parts_of_long_pages():
    sentence = "One, two, three, four; five, six, seven, eight, nine and so on to the end of the line. " * 5
    parts = (
        "<ul><li>first item of a list without marks at all<li>short</ul><table><tr><th>Year<td>1999</table>"
        "<blockquote><p>said so</p></blockquote><figure><img src=x><figcaption>A caption</figcaption></figure>"
    )
    wanted = ["first item of a list without marks at all", "short", "Year", "1999", "said so", "A caption"]
    for n in (10, 300):
        for tag in ("article", "div class=text"):
            page = f"<body><nav><a href=/>Home</a></nav><{tag}>{f'<p>{sentence}</p>' * n}{parts}</{tag.split()[0]}><footer>us</footer></body>"
            assert tag_paths.main_text(page).split("\n") == [sentence.strip()] * n + wanted
    menu = "<div><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></div>"
    assert tag_paths.main_text(f"<body>{menu}<div><h2><a href=/>Head</a></h2><p>{sentence}</p></div>") == f"Head\n{sentence.strip()}"


def test_main_text_does_not_hang_on_names():
    sentence = "One, two, three, four; five, six, seven, eight, nine and so on to the end of the line."
    body = f"<p>{sentence}</p>" * 3
    wanted = "\n".join([sentence] * 3)
    for name in ("content with-sidebar", "page-no-nav", "post-header", "menu", "share widget"):
        assert tag_paths.main_text(f"<body><div class='{name}'>{body}</div></body>") == wanted
        assert tag_paths.main_text(f"<body><div class='{name}'><article>{body}</article></div><div class=ad>Buy!</div></body>") == wanted
    assert tag_paths.main_text(f"<form>{body}</form>") == wanted
    assert tag_paths.main_text(f"<article>{body}<div class=related>More, of this.</div></article><nav>Go, there.</nav>") == wanted
    assert tag_paths.main_text("<nav>Go, there.</nav><footer>us</footer>") == tag_paths.main_text("<nav><a href=/>Go</a></nav>") == ""
    for tag in ("svg", "math", "noscript", "select", "object", "canvas", "template", "iframe"):
        assert tag_paths.main_text(f"<article><{tag}>{body}</article>") == wanted
        assert tag_paths.main_text(f"<article><{tag}>not read</{tag}>{body}</article>") == wanted
    for tag in ("script", "style", "textarea"):
        assert tag_paths.main_text(f"<article>{body}<{tag}>{body}</article>") == wanted


def test_fingerprints_are_homomorphic(edges, nothing):
    of = fingerprint.of_paragraphs
    one, two, three = b"first line of text", b"second, longer line of text", b""
    assert of(b"\n".join([one, two, three])).text() == of(b"\n".join([three, one, two])).text() == (of(one) + of(two) + of(three)).text()
    assert (of(b"\n".join([one, two])) - of(two)).text() == of(one).text()
    assert of(one).text() != of(one + b"\n" + one).text()
    assert fingerprint.Fingerprint.parse(of(two).text()).text() == of(two).text()
    assert fingerprint.with_edits(nothing).count() == 0
    assert fingerprint.fingerprints(edges).filter("fingerprint IS NULL").count() == 0


def test_edited_texts(edges):
    out = fingerprint.with_edits(edges).toPandas()
    rows = [(r.doc_id, r.text or "") for r in edges.collect()]
    assert len(out) == len(rows) and out.near_edited.between(0, 1).all() and out.near_next.between(0, 1).all()
    known = sorted([r for r in rows if r[0] is not None and r[0] != 8], key=lambda r: -r[0])
    by_id = out.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    for (i, text), (_, after) in zip(known, known[1:], strict=False):
        if {i, _} & {9, 7}:
            continue
        new = fingerprint.edited(text, after)[0]
        assert by_id.loc[i].edited_fingerprint == fingerprint.of_paragraphs(new.encode()).text()
        assert by_id.loc[i].n_chars == len(text)
    assert by_id.loc[6].near_next == 1.0


def test_split_rule(spark):
    from veldt.llm.common import split_of

    for row in spark.range(50).withColumn("r", split_of("id", 7)).collect():
        assert row.r == zlib.crc32(str(row.id).encode()) % 7
