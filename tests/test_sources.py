"""Readers and writers."""

import pytest

from veldt.sources import marts, payloads, tabular


def test_csv_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\noops,y\n3,z\n")
    df = tabular.load(spark, str(tmp_path / "t.csv"), "csv", "a int, b string")
    rows = sorted(df.collect(), key=lambda r: r.b)
    assert [r.a for r in rows] == [1, None, 3]
    assert [r[tabular.CORRUPT] for r in rows] == [None, "oops,y", None]


def test_json_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a": 1}\n{broken\n')
    rows = tabular.load(spark, str(tmp_path / "t.json"), "json", "a int").collect()
    assert sorted(str(r.a) for r in rows) == ["1", "None"]


def test_text_formats_need_a_schema(spark, tmp_path):
    with pytest.raises(ValueError):
        tabular.load(spark, str(tmp_path), "csv")


def test_payload(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "t": "x"}'), (2, "not json")], "id int, p string")
    rows = sorted(payloads.parse_payload(df, "p", "k int, t string").collect())
    assert [(r.k, r.t) for r in rows] == [(5, "x"), (None, None)]


def test_html(spark):
    page = (
        "<html><head><title> A &amp;\n B </title></head><body><script>var x='<p>no</p>'</script>"
        '<!-- gone --><p>One &lt;two&gt;</p><a class="q" href="/x">link</a></body></html>'
    )
    row = payloads.extract_html(spark.createDataFrame([(page,)], "html string"), "html").first()
    assert row.title == "A & B"
    assert row.links == ["/x"]
    assert row.text == "One <two> link"


def test_mart_reads_back_what_was_written(spark):
    df = spark.range(200).selectExpr("id", "id % 3 AS part", "cast(id AS string) AS name")
    back = marts.write_mart(df, marts.scratch_path(spark, "mart"), ["part"])
    assert back.columns == df.columns
    assert sorted(back.collect()) == sorted(df.collect())
