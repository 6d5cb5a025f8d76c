"""Tool calls and the pipeline; the queries themselves are run with all others in tests/test_queries.py."""

import json
import os

import __spark_entry__ as entry_module
import corpus_pipeline
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from veldt.llm import common, queries, stages, tools

FOLDER = os.environ.get("VELDT_TEST_FOLDER", "/root/testdata/sf0.001")


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", "find", '{"n": 2, "q": "x\\u00e9"}', None), (1, "b", "find", '{"q": 3, "z": 1}', "a"), (1, "c", "find", "{}", "b"),
            (1, "d", "find", "no json", "gone"), (1, "e", "other", "{}", None), (1, "f", "find", '{"q":"y"}', "g"),
            (1, "g", "find", '{"q":"y"}', "f"), (1, "a", "find", '{"n": 2, "q": "x\\u00e9"}', None), (None, "a", "find", None, None),
            (2, None, "find", "{}", None),
        ],
        "conv_id long, call_id string, name string, arguments string, after string",
    )
    results = spark.createDataFrame([(1, "a", 'say "hi"\n'), (1, "x", "late"), (1, "b", None)], "conv_id long, call_id string, content string")
    schemas = spark.createDataFrame([("find", "q", "string", True), ("find", "n", "integer", False)], "name string, field string, type string, required boolean")
    got = {(r.conv_id, r.call_id): r for r in tools.linked(calls, results, schemas).collect()}
    assert len(got) == 9
    a = got[1, "a"]
    assert (a.depth, a.status, a.copies, a.n_results, a.valid) == (0, "linked", 2, 1, True)
    assert a.call_json == '{"arguments":{"n":2,"q":"xé"},"id":"a","name":"find","type":"call"}'
    assert json.loads(a.result_json) == {"content": 'say "hi"\n', "id": "a", "type": "result"}
    assert got[1, "b"].depth == 1 and list(got[1, "b"].errors) == ["type q", "unknown z"]
    assert got[1, "c"].depth == 2 and list(got[1, "c"].errors) == ["missing q"]
    assert got[1, "d"].depth == 0 and list(got[1, "d"].errors) == ["arguments are not an object"]
    assert list(got[1, "e"].errors) == ["unknown tool"]
    assert got[1, "f"].depth is None and "circle" in got[1, "g"].errors
    assert got[1, "x"].status == "orphan" and got[1, "x"].call_json is None
    assert got[None, "a"].status == "unanswered" and json.loads(got[1, "b"].result_json)["content"] is None
    assert tools.linked(calls.limit(0), results.limit(0), schemas).count() == 0


def test_depth_of_long_chains(spark):
    rows = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(300)]
    got = tools.depths(spark.createDataFrame(rows, "key string, after string")).collect()
    assert {r.key: r.depth for r in got} == {f"c{i}": i for i in range(300)}


def test_stages_on_edges(spark, edges, nothing):
    for docs, least in ((edges, 1), (nothing, 0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "sentencepiece":
                assert out.columns == docs.columns
            assert out.count() >= least, name
    kept = stages.near_dedup(spark, edges, FOLDER).collect()
    ids = [r.doc_id for r in kept]
    assert not {6, 11} & set(ids) and ids.count(8) == 1 and {1, 2, 3, 5, 7, 9, 10, 12} <= set(ids) and ids.count(None) == 2


def test_nothing_is_lost_under_one_identifier(spark):
    calls = [
        ("1", "a", "find", '{"q":"x"}', None), ("1", "a", "find", '{"q":"y"}', None), ("1", "a", "find", '{"q":"y"}', None),
        ("a/b", "c", "find", '{"q":"1"}', None), ("a", "b/c", "find", '{"q":"2"}', None), (None, "c", "find", '{"q":"3"}', None),
        ("null", "c", "find", '{"q":"4","q":"5"}', None), ("2", "r", "find", '{"q":"z"}', None),
    ]
    results = [("1", "a", "one"), ("1", "a", "two"), ("1", "a", "two"), ("a/b", "c", "first"), ("a", "b/c", "second"), (None, "c", "third"), ("2", "r", None)]
    schemas = spark.createDataFrame([("find", "q", "string", True)], "name string, field string, type string, required boolean")
    out = tools.linked(
        spark.createDataFrame(calls, "conv_id string, call_id string, name string, arguments string, after string"),
        spark.createDataFrame(results, "conv_id string, call_id string, content string"), schemas,
    )
    found = sorted(
        ((r.conv_id, r.call_id, r.status, r.copies, r.n_results, tuple(r.errors), json.loads(r.call_json)["arguments"],
          r.result_json and json.loads(r.result_json)["content"]) for r in out.collect()), key=repr)
    assert found == sorted([
        ("1", "a", "linked", 1, 1, ("conflict",), {"q": "x"}, "one"), ("1", "a", "linked", 1, 2, ("conflict",), {"q": "x"}, "two"),
        ("1", "a", "conflict", 2, 0, ("conflict",), {"q": "y"}, None), ("a/b", "c", "linked", 1, 1, (), {"q": "1"}, "first"),
        ("a", "b/c", "linked", 1, 1, (), {"q": "2"}, "second"), (None, "c", "linked", 1, 1, (), {"q": "3"}, "third"),
        ("null", "c", "unanswered", 1, 0, ("arguments cannot be read",), '{"q":"4","q":"5"}', None), ("2", "r", "linked", 1, 1, (), {"q": "z"}, None),
    ], key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = corpus_pipeline.run(spark, FOLDER)
    rows = out.select("doc_id", "n_tokens", "round_trip").collect()
    assert 0 < len(rows) < docs.count() and all(r.round_trip for r in rows)
    toxic = spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 1")
    assert out.join(toxic, "doc_id", "left_semi").count() <= 0.5 * toxic.count()


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert sum(k.startswith("op") for k in entry_module.queries()) == 13
    native = ("tools", "contamination")
    for module in native:
        text = open(os.path.join(os.path.dirname(queries.__file__), f"{module}.py")).read()
        assert not any(x in text for x in ("udf", "mapIn", "applyIn", "map_rows", ".rdd"))


def test_stages_keep_the_values_of_columns_named_like_outputs(spark, labels):
    names = ["score", "grade", "p_toxic", "expected_severity", "kept", "spans", "n_bytes", "_row", "_text", "_doc", "_spans", "row"]
    rows = [(i, f"document number {i} with a text of its own, long enough for shingles {i * i}", *[f"{n}{i}" for n in names]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for stage in (stages.toxic, stages.near_dedup, stages.repeated_passages, stages.decontamination):
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)


def test_workers_get_small_batches(spark):
    """A partition does not reach a worker as one batch, unless the session says so."""
    rows = spark.range(5_000).coalesce(1)
    sizes = common.map_rows(rows, lambda: lambda ids: ([len(ids)] * len(ids),), ["id"], [("n", LongType())], chunk=10_000)
    assert sizes.agg(F.max("n")).first()[0] == 1_000
    own, name = spark.newSession(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    own.conf.set(name, 77)
    common.small_batches(own)
    assert int(own.conf.get(name)) == 77
