"""Chat formatting: link tool calls with their results, order them, validate arguments, write canonical JSON.

DataFrame operations only. Calls and results are joined by conversation and identifier. A call may name one earlier
call; its depth in that forest is found by doubling the reach of every reference, so a chain of n calls takes log2(n)
joins, and (depth, identifier) is a topological order. Canonical JSON has sorted keys and no blanks.

Nothing is lost: equal calls and equal results are merged and counted, different ones under one identifier stay rows of
their own. Of different calls, the one with the least (name, arguments, reference) is the identifier's call: it gives the
reference and takes the results, a row for each different one; the others have the status ``conflict``, and all of them
the error. So an identifier that a third of all rows share gives no more rows than it has calls and results.

Defined results: a null conversation is one of its own, apart from one named like it; calls and results without
identifier are left out; arguments that are not a JSON object, repeat a key, unknown tools, missing, unknown or wrongly
typed arguments are errors, and arguments that cannot be written as canonical JSON are written as the text they are; a
reference that no call has makes a root; calls in or behind a circle have a null depth and an error; results without a
call come out as ``orphan`` rows. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.llm.common import checkpointed

#: names of JSON types by the start of Spark's name for the type of a parsed value
KINDS = {
    "string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DECIMAL", "DOUBLE"], "boolean": ["BOOLEAN"],
    "array": ["ARRAY"], "object": ["OBJECT"], "null": ["VOID"],
}


def link_key(conv: str, call: str) -> Column:
    """One text for a conversation and an identifier; the conversation's length keeps the two apart."""
    name = F.col(conv).cast("string")
    return F.concat(F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), name), F.lit("-")), F.lit("/"), F.col(call))


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and without blanks; null where it cannot be read."""
    return F.to_json(F.try_parse_json(json))


def depths(calls: DataFrame) -> DataFrame:
    """(key, depth) of calls (key, after); null for calls that lead into a circle."""
    known = calls.select(F.col("key").alias("after"), F.lit(True).alias("found"))
    state = calls.join(known, "after", "left")
    state = checkpointed(state.select("key", F.when(F.col("found"), F.col("after")).alias("up"), F.when(F.col("found"), 1).otherwise(0).alias("far")))
    total = state.count()
    reach = 1
    while reach <= total and state.filter("up IS NOT NULL").take(1):
        ahead = state.select(F.col("key").alias("up"), F.col("up").alias("next"), F.col("far").alias("more"))
        state = state.join(ahead, "up", "left").select("key", F.col("next").alias("up"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"))
        state = checkpointed(state)
        reach *= 2
    return state.select("key", F.when(F.col("up").isNull(), F.col("far")).cast("long").alias("depth"))


def argument_errors(fields: Column, given: Column) -> Column:
    """Errors of a map of parsed arguments against an array of (field, type, required)."""

    def of_field(f: Column) -> Column:
        value = F.get(F.filter(F.map_entries(given), lambda e: e["key"] == f["field"]), F.lit(0))["value"]
        kind = F.schema_of_variant(value)
        right = F.lit(False)
        for name, starts in KINDS.items():
            fits = F.lit(False)
            for start in starts:
                fits = fits | kind.startswith(start)
            right = right | ((f["type"] == name) & fits)
        missing = F.when(f["required"], F.concat(F.lit("missing "), f["field"]))
        return F.when(value.isNull(), missing).when(~right, F.concat(F.lit("type "), f["field"]))

    names = F.transform(fields, lambda f: f["field"])
    unknown = F.transform(F.array_except(F.map_keys(given), names), lambda k: F.concat(F.lit("unknown "), k))
    return F.array_sort(F.concat(F.filter(F.transform(fields, of_field), lambda e: e.isNotNull()), unknown))


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Calls (conv_id, call_id, name, arguments, after) with results (conv_id, call_id, content) and argument schemas
    (name, field, type, required).

    A row per different call, and for the call that has them a row per different result: conv_id, call_id, depth, status
    (linked, unanswered, conflict, orphan), copies (equal calls), n_results (equal results), valid, errors, call_json,
    result_json.
    """
    every = calls.filter("call_id IS NOT NULL").groupBy("conv_id", "call_id", "name", "arguments", "after").agg(F.count("*").alias("copies"))
    every = every.withColumn("key", link_key("conv_id", "call_id"))
    body = F.struct("name", "arguments", "after")
    least = every.groupBy("key").agg(F.min(body).alias("least"), F.count("*").alias("variants"))
    nodes = least.join(every, "key").filter(body.eqNullSafe(F.col("least"))).select("key", link_key("conv_id", "after").alias("after"))
    answers = results.filter("call_id IS NOT NULL").groupBy("conv_id", "call_id", "content").agg(F.count("*").alias("n_results"))
    answers = answers.withColumn("key", link_key("conv_id", "call_id")).withColumnsRenamed({"conv_id": "conv2", "call_id": "call2"})
    fields = schemas.groupBy("name").agg(F.sort_array(F.collect_set(F.struct("field", "type", "required"))).alias("fields"))
    one = every.join(least, "key").join(depths(nodes), "key").join(fields, "name", "left")
    # only the identifier's own call meets the results
    one = one.withColumn("answered", F.when(body.eqNullSafe(F.col("least")), F.col("key")))
    rows = one.drop("key").join(answers, F.col("answered") == F.col("key"), "full")
    rows = rows.withColumn("given", F.from_json("arguments", "map<string,variant>"))
    is_call = F.col("call_id").isNotNull()
    unread = F.try_parse_json("arguments").isNull()
    errors = (
        F.when(~is_call, F.array(F.lit("no call")))
        .when(F.col("fields").isNull(), F.array(F.lit("unknown tool")))
        .when(F.col("given").isNull(), F.array(F.lit("arguments are not an object")))
        .when(unread, F.array(F.lit("arguments cannot be read")))
        .otherwise(argument_errors(F.col("fields"), F.col("given")))
    )
    errors = F.when(is_call & F.col("depth").isNull(), F.concat(errors, F.array(F.lit("circle")))).otherwise(errors)
    errors = F.when(is_call & (F.col("variants") > 1), F.concat(errors, F.array(F.lit("conflict")))).otherwise(errors)
    status = F.when(~is_call, "orphan").when(F.col("answered").isNull(), "conflict").when(F.col("n_results").isNull(), "unanswered").otherwise("linked")
    text = F.concat(
        F.lit('{"arguments":'), F.coalesce(canonical(F.col("arguments")), json_text(F.col("arguments")), F.lit("null")), F.lit(',"id":'), json_text(F.col("call_id")),
        F.lit(',"name":'), F.coalesce(json_text(F.col("name")), F.lit("null")), F.lit(',"type":"call"}'),
    )
    result = F.concat(
        F.lit('{"content":'), F.coalesce(json_text(F.col("content")), F.lit("null")), F.lit(',"id":'), json_text(F.col("call2")), F.lit(',"type":"result"}')
    )
    return rows.withColumn("errors", errors).select(
        F.coalesce("conv_id", "conv2").alias("conv_id"),
        F.coalesce("call_id", "call2").alias("call_id"),
        "depth",
        status.alias("status"),
        F.coalesce("copies", F.lit(0)).alias("copies"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        (F.size("errors") == 0).alias("valid"),
        "errors",
        F.when(is_call, text).alias("call_json"),
        F.when(F.col("n_results").isNotNull(), result).alias("result_json"),
    )


def json_text(value: Column) -> Column:
    """A string as JSON text; control characters below space, quotes and backslashes escaped."""
    whole = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), whole.substr(F.lit(6), F.length(whole) - 6))
