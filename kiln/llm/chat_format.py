"""Chat formatting by tool-call linking.

Calls and results are hash-joined by identifier, ordered topologically by what
they wait for, checked against the schemas of their tools, and written as
canonical JSON (keys sorted at every level, no blanks). DataFrame and SQL
functions only.

A call names at most one call it waits for, so dependencies form a forest. The
position of a call is its distance to the root of its chain, found by pointer
doubling: every round each call adds its pointer's distance and takes over its
pointer, so a chain of n calls needs log2(n) rounds. What still points on after
as many rounds as any chain can need lies on a cycle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import keep

KEY = ["conv_id", "call_id"]


def topological_positions(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, position, state)`` of calls ``(conv_id, call_id, after_id)``.

    ``position`` 0 for calls that wait for nothing; ``state`` is ``ok``,
    ``dangling`` (its chain ends at a call that doesn't exist; positions count
    from there) or ``cycle`` (null position).
    """
    known = calls.select("conv_id", F.col("call_id").alias("after_id"), F.lit(True).alias("known"))
    d = calls.select(*KEY, "after_id").join(known, ["conv_id", "after_id"], "left")
    d = keep(
        d.select(
            *KEY,
            F.when(F.col("known"), F.col("after_id")).alias("next"),
            F.when(F.col("known"), 1).otherwise(0).cast("long").alias("position"),
            (F.col("after_id").isNotNull() & F.col("known").isNull()).alias("dangling"),
        ),
        "pointers",
    )
    n = d.count()
    for _ in range(math.ceil(math.log2(n + 1)) + 1):
        if d.where("next IS NOT NULL").isEmpty():
            break
        to = d.select(
            "conv_id", F.col("call_id").alias("next"), F.col("next").alias("further"), F.col("position").alias("steps"), F.col("dangling").alias("loose")
        )
        moving = d.where("next IS NOT NULL").join(to, ["conv_id", "next"])
        d = keep(
            d.where("next IS NULL").unionByName(
                moving.select(
                    *KEY, F.col("further").alias("next"), (F.col("position") + F.col("steps")).alias("position"), (F.col("dangling") | F.col("loose")).alias("dangling")
                )
            ),
            "pointers",
        )
    return d.select(
        *KEY,
        F.when(F.col("next").isNull(), F.col("position")).alias("position"),
        F.when(F.col("next").isNotNull(), "cycle").when(F.col("dangling"), "dangling").otherwise("ok").alias("state"),
    )


def argument_errors(arguments: Column, schema: Column) -> Column:
    """Sorted error strings of a JSON object against ``array<struct<param, type, required>>``.

    Types: string, integer, number, boolean, array, object. Arguments that are
    no JSON object have the one error ``not an object``; a null schema (unknown
    tool) the one error ``unknown tool``.
    """
    value = F.try_parse_json(arguments)
    kind = F.schema_of_variant(value)
    given = F.from_json(arguments, "map<string,variant>")
    shape = lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    as_type = lambda v: (
        F.when(shape(v) == "STRING", "string")
        .when(shape(v) == "BOOLEAN", "boolean")
        .when(shape(v) == "BIGINT", "integer")
        .when(shape(v).isin("DECIMAL", "DOUBLE", "FLOAT"), "number")
        .when(shape(v) == "ARRAY", "array")
        .when(shape(v) == "OBJECT", "object")
        .otherwise("null")
    )
    got = F.transform_values(given, lambda _, v: as_type(v))
    missing = F.transform(
        F.filter(schema, lambda p: p["required"] & ~F.coalesce(F.array_contains(F.map_keys(got), p["param"]), F.lit(False))),
        lambda p: F.concat(F.lit("missing "), p["param"]),
    )
    wrong = F.transform(
        F.filter(
            schema,
            lambda p: F.coalesce(
                (F.element_at(got, p["param"]) != p["type"]) & ~((p["type"] == "number") & (F.element_at(got, p["param"]) == "integer")), F.lit(False)
            ),
        ),
        lambda p: F.concat(F.lit("wrong type "), p["param"]),
    )
    names = F.transform(schema, lambda p: p["param"])
    extra = F.transform(F.array_except(F.map_keys(got), names), lambda k: F.concat(F.lit("unexpected "), k))
    return (
        F.when(schema.isNull(), F.array(F.lit("unknown tool")))
        .when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), F.array(F.lit("not an object")))
        .otherwise(F.array_sort(F.concat(missing, wrong, extra)))
    )


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no blanks; null if it can't be parsed."""
    return F.to_json(F.try_parse_json(json))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame, messages: DataFrame | None = None) -> DataFrame:
    """One row per call, per result without a call, and per plain message.

    calls ``(conv_id, call_id, after_id, name, arguments)``; results
    ``(conv_id, call_id, content)``; schemas ``(name, param, type, required)``;
    messages ``(conv_id, call_id, role, content)``, whose ``call_id`` is their place.
    Returns ``conv_id, call_id, position, state, status, errors, message``:
    ``status`` is ``answered``, ``unanswered`` or ``orphan`` (no such call: null
    position, state and errors) or ``message`` (they wait for nothing: null, too);
    ``message`` is canonical JSON of the call with its result, or of the message.

    * rows with a null identifier are left out; of repeated identifiers the row
      with the smallest (name, arguments, after_id) or content counts;
    * messages pass as they are, repeated ones and those without an identifier too;
    * null arguments count as the empty object, null content as null;
    * arguments that don't parse are kept in the message as a string;
    * extra columns are ignored; empty tables give empty results.
    """
    named = lambda df: df.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    c = named(calls).withColumn("arguments", F.coalesce("arguments", F.lit("{}")))
    c = c.groupBy(*KEY).agg(F.min(F.struct("name", "arguments", "after_id")).alias("c")).select(*KEY, "c.*")
    c = keep(c, "calls")
    r = named(results).groupBy(*KEY).agg(F.min("content").alias("content"), F.lit(True).alias("has_result"))
    tools = schemas.where("name IS NOT NULL AND param IS NOT NULL").groupBy("name").agg(
        F.array_sort(F.collect_set(F.struct("param", "type", "required"))).alias("schema")
    )
    joined = (
        c.withColumn("has_call", F.lit(True)).hint("shuffle_hash").join(r, KEY, "full")
        .join(topological_positions(c.select(*KEY, "after_id")), KEY, "left")
        .join(tools, "name", "left")
    )
    arguments = F.coalesce(F.try_parse_json("arguments"), F.to_variant_object(F.struct(F.col("arguments").alias("unparsed"))))
    message = F.to_json(
        F.struct(
            F.when(F.col("has_call"), arguments).alias("arguments"),
            F.col("content").alias("content"),
            F.col("call_id").alias("id"),
            F.col("name").alias("name"),
            F.lit("tool_call").alias("type"),
        )
    )
    linked = joined.select(
        *KEY,
        "position",
        "state",
        F.when(F.col("has_call").isNull(), "orphan").when(F.col("has_result"), "answered").otherwise("unanswered").alias("status"),
        F.when(F.col("has_call"), argument_errors(F.col("arguments"), F.col("schema"))).alias("errors"),
        message.alias("message"),
    )
    if messages is None:
        return linked
    plain = F.to_json(F.struct("content", F.col("call_id").alias("id"), "role", F.lit("message").alias("type")))
    null = lambda c: F.lit(None).cast(linked.schema[c].dataType).alias(c)
    return linked.unionByName(
        messages.select(*KEY, null("position"), null("state"), F.lit("message").alias("status"), null("errors"), plain.alias("message"))
    )
