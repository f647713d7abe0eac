"""Chat formatting: tool calls linked to their results, ordered, checked and serialised.

A message whose text is a JSON object with ``tool_calls`` (an array of ``id``,
``name``, ``arguments``) makes calls; one of role ``tool`` with ``tool_call_id``
is a result; every other message is plain. Calls and results meet by a hash join on
conversation and identifier. Arguments are checked against the tool's schema and
every message becomes one line of canonical JSON: keys sorted, no blanks, numbers
in one form. DataFrame functions only; a conversation is never gathered in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperloom.llm.graph import written

#: Turns numbered in one window; longer conversations go by such blocks.
BLOCK = 4096

#: Kinds of a schema, by the leading word of a variant's own schema.
KINDS = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"], "null": ["VOID"]}

Schemas = dict[str, dict[str, tuple[str, bool]]]


def _faults(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments, in the schema's own order, extra ones last."""
    plain = F.array().cast("array<string>")
    out = F.array(F.lit("unknown tool"))
    for tool, params in schemas.items():
        checks = []
        for param, (kind, required) in params.items():
            value = F.try_variant_get(arguments, "$['" + param + "']", "variant")
            form = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
            checks.append(F.when(value.isNull(), F.lit(f"{param}: missing") if required else F.lit(None)).when(~form.isin(KINDS[kind]), f"{param}: not {kind}"))
        extra = F.array_sort(F.array_except(F.json_object_keys(F.to_json(arguments)), F.array(*map(F.lit, params)) if params else plain))
        found = F.concat(F.array_compact(F.array(*checks)) if checks else plain, F.transform(F.coalesce(extra, plain), lambda k: F.concat(k, F.lit(": unknown"))))
        out = F.when(name == tool, found).otherwise(out)
    is_object = F.schema_of_variant(arguments).startswith("OBJECT")
    return F.when(arguments.isNull() | ~is_object, F.array(F.lit("arguments: not an object"))).otherwise(F.when(name.isNull(), F.array(F.lit("unknown tool"))).otherwise(out))


def link_tool_calls(messages: DataFrame, schemas: Schemas, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message or call: ``conv_id, turn, call_no, kind, call_id, linked, faults, position, json``.

    ``kind`` is message, call or result. A call is linked if its identifier has a
    result in the conversation and a result if it has a call; of repeated calls of
    an identifier the first counts, further ones have the fault ``repeated id``.
    A missing identifier links with nothing. ``position`` counts from 0 in an order
    that keeps turns but puts a result after its call; ties go by role and text, so
    equal rows may stand either way. Unparsable text is a plain message. A null
    conversation is a group of its own whose rows link with nothing; null turns
    come first; a null role or text is left out of the JSON.
    """
    src = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    parsed = F.when(F.ltrim("text").startswith("{"), F.try_parse_json("text"))
    src = src.withColumn("body", parsed)
    calls = F.try_variant_get("body", "$.tool_calls", "array<variant>")
    given = F.try_variant_get("body", "$.tool_call_id", "string")
    one = lambda c: F.struct(F.try_variant_get(c, "$.id", "string").alias("id"), F.try_variant_get(c, "$.name", "string").alias("name"), F.try_variant_get(c, "$.arguments", "variant").alias("arguments"))
    src = src.withColumn("calls", F.when(F.size(calls) > 0, F.transform(calls, one)))
    kind = F.when(F.col("calls").isNotNull(), "call").when((F.col("role") == "tool") & F.col("body").isNotNull(), "result").otherwise("message")
    src = src.withColumn("kind", kind).withColumn("given", F.when(F.col("kind") == "result", given))
    rows = src.select("conv_id", "turn", "role", "text", "body", "kind", "given", F.posexplode_outer("calls").alias("call_no", "call"))
    rows = rows.withColumn("call_id", F.coalesce("call.id", "given")).withColumn("call_no", F.coalesce("call_no", F.lit(0)))
    checked = _faults(F.col("call.name"), F.col("call.arguments"), schemas)
    content = F.try_variant_get("body", "$.content", "variant")
    line = (
        F.when(F.col("kind") == "call", F.to_json(F.struct("role", F.array(F.struct(F.col("call.arguments").alias("arguments"), F.col("call.id").alias("id"), F.col("call.name").alias("name"))).alias("tool_calls"))))
        .when(F.col("kind") == "result", F.to_json(F.struct(content.alias("content"), "role", F.col("call_id").alias("tool_call_id"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("content"), "role")))
    )
    faults = F.when(F.col("kind") == "call", checked).otherwise(F.array().cast("array<string>"))
    rows = rows.select("conv_id", "turn", "call_no", "kind", "call_id", faults.alias("faults"), line.alias("json"))
    rows = written(rows.withColumn("uid", F.monotonically_increasing_id()), "chat-rows")
    # One row per identifier, added up before the shuffle; then back to the rows.
    tied = rows.where("call_id is not null and conv_id is not null")
    first_of = lambda k: F.min(F.when(F.col("kind") == k, F.struct("turn", "call_no", "json", "uid")))
    ids = written(tied.groupBy("conv_id", "call_id").agg(first_of("call").alias("c"), first_of("result").alias("r")), "chat-links")
    rows = rows.join(ids, ["conv_id", "call_id"], "left")
    linked = F.when(F.col("kind") == "call", F.col("r").isNotNull()).when(F.col("kind") == "result", F.col("c").isNotNull()).otherwise(False)
    again = (F.col("kind") == "call") & (F.col("c.uid") != F.col("uid"))
    faults = F.when(again, F.concat("faults", F.array(F.lit("repeated id")))).otherwise(F.col("faults"))
    waits = (F.col("kind") == "result") & F.col("c").isNotNull() & (F.col("c.turn") >= F.col("turn"))
    # A result that came too early stands right after the turn of its call.
    spot = F.when(waits, F.col("c.turn")).otherwise(F.col("turn"))
    rows = written(rows.select("conv_id", "turn", "call_no", "kind", "call_id", F.coalesce(linked, F.lit(False)).alias("linked"), faults.alias("faults"), spot.alias("spot"), F.coalesce(waits, F.lit(False)).alias("late"), "json"), "chat-linked")
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("spot") / BLOCK), F.lit(-(2**62))))
    inside = F.row_number().over(W.partitionBy("conv_id", "block").orderBy("spot", "late", "turn", "call_no", "kind", "json"))
    ahead = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    ahead = ahead.select(F.col("conv_id").alias("conv"), F.col("block").alias("at"), F.coalesce(before, F.lit(0)).alias("base"))
    placed = rows.withColumn("inside", inside).join(ahead, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("block") == F.col("at")))
    return placed.select("conv_id", "turn", "call_no", "kind", "call_id", "linked", "faults", (F.col("base") + F.col("inside") - 1).alias("position"), "json")
