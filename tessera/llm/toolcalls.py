"""Chat formatting: linking tool calls with their results, DataFrame functions only.

Calls name a tool, carry an identifier, arguments as a JSON text, and may name
the call that they follow up.  Results carry the identifier of their call.
Identifiers hold within a thread.

* Linking is a hash join by (thread, identifier); the side with one row an
  identifier is the one that is hashed, a shuffle partition at a time.
* The order is topological: a result comes after its call, a call after the
  one that it follows up and that one's result.  The graph is a forest, so
  the level of a node is its depth, found by pointer doubling: as many joins
  as the logarithm of the depth, whatever the length of a thread.  Sorting a
  thread by (level, place) gives the order, and no task holds a thread.
* Arguments are checked against the tool's schema: types, required and unknown
  keys, number ranges and text lengths.
* Messages are canonical JSON: keys sorted, no blanks, nulls left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import delete_files, materialize

#: tool -> key -> (type, required, least, most); the bounds of a string are those of its length.
SCHEMAS: dict[str, dict[str, tuple]] = {
    "note": {"body": ("string", True, 1, 600), "pinned": ("boolean", False, None, None)},
    "search": {"limit": ("integer", True, 1, 40), "query": ("string", True, 1, None)},
}
_TYPES = {"string": r"^STRING$", "integer": r"^BIGINT$", "boolean": r"^BOOLEAN$",
          "number": r"^(BIGINT|DOUBLE|DECIMAL.*)$"}


def argument_errors(tool: Column, arguments: Column, schemas: dict[str, dict[str, tuple]]) -> Column:
    """Sorted array of what is wrong with the arguments (a JSON text); empty if nothing is."""
    keys = F.json_object_keys(arguments)
    parsed = F.try_parse_json(arguments)
    per_tool = None
    for name, fields in sorted(schemas.items()):
        wrong = []
        for key, (kind, required, least, most) in sorted(fields.items()):
            path = f'$["{key}"]'
            value = F.try_variant_get(parsed, path, "string")
            typed = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
            there = F.coalesce(F.array_contains(keys, key), F.lit(False))
            ok = F.coalesce(typed.rlike(_TYPES[kind]), F.lit(False))
            size = F.length(value) if kind == "string" else value.try_cast("double")
            if required:
                wrong.append(F.when(~there, F.lit(f"missing {key}")))
            wrong.append(F.when(there & ~ok, F.lit(f"type {key}")))
            low = F.lit(False) if least is None else size < least
            high = F.lit(False) if most is None else size > most
            wrong.append(F.when(there & ok & (low | high), F.lit(f"range {key}")))
        unknown = F.transform(F.array_except(keys, F.array(*map(F.lit, sorted(fields)))),
                              lambda k: F.concat(F.lit("unknown "), k))
        errors = F.array_sort(F.concat(F.array_compact(F.array(*wrong)), unknown))
        per_tool = F.when(tool == name, errors) if per_tool is None else per_tool.when(tool == name, errors)
    known = F.coalesce(tool.isin(*sorted(schemas)), F.lit(False))
    return (F.when(~known, F.array(F.lit("no such tool")))
            .when(keys.isNull() | parsed.isNull(), F.array(F.lit("not an object")))
            .otherwise(per_tool))


def levels_of(nodes: DataFrame) -> DataFrame:
    """(thread, call_id, level) of (thread, call_id, up, step): the sum of the steps up to a root.

    Pointer doubling: each round joins every open node with the one it points
    to and points twice as far.  Nodes on a cycle, and below one, never close;
    the rounds end when they would span all nodes, and those have a null level.
    """
    now = materialize(nodes, "calls-up")
    total, rounds = now.count(), 0
    while (1 << rounds) <= 2 * total and not now.where("up is not null").isEmpty():
        upper = now.select(F.col("thread").alias("t"), F.col("call_id").alias("c"), F.col("up").alias("next"),
                           F.col("step").alias("more"))
        on = now["thread"].eqNullSafe(upper["t"]) & (now["up"] == upper["c"])
        new = materialize(now.join(upper.hint("shuffle_hash"), on, "left").select(
            "thread", "call_id", F.col("next").alias("up"),
            (F.col("step") + F.coalesce("more", F.lit(0))).alias("step")), "calls-up")
        delete_files(now)
        now, rounds = new, rounds + 1
    return now.select("thread", "call_id", F.when(F.col("up").isNull(), F.col("step")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame,
               schemas: dict[str, dict[str, tuple]] | None = None) -> DataFrame:
    """(thread, place, kind, call_id, status, level, errors, message): a row for each call and each result.

    ``calls``: thread, place, call_id, tool, arguments, after.  ``results``:
    thread, place, call_id, content.  Other columns are not read.

    Status of a call: linked, unanswered, duplicate (its identifier belongs to
    another call of the thread: the least by place, tool and arguments), cycle
    (it follows up itself in the end), or no id.  Of a result: linked or
    orphan (no call has its identifier, or it has none).  A call that follows
    up a call that is not there is a root.  Repeated rows have equal results.
    Level is null for duplicates, cycles, orphans and rows without identifier.
    A null thread is a thread of its own.  Empty tables give no rows.
    """
    schemas = SCHEMAS if schemas is None else schemas
    calls = calls.select("thread", "place", "call_id", "tool", "arguments", "after")
    results = results.select("thread", "place", "call_id", "content")
    own = F.struct("place", "tool", "arguments", "after")
    owners = (calls.where("call_id is not null").groupBy("thread", "call_id").agg(F.min(own).alias("own")))
    answers = (results.where("call_id is not null").groupBy(F.col("thread").alias("rt"), F.col("call_id").alias("rc"))
               .agg(F.count("*").alias("answers")))
    ids = materialize(owners.join(answers.hint("shuffle_hash"), F.col("thread").eqNullSafe(F.col("rt")) & (F.col("call_id") == F.col("rc")), "left")
                      .select("thread", "call_id", "own", F.coalesce("answers", F.lit(0)).alias("answers")), "calls-ids")
    parent = ids.select(F.col("thread").alias("pt"), F.col("call_id").alias("pc"), F.col("answers").alias("above"))
    nodes = ids.join(parent.hint("shuffle_hash"), F.col("thread").eqNullSafe(F.col("pt")) & (F.col("own.after") == F.col("pc")), "left").select(
        "thread", "call_id", F.col("pc").alias("up"),
        F.when(F.col("pc").isNull(), 0).when(F.col("above") > 0, 2).otherwise(1).cast("long").alias("step"))
    level = levels_of(nodes).select(F.col("thread").alias("lt"), F.col("call_id").alias("lc"), "level")
    known = materialize(ids.join(level.hint("shuffle_hash"), F.col("thread").eqNullSafe(F.col("lt")) & (F.col("call_id") == F.col("lc")))
                        .select(F.col("thread").alias("kt"), F.col("call_id").alias("kc"), "own", "answers", "level"), "calls-known")
    on = F.col("thread").eqNullSafe(F.col("kt")) & (F.col("call_id") == F.col("kc"))

    first = own.eqNullSafe(F.col("own"))
    status = (F.when(F.col("call_id").isNull(), "no id").when(~first, "duplicate")
              .when(F.col("level").isNull(), "cycle").when(F.col("answers") > 0, "linked").otherwise("unanswered"))
    message = F.to_json(F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"),
                                 F.col("tool").alias("name"), F.lit("call").alias("type")))
    call_rows = calls.join(known.hint("shuffle_hash"), on, "left").select(
        "thread", "place", F.lit("call").alias("kind"), "call_id", status.alias("status"),
        F.when(first, F.col("level")).alias("level"),
        argument_errors(F.col("tool"), F.col("arguments"), schemas).alias("errors"), message.alias("message"))
    answer = F.to_json(F.struct(F.col("content"), F.col("call_id").alias("id"), F.lit("result").alias("type")))
    result_rows = results.join(known.hint("shuffle_hash"), on, "left").select(
        "thread", "place", F.lit("result").alias("kind"), "call_id",
        F.when(F.col("kc").isNull(), "orphan").otherwise("linked").alias("status"),
        (F.col("level") + 1).alias("level"), F.lit(None).cast("array<string>").alias("errors"), answer.alias("message"))
    return call_rows.unionByName(result_rows)
