"""Tool calls in chats: linked, ordered, validated and written as canonical JSON.

Calls and results are hash-joined by conversation and call identifier. Calls that use an earlier
call's result name it; these links form a forest whose depth orders the calls topologically. Depths come from
pointer doubling (every round a call learns its ancestor twice as far away), so a chain of a
thousand calls takes ten joins, and no conversation is ever gathered in one task. Arguments are parsed as JSON variants and
checked against the tool's parameters. Canonical JSON has sorted keys, no spaces, and shortest escapes.

Only DataFrame functions are used. Rows are one per call and one per result that has no call.

Edge cases: of calls with one identifier the earliest counts (by turn, then arguments) and of its results the earliest; further ones are
counted in ``n_repeated``. Rows with a null conversation or identifier link with nothing and are kept as ``no_result`` or ``no_call``.
Arguments that are null or no JSON object are invalid (``not an object``). A call whose parent does not exist is a root. Calls in a cycle
have no depth and the status ``cyclic``. Tools without a schema give ``unknown tool``. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import keep, remove

KEY = ["conv_id", "call_id"]
BROADCAST_TOOLS = 10_000


def first_of(rows: DataFrame, values: Sequence[str], last: str) -> DataFrame:
    """The earliest row of each key, and how many more there are; combined before the exchange."""
    order = F.struct(F.col("turn"), F.col(last))
    return rows.groupBy(*KEY).agg(
        F.min_by(F.struct(*values), order).alias("first"), (F.count(F.lit(1)) - 1).alias("n_more")
    ).select(*KEY, *[F.col(f"first.{v}").alias(v) for v in values], "n_more")


def depths(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, depth`` (1 for roots, null in cycles) of calls with a parent ``after``."""
    spark = calls.sparkSession
    up = calls.select("conv_id", F.col("after").alias("call_id")).filter("call_id is not null").distinct()
    parents = up.join(calls.select(*KEY), KEY).withColumnRenamed("call_id", "after").withColumn("known", F.lit(True))
    start = calls.join(parents, ["conv_id", "after"], "left").select(
        *KEY,
        F.when(F.col("known"), F.col("after")).alias("up"),
        F.when(F.col("known"), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("steps"),
    )
    state, path = keep(start, "depths")
    reach, total = 1, state.count()
    while reach <= 2 * total and not state.filter("up is not null").isEmpty():
        other = state.select(
            "conv_id", F.col("call_id").alias("up"), F.col("up").alias("beyond"), F.col("steps").alias("more")
        )
        settled = state.filter("up is null").select(*KEY, "up", "steps")
        moved = state.filter("up is not null").join(other, ["conv_id", "up"]).select(
            *KEY, F.col("beyond").alias("up"), (F.col("steps") + F.col("more")).alias("steps")
        )
        state, new_path = keep(settled.union(moved), "depths")
        remove(spark, path)
        path, reach = new_path, reach * 2
    return state.select(*KEY, F.when(F.col("up").isNull(), F.col("steps") + 1).alias("depth"))


def problems(arguments: Column, parameters: Column) -> Column:
    """What is wrong with a call's arguments, sorted: missing, mistyped and unknown names."""
    kind = lambda p: F.schema_of_variant(F.element_at(arguments, p["name"]))
    missing = F.filter(parameters, lambda p: p["required"] & ~F.map_contains_key(arguments, p["name"]))
    mistyped = F.filter(
        parameters,
        lambda p: F.map_contains_key(arguments, p["name"]) & ~F.coalesce(kind(p) == p["type"], F.lit(False)),
    )
    names = F.transform(parameters, lambda p: p["name"])
    unknown = F.array_except(F.map_keys(arguments), names)
    return F.sort_array(
        F.concat(
            F.transform(missing, lambda p: F.concat(F.lit("missing "), p["name"])),
            F.transform(mistyped, lambda p: F.concat(p["name"], F.lit(" is not "), p["type"])),
            F.transform(unknown, lambda n: F.concat(F.lit("unknown "), n)),
        )
    )


def quoted(text: Column) -> Column:
    """A JSON string; null stays null."""
    json = F.to_json(F.struct(text.alias("s")))
    return F.when(text.isNotNull(), F.regexp_extract(json, '(?s)^\\{"s":(.*)\\}$', 1))


def canonical(arguments: Column) -> Column:
    """A JSON object with sorted keys from a map of variants."""
    entries = F.transform(
        F.array_sort(F.map_keys(arguments)),
        lambda k: F.concat(quoted(k), F.lit(":"), F.coalesce(F.to_json(F.element_at(arguments, k)), F.lit("null"))),
    )
    return F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))


def link(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """One row per call or unclaimed result, in place in its conversation.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), after. ``results``: conv_id,
    call_id, turn, content, and, if wanted for those without an identifier, name. ``tools``: tool, name, type (as Spark names a variant's type), required.
    """
    asked = first_of(calls.filter("conv_id is not null and call_id is not null"), ["turn", "name", "arguments", "after"], "arguments")
    asked, _ = keep(asked, "calls")
    given = first_of(results.filter("conv_id is not null and call_id is not null"), ["turn", "content"], "content")
    placed = asked.join(depths(asked), KEY)
    right = given.select(*KEY, F.col("turn").alias("result_turn"), "content", F.col("n_more").alias("n_more_results"), F.lit(True).alias("given"))
    joined = placed.withColumn("asked", F.lit(True)).join(right, KEY, "full")
    nameless = calls.filter("conv_id is null or call_id is null").select(
        *KEY, "turn", "name", "arguments", "after", F.lit(0).cast("bigint").alias("n_more"), F.lit(1).cast("bigint").alias("depth"), F.lit(True).alias("asked")
    )
    stray = results.filter("conv_id is null or call_id is null").select(
        *KEY, F.col("turn").alias("result_turn"), "content", *(["name"] if "name" in results.columns else []),
        F.lit(0).cast("bigint").alias("n_more_results"), F.lit(True).alias("given"),
    )
    rows = joined.unionByName(nameless, True).unionByName(stray, True)
    of_tool = tools.groupBy(F.col("tool").alias("name")).agg(
        F.sort_array(F.collect_set(F.struct("name", "type", "required"))).alias("parameters")
    )
    if of_tool.count() <= BROADCAST_TOOLS:
        of_tool = F.broadcast(of_tool)
    parsed = F.from_json("arguments", "map<string,variant>", {"mode": "PERMISSIVE"})
    rows = rows.join(of_tool, "name", "left").withColumn("args", parsed)
    wrong = (
        F.when(F.col("asked").isNull(), F.array().cast("array<string>"))
        .when(F.col("args").isNull(), F.array(F.lit("not an object")))
        .when(F.col("parameters").isNull(), F.array(F.lit("unknown tool")))
        .otherwise(problems(F.col("args"), F.col("parameters")))
    )
    status = (
        F.when(F.col("asked").isNull(), "no_call")
        .when(F.col("depth").isNull(), "cyclic")
        .when(F.col("given").isNull(), "no_result")
        .otherwise("linked")
    )
    rows = rows.withColumn("errors", wrong).withColumn("status", status)
    errors = F.concat(F.lit("["), F.array_join(F.transform("errors", quoted), ","), F.lit("]"))
    null = F.lit("null")
    body = F.concat(
        F.lit('{"arguments":'), F.coalesce(canonical(F.col("args")), null),
        F.lit(',"call_id":'), F.coalesce(quoted(F.col("call_id")), null),
        F.lit(',"content":'), F.coalesce(quoted(F.col("content")), null),
        F.lit(',"errors":'), errors,
        F.lit(',"name":'), F.coalesce(quoted(F.col("name")), null),
        F.lit(',"status":'), quoted(F.col("status")), F.lit("}"),
    )
    return rows.select(
        "conv_id", "call_id", F.coalesce("turn", "result_turn").alias("turn"), "result_turn",
        "depth", "status", F.size("errors").alias("n_errors"),
        (F.coalesce("n_more", F.lit(0)) + F.coalesce("n_more_results", F.lit(0))).alias("n_repeated"),
        body.alias("json"),
    )
