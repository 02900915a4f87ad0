"""Chat formatting: tool calls linked with their results, ordered, validated and serialised."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import store


class Argument(NamedTuple):
    """One argument of a tool: its JSON type and whether a call must have it."""

    name: str
    type: str
    required: bool = True


class Tool(NamedTuple):
    """A tool that calls may name. A set of tools fits into a prompt, so it is a plain list."""

    name: str
    arguments: tuple[Argument, ...]


# JSON types as Spark names them (of a variant's value).
_TYPES = {
    "string": "^STRING$",
    "integer": "^(TINYINT|SMALLINT|INT|BIGINT)$",
    "number": r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(.*)$",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT<",
    "array": "^ARRAY<",
}
# An argument value {"$ref": "<call id>"} stands for that call's result.
_REFERENCE = r'"\$ref"\s*:\s*"([^"]+)"'

# The tool that a user's turn calls, if a conversation holds no explicit calls: the next
# assistant turn answers it.
REPLY = Tool("reply", (Argument("prompt", "string"), Argument("turn", "integer")))


def argument_errors(tool: Column, arguments: Column, tools: Sequence[Tool]) -> Column:
    """What is wrong with a call, as ``array<string>``: ``unknown tool``, ``not an object``,
    ``missing <name>``, ``<name> is not <type>``, ``unexpected <name>``; empty if all is well."""
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit(False))
    none = F.array().cast("array<string>")
    found = F.array(F.lit("unknown tool"))
    for own in tools:
        parts = []
        for a in own.arguments:
            value = F.try_variant_get(parsed, f"$['{a.name}']", "variant")
            kind = F.schema_of_variant(value)
            absent = kind.isNull() | (kind == "VOID")
            parts.append(
                F.when(absent, F.lit(f"missing {a.name}") if a.required else F.lit(None).cast("string"))
                .when(~kind.rlike(_TYPES[a.type]), F.lit(f"{a.name} is not {a.type}"))
            )
        known = F.lit([a.name for a in own.arguments]) if own.arguments else none
        given = F.coalesce(F.json_object_keys(arguments), none)
        extra = F.transform(F.array_sort(F.array_except(given, known)), lambda n: F.concat(F.lit("unexpected "), n))
        named = F.concat(F.filter(F.array(*parts), lambda p: p.isNotNull()) if parts else none, extra)
        found = F.when(tool == own.name, named).otherwise(found)
    return F.when(~is_object, F.array(F.lit("not an object"))).otherwise(found)


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and without white space; null if ``text`` is no JSON."""
    return F.to_json(F.try_parse_json(text))


def explicit_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that messages spell out.

    An assistant's text ``{"tool_calls": [{"id", "name", "arguments"}, ...]}`` holds calls, a tool's
    text ``{"tool_call_id", "content"}`` a result. Other texts hold none.
    """
    calls = messages.where("role = 'assistant'").select(
        "conv_id", "turn",
        F.explode(F.from_json(
            F.get_json_object("text", "$.tool_calls"),
            "array<struct<id:string,name:string,arguments:string>>",
        )).alias("c"),
    ).select("conv_id", "turn", F.col("c.id").alias("call_id"), F.col("c.name").alias("tool"), F.col("c.arguments").alias("arguments"))
    results = messages.where("role = 'tool'").select(
        "conv_id", "turn", F.get_json_object("text", "$.tool_call_id").alias("call_id"),
        F.get_json_object("text", "$.content").alias("content"),
    )
    return calls, results.where("call_id is not null")


def implied_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each user turn as a call of ``REPLY``, each assistant turn as the result of the turn before."""
    def identifier(turn: Column) -> Column:
        return F.concat(F.lit("call_"), F.coalesce(turn.cast("string"), F.lit("null")))

    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), "turn"))
    calls = messages.where("role = 'user'").select(
        "conv_id", "turn", identifier(F.col("turn")).alias("call_id"), F.lit(REPLY.name).alias("tool"),
        arguments.alias("arguments"),
    )
    results = messages.where("role = 'assistant'").select(
        "conv_id", "turn", identifier(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


def _places(calls: DataFrame, results: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level, at, answered)`` of the calls, and their turns.

    ``level`` says how many results, one needing the other, a call waits for, and ``at`` the
    first turn at which all results that it needs are there. Level by level, calls whose
    references are all resolved leave the table, so a round is as small as what still waits;
    calls in or behind a cycle, or with a reference to no call, never leave and have no
    level. Only whether tables are empty reaches the driver.
    """
    key = ["conv_id", "call_id"]

    def same(a: str, b: str, id_a: str = "call_id", id_b: str = "call_id") -> Column:
        return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.{id_a}") == F.col(f"{b}.{id_b}"))

    needs = calls.select(*key, F.explode(F.array_distinct(
        F.regexp_extract_all("arguments", F.lit(_REFERENCE), F.lit(1))
    )).alias("needed")).distinct()
    needs = waiting = store(needs, "chat-needs")
    turns = calls.groupBy(key).agg(F.min("turn").alias("call_turn"))
    answers = results.groupBy(key).agg(F.min("turn").alias("result_turn"), F.lit(True).alias("answered"))
    nodes = turns.alias("n").join(answers.alias("r"), same("n", "r"), "left").select("n.*", "result_turn", "answered")
    first = nodes.alias("n").join(waiting.alias("w"), same("n", "w"), "left_anti").select(
        *key, "call_turn", F.lit(0).alias("level"), F.col("call_turn").alias("at"), "result_turn", "answered"
    )
    if needs.isEmpty():
        return first
    nodes, done, level = store(nodes, "chat-nodes"), store(first, "chat-levels"), 0
    while not waiting.isEmpty():
        level += 1
        still = store(
            waiting.alias("w").join(done.alias("d"), same("w", "d", "needed"), "left_anti"), "chat-needs"
        )
        open_ = still.select(key).distinct()
        free = waiting.select(key).distinct().alias("f").join(open_.alias("w"), same("f", "w"), "left_anti")
        ready = (
            free.alias("f").join(needs.alias("w"), same("f", "w")).join(done.alias("d"), same("w", "d", "needed"))
            .groupBy("f.conv_id", "f.call_id").agg(F.max(F.greatest("at", "result_turn")).alias("ready"))
        )
        freed = store(
            nodes.alias("n").join(ready.alias("f"), same("n", "f")).select(
                "n.conv_id", "n.call_id", "call_turn", F.lit(level).alias("level"),
                F.greatest("call_turn", "ready").alias("at"), "result_turn", "answered",
            ),
            "chat-free",
        )
        if freed.isEmpty():
            break
        waiting, done = still, store(done.union(freed), "chat-levels")
    left = nodes.alias("n").join(done.alias("d"), same("n", "d"), "left_anti").select(
        *key, "call_turn", F.lit(None).cast("int").alias("level"), F.col("call_turn").alias("at"), "result_turn", "answered"
    )
    return done.union(left)


def format_tool_calls(
    messages: DataFrame, calls: DataFrame, results: DataFrame, tools: Sequence[Tool]
) -> DataFrame:
    """Messages, calls and results of conversations as events in order, each as canonical JSON.

    ``messages`` has ``conv_id, turn, role, text``, ``calls`` ``conv_id, turn, call_id, tool, arguments``
    (JSON), ``results`` ``conv_id, turn, call_id, content``. One row per message, call and result:
    ``conv_id, turn, step, kind, call_id, status, errors, json``. Sorting a conversation by ``turn, step,
    kind, call_id, json`` gives an order in which messages come first in their turn, a call comes
    after the results it refers to, and a result after its call: ``turn`` is moved on to the
    first turn where that holds, and ``step`` is twice the call's level, one more for a result.

    ``status``: a call is ``linked`` or ``unanswered``, a result ``linked`` or ``orphan``; a call whose
    references form a cycle or lead nowhere is ``unordered`` and has no ``step``. ``errors``
    lists what its tool's schema finds. ``json`` holds sorted keys and no white space.

    Calls and results meet in a hash join on conversation and identifier; of several with one
    identifier in a conversation the first (by turn, then text) stands for the link, so that
    repeated rows never multiply, but each keeps its own row. Null identifiers link with
    nothing, null texts are JSON nulls, arguments that are no JSON are an error. Null
    conversations are one conversation. Other columns are left out. No message, no row.
    """
    messages = messages.select("conv_id", "turn", "role", "text")
    calls = calls.select("conv_id", "turn", "call_id", "tool", "arguments")
    results = results.select("conv_id", "turn", "call_id", "content")
    places = _places(calls, results).select(
        F.col("conv_id").alias("p_conv"), F.col("call_id").alias("p_call"), "level", "at", "answered"
    )

    def placed(rows: DataFrame) -> DataFrame:
        fits = F.col("conv_id").eqNullSafe(F.col("p_conv")) & (F.col("call_id") == F.col("p_call"))
        return rows.join(places, fits, "left")

    said = messages.select(
        "conv_id", "turn", F.lit(-1).alias("step"), F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"), F.lit("ok").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct(F.col("text").alias("content"), "role"), {"ignoreNullFields": "false"}).alias("json"),
    )
    called = placed(calls).select(
        "conv_id", F.greatest("turn", "at").alias("turn"), (F.col("level") * 2).alias("step"),
        F.lit("call").alias("kind"), "call_id",
        F.when(F.col("p_call").isNotNull() & F.col("level").isNull(), "unordered")
        .when(F.col("answered"), "linked").otherwise("unanswered").alias("status"),
        argument_errors(F.col("tool"), F.col("arguments"), tools).alias("errors"),
        F.to_json(
            F.struct(
                F.coalesce(F.try_parse_json("arguments"), F.to_variant_object(F.array("arguments"))).alias("arguments"),
                F.col("call_id").alias("id"), F.col("tool").alias("name"),
            ), {"ignoreNullFields": "false"},
        ).alias("json"),
    )
    answered = placed(results).select(
        "conv_id", F.greatest("turn", "at").alias("turn"), (F.col("level") * 2 + 1).alias("step"),
        F.lit("result").alias("kind"), "call_id",
        F.when(F.col("p_call").isNull(), "orphan").otherwise("linked").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct("content", F.col("call_id").alias("tool_call_id")), {"ignoreNullFields": "false"}).alias("json"),
    )
    return said.union(called).union(answered)


def format_conversations(messages: DataFrame) -> DataFrame:
    """The events of ``messages``, whose calls are spelled out or implied by turns.

    A turn that belongs to an explicit call or result implies none: messages of role ``tool``
    and assistants' ``tool_calls`` are taken as they are, all others by turns.
    """
    rows = messages.select("conv_id", "turn", "role", "text")
    explicit = explicit_calls(rows)
    spelled = (F.col("role") == "tool") | F.coalesce(
        F.col("text").contains('"tool_calls"') & F.get_json_object("text", "$.tool_calls").isNotNull(), F.lit(False)
    )
    implied = implied_calls(rows.where(~F.coalesce(spelled, F.lit(False))))
    calls, results = (a.union(b) for a, b in zip(explicit, implied, strict=True))
    return format_tool_calls(rows, calls, results, [REPLY])
