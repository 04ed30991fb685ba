"""Chat formatting with linked tool calls.

Messages have (conv_id, turn, role, text, calls, call_id): ``calls`` is an array of (id, name, arguments)
that an assistant makes, ``call_id`` says which call a message of role ``tool`` answers. Calls and
results are joined by conversation and identifier; calls whose arguments name other calls' results
(``"$id"`` as a value) are put after them by peeling the reference graph level by level; arguments are
checked against the tools' schemas; and every message becomes one line of canonical JSON (sorted keys,
no blanks, plain UTF-8) in which a call carries its result.

A conversation may hold a third of all rows: nothing gathers a conversation in one task. Rows of one
message are the largest group. Order within a conversation is (level, turn): a call's level is over
those of the calls it refers to.

Defined cases: of calls that share an identifier in a conversation the first by turn and place counts,
the others are errors ("repeated id"); of several results the first by turn counts; a result without a
call is kept as a message with the error "orphan result"; a call without a result has the result null and
the error "no result"; calls that refer to each other in a circle have level null and the error "cycle";
references to unknown calls are errors ("unknown reference"); a null text is the empty string; null
identifiers link nothing; repeated rows give repeated messages; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.ship import ship
from quillspark.session import stage

CALLS = "array<struct<id:string,name:string,arguments:string>>"
_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def schema_error(value, schema: dict, at: str = "") -> str | None:
    """The first violation of a JSON schema (type, enum, minimum, maximum, required, properties, items, additionalProperties)."""
    kind = schema.get("type")
    where = at or "arguments"
    if kind and (not isinstance(value, _TYPES[kind]) or (isinstance(value, bool) and kind in ("integer", "number"))):
        return f"{where}: not {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{where}: not in enum"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            return f"{where}: under minimum"
        if value > schema.get("maximum", value):
            return f"{where}: over maximum"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in sorted(schema.get("required", ())):
            if name not in value:
                return f"{where}: {name} is missing"
        for name in sorted(value):
            if name in known:
                if error := schema_error(value[name], known[name], f"{at}.{name}" if at else name):
                    return error
            elif schema.get("additionalProperties", True) is False:
                return f"{where}: {name} is unknown"
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            if error := schema_error(x, schema["items"], f"{where}[{k}]"):
                return error
    return None


def _references(value, found: set[str]) -> set[str]:
    if isinstance(value, str) and value.startswith("$") and len(value) > 1:
        found.add(value[1:])
    for x in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
        _references(x, found)
    return found


def checked_call(name: str | None, arguments: str | None, tools: dict[str, dict]) -> tuple[str | None, str | None, list[str]]:
    """(canonical arguments, error, references) of one call."""
    try:
        value = json.loads(arguments or "")
    except ValueError:
        return None, "arguments: not JSON", []
    refs = sorted(_references(value, set()))
    if name not in tools:
        return canonical(value), "unknown tool", refs
    # a reference stands for a value that is not known yet
    plain = {k: v for k, v in tools[name].get("properties", {}).items()}
    shape = tools[name]
    if isinstance(value, dict):
        held = {k for k, v in value.items() if isinstance(v, str) and v.startswith("$") and len(v) > 1}
        shape = tools[name] | {"properties": {k: ({} if k in held else v) for k, v in plain.items()}}
    return canonical(value), schema_error(value, shape), refs


def levels(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(conv_id, id, level): level 0 has no edge, others come after all calls they refer to.

    ``edges`` (conv_id, id, ref) between known nodes. Each round peels the calls whose references are
    all placed; what is left at the end lies on or behind a circle and has no row.
    """
    edges = stage(edges.distinct(), "tool-edges")
    left = nodes.join(edges.select("conv_id", "id").distinct(), ["conv_id", "id"], "left_anti").select("conv_id", "id")
    placed = stage(left.distinct().withColumn("level", F.lit(0)), "tool-levels")
    out, level = placed, 0
    while not edges.isEmpty():
        level += 1
        rest = stage(edges.join(placed.select("conv_id", F.col("id").alias("ref")), ["conv_id", "ref"], "left_anti"), "tool-edges")
        free = edges.select("conv_id", "id").distinct().join(rest.select("conv_id", "id").distinct(), ["conv_id", "id"], "left_anti")
        placed = stage(free.withColumn("level", F.lit(level)), "tool-levels")
        if placed.isEmpty():
            break
        out, edges = out.unionByName(placed), rest
    return out


def link_tools(messages: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """conv_id, turn, level, role, n_calls, n_errors, errors and json of every message."""
    spark = messages.sparkSession
    ship(spark)
    shapes = spark.sparkContext.broadcast(tools)
    base = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.col("calls").cast(CALLS).alias("calls"), "call_id")
    # one number per message, fixed by writing it
    base = stage(base.withColumn("message", F.monotonically_increasing_id()), "tool-messages")

    @F.pandas_udf("arguments string, error string, refs array<string>")
    def check(name: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for names, arguments in name:
            yield pd.DataFrame([checked_call(a, b, shapes.value) for a, b in zip(names, arguments, strict=True)], columns=["arguments", "error", "refs"])

    calls = base.select("message", "conv_id", "turn", F.posexplode("calls").alias("place", "call")).select("message", "conv_id", "turn", "place", "call.*")
    calls = stage(calls.withColumn("c", check("name", "arguments")).select("message", "conv_id", "turn", "place", "id", "name", "c.arguments", "c.error", "c.refs"), "tool-calls")
    first = calls.where("id IS NOT NULL").groupBy("conv_id", "id").agg(F.min(F.struct("turn", "message", "place")).alias("f"))
    answers = base.where((F.col("role") == "tool") & F.col("call_id").isNotNull())
    answers = answers.groupBy("conv_id", F.col("call_id").alias("id")).agg(F.min(F.struct("turn", "message", "text")).alias("a"))
    known = stage(first.join(answers, ["conv_id", "id"], "left").select("conv_id", "id", "f", "a"), "tool-known")

    wanted = calls.join(known.select("conv_id", "id", "f"), ["conv_id", "id"]).where("f.message = message AND f.place = place")
    wanted = wanted.select("conv_id", "id", F.explode("refs").alias("ref"))
    edges = wanted.join(known.select("conv_id", F.col("id").alias("ref"), F.lit(True).alias("there")), ["conv_id", "ref"], "left")
    edges = stage(edges, "tool-references")
    unknown = edges.where("there IS NULL").groupBy("conv_id", "id").agg(F.lit(True).alias("lost"))
    level = levels(edges.where("there").select("conv_id", "id", "ref"), known)

    linked = calls.join(known, ["conv_id", "id"], "left").join(level, ["conv_id", "id"], "left").join(unknown, ["conv_id", "id"], "left")
    counts = F.coalesce((F.col("f.message") == F.col("message")) & (F.col("f.place") == F.col("place")), F.lit(False))
    error = (
        F.when(F.col("id").isNull(), "no id").when(~counts, "repeated id").when(F.col("error").isNotNull(), F.col("error")).when(F.col("lost"), "unknown reference")
        .when(F.col("level").isNull(), "cycle").when(F.col("a").isNull(), "no result")
    )
    linked = linked.select("message", "place", "id", "name", "arguments", error.alias("error"), F.when(counts, F.col("a.text")).alias("result"), F.when(counts, F.col("level")).alias("level"))
    item = F.struct("place", "id", "name", "arguments", "error", "result", "level")
    per = linked.groupBy("message").agg(F.sort_array(F.collect_list(item)).alias("linked"))

    orphans = base.where("role = 'tool'").join(known.select("conv_id", F.col("id").alias("call_id"), F.lit(True).alias("asked")), ["conv_id", "call_id"], "left")
    orphans = orphans.where("asked IS NULL").select("message", F.lit(True).alias("orphan"))
    used = known.where("a IS NOT NULL").select(F.col("a.message").alias("message"), F.lit(True).alias("folded"))
    # a result stands right behind its call: the level of the call it answers
    after = used.join(known.where("a IS NOT NULL").select(F.col("a.message").alias("message"), "conv_id", "id"), "message").join(level, ["conv_id", "id"], "left").select("message", "folded", F.col("level").alias("own"))
    rows = base.join(per, "message", "left").join(orphans, "message", "left").join(after, "message", "left")

    @F.pandas_udf("string")
    def line(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for roles, texts, ids, lists in parts:
            out = []
            for role, text, call_id, linked in zip(roles, texts, ids, lists, strict=True):
                value = {"role": role, "content": text}
                if role == "tool":
                    value["tool_call_id"] = call_id
                if linked is not None and len(linked):
                    value["tool_calls"] = [
                        {"id": x["id"], "name": x["name"], "arguments": None if x["arguments"] is None else json.loads(x["arguments"]), "result": x["result"], "error": x["error"]} for x in linked
                    ]
                out.append(canonical(value))
            yield pd.Series(out)

    errors = F.filter(F.concat(F.coalesce(F.transform("linked", lambda x: x["error"]), F.array().cast("array<string>")), F.array(F.when(F.col("orphan"), "orphan result"))), lambda e: e.isNotNull())
    top = F.when(F.size("linked") > 0, F.array_max(F.transform("linked", lambda x: x["level"]))).when(F.col("folded"), F.col("own")).otherwise(F.lit(0))
    return rows.select(
        "conv_id", "turn", top.alias("level"), "role", F.greatest(F.coalesce(F.size("linked"), F.lit(0)), F.lit(0)).alias("n_calls"),
        F.size(errors).alias("n_errors"), errors.alias("errors"), line("role", "text", "call_id", "linked").alias("json"),
    )


#: The tools of the derived messages.
TOOLS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False, "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 500}}},
    "count": {"type": "object", "required": ["unit"], "properties": {"unit": {"type": "string", "enum": ["word", "line"]}, "of": {"type": "string"}}},
}


def derived_messages(conversations: DataFrame) -> DataFrame:
    """Messages with calls and results from plain conversations, by rule.

    A user turn is kept, and the assistant asks a tool about it under the id ``c<turn>``; an assistant turn
    is the result for the turn before it. A ``count`` call refers to the call two turns earlier.
    """
    turn, text = F.col("turn"), F.coalesce("text", F.lit(""))
    search = F.to_json(F.struct(F.length(text).alias("limit"), F.substring_index(text, " ", 1).alias("query")))
    count = F.to_json(F.struct(F.when(F.crc32(text.cast("binary")) % 5 == 0, "page").otherwise("word").alias("unit"), F.concat(F.lit("$c"), (turn - 2).cast("string")).alias("of")))
    counting = F.crc32(text.cast("binary")) % 3 == 0
    call = F.struct(F.concat(F.lit("c"), turn.cast("string")).alias("id"), F.when(counting, "count").otherwise("search").alias("name"), F.when(counting, count).otherwise(search).alias("arguments"))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    return conversations.select(
        "conv_id", "turn", F.when(assistant, "tool").otherwise(F.col("role")).alias("role"), "text",
        F.when(user, F.array(call)).otherwise(F.array().cast(CALLS)).alias("calls"), F.when(assistant, F.concat(F.lit("c"), (turn - 1).cast("string"))).alias("call_id"),
    )
