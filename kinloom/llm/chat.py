"""Tool-call linking: calls and results joined by identifier, ordered, validated, serialised.

A message is a row (conv_id, turn, role, text).  An assistant's text may be a JSON object
with ``tool_calls`` (id, name, arguments as JSON text, needs: ids of calls whose results it
uses); a tool's text is a JSON object with ``tool_call_id`` and ``content``.  All other
messages are plain.

* Calls meet results in a hash join on (conversation, identifier), the salt of which is the
  identifier itself: a conversation that holds a third of all rows is many keys.
* Topological levels come from pointer doubling over "needs" edges.  An edge may only point
  to a call of an earlier turn, or of the same turn and an earlier place, so turns bound the
  order; edges that do not are errors of their call and are left out.  The level of a call
  is the longest way from a call without needs.  Doubling along each call's latest need
  gives it in logarithmically many joins for chains of any length; where calls have several
  needs it is a lower bound, from which rounds of "one more than every need" rise to it.
* Arguments are validated against a schema per tool name, and every linked call becomes one
  canonical JSON object: keys sorted, no spaces, shortest numbers.
"""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

_CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,needs:array<string>>>>"
_RESULT = "struct<tool_call_id:string,content:string>"


# ---- validation and serialisation, one row at a time ----------------------

_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
}
# Keywords that ``violations`` judges, and those that only describe.
_JUDGED = {
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength",
    "minItems", "maxItems", "items", "properties", "required", "additionalProperties",
}
_DESCRIBING = {"title", "description", "default", "examples", "$comment"}
_LONE = re.compile("[\ud800-\udfff]")


def refuse_unknown(schema: dict, at: str = "$") -> None:
    """ValueError for a schema that says more than ``violations`` understands."""
    if not isinstance(schema, dict):
        raise ValueError(f"schema at {at} is no object")
    if strange := sorted(schema.keys() - _JUDGED - _DESCRIBING):
        raise ValueError(f"schema at {at} has unsupported keywords: {', '.join(strange)}")
    kinds = schema.get("type", [])
    if strange := sorted(({kinds} if isinstance(kinds, str) else set(kinds)) - _TYPES.keys()):
        raise ValueError(f"schema at {at} has unknown types: {', '.join(strange)}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"schema at {at}: additionalProperties must be true or false")
    for key, below in schema.get("properties", {}).items():
        refuse_unknown(below, f"{at}.{key}")
    if "items" in schema:
        refuse_unknown(schema["items"], f"{at}[]")


def escaped(text: str) -> str:
    """Lone surrogates, which no UTF-8 text can hold, as JSON escapes."""
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a value: type, enum, bounds, lengths, required and unknown keys, items."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):  # 1 is not true
        found.append(f"{at}: not in enum")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        found.append(f"{at}: not the constant")
    if _TYPES["number"](value):
        if value < schema.get("minimum", value):
            found.append(f"{at}: too small")
        if value > schema.get("maximum", value):
            found.append(f"{at}: too large")
        if "exclusiveMinimum" in schema and value <= schema["exclusiveMinimum"]:
            found.append(f"{at}: too small")
        if "exclusiveMaximum" in schema and value >= schema["exclusiveMaximum"]:
            found.append(f"{at}: too large")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        found.append(f"{at}: length")
    if isinstance(value, list) and not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", math.inf):
        found.append(f"{at}: number of items")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}: lacks {key}" for key in schema.get("required", []) if key not in value]
        if schema.get("additionalProperties", True) is False:
            found += [f"{at}: unknown {key}" for key in sorted(value) if key not in known]
        for key in sorted(known):
            if key in value:
                found += violations(value[key], known[key], f"{at}.{key}")
    return found


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, whole numbers without fraction, text unescaped where allowed."""

    def plain(v):
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        if isinstance(v, list):
            return [plain(x) for x in v]
        return int(v) if isinstance(v, float) and v.is_integer() and abs(v) < 2**53 else v

    return escaped(json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False))


def checked(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[object, list[str]]:
    """(parsed arguments or None, what is wrong with them)."""
    if name not in schemas:
        return None, ["unknown tool"]
    try:
        value = json.loads(arguments or "")
        canonical(value)
        return value, [escaped(e) for e in violations(value, schemas[name])]
    except (ValueError, RecursionError):
        return None, ["arguments are not JSON"]


# ---- linking ---------------------------------------------------------------


def calls_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, place, call_id, name, arguments, needs), one row per tool call."""
    rows = messages.filter("role = 'assistant'").select("conv_id", "turn", F.from_json("text", _CALLS).alias("m"))
    rows = rows.select("conv_id", "turn", F.posexplode("m.tool_calls").alias("place", "call"))
    return rows.filter("call.id IS NOT NULL").select(
        "conv_id", "turn", "place", F.col("call.id").alias("call_id"), "call.name", "call.arguments", "call.needs"
    )


def results_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, call_id, content), one row per tool result."""
    rows = messages.filter("role = 'tool'").select("conv_id", "turn", F.from_json("text", _RESULT).alias("m"))
    return rows.filter("m.tool_call_id IS NOT NULL").select(
        "conv_id", "turn", F.col("m.tool_call_id").alias("call_id"), "m.content"
    )


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, bad_needs): the longest way to a call without needs."""
    place = calls.select("conv_id", F.col("call_id").alias("need"), F.struct("turn", "place").alias("need_at"))
    needs = calls.select("conv_id", "call_id", F.struct("turn", "place").alias("at"), F.explode("needs").alias("need"))
    judged = written(
        needs.distinct().join(place, ["conv_id", "need"], "left").withColumn(
            "sound", F.col("need_at").isNotNull() & (F.col("need_at") < F.col("at"))
        ),
        "chat-needs",
    )
    latest = judged.groupBy("conv_id", "call_id").agg(
        F.max(F.when(F.col("sound"), F.struct("need_at", "need"))).alias("last"),
        F.sum(F.when(F.col("sound"), 0).otherwise(1)).alias("bad_needs"),
    )
    jump = calls.select("conv_id", "call_id").join(latest, ["conv_id", "call_id"], "left").select(
        "conv_id",
        "call_id",
        F.col("last.need").alias("to"),
        F.when(F.col("last").isNull(), 0).otherwise(1).cast("long").alias("level"),
        F.coalesce("bad_needs", F.lit(0)).cast("long").alias("bad_needs"),
    )
    jump = written(jump, "chat-jump")
    while not jump.filter("to IS NOT NULL").isEmpty():
        over = jump.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("level").alias("more"))
        jump = written(
            jump.join(over, ["conv_id", "to"], "left").select(
                "conv_id", "call_id", F.col("next").alias("to"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level"), "bad_needs"
            ),
            "chat-jump",
        )
    levels = jump.select("conv_id", "call_id", "level", "bad_needs")
    edges = judged.filter("sound").select("conv_id", "call_id", "need")
    if edges.groupBy("conv_id", "call_id").count().filter("count > 1").isEmpty():
        return levels
    while True:
        below = levels.select("conv_id", F.col("call_id").alias("need"), F.col("level").alias("below"))
        least = edges.join(below, ["conv_id", "need"]).groupBy("conv_id", "call_id").agg((F.max("below") + 1).alias("least"))
        raised = levels.join(least, ["conv_id", "call_id"], "left")
        if raised.filter("least > level").isEmpty():
            return levels
        levels = written(raised.select("conv_id", "call_id", F.greatest("level", "least").alias("level"), "bad_needs"), "chat-levels")


def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call and per result without call.

    conv_id, call_id, turn, place, name; level (topological); result_turn; status:
    ``linked``, ``unanswered``, ``orphan`` (a result without call) or ``early`` (the result
    stands before its call); valid and errors of the arguments and needs; json, the
    canonical object of a call, null for orphans.

    Of calls repeating an id within a conversation the first in turn order counts, of
    results the first behind its call, or else the first.  Messages with null conv_id form
    no conversation and link to nothing; null or other texts hold no calls.

    A schema with keywords that the validation does not know is refused before any row is
    read.  Numbers of any size are accepted; lone surrogates become JSON escapes.
    """
    for schema in schemas.values():
        refuse_unknown(schema)
    named = messages.select("conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    calls = calls_of(named).groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "place", "name", "arguments", "needs")).alias("c")
    )
    calls = written(calls.select("conv_id", "call_id", "c.*"), "chat-calls")
    results = results_of(named).groupBy("conv_id", "call_id", "turn").agg(F.min("content").alias("content"))
    answers = calls.select("conv_id", "call_id", F.col("turn").alias("call_turn"), F.lit(True).alias("called")).join(
        results, ["conv_id", "call_id"], "full"
    )
    early = F.col("turn") <= F.col("call_turn")
    first = answers.groupBy("conv_id", "call_id").agg(
        F.min(F.when(F.col("turn").isNotNull(), F.struct(early.alias("early"), "turn", "content"))).alias("r"),
        F.max("called").alias("called"),
    )
    rows = first.join(calls, ["conv_id", "call_id"], "left").join(_levels(calls), ["conv_id", "call_id"], "left")
    status = (
        F.when(F.col("called").isNull(), "orphan").when(F.col("r").isNull(), "unanswered")
        .when(F.col("r.early"), "early").otherwise("linked")
    )
    rows = rows.select(
        "conv_id", "call_id", "turn", "place", "name", "arguments", "level", "bad_needs", status.alias("status"),
        F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), "needs",
    )

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            valid, errors, texts = [], [], []
            for row in batch.to_pylist():
                if row["status"] == "orphan":
                    valid.append(None), errors.append([]), texts.append(None)
                    continue
                value, wrong = checked(row["name"], row["arguments"], schemas)
                if row["bad_needs"]:
                    wrong = [*wrong, f"{row['bad_needs']} needs are unknown or later"]
                whole = {
                    "id": row["call_id"],
                    "name": row["name"],
                    "arguments": row["arguments"] if value is None else value,
                    "needs": sorted(n for n in row["needs"] or [] if n is not None),
                    "result": row["content"],
                    "status": row["status"],
                }
                valid.append(not wrong), errors.append(wrong), texts.append(canonical(whole))
            kept = [batch.column(n) for n in ("conv_id", "call_id", "turn", "place", "name", "level", "result_turn", "status")]
            new = [pa.array(valid, pa.bool_()), pa.array(errors, pa.list_(pa.string())), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays([*kept, *new], _NAMES)

        return step

    kinds = dict(rows.dtypes)
    kept = ", ".join(f"{n} {kinds[n]}" for n in _NAMES[:8])
    return map_batches(rows, make, f"{kept}, valid boolean, errors array<string>, json string")


_NAMES = ["conv_id", "call_id", "turn", "place", "name", "level", "result_turn", "status", "valid", "errors", "json"]


# ---- messages with tool calls, derived from plain conversations -------------

# The three tools that derived conversations use.
SCHEMAS = {
    "search": {
        "type": "object",
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "count_words": {
        "type": "object",
        "properties": {"text": {"type": "string"}, "limit": {"type": "integer"}},
        "required": ["text"],
    },
    "translate": {
        "type": "object",
        "properties": {"text": {"type": "string"}, "to": {"enum": ["de", "en", "es", "fr"]}},
        "required": ["text", "to"],
    },
}


def with_tool_calls(conversations: DataFrame) -> DataFrame:
    """Conversations whose assistant turns call a tool and whose user turns answer the call before.

    The tool follows from the text's length; the arguments hold the text; a call needs the
    call of the assistant turn before it.  Everything comes from the given rows.
    """
    turn, chars = F.col("turn"), F.char_length("text")
    call_id = lambda at: F.concat(F.lit("call-"), at.cast("string"))
    name = F.element_at(F.array(*map(F.lit, sorted(SCHEMAS))), (chars % 3 + 1).cast("int"))
    arguments = F.to_json(
        F.struct(
            F.when(name == "search", F.col("text")).alias("query"),
            F.when(name != "search", F.col("text")).alias("text"),
            F.when(name != "translate", chars % 60).alias("limit"),
            F.when(name == "translate", F.element_at(F.array(*map(F.lit, ["de", "en", "es", "fr", "it"])), (chars % 5 + 1).cast("int"))).alias("to"),
        )
    )
    needs = F.when(turn >= 2, F.array(call_id(turn - 2))).otherwise(F.array().cast("array<string>"))
    call = F.to_json(
        F.struct(F.array(F.struct(call_id(turn).alias("id"), name.alias("name"), arguments.alias("arguments"), needs.alias("needs"))).alias("tool_calls"))
    )
    answer = F.to_json(F.struct(call_id(turn - 1).alias("tool_call_id"), F.col("text").alias("content")))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "assistant", call).when(F.col("role") == "user", answer).otherwise(F.col("text")).alias("text"),
    )
