"""Tool calls of conversations: linked to their results, ordered, validated, as canonical JSON."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Mapping
from decimal import Decimal
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pursewatch.llm.common import stored

SERIALISED = (
    "conv_id long, call_id string, kind string, depth long, turn long, status string, problems string, message string"
)

#: The types of JSON Schema that are checked.
_TYPES = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def canonical(value: Any) -> str:
    """JSON with sorted keys, no spaces, and one spelling of each number."""
    if isinstance(value, dict):
        inner = (f"{canonical(str(k))}:{canonical(value[k])}" for k in sorted(value))
        return "{" + ",".join(inner) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("not a JSON number")
        if value.is_integer() and abs(value) < 2**53:
            return str(int(value))
        return repr(value)
    return json.dumps(value, ensure_ascii=False)


#: Keywords of JSON Schema that are checked, and those that say nothing about values.
CHECKED = {
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf",
    "minLength", "maxLength", "pattern", "minItems", "maxItems", "uniqueItems", "items",
    "properties", "required", "additionalProperties", "minProperties", "maxProperties",
    "allOf", "anyOf", "oneOf", "not",
}
SILENT = {"title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "$schema", "$id", "$comment"}


def checked_schema(schema: Any, path: str = "#") -> None:
    """Raise on a keyword that ``problems`` would pass over, anywhere in a schema."""
    if isinstance(schema, bool):
        return
    if not isinstance(schema, Mapping):
        raise ValueError(f"{path}: no schema")
    unknown = sorted(set(schema) - CHECKED - SILENT)
    if unknown:
        raise ValueError(f"{path}: keywords that are not checked: {', '.join(unknown)}")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind not in _TYPES:
            raise ValueError(f"{path}: no type {kind}")
    re.compile(schema.get("pattern", ""))
    for name in ("items", "additionalProperties", "not"):
        if name in schema:
            checked_schema(schema[name], f"{path}/{name}")
    for k, inner in schema.get("properties", {}).items():
        checked_schema(inner, f"{path}/properties/{k}")
    for name in ("allOf", "anyOf", "oneOf"):
        for k, inner in enumerate(schema.get(name, ())):
            checked_schema(inner, f"{path}/{name}/{k}")


def _number_problems(value: float, schema: Mapping[str, Any]) -> list[str]:
    found = []
    if value < schema.get("minimum", value):
        found.append("below minimum")
    if value > schema.get("maximum", value):
        found.append("above maximum")
    if "exclusiveMinimum" in schema and value <= schema["exclusiveMinimum"]:
        found.append("not above minimum")
    if "exclusiveMaximum" in schema and value >= schema["exclusiveMaximum"]:
        found.append("not below maximum")
    # as written in decimals, so that 0.3 is three times 0.1
    if "multipleOf" in schema and Decimal(str(value)) % Decimal(str(schema["multipleOf"])):
        found.append("no multiple")
    return found


def problems(value: Any, schema: Any, path: str = "$") -> list[str]:
    """What in a value is against a schema of the ``CHECKED`` keywords."""
    if isinstance(schema, bool):
        return [] if schema else [f"{path}: not allowed"]
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        found.append(f"{path}: not in enum")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        found.append(f"{path}: not the constant")
    if _TYPES["number"](value):
        found += [f"{path}: {p}" for p in _number_problems(value, schema)]
    if isinstance(value, str | list | dict):
        kind = "Length" if isinstance(value, str) else "Items" if isinstance(value, list) else "Properties"
        if len(value) < schema.get(f"min{kind}", 0):
            found.append(f"{path}: too short")
        if len(value) > schema.get(f"max{kind}", len(value)):
            found.append(f"{path}: too long")
    if isinstance(value, str) and not re.search(schema.get("pattern", ""), value):
        found.append(f"{path}: not the pattern")
    if isinstance(value, list):
        if schema.get("uniqueItems") and len(set(map(canonical, value))) < len(value):
            found.append(f"{path}: repeated items")
        for k, v in enumerate(value):
            found += problems(v, schema.get("items", True), f"{path}[{k}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{path}.{k}: missing" for k in sorted(schema.get("required", ())) if k not in value]
        rest = schema.get("additionalProperties", True)
        for k in sorted(value):
            if k in known:
                found += problems(value[k], known[k], f"{path}.{k}")
            elif rest is False:
                found.append(f"{path}.{k}: unknown")
            else:
                found += problems(value[k], rest, f"{path}.{k}")
    for inner in schema.get("allOf", ()):
        found += problems(value, inner, path)
    for name, fits in (("anyOf", lambda n: n > 0), ("oneOf", lambda n: n == 1)):
        if name in schema and not fits(sum(not problems(value, inner, path) for inner in schema[name])):
            found.append(f"{path}: not {'any' if name == 'anyOf' else 'one'} of the schemas")
    if "not" in schema and not problems(value, schema["not"], path):
        found.append(f"{path}: not allowed")
    return found


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def read_arguments(text: str | None) -> Any:
    return json.loads(text or "", parse_constant=_no_constant)


def _edges(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, before: every call that a call names as one it comes after and that is there."""
    named = F.col("after")
    if not isinstance(calls.schema["after"].dataType, T.ArrayType):
        named = F.array(named)
    told = calls.select("conv_id", "call_id", F.explode(F.array_distinct(named)).alias("before"))
    there = calls.select("conv_id", F.col("call_id").alias("before"))
    return told.join(there, ["conv_id", "before"], "left_semi")


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth: the most calls in a row that must come before; null in or behind a cycle.

    ``after`` names the call, or an array of calls, that a call comes after; those that are not in
    the conversation do not count, and a call that comes after none has depth 0. Runs of calls with
    one predecessor each are walked by pointer doubling: each round every call looks twice as far, so
    a chain of n calls takes log2 n rounds, each a join of small rows written to the shared folder.
    Calls with several predecessors then take the longest way to each, one round per level of such
    calls.
    """
    key = ["conv_id", "call_id"]
    edges = stored(_edges(calls), "edges")
    preds = edges.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("before").alias("before"))
    own = calls.select(*key).join(preds, key, "left")
    one = F.col("n") == 1
    now = own.select(*key, F.when(one, F.col("before")).alias("ahead"), F.when(one, 1).otherwise(0).cast("long").alias("steps"))
    # ``at`` is where a call's run begins: one without a predecessor, or with several
    now = stored(now.withColumn("at", F.when(F.col("ahead").isNull(), F.col("call_id"))), "ahead")
    total, reach = now.count(), 1
    open_ = now.where("at is null").count()
    while open_ and reach <= total:
        next_ = now.select(
            "conv_id", F.col("call_id").alias("ahead"), F.col("ahead").alias("next"), F.col("steps").alias("more"), F.col("at").alias("found")
        )
        moving = now.where("at is null").join(next_, ["conv_id", "ahead"])
        moving = moving.select(*key, F.col("next").alias("ahead"), (F.col("steps") + F.col("more")).alias("steps"), F.col("found").alias("at"))
        now = stored(now.where("at is not null").unionByName(moving), "ahead")
        open_ = now.where("at is null").count()
        reach *= 2
    runs = now.select(*key, "at", "steps")

    known = own.where("n is null").select("conv_id", F.col("call_id").alias("at"), F.lit(0).cast("long").alias("depth"))
    ways = edges.join(preds.where("n > 1").select(*key, "n"), key).join(
        runs.select("conv_id", F.col("call_id").alias("before"), "at", "steps"), ["conv_id", "before"]
    )
    ways = stored(ways.select(*key, "n", "at", "steps"), "ways")
    if not ways.isEmpty():
        known, held = stored(known, "depths"), -1
        while (size := known.count()) != held:
            held = size
            done = known.select("conv_id", F.col("at").alias("call_id"))
            reached = ways.join(known, ["conv_id", "at"]).groupBy(*key, "n").agg(
                F.count(F.lit(1)).alias("seen"), (F.max(F.col("depth") + F.col("steps")) + 1).alias("depth")
            )
            new = reached.where("seen = n").join(done, key, "left_anti")
            known = stored(known.unionByName(new.select("conv_id", F.col("call_id").alias("at"), "depth")), "depths")
    found = runs.join(known, ["conv_id", "at"], "left")
    return found.select(*key, (F.col("depth") + F.col("steps")).alias("depth"))


def link_calls(
    calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Any]]
) -> DataFrame:
    """One row per message: every call and every result, checked, as canonical JSON.

    ``calls`` has conv_id, call_id, turn, name, arguments (JSON text) and after (the call it must
    follow, or null, or an array of such calls); ``results`` has conv_id, call_id, turn and content. Calls and results are
    joined by conversation and call_id. Returns conv_id, call_id, kind, depth, turn, status,
    problems, message. The order of a conversation is (depth, turn, call_id, kind): a call comes
    after those it depends on, a result right behind its call (it takes the call's depth and turn).

    status of a call: the first that holds of ``duplicate``, ``cycle``, ``unknown tool``,
    ``bad json``, ``invalid`` (against the schema), ``no result``, else ``ok``; of a result:
    ``duplicate``, ``no call``, ``ok``; one that is not linked has its own turn and depth 0.
    ``problems`` joins what the schema finds; a schema with a keyword that is not checked raises. Of several calls of one id the first by turn, then
    name and arguments, is linked and the others are duplicates; likewise results. Rows with a null conv_id or call_id are linked with nothing: such calls have
    ``no result`` at best, such results ``no call``. Empty tables give no rows; other columns are
    ignored. No conversation is gathered: messages stay rows, so one of any length is spread out.
    """
    for schema in schemas.values():
        checked_schema(schema)
    key = ["conv_id", "call_id"]
    keyed = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    calls = calls.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", "turn", "name", "arguments", "after")
    results = results.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", "turn", "content")

    def numbered(rows: DataFrame, *order: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        return stored(rows.where(keyed).withColumn("repeated", nth > 1), "numbered")

    all_calls = numbered(calls, "turn", "name", "arguments", "after")
    all_results = numbered(results, "turn", "content").withColumnRenamed("turn", "result_turn")
    one_call = all_calls.where("not repeated").drop("repeated")
    one_result = all_results.where("not repeated").drop("repeated")
    linked = one_call.join(depths(one_call), key).withColumn("called", F.lit(True))
    linked = linked.join(one_result.withColumn("answered", F.lit(True)), key, "full_outer")
    no_depth = F.lit(0).cast("long")
    apart = [
        all_calls.where("repeated").withColumns({"called": F.lit(True), "depth": no_depth}),
        calls.where(~keyed).withColumns({"called": F.lit(True), "depth": no_depth}),
        all_results.where("repeated").withColumn("answered", F.lit(True)),
        results.where(~keyed).withColumnRenamed("turn", "result_turn").withColumn("answered", F.lit(True)),
    ]
    for rows in apart:
        linked = linked.unionByName(rows, allowMissingColumns=True)
    names = ["depth", "turn", "name", "arguments", "after", "result_turn", "content", "called", "answered", "repeated"]
    return linked.select(*key, *names).mapInArrow(_serialiser(dict(schemas)), SERIALISED)


def _call(row: dict, schemas: Mapping[str, Mapping[str, Any]]) -> dict:
    status, wrong, value = "ok", [], None
    try:
        value = read_arguments(row["arguments"])
        text = canonical(value)
        text.encode()  # half a surrogate pair is no text
    except (ValueError, RecursionError):
        value, text = None, None
    if row["repeated"]:
        status = "duplicate"
    elif row["depth"] is None:
        status = "cycle"
    elif row["name"] not in schemas:
        status = "unknown tool"
    elif text is None:
        status = "bad json"
    else:
        wrong = problems(value, schemas[row["name"]])
        status = "invalid" if wrong else "ok" if row["answered"] else "no result"
    body = {"role": "assistant", "tool_call": {"id": row["call_id"], "name": row["name"]}}
    if row["after"] is not None:
        body["tool_call"]["after"] = row["after"]
    body["tool_call"]["arguments"] = value if text is not None else row["arguments"]
    return {
        "conv_id": row["conv_id"], "call_id": row["call_id"], "kind": "call", "depth": row["depth"],
        "turn": row["turn"], "status": status, "problems": "; ".join(wrong), "message": canonical(body),
    }


def _result(row: dict) -> dict:
    linked = row["called"]
    status = "duplicate" if row["repeated"] else "ok" if linked else "no call"
    body = {"role": "tool", "tool_call_id": row["call_id"], "content": row["content"]}
    return {
        "conv_id": row["conv_id"], "call_id": row["call_id"], "kind": "result",
        "depth": row["depth"] if linked else 0, "turn": row["turn"] if linked else row["result_turn"],
        "status": status, "problems": "", "message": canonical(body),
    }


def _serialiser(schemas: Mapping[str, Mapping[str, Any]]):
    names = ["conv_id", "call_id", "kind", "depth", "turn", "status", "problems", "message"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["called"]:
                    out.append(_call(row, schemas))
                if row["answered"]:
                    out.append(_result(row))
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(list(zip(names, kinds, strict=True))))

    return run
