"""Tool-call linking: calls and results joined by identifier, ordered, validated, serialised.

Results join their calls on the call id.  A call lists the ids it depends on; within
a conversation calls come in an order in which every call follows its dependencies.
Where all dependencies lie at earlier turns the turns are that order; other
conversations are layered (a call's layer is one above its highest dependency): those
of at most ``WHOLE`` calls without ties to other conversations inside one task each,
the rest round by round, each round a join.  Arguments are checked against the JSON schema of
the called tool, and every call becomes one canonical JSON message (keys in code
unit order, no white space, shortest numbers).

Defined results, by ``status``: ``answered``, ``unanswered``, ``orphan`` (a result
whose call does not exist), ``cycle`` (a call on or behind a dependency cycle; after
all layers), ``duplicate_id`` (one of several different calls with one id), ``no_id``
(NULL call id).  Equal repeated rows count once; of several results of a call the
one with the smallest (turn, content) is linked.  Dependencies on unknown ids are
dropped from the order but stay in the message.  NULL arguments are an empty object,
NULL content is JSON null.  A half of a surrogate pair that stands alone in a JSON text
is written as its escape (``\\ud800``), in messages and in errors.  A tool without a schema accepts any object.  Empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import persisted, slices

WHOLE = 20_000  # calls of a conversation that one task puts in order
TYPES = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}


def number(x: float) -> str:
    if not math.isfinite(x):
        raise ValueError("number out of range")
    if x == int(x) and abs(x) < 1e21:
        return str(int(x))
    mantissa, _, exponent = repr(x).partition("e")
    return f"{mantissa}e{'+' if int(exponent) > 0 else ''}{int(exponent)}" if exponent else mantissa


def canonical(value: object) -> str:
    """JSON with keys in UTF-16 code unit order, no white space and shortest numbers."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        return number(value)
    return json.dumps(value, ensure_ascii=False)


def writable(text: str) -> str:
    """The text with lone surrogates as escapes, so that it can be written as UTF-8."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m.group()):04x}", text)


def fits(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        ok = isinstance(value, int | float) and not isinstance(value, bool)
        return ok and (kind == "number" or value == int(value))
    return kind in TYPES and isinstance(value, TYPES[kind])


def violations(value: object, schema: dict, at: str = "$") -> list[str]:
    """Where ``value`` breaks a JSON schema (type, enum, bounds, lengths, properties, items)."""
    kinds = schema.get("type")
    if kinds is not None and not any(fits(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: not {kinds if isinstance(kinds, str) else ' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if fits(value, "number"):
        out += [f"{at}: below {schema['minimum']}"] if "minimum" in schema and value < schema["minimum"] else []
        out += [f"{at}: above {schema['maximum']}"] if "maximum" in schema and value > schema["maximum"] else []
    if isinstance(value, str | list):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        out += [f"{at}: shorter than {schema[low]}"] if len(value) < schema.get(low, 0) else []
        out += [f"{at}: longer than {schema[high]}"] if len(value) > schema.get(high, math.inf) else []
    if isinstance(value, list) and "items" in schema:
        out += [v for i, x in enumerate(value) for v in violations(x, schema["items"], f"{at}[{i}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    return out


def layers_inside(edges: DataFrame) -> DataFrame:
    """(call_id, layer, cycle) of calls (conv_id, call_id, needs; ``needs`` NULL in a row of
    its own for every call) whose dependencies all lie in their own conversation, a task
    a conversation.  Calls are taken away layer by layer; what stays is on or behind a cycle."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        calls = sorted(set(group["call_id"]))
        waits, after = dict.fromkeys(calls, 0), {c: [] for c in calls}
        for call, needs in {(c, n) for c, n in zip(group["call_id"], group["needs"], strict=True) if isinstance(n, str)}:
            waits[call] += 1
            after[needs].append(call)
        free, layer, done = [c for c in calls if not waits[c]], 0, []
        while free:
            done += [(c, layer, False) for c in free]
            freed = []
            for c in free:
                for x in after[c]:
                    waits[x] -= 1
                    if not waits[x]:
                        freed.append(x)
            free, layer = freed, layer + 1
        known = {c for c, *_ in done}
        return pd.DataFrame(done + [(c, layer, True) for c in calls if c not in known], columns=["call_id", "layer", "cycle"])

    return edges.groupBy("conv_id").applyInPandas(run, "call_id string, layer bigint, cycle boolean")


def layers(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(call_id, layer, cycle) of the calls in conversations with a dependency that is
    not at an earlier turn.  One round a layer; what never gets free is a cycle."""
    open_ = persisted(calls.select("call_id"))
    edges, done, layer = persisted(edges), None, 0
    while not open_.isEmpty():
        blocked = edges.join(open_.select(F.col("call_id").alias("needs")), "needs", "left_semi").select("call_id").distinct()
        free = persisted(open_.join(blocked, "call_id", "left_anti"))
        stuck = free.isEmpty()
        now = (open_ if stuck else free).select("call_id", F.lit(layer).cast("bigint").alias("layer"), F.lit(stuck).alias("cycle"))
        done = now if done is None else done.union(now)
        if stuck:
            break
        open_, layer = persisted(open_.join(free, "call_id", "left_anti")), layer + 1
    return done if done is not None else calls.select("call_id", F.lit(0).cast("bigint").alias("layer"), F.lit(False).alias("cycle"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row a call, and one for each orphan result.

    calls: conv_id, turn, call_id, name, arguments (JSON), depends_on (array of ids);
    results: conv_id, turn, call_id, content; schemas: JSON schema by tool name."""
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    results = results.select("conv_id", "turn", "call_id", "content")
    # ids, order and duplicates need no texts: a slim table of the distinct calls
    slim = persisted(calls.select("conv_id", "turn", "call_id", "depends_on", F.xxhash64("name", "arguments").alias("said")).distinct())
    known = slim.filter("call_id IS NOT NULL").groupBy("call_id").agg(F.count("*").alias("same_id"), F.min("turn").alias("at"))
    needs = slim.select("conv_id", "call_id", "turn", F.explode("depends_on").alias("needs"))
    needs = needs.join(known.select(F.col("call_id").alias("needs"), "at"), "needs").filter("call_id IS NOT NULL")
    late = persisted(needs.filter("NOT at < turn").select("conv_id").distinct())
    mixed = slim.join(late, "conv_id", "left_semi").filter("call_id IS NOT NULL").select("call_id").distinct()
    edges = persisted(needs.join(late, "conv_id", "left_semi").select("conv_id", "call_id", "needs").distinct())
    # ids that stand in two conversations, or edges between them, tie conversations together
    homes = slim.filter("call_id IS NOT NULL").groupBy("call_id").agg(F.min("conv_id").alias("home"), F.max("conv_id").alias("other"))
    ends = needs.select("conv_id", "needs").join(homes.withColumnRenamed("call_id", "needs"), "needs")
    tied = ends.filter("conv_id <> home OR home <> other").select(F.explode(F.array("conv_id", "home", "other")).alias("conv_id"))
    tied = tied.union(homes.filter("home <> other").select(F.explode(F.array("home", "other")).alias("conv_id")))
    sizes = slim.join(late, "conv_id", "left_semi").groupBy("conv_id").agg(F.count("*").alias("calls"))
    whole = persisted(sizes.filter(F.col("calls") <= WHOLE).join(tied.distinct(), "conv_id", "left_anti").select("conv_id"))
    alone = slim.filter("call_id IS NOT NULL").join(whole, "conv_id", "left_semi").select("conv_id", "call_id", F.lit(None).cast("string").alias("needs")).distinct()
    inside = layers_inside(alone.union(edges.join(whole, "conv_id", "left_semi").select("conv_id", "call_id", "needs")))
    rest = mixed.join(alone.select("call_id"), "call_id", "left_anti")
    layered = inside.union(layers(rest, edges.join(whole, "conv_id", "left_anti").select("call_id", "needs").distinct()))
    first = results.filter("call_id IS NOT NULL").groupBy("call_id").agg(F.min(F.struct("turn", "conv_id", "content")).alias("r"))
    about = known.select("call_id", "same_id").join(layered, "call_id", "left")
    rows = calls.distinct().join(first, "call_id", "left").join(about, "call_id", "left")
    status = F.when(F.col("call_id").isNull(), "no_id").when(F.col("same_id") > 1, "duplicate_id").when(F.col("cycle"), "cycle").when(F.col("r").isNull(), "unanswered").otherwise("answered")
    rows = rows.select("conv_id", "turn", "call_id", "name", "arguments", "depends_on", F.col("r.content").alias("content"), F.coalesce("layer", "turn").alias("order_key"), status.alias("status"))
    lone = results.join(slim.select("call_id"), "call_id", "left_anti").distinct()
    none = F.lit(None).cast("string")
    rows = rows.unionByName(lone.select("conv_id", "turn", "call_id", none.alias("name"), none.alias("arguments"), F.array().cast("array<string>").alias("depends_on"), "content", F.col("turn").alias("order_key"), F.lit("orphan").alias("status")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(slices(batches, "content"), "arguments"):
            errors, messages = [], []
            for r in b.to_pylist():
                wrong, args = [], None
                if r["status"] != "orphan":
                    try:
                        args = json.loads(r["arguments"] if r["arguments"] is not None else "{}", parse_constant=lambda c: float("nan"))
                        canonical(args)
                        wrong = violations(args, {"type": "object"} | schemas.get(r["name"], {}))
                    except (ValueError, RecursionError, OverflowError):
                        args, wrong = None, ["$: not JSON"]
                errors.append([writable(e) for e in wrong])
                messages.append(writable(canonical({"arguments": args, "depends_on": r["depends_on"], "id": r["call_id"], "name": r["name"], "result": r["content"], "status": r["status"]})))
            keep = [b.column(b.schema.get_field_index(c)) for c in ("conv_id", "order_key", "turn", "call_id", "name", "status")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array([not e for e in errors]), pa.array(["; ".join(e) for e in errors]), pa.array(messages)], ["conv_id", "order_key", "turn", "call_id", "name", "status", "valid", "errors", "message"])

    return rows.mapInArrow(run, "conv_id bigint, order_key bigint, turn bigint, call_id string, name string, status string, valid boolean, errors string, message string")


# The tools of a plain conversation: a system turn sets it up, a user turn asks.
SCHEMAS = {
    "configure": {"type": "object", "properties": {"instructions": {"type": "string", "minLength": 1}}, "required": ["instructions"], "additionalProperties": False},
    "reply": {"type": "object", "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}, "required": ["prompt", "turn"], "additionalProperties": False},
}


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of (conv_id, turn, role, text): system and user turns are
    calls that depend on the two turns before them as far as these are calls; an
    assistant turn is the result of the turn before it."""
    t = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    at = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - back).cast("string"))
    arguments = F.when(F.col("role") == "system", F.to_json(F.struct(F.col("text").alias("instructions")))).otherwise(F.to_json(F.struct(F.col("text").alias("prompt"), "turn")))
    before = F.filter(F.array(F.when(F.col("turn") >= 2, at(2)), F.when(F.col("turn") >= 1, at(1))), lambda x: x.isNotNull())
    calls = t.filter(F.col("role").isin("system", "user")).select("conv_id", "turn", at(0).alias("call_id"), F.when(F.col("role") == "system", "configure").otherwise("reply").alias("name"), arguments.alias("arguments"), before.alias("depends_on"))
    results = t.filter(F.col("role") == "assistant").select("conv_id", "turn", at(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
