"""Chat formatting: tool calls linked with their results, in order, as canonical JSON.

A message's text is plain, or a JSON object in the usual tool format: an
assistant's object with ``tool_calls`` (id, name, arguments - an object, or
text that holds one -, or these under ``function``), and perhaps
``depends_on`` (ids whose results it needs), or a tool's object with
``tool_call_id`` and ``content``.

Calls and results are joined on (conv_id, call id); of several calls with one
id the earliest counts.  A result comes after its call, and a message after
the results it depends on; messages keep their turn's place otherwise.  A
message's place is (place_turn, place_depth): the greatest turn among itself and
all that it needs, directly or not, and the most steps from the message with
that turn to it.  Where every need has a smaller turn this is (turn, 0); only
conversations with another need are ordered, by doubling: round k knows the
needs 2^k steps away and the greatest place among those nearer, so a chain of n
messages takes log n rounds.  What is still needed over as many steps as the
conversation has messages lies on a cycle, or behind one, keeps its turn and is
reported.

Arguments are checked against the tool's schema (required names, types of
properties).  Every message becomes one JSON text with sorted keys and no
spaces.  Conversations are never gathered: messages stay rows, so one
conversation may hold any share of them.  Nothing of an object is left out:
other keys of a message, call or function stay where they were, values keep
their types.  The row's conv_id, role and turn stand in for the object's own,
which are reported where they differ.

Cases: null texts have null content; null conv_ids, turns or ids are linked
with nothing; text that isn't a JSON object, or is one without the names
above, is plain content; ``tool_calls`` that is no list leaves the message plain
and is reported, as are an entry that is no object (kept as it is, no call),
``depends_on`` that is no list, and arguments that are no object (kept as they
are); repeated rows give repeated rows; equal turns share
a place; very long texts stay in their row; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import let, staged

# tools known by default: name -> {"required": [names], "properties": {name: JSON schema type}}
DEFAULT_SCHEMAS = {
    "search": {"required": ["query"], "properties": {"query": "string", "limit": "integer"}},
    "calculator": {"required": ["expression"], "properties": {"expression": "string"}},
    "fetch": {"required": ["url"], "properties": {"url": "string", "timeout": "number"}},
}
SCHEMA_TYPE = "map<string, struct<required: array<string>, properties: map<string, string>>>"
OBJECT = "map<string, variant>"
OWN = ("conv_id", "role", "turn")  # what a message has from its row


def _parsed(text: Column) -> Column:
    """The text as a variant if it looks like a JSON object."""
    return F.when(F.trim(text, F.lit(" \t\n\r")).startswith("{"), F.try_parse_json(text))


def _as_object(arguments: Column) -> Column:
    """Arguments as a variant object, also when they came as text."""
    return F.when(F.schema_of_variant(arguments) == "STRING", F.try_parse_json(arguments.cast("string"))).otherwise(arguments)


def _json_type(kind: Column) -> Column:
    """JSON schema type of a variant type's name."""
    return (
        F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null")
        .when(kind == "BIGINT", "integer").when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "number")
        .when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object").otherwise("other")
    )


def argument_errors(name: Column, arguments: Column, schemas: dict) -> Column:
    """What is wrong with a call's arguments, in the schema's order."""
    table = F.from_json(F.lit(json.dumps(schemas)), SCHEMA_TYPE)

    def against(args: Column, schema: Column) -> Column:
        missing = F.transform(F.filter(F.coalesce(schema.required, F.array()), lambda k: ~F.map_contains_key(args, k)), lambda k: F.concat(F.lit("missing "), k))

        def fits(e: Column) -> Column:
            want, got = F.try_element_at(schema.properties, e.key), _json_type(F.schema_of_variant(e.value))
            return want.isNull() | (want == got) | ((want == "number") & (got == "integer"))

        wrong = F.filter(F.sort_array(F.transform(F.map_entries(args), lambda e: F.struct(e.key.alias("key"), fits(e).alias("fits")))), lambda e: ~e.fits)
        return F.concat(missing, F.transform(wrong, lambda e: F.concat(F.lit("type of "), e.key)))

    is_object = F.schema_of_variant(arguments).startswith("OBJECT")
    known = let(F.try_element_at(table, name), lambda s: F.when(s.isNull(), F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))).otherwise(
        let(arguments.cast("map<string, variant>"), lambda a: against(a, s))))
    return F.when(F.coalesce(is_object, F.lit(False)), known).otherwise(F.array(F.lit("arguments are no object")))


def _json(value: Column) -> Column:
    return F.coalesce(F.to_json(value.cast("variant")), F.lit("null"))


def _object_json(fields: Column) -> Column:
    """JSON of an object with sorted keys, from its values' JSON by key."""
    pair = lambda m: lambda k: F.concat(_json(k), F.lit(":"), F.element_at(m, k))
    return let(fields, lambda m: F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(m)), pair(m)), ","), F.lit("}")))


def _rest(fields: Column, but: Callable[[Column], Column]) -> Column:
    """The JSON by key of an object's values, except the keys that ``but`` holds for."""
    kept = F.map_filter(fields, lambda k, _: ~but(k))
    return F.coalesce(F.transform_values(kept, lambda _, v: _json(v)), F.create_map().cast("map<string, string>"))


def _fields(**values: Column) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def _call(entry: Column, number: Column, schemas: dict) -> Column:
    """An entry of tool_calls: id, is_call, errors, json."""
    text = lambda path: F.try_variant_get(entry, path, "string")
    value = lambda path: F.try_variant_get(entry, path, "variant")
    name, given = F.coalesce(text("$.name"), text("$.function.name")), F.coalesce(value("$.arguments"), value("$.function.arguments"))
    function = F.try_variant_get(entry, "$.function", OBJECT)
    # the function's name and arguments have moved where the call has none of its own
    moved = lambda k: ((k == "name") & text("$.name").isNull()) | ((k == "arguments") & value("$.arguments").isNull())
    left = _rest(function, moved)
    own = lambda k: k.isin("id", "name", "arguments") | ((k == "function") & function.isNotNull())

    def shaped(args: Column) -> Column:
        shown = _fields(arguments=_json(F.coalesce(args, given)), id=_json(text("$.id")), name=_json(name))
        fields = F.map_concat(shown, _rest(F.try_variant_get(entry, "$", OBJECT), own))
        whole = F.when(F.size(left) > 0, F.map_concat(fields, _fields(function=_object_json(left)))).otherwise(fields)
        return F.struct(text("$.id").alias("id"), F.lit(True).alias("is_call"), argument_errors(name, args, schemas).alias("errors"), _object_json(whole).alias("json"))

    other = F.struct(F.lit(None).cast("string").alias("id"), F.lit(False).alias("is_call"), F.array(F.concat(F.lit("entry "), number.cast("string"), F.lit(" is no call"))).alias("errors"), _json(entry).alias("json"))
    is_object = F.coalesce(F.schema_of_variant(entry).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, let(_as_object(given), shaped)).otherwise(other)


def parsed_messages(conversations: DataFrame, schemas: dict) -> DataFrame:
    """conv_id, turn, role with _calls (id, is_call, errors, json), _needs (ids) and _answers (id), null for plain ones, _errors and _message."""
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("_v", _parsed(F.col("text")))
    given = lambda name: F.try_variant_get("_v", f"$.{name}", "variant")
    is_list = lambda name: F.coalesce(F.schema_of_variant(given(name)).startswith("ARRAY"), F.lit(False))
    assistant, tool = F.col("role") == "assistant", F.col("role") == "tool"
    entries = F.when(assistant & is_list("tool_calls"), F.try_variant_get("_v", "$.tool_calls", "array<variant>"))
    rows = rows.withColumn("_calls", F.transform(entries, lambda c, i: _call(c, i, schemas)))
    rows = rows.withColumn("_needs", F.when(F.col("_calls").isNotNull(), F.try_variant_get("_v", "$.depends_on", "array<string>")))
    rows = rows.withColumn("_answers", F.when(tool, F.try_variant_get("_v", "$.tool_call_id", "string")))

    linked = F.col("_calls").isNotNull() | F.col("_answers").isNotNull()
    said = lambda wrong, what: F.when(F.coalesce(wrong, F.lit(False)), F.array(F.lit(what))).otherwise(F.array().cast("array<string>"))
    unlike = lambda c: linked & given(c).isNotNull() & ~F.col(c).cast("string").eqNullSafe(given(c).cast("string"))
    errors = F.concat(
        said(assistant & given("tool_calls").isNotNull() & ~is_list("tool_calls"), "tool_calls is no list"),
        said(F.col("_calls").isNotNull() & given("depends_on").isNotNull() & F.col("_needs").isNull(), "depends_on is no list"),
        *[said(unlike(c), f"{c} differs") for c in OWN],
    )
    own = _fields(**{c: _json(F.col(c)) for c in OWN})
    kept = lambda *names: _rest(F.try_variant_get("_v", "$", OBJECT), lambda k: k.isin(*OWN, "content", *names))
    content = _fields(content=_json(given("content")))
    calls = _fields(tool_calls=F.concat(F.lit("["), F.array_join(F.transform("_calls", lambda c: c.json), ","), F.lit("]")))
    calling = _object_json(F.map_concat(own, content, calls, kept("tool_calls")))
    answering = _object_json(F.map_concat(own, content, _fields(tool_call_id=_json(F.col("_answers"))), kept("tool_call_id")))
    plain = F.to_json(F.struct(F.col("text").alias("content"), *OWN), {"ignoreNullFields": "false"})
    message = F.when(F.col("_calls").isNotNull(), calling).when(F.col("_answers").isNotNull(), answering).otherwise(plain)
    return rows.withColumn("_errors", errors).withColumn("_message", message).drop("_v", "text")


def _edges(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, call_id, call_turn) of the calls, and (conv_id, turn, need) between messages."""
    calls = rows.where(F.col("_calls").isNotNull()).select("conv_id", "turn", F.explode(F.transform("_calls", lambda c: c.id)).alias("call_id"))
    calls = calls.where(F.col("call_id").isNotNull()).groupBy("conv_id", "call_id").agg(F.min("turn").alias("call_turn"))
    results = rows.where(F.col("_answers").isNotNull()).select("conv_id", "turn", F.col("_answers").alias("call_id"))
    answered = results.join(calls, ["conv_id", "call_id"]).select("conv_id", "turn", F.col("call_turn").alias("need"))
    first = results.groupBy("conv_id", "call_id").agg(F.min("turn").alias("need"))
    wanted = rows.where(F.col("_needs").isNotNull()).select("conv_id", "turn", F.explode("_needs").alias("call_id"))
    needed = wanted.join(first, ["conv_id", "call_id"]).select("conv_id", "turn", "need")
    return calls, answered.union(needed).where(F.col("turn").isNotNull() & F.col("need").isNotNull()).distinct()


def _places(edges: DataFrame) -> DataFrame:
    """conv_id, turn, place (turn, depth) of every message with an edge; null where it lies on a cycle or behind one."""
    place = lambda t, d: F.struct(t.cast("long").alias("turn"), d.cast("long").alias("depth"))
    ends = lambda e: e.select("conv_id", "turn").union(e.select("conv_id", F.col("need").alias("turn"))).distinct()
    nodes = ends(edges)
    # without a need at or after its own turn a conversation has no cycle, and its turns are in order
    unordered = edges.where(F.col("need") >= F.col("turn")).select("conv_id").distinct()
    away = staged(edges.join(unordered, "conv_id", "left_semi"), "needs")
    placed = staged(ends(away).withColumn("place", place(F.col("turn"), F.lit(0))), "places")
    longest = placed.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    steps = 1  # away: the messages exactly so many steps away; placed: by all that are nearer
    while steps < longest and not away.isEmpty():
        need = placed.select("conv_id", F.col("turn").alias("need"), F.col("place").alias("p"))
        farther = away.join(need, ["conv_id", "need"]).groupBy("conv_id", "turn").agg(F.max(place(F.col("p.turn"), F.col("p.depth") + steps)).alias("p"))
        placed = staged(placed.join(farther, ["conv_id", "turn"], "left").select("conv_id", "turn", F.greatest("place", F.coalesce("p", "place")).alias("place")), "places")
        then = away.select("conv_id", F.col("turn").alias("need"), F.col("need").alias("then"))
        away = staged(away.join(then, ["conv_id", "need"]).select("conv_id", "turn", F.col("then").alias("need")).distinct(), "needs")
        steps *= 2
    endless = away.select("conv_id", "turn").distinct().withColumn("endless", F.lit(True))
    found = nodes.join(placed, ["conv_id", "turn"], "left").join(endless, ["conv_id", "turn"], "left")
    return found.select("conv_id", "turn", F.when(F.col("endless").isNull(), F.coalesce("place", place(F.col("turn"), F.lit(0)))).alias("place"))


def format_chats(conversations: DataFrame, schemas: dict | None = None) -> DataFrame:
    """conv_id, turn, role, place_turn, place_depth, n_calls, errors, message (canonical JSON) of every message."""
    rows = parsed_messages(conversations, DEFAULT_SCHEMAS if schemas is None else schemas)
    tools = staged(rows.where(F.col("_calls").isNotNull() | F.col("_answers").isNotNull()).select("conv_id", "turn", F.transform("_calls", lambda c: F.struct(c.id.alias("id"))).alias("_calls"), "_needs", "_answers"), "tool-messages")
    calls, edges = _edges(tools)
    places = _places(staged(edges, "tool-edges")).select(F.col("conv_id").alias("p_conv"), F.col("turn").alias("p_turn"), "place")
    linked = calls.select(F.col("conv_id").alias("c_conv"), "call_id", F.lit(True).alias("linked"))

    out = rows.join(places, (F.col("conv_id") == F.col("p_conv")) & (F.col("turn") == F.col("p_turn")), "left")
    out = out.join(linked, (F.col("conv_id") == F.col("c_conv")) & (F.col("_answers") == F.col("call_id")), "left")
    none = F.array().cast("array<string>")
    of_call = lambda c: F.transform(c.errors, lambda e: F.when(c.is_call, F.concat(F.coalesce(c.id, F.lit("null")), F.lit(": "), e)).otherwise(e))
    errors = F.concat(
        "_errors",
        F.coalesce(F.flatten(F.transform("_calls", of_call)), none),
        F.when(F.col("_answers").isNotNull() & F.col("linked").isNull(), F.array(F.concat(F.lit("no call "), F.col("_answers")))).otherwise(none),
        F.when(F.col("p_conv").isNotNull() & F.col("place").isNull(), F.array(F.lit("cycle"))).otherwise(none),
    )
    n_calls = F.size(F.filter(F.col("_calls"), lambda c: c.is_call))
    return out.select(
        "conv_id", "turn", "role", F.coalesce("place.turn", F.col("turn").cast("long")).alias("place_turn"), F.coalesce("place.depth", F.lit(0).cast("long")).alias("place_depth"),
        F.when(F.col("_calls").isNull(), 0).otherwise(n_calls).cast("long").alias("n_calls"), F.array_join(errors, "; ").alias("errors"), F.col("_message").alias("message"),
    )
