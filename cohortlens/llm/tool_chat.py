"""Chat formatting with tool-call linking, in DataFrame functions only.

A message whose text is a JSON object with ``tool_calls`` gives, besides its
content, one row for each call (``id``, ``name``, ``arguments``, also in the
nested ``function`` form); one with ``tool_call_id`` is a result.  Further
fields of such a message, or of a call, go into ``more`` of its line, and
content that is no string stays the JSON value it is.  Results are
hash-joined to the first call with their identifier in the conversation.  The
order keys put every result after its call, at the later of the two turns.
Arguments are checked against parameter schemas; every row is serialised as
canonical JSON (sorted keys, no blanks).

Rows come out one by one with order keys (conv_id, at_turn, step, place), so
a conversation of any length never gathers in one task.

Defined cases: null or non-JSON texts are plain messages with their whole text,
and so are objects without a readable ``tool_calls`` array or ``tool_call_id``
and those with an unreadable ``tool_calls``; a null text is an empty one; a null ``conv_id`` is one conversation; a repeated call identifier
links to the first call (by turn, then place) and later ones are ``repeated``;
a result without a call is an ``orphan``, a call without a result
``unanswered``; unreadable arguments are invalid; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALL = "struct<id:string,name:string,arguments:string,function:struct<name:string,arguments:string>>"
MESSAGE = f"struct<content:string,tool_calls:array<{CALL}>,tool_call_id:string>"

#: (tool, parameter, type, required)
SCHEMAS = (
    ("calculate", "expression", "string", True), ("lookup", "key", "string", True), ("lookup", "default", "string", False),
    ("search", "query", "string", True), ("search", "limit", "integer", False), ("weather", "place", "string", True),
    ("weather", "days", "integer", False), ("weather", "metric", "boolean", False),
)
#: How Spark names the types of JSON values.
TYPES = (("string", "^STRING$"), ("integer", "^BIGINT$"), ("number", "^(BIGINT|DOUBLE|DECIMAL.*)$"),
         ("boolean", "^BOOLEAN$"), ("array", "^ARRAY.*$"), ("object", "^OBJECT.*$"))


def _type_fits(found: Column, wanted: Column) -> Column:
    fits = F.lit(False)
    for name, form in TYPES:
        fits = fits | ((wanted == name) & found.rlike(form))
    return fits


def _canonical(text: Column) -> Column:
    return F.to_json(F.try_parse_json(text))


def parsed_messages(chats: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, message (its parsed form, null for plain texts), more (the message's other fields)."""
    looks = F.coalesce("text", F.lit("")).rlike(r"^\s*\{(?s:.*)\"tool_call(s|_id)\"(?s:.*)\}\s*$")
    out = chats.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"),
                       F.when(looks, _canonical(F.col("text"))).alias("object"))
    out = out.withColumns({"message": F.from_json("object", MESSAGE, {"mode": "PERMISSIVE"}),
                           "fields": F.from_json("object", "map<string,variant>")})
    calls, given = F.col("message.tool_calls"), F.try_element_at("fields", F.lit("tool_calls"))
    # A null there means no calls; anything else has to be an array of objects.
    no_calls = given.isNull() | (F.schema_of_variant(given) == "VOID")
    whole = F.schema_of_variant(given).startswith("ARRAY") & calls.isNotNull() & ~F.exists(calls, lambda c: c.isNull())
    readable = F.coalesce(whole, F.lit(False)) | (no_calls & F.col("message.tool_call_id").isNotNull())
    more = F.map_filter("fields", lambda k, _: ~k.isin("content", "tool_calls", "tool_call_id"))
    content = F.try_element_at("fields", F.lit("content"))
    return out.select("conv_id", "turn", "role", "text", F.when(readable, F.col("message")).alias("message"),
                      F.when(readable & (F.size(more) > 0), more).alias("more"),
                      F.when(readable & (F.schema_of_variant(content) != "VOID"), content).alias("content"),
                      F.when(readable, F.try_variant_get(given, "$", "array<variant>")).alias("given"))


def _fields(value: Column) -> Column:
    return F.from_json(F.to_json(value), "map<string,variant>")


def _more_of_call() -> Column:
    """The fields of a call that have no column of their own, those of its ``function`` object included."""
    fields = _fields(F.col("whole"))
    inner = F.try_element_at(fields, F.lit("function"))
    is_object = F.coalesce(F.schema_of_variant(inner).startswith("OBJECT"), F.lit(False))
    # A name or arguments of the nested form are left over where the outer form gives them.
    left = F.map_filter(_fields(F.when(is_object, inner)), lambda k, _: ~(
        ((k == "name") & F.col("call.name").isNull()) | ((k == "arguments") & F.col("call.arguments").isNull())))
    nested = F.when(is_object & (F.size(left) > 0), F.map_from_arrays(
        F.array(F.lit("function")), F.array(F.try_parse_json(F.to_json(left)))))
    plain = F.map_filter(fields, lambda k, _: ~k.isin("id", "name", "arguments") & ~((k == "function") & is_object))
    more = F.when(nested.isNull(), plain).otherwise(F.map_concat(plain, nested))
    return F.when(F.size(more) > 0, more)


def calls_of(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, place, call_id, tool, arguments, more (its other fields) of every call."""
    both = F.posexplode(F.arrays_zip(F.col("message.tool_calls").alias("call"), F.col("given").alias("whole")))
    return messages.where("message.tool_calls is not null").select("conv_id", "turn", "role", both.alias("place", "both")).select(
        "conv_id", "turn", "role", "place", F.col("both.call").alias("call"), F.col("both.whole").alias("whole")).select(
        "conv_id", "turn", "role", "place", F.col("call.id").alias("call_id"),
        F.coalesce("call.name", "call.function.name").alias("tool"),
        F.coalesce("call.arguments", "call.function.arguments", F.lit("{}")).alias("arguments"), _more_of_call().alias("more"))


def checked_calls(calls: DataFrame, schemas=SCHEMAS) -> DataFrame:
    """The calls with ``canonical`` arguments and ``faults``, sorted names of what breaks the schema."""
    spark = calls.sparkSession
    # A configuration list: as many rows as tools.
    names = ("s_tool", "name", "type", "required")
    known = spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(k) for k, v in zip(names, row, strict=True)]) for row in schemas])))
    known = F.broadcast(known.groupBy("s_tool").agg(
        F.collect_list(F.struct("name", "type", "required")).alias("params")))
    # Arguments may come as an object or as a string that holds one.
    raw = F.coalesce(F.try_variant_get(F.try_parse_json("arguments"), "$", "string"), F.col("arguments"))
    raw = F.when(F.trim("arguments").startswith('"'), raw).otherwise(F.col("arguments"))
    out = calls.withColumn("canonical", _canonical(raw))
    out = out.withColumn("given", F.from_json(F.when(F.col("canonical").startswith("{"), F.col("canonical")),
                                              "map<string,variant>"))
    out = out.join(known, F.col("tool") == F.col("s_tool"), "left")
    kinds = F.transform_values("given", lambda _, v: F.schema_of_variant(v))
    wrong = F.filter("params", lambda p: F.when(F.map_contains_key(F.col("kinds"), p["name"]), ~_type_fits(
        F.try_element_at(F.col("kinds"), p["name"]), p["type"])).otherwise(p["required"]))
    extra = F.filter(F.map_keys("kinds"), lambda k: ~F.array_contains(F.transform("params", lambda p: p["name"]), k))
    out = out.withColumn("kinds", kinds)
    return out.withColumn("faults", F.when(F.col("params").isNull(), F.array(F.lit("unknown tool")))
                          .when(F.col("given").isNull(), F.array(F.lit("unreadable arguments")))
                          .otherwise(F.array_sort(F.concat(F.transform(wrong, lambda p: p["name"]), extra)))).drop(
        "params", "s_tool", "given", "kinds")


def format_chats(chats: DataFrame, schemas=SCHEMAS) -> DataFrame:
    """conv_id, at_turn, step, place, turn, kind, call_id, status, faults, line: messages, calls and results."""
    messages = parsed_messages(chats)
    calls = checked_calls(calls_of(messages), schemas)
    results = messages.where("message.tool_call_id is not null").select(
        "conv_id", "turn", "role", F.col("message.tool_call_id").alias("call_id"),
        F.coalesce("content", F.lit("").cast("variant")).alias("content"), "more")
    first = calls.where("call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "place")).alias("at")).select(
        F.col("conv_id").alias("f_conv"), F.col("call_id").alias("f_call"), "at")
    answered = results.groupBy(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call")).agg(
        F.count(F.lit(1)).alias("results"))

    plain = messages.where("message.tool_call_id is null").select(
        "conv_id", F.col("turn").alias("at_turn"), F.lit(0).alias("step"), F.lit(0).alias("place"), "turn",
        F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit("plain").alias("status"),
        F.lit("").alias("faults"),
        F.when(F.col("message").isNull(), F.to_json(F.struct(F.col("text").alias("content"), "role", "turn"))).otherwise(
            F.to_json(F.struct(F.coalesce("content", F.lit("").cast("variant")).alias("content"), "more", "role", "turn")))
        .alias("line"))
    linked = (calls.join(first, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("call_id") == F.col("f_call")), "left")
              .join(answered, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("call_id") == F.col("r_call")), "left"))
    is_first = F.col("at").isNull() | (F.struct("turn", "place") == F.col("at"))
    call_rows = linked.select(
        "conv_id", F.col("turn").alias("at_turn"), F.lit(1).alias("step"), "place", "turn", F.lit("call").alias("kind"),
        "call_id", F.when(~is_first, "repeated").when(F.col("results").isNull(), "unanswered").otherwise("answered").alias("status"),
        F.array_join("faults", ",").alias("faults"),
        F.to_json(F.struct(F.try_parse_json("canonical").alias("arguments"), "call_id", "more", "role", "tool", "turn")).alias("line"))
    result_rows = results.join(first, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("call_id") == F.col("f_call")),
                               "left").select(
        "conv_id", F.greatest("turn", "at.turn").alias("at_turn"), F.lit(2).alias("step"),
        F.coalesce("at.place", F.lit(0)).alias("place"), "turn", F.lit("result").alias("kind"), "call_id",
        F.when(F.col("at").isNull(), "orphan").otherwise("linked").alias("status"), F.lit("").alias("faults"),
        F.to_json(F.struct("call_id", "content", "more", "role", "turn")).alias("line"))
    return plain.unionByName(call_rows).unionByName(result_rows)
