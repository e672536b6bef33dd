"""Chat formatting with tool-call linking.

A message of an assistant whose text is a JSON object may hold ``tool_calls`` (each with id,
name and arguments); a message of the role ``tool`` holds ``tool_call_id`` and ``content``.
Calls and results meet in a hash join on conversation and id. Results follow the message that
called for them, in the order of its calls; all else stands by turn. Arguments are checked
against the tools' schemas. A conversation becomes one line of canonical JSON: keys sorted,
no spaces. Everything is DataFrame operations; JSON goes through the variant type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: JSON schema type names and the variant types that satisfy them.
TYPES = {
    "string": "^STRING$",
    "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY.*$",
    "object": "^OBJECT.*$",
    "null": "^VOID$",
}
SCHEMAS = "name string, field string, type string, required boolean"


#: Share of a tool's calls, in tenths, that give a field which ``used_schemas`` takes for required.
REQUIRED_TENTHS = 9


def no_schemas(spark: SparkSession) -> DataFrame:
    """A table of tool schemas without a tool: no arguments are checked."""
    return spark.createDataFrame([], SCHEMAS)


def _quoted(text: Column) -> Column:
    """A string as JSON: that of an object with it alone, without what is around it."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)


def _calls(messages: DataFrame) -> DataFrame:
    calls = messages.where("role = 'assistant' and payload is not null").select(
        "conv_id",
        "turn",
        "row",
        F.posexplode(F.try_variant_get("payload", "$.tool_calls", "array<variant>")).alias("place", "call"),
    )
    return calls.select(
        "conv_id",
        "turn",
        "row",
        "place",
        F.try_variant_get("call", "$.id", "string").alias("call_id"),
        F.try_variant_get("call", "$.name", "string").alias("name"),
        F.try_variant_get("call", "$.arguments", "variant").alias("arguments"),
    )


def _messages(conversations: DataFrame) -> DataFrame:
    """The different messages with their copies, and the JSON object that a tool's or an assistant's text is."""
    messages = conversations.select(
        F.col("conv_id").cast("long"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1).cast("long")).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # One row for each different message, so that its calls are told apart from those of its copies.
    messages = messages.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    row = F.xxhash64(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), "turn", "role", "text")
    alone = F.concat(F.lit("alone "), F.col("row").cast("string"))
    messages = messages.withColumn("row", row).withColumn("_c", F.coalesce(F.col("conv_id").cast("string"), alone))
    tooled = F.col("role").isin("assistant", "tool") & F.ltrim("text").startswith("{")
    return messages.withColumn("payload", F.when(tooled, F.try_parse_json("text")))


def _tools(messages: DataFrame) -> DataFrame:
    return messages.where("payload is not null").drop("conv_id").withColumnRenamed("_c", "conv_id")


def _given(calls: DataFrame) -> DataFrame:
    """One row for each field of a call's arguments, with the variant type found there."""
    fields = F.expr("try_cast(arguments as map<string, variant>)")
    return calls.select(
        "conv_id", "row", "place", "name",
        F.explode(F.coalesce(fields, F.expr("cast(map() as map<string, variant>)"))).alias("field", "value"),
    ).select("conv_id", "row", "place", "name", "field", F.schema_of_variant("value").alias("found"))


def used_schemas(conversations: DataFrame) -> DataFrame:
    """Schemas of the tools as their calls in the table use them.

    A field has the type that most calls of the tool give it (of equally many the first by name;
    numbers are integers if all are) and is required if nine calls in ten give it. Every
    different message counts once. Calls without a name have no schema.
    """
    calls = _calls(_tools(_messages(conversations)))
    kind = F.when(F.col("found").rlike(TYPES["number"]), "number")
    for name in ("string", "boolean", "array", "object", "null"):
        kind = kind.when(F.col("found").rlike(TYPES[name]), name)
    kinds = _given(calls).groupBy("name", "field", kind.alias("kind")).agg(
        F.count("*").alias("n"), F.bool_and(F.col("found").rlike(TYPES["integer"])).alias("whole")
    )
    fields = kinds.groupBy("name", "field").agg(
        F.min(F.when(F.col("kind").isNotNull(), F.struct((-F.col("n")).alias("n"), "kind", "whole"))).alias("most"),
        F.sum("n").alias("given"),
    )
    made = calls.groupBy("name").agg(F.count("*").alias("calls"))
    of_type = F.when(F.col("most.whole"), "integer").otherwise(F.col("most.kind"))
    required = 10 * F.col("given") >= REQUIRED_TENTHS * F.col("calls")
    found = fields.where("most is not null").join(made, "name")
    return found.select("name", "field", of_type.alias("type"), required.alias("required"))


def _checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with the number of faults: required fields absent, fields of another type,
    fields that a known tool does not have. Tools without a schema have none."""
    tools = schemas.select("name").distinct()
    asked = calls.select("conv_id", "row", "place", "name").join(schemas.distinct(), "name")
    meets = F.lit(False)
    for name, pattern in TYPES.items():
        meets = meets | ((F.col("type") == name) & F.col("found").rlike(pattern))
    keys = ["conv_id", "row", "place", "name", "field"]
    right = _given(calls).join(tools, "name", "left_semi")
    both = asked.withColumn("asked", F.lit(True)).join(right, keys, "full")
    fault = F.when(F.col("asked").isNull(), 1).when(F.col("found").isNull(), F.col("required").cast("int")).otherwise((~meets).cast("int"))
    faults = both.groupBy("conv_id", "row", "place").agg(F.sum(fault).alias("faults"))
    return calls.join(faults, ["conv_id", "row", "place"], "left").withColumn("faults", F.coalesce("faults", F.lit(0)))


def format_chats(conversations: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, n_messages, n_calls, n_linked, n_orphans, n_faults, chat: one row per conv_id.

    Of several calls or results with one id in a conversation the first by turn is linked; a
    result without a call (an orphan) keeps its turn, a call without a result stands alone.
    Null roles and texts are empty strings; a message without a conv_id stands alone, one row for
    each different one with its copies. Messages of equal turns are ordered by role and text;
    repeated messages stay, each with its own calls, of which all or none count as linked. A text
    that is no JSON object, or says more than calls, ids and content, is content as it is. An empty table gives no rows. Other columns are not read.
    """
    messages = _messages(conversations)
    tools = _tools(messages)
    calls = _checked(_calls(tools), schemas)
    first = calls.where("call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "row", "place")).alias("at")
    )
    results = tools.where("role = 'tool'").select(
        "conv_id", "turn", "row", F.try_variant_get("payload", "$.tool_call_id", "string").alias("call_id")
    )
    answered = results.where("call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "row")).alias("by")
    )
    links = answered.join(first, ["conv_id", "call_id"])
    anchors = links.select(
        F.col("conv_id").alias("_c"), F.col("by.row").alias("row"), F.col("at.turn").alias("anchor"),
        F.col("at.row").alias("anchor_row"), (F.col("at.place") + 1).alias("place"),
    )
    linked = links.select("conv_id", "call_id", F.col("at.row").alias("row"), F.col("at.place").alias("place"), F.lit(True).alias("linked"))
    marked = calls.join(linked.drop("call_id"), ["conv_id", "row", "place"], "left")
    shown = marked.groupBy("conv_id", "row").agg(
        F.array_sort(F.collect_list(F.struct(
            "place", F.to_json(F.struct(
                F.col("arguments"), (F.col("faults") == 0).alias("arguments_valid"), F.col("call_id").alias("id"), "name",
                F.coalesce("linked", F.lit(False)).alias("result_linked"),
            )).alias("json"),
        ))).alias("list"),
        F.count("*").alias("n_calls"), F.count("linked").alias("n_linked"), F.sum("faults").alias("n_faults"),
    )
    shown = shown.select(
        F.col("conv_id").alias("_c"), "row", "n_calls", "n_linked", "n_faults",
        F.concat(F.lit("["), F.array_join(F.transform("list", lambda x: x["json"]), ","), F.lit("]")).alias("calls"),
    )
    wide = messages.join(anchors, ["_c", "row"], "left").join(shown, ["_c", "row"], "left")
    orphan = (F.col("role") == "tool") & F.col("anchor").isNull()
    own = F.try_variant_get("payload", "$.content", "string")
    keys = F.coalesce(F.expr("map_keys(try_cast(payload as map<string, variant>))"), F.array().cast("array<string>"))
    taken = F.array(F.lit("content"), F.when(F.col("role") == "tool", "tool_call_id").otherwise("tool_calls"))
    bare = F.col("calls").isNotNull() & ~F.array_contains(keys, "content")
    read = (own.isNotNull() | bare) & (F.size(F.array_except(keys, taken)) == 0)
    # A text stays whole unless all that it says is in the message.
    content = F.when(F.col("payload").isNotNull() & read, F.coalesce(own, F.lit(""))).otherwise(F.col("text"))
    parts = [
        F.concat(F.lit('"content":'), _quoted(content)),
        F.concat(F.lit('"role":'), _quoted(F.col("role"))),
        F.when(F.col("calls").isNotNull(), F.concat(F.lit('"tool_calls":'), F.col("calls"))),
    ]
    message = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    order = F.struct(
        F.coalesce("anchor", "turn").alias("a"), F.coalesce("anchor_row", F.when(F.col("calls").isNotNull(), F.col("row"))).alias("b"),
        F.coalesce("place", F.lit(0)).alias("p"), F.col("turn").alias("t"), F.col("role").alias("r"), message.alias("m"),
    )
    def over_copies(count: Column) -> Column:
        return F.coalesce(F.sum(count * F.col("copies")), F.lit(0).cast("long"))

    grouped = wide.groupBy("_c", "conv_id").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), "copies"))).alias("list"),
        F.sum("copies").alias("n_messages"),
        over_copies(F.col("n_calls")).alias("n_calls"),
        over_copies(F.col("n_linked")).alias("n_linked"),
        over_copies(orphan.cast("long")).alias("n_orphans"),
        over_copies(F.col("n_faults")).alias("n_faults"),
    )
    repeated = F.transform("list", lambda x: F.array_repeat(x["o"]["m"], x["copies"].cast("int")))
    body = F.array_join(F.flatten(repeated), ",")
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    chat = F.concat(F.lit('{"conv_id":'), name, F.lit(',"messages":['), body, F.lit("]}"))
    return grouped.select("conv_id", "n_messages", "n_calls", "n_linked", "n_orphans", "n_faults", chat.alias("chat"))
