"""Tool-call linking in DataFrame functions alone.

Messages carry tool calls and tool results as JSON.  Calls and results are parsed and hash-joined by
identifier within their conversation; calls are ordered so that each comes after those it depends on;
arguments are checked against the tools' schemas; and every call is written as canonical JSON (keys in
order, no spaces) with its result.

    {"tool_calls": [{"id": ..., "name": ..., "arguments": {...}, "after": [ids]}]}   a call message
    {"tool_call_id": ..., "content": ...}                                             a result message

Every join is by conversation and identifier, so a conversation of any length spreads over all tasks.
A call's level is one more than the greatest level of the calls it depends on.  Chains, in which each
call depends on one other, are followed by doubling, so a conversation of n turns takes log2(n) rounds;
only calls with several predecessors take a round for each such call on the longest path.

Defined results: messages that are neither form (null, plain text, broken JSON) are ignored; of calls,
or results, that repeat an identifier the one of least turn and text counts; a call without a result
has status "open", one whose result comes before it "early", a result without a call is not
reported; calls in a cycle, or after an unknown call, have no level; arguments
that are not an object ("object"), lack a required name ("missing:x"), have an unknown one ("unknown:x") or
a value of another JSON type, null included ("type:x"), are listed as problems; unknown tools have the
problem "tool"; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:variant,after:array<string>>>>"
RESULT = "struct<tool_call_id:string,content:string>"
#: Tools with their arguments: name -> (type, required).  Types: string, integer, number, boolean.
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {
    "answer": {"prompt": ("string", True), "words": ("integer", True), "first": ("boolean", False)},
    "revise": {"prompt": ("string", True), "words": ("integer", True)},
}
#: How Spark names the types of JSON values that each type of the schemas allows.
TYPES = {"string": r"STRING", "integer": r"BIGINT|DECIMAL\(\d+,0\)", "number": r"BIGINT|DOUBLE|DECIMAL\(\d+,\d+\)", "boolean": r"BOOLEAN"}


def problems(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]] = SCHEMAS) -> Column:
    """What a call's arguments (a variant) violate, sorted: tool, object, missing:x, unknown:x, type:x."""
    values = F.coalesce(F.try_variant_get(arguments, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    keys = F.map_keys(values)
    other = F.when(arguments.isNotNull() & ~F.schema_of_variant(arguments).startswith("OBJECT"), F.array(F.lit("object"))).otherwise(F.array().cast("array<string>"))
    found = F.array(F.lit("tool"))
    for tool, fields in schemas.items():
        known = F.array(*(F.lit(f) for f in fields))
        required = F.array(*(F.lit(f) for f, (_, needed) in fields.items() if needed)).cast("array<string>")
        wrong = F.array_compact(F.array(*(F.when(~F.schema_of_variant(F.try_element_at(values, F.lit(f))).rlike(f"^({TYPES[kind]})$"), F.lit(f"type:{f}")) for f, (kind, _) in fields.items())))
        missing = F.transform(F.array_except(required, keys), lambda x: F.concat(F.lit("missing:"), x))
        unknown = F.transform(F.array_except(keys, known), lambda x: F.concat(F.lit("unknown:"), x))
        found = F.when(name == tool, F.array_sort(F.concat(other, missing, unknown, wrong))).otherwise(found)
    return found


def parse_calls(messages: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]] = SCHEMAS) -> DataFrame:
    """conv_id, call_id, turn, name, arguments (as canonical JSON), problems and after of every call."""
    parsed = messages.select("conv_id", "turn", F.posexplode(F.from_json("text", CALLS)["tool_calls"]).alias("place", "call"))
    given = F.col("call.arguments")
    calls = parsed.filter("call.id is not null").select("conv_id", F.col("call.id").alias("call_id"), "turn", "place", F.col("call.name").alias("name"), F.coalesce(F.to_json(given), F.lit("{}")).alias("arguments"), F.array_join(problems(F.col("call.name"), given, schemas), ",").alias("problems"), F.coalesce("call.after", F.array().cast("array<string>")).alias("after"))
    order = F.struct("turn", "place", F.coalesce("name", F.lit("")), "arguments")
    return calls.groupBy("conv_id", "call_id").agg(F.min_by(F.struct("turn", "name", "arguments", "problems", "after"), order).alias("c")).select("conv_id", "call_id", "c.*")


def parse_results(messages: DataFrame) -> DataFrame:
    """conv_id, call_id, result_turn and content of every result."""
    parsed = messages.select("conv_id", "turn", F.from_json("text", RESULT).alias("r")).filter("r.tool_call_id is not null")
    first = F.min(F.struct(F.col("turn").alias("result_turn"), F.col("r.content").alias("content")))
    return parsed.groupBy("conv_id", F.col("r.tool_call_id").alias("call_id")).agg(first.alias("r")).select("conv_id", "call_id", "r.*")


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level (0 for calls after no other); absent in cycles and after unknown calls."""
    key = ["conv_id", "call_id"]
    after = written(calls.select(*key, F.array_distinct("after").alias("after")), "after")
    n = after.count()
    hops = written(after.filter(F.size("after") == 1).select(*key, F.col("after")[0].alias("anchor"), F.lit(1).cast("long").alias("dist")), "hops")
    while True:  # each round doubles the reach; in a cycle the distance outgrows the number of calls
        ahead = hops.select("conv_id", F.col("call_id").alias("anchor"), F.col("anchor").alias("next"), F.col("dist").alias("more"))
        far = hops.join(ahead, ["conv_id", "anchor"], "left").select(*key, F.coalesce("next", "anchor").alias("anchor"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), F.col("next").isNotNull().alias("moved"))
        far = written(far, "hops")
        hops = far.drop("moved")
        if not far.filter(F.col("moved") & (F.col("dist") <= n)).take(1):
            break

    def with_chains(settled: DataFrame, name: str) -> DataFrame:
        """Settled calls and those that hang on them by chains."""
        base = settled.select("conv_id", F.col("call_id").alias("anchor"), F.col("level").alias("base"))
        hung = hops.join(base, ["conv_id", "anchor"]).select(*key, (F.col("base") + F.col("dist")).alias("level"))
        return written(settled.unionByName(hung), name)

    newest = done = with_chains(after.filter(F.size("after") == 0).select(*key, F.lit(0).cast("long").alias("level")), "level")
    arcs = written(after.filter(F.size("after") > 1).select(*key, F.explode("after").alias("before_id")), "arcs")
    while arcs.take(1) and newest.take(1):
        marked = arcs.join(done.select("conv_id", F.col("call_id").alias("before_id"), "level"), ["conv_id", "before_id"], "left")
        sums = marked.groupBy(*key).agg(F.count("*").alias("needs"), F.count("level").alias("met"), F.max("level").alias("top"))
        newest = with_chains(sums.filter("needs = met").select(*key, (F.col("top") + 1).alias("level")), "level")
        arcs = written(arcs.join(newest, key, "left_anti"), "arcs")
        done = done.unionByName(newest)
    return done.withColumn("level", F.col("level").cast("int"))


def quoted(value: Column) -> Column:
    """A string as JSON; null as null."""
    listed = F.to_json(F.array(value))
    return F.coalesce(F.substring(listed, F.lit(2), F.length(listed) - 2), F.lit("null"))


def canonical(name: Column, call_id: Column, arguments: Column, content: Column) -> Column:
    """A call (its arguments as canonical JSON) with its result as JSON with sorted keys and no spaces."""
    return F.concat(F.lit('{"arguments":'), arguments, F.lit(',"id":'), quoted(call_id), F.lit(',"name":'), quoted(name), F.lit(',"result":'), quoted(content), F.lit("}"))


def link_calls(messages: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]] = SCHEMAS) -> DataFrame:
    """conv_id, call_id, turn, level, status, problems (comma-joined) and call_json of every call."""
    calls = written(parse_calls(messages, schemas), "calls")
    linked = calls.join(parse_results(messages), ["conv_id", "call_id"], "left").join(levels(calls), ["conv_id", "call_id"], "left")
    status = F.when(F.col("result_turn").isNull(), "open").when(F.col("result_turn") < F.col("turn"), "early").otherwise("done")
    json = canonical(F.col("name"), F.col("call_id"), F.col("arguments"), F.col("content"))
    return linked.select("conv_id", "call_id", "turn", "level", status.alias("status"), "problems", json.alias("call_json"))


def as_messages(conversations: DataFrame) -> DataFrame:
    """Plain conversations as tool messages, good and bad by rule.

    A user's turn calls a tool: `answer` first, `revise` later, after the call two turns before and, in
    turns 4, 5, 10 and 11, that of four turns before too.  Its number of words is a string where it is
    divisible by 7, left out where it is by 11, and an unknown name is added where it is by 13.  The
    assistant's next turn is the call's result; turns that end with 5 or 6 answer the next call, too early.
    """
    turn, conv = F.col("turn"), F.col("conv_id").cast("string")
    call_id = lambda t: F.concat(F.lit("call_"), conv, F.lit("_"), t.cast("string"))
    words = F.length("text") - F.length(F.replace(F.col("text"), F.lit(" "), F.lit(""))) + 1
    first = turn < 2
    shown = F.when(words % 11 == 0, None).when(words % 7 == 0, F.concat(F.lit('"'), words.cast("string"), F.lit('"'))).otherwise(words.cast("string"))
    parts = [F.when(first, F.lit('"first":true')), F.when(words % 13 == 0, F.lit('"note":null')), F.concat(F.lit('"prompt":'), quoted(F.col("text"))), F.concat(F.lit('"words":'), shown)]
    arguments = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    after = F.when(first, F.array().cast("array<string>")).when(turn.isin(4, 5, 10, 11), F.array(call_id(turn - 2), call_id(turn - 4))).otherwise(F.array(call_id(turn - 2)))
    call = F.concat(F.lit('{"tool_calls":[{"id":'), quoted(call_id(turn)), F.lit(',"name":'), quoted(F.when(first, "answer").otherwise("revise")), F.lit(',"arguments":'), arguments, F.lit(',"after":'), F.to_json(after), F.lit("}]}"))
    answered = F.when((turn % 10).isin(5, 6), call_id(turn + 1)).otherwise(call_id(turn - 1))
    result = F.to_json(F.struct(answered.alias("tool_call_id"), F.col("text").alias("content")))
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text"))
    return conversations.select("conv_id", "turn", "role", text.alias("text"))


def op5_tool_calls(spark, sf_dir: str) -> DataFrame:
    """Every turn of the conversations table."""
    return link_calls(as_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


#: The same in DuckDB's SQL.  A call's level follows from the call two turns before: that one is after
#: the call of four turns before itself.
OP5_SQL = """
WITH RECURSIVE c AS (
  SELECT conv_id, turn, text, 'call_' || conv_id || '_' || turn AS call_id, 'call_' || conv_id || '_' || (turn - 2) AS after_id,
         turn < 2 AS is_first, length(text) - length(replace(text, ' ', '')) + 1 AS words
  FROM conversations WHERE role = 'user'),
every_result AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || CASE WHEN turn % 10 IN (5, 6) THEN turn + 1 ELSE turn - 1 END AS call_id, text AS content
  FROM conversations WHERE role = 'assistant'),
r AS (SELECT conv_id, call_id, min(turn) AS result_turn, arg_min(content, turn) AS content FROM every_result GROUP BY conv_id, call_id),
l AS (SELECT conv_id, call_id, 0 AS level FROM c WHERE is_first
      UNION ALL SELECT c.conv_id, c.call_id, l.level + 1 FROM c JOIN l ON c.conv_id = l.conv_id AND NOT c.is_first AND c.after_id = l.call_id)
SELECT c.conv_id, c.call_id, c.turn, l.level,
  CASE WHEN r.call_id IS NULL THEN 'open' WHEN r.result_turn < c.turn THEN 'early' ELSE 'done' END AS status,
  concat_ws(',', CASE WHEN words % 11 = 0 THEN 'missing:words' END, CASE WHEN words % 11 <> 0 AND words % 7 = 0 THEN 'type:words' END, CASE WHEN words % 13 = 0 THEN 'unknown:note' END) AS problems,
  '{"arguments":{' || concat_ws(',', CASE WHEN is_first THEN '"first":true' END, CASE WHEN words % 13 = 0 THEN '"note":null' END, '"prompt":' || to_json(c.text)::VARCHAR,
    CASE WHEN words % 11 = 0 THEN NULL WHEN words % 7 = 0 THEN '"words":"' || words || '"' ELSE '"words":' || words END) || '},"id":"' || c.call_id
  || '","name":"' || CASE WHEN is_first THEN 'answer' ELSE 'revise' END || '","result":' || coalesce(to_json(r.content)::VARCHAR, 'null') || '}' AS call_json
FROM c LEFT JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id LEFT JOIN l ON c.conv_id = l.conv_id AND c.call_id = l.call_id
"""
