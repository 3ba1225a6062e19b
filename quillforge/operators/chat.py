"""Loss-masked messages and the training formats made of them.

A message is (role, content, reasoning, tool_calls, tool_call_id, name, loss_weight); a trace is an array of them or
one row a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checkpoints import numbered

TOOL_CALLS = "array<struct<id:string,name:string,arguments:string>>"
MESSAGE = f"struct<role:string,content:string,reasoning:string,tool_calls:{TOOL_CALLS},tool_call_id:string,name:string,loss_weight:double>"
#: The event types that become messages, by role, and the names their content goes by in a payload. Other events become none.
EVENT_ROLES = {
    "system": ("scenario.init", "system.prompt"),
    "user": ("user.input", "task.start"),
    "assistant": ("model.response", "turn.assistant"),
    "tool": ("tool.result", "broker.result", "exec.result"),
}
CONTENT = {"system": ("instruction", "text"), "user": ("prompt", "text"), "assistant": ("content",), "tool": ("output", "result")}
REASONING = ("reasoning", "provider_reasoning")
PAIR_ROLES = {"user": "human", "assistant": "gpt", "function": "tool"}
FORMATS = {"chat": "chat", "openai": "chat", "openai_chat": "chat", "messages": "chat", "turn_pair": "turn_pair", "sharegpt": "turn_pair", "conversations": "turn_pair", "block": "block", "anthropic": "block"}


def loss_weight(role: Column, given: Column | None = None) -> Column:
    """A weight that is there stays; else assistants weigh 1, all others 0."""
    own = F.when(role == "assistant", 1.0).otherwise(0.0)
    return own if given is None else F.coalesce(given, own)


def messages_from_events(events: DataFrame) -> DataFrame:
    """Events with their messages, other columns kept. An event's type is ``event_type``, ``type`` or ``name``, its payload (a JSON text) ``payload`` or
    ``data``: of these, and of a payload's names for one thing, the first that is not empty counts."""
    first = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names if n in events.columns])
    kind, payload = first("event_type", "type", "name"), first("payload", "data")
    role = F.coalesce(*[F.when(kind.isin(*types), r) for r, types in EVENT_ROLES.items()])
    field = lambda *names: F.coalesce(*[F.nullif(F.get_json_object(payload, f"$.{n}"), F.lit("")) for n in names])
    calls = F.transform(F.from_json(F.get_json_object(payload, "$.tool_calls"), "array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"), lambda c: F.struct(c["id"].alias("id"), c["function"]["name"].alias("name"), c["function"]["arguments"].alias("arguments")))
    content = F.coalesce(*[F.when(role == r, field(*names)) for r, names in CONTENT.items()], F.lit(""))
    message = F.struct(role.alias("role"), content.alias("content"), F.when(role == "assistant", field(*REASONING)).alias("reasoning"), F.when(role == "assistant", calls).alias("tool_calls"), F.when(role == "tool", field("tool_call_id", "id")).alias("tool_call_id"), F.when(role == "tool", field("name")).alias("name"), loss_weight(role).alias("loss_weight"))
    return events.where(role.isNotNull()).withColumn("message", message)


def message(role: Column, content: Column, reasoning=None, tool_calls=None, tool_call_id=None, name=None, weight=None) -> Column:
    null = lambda c, t: F.lit(None).cast(t) if c is None else c
    return F.struct(role.alias("role"), F.coalesce(content, F.lit("")).alias("content"), null(reasoning, "string").alias("reasoning"), null(tool_calls, TOOL_CALLS).alias("tool_calls"), null(tool_call_id, "string").alias("tool_call_id"), null(name, "string").alias("name"), loss_weight(role, weight).alias("loss_weight"))


def traces(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """key and messages, in order: a trace is one group, bounded by a conversation."""
    rows = turns.select(key, F.struct(order, message(F.col("role"), F.col("text")).alias("m")).alias("x"))
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["m"]).alias("messages"))


def chat_format(messages: Column) -> Column:
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["reasoning"].alias("reasoning_content"), m["tool_calls"].alias("tool_calls"), m["tool_call_id"].alias("tool_call_id"), m["name"].alias("name"), m["loss_weight"].alias("loss_weight")))


def pair_value(m: Column) -> Column:
    """A turn's parts, joined by blank lines: tagged reasoning, content, tagged tool calls (made by a JSON writer)."""
    calls = F.transform(F.coalesce(m["tool_calls"], F.expr(f"cast(array() as {TOOL_CALLS})")), lambda c: F.concat(F.lit("<tool_call>\n"), F.to_json(F.struct(c["name"].alias("name"), c["arguments"].alias("arguments"))), F.lit("\n</tool_call>")))
    thought = F.when(F.coalesce(m["reasoning"], F.lit("")) != "", F.concat(F.lit("<think>\n"), m["reasoning"], F.lit("\n</think>")))
    return F.array_join(F.concat(F.array_compact(F.array(thought, F.nullif(m["content"], F.lit("")))), calls), "\n\n")


def turn_pair_format(messages: Column) -> Column:
    roles = F.create_map(*[F.lit(x) for kv in PAIR_ROLES.items() for x in kv])
    return F.transform(messages, lambda m: F.struct(F.coalesce(F.element_at(roles, m["role"]), m["role"]).alias("from"), pair_value(m).alias("value"), m["loss_weight"].alias("weight")))


BLOCK = "struct<type:string,text:string,id:string,name:string>"


def _block(kind: str, text: Column, ident=None, name=None) -> Column:
    null = F.lit(None).cast("string")
    return F.struct(F.lit(kind).alias("type"), text.alias("text"), (null if ident is None else ident).alias("id"), (null if name is None else name).alias("name"))


def block_format(messages: Column) -> Column:
    """(system, messages): system turns joined by blank lines; an assistant's thinking, tool_use and text blocks in that order; a tool
    result goes to the output message right before it if that is the user's, else it opens one."""
    system = F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == "system"), lambda m: m["content"]), "\n\n")
    none = F.expr(f"cast(array() as array<{BLOCK}>)")

    def blocks(m):
        thought = F.when(F.coalesce(m["reasoning"], F.lit("")) != "", F.array(_block("thinking", m["reasoning"]))).otherwise(none)
        calls = F.coalesce(F.transform(m["tool_calls"], lambda c: _block("tool_use", c["arguments"], c["id"], c["name"])), none)
        text = F.when(m["content"] != "", F.array(_block("text", m["content"]))).otherwise(none)
        return F.when(m["role"].isin("tool", "function"), F.array(_block("tool_result", m["content"], m["tool_call_id"]))).when(m["role"] == "assistant", F.concat(thought, calls, text)).otherwise(text)

    start = F.expr(f"cast(array() as array<struct<role:string,content:array<{BLOCK}>,loss_weight:double>>)")

    def step(acc, m):
        tool = m["role"].isin("tool", "function")
        out = F.struct(F.when(tool, "user").otherwise(m["role"]).alias("role"), blocks(m).alias("content"), m["loss_weight"].alias("loss_weight"))
        last = F.element_at(acc, -1)
        merged = F.struct(last["role"].alias("role"), F.concat(last["content"], blocks(m)).alias("content"), last["loss_weight"].alias("loss_weight"))
        return F.when(tool & (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["role"] == "user"), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(merged))).otherwise(F.concat(acc, F.array(out)))

    turns = F.aggregate(F.filter(messages, lambda m: m["role"] != "system"), start, step)
    return F.struct(system.alias("system"), turns.alias("messages"))


def formatted(df: DataFrame, name: str, messages: str = "messages") -> DataFrame:
    """``df`` with its messages in a format by any of its names; an unknown one leaves them under ``data``."""
    kind, m = FORMATS.get(name), F.col(messages)
    if kind is None:
        return df.withColumnRenamed(messages, "data")
    made = {"chat": chat_format, "turn_pair": turn_pair_format, "block": block_format}[kind](m)
    return df.withColumn({"chat": "messages", "turn_pair": "conversations", "block": "record"}[kind], made)


def output_message_groups(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Which output message each turn goes to, one row a turn: a running sum of the turns that open one."""
    w = Window.partitionBy(key).orderBy(order)
    rows = turns.where("role <> 'system'")
    opens = F.when(F.col("role").isin("tool", "function") & F.coalesce(F.lag("role").over(w).isin("tool", "function", "user"), F.lit(False)), 0).otherwise(1)
    return rows.withColumn("_opens", opens).withColumn("message_no", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_opens")


def typed_rows(df: DataFrame, order: list[str], messages: str = "messages", ident: Column | None = None, split: Column | None = None) -> DataFrame:
    """Rows of the typed tables: id (row_%07d by the order in all by default), split (train), messages, metadata_json; null contents are empty."""
    rest = [c for c in df.columns if c != messages]
    given = df.withColumns({"_all": F.lit(""), "_id": ident if ident is not None else F.lit(None).cast("string"), "_split": F.coalesce(split if split is not None else F.lit(None).cast("string"), F.lit("train"))})
    return numbered(given, "_all", order).select(F.coalesce("_id", F.format_string("row_%07d", "row_index")).alias("id"), F.col("_split").alias("split"), chat_format(F.col(messages)).alias("messages"), F.to_json(F.struct(*rest)).alias("metadata_json"))


def recipe_rows(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Exactly the recipe's top-level columns; a missing or an extra one is an error."""
    if set(df.columns) != set(columns):
        raise ValueError(f"columns differ from the recipe's: {sorted(set(df.columns) ^ set(columns))}")
    return df.select(*columns)


def shards(df: DataFrame, order: list[str], split: str, size: int) -> DataFrame:
    """``df`` with row_index, dense within a split in an order, shard and file name."""
    out = numbered(df, split, order).withColumn("shard", F.floor(F.col("row_index") / size).cast("long"))
    return out.withColumn("file", F.concat(F.col(split), F.format_string("-%05d", "shard")))
