"""Event streams: chains, ordinals, forward as-of, leads, and the records made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def normalise_events(events: DataFrame, run: str, order: list[str]) -> DataFrame:
    """run, index (dense, from 0, in order), event_type, timestamp and payload; a name stands in for a missing type."""
    cols = set(events.columns)
    kind = T.first_truthy(*[F.col(c) for c in ("event_type", "name", "type") if c in cols])
    payload = T.first_truthy(*[F.col(c) for c in ("payload", "data", "props") if c in cols])
    stamp = F.col("timestamp" if "timestamp" in cols else "ts")
    index = F.row_number().over(Window.partitionBy(run).orderBy(*order)) - 1
    return events.select(run, index.cast("long").alias("index"), F.coalesce(kind, F.lit("unknown")).alias("event_type"), F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), F.coalesce(payload, F.lit("{}")).alias("payload"))


def chain_problems(events: DataFrame, run: str = "run_id") -> DataFrame:
    """run, sequence and problem: a previous-hash that is not the previous event's (declared, else computed over its payload), or a
    sequence that does not rise. Streams may count from 0 or 1; an empty previous-hash says nothing."""
    w = Window.partitionBy(run).orderBy("position")
    own = F.coalesce(F.nullif("event_sha256", F.lit("")), T.sha256(F.coalesce(T.canonical_json(F.col("payload")), F.col("payload"))))
    rows = events.withColumns({"_prev": F.lag(own).over(w), "_seq": F.lag("sequence").over(w)})
    broken = (F.coalesce("prev_event_sha256", F.lit("")) != "") & F.col("_prev").isNotNull() & (F.col("prev_event_sha256") != F.col("_prev"))
    back = F.col("sequence") <= F.col("_seq")
    return rows.select(run, "sequence", F.explode(F.array_compact(F.array(F.when(broken, "HASH_MISMATCH"), F.when(back, "SEQUENCE_REGRESSION")))).alias("problem"))


def ordinal_gaps(rows: DataFrame, run: str, ordinal: str, base: int = 0) -> DataFrame:
    """Rows whose ordinal is not their place in the run, counted from ``base``."""
    at = F.row_number().over(Window.partitionBy(run).orderBy(ordinal)) - 1 + base
    return rows.withColumn("expected", at.cast("long")).where(F.col(ordinal) != F.col("expected"))


def next_action(events: DataFrame, run: str, order: list[str], is_request: Column, is_action: Column, ident: str) -> DataFrame:
    """Forward as-of: each request with the first action after it in its run; many requests may share one; null if none follows.

    One sort of each run, latest event first: the last action before a row there is the first after it in time, kept as the frame grows."""
    ahead = Window.partitionBy(run).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    rows = events.withColumns({"_q": is_request, "_a": F.last(F.when(is_action, F.col(ident)), ignorenulls=True).over(ahead)})
    return rows.where("_q").select(run, F.col(ident).alias("request_id"), F.col("_a").alias("action_id"))


def lead_pairs(rows: DataFrame, run: str, order: list[str], first: Column, second: Column, ident: str, one_per_run: bool = False) -> DataFrame:
    """(run, first id, second id) of neighbours of which one has ``first`` and the next ``second``; the first such pair of a run if so asked."""
    w = Window.partitionBy(run).orderBy(*order)
    found = rows.withColumns({"_next": F.lead(F.col(ident)).over(w), "_then": F.lead(second).over(w), "_now": first, "_at": F.row_number().over(w)}).where("_now and _then")
    if one_per_run:
        found = found.withColumn("_r", F.row_number().over(Window.partitionBy(run).orderBy("_at"))).where("_r = 1")
    return found.select(run, F.col(ident).alias("first_id"), F.col("_next").alias("second_id"))


def structural_digest(events: DataFrame, run: str, order: list[str], n: int = 50) -> DataFrame:
    """run, n_events and a digest of its first n event types: equal for runs of the same shape."""
    w = Window.partitionBy(run).orderBy(*order)
    head = events.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).groupBy(run).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "event_type"))), lambda x: x["event_type"]), ">").alias("_shape"))
    return head.join(events.groupBy(run).agg(F.count("*").alias("n_events")), run).select(run, "n_events", T.sha256(F.col("_shape")).alias("structural_sha256"))


# Records of recipes -------------------------------------------------------------------------------------------------------------


def conversations(requests: DataFrame, responses: DataFrame, blobs: DataFrame, run: str = "run_id", min_bytes: int = 100) -> DataFrame:
    """run, request_id and messages: requests (run, request_id, blob) with their responses, bodies of ``min_bytes`` or more from the blob
    table (sha256, content), two messages or more."""
    body = lambda df, name: df.join(blobs.select(F.col("sha256").alias("blob"), F.col("content").alias(name)), "blob").drop("blob")
    both = body(requests, "ask").where(F.octet_length("ask") >= min_bytes).join(body(responses, "answer"), [run, "request_id"])
    msgs = F.from_json("ask", "struct<messages:array<struct<role:string,content:string>>>")["messages"]
    whole = F.concat(F.coalesce(msgs, F.expr("cast(array() as array<struct<role:string,content:string>>)")), F.array(F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content"))))
    return both.select(run, "request_id", whole.alias("messages")).where(F.size("messages") >= 2)


def tool_proposal(text: Column) -> Column:
    """A structured call (name, arguments as JSON) proposed by an assistant's text, in one of three shapes; null if there is none."""
    raw = F.coalesce(F.nullif(F.regexp_extract(text, r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>", 1), F.lit("")), F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit("")), F.when(F.trim(text).startswith("{"), F.trim(text)))
    v = F.try_parse_json(raw)
    name = F.coalesce(*[F.try_variant_get(v, p, "string") for p in ("$.name", "$.tool", "$.function.name")])
    args = F.coalesce(*[F.to_json(F.try_variant_get(v, p, "variant")) for p in ("$.arguments", "$.args", "$.function.arguments")], F.lit("{}"))
    return F.when(name.isNotNull(), F.struct(name.alias("name"), args.alias("arguments")))


def chat_recipe(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("messages") >= 2).select("*", F.lit("chat").alias("recipe"))


def tool_use_recipe(rows: DataFrame) -> DataFrame:
    call = tool_proposal(F.element_at("messages", -1)["content"])
    return rows.where(F.size("messages") >= 2).withColumn("call", call).where("call is not null").withColumn("recipe", F.lit("tool_use"))


def preference_recipe(rows: DataFrame, run: str, order: list[str]) -> DataFrame:
    """(run, prompt, rejected, chosen): a failed parse and the next record of its run, both of three messages or more, with differing answers."""
    w = Window.partitionBy(run).orderBy(*order)
    last = lambda m: F.element_at(m, -1)["content"]
    both = rows.withColumns({"_failed": F.col("parse_failed"), "_next": F.lead("messages").over(w)}).where("_failed and size(messages) >= 3 and size(_next) >= 3")
    return both.where(last(F.col("messages")) != last(F.col("_next"))).select(run, F.slice("messages", 1, F.size("messages") - 1).alias("prompt"), last(F.col("messages")).alias("rejected"), last(F.col("_next")).alias("chosen"))


def eval_recipe(rows: DataFrame, clip: int = 200) -> DataFrame:
    """Cases of three messages or more: what was asked and the reference answer, both clipped for display."""
    return rows.where(F.size("messages") >= 3).select("*", F.left(F.element_at("messages", -2)["content"], F.lit(clip)).alias("ask"), F.left(F.element_at("messages", -1)["content"], F.lit(clip)).alias("reference"))


def interactive_turns(turns: DataFrame, calls: DataFrame, run: str = "run_id") -> DataFrame:
    """Turns (run, turn, call_ids) with their calls (run, call_id, request, result), in the turn's order; a turn that names a call that is
    not there, or that has no result, is dropped."""
    named = turns.select(run, "turn", F.posexplode_outer("call_ids").alias("k", "call_id"))
    found = named.join(calls, [run, "call_id"], "left")
    whole = found.groupBy(run, "turn").agg(F.bool_and(F.col("call_id").isNull() | (F.col("request").isNotNull() & F.col("result").isNotNull())).alias("whole"), F.array_sort(F.collect_list(F.when(F.col("call_id").isNotNull(), F.struct("k", "call_id", "request", "result")))).alias("calls"))
    return whole.where("whole").drop("whole")


def treated(value: Column) -> Column:
    """A value as available, or unavailable with its reason: null, or a reference into the store that was not resolved."""
    reason = F.when(value.isNull(), "missing").when(value.rlike("(?:cas|sha256)://|artifacts/sha256/"), "unresolved_reference")
    return F.struct(F.when(reason.isNull(), "available").otherwise("unavailable").alias("state"), reason.alias("reason"), F.when(reason.isNull(), value).alias("value"))
