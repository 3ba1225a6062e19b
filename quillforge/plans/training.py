"""Queries of masking, formats, shards and token statistics over ``conversations``."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chat as M
from ..operators import datacard as D
from .catalog import query, read


@query("loss_weight_turns", "SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN 1.0 ELSE 0.0 END::DOUBLE AS loss_weight FROM conversations")
def loss_weight_turns(spark, d):
    return read(spark, d, "conversations").select("conv_id", "turn", "role", M.loss_weight(F.col("role")).alias("loss_weight"))


@query("chat_format", "SELECT conv_id, sha256(string_agg(role || ':' || coalesce(text, ''), chr(10) ORDER BY turn)) AS messages_sha256, count(*) AS n_messages, sum((role = 'assistant')::INT)::DOUBLE AS weight FROM conversations GROUP BY conv_id")
def chat_format(spark, d):
    m = M.formatted(M.traces(read(spark, d, "conversations")), "chat")
    line = F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "\n")
    return m.select("conv_id", T.sha256(line).alias("messages_sha256"), F.size("messages").cast("long").alias("n_messages"), F.aggregate("messages", F.lit(0.0), lambda a, x: a + x["loss_weight"]).alias("weight"))


_FROM = "CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' WHEN 'function' THEN 'tool' ELSE role END"


@query("turn_pair_format", f"SELECT conv_id, turn, {_FROM} AS speaker, coalesce(text, '') AS value FROM conversations")
def turn_pair_format(spark, d):
    m = M.formatted(M.traces(read(spark, d, "conversations")), "turn_pair").select("conv_id", F.posexplode("conversations").alias("turn", "c"))
    return m.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("c.from").alias("speaker"), F.col("c.value").alias("value"))


@query("block_format", """SELECT conv_id, coalesce(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) FILTER (role = 'system'), '') AS system, count(*) FILTER (role <> 'system') AS n_messages FROM conversations GROUP BY conv_id""")
def block_format(spark, d):
    m = M.formatted(M.traces(read(spark, d, "conversations")), "block")
    return m.select("conv_id", F.col("record.system").alias("system"), F.size("record.messages").cast("long").alias("n_messages"))


@query("block_format_groups", """WITH f AS (SELECT conv_id, turn, role, CASE WHEN role IN ('tool', 'function') AND coalesce(lag(role) OVER w IN ('tool', 'function', 'user'), false) THEN 0 ELSE 1 END AS opens FROM conversations WHERE role <> 'system' WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, role, (sum(opens) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) - 1)::BIGINT AS message_no FROM f""")
def block_format_groups(spark, d):
    return M.output_message_groups(read(spark, d, "conversations")).select("conv_id", "turn", "role", F.col("message_no").cast("long").alias("message_no"))


@query("shard_assignment", """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS row_index FROM documents)
SELECT doc_id, lang, row_index, row_index // 100 AS shard, lang || '-' || lpad((row_index // 100)::VARCHAR, 5, '0') AS file FROM r""")
def shard_assignment(spark, d):
    return M.shards(read(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], "lang", 100)


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))"
_EST = f"greatest({_WORDS}, ceil(length(coalesce(text, '')) / 4.0))::BIGINT"
_COUNTS = f"WITH c AS (SELECT conv_id, sum(CASE WHEN role IN ('user', 'system') THEN {_EST} ELSE 0 END)::BIGINT AS prompt_tokens, 0::BIGINT AS reasoning_tokens, sum((role IN ('tool', 'function'))::INT)::BIGINT AS tool_turns FROM conversations GROUP BY conv_id)"
_STATS = ", ".join(f"sum({c})::BIGINT AS {c}_total, round(avg({c}), 2) AS {c}_mean, min({c}) AS {c}_min, max({c}) AS {c}_max" for c in ("prompt_tokens", "reasoning_tokens", "tool_turns"))


@query("token_counts_by_conversation", _COUNTS + " SELECT * FROM c")
def token_counts_by_conversation(spark, d):
    return D.record_counts(read(spark, d, "conversations"))


@query("token_stats", _COUNTS + f" SELECT count(*) AS n_records, {_STATS} FROM c")
def token_stats(spark, d):
    return D.token_statistics(D.record_counts(read(spark, d, "conversations")))


@query("token_estimates", f"SELECT doc_id, {_EST} AS estimate FROM documents")
def token_estimates(spark, d):
    return read(spark, d, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("estimate"))


@query("taxonomy", "SELECT DISTINCT tag FROM (SELECT 'lang:' || lang AS tag FROM documents UNION ALL SELECT 'source:' || source FROM documents) WHERE tag IS NOT NULL")
def taxonomy(spark, d):
    return D.taxonomy(read(spark, d, "documents"), lang="lang", source="source")


@query("event_messages", "SELECT conv_id, turn, role, coalesce(text, '') AS content, CASE WHEN role = 'assistant' THEN 1.0 ELSE 0.0 END::DOUBLE AS loss_weight FROM conversations WHERE role IN ('system', 'user', 'assistant')")
def event_messages(spark, d):
    kind = F.when(F.col("role") == "system", "system.prompt").when(F.col("role") == "user", "user.input").when(F.col("role") == "assistant", "model.response").otherwise("heartbeat")
    names = F.when(F.col("role") == "user", F.to_json(F.struct(F.col("text").alias("prompt")))).when(F.col("role") == "system", F.to_json(F.struct(F.col("text").alias("instruction")))).otherwise(F.to_json(F.struct(F.col("text").alias("content"))))
    events = read(spark, d, "conversations").select("conv_id", "turn", kind.alias("type"), names.alias("payload"))
    return M.messages_from_events(events).select("conv_id", "turn", "message.role", "message.content", "message.loss_weight")
