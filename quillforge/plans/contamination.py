"""Queries over ``documents`` and ``conversations`` against ``benchmark``."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import contamination as C
from .catalog import query, read

_TOKEN_SQL = r"[A-Za-z0-9_]+|[^\p{L}\p{N}_\s\p{Z}\x0B\x1C-\x1F\x{85}]"
_TOKS = f"list_transform(regexp_extract_all(coalesce(text, ''), '{_TOKEN_SQL}'), lambda x: lower(x))"
_GRAMS = "unnest([array_to_string(toks[i:i+12], ' ') for i in range(1, len(toks) - 11)]) AS gram, unnest(range(0, len(toks) - 12)) AS pos"
_HITS = """
WITH b AS (SELECT item_id, @TOKS@ AS toks FROM benchmark), bg AS (SELECT item_id, @ITEM@ FROM b),
d AS (SELECT @KEYS@, @TOKS@ AS toks FROM @TABLE@), dg AS (SELECT @KEYS@, @GRAMS@ FROM d),
hits AS (SELECT @DKEYS@, dg.pos, bg.item_id, bg.item_pos FROM dg JOIN bg ON dg.gram = bg.gram)"""


def _hits(keys: str, table: str) -> str:
    named = ", ".join(f"dg.{k}" for k in keys.split(", "))
    sql = _HITS
    for mark, value in (("@ITEM@", _GRAMS.replace("AS pos", "AS item_pos")), ("@GRAMS@", _GRAMS), ("@DKEYS@", named), ("@KEYS@", keys), ("@TABLE@", table), ("@TOKS@", _TOKS)):
        sql = sql.replace(mark, value)
    return sql


_DOC_HITS, _TURN_HITS = _hits("doc_id", "documents"), _hits("conv_id, turn", "conversations")
_REPORT = """, agg AS (SELECT doc_id, count(*) AS n_hits, count(DISTINCT pos) AS n_positions FROM hits GROUP BY doc_id),
rep AS (SELECT d.doc_id, len(toks) AS n_tokens, greatest(len(toks) - 12, 0) AS n_ngrams, coalesce(n_hits, 0) AS n_hits, coalesce(n_positions, 0) AS n_positions FROM d LEFT JOIN agg USING (doc_id)),
fin AS (SELECT *, CASE WHEN n_ngrams > 0 THEN round(100.0::DOUBLE * n_positions / n_ngrams, 4) ELSE 0.0 END AS overlap_pct,
CASE WHEN n_ngrams = 0 THEN 'NOT_CHECKED' WHEN n_positions > 0 THEN 'CONTAMINATED' ELSE 'CLEAN' END AS status FROM rep)"""


@query("contam_ngram_hits", _DOC_HITS + " SELECT doc_id, pos, item_id, item_pos FROM hits")
def contam_ngram_hits(spark, d):
    return C.ngram_hits(read(spark, d, "documents"), C.postings(read(spark, d, "benchmark")), ["doc_id"]).select("doc_id", F.col("pos").cast("long").alias("pos"), "item_id", F.col("item_pos").cast("long").alias("item_pos"))


@query("contam_doc_report", _DOC_HITS + _REPORT + " SELECT doc_id, n_tokens, n_ngrams, n_hits, n_positions, overlap_pct, status FROM fin")
def contam_doc_report(spark, d):
    out = C.doc_report(read(spark, d, "documents"), read(spark, d, "benchmark"), ["doc_id"])
    return out.withColumns({c: F.col(c).cast("long") for c in ("n_tokens", "n_ngrams")})


@query("contam_spans", _DOC_HITS + """, flag AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 1 THEN 0 ELSE 1 END AS fresh FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY pos, item_id, item_pos)),
isl AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos, item_id, item_pos ROWS UNBOUNDED PRECEDING) AS island FROM flag)
SELECT doc_id, min(pos) AS start_token, max(pos) + 13 AS end_token, arg_min(item_id, (pos, item_id, item_pos)) AS item_id, count(DISTINCT pos) AS n_positions FROM isl GROUP BY doc_id, island""")
def contam_spans(spark, d):
    spans = C.flagged_spans(C.ngram_hits(read(spark, d, "documents"), C.postings(read(spark, d, "benchmark")), ["doc_id"]), ["doc_id"])
    return spans.select("doc_id", F.col("start_token").cast("long").alias("start_token"), F.col("end_token").cast("long").alias("end_token"), "item_id", "n_positions")


@query("contam_conversation_report", _TURN_HITS + """, agg AS (SELECT conv_id, turn, count(*) AS n_hits, count(DISTINCT pos) AS n_positions FROM hits GROUP BY ALL),
rep AS (SELECT d.conv_id, d.turn, len(toks) AS n_tokens, greatest(len(toks) - 12, 0) AS n_ngrams, coalesce(n_hits, 0) AS n_hits, coalesce(n_positions, 0) AS n_positions FROM d LEFT JOIN agg USING (conv_id, turn))
SELECT conv_id, count(*) AS scanned_turns, sum(n_tokens)::BIGINT AS n_tokens, sum(n_ngrams)::BIGINT AS n_ngrams, sum(n_hits)::BIGINT AS n_hits, sum(n_positions)::BIGINT AS n_positions,
CASE WHEN sum(n_ngrams) > 0 THEN round(100.0::DOUBLE * sum(n_positions) / sum(n_ngrams), 4) ELSE 0.0 END AS overlap_pct, (count(*) FILTER (n_positions > 0))::BIGINT AS flagged_turns FROM rep GROUP BY conv_id""")
def contam_conversation_report(spark, d):
    return C.conversation_report(read(spark, d, "conversations"), read(spark, d, "benchmark"))


@query("contam_partition", _DOC_HITS + _REPORT + " SELECT status <> 'CONTAMINATED' AS is_clean, count(*) AS n FROM fin GROUP BY 1")
def contam_partition(spark, d):
    docs = read(spark, d, "documents")
    clean, dirty = C.split_clean(docs, C.doc_report(docs, read(spark, d, "benchmark"), ["doc_id"]), ["doc_id"])
    return clean.select(F.lit(True).alias("is_clean")).unionAll(dirty.select(F.lit(False).alias("is_clean"))).groupBy("is_clean").agg(F.count("*").alias("n"))


_SMALL = ", ".join(f"min(((('0x' || h)::UBIGINT)::HUGEINT * {a}::HUGEINT + {b}::HUGEINT) % {C.PRIME}::HUGEINT)::BIGINT AS m{k}" for k, (a, b) in enumerate(C.parameters(2)))


@query("minhash_signature_small", f"WITH d AS (SELECT doc_id, {_TOKS} AS toks FROM documents), g AS (SELECT doc_id, substr(sha256(gram), 1, 15) AS h FROM (SELECT doc_id, {_GRAMS} FROM d)) SELECT doc_id, {_SMALL} FROM g GROUP BY doc_id")
def minhash_signature_small(spark, d):
    grams = read(spark, d, "documents").select("doc_id", T.tokens(F.col("text")).alias("toks")).select("doc_id", F.explode(T.ngrams(F.col("toks"))).alias("gram"))
    return C.signature_native(grams, ["doc_id"], n=2)


@query("minhash_benchmark_argmax")
def minhash_benchmark_argmax(spark, d):
    return C.most_similar(read(spark, d, "documents"), read(spark, d, "benchmark"), ["doc_id"])
