"""Queries of admission, leakage, rights, lots and ledgers, over records derived from the supplied tables."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import admission as A
from ..operators import lot as L
from ..operators import receipts as R
from ..operators import suite
from .catalog import query, read

_RECORDS = """WITH rec AS (SELECT doc_id::VARCHAR AS record_id, (doc_id % 3 + 1)::INT AS schema_version, CASE WHEN doc_id % 17 = 0 THEN 'heldout_eval' WHEN doc_id % 7 = 0 THEN 'preference' ELSE 'train' END AS split, [source || '-' || (doc_id % 40)::VARCHAR, lang] AS groups,
CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'UNKNOWN' ELSE 'OPERATOR_OWNED_FULL_RIGHTS' END AS rights_status, CASE WHEN doc_id % 19 = 0 THEN 'RAW' ELSE 'PASS_AUTOMATED_SCAN' END AS privacy_status, 'AUTOMATED_REVIEW_PASS' AS quality_review, 'operator_material' AS authorship_class, sha256(coalesce(text, '')) AS content_sha256,
CASE WHEN doc_id % 23 = 0 THEN 'HOLD' ELSE 'PASSED' END AS source_status, 'PASS' AS evaluation_status, CASE WHEN doc_id % 29 = 0 THEN 'short' ELSE sha256(source) END AS assertion_sha256 FROM documents),
held AS (SELECT DISTINCT unnest(groups[1:1]) AS g FROM rec WHERE split = 'heldout_eval'), leaks AS (SELECT DISTINCT record_id FROM rec, held WHERE split <> 'heldout_eval' AND g = groups[1])"""


def records(spark, d):
    """Records derived from ``documents`` by rules on ids, so that every check has something to find."""
    docs, i = read(spark, d, "documents"), F.col("doc_id")
    when = lambda n, v, other: F.when(i % n == 0, F.lit(v)).otherwise(other)
    return docs.select(i.cast("string").alias("record_id"), (i % 3 + 1).cast("int").alias("schema_version"), when(17, "heldout_eval", when(7, "preference", F.lit("train"))).alias("split"), F.array(F.concat("source", F.lit("-"), (i % 40).cast("string"))).alias("split_group_ids"), when(11, None, when(13, "UNKNOWN", F.lit("OPERATOR_OWNED_FULL_RIGHTS"))).alias("rights_status"), when(19, "RAW", F.lit("PASS_AUTOMATED_SCAN")).alias("privacy_status"), F.lit("AUTOMATED_REVIEW_PASS").alias("quality_review"), F.lit("operator_material").alias("authorship_class"), T.sha256(F.coalesce("text", F.lit(""))).alias("content_sha256"), when(23, "HOLD", F.lit("PASSED")).alias("source_status"), F.lit("PASS").alias("evaluation_status"), F.when(i % 29 == 0, "short").otherwise(T.sha256(F.col("source"))).alias("assertion_sha256"))


@query("split_leakage", _RECORDS + " SELECT record_id FROM leaks")
def split_leakage(spark, d):
    return A.leaking(records(spark, d))


_ADMIT = _RECORDS + """, r AS (SELECT rec.*, l.record_id IS NOT NULL AS leaks FROM rec LEFT JOIN leaks l USING (record_id)), bad AS (SELECT record_id, CASE WHEN schema_version > 1 AND assertion_sha256 = 'short' THEN ['schema: invalid'] ELSE list_filter([
CASE WHEN split = 'heldout_eval' THEN 'split: heldout_eval' END, CASE WHEN coalesce(rights_status, 'null') <> 'OPERATOR_OWNED_FULL_RIGHTS' THEN 'rights: ' || coalesce(rights_status, 'null') END, CASE WHEN privacy_status = 'RAW' THEN 'privacy: RAW' END, CASE WHEN leaks THEN 'leakage: a split group is held out' END, CASE WHEN source_status = 'HOLD' THEN 'source_status: not passed' END], lambda x: x IS NOT NULL) END AS reasons FROM r)"""


@query("admission_reasons", _ADMIT + " SELECT record_id, array_to_string(reasons, '|') AS reasons, len(reasons) = 0 AS admitted FROM bad")
def admission_reasons(spark, d):
    return A.admit(records(spark, d)).select("record_id", F.array_join("reasons", "|").alias("reasons"), "admitted")


@query("admission_histogram", _ADMIT + " SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM bad) GROUP BY reason")
def admission_histogram(spark, d):
    return A.reason_histogram(A.admit(records(spark, d)))


@query("rights_binding", """WITH b AS (SELECT o_orderkey, o_custkey AS k1, o_orderstatus AS k2, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS k3 FROM orders), e AS (SELECT c_custkey AS k1, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'O' END AS k2, '1-URGENT' AS k3 FROM customer)
SELECT CASE WHEN e.k1 IS NULL THEN 'UNMATCHED' WHEN b.k2 <> e.k2 OR (b.k3 IS NOT NULL AND b.k3 <> e.k3) THEN 'MISMATCH' ELSE 'BOUND' END AS binding, count(*) AS n FROM b LEFT JOIN e ON b.k1 = e.k1 GROUP BY 1""")
def rights_binding(spark, d):
    keys = ("artifact_id", "manifest_sha256", "head_sha256")
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    bundles = o.select(F.col("o_custkey").alias(keys[0]), F.col("o_orderstatus").alias(keys[1]), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias(keys[2]))
    entries = c.select(F.col("c_custkey").alias(keys[0]), F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("O").alias(keys[1]), F.lit("1-URGENT").alias(keys[2]), F.lit("LICENSED").alias("rights_status"), F.lit("").alias("assertion_sha256"))
    return A.bind_rights(bundles, entries, keys).groupBy("binding").agg(F.count("*").alias("n"))


@query("ledger_conflicts", "SELECT o_custkey AS artifact_id, o_orderstatus AS rights_status, count(DISTINCT o_orderpriority) AS n_assertions FROM orders GROUP BY ALL HAVING count(DISTINCT o_orderpriority) > 1")
def ledger_conflicts(spark, d):
    return A.conflicts(read(spark, d, "orders").select(F.col("o_custkey").alias("artifact_id"), F.col("o_orderstatus").alias("rights_status"), F.col("o_orderpriority").alias("assertion_sha256")))


@query("file_digest_tree", "WITH f AS (SELECT source, sha256(coalesce(text, '')) || '  ' || doc_id::VARCHAR AS line FROM documents) SELECT source, sha256(string_agg(line, chr(10) ORDER BY line)) AS tree_sha256, count(*) AS n_files FROM f GROUP BY source")
def file_digest_tree(spark, d):
    files = read(spark, d, "documents").select("source", T.sha256(F.coalesce("text", F.lit(""))).alias("sha256"), F.col("doc_id").cast("string").alias("path"))
    return L.tree_digest(files, ["source"])


def lot(spark, d):
    """Sources, decisions, rows and the row map of a lot made of ``documents``."""
    docs, i = read(spark, d, "documents"), F.col("doc_id")
    ingots = docs.select(F.concat(F.lit("ing-"), i.cast("string")).alias("ingot_id"), T.sha256(F.coalesce("text", F.lit(""))).alias("ingot_sha256"), F.concat("source", F.lit("/"), (i % 50).cast("string")).alias("split_group_id"), F.when(i % 10 == 0, "validation").otherwise("train").alias("proposed_role"), F.lit(False).alias("eval_eligible"), "lang", (F.length(F.coalesce("text", F.lit(""))) < 200).alias("_short"))
    decisions = L.decide(ingots, F.when(F.col("_short"), "EXCLUDE").otherwise("INCLUDE"), F.when(F.col("_short"), F.array(F.lit("TOO_SHORT"))).otherwise(F.expr("cast(array() as array<string>)")), "0" * 64, "1" * 64)
    rows = L.assign_split(decisions).withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), F.col("lang").alias("content"))))
    mapped = L.row_map(rows, ["ingot_id"], ["ingot_id", "split", "lang"])
    dataset = mapped.select("split", "row_index", "row_sha256", "ingot_id").join(rows.select("ingot_id", "split_group_id", "messages"), "ingot_id")
    return mapped, dataset, ingots, decisions


_LOT = """WITH i AS (SELECT doc_id, 'ing-' || doc_id::VARCHAR AS ingot_id, sha256(coalesce(text, '')) AS sha, source || '/' || (doc_id % 50)::VARCHAR AS grp, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split, lang, length(coalesce(text, '')) < 200 AS short FROM documents),
m AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY ingot_id) - 1 AS row_index, sha256('{"ingot_id":"' || ingot_id || '",' || coalesce('"lang":"' || lang || '",', '') || '"split":"' || split || '"}') AS h FROM i WHERE NOT short)"""


@query("lot_row_map", _LOT + " SELECT split || '-' || lpad(row_index::VARCHAR, 7, '0') AS record_id, split, row_index, h AS row_sha256, ingot_id, sha AS ingot_sha256 FROM m")
def lot_row_map(spark, d):
    return lot(spark, d)[0].drop("decision_id")


_LOT_COUNTS = {
    "row_hashes_match": "FROM mm FULL JOIN r ON mm.split = r.split AND mm.row_index = r.row_index WHERE coalesce(mm.h <> r.h, true)",
    "sources_match": "FROM mm LEFT JOIN s USING (ingot_id) WHERE coalesce(s.sha <> mm.sha, true)",
    "decisions_match": "FROM mm LEFT JOIN e USING (ingot_id) WHERE coalesce(e.decision <> 'INCLUDE', true)",
    "record_ids_unique": "FROM (SELECT split, row_index FROM mm GROUP BY ALL HAVING count(*) > 1)",
    "places_unique": "FROM (SELECT split, row_index FROM mm GROUP BY ALL HAVING count(*) > 1)",
    "enough_training_rows": "FROM (SELECT count(*) AS n FROM r WHERE split = 'train') WHERE n < 1",
    "enough_turns": "FROM r WHERE false",
    "no_group_leaks": "FROM r WHERE split <> 'eval' AND grp IN (SELECT grp FROM r WHERE split = 'eval')",
    "no_excluded_source": "FROM mm WHERE ingot_id IN (SELECT ingot_id FROM e WHERE decision <> 'INCLUDE')",
    "sources_declared": "FROM mm WHERE ingot_id NOT IN (SELECT ingot_id FROM s)",
    "sources_included": "FROM mm WHERE ingot_id NOT IN (SELECT ingot_id FROM e WHERE decision = 'INCLUDE')",
    "every_source_decided": "FROM s FULL JOIN e USING (ingot_id) WHERE s.sha IS NULL OR e.decision IS NULL",
}
_LOT_FAULTS = _LOT + """, mm AS (SELECT * REPLACE (CASE WHEN doc_id % 41 = 0 THEN '' ELSE h END AS h) FROM (SELECT * FROM m UNION ALL SELECT * FROM m WHERE doc_id % 61 = 0)),
r AS (SELECT * REPLACE (CASE WHEN doc_id % 67 = 0 THEN 'eval' ELSE split END AS split) FROM m), s AS (SELECT ingot_id, CASE WHEN doc_id % 47 = 0 THEN '' ELSE sha END AS sha FROM i WHERE doc_id % 53 <> 0),
e AS (SELECT ingot_id, CASE WHEN short OR doc_id % 59 = 0 THEN 'EXCLUDE' ELSE 'INCLUDE' END AS decision FROM i WHERE doc_id % 43 <> 0) """


@query("lot_checks", _LOT_FAULTS + 'SELECT "check", n = 0 AS ok, CASE WHEN n > 0 THEN n::VARCHAR || \' rows\' ELSE \'\' END AS detail FROM (' + " UNION ALL ".join(f"SELECT '{c}' AS \"check\", count(*) AS n {q}" for c, q in _LOT_COUNTS.items()) + ")")
def lot_checks(spark, d):
    """A lot with faults of seven kinds, planted by rules on ids: every check says how many rows it finds."""
    mapped, dataset, sources, decisions = lot(spark, d)
    hits = lambda n: F.substring("ingot_id", 5, 20).cast("long") % n == 0
    mapped = mapped.unionByName(mapped.where(hits(61))).withColumn("row_sha256", F.when(hits(41), "").otherwise(F.col("row_sha256")))
    dataset = dataset.withColumn("split", F.when(hits(67), "eval").otherwise(F.col("split")))
    sources = sources.where(~hits(53)).withColumn("ingot_sha256", F.when(hits(47), "").otherwise(F.col("ingot_sha256")))
    decisions = decisions.where(~hits(43)).withColumn("decision", F.when(hits(59), "EXCLUDE").otherwise(F.col("decision")))
    return L.verify_lot(spark, mapped, dataset, sources, decisions)


@query("lot_checks_sound", "SELECT unnest([" + ", ".join(f"'{c}'" for c in _LOT_COUNTS) + "]) AS \"check\", true AS ok, '' AS detail")
def lot_checks_sound(spark, d):
    """The same lot without faults passes them all."""
    return L.verify_lot(spark, *lot(spark, d))


@query("derived_status", "SELECT count(*) FILTER (o_orderstatus = 'F') AS n_pass, count(*) FILTER (o_orderstatus = 'O') AS n_hold, count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 2 = 0) AS n_fail, count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 2 = 1) AS n_error, CASE WHEN count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 2 = 1) > 0 THEN 'ERROR' WHEN count(*) FILTER (o_orderstatus = 'P') > 0 THEN 'FAIL' WHEN count(*) FILTER (o_orderstatus = 'O') > 0 THEN 'HOLD' ELSE 'PASS' END AS status FROM orders")
def derived_status(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "PASS").when(F.col("o_orderstatus") == "O", "HOLD").when(F.col("o_orderkey") % 2 == 0, "FAIL").otherwise("ERROR")
    return suite.derived_status(read(spark, d, "orders").select(status.alias("status")))


@query("telemetry_rows", "SELECT event_id, event_type, octet_length(props::BLOB)::INT AS payload_bytes, sha256(props) AS payload_sha256, props = '' AS is_empty FROM events")
def telemetry_rows(spark, d):
    e = read(spark, d, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("index"), "event_type", F.col("props").alias("payload"))
    return R.telemetry(e).select(F.col("index").alias("event_id"), "event_type", "payload_bytes", "payload_sha256", "is_empty")


@query("source_accounting", "SELECT count(*) AS n_unaccounted FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)")
def source_accounting(spark, d):
    return read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels"), "doc_id", "left_anti").agg(F.count("*").alias("n_unaccounted"))
