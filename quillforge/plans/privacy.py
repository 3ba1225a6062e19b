"""Queries over personal data, secrets and licences."""

from pyspark.sql import functions as F

from ..functions import license as L
from ..functions import pii as P
from ..functions import text as T
from ..operators import release as R
from ..operators import sanitize as S
from .catalog import query, read


def _lit(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_BY_RULE = " UNION ALL ".join(f"SELECT '{r.name}' AS rule, '{r.category}' AS category, len(regexp_extract_all(coalesce(text, ''), {_lit(r.pattern)})) AS k FROM documents" for r in P.RULES)


@query("pii_findings_by_rule", f"SELECT rule, category, sum(k)::BIGINT AS n, count(*) AS n_rows FROM ({_BY_RULE}) WHERE k > 0 GROUP BY ALL")
def pii_findings_by_rule(spark, d):
    return S.counts_by_rule(read(spark, d, "documents"))


_BY_TURN = _BY_RULE.replace("FROM documents", "FROM conversations")


@query("pii_findings_in_conversations", f"SELECT rule, category, sum(k)::BIGINT AS n, count(*) AS n_rows FROM ({_BY_TURN}) WHERE k > 0 GROUP BY ALL")
def pii_findings_in_conversations(spark, d):
    return S.counts_by_rule(read(spark, d, "conversations"))


@query("pii_findings_by_category")
def pii_findings_by_category(spark, d):
    return S.counts_by_category(S.scan(read(spark, d, "documents").select("doc_id", "text")))


_EMAIL = next(r for r in P.RULES if r.name == "email")


@query("pii_email_redacted", f"SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), {_lit(_EMAIL.pattern)}, '[REDACTED:EMAIL]', 'g')) AS clean_sha256, len(regexp_extract_all(coalesce(text, ''), {_lit(_EMAIL.pattern)})) AS n FROM documents")
def pii_email_redacted(spark, d):
    out = S.sanitise(read(spark, d, "documents").select("doc_id", "text"), rules=(_EMAIL,))
    return out.select("doc_id", T.sha256(F.col("clean_text")).alias("clean_sha256"), F.size("applied").cast("long").alias("n"))


@query("pii_residual_check")
def pii_residual_check(spark, d):
    return S.sanitise(read(spark, d, "documents").select("doc_id", "text")).groupBy("is_clean").agg(F.count("*").alias("n"), F.sum("n_residual").alias("n_residual"))


@query("pii_receipts")
def pii_receipts(spark, d):
    return S.receipts(S.sanitise(read(spark, d, "documents").select("doc_id", "text")), "doc_id")


_BITS = "-list_sum(list_transform(list_distinct(regexp_extract_all(token, '.')), lambda c: (len(token) - len(replace(token, c, ''))) / len(token)::DOUBLE * log2((len(token) - len(replace(token, c, ''))) / len(token)::DOUBLE)))"
_CLASSES = " + ".join(f"regexp_matches(token, '{p}')::INT" for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))


@query("entropy_tokens", f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{P.ENTROPY_TOKEN}')) AS token FROM documents),
x AS (SELECT *, {_BITS} AS bits FROM t) SELECT doc_id, token FROM x WHERE CASE WHEN regexp_full_match(token, '[0-9a-fA-F]{{64}}') THEN bits >= {P.MIN_HEX_BITS} ELSE {_CLASSES} >= {P.MIN_CLASSES} AND bits >= {P.MIN_BITS} END""")
def entropy_tokens(spark, d):
    return S.entropy_findings(read(spark, d, "documents"), "doc_id")


_M = lambda p: f"regexp_matches(t, {_lit(p)})"
_HITS = [" + ".join(f"{_M(p)}::INT" for p in ps) for _, ps in L.SIGNATURES]
_N = f"list_max([{', '.join(f'{{n: {h}, k: {-k}}}' for k, h in enumerate(_HITS))}])"
_IDS = "[" + ", ".join(f"'{name}'" for name, _ in L.SIGNATURES) + "]"


def _category(x: str) -> str:
    copyleft = f"regexp_matches({x}, '^(?:{'|'.join(L.COPYLEFT_PREFIXES)})') OR {x} IN ({', '.join(_lit(c) for c in L.COPYLEFT)})"
    return f"CASE WHEN {x} IN ({', '.join(_lit(c) for c in L.PERMISSIVE)}) THEN 'PERMISSIVE' WHEN {copyleft} THEN 'COPYLEFT' WHEN regexp_matches({x}, '-NC-|-NC$|-ND') THEN 'PROPRIETARY' ELSE 'UNKNOWN' END"


_LICENSE = f"""WITH a AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, t, {_N} AS best, regexp_extract(t, 'SPDX-License-Identifier:[ ]*([A-Za-z0-9.+-]+)', 1) AS spdx FROM a),
c AS (SELECT doc_id, CASE WHEN spdx <> '' THEN upper(spdx) WHEN {_M(L.PROPRIETARY)} THEN 'PROPRIETARY' WHEN best.n > 0 THEN ({_IDS})[1 - best.k] ELSE 'UNKNOWN' END AS license_id,
CASE WHEN spdx <> '' THEN 1.0 WHEN {_M(L.PROPRIETARY)} THEN 0.95 WHEN best.n >= 2 THEN 0.95 WHEN best.n = 1 THEN 0.8 ELSE 0.0 END::DOUBLE AS confidence FROM b),
lic AS (SELECT doc_id, license_id, CASE WHEN license_id = 'PROPRIETARY' THEN 'PROPRIETARY' ELSE {_category('license_id')} END AS category, confidence FROM c)"""


@query("license_class_by_doc", _LICENSE + " SELECT * FROM lic")
def license_class_by_doc(spark, d):
    return read(spark, d, "documents").select("doc_id", L.classify_text(F.col("text")).alias("l")).select("doc_id", "l.*")


@query("license_gate", _LICENSE + " SELECT category, category = 'PERMISSIVE' AS compliant, count(*) AS n FROM lic GROUP BY ALL")
def license_gate(spark, d):
    rows = read(spark, d, "documents").select(L.classify_text(F.col("text"))["category"].alias("category"))
    return rows.groupBy("category", (F.col("category") == "PERMISSIVE").alias("compliant")).agg(F.count("*").alias("n"))


@query("conversation_trees")
def conversation_trees(spark, d):
    rows = read(spark, d, "conversations").select("conv_id", "turn", F.to_json(F.struct("role", F.col("text").alias("content"))).alias("json"))
    return S.release_rows(rows).select("conv_id", "turn", T.sha256(F.col("clean_json")).alias("clean_sha256"), "n_findings", "n_residual", "released")


_STRINGS = "((role IS NOT NULL)::BIGINT + (text IS NOT NULL)::BIGINT)"
_BYTES = "(coalesce(4 + strlen(role), 0) + coalesce(7 + strlen(text), 0))"


@query("release_coverage", "SELECT " + ", ".join(f"sum({x})::BIGINT AS {n}{s}" for s in ("", "_scanned") for n, x in (("keys", _STRINGS), ("values", _STRINGS), ("bytes", _BYTES))) + ", 0::BIGINT AS n_refused FROM conversations")
def release_coverage(spark, d):
    return R.coverage(read(spark, d, "conversations").select(F.to_json(F.struct("role", F.col("text").alias("content"))).alias("json")))


@query("release_verified", "SELECT 'CURRENT' AS status, count(*) AS n, 0::BIGINT AS n_problems FROM conversations")
def release_verified(spark, d):
    """Every turn is released with a receipt, and every receipt verified against what was released."""
    rows = read(spark, d, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("id"), F.to_json(F.struct("role", F.col("text").alias("content"))).alias("json"))
    return R.verify(R.release(rows, "id"), "id").groupBy("status").agg(F.count("*").alias("n"), F.sum(F.size("problems")).cast("long").alias("n_problems"))
