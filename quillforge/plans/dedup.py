"""Queries of seed curation over ``documents``."""

from pyspark.sql import functions as F

from ..operators import contamination as C
from ..operators import dedup as D
from .catalog import query, read
from .contamination import _GRAMS, _TOKS

_NORM = r"trim(regexp_replace(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+', ' ', 'g'))"


@query("dedup_exact", f"WITH h AS (SELECT doc_id, sha256({_NORM}) AS text_hash FROM documents) SELECT doc_id, text_hash, min(doc_id) OVER (PARTITION BY text_hash) AS survivor FROM h")
def dedup_exact(spark, d):
    return D.exact_duplicates(read(spark, d, "documents"))


@query("dedup_ngram_set", f"""WITH t AS (SELECT doc_id, {_TOKS} AS toks FROM documents), g AS (SELECT doc_id, gram FROM (SELECT doc_id, {_GRAMS} FROM t WHERE len(toks) >= 13) UNION ALL SELECT doc_id, array_to_string(toks, ' ') FROM t WHERE len(toks) < 13),
k AS (SELECT doc_id, sha256(string_agg(gram, chr(10) ORDER BY gram)) AS set_key FROM (SELECT DISTINCT doc_id, gram FROM g) GROUP BY doc_id) SELECT doc_id, min(doc_id) OVER (PARTITION BY set_key) AS survivor FROM k""")
def dedup_ngram_set(spark, d):
    return D.equal_sets(read(spark, d, "documents"))


@query("dedup_near_pairs")
def dedup_near_pairs(spark, d):
    found = D.accept_similar(C.signatures(read(spark, d, "documents"), ["doc_id"]), "doc_id")
    return found.where("survivor is not null").select(F.col("survivor").alias("lo"), F.col("doc_id").alias("hi"), "jaccard")


@query("dedup_audit")
def dedup_audit(spark, d):
    return D.audit(read(spark, d, "documents"), read(spark, d, "benchmark"))


@query("curation_summary")
def curation_summary(spark, d):
    return D.summary(D.audit(read(spark, d, "documents"), read(spark, d, "benchmark")))


@query("curation_breakdown_lang")
def curation_breakdown_lang(spark, d):
    docs = read(spark, d, "documents")
    return D.breakdown(D.audit(docs, read(spark, d, "benchmark")), docs, "lang")
