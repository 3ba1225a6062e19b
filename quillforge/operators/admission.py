"""Admission of records, rights, and leakage between splits.

A record is (record_id, schema_version, split, split_group_ids, rights_status, privacy_status, quality_review,
authorship_class, content_sha256, source_status, evaluation_status, assertion_sha256).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# What a record's fields must say to be admitted. All else, null included, blocks.
ADMISSIBLE_RIGHTS = ("TRANSFORMED_RELEASE_TEXT_ONLY_SOURCE_MATERIAL_EXCLUDED", "OPERATOR_OWNED_FULL_RIGHTS", "SYNTHETIC_ORIGINAL_FULL_RIGHTS", "MACHINE_RESULT_OPERATOR_OWNED")
ADMISSIBLE_PRIVACY = ("PASS_MANUAL_PUBLIC_REVIEW", "PASS_AUTOMATED_SCAN", "PASS_AUTOMATED_REDACTION", "PASS_AUTOMATED_SCAN_AND_MANUAL_REVIEW")
ADMISSIBLE_REVIEW = ("MANUAL_REVIEW_PASS", "AUTOMATED_REVIEW_PASS", "AUTOMATED_REVIEW_PASS_MANUAL_SPOT_CHECK")
ADMISSIBLE_AUTHORSHIP = ("operator_input", "operator_material", "machine_result", "model_prose", "model_reasoning", "model_tool_call", "telemetry", "mixed")
TRAINING, HELD_OUT = ("train", "preference"), ("heldout_eval",)
SPLITS = (*TRAINING, *HELD_OUT)


def held_out_groups(records: DataFrame) -> DataFrame:
    """Distinct split groups of held-out records, primary or not."""
    return records.where(F.col("split").isin(*HELD_OUT)).select(F.explode("split_group_ids").alias("group_id")).distinct()


def leaking(records: DataFrame, held_out: DataFrame | None = None) -> DataFrame:
    """record_id of training records of which any group is held out."""
    held = held_out_groups(records) if held_out is None else held_out
    return records.where(~F.col("split").isin(*HELD_OUT)).select("record_id", F.explode("split_group_ids").alias("group_id")).join(held, "group_id", "left_semi").select("record_id").distinct()


def schema_valid(version: Column) -> Column:
    """Required fields by version: the first accepts null statuses, the second needs PASSED, PASS and an assertion, the third also takes asserted rights."""
    base = F.col("record_id").isNotNull() & T.is_sha256(F.col("content_sha256")) & F.col("split").isin(*SPLITS) & (F.size("split_group_ids") > 0)
    bound = T.is_sha256(F.col("assertion_sha256")) & F.col("evaluation_status").isNotNull() & F.col("source_status").isNotNull()
    return F.coalesce(base & ((version == 1) | (version.isin(2, 3) & bound)), F.lit(False))


def source_ok() -> Column:
    v, s, e = F.col("schema_version"), F.col("source_status"), F.col("evaluation_status")
    return F.coalesce(F.when(v == 1, F.coalesce(s, F.lit("PASSED")).isin("PASSED") & F.coalesce(e, F.lit("PASS")).isin("PASS")).when(v == 2, (s == "PASSED") & (e == "PASS")).when(v == 3, s.isin("PASSED", "RIGHTS_ASSERTED") & (e == "PASS")), F.lit(False))


def admit(records: DataFrame, rights=ADMISSIBLE_RIGHTS, held_out: DataFrame | None = None) -> DataFrame:
    """``records`` with every reason that speaks against admission, and ``admitted``. A schema failure is the only reason given; the
    others add up. Null is on no list, so it blocks."""
    leaks = leaking(records, held_out).withColumn("_leaks", F.lit(True))
    rows = records.join(leaks, "record_id", "left")
    blocked = lambda c, allowed: ~F.coalesce(F.col(c).isin(*allowed), F.lit(False))
    shown = lambda c: F.coalesce(F.col(c), F.lit("null"))
    reasons = F.array_compact(F.array(
        F.when(blocked("split", TRAINING), F.concat(F.lit("split: "), shown("split"))),
        F.when(blocked("rights_status", rights), F.concat(F.lit("rights: "), shown("rights_status"))),
        F.when(blocked("authorship_class", ADMISSIBLE_AUTHORSHIP), F.concat(F.lit("authorship: "), shown("authorship_class"))),
        F.when(blocked("privacy_status", ADMISSIBLE_PRIVACY), F.concat(F.lit("privacy: "), shown("privacy_status"))),
        F.when(blocked("quality_review", ADMISSIBLE_REVIEW), F.concat(F.lit("quality_review: "), shown("quality_review"))),
        F.when(F.col("_leaks"), F.lit("leakage: a split group is held out")),
        F.when(~source_ok(), F.lit("source_status: not passed")),
    ))
    out = rows.withColumn("reasons", F.when(schema_valid(F.col("schema_version")), reasons).otherwise(F.array(F.lit("schema: invalid")))).drop("_leaks")
    return out.withColumn("admitted", F.size("reasons") == 0)


def reason_histogram(admitted: DataFrame) -> DataFrame:
    """Rejection reasons, each cut at ``;`` and ``(``, most first."""
    return admitted.where("not admitted").select(F.explode("reasons").alias("r")).groupBy(F.trim(F.regexp_extract("r", r"^[^;(]*", 0)).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def bind_rights(bundles: DataFrame, entries: DataFrame, keys: tuple[str, str, str] = ("artifact_id", "manifest_sha256", "head_sha256")) -> DataFrame:
    """Bundles with the ledger entries that bind to them: the first key equal, two equal keys or more, and no key that both have and that
    differs. Null never equals null. The first key is a condition of the join, so only entries of the same artefact meet."""
    b, e = bundles.alias("b"), entries.alias("e")
    both = [F.col(f"b.{k}").isNotNull() & F.col(f"e.{k}").isNotNull() for k in keys]
    equal = [F.coalesce(F.col(f"b.{k}") == F.col(f"e.{k}"), F.lit(False)) for k in keys]
    n = sum((x.cast("int") for x in equal), F.lit(0))
    clash = F.exists(F.array(*[a & ~x for a, x in zip(both, equal)]), lambda x: x)
    joined = b.join(e, F.col(f"b.{keys[0]}") == F.col(f"e.{keys[0]}"), "left")
    state = F.when(F.col(f"e.{keys[0]}").isNull(), "UNMATCHED").when(clash, "MISMATCH").when(n >= 2, "BOUND").otherwise("INSUFFICIENT")
    return joined.select("b.*", F.col("e.rights_status"), F.col("e.assertion_sha256"), state.alias("binding"))


def conflicts(entries: DataFrame) -> DataFrame:
    """Artefacts that one status gives more than one assertion."""
    return entries.groupBy("artifact_id", "rights_status").agg(F.countDistinct("assertion_sha256").alias("n_assertions")).where("n_assertions > 1")


def assertion_bodies(entries: DataFrame, bodies: DataFrame) -> DataFrame:
    """Entries with their assertion bodies (json), found by a digest made anew: a body that was altered is not found."""
    keyed = bodies.select(T.sha256(T.canonical_json(F.col("json"))).alias("assertion_sha256"), F.col("json").alias("assertion"))
    return entries.join(keyed.dropDuplicates(["assertion_sha256"]), "assertion_sha256", "left")


def lookup_one(registry: DataFrame, **wanted) -> dict | None:
    """The one entry with these values (those that are not None); none if there are several or no such."""
    rows = registry
    for k, v in wanted.items():
        rows = rows if v is None else rows.where(F.col(k) == v)
    found = rows.limit(2).collect()
    return found[0].asDict() if len(found) == 1 else None


def disposition(findings_severe: Column, imported: Column, asserted: Column) -> Column:
    """QUARANTINED on a severe finding; of imports RIGHTS_ASSERTED with an assertion, else HOLD; PASSED otherwise."""
    return F.when(findings_severe > 0, "QUARANTINED").when(imported & asserted, "RIGHTS_ASSERTED").when(imported, "HOLD").otherwise("PASSED")


def trusted(receipts: DataFrame, packs: DataFrame) -> DataFrame:
    """Receipts whose pack, version and hash are all on the list of trusted ones."""
    return receipts.join(packs, ["pack_id", "pack_version", "pack_sha256"], "left_semi")
