"""Casting a sealed bundle into an ingot, and the licence audit of a repository."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import license as L
from ..functions import pii as P
from ..functions import text as T
from ..sources import readers
from . import events as E
from . import sanitize as S
from .lot import canonical
from .receipts import GateError, TrustPolicy, verify_receipt

EVENT = "run_id string, sequence long, event_type string, name string, payload string, event_sha256 string, prev_event_sha256 string, timestamp string"


def cast_bundle(spark: SparkSession, root: str, out: str, receipt: dict | None = None, policy: TrustPolicy | None = None, imported: bool = False, rights_asserted: bool = False, clock: Callable[[], str] = lambda: "") -> dict:
    """The ingot of a bundle. Seal and receipt are checked before anything is written; events are checked for their chain, redacted, and
    written as two streams, clean events and findings without their matches. A severe finding quarantines the ingot, its redacted events notwithstanding."""
    bundle = readers.bundle(spark, root)
    status = None
    if policy is not None:
        if receipt is None:
            raise GateError("a receipt is required")
        status = verify_receipt(receipt, {"bundle_hash": bundle["manifest_sha256"], "manifest_hash": bundle["manifest_sha256"]}, policy)
    if os.path.exists(out):
        raise GateError("the output folder exists")
    rows = readers.events(spark, bundle["events/events.ndjson"], EVENT).withColumn("position", F.col("line_no").cast("int"))
    problems = E.chain_problems(rows).groupBy("problem").count().collect()  # two kinds at most
    scanned = S.sanitise(rows.withColumn("payload", F.coalesce("payload", F.lit("{}"))), "payload").cache()
    severe = F.size(F.filter("applied", lambda f: f["rule"].isin(*[k for k, r in enumerate(P.RULES) if r.severe])))
    totals = scanned.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("applied")), F.lit(0)).alias("findings"), F.coalesce(F.sum(severe), F.lit(0)).alias("severe"), F.coalesce(F.sum("n_residual"), F.lit(0)).alias("residual")).first()
    digest = scanned.agg(T.sha256(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", T.sha256(F.col("clean_text")).alias("d")))), lambda x: x["d"]), "\n")).alias("d")).first()["d"]
    shape = E.structural_digest(rows, "run_id", ["position"]).agg(T.sha256(F.array_join(F.array_sort(F.collect_list("structural_sha256")), "\n"))).first()[0]
    scanned.select("run_id", "position", "event_type", F.col("clean_text").alias("payload")).write.json(f"{out}/events")
    scanned.select("run_id", "position", F.explode("applied").alias("f")).select("run_id", "position", "f.start", "f.end", "f.category").write.json(f"{out}/findings")
    scanned.unpersist()
    quarantined = totals.severe > 0 or totals.residual > 0
    ingot = {"schema_id": "ingot.v1", "bundle_manifest_sha256": bundle["manifest_sha256"], "n_events": totals.n, "findings": totals.findings, "severe_findings": totals.severe, "residual": totals.residual, "chain": {r["problem"]: r["count"] for r in problems}, "receipt_status": status, "exact_sha256": digest, "structural_sha256": shape}
    ingot["disposition"] = "QUARANTINED" if quarantined else "RIGHTS_ASSERTED" if imported and rights_asserted else "HOLD" if imported or problems else "PASSED"
    ingot["ingot_id"] = "ing-" + hashlib.sha256(canonical(ingot).encode()).hexdigest()[:16]
    Path(out, "ingot.json").write_text(canonical(ingot | {"cast_at": clock()}) + "\n", encoding="utf-8")
    return ingot


MAX_SOURCES, HEADER_CHARS = 25, 2000


def audit_repository(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """(category, evidence): licence files, three kinds of manifests, and SPDX tags at the head of at most MAX_SOURCES sources, by path. One
    copyleft or proprietary licence decides; without any evidence the category is unknown."""
    files = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), "value")
    named = F.coalesce(F.nullif(F.regexp_extract("value", r'"license"\s*:\s*"([^"]+)"', 1), F.lit("")), F.nullif(F.regexp_extract("value", r'(?m)^\s*license\s*=\s*(?:\{\s*text\s*=\s*)?"([^"]+)"', 1), F.lit("")))
    text = files.where(F.lower("name").rlike(r"^(licen[sc]e|copying|unlicense)(\.[a-z]+)?$")).select("path", F.lit("license_file").alias("kind"), L.classify_text(F.col("value"))["category"].alias("category"))
    manifest = files.where(F.col("name").isin("package.json", "pyproject.toml", "Cargo.toml") & named.isNotNull()).select("path", F.lit("manifest").alias("kind"), L.classify_identifier(named).alias("category"))
    heads = files.where(F.col("name").rlike(r"\.(py|js|ts|rs|go|java|c|cc|cpp|h|rb|sh)$")).orderBy("path").limit(MAX_SOURCES).withColumn("spdx", L.spdx_header(F.left("value", F.lit(HEADER_CHARS)))).where("spdx <> ''")
    evidence = text.unionByName(manifest).unionByName(heads.select("path", F.lit("spdx").alias("kind"), L.classify_identifier(F.col("spdx")).alias("category"))).cache()
    seen = {r["category"] for r in evidence.select("category").distinct().collect()}
    return next((c for c in ("PROPRIETARY", "COPYLEFT", "UNKNOWN", "PERMISSIVE") if c in seen), "UNKNOWN"), evidence
