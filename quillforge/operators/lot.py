"""Product lots: decisions, group-aware splits, row maps, digests, verification."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import suite
from .checkpoints import materialised, numbered

ARTEFACTS = ("manifest.json", "dataset/train.jsonl", "dataset/validation.jsonl", "record_map.jsonl", "decisions.jsonl", "sources.jsonl", "spec.json", "rubric.json", "datacard.json", "SHA256SUMS")
MIN_RECORDS = 1


def decide(ingots: DataFrame, decision: Column, reasons: Column, spec_sha256: str, rubric_sha256: str) -> DataFrame:
    """A decision for each ingot (ingot_id, ingot_sha256), bound to the spec, the rubric and itself by digests."""
    rows = ingots.withColumns({"decision": decision, "reason_codes": F.array_sort(reasons), "spec_sha256": F.lit(spec_sha256), "rubric_sha256": F.lit(rubric_sha256)})
    body = F.to_json(F.struct("decision", "ingot_id", "ingot_sha256", "reason_codes", "rubric_sha256", "spec_sha256"))
    return rows.withColumn("decision_id", F.concat(F.lit("dec_"), F.substring(T.sha256(body), 1, 16))).withColumn("decision_sha256", T.sha256(body))


def assign_split(decisions: DataFrame, validation_pct: int = 10) -> DataFrame:
    """Included ingots with their split: an evaluation flag outranks the proposed role; the rest by a hash of the split group, so a group
    is whole in one split."""
    included = decisions.where("decision = 'INCLUDE'")
    by_hash = F.when(F.pmod(F.xxhash64("split_group_id"), F.lit(100)) < validation_pct, "validation").otherwise("train")
    return included.withColumn("split", F.when(F.coalesce("eval_eligible", F.lit(False)), "eval").when(F.col("proposed_role").isin("train", "validation", "eval"), F.col("proposed_role")).otherwise(by_hash))


def split_leaks(rows: DataFrame) -> DataFrame:
    """Groups that stand in more than one of training (train and validation count as one) and evaluation."""
    side = F.when(F.col("split").isin("train", "validation"), "train").otherwise("eval")
    return rows.select("split_group_id", side.alias("side")).groupBy("split_group_id").agg(F.countDistinct("side").alias("n")).where("n > 1").select("split_group_id")


def row_map(rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """record_id, split, row_index (from 0, by split, in order), row_sha256 of the canonical row, and the ingot it came from."""
    digest = T.sha256(T.canonical_json(F.to_json(F.struct(*columns))))
    kept = rows.select("split", *[c for c in order if c not in ("split", "ingot_id", "ingot_sha256", "decision_id")], digest.alias("row_sha256"), "ingot_id", "ingot_sha256", "decision_id")
    return numbered(kept, "split", order).select(F.concat(F.col("split"), F.format_string("-%07d", "row_index")).alias("record_id"), "split", "row_index", "row_sha256", "ingot_id", "ingot_sha256", "decision_id")


def tree_digest(files: DataFrame, group: list[str]) -> DataFrame:
    """``group`` and the digest of its sorted ``digest  path`` lines: a file list of a lot, not its data."""
    return files.groupBy(*group).agg(T.sha256(F.array_join(F.array_sort(F.collect_list(F.concat_ws("  ", "sha256", "path"))), "\n")).alias("tree_sha256"), F.count("*").alias("n_files"))


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """path (relative), sha256 and size of every file below ``folder``, read by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = folder.rstrip("/").removeprefix("file:")
    return files.select(F.regexp_replace("path", f"^.*?{root}/", "").alias("path"), F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("size"))


def verify_map(mapped: DataFrame, dataset: DataFrame, sources: DataFrame, decisions: DataFrame) -> list[DataFrame]:
    """Every claim of a row map, derived anew: against the rows by place, the source ledger and the decisions."""
    m, rows = mapped.alias("m"), dataset.alias("r")
    at = m.join(rows, (F.col("m.split") == F.col("r.split")) & (F.col("m.row_index") == F.col("r.row_index")), "full")
    src = mapped.join(sources.select("ingot_id", F.col("ingot_sha256").alias("_sha")), "ingot_id", "left")
    dec = mapped.join(decisions.select("decision_id", F.col("ingot_id").alias("_ingot"), F.col("ingot_sha256").alias("_sha"), F.col("decision").alias("_decision")), "decision_id", "left")
    return [
        suite.check(at, "row_hashes_match", F.col("m.row_sha256") != F.col("r.row_sha256")),
        suite.check(src, "sources_match", F.col("_sha") != F.col("ingot_sha256")),
        suite.check(dec, "decisions_match", (F.col("_ingot") != F.col("ingot_id")) | (F.col("_sha") != F.col("ingot_sha256")) | (F.col("_decision") != "INCLUDE")),
        suite.unique(mapped, "record_ids_unique", "record_id"),
        suite.unique(mapped, "places_unique", "split", "row_index"),
    ]


def substance(dataset: DataFrame, minimum: int = MIN_RECORDS, min_turns: int = 1, roles: tuple[str, ...] = (), validation: bool = False) -> list[DataFrame]:
    """Enough training rows (a rubric may raise the least number, never lower it), validation rows if any are promised, enough turns, and the roles that must be there."""
    train = dataset.where("split = 'train'")
    least = max(MIN_RECORDS, minimum)
    checks = [suite.check(train.agg(F.count("*").alias("n")), "enough_training_rows", F.col("n") < least), suite.check(dataset, "enough_turns", F.size("messages") < min_turns)]
    if validation:
        checks.append(suite.check(dataset.agg(F.count_if(F.col("split") == "validation").alias("n")), "validation_rows_present", F.col("n") == 0))
    have = F.transform("messages", lambda m: m["role"])
    return checks + [suite.check(dataset, f"role_{r}_present", ~F.array_contains(have, r)) for r in roles]


def verify_lot(spark: SparkSession, mapped: DataFrame, dataset: DataFrame, sources: DataFrame, decisions: DataFrame, folder: str | None = None, **floor) -> DataFrame:
    """All checks of a lot as (check, ok, detail). What a dozen checks read (keys, digests, roles; no contents) is saved once."""
    mapped, decisions = materialised(mapped), materialised(decisions.select("decision_id", "ingot_id", "ingot_sha256", "decision"))
    sources = materialised(sources.select("ingot_id", "ingot_sha256"))
    dataset = materialised(dataset.select("split", "row_index", "row_sha256", "split_group_id", F.transform("messages", lambda m: F.struct(m["role"].alias("role"))).alias("messages")))
    train = dataset.where("split in ('train', 'validation')")
    held, excluded = dataset.where("split = 'eval'"), decisions.where("decision <> 'INCLUDE'")
    checks = verify_map(mapped, dataset, sources, decisions) + substance(dataset, **floor)
    checks += [suite.disjoint(train, held, "no_group_leaks", "split_group_id"), suite.disjoint(mapped, excluded, "no_excluded_source", "ingot_id"), suite.contained(mapped, sources, "sources_declared", "ingot_id"), suite.contained(mapped, decisions.where("decision = 'INCLUDE'"), "sources_included", "ingot_id"), suite.same_keys(sources, decisions, "every_source_decided", "ingot_id")]
    if folder is not None:
        checks += [suite.fact(spark, f"file:{a}", os.path.isfile(os.path.join(folder, a))) for a in ARTEFACTS] + [checksums(spark, folder)]
    return suite.run(checks)


DISPOSITIONS = ("ACCEPT", "REJECT", "HOLD")
REVIEW = "ingot_id string, disposition string, reviewer_type string, reason string"


def hold_all(source: dict) -> dict:
    """The reviewer where none is named: nothing is accepted."""
    return {"disposition": "HOLD", "reviewer_type": "unconfigured", "reason": "no reviewer is configured"}


def accept_fixtures(source: dict) -> dict:
    """A reviewer for lots made of fixtures only."""
    return {"disposition": "ACCEPT", "reviewer_type": "fixture", "reason": ""}


def review(sources: DataFrame, reviewer: Callable[[dict], dict] = hold_all) -> DataFrame:
    """A review (ingot_id, disposition, reviewer_type, reason) of each source by a callback, on the executors. A callback that fails, answers
    for another source, or gives no known disposition holds that source; that it returns is no acceptance."""

    def rows(batches):
        for b in batches:
            out = []
            for source in b.to_dict("records"):
                try:
                    r = reviewer(dict(source))
                    if r["disposition"] not in DISPOSITIONS:
                        raise ValueError("unknown disposition")
                    if r.get("ingot_id") not in (None, source["ingot_id"]):
                        raise ValueError("a review of another source")
                    out.append((source["ingot_id"], r["disposition"], str(r.get("reviewer_type", "")), str(r.get("reason", ""))))
                except Exception as e:  # noqa: BLE001
                    out.append((source["ingot_id"], "HOLD", "error", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["ingot_id", "disposition", "reviewer_type", "reason"])

    return sources.mapInPandas(rows, REVIEW)


def review_checks(spark: SparkSession, sources: DataFrame, reviews: DataFrame, fixture_only: bool = False, production: bool = False) -> list[DataFrame]:
    """Every source accepted; one review a source and none besides; fixture reviews in lots of fixtures only, and these not in production."""
    reviews, fixture = materialised(reviews), F.col("reviewer_type") == "fixture"
    both = sources.groupBy("ingot_id").agg(F.count("*").alias("_s")).join(reviews.groupBy("ingot_id").agg(F.count("*").alias("_r")), "ingot_id", "full")
    return [
        suite.check(sources.select("ingot_id").join(reviews, "ingot_id", "left"), "review_accepts", F.col("disposition") != "ACCEPT"),
        suite.check(both, "review_attributed", (F.col("_s") != 1) | (F.col("_r") != 1)),
        suite.check(reviews, "reviewer_scope", fixture & F.lit(not fixture_only)),
        suite.check(reviews, "review_mode", F.lit(production) & (fixture | F.lit(fixture_only))),
        suite.check(sources.agg(F.count("*").alias("n")), "review_present", F.col("n") == 0),
    ]


def lot_gaps(results: DataFrame, required: tuple[str, ...]) -> list[str]:
    """Required checks that are missing, and checks that are not ok, sorted."""
    seen = results.groupBy(F.lit(1)).agg(F.collect_set("check").alias("have"), F.collect_set(F.when(~F.col("ok"), F.col("check"))).alias("bad"))  # a row a check
    row = seen.select(suite.gaps(F.array_except(F.array(*map(F.lit, required)), F.col("have")), F.col("bad")).alias("g")).first()
    return row["g"] if row else sorted(required)


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """ok if SHA256SUMS lists exactly the files of the folder, with their digests."""
    listed = spark.read.text(os.path.join(folder, "SHA256SUMS")).select(F.split("value", "  ", 2).alias("p")).select(F.col("p")[1].alias("path"), F.col("p")[0].alias("listed"))
    both = file_digests(spark, folder).where("path <> 'SHA256SUMS'").join(listed, "path", "full")
    return suite.check(both, "checksums_match", F.col("sha256") != F.col("listed"))


def safe_path(path: Column) -> Column:
    """A relative path that stays inside its root."""
    return F.coalesce((path != "") & ~path.startswith("/") & ~path.rlike(r"(^|/)\.\.(/|$)") & ~path.contains("\\"), F.lit(False))


# The driver writes a lot's small files; rows are written by Spark -------------------------------------------------------------------------


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def sha256_file(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def folder_sums(folder: str) -> list[tuple[str, str]]:
    found = sorted(str(p.relative_to(folder)) for p in Path(folder).rglob("*") if p.is_file() and p.name != "SHA256SUMS")
    return [(sha256_file(os.path.join(folder, p)), p) for p in found]


def seal_lot(folder: str, manifest: dict) -> str:
    """Writes manifest.json (with its own digest) and SHA256SUMS; the lot's hash covers every file, the manifest without its digest."""
    body = {k: v for k, v in manifest.items() if k != "manifest_sha256"}
    body["manifest_sha256"] = hashlib.sha256(canonical(body).encode()).hexdigest()
    Path(folder, "manifest.json").write_text(canonical(body) + "\n", encoding="utf-8")
    sums = folder_sums(folder)
    Path(folder, "SHA256SUMS").write_text("".join(f"{d}  {p}\n" for d, p in sums), encoding="utf-8")
    return lot_hash(folder)


def lot_hash(folder: str) -> str:
    lines = []
    for digest, path in folder_sums(folder):
        if path == "manifest.json":
            body = json.loads(Path(folder, path).read_text(encoding="utf-8"))
            digest = hashlib.sha256(canonical({k: v for k, v in body.items() if k != "manifest_sha256"}).encode()).hexdigest()
        lines.append(f"{digest}  {path}")
    return hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()
