"""A vault: content-addressed lots and an append-only ledger, under one lock. Files of the driver; lots are checked before they move."""

from __future__ import annotations

import contextlib
import datetime as dt
import fcntl
import hashlib
import json
import os
import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lot import canonical, lot_hash

REQUIRED_CHECKS = ("row_hashes_match", "sources_match", "decisions_match", "record_ids_unique", "places_unique", "enough_training_rows", "enough_turns", "no_group_leaks", "no_excluded_source", "sources_declared", "sources_included", "every_source_decided", "checksums_match")
LEDGER = "product_id string, product_version string, lot_sha256 string, report_sha256 string, status string, admitted_at string, location string, rights_status string, action string, reason string, entry_sha256 string"


class VaultError(ValueError):
    """A lot or request that the vault refuses."""


def report_gaps(results: DataFrame, spark: SparkSession) -> list[str]:
    """Required checks that a report lacks or that are not ok: one anti join."""
    required = spark.createDataFrame([(c,) for c in REQUIRED_CHECKS], "check string")
    return sorted(r["check"] for r in required.join(results.where("ok"), "check", "left_anti").collect())


class Vault:
    def __init__(self, root: str, clock: Callable[[], str] | None = None):
        self.root, self.clock = Path(root), clock or (lambda: dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
        for d in ("objects", "staging"):
            (self.root / d).mkdir(parents=True, exist_ok=True)

    @contextlib.contextmanager
    def _locked(self):
        with open(self.root / ".lock", "w") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            yield

    @property
    def ledger_path(self) -> Path:
        return self.root / "ledger.jsonl"

    def rows(self) -> list[dict]:
        return [json.loads(x) for x in self.ledger_path.read_text(encoding="utf-8").splitlines()] if self.ledger_path.exists() else []

    def ledger(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LEDGER).json(str(self.ledger_path)) if self.ledger_path.exists() else spark.createDataFrame([], LEDGER)

    def _append(self, row: dict) -> dict:
        row = row | {"entry_sha256": hashlib.sha256(canonical(row).encode()).hexdigest()}
        with open(self.ledger_path, "a", encoding="utf-8") as f:
            f.write(canonical(row) + "\n")
            f.flush()
            os.fsync(f.fileno())
        return row

    def admit(self, folder: str, product_id: str, version: str, report: dict, rights_status: str) -> dict:
        """Admits a lot whose report passes and names it. The same lot again changes nothing; another under its name and version is refused."""
        if not product_id or not version:
            raise VaultError("a product needs an id and a version")
        if any(p.is_symlink() for p in Path(folder).rglob("*")) or Path(folder).is_symlink():
            raise VaultError("links are not admitted")
        with self._locked():
            digest = lot_hash(folder)
            if report.get("status") != "PASS" or report.get("lot_sha256") != digest or report.get("gaps"):
                raise VaultError("no passing report of this lot")
            same = [r for r in self.rows() if (r["product_id"], r["product_version"]) == (product_id, version) and r["action"] == "admit"]
            if same and same[-1]["lot_sha256"] != digest:
                raise VaultError("another lot has this id and version")
            if same:
                return same[-1]
            staged, final = self.root / "staging" / digest, self.root / "objects" / digest
            shutil.rmtree(staged, ignore_errors=True)
            shutil.copytree(folder, staged)
            if lot_hash(str(staged)) != digest:
                shutil.rmtree(staged)
                raise VaultError("the lot changed while it was copied")
            if final.exists():
                shutil.rmtree(staged)
            else:
                os.rename(staged, final)
            return self._append({"product_id": product_id, "product_version": version, "lot_sha256": digest, "report_sha256": hashlib.sha256(canonical(report).encode()).hexdigest(), "status": report["status"], "admitted_at": self.clock(), "location": f"objects/{digest}", "rights_status": rights_status, "action": "admit", "reason": ""})

    def withdraw(self, product_id: str, version: str, reason: str) -> dict:
        """A new row of the ledger; the object and its rows stay."""
        with self._locked():
            mine = [r for r in self.rows() if (r["product_id"], r["product_version"]) == (product_id, version)]
            if not mine or not reason:
                raise VaultError("nothing to withdraw, or no reason given")
            if mine[-1]["action"] == "withdraw":
                return mine[-1]
            return self._append({k: v for k, v in mine[-1].items() if k != "entry_sha256"} | {"action": "withdraw", "reason": reason, "admitted_at": self.clock()})

    def publish(self, *_) -> None:
        raise VaultError("the vault does not publish")

    def inspect(self, spark: SparkSession) -> DataFrame:
        """The latest row of each product and version."""
        rows = self.ledger(spark).withColumn("_n", F.monotonically_increasing_id())
        return rows.groupBy("product_id", "product_version").agg(F.max_by(F.struct(*[f.name for f in rows.schema if f.name not in ("product_id", "product_version", "_n")]), "_n").alias("r")).select("product_id", "product_version", "r.*")


def ledger_conflicts(ledger: DataFrame) -> DataFrame:
    """Products and versions that were admitted with different lots."""
    return ledger.where("action = 'admit'").groupBy("product_id", "product_version").agg(F.countDistinct("lot_sha256").alias("n_lots")).where("n_lots > 1")
