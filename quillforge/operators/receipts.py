"""Evaluation receipts, domain records and structural projections: gates before anything is written."""

from __future__ import annotations

import hashlib
import hmac
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .lot import canonical


class GateError(ValueError):
    """A receipt, record or pack that is refused; the message names the gate."""


def _require(ok: bool, gate: str) -> None:
    if not ok:
        raise GateError(gate)


@dataclass(frozen=True)
class TrustPolicy:
    """Issuers' keys, trusted packs (id, version, sha256) and the accepted major version."""

    issuer_keys: dict[str, bytes]
    packs: frozenset[tuple[str, str, str]]
    major: int = 1
    statuses: tuple[str, ...] = field(default=("PASS",))


def receipt_hash(receipt: dict) -> str:
    return hashlib.sha256(canonical({k: v for k, v in receipt.items() if k not in ("receipt_hash",)}).encode()).hexdigest()


def authentication_tag(receipt: dict, key: bytes) -> str:
    """HMAC-SHA256 over the receipt without its hash and tag. Keys stay on the driver and never enter a plan."""
    body = json.loads(canonical({k: v for k, v in receipt.items() if k != "receipt_hash"}))
    body.get("issuer", {}).get("authentication", {}).pop("tag", None)
    return hmac.new(key, canonical(body).encode(), hashlib.sha256).hexdigest()


def derived_status(checks: list[dict]) -> str:
    seen = {c.get("status") for c in checks}
    return next((s for s in ("ERROR", "FAIL", "HOLD") if s in seen), "PASS")


def verify_receipt(receipt: dict, bundle: dict, policy: TrustPolicy) -> str:
    """The receipt's status if every gate holds: version, hash, issuer, bundle, pack, counts, status. Fails at the first that does not."""
    version = str(receipt.get("schema_version", ""))
    _require(version.count(".") == 2 and version.split(".")[0] == str(policy.major), "version")
    _require(receipt.get("receipt_hash") == receipt_hash(receipt), "hash")
    issuer = receipt.get("issuer", {})
    key = policy.issuer_keys.get(issuer.get("issuer_id", ""))
    _require(key is not None and hmac.compare_digest(str(issuer.get("authentication", {}).get("tag", "")), authentication_tag(receipt, key)), "issuer")
    source = receipt.get("source", {})
    _require(all(source.get(k) is not None and source.get(k) == bundle.get(k) for k in ("bundle_hash", "manifest_hash")), "bundle")
    pack = receipt.get("evaluation_pack", {})
    _require((pack.get("pack_id"), pack.get("pack_version"), pack.get("pack_hash")) in policy.packs, "pack")
    checks, counts = receipt.get("evaluation", {}).get("checks", []), receipt.get("evaluation", {}).get("counts", {})
    found = {s: sum(c.get("status") == s for c in checks) for s in ("PASS", "HOLD", "FAIL", "ERROR")}
    _require(len(checks) == pack.get("check_count") and all(counts.get(s, 0) == n for s, n in found.items()) and len({c.get("check_id") for c in checks}) == len(checks), "counts")
    status = derived_status(checks)
    _require(status == receipt.get("status") and status in policy.statuses, "status")
    return status


# Domain records ------------------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Mold:
    """A declared shape: allowed values, least numbers and prefixes by path, and lists whose order says nothing."""

    name: str
    allowed: dict[str, tuple] = field(default_factory=dict)
    minimum: dict[str, int] = field(default_factory=dict)
    prefix: dict[str, str] = field(default_factory=dict)
    unordered: tuple[str, ...] = ()

    def sha256(self) -> str:
        return hashlib.sha256(canonical({"name": self.name, "allowed": {k: list(v) for k, v in self.allowed.items()}, "minimum": self.minimum, "prefix": self.prefix, "unordered": list(self.unordered)}).encode()).hexdigest()

    def gates(self, column: str = "json") -> Column:
        """Names of the gates that a record (JSON text) does not pass."""
        v = F.try_parse_json(column)
        get = lambda p, t: F.try_variant_get(v, f"$.{p}", t)
        bad = [F.when(~F.coalesce(get(p, "string").isin(*x), F.lit(False)), f"allowed:{p}") for p, x in self.allowed.items()]
        bad += [F.when(F.coalesce(get(p, "bigint") < x, F.lit(True)), f"minimum:{p}") for p, x in self.minimum.items()]
        bad += [F.when(~F.coalesce(get(p, "string").startswith(x), F.lit(False)), f"prefix:{p}") for p, x in self.prefix.items()]
        return F.array_compact(F.array(F.when(v.isNull(), "json"), *bad))

    def normalised(self, column: str = "json") -> Column:
        """The listed paths as sorted distinct lists, for a digest that their order does not change."""
        v = F.try_parse_json(column)
        return F.to_json(F.struct(F.to_json(v).alias("record"), *[F.array_sort(F.array_distinct(F.try_variant_get(v, f"$.{p}", "array<string>"))).alias(p.replace(".", "_")) for p in self.unordered]))


def cast_records(records: DataFrame, mold: Mold, column: str = "json") -> DataFrame:
    """``records`` with failing gates, core digest (over the normalised record and the mold) and ready."""
    out = records.withColumn("failed_gates", mold.gates(column))
    return out.withColumn("core_sha256", T.sha256(F.concat(F.lit(mold.sha256()), mold.normalised(column)))).withColumn("ready", F.size("failed_gates") == 0)


def route(records: DataFrame, routes: dict[str, str], family: str = "family") -> DataFrame:
    """``records`` with the processor of their family; an unknown family is held."""
    known = F.create_map(*[F.lit(x) for kv in routes.items() for x in kv])
    return records.withColumn("route", F.coalesce(F.element_at(known, F.col(family)), F.lit("HOLD")))


# Projections ----------------------------------------------------------------------------------------------------------------------------

HIDDEN = ("content", "text", "prompt", "answer", "oracle", "secret", "reasoning", "path")


def telemetry(events: DataFrame, run: str = "run_id", binding: Column | None = None) -> DataFrame:
    """Structure only: kinds, sizes and digests of events, a row digest, and what the rows are bound to. No content leaves."""
    payload = F.coalesce(F.col("payload"), F.lit(""))
    row = events.select(run, "index", "event_type", F.octet_length(payload).alias("payload_bytes"), T.sha256(payload).alias("payload_sha256"), (payload == "").alias("is_empty"), (F.lit(None).cast("string") if binding is None else binding).alias("source_binding"))
    return row.withColumn("row_sha256", T.sha256(F.to_json(F.struct(*row.columns))))


def verify_telemetry(rows: DataFrame, events: DataFrame, run: str = "run_id", binding: Column | None = None) -> DataFrame:
    """Rows that a new projection of their source does not give, or gives and they lack."""
    again = telemetry(events, run, binding).select(run, "index", F.col("row_sha256").alias("expected"))
    return rows.select(run, "index", "row_sha256").join(again, [run, "index"], "full").where(~F.coalesce(F.col("row_sha256") == F.col("expected"), F.lit(False)))


def portable(df: DataFrame, keep: list[str]) -> DataFrame:
    """The named columns, which of the others were left out, and a digest of the projection itself."""
    for c in keep:
        _require(c not in HIDDEN, f"hidden column: {c}")
    left = sorted(set(df.columns) - set(keep))
    out = df.select(*keep, F.array(*[F.lit(c) for c in left]).alias("omitted"))
    return out.withColumn("projection_sha256", T.sha256(F.to_json(F.struct(*out.columns))))


def hidden_keys(json_text: Column, hidden: tuple[str, ...] = HIDDEN) -> Column:
    """Hidden names that occur as keys anywhere in a JSON text: must be none in what is released."""
    return F.array_compact(F.array(*[F.when(json_text.rlike(f'"{k}"\\s*:'), k) for k in hidden]))
