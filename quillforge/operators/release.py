"""Release of single rows and files: what was scanned, receipts, and the verifier that holds a receipt against its row."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pii as P
from ..functions import text as T
from . import sanitize as S
from .checkpoints import materialised
from .lot import canonical, file_digests

POLICY, OLD_POLICY = "row-release.v2", "row-release.v1"
FIELDS = ("policy", "record_sha256", "ruleset_sha256", "input_sha256", "output_sha256", "changed", "n_findings", "findings_by_category", "n_residual", "coverage", "status", "receipt_sha256")
OLD_FIELDS = tuple(f for f in FIELDS if f != "coverage")
CURRENT, INTEGRITY_ONLY, INVALID = "CURRENT", "INTEGRITY_ONLY", "INVALID"


def _sha(value) -> str:
    return hashlib.sha256((value if isinstance(value, str) else canonical(value)).encode("utf-8", "surrogatepass")).hexdigest()


def expected_coverage(tree) -> dict[str, int]:
    """Keys, strings and their bytes that a scan of ``tree`` must visit, counted by a walk of its own."""
    keys = values = size = 0
    todo = [tree]
    while todo:
        node = todo.pop()
        if isinstance(node, dict):
            keys += len(node)
            size += sum(len(k.encode("utf-8", "surrogatepass")) for k in node)
            todo += node.values()
        elif isinstance(node, list):
            todo += node
        elif isinstance(node, str):
            values += 1
            size += len(node.encode("utf-8", "surrogatepass"))
    return {"keys": keys, "values": values, "bytes": size}


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Places of high-entropy tokens in one string, by the rule of ``functions.pii.is_high_entropy``."""
    from math import log2

    out = []
    for m in re.finditer(P.ENTROPY_TOKEN, text):
        t = m.group()
        bits = -sum(n / len(t) * log2(n / len(t)) for n in (t.count(c) for c in set(t)))
        classes = sum(bool(re.search(p, t)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        if bits >= P.MIN_HEX_BITS if re.fullmatch("[0-9a-fA-F]{64}", t) else classes >= P.MIN_CLASSES and bits >= P.MIN_BITS:
            out.append(m.span())
    return out


def _digest_field(name: str | None) -> bool:
    """Fields whose name declares a digest may hold one."""
    return name is not None and name.lower().endswith(("sha256", "digest", "hash"))


def treat(tree, digests: bool = True):
    """(clean tree, findings by category, what was scanned). Rules first, then high-entropy tokens; a digest stands in a field that declares one."""
    counts, seen, compiled = {}, {"keys": 0, "values": 0, "bytes": 0}, S._compiled(P.RULES)

    def string(text: str, kind: str, name: str | None) -> str:
        seen[kind] += 1
        seen["bytes"] += len(text.encode("utf-8", "surrogatepass"))
        found: list = []
        clean = S._redact_string(text, compiled, "", found)
        for f in found:
            counts[f[2]] = counts.get(f[2], 0) + 1
        declared = digests and _digest_field(name) and re.fullmatch("[0-9a-f]{64}", clean)
        for start, end in [] if declared else reversed(entropy_spans(clean)):
            clean = f"{clean[:start]}[REDACTED:HIGH_ENTROPY]{clean[end:]}"
            counts["HIGH_ENTROPY"] = counts.get("HIGH_ENTROPY", 0) + 1
        return clean

    def walk(node, name=None):
        if isinstance(node, str):
            return string(node, "values", name)
        if isinstance(node, list):
            return [walk(x, name) for x in node]
        if isinstance(node, dict):
            out = {}
            for k, v in node.items():
                key = string(k, "keys", None)
                if key in out:
                    raise S.TreeError("redacted keys collide")
                out[key] = walk(v, k)
            return out
        return node

    return walk(tree), dict(sorted(counts.items())), seen


def release_row(raw: str, record_id: str) -> tuple[str, dict]:
    """(clean JSON, receipt) of one row. Residual findings, a scan that missed text, and findings that don't fit the change are errors."""
    row = S.parse_strict(raw)
    if not isinstance(row, dict):
        raise S.TreeError("a row is an object")
    clean, counts, seen = treat(row)
    _, residual, again = treat(clean)
    changed = canonical(clean) != canonical(row)
    if residual:
        raise S.TreeError("findings are left")
    if seen != expected_coverage(row) or again != expected_coverage(clean):
        raise S.TreeError("not all text was scanned")
    if bool(counts) != changed:
        raise S.TreeError("findings do not fit the change")
    body = {"policy": POLICY, "record_sha256": _sha(record_id), "ruleset_sha256": S.ruleset_digest(), "input_sha256": _sha(row), "output_sha256": _sha(clean), "changed": changed, "n_findings": sum(counts.values()), "findings_by_category": counts, "n_residual": 0, "coverage": {"input": seen, "output": again}, "status": "PASS_REDACTED" if changed else "PASS_SCANNED"}
    return canonical(clean), body | {"receipt_sha256": _sha(body)}


def verify_row(receipt: dict, raw: str, record_id: str | None = None) -> tuple[str, list[str]]:
    """(status, problems): CURRENT if the receipt of the present policy holds against the row as it is now; one of the old policy, which knew no
    coverage, is INTEGRITY_ONLY and admits nothing; any other is INVALID. Names of unknown fields are not repeated."""
    problems: list[str] = []
    say = lambda bad, what: problems.append(what) if bad else None
    known = {POLICY: (FIELDS, CURRENT), OLD_POLICY: (OLD_FIELDS, INTEGRITY_ONLY)}
    if not isinstance(receipt, dict):
        return INVALID, ["the receipt is no object"]
    fields, status = known.get(receipt.get("policy") if isinstance(receipt.get("policy"), str) else None, (FIELDS, INVALID))
    say(status == INVALID, "unknown policy")
    missing, extra = sorted(set(fields) - set(receipt)), len(set(receipt) - set(fields))
    say(missing, f"missing: {', '.join(missing)}")
    say(extra, f"{extra} unknown fields")
    for f in ("record_sha256", "ruleset_sha256", "input_sha256", "output_sha256", "receipt_sha256"):
        say(not re.fullmatch("[0-9a-f]{64}", str(receipt.get(f))), f"{f} is no digest")
    try:
        row = S.parse_strict(raw)
    except S.TreeError as e:
        return INVALID, [*problems, f"row: {e}"]
    say(receipt.get("output_sha256") != _sha(row), "the row is another one")
    say(record_id is not None and receipt.get("record_sha256") != _sha(record_id), "the record is another one")
    say(status == CURRENT and receipt.get("ruleset_sha256") != S.ruleset_digest(), "other rules")
    counts, n, changed = receipt.get("findings_by_category"), receipt.get("n_findings"), receipt.get("changed")
    fine = isinstance(counts, dict) and all(type(v) is int and v > 0 for v in counts.values())
    say(not fine or type(n) is not int or sum(counts.values()) != n, "counts of findings do not add up")
    say(type(changed) is not bool or changed != (receipt.get("input_sha256") != receipt.get("output_sha256")), "changed does not fit the digests")
    say(type(n) is int and (n > 0) != (changed is True), "findings do not fit the change")
    say(type(receipt.get("n_residual")) is not int or receipt["n_residual"] != 0, "residual findings")
    say(receipt.get("status") != ("PASS_REDACTED" if changed is True else "PASS_SCANNED"), "status does not fit the change")
    _, residual, seen = treat(row) if status == CURRENT else (None, S.redact_tree(row)[1], None)
    say(residual, "the row has findings")
    if status == CURRENT:
        cover = receipt.get("coverage") if isinstance(receipt.get("coverage"), dict) else {}
        say(cover.get("output") != expected_coverage(row) or cover.get("output") != seen, "coverage of the row differs")
        say(changed is False and cover.get("input") != cover.get("output"), "coverage of an unchanged row differs")
    say(receipt.get("receipt_sha256") != _sha({k: v for k, v in receipt.items() if k != "receipt_sha256"}), "the receipt's own digest differs")
    return (INVALID, problems) if problems else (status, [])


def release(df: DataFrame, key: str, column: str = "json") -> DataFrame:
    """key, clean_json, receipt (JSON) and error: of a row that may not be released the error only."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, raw in zip(b["k"], b["v"]):
                try:
                    clean, receipt = release_row(raw if isinstance(raw, str) else "", k if isinstance(k, str) else "")
                    out.append((k, clean, canonical(receipt), None))
                except S.TreeError as e:
                    out.append((k, None, None, str(e)))
            yield pd.DataFrame(out, columns=["k", "clean_json", "receipt", "error"])

    made = df.select(F.col(key).cast("string").alias("k"), F.col(column).alias("v")).mapInPandas(rows, "k string, clean_json string, receipt string, error string")
    return made.withColumnRenamed("k", key)


def verify(df: DataFrame, key: str) -> DataFrame:
    """key, status and problems of rows (key, clean_json, receipt)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, raw, receipt in zip(b["k"], b["clean_json"], b["receipt"]):
                try:
                    out.append((k, *verify_row(json.loads(receipt), raw if isinstance(raw, str) else "", k)))
                except (TypeError, ValueError):
                    out.append((k, INVALID, ["the receipt is no JSON"]))
            yield pd.DataFrame(out, columns=["k", "status", "problems"])

    made = df.select(F.col(key).cast("string").alias("k"), "clean_json", "receipt").mapInPandas(rows, "k string, status string, problems array<string>")
    return made.withColumnRenamed("k", key)


def scrub_file(spark: SparkSession, source: str, out: str, receipt: str | None = None, clock: Callable[[], str] = lambda: "") -> dict:
    """Sanitises a file of lines and puts a receipt beside the output (``OUT.receipt.json``, or another path): digests of both, counts by
    category, and whether a second scan of what was written finds nothing. Only names of files enter it, no folders."""
    from ..sources.readers import jsonl_or_text

    rows = materialised(S.sanitise(jsonl_or_text(spark, source), "value").select("clean_text", "applied", "n_residual"))
    rows.select(F.col("clean_text").alias("value")).write.mode("errorifexists").text(out)
    again = S.scan(spark.read.text(out), "value").agg(F.coalesce(F.sum(F.size("applied")), F.lit(0))).first()[0]
    counts = {r["category"]: r["n"] for r in S.counts_by_category(rows).orderBy("category").collect()}  # a row a category

    def digest(path: str) -> tuple[str, int]:
        files = file_digests(spark, path).where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))
        one = files.agg(F.array_join(F.array_sort(F.collect_list("sha256")), "\n").alias("d"), F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()
        return hashlib.sha256(one["d"].encode()).hexdigest(), one["n"]

    (before, size), (after, out_size) = digest(source), digest(out)
    body = {"input_sha256": before, "output_sha256": after, "input_bytes": size, "output_bytes": out_size, "input_file": os.path.basename(source.rstrip("/")), "output_file": os.path.basename(out.rstrip("/")), "ruleset_sha256": S.ruleset_digest(), "n_findings": sum(counts.values()), "findings_by_category": counts, "n_residual": again, "is_clean": again == 0}
    body["receipt_id"] = f"file-{before[:12]}"
    body["receipt_sha256"] = _sha(body)
    path = Path(receipt or f"{out.rstrip('/')}.receipt.json")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(body | {"created_at": clock()}, sort_keys=True, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
    return body


def coverage(df: DataFrame, column: str = "json") -> DataFrame:
    """One row of totals over rows of JSON: keys, strings and bytes that a scan must visit, and those it does visit."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            total = [0] * 7
            for raw in b["v"]:
                try:
                    tree = S.parse_strict(raw if isinstance(raw, str) else "")
                    want, seen = expected_coverage(tree), treat(tree)[2]
                except S.TreeError:
                    total[6] += 1
                    continue
                for i, k in enumerate(("keys", "values", "bytes")):
                    total[i] += want[k]
                    total[i + 3] += seen[k]
            yield pd.DataFrame([total], columns=NAMES)

    made = df.select(F.col(column).alias("v")).mapInPandas(rows, ", ".join(f"{n} long" for n in NAMES))
    return made.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in NAMES])


NAMES = ["keys", "values", "bytes", "keys_scanned", "values_scanned", "bytes_scanned", "n_refused"]
