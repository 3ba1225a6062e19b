"""Sanitising texts, JSON trees and release rows, with receipts."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import license as L
from ..functions import pii as P
from ..functions import text as T


def scan(df: DataFrame, text: str = "text", rules=P.RULES) -> DataFrame:
    """``df`` with ``findings`` (all spans, overlapping ones too) and ``applied`` (those that count)."""
    found = df.withColumn("findings", P.all_spans(F.coalesce(F.col(text), F.lit("")), rules))
    return found.withColumn("applied", P.chosen(F.col("findings")))


def sanitise(df: DataFrame, text: str = "text", home: str | None = None, rules=P.RULES) -> DataFrame:
    """``df`` with ``clean_text``, its findings, how many are left in it when it is scanned again, and ``is_clean``."""
    source = df.withColumn(text, P.own_home(F.col(text), home)) if home else df
    out = scan(source, text, rules).withColumn("clean_text", P.redact(F.coalesce(F.col(text), F.lit("")), F.col("applied")))
    again = F.when(F.size("applied") > 0, F.size(P.chosen(P.all_spans(F.col("clean_text"), rules)))).otherwise(0)  # an unchanged text has none
    return out.withColumn("n_residual", again).withColumn("is_clean", F.col("n_residual") == 0)


def counts_by_category(scanned: DataFrame) -> DataFrame:
    found = scanned.select(F.explode("applied").alias("f"))
    return found.groupBy(F.col("f.category").alias("category")).agg(F.count("*").alias("n"))


def counts_by_rule(df: DataFrame, text: str = "text", rules=P.RULES) -> DataFrame:
    """rule, category, n (matches) and n_rows: one pass, a count for each rule and row, no span is built."""
    t = F.coalesce(F.col(text), F.lit(""))
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.category).alias("category"), P.match_count(t, r).cast("long").alias("k")) for r in rules])
    return df.select(F.explode(each).alias("x")).select("x.*").where("k > 0").groupBy("rule", "category").agg(F.sum("k").alias("n"), F.count("*").alias("n_rows"))


def severe_count(df: DataFrame, text: str = "text") -> Column:
    """Matches of severe rules in a text."""
    return sum((P.match_count(F.coalesce(F.col(text), F.lit("")), r) for r in P.RULES if r.severe), F.lit(0))


def entropy_findings(df: DataFrame, key: str, text: str = "text", allowed: Column | None = None) -> DataFrame:
    """key and token of every high-entropy token; rows for which ``allowed`` holds (a declared digest field) are left out."""
    rows = df if allowed is None else df.where(~F.coalesce(allowed, F.lit(False)))
    toks = rows.select(key, F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(P.ENTROPY_TOKEN), F.lit(0))).alias("token"))
    return toks.where(P.is_high_entropy(F.col("token")))


def ruleset_digest(rules=P.RULES) -> str:
    """SHA-256 over the rules, their tokens and the entropy thresholds: what a receipt binds."""
    table = {"rules": [[r.name, r.category, r.pattern, r.group, r.severe] for r in rules], "tokens": P.TOKENS, "entropy": [P.MIN_ENTROPY_LENGTH, P.MIN_HEX_BITS, P.MIN_BITS, P.MIN_CLASSES]}
    return hashlib.sha256(json.dumps(table, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def receipts(sanitised: DataFrame, key: str, text: str = "text") -> DataFrame:
    """A receipt a row: input and output digests, counts, rule set, clean or not, and a digest of the receipt itself."""
    body = F.struct(F.lit(ruleset_digest()).alias("ruleset_sha256"), T.sha256(F.coalesce(F.col(text), F.lit(""))).alias("input_sha256"), T.sha256(F.col("clean_text")).alias("output_sha256"), F.size("applied").alias("n_findings"), F.col("n_residual"), F.col("is_clean"))
    return sanitised.select(key, body.alias("receipt")).select(key, "receipt.*", T.sha256(F.to_json("receipt")).alias("receipt_sha256"))


# JSON trees -----------------------------------------------------------------------------------------------------------------


class TreeError(ValueError):
    """A tree that may not be released: malformed, too deep, with duplicate or colliding keys or numbers that are not finite."""


MAX_DEPTH = 128


def parse_strict(raw: str):
    """JSON without duplicate keys or non-finite numbers, at most MAX_DEPTH deep."""

    def pairs(items):
        out = dict(items)
        if len(out) < len(items):
            raise TreeError("duplicate key")
        return out

    def constant(name):
        raise TreeError(f"{name} is not finite")

    try:
        tree = json.loads(raw, object_pairs_hook=pairs, parse_constant=constant)
    except (ValueError, RecursionError) as e:
        raise e if isinstance(e, TreeError) else TreeError(f"no JSON: {e}") from e
    deep = [(tree, 1)]
    while deep:
        node, depth = deep.pop()
        if depth > MAX_DEPTH:
            raise TreeError("too deep")
        if isinstance(node, float) and node in (float("inf"), float("-inf")):
            raise TreeError("a number is not finite")
        deep += [(x, depth + 1) for x in (node.values() if isinstance(node, dict) else node if isinstance(node, list) else ())]
    return tree


def _compiled(rules):
    import re

    return [(k, r, re.compile(r.pattern, re.ASCII)) for k, r in enumerate(rules)]


def _redact_string(text: str, compiled, path: str, findings: list) -> str:
    spans = sorted((m.start(r.group), -m.end(r.group), k, r) for k, r, p in compiled for m in p.finditer(text))
    out, at = [], 0
    for start, end, k, r in spans:
        if start >= at and -end > start:
            out += [text[at:start], P.TOKENS.get(r.category, f"[REDACTED:{r.category}]")]
            findings.append((path, r.name, r.category, start, -end))
            at = -end
    return "".join([*out, text[at:]])


def redact_tree(tree, rules=P.RULES):
    """(tree with keys and values redacted, findings as (path, rule, category, start, end)); colliding keys are an error."""
    compiled, findings = _compiled(rules), []

    def walk(node, path):
        if isinstance(node, str):
            return _redact_string(node, compiled, path, findings)
        if isinstance(node, list):
            return [walk(x, f"{path}[{i}]") for i, x in enumerate(node)]
        if isinstance(node, dict):
            out = {}
            for k, v in node.items():
                key = _redact_string(k, compiled, f"{path}.key({k})", findings)
                if key in out:
                    raise TreeError("redacted keys collide")
                out[key] = walk(v, f"{path}.{k}")
            return out
        return node

    return walk(tree, "$"), findings


def sanitise_trees(df: DataFrame, column: str = "json") -> DataFrame:
    """``df`` with clean_json, n_findings, categories, n_residual and error. A row that may not be released has an error and no tree.

    Trees of any shape have no column expression, so this one runs in Arrow batches; its rules are those of the columns."""
    schema = df.select("*", F.lit("").alias("clean_json"), F.lit(0).alias("n_findings"), F.expr("map('', 0)").alias("categories"), F.lit(0).alias("n_residual"), F.lit("").alias("error")).schema
    for f in schema.fields[-5:]:
        f.nullable = True

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for raw in b[column]:
                try:
                    tree, found = redact_tree(parse_strict(raw if isinstance(raw, str) else ""))
                    clean = json.dumps(tree, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
                    kinds: dict[str, int] = {}
                    for f in found:
                        kinds[f[2]] = kinds.get(f[2], 0) + 1
                    out.append((clean, len(found), kinds, len(redact_tree(tree)[1]), None))
                except TreeError as e:
                    out.append((None, 0, {}, 0, str(e)))
            names = ["clean_json", "n_findings", "categories", "n_residual", "error"]
            yield b.assign(**{n: [o[i] for o in out] for i, n in enumerate(names)})

    return df.mapInPandas(rows, schema)


def release_rows(df: DataFrame, column: str = "json") -> DataFrame:
    """Trees with a ``released`` verdict: parsed, redacted, clean when scanned again, and changed exactly where something was found."""
    out = sanitise_trees(df, column)
    changed = F.coalesce(F.col("clean_json") != T.canonical_json(F.col(column)), F.lit(False))
    return out.withColumn("released", F.col("error").isNull() & (F.col("n_residual") == 0) & ((F.col("n_findings") > 0) == changed))


def audit_records(df: DataFrame, text: str = "text", license_column: str | None = "license") -> DataFrame:
    """Licence and privacy of each record: compliant if its licence is permissive (or it names none) and its text is clean."""
    category = L.classify(F.col(license_column)) if license_column else F.lit(None).cast("string")
    out = sanitise(df, text).withColumn("license_category", F.when(F.col(license_column).isNotNull(), category) if license_column else category)
    ok = F.coalesce(F.col("license_category") == "PERMISSIVE", F.lit(True)) & F.col("is_clean")
    return out.withColumn("compliant", ok).withColumn("audit_sha256", T.sha256(F.concat_ws("|", T.sha256(F.col("clean_text")), F.coalesce("license_category", F.lit("NONE")), ok.cast("string"))))
