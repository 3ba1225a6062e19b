"""Readers. Where a malformed row is an error, it is one; where it is skipped or taken as text, the reader says so."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

LINE = "line_no long, value string"


class SourceError(ValueError):
    """Input that a strict reader refuses."""


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): every line with its file and its number from 1. A file is one partition, so numbers need no shuffle."""
    whole = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.split("value", "\r?\n").alias("v"))
    numbered = whole.select("file", F.posexplode("v").alias("p", "value"))
    return numbered.select("file", (F.col("p") + 1).cast("long").alias("line_no"), "value")


def jsonl_or_text(spark: SparkSession, path: str) -> DataFrame:
    """(value, json, is_json): lines for sanitising; what does not parse is text, and blank lines stay."""
    v = F.try_parse_json("value")
    return spark.read.text(path).select("value", F.to_json(v).alias("json"), v.isNotNull().alias("is_json"))


def whole_json_or_text(spark: SparkSession, path: str) -> DataFrame:
    v = F.try_parse_json("value")
    return spark.read.text(path, wholetext=True).select("value", F.to_json(v).alias("json"), v.isNotNull().alias("is_json"))


def sniffed(spark: SparkSession, path: str) -> DataFrame:
    """Files without a known suffix: what begins like JSON is tried as such."""
    v = F.when(F.ltrim("value").rlike(r"^[\[{]"), F.try_parse_json("value"))
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value", F.to_json(v).alias("json"), v.isNotNull().alias("is_json"))


def items(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """(file, ord, json): the objects of a JSON-lines file, of a JSON list, or of an object's list under one of ``names``."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    v = F.try_parse_json("value")
    listed = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), *[F.try_variant_get(v, f"$.{n}", "array<variant>") for n in names])
    by_line = F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")
    rows = F.when(listed.isNotNull(), F.transform(listed, lambda x: F.to_json(x))).otherwise(by_line)
    return whole.select("file", F.posexplode(rows).alias("ord", "json"))


def seeds(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(raw_index, source, json): all seed files in order; a scalar becomes {prompt}; files that are not there are left out."""
    there = [p for p in paths if os.path.exists(p)]
    out = None
    for n, p in enumerate(there):
        one = items(spark, p, "seeds", "items").withColumn("_n", F.lit(n))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "raw_index long, source string, json string")
    wrapped = F.when(F.ltrim("json").startswith("{"), F.col("json")).otherwise(F.to_json(F.struct(F.coalesce(F.try_variant_get(F.try_parse_json("json"), "$", "string"), F.col("json")).alias("prompt"))))
    return out.select(((F.col("_n").cast("long") * F.lit(1 << 40)) + F.col("ord")).alias("raw_index"), F.col("file").alias("source"), wrapped.alias("json"))


def benchmark(spark: SparkSession, path: str) -> DataFrame:
    """(item_id, text) of a benchmark file; the id is the item's or its place."""
    v = F.try_parse_json("json")
    get = lambda *p: T.first_truthy(*[F.try_variant_get(v, f"$.{x}", "string") for x in p])
    return items(spark, path, "items", "benchmarks").select(F.coalesce(get("id", "item_id"), F.col("ord").cast("string")).alias("item_id"), F.coalesce(get("prompt", "text", "content"), F.try_variant_get(v, "$", "string"), F.lit("")).alias("text")).where("text <> ''")


def events(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """An event stream. Strict: the first line that is no object is an error with its number. Lenient: such lines, and a missing file, are nothing."""
    if not strict:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path) if os.path.exists(path.removeprefix("file:")) else spark.createDataFrame([], schema)
    rows = lines(spark, path).where(F.trim("value") != "")
    bad = rows.where(F.coalesce(F.schema_of_variant(F.try_parse_json("value")), F.lit("")).startswith("OBJECT") == F.lit(False)).orderBy("line_no").limit(1).collect()
    if bad:
        raise SourceError(f"line {bad[0]['line_no']} is no JSON object")
    return rows.select("line_no", F.from_json("value", schema).alias("e")).select("line_no", "e.*")


def canonical_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value): lines that are byte for byte their canonical form, ended by LF; anything else is an error."""
    rows = lines(spark, path)
    last = rows.agg(F.max("line_no")).first()[0]
    bad = rows.where(((F.col("line_no") == last) & (F.col("value") != "")) | ((F.col("line_no") < last) & ~F.coalesce(F.col("value") == T.canonical_json(F.col("value")), F.lit(False)))).limit(1).collect()
    if bad:
        raise SourceError(f"line {bad[0]['line_no']} is not canonical")
    return rows.where(F.col("line_no") < last).select("line_no", "value")


def blobs(spark: SparkSession, root: str) -> DataFrame:
    """(sha256, content, size) of a content-addressed store; what does not match its name is left out, so it reads as missing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root.rstrip('/')}/sha256")
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("sha256"), "content", F.length("content").cast("long").alias("size"))
    return named.where(F.sha2("content", 256) == F.col("sha256"))


def bundle(spark: SparkSession, root: str) -> dict[str, str]:
    """A sealed bundle's required files: the manifest against its digest, and every file that it lists ({"files": {path: sha256}}, the run and its events
    at least) against the manifest, on the driver and in blocks, before anything is loaded."""
    from ..operators.lot import sha256_file

    need = ("run.json", "manifest.json", "manifest.sha256", "events/events.ndjson")
    missing = [p for p in need if not os.path.isfile(os.path.join(root, p))]
    if missing:
        raise SourceError(f"missing: {', '.join(missing)}")
    with open(os.path.join(root, "manifest.sha256"), encoding="utf-8") as f:
        stated = f.read().split()[0]
    if stated != sha256_file(os.path.join(root, "manifest.json")):
        raise SourceError("the manifest does not match its digest")
    with open(os.path.join(root, "manifest.json"), encoding="utf-8") as f:
        files = json.load(f).get("files")
    if not isinstance(files, dict) or not {"run.json", "events/events.ndjson"} <= set(files):
        raise SourceError("the manifest does not list the run and its events")
    for path, digest in sorted(files.items()):
        full = os.path.join(root, path)
        if os.path.isabs(path) or ".." in path.split("/") or os.path.islink(full) or not os.path.isfile(full):
            raise SourceError(f"listed, but no file of the bundle: {path}")
        if sha256_file(full) != digest:
            raise SourceError(f"altered: {path}")
    return {"manifest_sha256": stated, **{p: os.path.join(root, p) for p in need}}


def rights_ledger(spark: SparkSession, path: str, schemas: tuple[str, ...] = ("rights-ledger.v1", "rights-ledger.v2")) -> DataFrame:
    """Entries of a rights ledger: the header's schema must be known and its count right."""
    rows = spark.read.schema("record_type string, ledger_schema string, entry_count long, artifact_id string, manifest_sha256 string, head_sha256 string, rights_status string, assertion_sha256 string").json(path)
    head = rows.where("record_type = 'header'").limit(2).collect()
    entries = rows.where("record_type = 'entry'")
    if len(head) != 1 or head[0]["ledger_schema"] not in schemas or head[0]["entry_count"] != entries.count():
        raise SourceError("the ledger's header does not fit its entries")
    return entries.drop("record_type", "entry_count")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """A registry of cards: every row valid, hashes and pack ids unique."""
    rows = spark.read.schema("card_id string, card_sha256 string, pack_id string, pack_version string, pack_sha256 string").json(path)
    bad = rows.where(F.col("card_id").isNull() | ~T.is_sha256(F.col("card_sha256"))).limit(1).count()
    twice = sum(rows.where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1").limit(1).count() for c in ("card_sha256", "pack_id"))
    if bad or twice:
        raise SourceError("the registry has invalid or repeated rows")
    return rows


def ingots(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.json(path, multiLine=True)
    if "ingot_id" not in rows.columns or rows.where("ingot_id is null").limit(1).count():
        raise SourceError("an ingot needs an id")
    return rows


LOT_TABLES = {"train": "dataset/train.jsonl", "validation": "dataset/validation.jsonl", "record_map": "record_map.jsonl", "decisions": "decisions.jsonl", "sources": "sources.jsonl"}


def lot(spark: SparkSession, folder: str) -> tuple[dict, dict[str, DataFrame]]:
    """(manifest, tables) of a lot for its card: training rows and the manifest must be there; another table that is not has no entry."""
    manifest = os.path.join(folder, "manifest.json")
    if not os.path.isfile(manifest) or not os.path.exists(os.path.join(folder, LOT_TABLES["train"])):
        raise SourceError("a lot has a manifest and training rows")
    with open(manifest, encoding="utf-8") as f:
        body = json.load(f)
    return body, {name: spark.read.json(os.path.join(folder, p)) for name, p in LOT_TABLES.items() if os.path.exists(os.path.join(folder, p)) and os.path.getsize(os.path.join(folder, p))}


def partition(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of a written partition, by suffix: parquet, arrow or feather, JSON lines plain, gzip or zstd."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith((".arrow", ".feather", ".ipc")):
        import pyarrow.feather as feather

        return spark.createDataFrame(feather.read_table(path))
    if path.endswith(".zst"):
        import io

        import zstandard

        def unpack(batches):
            import pyarrow as pa

            for b in batches:
                for raw in b.column(0).to_pylist():
                    text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)), "utf-8")
                    yield pa.RecordBatch.from_arrays([pa.array([x.rstrip("\n") for x in text], pa.string())], names=["value"])

        rows = spark.read.format("binaryFile").load(path).select("content").mapInArrow(unpack, "value string")
        shape = schema or rows.selectExpr("schema_of_variant_agg(try_parse_json(value))").first()[0].replace("OBJECT<", "STRUCT<")
        return rows.where("value <> ''").select(F.from_json("value", shape).alias("r")).select("r.*")
    return spark.read.json(path)


def json_field(column: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(column), path, kind)
