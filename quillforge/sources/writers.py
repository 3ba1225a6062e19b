"""Writers: partitions by split and shard, a manifest and checksums.

Spark writes the rows; files are then digested where they lie, and only their list comes to the driver.
"""

from __future__ import annotations

import gzip
import hashlib
import itertools
import json
import os
from pathlib import Path

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from ..operators.lot import canonical, file_digests, folder_sums, sha256_file

CODECS = {"none": "none", "": "none", "uncompressed": "none", "gzip": "gzip", "gz": "gzip", "zstd": "zstd", "zst": "zstd"}
ROW_GROUP_BYTES, GROUP_ROWS = 16 << 20, 5000


def codec(name: str | None) -> str:
    try:
        return CODECS[(name or "none").lower()]
    except KeyError:
        raise ValueError(f"unknown codec: {name}") from None


SUFFIXES = {"none": ".jsonl", "gzip": ".jsonl.gz", "zstd": ".jsonl.zst"}


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> dict:
    """Rows as JSON lines in a folder, which gets the suffix of its kind if it has none. Returns the folder and two digests over its files' own: of
    the bytes as they lie (``stored_sha256``) and of the lines in them (``rows_sha256``), which does not depend on the codec. zstd needs
    Hadoop's native library; without it Spark refuses."""
    kind = codec(compression)
    out = path if path.endswith(SUFFIXES[kind]) else path + SUFFIXES[kind]
    df.write.mode("errorifexists").option("compression", kind).option("ignoreNullFields", "false").json(out)

    def raw(batches):
        for b in batches:
            found = []
            for content in b["content"]:
                body = gzip.decompress(content) if kind == "gzip" else zstandard.ZstdDecompressor().stream_reader(content).read() if kind == "zstd" else content
                found.append((hashlib.sha256(content).hexdigest(), hashlib.sha256(body).hexdigest()))
            yield pd.DataFrame(found, columns=["stored", "rows"])

    files = df.sparkSession.read.format("binaryFile").load(out).orderBy("path").select("content").mapInPandas(raw, "stored string, rows string").collect()  # a row a file
    both = [hashlib.sha256("\n".join(sorted(r[k] for r in files)).encode()).hexdigest() for k in ("stored", "rows")]
    return {"path": out, "stored_sha256": both[0], "rows_sha256": both[1], "n_files": len(files)}


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", group_rows: int = GROUP_ROWS) -> None:
    """Parquet with dictionaries, and row groups of at most ``group_rows`` rows."""
    options = {"compression": codec(compression).replace("none", "uncompressed"), "parquet.block.size": ROW_GROUP_BYTES, "parquet.block.row.count.limit": group_rows, "parquet.enable.dictionary": "true"}
    df.write.mode("errorifexists").options(**options).parquet(path)


def write_arrow(df: DataFrame, path: str, compression: str = "zstd", schema: StructType | None = None) -> None:
    """One Arrow IPC file, by the driver, which holds one partition at a time: for tables that a single reader takes. ``schema`` replaces the
    table's own: its columns, in its order and types. gzip is none here, as the format has no such codec."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    shape = to_arrow_schema(schema or df.schema)
    maps = [f.name for f in df.schema if isinstance(f.dataType, MapType)]
    options = pa.ipc.IpcWriteOptions(compression="zstd" if codec(compression) == "zstd" else None)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    rows = df.toLocalIterator()
    with pa.OSFile(path, "wb") as f, pa.ipc.new_file(f, shape, options=options) as w:
        while some := [r.asDict(recursive=True) for r in itertools.islice(rows, 5000)]:
            w.write_batch(pa.RecordBatch.from_pylist([r | {m: list(r[m].items()) for m in maps if r[m] is not None} for r in some], schema=shape))


def install(staged: str, final: str) -> None:
    """Moves a finished folder to its place whole, for its owner only; what is there already is never replaced. The place is claimed first (one
    of several callers gets it), then the folder takes it in one step; if that fails the claim is given back."""
    for top, folders, files in os.walk(staged):
        if any(os.path.islink(os.path.join(top, n)) for n in folders + files):
            raise ValueError("links are not installed")
        os.chmod(top, 0o700)
        for n in files:
            os.chmod(os.path.join(top, n), 0o600)
    os.mkdir(final, 0o700)
    try:
        os.rename(staged, final)
    except OSError:
        os.rmdir(final)
        raise


def write_shards(df: DataFrame, folder: str, split: str = "split", file: str = "file", formats: tuple[str, ...] = ("jsonl",), compression: str = "none") -> None:
    """A folder for each format, split and shard; empty splits have none. Every shard is written by one task, in order."""
    rows = df.repartition(split, file).sortWithinPartitions(split, file, "row_index")
    for kind in formats:
        out = rows.drop("shard").write.mode("errorifexists").partitionBy(split, file)
        if kind == "parquet":
            out.option("compression", codec(compression).replace("none", "uncompressed")).parquet(os.path.join(folder, kind))
        else:
            out.option("compression", codec(compression)).json(os.path.join(folder, kind))


def manifest(spark: SparkSession, folder: str) -> dict:
    """Entries (path, sha256, size), totals and a root hash that no clock enters."""
    rows = file_digests(spark, folder).where(~F.col("path").rlike(r"(^|/)[._]|manifest\.json$|SHA256SUMS$")).orderBy("path").collect()  # a row a file
    entries = [r.asDict() for r in rows]
    return {"entries": entries, "n_files": len(entries), "total_bytes": sum(e["size"] for e in entries), "root_sha256": hashlib.sha256(canonical(entries).encode()).hexdigest()}


def seal(spark: SparkSession, folder: str, created_at: str | None = None) -> dict:
    """Writes manifest.json and SHA256SUMS; the time of creation stands beside what is hashed."""
    body = manifest(spark, folder)
    Path(folder, "manifest.json").write_text(json.dumps(body | {"created_at": created_at}, sort_keys=True, indent=2) + "\n", encoding="utf-8")
    Path(folder, "SHA256SUMS").write_text("".join(f"{d}  {p}\n" for d, p in folder_sums(folder) if not os.path.basename(p).startswith((".", "_"))), encoding="utf-8")
    return body


def verify(folder: str) -> list[str]:
    """Problems of a sealed folder: files missing, changed in size or digest, or a manifest whose root hash is not that of its entries."""
    body = json.loads(Path(folder, "manifest.json").read_text(encoding="utf-8"))
    out = [] if body["root_sha256"] == hashlib.sha256(canonical(body["entries"]).encode()).hexdigest() else ["root hash"]
    for e in body["entries"]:
        path = os.path.join(folder, e["path"])
        if not os.path.isfile(path):
            out.append(f"missing: {e['path']}")
        elif os.path.getsize(path) != e["size"] or sha256_file(path) != e["sha256"]:
            out.append(f"changed: {e['path']}")
    return out
