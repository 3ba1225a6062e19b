"""Helpers shared by the training-data operators.

Inputs are read by column name only, so extra columns never clash with an operator's own. What must
outlive its lineage goes to the folder of ``spark.checkpoint.dir``, which executors share.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What holds while a table is saved: a query's shuffle files go at its end, and Arrow batches between the JVM and Python stay small.
WHILE_SAVING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608b"}
#: A word is a run of anything but these (space, \t, \n, \v, \f, \r); ``bytes.split()`` cuts at the same.
WORD_JAVA = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a test session that names none gets one in its own warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


class Scratch:
    """Tables of one operator call in the shared folder; ``drop`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read again; the shuffles that made it are removed as soon as it is there, as nothing reads them again."""
        conf = self.spark.conf
        before = {k: conf.get(k, None) for k in WHILE_SAVING}
        try:
            for k, v in WHILE_SAVING.items():
                conf.set(k, v)
            df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def text_key(text: str = "text") -> list:
    """Columns that, with a document's id, tell rows with different texts apart without moving the text."""
    return [F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("_th"), F.coalesce(F.length(F.col(text)), F.lit(-1)).alias("_tl")]


def slices(batches: Iterable, rows: int = 256) -> Iterator:
    """Arrow batches in pieces of a few rows, so that Python objects of one piece are there at a time; at the end, unused memory goes back."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
    pa.default_memory_pool().release_unused()


def as_struct(docs: DataFrame):
    """All columns of a row as one struct: an operator's own columns beside it can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])
