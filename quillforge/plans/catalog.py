"""Every registered query and, where SQL expresses it, its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Registers ``f(spark, sf_dir)`` under ``name``."""

    def put(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return put


#: Tables whose rows are texts, so that a row's work outweighs moving it.
TEXTS = ("documents", "conversations", "pages")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table. Texts of a scan with fewer splits than cores (a small file of one row group) are dealt out first, as each would be one task's work."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in TEXTS and df.rdd.getNumPartitions() < cores else df
