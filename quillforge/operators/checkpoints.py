"""Cutting lineage: tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a build side, of about 60 bytes each, up to which it is broadcast.
BROADCAST_ROWS = 500_000
#: What holds while a table is saved: Arrow batches between the JVM and Python stay small, as a worker holds some of them whole.
WHILE_SAVING = {"spark.sql.execution.arrow.maxBytesPerBatch": "8388608b"}


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir`` and read again; the warehouse where none is named."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/table-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in WHILE_SAVING}
    try:
        for k, v in WHILE_SAVING.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """``df``, saved, for the build side of a join: broadcast if it is counted to be small, else left to a shuffled join."""
    df = materialised(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def numbered(df: DataFrame, split: str, order: list[str]) -> DataFrame:
    """``df`` with row_index, dense from 0 within a split, in an order that no two rows share. Ranges are saved with their places, and numbers come from
    the counts of ranges, so no split is sorted in one task and no number depends on how a stage is run again."""
    ranged = materialised(df.repartitionByRange(split, *order).sortWithinPartitions(split, *order).withColumn("_p", F.spark_partition_id()).withColumn("_k", F.monotonically_increasing_id()))
    counts = ranged.groupBy(F.col(split).alias("_s"), F.col("_p").alias("_q")).agg(F.count("*").alias("_n"), F.min("_k").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_s").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.join(sized(counts.select("_s", "_q", "_first", before.alias("_before"))), (F.col("_p") == F.col("_q")) & F.col(split).eqNullSafe(F.col("_s")))
    return placed.withColumn("row_index", (F.col("_before") + F.col("_k") - F.col("_first")).cast("long")).drop("_p", "_k", "_q", "_s", "_before", "_first")
