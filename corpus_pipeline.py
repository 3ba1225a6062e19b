"""A corpus pipeline of the training-data operators.

Every stage takes all that its predecessor kept, written as Parquet and read again, and returns the columns of
``documents``; the last returns packed sequences. Quality rules reject documents; of each group of near-duplicates
(five-word shingles, similarity 0.8) one stays; secrets in texts are replaced; sources are mixed to their target
weights, a document standing there as often as it is taken; texts become sequences of power-of-two lengths.

Defined results: documents with a null or empty text, as all under the least number of words, go in the first stage; nulls in other columns
are values like any other; of rows equal in text one goes on, the one of the least id; texts are taken whole, however long; columns
besides those of ``documents``, whatever their names, are handed on up to packing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillforge.llm.base import Scratch
from quillforge.llm.mixing import repeat_mixed
from quillforge.llm.neardup import drop_near_duplicates
from quillforge.llm.packing import pack_power_of_two
from quillforge.llm.quality import keep_good
from quillforge.llm.secrets import redact_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeat_mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_power_of_two(docs, with_ids=True)


STAGES = [("quality rules", quality_rules), ("minhash near-dedup", near_duplicates), ("secret scan", secret_scan), ("source mix", source_mix), ("packing", packing)]

#: Tokenizer ids, unlike the rest, can't be had in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    scratch, docs = Scratch(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs, f"stage-{k}")
            if k > 1:
                scratch.drop(f"stage-{k - 2}")
    return docs
