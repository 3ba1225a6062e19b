"""The row-wise operators on streams: scrubbing, licences and contamination need no state; exact duplicates need the hashes within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import license as L
from ..functions import text as T
from ..operators import sanitize as S


def scrub(stream: DataFrame, text: str = "text") -> DataFrame:
    """``stream`` with clean_text, the licence's category and how many findings were replaced."""
    out = S.sanitise(stream, text)
    return out.withColumn("license_category", L.classify_text(F.col(text))["category"]).withColumn("n_findings", F.size("applied")).drop("findings", "applied")


def without_copies(stream: DataFrame, time: str, delay: str = "1 hour", text: str = "text") -> DataFrame:
    """``stream`` without texts that are equal, normalised, to one within the watermark."""
    return stream.withColumn("text_hash", T.sha256(T.normalised(F.col(text)))).withWatermark(time, delay).dropDuplicatesWithinWatermark(["text_hash"])
