"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Each document gets the key -ln(u) / w: u a uniform number of 52 bits from a digest of its id and text, w its quality
weight. A source's target takes as many complete epochs as fit; the rest is a weighted sample without
replacement, the documents of least keys up to the remaining words, of which the last is taken in part. Keys are
bucketed, so that a hot source is never sorted in one task: sums of the buckets tell in which one the rest ends, that bucket
is bucketed again while it has more than BUCKET_ROWS rows, and only the last is sorted. Rows never move with their texts.

Sources by code point, null last, weigh 5, 2, 1, repeating, and share the words of all documents; a target stops at
3 times its source's words, and the excess goes to the others by weight until none is above: the level x solves
sum(min(3 * words, weight * x)) = total.

Defined results: a null or empty text has size 0 and is never taken; rows that are equal in id and text share what
they get at the boundary evenly; a null id is a value like any other; an empty table gives no rows. Reruns agree.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import WORD_JAVA, Scratch, as_struct, text_key

WEIGHTS, MAX_EPOCHS, BUCKET_ROWS = (5, 2, 1), 3, 4_000
#: Rows of a table of sources, of about 100 bytes each, up to which it is broadcast.
BROADCAST_ROWS = 50_000


def n_words(text: Column) -> Column:
    """Words as one pass over the text: every word becomes one character, and white space goes."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_JAVA)), F.lit(0)).cast("long")


def quality_weight(size: Column, n_chars: Column) -> Column:
    """From 1/12 to 1: highest where words have five to six letters, as prose has."""
    return F.when(size > 0, 1 / (1 + F.least(F.abs(n_chars / size - 6.5), F.lit(11.0)))).otherwise(1.0)


def sampling_rows(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, the document's key and what breaks ties: its id and text hash."""
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("_md5")))
    uniform = (F.conv(F.substring(mark, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    rows = docs.select(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_md5"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), F.coalesce(F.length("text"), F.lit(0)).alias("_n"), *text_key())
    return rows.select("doc_id", "source", "size", "_th", "_tl", (-F.log(uniform) / quality_weight(F.col("size"), F.col("_n"))).alias("key"))


def source_targets(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, n_docs, target: one row a source."""
    by = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order, everywhere = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = max_epochs * F.col("source_size")
    full = Window.orderBy("_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = by.withColumn("_w", w).withColumn("_at", cap / F.col("_w"))
    s = s.withColumns({"_total": F.sum("source_size").over(everywhere), "_wall": F.sum("_w").over(everywhere), "_capped": F.coalesce(F.sum(cap).over(full), F.lit(0)), "_wbefore": F.coalesce(F.sum("_w").over(full), F.lit(0.0))})
    # The level if exactly the sources before this one are at their cap; it holds from the first source on whose own level is not below it.
    s = s.withColumn("_level", (F.col("_total") - F.col("_capped")) / (F.col("_wall") - F.col("_wbefore")))
    s = s.withColumn("_x", F.min(F.when(F.col("_at") >= F.col("_level"), F.struct("_at", "_level"))).over(everywhere)["_level"])
    return s.select("source", "source_size", "n_docs", F.coalesce(F.least(cap.cast("double"), F.col("_w") * F.col("_x")), F.lit(0.0)).alias("target"))


def small(df: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``df``, a row or so a source, written and counted: marked for broadcast where it has few rows, else left to a shuffled join."""
    saved = scratch.save(df, name)
    return F.broadcast(saved) if saved.count() <= BROADCAST_ROWS else saved


def end_bucket(dealt: DataFrame, scratch: Scratch, step: int) -> DataFrame:
    """Of each source's rows, dealt to buckets (_b) in order of their keys, those of the bucket in which its sample of ``_rest`` words ends; ``_before``: words before."""
    sums = dealt.groupBy("source", "_b", "_rest", "_before").agg(F.sum("size").alias("_n"))
    until = F.col("_before") + F.sum("_n").over(Window.partitionBy("source").orderBy("_b"))
    ends = sums.withColumn("_until", until).where((F.col("_until") - F.col("_n") <= F.col("_rest")) & (F.col("_rest") < F.col("_until"))).select("source", "_b", (F.col("_until") - F.col("_n")).alias("_start"))
    ends = small(ends, scratch, f"ends-{step}")
    hit = dealt.alias("d").join(ends.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d._b") == F.col("e._b")))
    return scratch.save(hit.select("d.source", "key", "doc_id", "_th", "_tl", "size", "_rest", F.col("_start").alias("_before")), f"last-{step}")


def plan_mix(rows: DataFrame, scratch: Scratch, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row a source: its target, complete epochs, and where the sample of the rest ends (key, tie, words of a row there)."""
    s = source_targets(rows, weights, max_epochs).withColumn("_full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    s = s.withColumn("_rest", F.round(F.col("target")).cast("long") - F.col("_full") * F.col("source_size"))
    s = s.withColumns({"_full": F.when(F.col("_rest") < 0, F.col("_full") - 1).otherwise(F.col("_full")), "_rest": F.when(F.col("_rest") < 0, F.col("_rest") + F.col("source_size")).otherwise(F.col("_rest"))})
    s = s.withColumn("_buckets", F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BUCKET_ROWS)).cast("long"))
    s = small(s, scratch, "targets")
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    bucket = F.floor((1 - F.exp(-F.col("key"))) * F.col("_buckets"))
    dealt = rows.alias("r").join(s.alias("s"), same("r", "s")).where(F.col("size") > 0).select("r.*", "_rest", bucket.alias("_b"))
    last = end_bucket(dealt.withColumn("_before", F.lit(0).cast("long")), scratch, 0)
    for step in itertools.count(1):  # a bucket that came out great, as weights differ, is dealt again between its least and greatest key
        great = last.groupBy("source").agg(F.count("*").alias("_rows"), F.min("key").alias("_lo"), F.max("key").alias("_hi")).where((F.col("_rows") > BUCKET_ROWS) & (F.col("_lo") < F.col("_hi")))
        great = small(great, scratch, f"great-{step}")
        if not great.take(1):
            break
        part = F.floor((F.col("key") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.ceil(F.col("_rows") / BUCKET_ROWS)).cast("long")
        again = last.alias("l").join(great.alias("g"), same("l", "g"), "left").select("l.*", F.coalesce(part, F.lit(0).cast("long")).alias("_b"))
        last = end_bucket(again, scratch, step)
    ties = last.groupBy("source", "key", "doc_id", "_th", "_tl", "_rest", "_before").agg(F.sum("size").alias("_n"), F.count("*").alias("_c"))
    so_far = F.sum("_n").over(Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "_th", "_tl")) - F.col("_n") + F.col("_before")
    end = ties.withColumn("_so", so_far).where((F.col("_so") <= F.col("_rest")) & (F.col("_rest") < F.col("_so") + F.col("_n")))
    end = end.select("source", F.struct("key", F.col("doc_id").isNull().alias("none"), "doc_id", "_th", "_tl").alias("_end"), F.floor((F.col("_rest") - F.col("_so")) / F.col("_c")).cast("long").alias("_part"))
    return s.alias("s").join(end.alias("e"), same("s", "e"), "left").select("s.source", "source_size", "target", "_full", "_rest", "_end", "_part")


def taken_words(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and taken: complete epochs, and the sample's share of the document."""
    at = F.struct("key", F.col("doc_id").isNull().alias("none"), "doc_id", "_th", "_tl")
    part = F.when(F.col("_end").isNull() | (F.col("_rest") <= 0), F.lit(0)).when(at < F.col("_end"), F.col("size")).when(at == F.col("_end"), F.col("_part")).otherwise(F.lit(0))
    return rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))).select("r.*", "source_size", "target", F.when(F.col("size") > 0, F.col("_full") * F.col("size") + part).otherwise(0).cast("long").alias("taken"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target and taken for each row of ``docs`` (doc_id, text, source)."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.save(sampling_rows(docs, seed), "sizes")
    return taken_words(rows, small(plan_mix(rows, scratch, weights, max_epochs), scratch, "plan")).select("doc_id", "source", "size", "source_size", "target", "taken", "_th", "_tl")


def repeat_mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as it is taken whole; the document at a source's
    boundary counts as whole from half of its words on."""
    mixed = mix_sources(docs, **options).where("size > 0").select(F.col("doc_id").alias("_id"), F.col("_th").alias("_mth"), F.col("_tl").alias("_mtl"), F.round(F.col("taken") / F.col("size")).cast("int").alias("_times")).dropDuplicates(["_id", "_mth", "_mtl"])
    keyed = docs.select(as_struct(docs).alias("doc"), F.col("doc_id").cast("long").alias("_row_id"), *text_key())
    on = F.col("_row_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_mth")) & (F.col("_tl") == F.col("_mtl"))
    hit = keyed.join(mixed.where("_times > 0"), on)
    return hit.select("doc", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("doc.*")
