"""Seed curation: contaminated, exact, equal n-gram sets, near-duplicates, in that order, first come first kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import contamination as C
from .checkpoints import materialised, sized

NEAR, BANDS = 0.85, 20
#: Open classes, of about a kilobyte each, that one pass of the driver settles.
TAIL = 4096
PROMPT_FIELDS = ("task_prompt", "prompt", "instruction", "question", "query", "task", "user_prompt")
BODY_FIELDS = ("input", "content", "text", "body")


def seed_text(fields: dict[str, Column], messages: Column | None = None) -> Column:
    """A seed's text: its first non-empty prompt field, role and description, and every turn's reasoning and content, one a line;
    without any of these its first non-empty body field. ``fields`` names the columns there are."""
    prompt = [fields[f] for f in PROMPT_FIELDS if f in fields]
    parts = ([T.first_truthy(*prompt)] if prompt else []) + [F.nullif(fields[f], F.lit("")) for f in ("role", "description") if f in fields]
    if messages is not None:
        line = lambda m, k: F.when(F.coalesce(m[k], F.lit("")) != "", F.concat(F.lit(f"{k}: "), m[k]))
        parts.append(F.nullif(F.array_join(F.flatten(F.transform(messages, lambda m: F.array_compact(F.array(line(m, "reasoning"), line(m, "content"))))), "\n"), F.lit("")))
    main = F.nullif(F.trim(F.concat_ws("\n", *parts)), F.lit("")) if parts else F.lit(None).cast("string")
    body = [fields[f] for f in BODY_FIELDS if f in fields]
    return F.coalesce(main, T.first_truthy(*body) if body else F.lit(None).cast("string"), F.lit(""))


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text_hash and survivor: the least key of equal normalised texts. Only hashes are shuffled."""
    hashed = docs.select(key, T.sha256(T.normalised(F.col(text))).alias("text_hash"))
    least = hashed.groupBy("text_hash").agg(F.min(key).alias("survivor"))
    return hashed.join(least, "text_hash").select(key, "text_hash", "survivor")


def equal_sets(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and survivor: the least key of equal sets of n-grams; of a shorter text its whole token run is the only one. Grams are told apart by 64-bit
    hashes. Texts are read once, and only digests of their sets are shuffled."""
    keyed = materialised(C.facts(docs, [key], "set_key"))
    return keyed.join(keyed.groupBy("set_key").agg(F.min(key).alias("survivor")), "set_key").select(key, "survivor")


def accept_similar(signed: DataFrame, key: str, cut: float = NEAR, bands: int = BANDS, n_perm: int = C.PERMUTATIONS, tail: int = TAIL) -> DataFrame:
    """key, survivor and jaccard of each row of ``signed`` (key, sig): what taking rows in rising order of key would do, each accepted
    (survivor null) unless its signature agrees in a share of ``cut`` or more with an accepted one's, the least of which survives it.

    Rows of equal signatures are one class under their least key. With fewer disagreeing places than bands one band at least agrees whole,
    so only classes that share a band can meet. A round accepts the classes that are the least open ones in all their bands; each band has one
    such at most, so a class is compared with no more than ``bands`` of them and no pair of a bucket is made. When ``tail`` open classes or fewer
    are left, one pass over their signatures settles them."""
    return _accepted(materialised(signed.select(F.col(key).alias("key"), "sig", T.run_hash(F.col("sig")).alias("_s"))), key, cut, bands, n_perm, tail)


def _accepted(signed: DataFrame, key: str, cut: float = NEAR, bands: int = BANDS, n_perm: int = C.PERMUTATIONS, tail: int = TAIL, but: DataFrame | None = None) -> DataFrame:
    """``accept_similar`` of saved rows (key, sig, _s, the hash of sig), without the keys of ``but``. Signatures, a kilobyte each, are moved for classes
    that share a band only; all else goes by keys and hashes."""
    if n_perm - int(-(-cut * n_perm // 1)) >= bands:
        raise ValueError("more bands are needed for this cut")
    spark = signed.sparkSession
    named = signed.select("key", "_s")
    named = named if but is None else named.join(but.select(F.col(but.columns[0]).alias("key")), "key", "left_anti")
    members = materialised(named.join(named.groupBy("_s").agg(F.min("key").alias("rep")), "_s").select("key", "rep"))
    edges = [n_perm * b // bands for b in range(bands + 1)]
    band = F.array(*[F.xxhash64(F.lit(b), F.slice("sig", edges[b] + 1, edges[b + 1] - edges[b])) for b in range(bands)])
    banded = signed.select(F.col("key").alias("node"), band.alias("bands"))
    rows = materialised(banded.join(members.where("key = rep").select(F.col("key").alias("node")), "node", "left_semi")).select("node", F.explode("bands").alias("band"))
    rows = materialised(rows.join(rows.groupBy("band").count().where("count > 1").select("band"), "band"))
    state = materialised(rows.select("node").distinct().select("node", F.lit(False).alias("accepted"), F.lit(None).cast("long").alias("survivor"), F.lit(None).cast("double").alias("jaccard")))
    nodes = materialised(signed.select(F.col("key").alias("node"), "sig").join(sized(state.select("node")), "node", "left_semi"))
    sig = lambda c, s: nodes.select(F.col("node").alias(c), F.col("sig").alias(s))
    while (left := state.where("not accepted and survivor is null")).limit(tail + 1).count() > tail:
        at = rows.join(left.select("node"), "node")
        least = materialised(at.groupBy("band").agg(F.min("node").alias("lead")))
        leads = materialised(at.join(least, "band").groupBy(F.col("node").alias("lead")).agg(F.bool_and(F.col("node") == F.col("lead")).alias("all")).where("all").select("lead"))
        rest = state.where("not accepted").select("node", "survivor").join(leads.select(F.col("lead").alias("node")), "node", "left_anti")
        met = rows.join(least.join(leads, "lead", "left_semi"), "band").join(rest, "node").where("lead < coalesce(survivor, node)").select("node", "lead").distinct()
        agree = met.join(sig("node", "_a"), "node").join(sig("lead", "_b"), "lead").select("node", "lead", C.similarity(F.col("_a"), F.col("_b")).alias("j")).where(F.col("j") >= cut)
        hits = agree.groupBy("node").agg(F.min_by(F.struct("lead", "j"), "lead").alias("w"))
        fresh = state.join(hits, "node", "left").join(leads.select(F.col("lead").alias("node"), F.lit(True).alias("_lead")), "node", "left")
        state = materialised(fresh.select("node", (F.col("accepted") | F.coalesce("_lead", F.lit(False))).alias("accepted"), F.coalesce("w.lead", "survivor").alias("survivor"), F.coalesce("w.j", "jaccard").alias("jaccard")))
    last = _settled(left.join(nodes, "node").select("node", "sig").orderBy("node").collect(), cut, n_perm)
    open_ = spark.createDataFrame([(n, s, j) for n, s, j, _ in last], "node long, _s long, _j double")
    taken = [(n, g) for n, s, _, g in last if s is None]
    beaten = _lesser(state.where("survivor is not null").select("node", "survivor", "jaccard").join(nodes, "node"), taken, cut, n_perm)
    placed = state.where("accepted").select("node", "survivor", "jaccard").unionByName(beaten).unionByName(open_.select("node", F.col("_s").alias("survivor"), F.col("_j").alias("jaccard")))
    lost = placed.where("survivor is not null").withColumnRenamed("node", "rep")
    out = members.join(lost, "rep", "left")
    of = F.coalesce("survivor", F.when(F.col("key") != F.col("rep"), F.col("rep")))
    return out.select(F.col("key").alias(key), of.alias("survivor"), F.when(of.isNotNull(), F.coalesce("jaccard", F.lit(1.0))).alias("jaccard"))


def _settled(rows: list, cut: float, n_perm: int) -> list:
    """(node, survivor, jaccard, sig) of a bounded list of open classes in rising order."""
    taken, ids, out = np.empty((len(rows), n_perm), np.int64), [], []
    for node, sig in rows:
        v = np.asarray(sig, np.int64)
        share = (taken[: len(ids)] == v).sum(axis=1) / n_perm
        near = np.flatnonzero(share >= cut)
        if len(near):
            out.append((node, ids[near[0]], float(share[near[0]]), v))
        else:
            taken[len(ids)] = v
            ids.append(node)
            out.append((node, None, None, v))
    return out


def _lesser(beaten: DataFrame, taken: list, cut: float, n_perm: int) -> DataFrame:
    """``beaten`` (node, survivor, jaccard, sig) with the least survivor also among ``taken``, the bounded rest that was settled last."""
    ids, sigs = np.array([n for n, _ in taken], np.int64), np.array([g for _, g in taken], np.int64).reshape(-1, n_perm)

    def hold(batches):
        for b in batches:
            out = []
            for survivor, jaccard, sig in zip(b["survivor"].to_pylist(), b["jaccard"].to_pylist(), b["sig"]):
                share = (sigs[: np.searchsorted(ids, survivor)] == np.asarray(sig.values, np.int64)).sum(axis=1) / n_perm
                near = np.flatnonzero(share >= cut)
                out.append((int(ids[near[0]]), float(share[near[0]])) if len(near) else (survivor, jaccard))
            yield pa.RecordBatch.from_arrays([b["node"], pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.float64())], names=["node", "survivor", "jaccard"])

    return beaten.mapInArrow(hold, "node long, survivor long, jaccard double")


def audit(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", cut: float = NEAR) -> DataFrame:
    """key, status (CONTAMINATED, DUPLICATE_EXACT, DUPLICATE_MINHASH or CLEAN), duplicate_of and jaccard, in order of ``key``.

    Texts are tokenised once, in a pass that saves what is a kilobyte a text: its signature, a digest of its n-gram set, and whether it may hold an n-gram
    of the benchmark (which the n-grams themselves then decide). Equal texts have equal n-gram sets, and these equal signatures, so one seed of each set
    stands for all; the others are exact duplicates of it if it is accepted, and near-duplicates of what beat it otherwise."""
    told = C.holders(docs, benchmark, [key], "set_key", "sig", all_signed=True)
    signed = told.select(F.col(key).alias("key"), "sig", "_s")
    dirty = materialised(C.ngram_hits(docs.join(sized(told.where("may").select(key)), key, "left_semi"), C.postings(benchmark), [key]).select(key).distinct())
    keyed = told.select(key, "set_key").join(dirty, key, "left_anti")
    reps = keyed.groupBy("set_key").agg(F.min(key).alias("rep"))
    lost = _accepted(signed, key, cut, but=dirty).where("survivor is not null").withColumnRenamed(key, "rep")
    placed = keyed.join(reps, "set_key").join(lost, "rep", "left")
    near, same = F.col("survivor").isNotNull(), F.col(key) != F.col("rep")
    status = F.when(near, "DUPLICATE_MINHASH").when(same, "DUPLICATE_EXACT").otherwise("CLEAN")
    found = placed.select(key, status.alias("status"), F.when(near, F.col("survivor")).when(same, F.col("rep")).alias("duplicate_of"), F.when(near, F.col("jaccard")).when(same, 1.0).alias("jaccard"))
    return found.unionByName(dirty.select(key, F.lit("CONTAMINATED").alias("status"), F.lit(None).cast("long").alias("duplicate_of"), F.lit(None).cast("double").alias("jaccard")))


def summary(audited: DataFrame) -> DataFrame:
    """One row of counters."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    return audited.agg(F.count("*").alias("ingested"), n("DUPLICATE_EXACT").alias("exact_duplicates"), n("DUPLICATE_MINHASH").alias("near_duplicates"), n("DUPLICATE_EXACT", "DUPLICATE_MINHASH").alias("duplicates"), n("CONTAMINATED").alias("contaminated"), n("CLEAN").alias("clean"))


def breakdown(audited: DataFrame, docs: DataFrame, by: str, key: str = "doc_id", accepted_only: bool = True) -> DataFrame:
    """Counts by a column of ``docs``, most first."""
    rows = docs.select(key, by).join(audited, key)
    return (rows.where("status = 'CLEAN'") if accepted_only else rows).groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by)
