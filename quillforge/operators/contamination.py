"""Benchmark contamination: 13-gram postings, spans, MinHash similarity, verdicts and their roll-ups."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..functions import text as T
from ..functions.runs import Runs, symbols
from .checkpoints import BROADCAST_ROWS, materialised, sized

PERMUTATIONS, PRIME, SIMILAR = 128, (1 << 61) - 1, 0.8


def postings(benchmark: DataFrame, name: str = "benchmark", n: int = T.NGRAM) -> DataFrame:
    """(h, benchmark, item_id, item_pos): the inverted index of a benchmark table (item_id, text); empty items have no rows."""
    toks = benchmark.select("item_id", T.tokens(F.col("text")).alias("toks"))
    return toks.select("item_id", F.posexplode(T.ngrams(F.col("toks"), n, T.run_hash)).alias("item_pos", "h")).select("h", F.lit(name).alias("benchmark"), "item_id", "item_pos")


def ngram_hits(texts: DataFrame, index: DataFrame, keys: list[str], n: int = T.NGRAM) -> DataFrame:
    """``keys``, pos, benchmark, item_id, item_pos: a row for each pair of an n-gram of ``text`` and a posting.

    Only hashes are exploded, so no n-gram is built as text; the index is the build side."""
    toks = texts.select(*keys, T.tokens(F.col("text")).alias("toks"))  # bound here: inside a lambda it would be made anew for every n-gram
    grams = toks.select(*keys, F.posexplode(T.ngrams(F.col("toks"), n, T.run_hash)).alias("pos", "h"))
    return grams.join(sized(index), "h").select(*keys, "pos", "benchmark", "item_id", "item_pos")


def flagged_spans(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Gaps and islands: runs of neighbouring hit positions of a benchmark, with the first posting's item and the distinct positions."""
    by = Window.partitionBy(*keys, "benchmark").orderBy("pos", "item_id", "item_pos")
    new = F.when(F.col("pos") - F.lag("pos").over(by) <= 1, 0).otherwise(1)
    islands = hits.withColumn("_new", new).withColumn("island", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy(*keys, "benchmark", "island").agg(F.min("pos").alias("start_token"), (F.max("pos") + T.NGRAM).alias("end_token"), F.min_by("item_id", F.struct("pos", "item_id", "item_pos")).alias("item_id"), F.countDistinct("pos").alias("n_positions"))
    return spans.drop("island")


def doc_report(texts: DataFrame, benchmark: DataFrame, keys: list[str], max_pct: float = 0.0) -> DataFrame:
    """n_tokens, n_ngrams, n_hits (pairs), n_positions, overlap_pct and status of each text; too short a text is NOT_CHECKED."""
    toks = texts.select(*keys, F.size(T.tokens(F.col("text"))).alias("n_tokens"))
    hits = ngram_hits(texts, postings(benchmark), keys).groupBy(*keys).agg(F.count("*").alias("n_hits"), F.countDistinct("pos").alias("n_positions"))
    out = toks.join(hits, keys, "left").na.fill(0, ["n_hits", "n_positions"])
    grams = F.greatest(F.col("n_tokens") - (T.NGRAM - 1), F.lit(0))
    pct = F.when(grams > 0, F.round(100.0 * F.col("n_positions") / grams, 4)).otherwise(0.0)
    status = F.when(grams == 0, "NOT_CHECKED").when(F.col("n_positions") > 0, "CONTAMINATED").when(pct > max_pct, "CONTAMINATED").otherwise("CLEAN")
    return out.select(*keys, "n_tokens", grams.alias("n_ngrams"), "n_hits", "n_positions", pct.alias("overlap_pct"), status.alias("status"))


def conversation_report(turns: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Roll-up by conversation (conv_id, turn, text): sums, and the ratio of sums. Blank turns are counted and not scanned."""
    each = doc_report(turns, benchmark, ["conv_id", "turn"])
    grams = F.sum("n_ngrams")
    return each.groupBy("conv_id").agg(F.count("*").alias("scanned_turns"), F.sum("n_tokens").alias("n_tokens"), grams.alias("n_ngrams"), F.sum("n_hits").alias("n_hits"), F.sum("n_positions").alias("n_positions"), F.when(grams > 0, F.round(100.0 * F.sum("n_positions") / grams, 4)).otherwise(0.0).alias("overlap_pct"), F.sum((F.col("status") == "CONTAMINATED").cast("long")).alias("flagged_turns"))


def turn_text(*parts: Column) -> Column:
    """Parts of a turn (content, reasoning, tool names and arguments), blank ones skipped, by line ends."""
    return F.trim(F.array_join(F.filter(F.array(*parts), lambda p: F.trim(p) != ""), "\n"))


def dataset_turns(items: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turn, text) of items of any shape (key, json): a list of turns, an object's ``messages`` or else its ``events``, any other object as
    one turn, a string or other value as one text; what is no JSON is a text too. An empty list has one blank turn, so that no item is lost."""
    v = F.try_parse_json("json")
    listed = F.coalesce(*[F.try_variant_get(v, p, "array<variant>") for p in ("$", "$.messages", "$.events")])
    turns = items.select(key, "json", F.when(F.size(listed) > 0, listed).when(listed.isNotNull(), F.array(F.lit(None).cast("variant"))).otherwise(F.array(v)).alias("turns"), listed.isNotNull().alias("_listed"))
    each = turns.select(key, "json", "_listed", F.posexplode("turns").alias("turn", "t"))
    inside = lambda *paths: F.coalesce(*[F.try_variant_get("t", p, "string") for p in paths], F.lit(""))
    parts = turn_text(inside("$.reasoning", "$.reasoning_content"), inside("$.content", "$.text", "$.payload.content", "$.data.content", "$.payload.text", "$.data.text"), F.coalesce(F.to_json(F.try_variant_get("t", "$.tool_calls", "variant")), F.lit("")))
    is_object = F.coalesce(F.schema_of_variant("t"), F.lit("")).startswith("OBJECT")
    text = F.when(is_object, parts).when(F.col("t").isNotNull(), F.coalesce(F.try_variant_get("t", "$", "string"), F.to_json("t"))).otherwise(F.when(F.col("_listed"), "").otherwise(F.coalesce("json", F.lit(""))))
    return each.select(key, F.col("turn").cast("long").alias("turn"), text.alias("text"))


def check_dataset(items: DataFrame, benchmark: DataFrame, key: str = "conv_id") -> DataFrame:
    """``conversation_report`` of items of any shape."""
    return conversation_report(dataset_turns(items, key).withColumnRenamed(key, "conv_id"), benchmark).withColumnRenamed("conv_id", key)


def split_clean(texts: DataFrame, report: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(clean, contaminated) rows of ``texts``; what was too short to be checked counts as clean."""
    dirty = report.where("status = 'CONTAMINATED'").select(*keys)
    return texts.join(dirty, keys, "left_anti"), texts.join(dirty, keys, "left_semi")


# MinHash -----------------------------------------------------------------------------------------------------------------


def parameters(n: int = PERMUTATIONS, seed: int = 42) -> list[tuple[int, int]]:
    """(a, b) of each function (a * h + b) mod PRIME, from digests of the seed."""
    number = lambda tag, k: int.from_bytes(hashlib.sha256(f"{seed}:{tag}:{k}".encode()).digest()[:8], "big")
    return [(number("a", k) % (PRIME - 1) + 1, number("b", k) % PRIME) for k in range(n)]


def signature_native(grams: DataFrame, keys: list[str], gram: str = "gram", n: int = 4) -> DataFrame:
    """Signatures by decimal arithmetic: for checking a few functions against SQL; ``signatures`` is for all of them."""
    h = grams.select(*keys, T.leading_bits(F.col(gram)).cast("decimal(38,0)").alias("h"))
    least = [F.min((h["h"] * F.lit(a).cast("decimal(19,0)") + F.lit(b).cast("decimal(19,0)")) % F.lit(PRIME).cast("decimal(19,0)")).cast("long").alias(f"m{k}") for k, (a, b) in enumerate(parameters(n))]
    return h.groupBy(*keys).agg(*least)


def _mulmod(h: np.ndarray, a: np.ndarray) -> np.ndarray:
    """h * a mod 2^61 - 1 for h, a < 2^61, in 64-bit words, broadcast: a is split so that no product leaves 64 bits, and high parts wrap round."""
    m, u = np.uint64(PRIME), np.uint64
    fold = lambda x: (x & m) + (x >> u(61))
    turn = lambda x, k: ((x & u((1 << 61 - k) - 1)) << u(k)) | (x >> u(61 - k))  # times 2^k within 61 bits
    low, high, out = h & u(0x7FFFFFFF), h >> u(31), u(0)
    for shift in (42, 21, 0):  # three parts of a, of 21 bits at most
        part = (a >> u(shift)) & u(0x1FFFFF)
        product = fold(low * part + turn(high * part, 31))  # below 2^52 and 2^61
        out = fold(out + turn(np.where(product >= m, product - m, product), shift))
    return np.where(out >= m, out - m, out)


class Minima:
    """The least value of each function over texts' hashes.

    (a * h + b) / PRIME is held as a fraction of 2^64 first: two products and a sum that wrap round, too great by less than SLACK. Only hashes within SLACK
    of a function's least fraction can be its minimum; those are computed exactly. Where the least one is below SLACK a fraction may have wrapped, so all are."""

    BLOCK, SLACK = 256, np.uint64(1 << 32)

    def __init__(self, n_perm: int):
        pairs = parameters(n_perm)
        part = lambda x: ((x << 64) + PRIME // 2) // PRIME & (1 << 64) - 1
        self.a, self.b = (np.array(c, np.uint64) for c in zip(*pairs))
        self.low, self.high, self.plus = (np.array(c, np.uint64) for c in zip(*((part(a), part((a << 31) % PRIME), (part(b) + (1 << 31)) & (1 << 64) - 1) for a, b in pairs)))

    def exact(self, h: np.ndarray, k: np.ndarray) -> np.ndarray:
        sums = _mulmod(h, self.a[k]) + self.b[k]
        return np.where(sums >= np.uint64(PRIME), sums - np.uint64(PRIME), sums)

    def __call__(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A row of minima (long) for each text, given the hashes of all end to end; zeros for a text without any."""
        n, h = len(self.a), hashes & np.uint64(PRIME)
        least = np.full((len(counts), n), PRIME, np.uint64)
        at, which, maybe = np.cumsum(counts) - counts, [], []
        for i, (lo, count) in enumerate(zip(at.tolist(), counts.tolist())):
            for start in range(lo, lo + count, self.BLOCK):
                v = h[start : min(start + self.BLOCK, lo + count), None]
                share = (v & np.uint64(0x7FFFFFFF)) * self.low
                share += (v >> np.uint64(31)) * self.high
                share += self.plus
                floor = share.min(axis=0)
                top = floor + self.SLACK
                top[(floor < self.SLACK) | (top < floor)] = np.uint64(2**64 - 1)
                found = np.flatnonzero(share <= top)
                maybe.append(found + start * n)
                which.append(np.full(len(found), i))
        if maybe:
            found, which = np.concatenate(maybe), np.concatenate(which)
            place, k = np.divmod(found, n)
            np.minimum.at(least, (which, k), self.exact(h[place], k))
        least[counts == 0] = 0
        return least.view(np.int64)


#: Texts whose runs are hashed at a time, and their bytes beyond a first one; what ``facts`` can tell of a text.
SLICE, SLICE_BYTES, FACTS = 64, 1 << 20, {"runs": "array<bigint>", "set_key": "binary", "may": "boolean", "sig": "array<bigint>"}


def known_runs(benchmark: DataFrame, n: int = T.NGRAM) -> np.ndarray | None:
    """The distinct run hashes of a benchmark, sorted, if they are few enough to be sent to all; else none."""
    found = materialised(facts(benchmark, ["item_id"], "runs", n=n).select(F.explode("runs").alias("h")).distinct())
    return np.sort(np.array([r.h for r in found.collect()], np.int64)) if found.count() <= BROADCAST_ROWS else None


def parts(batch: pa.RecordBatch, column: int):
    """A batch in pieces of ``SLICE`` rows at most, of one row or of ``SLICE_BYTES`` at most in ``column``."""
    ends, lo = np.cumsum(pc.binary_length(batch.column(column).cast(pa.binary())).fill_null(0).to_numpy()), 0
    while lo < batch.num_rows:
        fit = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_BYTES, "right"))
        hi = min(lo + SLICE, max(fit, lo + 1))
        yield batch.slice(lo, hi - lo)
        lo = hi


def facts(texts: DataFrame, keys: list[str], *names: str, known: np.ndarray | None = None, n_perm: int = PERMUTATIONS, n: int = T.NGRAM, all_signed: bool = False) -> DataFrame:
    """``keys`` and facts of each text's ``text``, in one pass in Arrow batches: ``runs``, the 64-bit hash of each n-gram (of a text under n tokens that of
    its whole token run, of one without tokens none); ``set_key``, equal for equal sets of runs; ``may``, whether one is among ``known``;
    ``sig``, minima over its runs. If ``known`` is given, a text without any of it has no ``sig``, unless ``all_signed``."""
    table, spark = symbols(texts.sparkSession), texts.sparkSession
    sent = None if known is None else spark.sparkContext.broadcast(known)
    schema = T_.StructType([texts.schema[k] for k in keys] + T_.StructType.fromDDL(", ".join(f"{c} {FACTS[c]}" for c in names)).fields)

    def told(batches):
        engine, minima = Runs(table, n), Minima(n_perm)
        some = None if sent is None else sent.value.view(np.uint64)
        bits = None
        if some is not None:  # a bit of 2^22 rules out most
            bits = np.zeros(1 << 22, bool)
            bits[some & np.uint64(len(bits) - 1)] = True
        for batch in batches:
            for part in parts(batch, len(keys)):
                h, counts = engine.of(part.column(len(keys)).cast(pa.binary()).to_pylist())
                ends = np.cumsum(counts)
                split = [h[e - c : e] for e, c in zip(ends.tolist(), counts.tolist())]
                may = None
                if some is not None:
                    near = np.flatnonzero(bits[h & np.uint64(len(bits) - 1)])
                    near = near[np.isin(h[near], some)]
                    may = np.zeros(len(counts), bool)
                    may[np.searchsorted(ends, near, "right")] = True
                out = []
                for c in names:
                    if c == "runs":
                        out.append(pa.array([x.view(np.int64) for x in split], pa.list_(pa.int64())))
                    elif c == "set_key":
                        out.append(pa.array([hashlib.sha256(np.unique(x).tobytes()).digest() for x in split], pa.binary()))
                    elif c == "may":
                        out.append(pa.array(may))
                    else:
                        some_texts = np.flatnonzero(may) if may is not None and not all_signed else np.arange(len(counts))
                        signed = [None] * len(counts)
                        if len(some_texts):
                            rows = minima(np.concatenate([split[i] for i in some_texts]), counts[some_texts])
                            for i, row in zip(some_texts.tolist(), rows):
                                signed[i] = row
                        out.append(pa.array(signed, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keys))), *out], names=[*keys, *names])
        pa.default_memory_pool().release_unused()

    return texts.select(*keys, "text").mapInArrow(told, schema)


def signatures(texts: DataFrame, keys: list[str], n_perm: int = PERMUTATIONS, n: int = T.NGRAM) -> DataFrame:
    """``keys`` and sig array<long>: minima over the distinct n-grams of each text; a text with no token has zeros, one under n tokens its
    whole token run as the only n-gram."""
    return facts(texts, keys, "sig", n_perm=n_perm, n=n)


def holders(texts: DataFrame, benchmark: DataFrame, keys: list[str], *names: str, n_perm: int = PERMUTATIONS, all_signed: bool = False) -> DataFrame:
    """``facts`` of all texts with ``may``, saved; ``sig``, and its hash ``_s``, only of those that may unless ``all_signed``. A benchmark of too many runs
    to be sent to all is joined by its hashes."""
    known = known_runs(benchmark)
    if known is not None:
        out = facts(texts, keys, "may", *names, known=known, n_perm=n_perm, all_signed=all_signed)
    else:
        index = materialised(facts(benchmark, ["item_id"], "runs").select(F.explode("runs").alias("h")).distinct())
        may = facts(texts, keys, "runs").select(*keys, F.explode("runs").alias("h")).join(index, "h", "left_semi").select(*keys).distinct()
        out = facts(texts, keys, *names, n_perm=n_perm).join(sized(may.withColumn("may", F.lit(True))), keys, "left").na.fill(False, ["may"])
    return materialised(out.withColumn("_s", T.run_hash(F.col("sig"))) if "sig" in names else out)


def similarity(a: Column, b: Column) -> Column:
    """Share of equal places; 0 for signatures of different lengths."""
    n = F.size(a)
    return F.when((n == F.size(b)) & (n > 0), F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x) / n).otherwise(0.0)


def most_similar(texts: DataFrame, benchmark: DataFrame, keys: list[str], n_perm: int = PERMUTATIONS) -> DataFrame:
    """The greatest similarity of each text to a benchmark item, and the first such item; 0 and null where nothing agrees.

    A join of (place, value) pairs counts agreements, so texts that agree nowhere with an item never meet it."""
    places = lambda df, *cols: df.select(*cols, F.posexplode("sig").alias("k", "v"))
    items = places(signatures(benchmark, ["item_id"], n_perm), "item_id")
    signed = holders(texts, benchmark, keys, "sig", n_perm=n_perm).where("may").where(F.exists("sig", lambda v: v != 0))  # functions are one-to-one: equal minima come of an equal n-gram
    same = places(signed, *keys).join(sized(items.where("v <> 0")), ["k", "v"]).groupBy(*keys, "item_id").count()
    best = same.groupBy(*keys).agg(F.max_by(F.struct("item_id", "count"), F.struct("count", -F.col("item_id"))).alias("b"))
    out = texts.select(*keys).join(best, keys, "left")
    return out.select(*keys, F.coalesce(F.col("b.count") / n_perm, F.lit(0.0)).alias("similarity"), F.col("b.item_id").alias("item_id"))


def check_documents(texts: DataFrame, benchmark: DataFrame, keys: list[str], n_perm: int = PERMUTATIONS) -> DataFrame:
    """``doc_report`` with similarity; a text similar as a whole, without an exact span, is flagged as a whole document."""
    both = doc_report(texts, benchmark, keys).join(most_similar(texts, benchmark, keys, n_perm), keys)
    whole = (F.col("similarity") >= SIMILAR) & (F.col("n_positions") == 0) & (F.col("n_ngrams") > 0)
    return both.withColumn("whole_document", whole).withColumn("status", F.when(whole, "CONTAMINATED").otherwise(F.col("status")))
