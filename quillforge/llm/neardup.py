"""Near-duplicate documents by MinHash with tensored banding.

Table keys combine one half key of each of two small collections: M + M half keys of K minhashes each give M x M
tables, so 2MK hash functions do the work of 2M^2 K. Two documents share a table exactly where they share a half
key of either collection, so half keys that only one document has are dropped before any table key is formed.
Every link is confirmed on the full shingle sets.

No bucket is expanded into pairs. Documents with equal sets are one class from the start. Each class is held
against the least class, the hub, that it meets in most buckets; confirmed links are joined into components. Pairs
of a bucket that are in one component by then need no check. Buckets of several components are verified in blocks:
by half key of the first collection, the classes outside the main component are a query set against all, in blocks
of bounded size, whose set intersections are counted as products of incidence matrices. Only links that join
components leave a block, fewer than it has classes. So no pair that shares a bucket is left undecided. Pairs of
similarity 0.85 share none with probability 1 - (1 - (1 - 0.85^3)^10)^2, about 0.00015, of 0.8 about 0.0015.

Defined results: a null or empty text, or one without a word, has an empty set and is linked with nothing; equal
sets are linked; a null id is never the smallest, and of documents that have none the component is null; an empty
table gives no rows. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch, as_struct, slices, text_key
from .words import mix, word_hashes

K, M = 3, 10
#: Classes a block holds at about most, those that are held against them, shingles of a block, and matrix columns at a time.
BLOCK, QUERIES, BLOCK_SHINGLES, COLUMNS = 1024, 256, 500_000, 4096
_U = np.uint64


def sets(texts: Iterable[bytes | None], width: int) -> list[np.ndarray]:
    """For each text the hashes of its distinct shingles of ``width`` words, sorted; of fewer words, one of the whole sequence; of none, none."""
    h, counts = word_hashes(texts)
    n = len(h) - width + 1
    rolled = h[: max(n, 0)].copy()
    for i in range(1, width if n > 0 else 0):
        rolled = mix(rolled) + h[i : i + n]
    rolled = mix(rolled)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(rolled[at : at + c - width + 1]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[at : at + c].tobytes(), seed=1)], _U) if c else np.zeros(0, _U))
        at += c
    return out


def _family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 1 << 64, n, _U) | _U(1), rng.integers(0, 1 << 64, n, _U)


def minhashes(x: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 4096) -> np.ndarray:
    out = np.full(len(a), np.iinfo(_U).max, _U)
    for lo in range(0, len(x), block):
        part = x[lo : lo + block]
        for i in range(len(a)):
            out[i] = min(out[i], (part * a[i] + b[i]).min())
    return out


SIGNED = "cls binary, n_shingles long, halves array<long>"


def sign(docs: DataFrame, width: int, seed: int = 11) -> DataFrame:
    """doc_id and text key of every row, with its class (128-bit hash of the set), set size and half keys."""
    family = _family(2 * M * K, seed)

    def rows(batches):
        for b in slices(batches):
            cls, n, halves, known = [], [], [], {}
            for s in sets((v.as_py() for v in b.column(3).cast(pa.large_binary())), width):
                n.append(len(s))
                if not len(s):
                    cls.append(None)
                    halves.append(None)
                    continue
                key = xxhash.xxh3_128_digest(s.tobytes())
                if key not in known:
                    m = minhashes(s, *family)
                    h = mix(mix(mix(m[0::K] + _U(1)) + m[1::K]) + m[2::K] + np.arange(2 * M, dtype=_U))
                    known[key] = h.view(np.int64)
                cls.append(key)
                halves.append(known[key])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(halves, pa.list_(pa.int64()))], names=["doc_id", "_th", "_tl", "cls", "n_shingles", "halves"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(rows, f"doc_id long, _th long, _tl int, {SIGNED}")


def buckets(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, hub, cls, half): the tables' rows in buckets of two classes or more; half is the row's half key of the first collection."""
    half = classes.select("cls", F.posexplode("halves").alias("i", "h"))
    shared = half.groupBy("h").count().where("count > 1").select("h")
    kept = half.join(shared, "h").groupBy("cls").agg(F.collect_list(F.when(F.col("i") < M, F.col("h"))).alias("a"), F.collect_list(F.when(F.col("i") >= M, F.col("h"))).alias("b"))
    pair = F.transform(F.col("a"), lambda a: F.transform(F.col("b"), lambda b: F.struct(a.alias("half"), F.xxhash64(a, b).alias("key"))))
    keyed = scratch.save(kept.where((F.size("a") > 0) & (F.size("b") > 0)).select("cls", F.explode(F.flatten(pair)).alias("t")).select("cls", "t.half", "t.key"), "keyed")
    many = keyed.groupBy("key").agg(F.count("*").alias("c"), F.min("cls").alias("hub")).where("c > 1").select("key", "hub")
    return keyed.join(many, "key")


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of ``pairs`` (x, y) of classes, those whose full sets have 100 * intersection >= percent * union."""
    left = pairs.join(texts.select(F.col("cls").alias("x"), F.col("text").alias("tx")), "x")
    both = left.join(texts.select(F.col("cls").alias("y"), F.col("text").alias("ty")), "y").select("x", "y", "tx", "ty")

    def check(batches):
        last = (None, None)
        for b in slices(batches):
            keep, own = [], sets((t.as_py().encode() for t in b.column(2)), width)
            for i in range(b.num_rows):
                y = b.column(1)[i].as_py()
                if last[0] != y:
                    last = (y, sets([b.column(3)[i].as_py().encode()], width)[0])
                s, t = own[i], last[1]
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            ok = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["x", "y"])

    return both.mapInArrow(check, "x binary, y binary")


def block_links(group: pa.Table, width: int, percent: int) -> pa.Table:
    """Links that join components, between the queries and the members of a block (cls, root, query, text)."""
    cls, root, query = group["cls"].to_pylist(), group["root"].to_pylist(), np.array(group["query"].to_pylist())
    found = sets((t.as_py().encode() for t in group["text"]), width)
    sizes, q, m = np.array([len(x) for x in found]), np.flatnonzero(query), np.flatnonzero(~query)
    owner, token = np.repeat(np.arange(len(found)), sizes), np.concatenate(found)
    column = np.unique(token, return_inverse=True)[1]
    both = np.bincount(column[query[owner]], minlength=column.max() + 1).astype(bool) & np.bincount(column[~query[owner]], minlength=column.max() + 1).astype(bool)
    place = np.cumsum(both) - 1
    owner, column = owner[both[column]], place[column[both[column]]]
    row = np.zeros(len(found), np.int64)
    row[q], row[m] = np.arange(len(q)), np.arange(len(m))
    common = np.zeros((len(q), len(m)), np.float32)
    for lo in range(0, int(both.sum()), COLUMNS):
        near = (column >= lo) & (column < lo + COLUMNS)
        o, c = owner[near], column[near] - lo
        side = query[o]
        a, b = np.zeros((len(q), COLUMNS), np.float32), np.zeros((len(m), COLUMNS), np.float32)
        a[row[o[side]], c[side]], b[row[o[~side]], c[~side]] = 1, 1
        common += a @ b.T
    link = 100 * common >= percent * (sizes[q][:, None] + sizes[m][None, :] - common)
    parent: dict[bytes, bytes] = {}

    def find(r):
        while (up := parent.get(r, r)) != r:
            parent[r] = parent.get(up, up)
            r = up
        return r

    out = []
    for i, j in zip(*(k.tolist() for k in np.nonzero(link))):
        x, y = find(root[q[i]]), find(root[m[j]])
        if x != y:
            parent[x] = y
            out.append((cls[q[i]], cls[m[j]]))
    return pa.table([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], names=["x", "y"])


def leftover_links(inside: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(x, y): confirmed links between components, of classes that share a bucket of several; found in blocks."""
    placed = inside.select("key", "half", "cls").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    rest = placed.join(mixed, "key").select("half", "cls", "root").distinct().join(classes.select("cls", "n_shingles"), "cls")
    each = rest.groupBy("half", "root").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("s"))
    by = each.groupBy("half").agg(F.sum("c").alias("n"), F.sum("s").alias("s"), F.max_by(F.struct("root", "c", "s"), F.struct("c", "root")).alias("main"))
    parts = lambda n, most, s: F.ceil(F.greatest(n / most, s / BLOCK_SHINGLES))
    dealt = rest.join(by.select("half", F.col("main.root").alias("main"), parts(F.col("n"), BLOCK, F.col("s")).alias("blocks"), parts(F.col("n") - F.col("main.c"), QUERIES, F.col("s") - F.col("main.s")).alias("asking")), "half")
    own = lambda c: F.pmod(F.xxhash64("cls"), F.col(c))
    every = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    members = F.transform(every("asking"), lambda k: F.struct(k.alias("q"), own("blocks").alias("m"), F.lit(False).alias("query")))
    queries = F.transform(every("blocks"), lambda k: F.struct(own("asking").alias("q"), k.alias("m"), F.lit(True).alias("query")))
    roles = dealt.select("half", "cls", "root", F.explode(F.when(F.col("root") == F.col("main"), members).otherwise(F.concat(members, queries))).alias("r")).select("half", "r.*", "cls", "root")
    full = roles.join(texts, "cls").select("half", "q", "m", "cls", "root", "query", "text")
    return full.groupBy("half", "q", "m").applyInArrow(lambda t: block_links(t, width, percent), "x binary, y binary")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(cls, root): the least class of every linked class's component, by alternating large-star and small-star steps."""
    edges = scratch.save(links.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        both = edges.unionAll(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        down = large.where("x <> y").distinct()
        low = down.groupBy("x").agg(F.min("y").alias("m"))
        small = down.join(low, "x").select(F.explode(F.array(F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e")).select("e.x", "e.y").where("x <> y").distinct()
        step += 1
        edges = scratch.save(small, f"{name}-{step}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}-{step - 1}")
        if now == state or now[0] == 0:
            return edges.select(F.col("x").alias("cls"), F.col("y").alias("root"))
        state = now


def _link(docs: DataFrame, signed: DataFrame, scratch: Scratch, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The classes (cls, rep: the first row's id and text key) and (cls, root) of the linked ones."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th", "_tl")
    classes = scratch.save(signed.where("cls is not null").groupBy("cls").agg(F.min(first).alias("rep"), F.first("halves").alias("halves"), F.first("n_shingles").alias("n_shingles")), "classes")
    inside = scratch.save(buckets(classes, scratch), "buckets")
    best = scratch.save(inside.where("cls <> hub").groupBy("cls", "hub").count().groupBy("cls").agg(F.max_by("hub", F.struct("count", "hub")).alias("y")).withColumnRenamed("cls", "x"), "spokes")
    if not best.take(1):
        return classes, best.select(F.col("x").alias("cls"), F.col("y").alias("root"))
    wanted = inside.select("cls").distinct().join(classes.select("cls", "rep"), "cls").select("cls", F.coalesce("rep.doc_id", F.lit(0)).alias("_i"), F.col("rep.none").alias("_no"), F.col("rep._th").alias("_th"), F.col("rep._tl").alias("_tl"))
    there = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_i"), F.col("doc_id").isNull().alias("_no"), *text_key(), F.col("text").cast("string").alias("text"))
    texts = scratch.save(there.join(wanted, ["_i", "_no", "_th", "_tl"]).groupBy("cls").agg(F.min("text").alias("text")), "texts")
    links = scratch.save(confirm(best, texts, width, percent), "links")
    roots = components(links, scratch, "roots")
    more = scratch.save(leftover_links(inside, roots, classes, texts, width, percent), "more")
    if more.take(1):
        roots = components(links.unionAll(more), scratch, "all-roots")
    scratch.drop("keyed", "buckets", "spokes", "texts", "links", "more")
    return classes, roots


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): n_shingles, component_id (the least id linked with it, its own included), kept
    (it has that id), and whether its row is the one that stands for the component (``first``; equal rows all do)."""
    scratch = Scratch(docs.sparkSession)
    signed = scratch.save(sign(docs, width), "signed")
    classes, roots = _link(docs, signed, scratch, width, percent)
    rooted = classes.select("cls", "rep").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    reps = rooted.groupBy("root").agg(F.min("rep").alias("rep"))
    of_class = rooted.select("cls", "root").join(reps, "root").select("cls", "rep")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th", "_tl")
    out = signed.select("doc_id", "_th", "_tl", "cls", "n_shingles").join(of_class, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("rep.doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), (F.col("cls").isNull() | (own == F.col("rep"))).alias("first"), "_th", "_tl")


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, same columns, with one row of each component; rows equal in id and text become one."""
    kept = near_duplicates(docs, width, percent).where("first").select(F.coalesce("doc_id", F.lit(0)).alias("_i"), F.col("doc_id").isNull().alias("_no"), "_th", "_tl").distinct()
    keyed = docs.select(as_struct(docs).alias("doc"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_i"), F.col("doc_id").isNull().alias("_no"), *text_key())
    return keyed.join(kept, ["_i", "_no", "_th", "_tl"]).dropDuplicates(["_i", "_no", "_th", "_tl"]).select("doc.*")
