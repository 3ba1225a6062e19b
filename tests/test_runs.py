"""Token runs and minima over whole arrays against the JVM's expressions and big integers, and what the curation queries save and read."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillforge.functions import runs as R
from quillforge.functions import text as T
from quillforge.operators import contamination as C
from quillforge.operators import dedup as D

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def by_columns(df):
    """The run hashes as Spark's own expressions give them."""
    toks = df.select("doc_id", T.tokens(F.col("text")).alias("toks"))
    runs = F.when(F.size("toks") >= T.NGRAM, T.ngrams(F.col("toks"), T.NGRAM, F.xxhash64)).when(F.size("toks") > 0, F.array(F.xxhash64("toks"))).otherwise(F.expr("cast(array() as array<bigint>)"))
    return {r.doc_id: r.runs for r in toks.select("doc_id", runs.alias("runs")).collect()}


def test_runs_are_those_of_the_columns(spark):
    """Every code point of three planes, tokens of 1 to 90 bytes, texts of fewer tokens than a run, null and empty."""
    rng = random.Random(1)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    word = lambda most: "".join(rng.choice("abcXYZ09_") for _ in range(rng.randrange(1, most)))
    texts = ["".join(chr(c) + " " for c in range(a, a + 256)) for a in range(0, 0x30000, 256) if not 0xD800 <= a < 0xE000]
    texts += ["".join(chr(rng.choice(points)) if rng.random() < 0.4 else rng.choice("abcDEF_9 \n.!") for _ in range(rng.randrange(400))) for _ in range(100)]
    texts += [" ".join(word(90) for _ in range(40)) for _ in range(30)] + ["x " * n for n in range(16)] + [None, "", "é" * 50, "a" * (R.PIECE + 5), "b " * (R.WINDOW + 40)]
    df = table(spark, texts)
    got = {r.doc_id: r.runs for r in C.facts(df, ["doc_id"], "runs").collect()}
    assert got == by_columns(df)


def test_bytes_that_are_no_text(spark):
    df = spark.sql("select 1L as doc_id, cast(unhex('61FF62E2C0') as string) as text union all select 2L, cast(unhex('C3') as string)")
    assert {r.doc_id: r.runs for r in C.facts(df, ["doc_id"], "runs").collect()} == by_columns(df)


def test_minima_are_those_of_big_integers():
    """Also where a fraction wraps: hashes whose values are the least and greatest there are."""
    minima, (a, b) = C.Minima(4), C.parameters(4)[0]
    inverse = pow(a, -1, C.PRIME)
    for values in ([C.PRIME - 1], [C.PRIME - 1, C.PRIME - 2], [C.PRIME - 1, 0], [0, 1], [2**29, 2**29 - 1, 2**30], [C.PRIME - 3, C.PRIME // 2]):
        assert minima(np.array([(v - b) * inverse % C.PRIME for v in values], np.uint64), np.array([len(values)]))[0, 0] == min(values)
    rng, counts = random.Random(2), [0, 1, 3, 255, 256, 257, 0, 700]
    hashes = [rng.getrandbits(64) for _ in range(sum(counts))]
    got, at = minima(np.array(hashes, np.uint64), np.array(counts)), 0
    for row, n in zip(got.tolist(), counts):
        assert row == [min(((h & C.PRIME) * a + b) % C.PRIME for h in hashes[at : at + n]) if n else 0 for a, b in C.parameters(4)]
        at += n


@pytest.mark.parametrize("small", [True, False])
def test_only_texts_that_share_a_run_are_signed(spark, monkeypatch, small):
    """minima, the cost of the search, are made for texts that can agree with an item; also where the benchmark is too large to be sent to all."""
    if not small:
        monkeypatch.setattr(C, "known_runs", lambda *a, **k: None)
    bench = table(spark, [ITEM, "", "too short"]).withColumnRenamed("doc_id", "item_id")
    texts = table(spark, [f"before {ITEM}", "other words " * 20, "too short", "", None, ITEM])
    told = {r.doc_id: r for r in C.holders(texts, bench, ["doc_id"], "sig").collect()}
    assert {k for k, r in told.items() if r.may} == {0, 2, 5}
    assert not small or {k for k, r in told.items() if r.sig} == {0, 2, 5}
    got = {r.doc_id: (r.similarity, r.item_id) for r in C.most_similar(texts, bench, ["doc_id"]).collect()}
    assert got[5] == (1.0, 0) and got[2] == (1.0, 2) and 0.5 < got[0][0] < 1 and got[1] == got[3] == got[4] == (0.0, None)


def test_equal_sets(spark):
    """equal sets of n-grams, whatever their order, and one class of texts without tokens; a digest and no text leaves the pass."""
    rows = table(spark, ["x y", "X Y", "x y z", "", None, f"{ITEM} {ITEM} {ITEM}", f"{ITEM} {ITEM} {ITEM} {ITEM}", ITEM, "é"])
    assert {r.doc_id: r.survivor for r in D.equal_sets(rows).collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7, 8: 3}
    assert len(C.facts(rows, ["doc_id"], "set_key").first().set_key) == 32


def size(spark):
    import os

    return sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) for f in fs if f.endswith(".parquet"))


def test_audit_saves_no_runs(spark):
    """what the audit saves is some kilobytes a text, not its hashed n-grams."""
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(4000)) for _ in range(40)]
    rows, bench = table(spark, [*texts, texts[0], f"{ITEM} and more"]), table(spark, [ITEM]).withColumnRenamed("doc_id", "item_id")
    before = size(spark)
    got = {r.doc_id: (r.status, r.duplicate_of) for r in D.audit(rows, bench).collect()}
    assert got[40] == ("DUPLICATE_EXACT", 0) and got[41] == ("CONTAMINATED", None) and sum(s == "CLEAN" for s, _ in got.values()) == 40
    assert size(spark) - before < 42 * 4000  # the runs alone are 42 x 32,000 bytes


def test_signatures_come_in_small_batches(spark):
    """while a table is saved, what a Python worker gets at once is bounded in bytes."""
    from quillforge.operators import checkpoints

    df = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))

    def seen(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    most = checkpoints.materialised(df.mapInArrow(seen, "n long")).agg(F.max("n")).first()[0]
    assert most <= 16 << 20 and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != "8388608b"


def test_long_texts_are_hashed_in_small_parts():
    """what a Python worker hashes at a time is bounded in bytes, but for a single longer text; no row is left out."""
    import pyarrow as pa

    texts = ["w " * 100_000] * 40 + ["w " * 1_000_000, None, "", "w"] + ["a b"] * 200
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = list(C.parts(batch, 1))
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(len(texts)))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column(1).to_pylist()) <= C.SLICE_BYTES and b.num_rows <= C.SLICE for b in got)
    assert len(got) < 20
