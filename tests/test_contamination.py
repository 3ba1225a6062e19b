import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillforge.functions import text as T
from quillforge.operators import contamination as C
from quillforge.operators import dedup as D

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, ""), (3, "too short")], "item_id long, text string")


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_tokens(spark):
    row = docs(spark, "Héllo, World_1 x²! é").select(T.tokens(F.col("text"))).first()[0]
    assert row == ["h", "llo", ",", "world_1", "x", "!"]


def test_report(spark, bench):
    got = {r.doc_id: r for r in C.doc_report(docs(spark, f"before {ITEM} after", "short", None, "a b c d e f g h i j k l m n"), bench, ["doc_id"]).collect()}
    assert (got[0].n_hits, got[0].n_positions, got[0].status, got[0].n_ngrams) == (3, 3, "CONTAMINATED", 5)
    assert got[0].overlap_pct == 60.0
    assert got[1].status == got[2].status == "NOT_CHECKED" and got[3].status == "CLEAN"


def test_spans_are_islands(spark, bench):
    d = docs(spark, f"{ITEM} gap {ITEM}")
    spans = C.flagged_spans(C.ngram_hits(d, C.postings(bench), ["doc_id"]), ["doc_id"]).orderBy("start_token").collect()
    assert [(s.start_token, s.end_token, s.n_positions, s.item_id) for s in spans] == [(0, 15, 3, 1), (16, 31, 3, 1)]


def test_conversation_sums(spark, bench):
    turns = spark.createDataFrame([(1, 0, ITEM), (1, 1, ""), (2, 0, "fine words")], "conv_id long, turn long, text string")
    got = {r.conv_id: r for r in C.conversation_report(turns, bench).collect()}
    assert (got[1].scanned_turns, got[1].n_hits, got[1].flagged_turns, got[1].overlap_pct) == (2, 3, 1, 100.0)
    assert got[2].n_hits == 0


def test_modular_product():
    rng = random.Random(1)
    h = [rng.randrange(1 << 61) for _ in range(500)] + [0, C.PRIME - 1, C.PRIME]
    for _ in range(20):
        a = rng.randrange(1, C.PRIME)
        got = C._mulmod(np.array(h, np.uint64), np.uint64(a))
        assert [int(x) for x in got] == [x * a % C.PRIME for x in h]


def test_signature_is_what_big_integers_give(spark):
    d = docs(spark, ITEM)
    sig = C.signatures(d, ["doc_id"], 8).first().sig
    hashes = d.select(F.explode(T.ngrams(T.tokens(F.col("text")), key=F.xxhash64))).collect()
    hs = [int(np.array([r[0]], np.int64).view(np.uint64)[0]) & C.PRIME for r in hashes]
    assert list(sig) == [min((a * h + b) % C.PRIME for h in hs) for a, b in C.parameters(8)]


def test_most_similar(spark, bench):
    got = {r.doc_id: r for r in C.most_similar(docs(spark, ITEM, "other words entirely " * 6, ""), bench, ["doc_id"]).collect()}
    assert got[0].similarity == 1.0 and got[0].item_id == 1
    assert got[1].similarity == 0.0 and got[1].item_id is None and got[2].similarity == 0.0


def sequential(sigs, cut):
    """Survivor of each key by the plain pass: the first accepted signature that agrees enough."""
    taken, out = [], {}
    for k in sorted(sigs):
        near = [a for a in taken if sum(x == y for x, y in zip(sigs[a], sigs[k])) / len(sigs[k]) >= cut]
        out[k] = near[0] if near else None
        taken += [] if near else [k]
    return out


@pytest.mark.parametrize("tail", [0, 3, 1000])
def test_acceptance_in_order(spark, tail):
    """Chains in which each is near the next only, equal signatures, and a lesser survivor that is accepted in a later round."""
    rng = random.Random(3)
    sigs, at = {}, [rng.randrange(50) for _ in range(40)]
    for k in rng.sample(range(1000), 60):
        for _ in range(rng.randrange(5)):
            at[rng.randrange(40)] = rng.randrange(10**6)
        sigs[k] = list(at)
    sigs |= {2000 + k: sigs[s] for k, s in enumerate(list(sigs)[:5])}
    df = spark.createDataFrame(list(sigs.items()), "doc_id long, sig array<long>")
    got = {r.doc_id: r for r in D.accept_similar(df, "doc_id", 0.85, 7, 40, tail).collect()}
    want = sequential(sigs, 0.85)
    assert {k: r.survivor for k, r in got.items()} == want and len(set(want.values())) > 5
    assert all(r.jaccard >= 0.85 for r in got.values() if r.survivor is not None)


def test_many_equal_texts_make_no_pairs(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.array(*[F.lit(7).cast("long")] * 128).alias("sig"))
    out = D.accept_similar(df, "doc_id")
    assert out.count() == 1000 and out.where("survivor = 0 and jaccard = 1.0").count() == 999


def test_audit(spark, bench):
    base = " ".join(f"word{i}" for i in range(300))
    near = base.replace("word299", "other")
    rows = docs(spark, ITEM + " and more", base, base.upper(), near, near + " ", "lone text of its own", "")
    got = {r.doc_id: r for r in D.audit(rows, bench).collect()}
    assert [got[i].status for i in range(7)] == ["CONTAMINATED", "CLEAN", "DUPLICATE_EXACT", "DUPLICATE_MINHASH", "DUPLICATE_MINHASH", "CLEAN", "CLEAN"]
    assert got[2].duplicate_of == got[3].duplicate_of == got[4].duplicate_of == 1
    s = D.summary(D.audit(rows, bench)).first()
    assert (s.ingested, s.duplicates, s.contaminated, s.clean) == (7, 3, 1, 3)


def test_seed_text(spark):
    row = spark.createDataFrame([("", "Do it", "coder", [("think", "say"), ("", "more")])], "prompt string, question string, role string, messages array<struct<reasoning:string,content:string>>")
    text = row.select(D.seed_text({c: F.col(c) for c in ("prompt", "question", "role")}, F.col("messages"))).first()[0]
    assert text == "Do it\ncoder\nreasoning: think\ncontent: say\ncontent: more"
