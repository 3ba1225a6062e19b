import json

import pytest
from pyspark.sql import functions as F

from quillforge.operators import admission as A
from quillforge.operators import assay as Y
from quillforge.operators import events as E
from quillforge.operators import lot as L
from quillforge.operators import receipts as R
from quillforge.operators import suite
from quillforge.operators.vault import REQUIRED_CHECKS, Vault, VaultError, report_gaps
from quillforge.streaming import scrub

OK = {"record_id": "r", "schema_version": 2, "split": "train", "split_group_ids": ["g"], "rights_status": "OPERATOR_OWNED_FULL_RIGHTS", "privacy_status": "PASS_AUTOMATED_SCAN", "quality_review": "AUTOMATED_REVIEW_PASS", "authorship_class": "operator_material", "content_sha256": "a" * 64, "source_status": "PASSED", "evaluation_status": "PASS", "assertion_sha256": "b" * 64}
DDL = "record_id string, schema_version int, split string, split_group_ids array<string>, rights_status string, privacy_status string, quality_review string, authorship_class string, content_sha256 string, source_status string, evaluation_status string, assertion_sha256 string"


def admit(spark, *changes):
    rows = [OK | {"record_id": f"r{i}"} | c for i, c in enumerate(changes)]
    names = [c.split()[0] for c in DDL.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], DDL)
    return {r.record_id: list(r.reasons) for r in A.admit(df).collect()}


def test_admission(spark):
    got = admit(spark, {}, {"rights_status": None, "privacy_status": "RAW"}, {"content_sha256": "x", "rights_status": None}, {"split": "heldout_eval", "split_group_ids": ["h"]}, {"split_group_ids": ["g", "h"]}, {"schema_version": 3, "source_status": "RIGHTS_ASSERTED"}, {"source_status": "RIGHTS_ASSERTED"}, {"schema_version": 1, "source_status": None, "evaluation_status": None})
    assert got["r0"] == got["r5"] == got["r7"] == []
    assert got["r1"] == ["rights: null", "privacy: RAW"] and got["r2"] == ["schema: invalid"]
    assert got["r3"] == ["split: heldout_eval"] and got["r4"] == ["leakage: a split group is held out"] and got["r6"] == ["source_status: not passed"]


def test_binding_null_never_matches(spark):
    b = spark.createDataFrame([("a", "m", None), ("b", None, None), ("c", "m", "x"), ("d", "m", "x")], "artifact_id string, manifest_sha256 string, head_sha256 string")
    e = spark.createDataFrame([("a", "m", None, "L", "s"), ("b", None, None, "L", "s"), ("c", "m", "y", "L", "s")], "artifact_id string, manifest_sha256 string, head_sha256 string, rights_status string, assertion_sha256 string")
    assert {r.artifact_id: r.binding for r in A.bind_rights(b, e).collect()} == {"a": "BOUND", "b": "INSUFFICIENT", "c": "MISMATCH", "d": "UNMATCHED"}


@pytest.mark.parametrize("b,c,p", [(0, 0, 1.0), (5, 5, 1.0), (10, 0, 2 / 1024), (8, 2, 0.109375), (600, 400, 2.7e-10), (600, 500, 0.00283), (499, 501, 0.9748), (1, 999, None), (5000, 4900, 0.3196), (900, 100, None)])
def test_mcnemar(spark, b, c, p):
    if p is not None:
        assert Y.mcnemar(b, c) == pytest.approx(p, rel=0.02)
    assert spark.range(1).select(Y.mcnemar_column(F.lit(b), F.lit(c))).first()[0] == pytest.approx(Y.mcnemar(b, c), rel=1e-9, abs=1e-300)


def test_erfc(spark):
    import math

    xs = [0.0, 0.1, 1.0, 2.49, 2.51, 5.0, 20.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(Y.erfc_column(F.col("x"))).collect()]
    assert got == [pytest.approx(math.erfc(x), rel=1e-8) for x in xs]


def test_every_admissible_value(spark):
    """Each value of each list is admitted, and each split is what it is: two train, one is held out."""
    lists = {"rights_status": A.ADMISSIBLE_RIGHTS, "privacy_status": A.ADMISSIBLE_PRIVACY, "quality_review": A.ADMISSIBLE_REVIEW, "authorship_class": A.ADMISSIBLE_AUTHORSHIP, "split": A.TRAINING}
    got = admit(spark, *({k: v} for k, values in lists.items() for v in values))
    assert len(got) == 4 + 4 + 3 + 8 + 2 and not any(got.values())


def test_report_verdicts(spark):
    row = lambda b, t, n: [(f"{b}{t}{i}", "task", b, t, None, None, 1, 1, 1, 1, 4, 2, 10, 5, 1.0, 1.0) for i in range(n)]
    good = spark.createDataFrame(row(False, True, 20) + row(True, True, 25) + row(True, False, 2) + row(False, False, 3), Y.CASE)
    r = Y.report(good)
    assert (r.verdict, r.wins, r.losses, r.gain, r.turns_saved, r.tokens_saved_pct) == ("PROVEN", 20, 2, 36.0, 2.0, 50.0)
    assert Y.report(good).seal_sha256 == r.seal_sha256
    assert Y.report(spark.createDataFrame(row(True, False, 5) + row(True, True, 5), Y.CASE)).verdict == "REGRESSION"
    assert Y.report(good.limit(0)).verdict == "INSUFFICIENT"


def test_pairing(spark):
    rec = lambda i, ok: json.dumps({"case": {"id": i, "task": "t"}, "validation": {"accepted": ok}, "calls_used": 2} if i else {"status": "SCORED"})
    base = spark.createDataFrame([(rec("a", False), 0), (rec("b", True), 1), (rec("", True), 2)], "json string, ord int")
    tuned = spark.createDataFrame([(rec("a", False), 0), (rec("a", True), 1), (rec("z", True), 2)], "json string, ord int")
    got = Y.pair(Y.receipts_to_cases(base), Y.receipts_to_cases(tuned)).collect()
    assert [(r.case_id, r.base_passed, r.tuned_passed) for r in got] == [("a", False, True)]
    assert Y.receipts_to_cases(base).where("case_id = 'case_0002'").first().passed


def test_chain(spark):
    rows = [("r", 0, 1, "{}", "h1", ""), ("r", 1, 2, "{}", "h2", "h1"), ("r", 2, 2, "{}", "h3", "bad")]
    e = spark.createDataFrame(rows, "run_id string, position int, sequence int, payload string, event_sha256 string, prev_event_sha256 string")
    assert sorted(r.problem for r in E.chain_problems(e).collect()) == ["HASH_MISMATCH", "SEQUENCE_REGRESSION"]


def test_as_of_and_leads(spark):
    e = spark.createDataFrame([(1, i, k) for i, k in enumerate("qqaqxa")] + [(2, 9, "q")], "run int, n int, kind string")
    got = {r.request_id: r.action_id for r in E.next_action(e, "run", ["n"], F.col("kind") == "q", F.col("kind") == "a", "n").collect()}
    assert got == {0: 2, 1: 2, 3: 5, 9: None}
    assert [(r.first_id, r.second_id) for r in E.lead_pairs(e, "run", ["n"], F.col("kind") == "q", F.col("kind") == "a", "n", True).collect()] == [(1, 2)]


def test_tool_proposals(spark):
    texts = ['<tool_call>{"name": "f", "arguments": {"a": 1}}</tool_call>', '```json\n{"tool": "g", "args": {}}\n```', '{"function": {"name": "h", "arguments": {}}}', "words"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(E.tool_proposal(F.col("t"))).collect()]
    assert [g and g.name for g in got] == ["f", "g", "h", None] and got[0].arguments == '{"a":1}'


def tiny_lot(spark):
    ingots = spark.createDataFrame([(f"i{k}", f"{k:064x}", f"g{k % 3}", None, False) for k in range(9)], "ingot_id string, ingot_sha256 string, split_group_id string, proposed_role string, eval_eligible boolean")
    dec = L.decide(ingots, F.lit("INCLUDE"), F.expr("cast(array() as array<string>)"), "0" * 64, "1" * 64)
    rows = L.assign_split(dec).withColumn("messages", F.array(F.struct(F.lit("user").alias("role"))))
    mapped = L.row_map(rows, ["ingot_id"], ["ingot_id", "split"])
    data = mapped.select("split", "row_index", "row_sha256", "ingot_id").join(rows.select("ingot_id", "split_group_id", "messages"), "ingot_id")
    return mapped, data, ingots, dec


def test_lot_passes_and_tampering_is_seen(spark):
    mapped, data, ingots, dec = tiny_lot(spark)
    res = L.verify_lot(spark, mapped, data, ingots, dec)
    assert res.where("not ok").count() == 0 and suite.lot_status(res, ["row_hashes_match"]) == "PASS"
    bad = L.verify_lot(spark, mapped.withColumn("row_sha256", F.when(F.col("ingot_id") == "i4", "0").otherwise(F.col("row_sha256"))), data, ingots, dec)
    assert [r.check for r in bad.where("not ok").collect()] == ["row_hashes_match"] and suite.lot_status(bad, ["row_hashes_match"]) == "FAIL"
    less = L.verify_lot(spark, mapped, data, ingots, dec.where("ingot_id <> 'i4'"))
    assert {r.check for r in less.where("not ok").collect()} == {"decisions_match", "sources_included", "every_source_decided"} and suite.lot_status(less, ["row_hashes_match"]) == "HOLD"
    held = data.withColumn("split", F.when(F.col("ingot_id") == "i0", "eval").otherwise(F.col("split")))
    assert "no_group_leaks" in {r.check for r in L.verify_lot(spark, mapped, held, ingots, dec).where("not ok").collect()}
    assert {r.check for r in L.verify_lot(spark, mapped, data, ingots, dec, minimum=100, roles=("tool",)).where("not ok").collect()} == {"enough_training_rows", "role_tool_present"}


def test_vault(spark, tmp_path):
    lot = tmp_path / "lot"
    (lot / "dataset").mkdir(parents=True)
    (lot / "dataset/train.jsonl").write_text('{"a":1}\n')
    digest = L.seal_lot(str(lot), {"product": "p"})
    assert L.checksums(spark, str(lot)).first().ok
    results = spark.createDataFrame([(c, c != "places_unique", "") for c in REQUIRED_CHECKS], suite.CHECK)
    assert report_gaps(results, spark) == ["places_unique"]
    v = Vault(str(tmp_path / "vault"), lambda: "2020-01-01T00:00:00Z")
    good = {"status": "PASS", "lot_sha256": digest, "gaps": []}
    for bad in ({**good, "status": "HOLD"}, {**good, "lot_sha256": "0"}, {**good, "gaps": ["x"]}):
        with pytest.raises(VaultError):
            v.admit(str(lot), "p", "1.0.0", bad, "LICENSED")
    first = v.admit(str(lot), "p", "1.0.0", good, "LICENSED")
    assert v.admit(str(lot), "p", "1.0.0", good, "LICENSED") == first and len(v.rows()) == 1
    (lot / "dataset/train.jsonl").write_text('{"a":2}\n')
    other = L.seal_lot(str(lot), {"product": "p"})
    with pytest.raises(VaultError):
        v.admit(str(lot), "p", "1.0.0", {**good, "lot_sha256": other}, "LICENSED")
    v.withdraw("p", "1.0.0", "recalled")
    assert v.inspect(spark).first().action == "withdraw" and v.ledger(spark).count() == 2
    with pytest.raises(VaultError):
        v.publish("p")
    (lot / "dataset/train.jsonl").write_text("tampered")
    assert not L.checksums(spark, str(lot)).first().ok


def receipt(key):
    r = {"schema_version": "1.2.0", "status": "PASS", "issuer": {"issuer_id": "lab", "authentication": {"method": "hmac", "tag": ""}}, "source": {"bundle_hash": "b", "manifest_hash": "m"}, "evaluation_pack": {"pack_id": "p", "pack_version": "1", "pack_hash": "h", "check_count": 2}, "evaluation": {"checks": [{"check_id": "a", "status": "PASS"}, {"check_id": "b", "status": "PASS"}], "counts": {"PASS": 2}}}
    r["issuer"]["authentication"]["tag"] = R.authentication_tag(r, key)
    return r | {"receipt_hash": R.receipt_hash(r)}


def test_receipt_gates():
    policy, bundle = R.TrustPolicy({"lab": b"k"}, frozenset({("p", "1", "h")})), {"bundle_hash": "b", "manifest_hash": "m"}
    assert R.verify_receipt(receipt(b"k"), bundle, policy) == "PASS"
    for gate, r, b in (("issuer", receipt(b"forged"), bundle), ("bundle", receipt(b"k"), {"bundle_hash": "b"}), ("hash", receipt(b"k") | {"status": "HOLD"}, bundle), ("version", receipt(b"k") | {"schema_version": "2.0.0"}, bundle)):
        with pytest.raises(R.GateError, match=gate):
            R.verify_receipt(r, b, policy)


def test_molds(spark):
    mold = R.Mold("m", {"kind": ("x",)}, {"n": 2}, {"id": "rec-"}, ("tags",))
    rows = ['{"kind":"x","n":3,"id":"rec-1","tags":["b","a"]}', '{"kind":"x","n":3,"id":"rec-1","tags":["b","a"]}', '{"kind":"y","n":1,"id":"q"}', "no"]
    got = R.cast_records(spark.createDataFrame([(r,) for r in rows], "json string"), mold).collect()
    assert got[0].ready and got[0].core_sha256 == got[1].core_sha256 and list(got[2].failed_gates) == ["allowed:kind", "minimum:n", "prefix:id"] and "json" in got[3].failed_gates


def test_telemetry(spark):
    e = spark.createDataFrame([(1, 0, "a", "x"), (1, 1, "b", "")], "run_id int, index int, event_type string, payload string")
    rows = R.telemetry(e)
    assert "payload" not in rows.columns and R.verify_telemetry(rows, e).count() == 0
    assert R.verify_telemetry(rows, e.withColumn("payload", F.lit("y"))).count() == 2
    with pytest.raises(R.GateError):
        R.portable(e.withColumn("content", F.lit("x")), ["content"])


def test_stream(spark, tmp_path):
    spark.createDataFrame([("bob@example.com",)], "text string").write.parquet(str(tmp_path / "in"))
    q = scrub(spark.readStream.schema("text string").parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("scrubbed").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("scrubbed").first().clean_text == "[REDACTED:EMAIL]"
