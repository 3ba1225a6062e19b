import json

import pytest

from quillforge.operators import release as R
from quillforge.operators import sanitize as S
from quillforge.operators.lot import canonical

KEY = "Zq8vX2mK9pL4tR7wB3nJ6yH1cF5dG0sAeUi"


def test_row_and_receipt():
    clean, receipt = R.release_row('{"note":"write to bob@example.com","n":[1,"x"],"key":"' + KEY + '"}', "r1")
    assert "bob@" not in clean and KEY not in clean and receipt["findings_by_category"] == {"EMAIL": 1, "HIGH_ENTROPY": 1}
    assert receipt["coverage"]["input"]["keys"] == 3 and receipt["coverage"]["input"]["values"] == 3
    assert R.verify_row(receipt, clean, "r1") == (R.CURRENT, [])
    same, plain = R.release_row('{"a":"fine","file_sha256":"' + "0123456789abcdef" * 4 + '"}', "r2")
    assert plain["status"] == "PASS_SCANNED" and not plain["changed"] and R.verify_row(plain, same, "r2")[0] == R.CURRENT


@pytest.mark.parametrize("raw", ['{"a":1,"a":2}', "[1]", '{"a":NaN}', "no", '{"a@example.com":1,"b@example.com":2}', ""])
def test_rows_that_are_refused(raw):
    with pytest.raises(S.TreeError):
        R.release_row(raw, "r")


def resealed(receipt, **changes):
    body = {k: v for k, v in (receipt | changes).items() if k != "receipt_sha256" and v is not None}
    return body | {"receipt_sha256": R._sha(body)}


def test_tampering_is_seen():
    clean, receipt = R.release_row('{"note":"write to bob@example.com"}', "r1")
    cases = {"the row is another one": (receipt, '{"note":"other"}', "r1"), "the record is another one": (receipt, clean, "r9"), "the receipt's own digest differs": (receipt | {"status": "PASS_SCANNED"}, clean, "r1"), "unknown policy": (resealed(receipt, policy="x"), clean, "r1"),
             "counts of findings do not add up": (resealed(receipt, n_findings=2), clean, "r1"), "residual findings": (resealed(receipt, n_residual=1), clean, "r1"), "other rules": (resealed(receipt, ruleset_sha256="0" * 64), clean, "r1"), "1 unknown fields": (resealed(receipt, more=1), clean, "r1"),
             "coverage of the row differs": (resealed(receipt, coverage={"input": {}, "output": {}}), clean, "r1"), "status does not fit the change": (resealed(receipt, status="PASS_SCANNED"), clean, "r1"), "missing: n_residual": (resealed(receipt, n_residual=None), clean, "r1")}
    for problem, args in cases.items():
        status, problems = R.verify_row(*args)
        assert status == R.INVALID and problem in problems, problem
    dirty = '{"note":"bob@example.com"}'
    assert "the row has findings" in R.verify_row(resealed(receipt, output_sha256=R._sha(json.loads(dirty))), dirty, "r1")[1]


def test_old_policy_is_integrity_only():
    clean, receipt = R.release_row('{"a":"b"}', "r1")
    assert R.verify_row(resealed(receipt, policy=R.OLD_POLICY, coverage=None), clean, "r1") == (R.INTEGRITY_ONLY, [])


def test_tables(spark):
    df = spark.createDataFrame([("a", '{"m":"bob@example.com"}'), ("b", '{"m":"fine"}'), ("c", None), ("d", "{")], "id string, json string")
    out = R.release(df, "id")
    assert {r.id: r.error is None for r in out.collect()} == {"a": True, "b": True, "c": False, "d": False}
    assert {r.id: r.status for r in R.verify(out, "id").collect()} == {"a": "CURRENT", "b": "CURRENT", "c": "INVALID", "d": "INVALID"}
    total = R.coverage(df).first()
    assert (total["keys"], total["values"], total["bytes"], total["n_refused"]) == (2, 2, 21, 2) and total["keys_scanned"] == 2 and total["bytes_scanned"] == 21
    assert R.coverage(df.limit(0)).first()["keys"] == 0 and R.release(df.limit(0), "id").count() == 0


def test_file_with_receipt(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"a":"bob@example.com"}\n\nplain line\n')
    body = R.scrub_file(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"))
    assert body["is_clean"] and body["findings_by_category"] == {"EMAIL": 1} and body["input_file"] == "in.jsonl"
    written = json.loads((tmp_path / "out.receipt.json").read_text())
    assert written["receipt_sha256"] == R._sha({k: v for k, v in body.items() if k != "receipt_sha256"}) and str(tmp_path) not in canonical(written)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["", "plain line", '{"a":"[REDACTED:EMAIL]"}']
