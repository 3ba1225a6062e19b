import hashlib
import json

import pytest

from quillforge.__main__ import main
from quillforge.operators import casting
from quillforge.operators.receipts import GateError, TrustPolicy
from quillforge.sources.readers import SourceError


@pytest.fixture
def bundle(tmp_path):
    root = tmp_path / "bundle"
    (root / "events").mkdir(parents=True)
    rows = [{"run_id": "r", "sequence": i, "event_type": "assistant", "payload": p} for i, p in enumerate(['{"content":"hi"}', '{"content":"mail bob@example.com"}'])]
    (root / "events/events.ndjson").write_text("".join(json.dumps(r) + "\n" for r in rows))
    (root / "run.json").write_text("{}")
    seal(root)
    return root


def seal(root):
    body = json.dumps({"files": {p: hashlib.sha256((root / p).read_bytes()).hexdigest() for p in ("run.json", "events/events.ndjson")}})
    (root / "manifest.json").write_text(body)
    (root / "manifest.sha256").write_text(hashlib.sha256(body.encode()).hexdigest() + "  manifest.json\n")


def test_cast(spark, bundle, tmp_path):
    a = casting.cast_bundle(spark, str(bundle), str(tmp_path / "a"))
    b = casting.cast_bundle(spark, str(bundle), str(tmp_path / "b"), clock=lambda: "later")
    assert a == b and a["disposition"] == "PASSED" and (a["findings"], a["severe_findings"], a["n_events"]) == (1, 0, 2)
    assert "bob@" not in "".join(r.value for r in spark.read.text(str(tmp_path / "a/events")).collect())
    with pytest.raises(GateError):
        casting.cast_bundle(spark, str(bundle), str(tmp_path / "a"))
    assert casting.cast_bundle(spark, str(bundle), str(tmp_path / "c"), imported=True)["disposition"] == "HOLD"


def test_severe_findings_quarantine(spark, bundle, tmp_path):
    with (bundle / "events/events.ndjson").open("a") as f:
        f.write(json.dumps({"run_id": "r", "sequence": 2, "event_type": "tool", "payload": 'password = "hunter22"'}) + "\n")
    seal(bundle)
    assert casting.cast_bundle(spark, str(bundle), str(tmp_path / "a"))["disposition"] == "QUARANTINED"


def test_gates_come_before_writes(spark, bundle, tmp_path):
    with pytest.raises(GateError):
        casting.cast_bundle(spark, str(bundle), str(tmp_path / "a"), policy=TrustPolicy({}, frozenset()))
    (bundle / "manifest.json").write_text('{"a":2}')
    with pytest.raises(SourceError):
        casting.cast_bundle(spark, str(bundle), str(tmp_path / "a"))
    assert not (tmp_path / "a").exists() and main(["cast", str(bundle), str(tmp_path / "a")]) == 3


@pytest.mark.parametrize("files,category", [({"LICENSE": "MIT License. Permission is hereby granted, free of charge", "a.py": "# SPDX-License-Identifier: MIT"}, "PERMISSIVE"), ({"package.json": '{"license": "MIT"}', "b.py": "# SPDX-License-Identifier: GPL-3.0"}, "COPYLEFT"), ({"pyproject.toml": '[project]\nlicense = "Apache-2.0"\n'}, "PERMISSIVE"), ({"a.txt": "words"}, "UNKNOWN")])
def test_repository(spark, tmp_path, files, category):
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    assert casting.audit_repository(spark, str(tmp_path))[0] == category


def test_altered_events_are_refused(spark, bundle, tmp_path):
    with (bundle / "events/events.ndjson").open("a") as f:
        f.write("{}\n")
    with pytest.raises(SourceError, match="altered: events"):
        casting.cast_bundle(spark, str(bundle), str(tmp_path / "x"))
    (bundle / "manifest.json").write_text("{}")
    (bundle / "manifest.sha256").write_text(hashlib.sha256(b"{}").hexdigest())
    with pytest.raises(SourceError, match="does not list"):
        casting.cast_bundle(spark, str(bundle), str(tmp_path / "x"))
