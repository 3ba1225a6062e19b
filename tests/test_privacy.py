import json

import pytest
from pyspark.sql import functions as F

from quillforge.functions import license as L
from quillforge.functions import pii as P
from quillforge.operators import sanitize as S

CASES = [
    ("mail bob@example.com now", "EMAIL", "mail [REDACTED:EMAIL] now"),
    ("call +1 (555) 123-4567", "PHONE", "call [REDACTED:PHONE]"),
    ("at 10.0.0.255!", "IP_ADDRESS", "at [REDACTED:IP_ADDRESS]!"),
    ('password = "hunter22"', "PASSWORD", 'password = "[REDACTED:PASSWORD]"'),
    ("AKIA" + "ABCDEFGH12345678", "API_KEY", "[REDACTED:API_KEY]"),
    ("id 123-45-6789", "SSN", "id [REDACTED:SSN]"),
    ("see /home/ann/x.y/z now", "PATH", "see [REDACTED:PATH] now"),
    ("ABIA" + "ABCDEFGH12345678", "API_KEY", "[REDACTED:API_KEY]"),
    ("github_pat_" + "A1b2_" * 9, "API_KEY", "[REDACTED:API_KEY]"),
    ("db_pass: hunter22", "PASSWORD", "db_pass: [REDACTED:PASSWORD]"),
    ("on ::1 and", "IP_ADDRESS", "on [REDACTED:IP_ADDRESS] and"),
    ("on fe80::1 and", "IP_ADDRESS", "on [REDACTED:IP_ADDRESS] and"),
    ("on 2001:db8::8a2e:370:7334 and", "IP_ADDRESS", "on [REDACTED:IP_ADDRESS] and"),
    ("Author: Ada Byron", "NAME", "Author: [REDACTED:NAME]"),
    ("Dr. Ada Byron came", "NAME", "[REDACTED:NAME] came"),
    ('token = "' + "0af3" * 10 + '"', "SECRET", 'token = "[REDACTED:SECRET]"'),
    ("😀é bob@example.com", "EMAIL", "😀é [REDACTED:EMAIL]"),
]


def rows(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_rules(spark):
    got = {r.doc_id: r for r in S.sanitise(rows(spark, *[c[0] for c in CASES], None, "nothing")).collect()}
    for i, (_, category, clean) in enumerate(CASES):
        assert got[i].clean_text == clean, got[i]
        assert [f.category for f in got[i].applied] == [category] and got[i].is_clean
    assert got[len(CASES)].clean_text == "" and got[len(CASES) + 1].applied == []


def test_columns_and_trees_agree(spark):
    got = {r.doc_id: r.clean_text for r in S.sanitise(rows(spark, *[c[0] for c in CASES])).collect()}
    for i, (text, _, _) in enumerate(CASES):
        assert S.redact_tree(text)[0] == got[i]


def test_earliest_start_then_longest(spark):
    text = "key sk-" + "a1B2" * 6 + " and api_key=sk-" + "Zz09" * 6
    r = S.sanitise(rows(spark, text)).first()
    assert r.clean_text == "key [REDACTED:API_KEY] and api_key=[REDACTED:API_KEY]"
    assert all(a.end <= b.start for a, b in zip(r.applied, r.applied[1:]))


def test_idempotent(spark):
    once = S.sanitise(rows(spark, *[c[0] for c in CASES])).select("doc_id", F.col("clean_text").alias("text"))
    again = S.sanitise(once).where("clean_text <> text")
    assert again.count() == 0


def test_own_home(spark):
    r = rows(spark, "/home/me/a /home/me2/b").select(P.own_home(F.col("text"), "/home/me")).first()[0]
    assert r == "/workspace/a /home/me2/b"


def test_phrases(spark):
    out = S.sanitise(rows(spark, "Project  Blue\nSky ends"), rules=(P.phrase_rule("project blue sky"),)).first()
    assert out.clean_text == "[REDACTED:PHRASE] ends"


@pytest.mark.parametrize("raw", ["{", '{"a":1,"a":2}', '{"a":NaN}', "[" * 200 + "]" * 200, '{"bob@example.com":1,"eve@example.com":2}'])
def test_trees_that_are_refused(spark, raw):
    r = S.release_rows(spark.createDataFrame([(raw,)], "json string")).first()
    assert r.error and not r.released


def test_tree_release(spark):
    raw = json.dumps({"a": ["bob@example.com", 3], "b": {"k": None}})
    r = S.release_rows(spark.createDataFrame([(raw,), ('{"a": 1}',)], "json string")).collect()
    assert r[0].released and r[0].n_findings == 1 and json.loads(r[0].clean_json)["a"][0] == "[REDACTED:EMAIL]"
    assert r[1].released and r[1].n_findings == 0


def test_entropy(spark):
    toks = S.entropy_findings(rows(spark, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "Xk29fLq0Zr81TbWn47VdMs53Hy", "word " * 9), "doc_id").collect()
    assert [t.doc_id for t in toks] == [1]


def test_receipts_bind_rules_and_output(spark):
    a, b = (S.receipts(S.sanitise(rows(spark, t)), "doc_id").first() for t in ("bob@example.com", "eve@example.com"))
    assert a.output_sha256 == b.output_sha256 and a.input_sha256 != b.input_sha256 and a.ruleset_sha256 == S.ruleset_digest()


@pytest.mark.parametrize("value,category", [("mit", "PERMISSIVE"), (" Apache 2.0 ".replace(" 2.0", "_2.0"), "PERMISSIVE"), ("GPL-3.0-only", "COPYLEFT"), ("CC-BY-NC-4.0", "PROPRIETARY"), ("odd", "UNKNOWN"), (None, "UNKNOWN")])
def test_identifiers(spark, value, category):
    assert spark.createDataFrame([(value,)], "v string").select(L.classify_identifier(F.col("v"))).first()[0] == category


def test_license_texts(spark):
    texts = ["SPDX-License-Identifier: MIT\nx", "The MIT License. Permission is hereby granted, free of charge", "All rights reserved. MIT License", "prose"]
    got = [tuple(r[0]) for r in rows(spark, *texts).select(L.classify_text(F.col("text"))).collect()]
    assert got == [("MIT", "PERMISSIVE", 1.0), ("MIT", "PERMISSIVE", 0.95), ("PROPRIETARY", "PROPRIETARY", 0.95), ("UNKNOWN", "UNKNOWN", 0.0)]


def test_metadata(spark):
    v = ['"MIT"', '{"type": "GPL-2.0"}', '["MIT", "ISC"]', '["MIT", "GPL-2.0"]', "7x"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in v], "v string").select(L.classify_metadata(F.col("v"))).collect()]
    assert got == ["PERMISSIVE", "COPYLEFT", "PERMISSIVE", "COPYLEFT", "UNKNOWN"]
