"""F7, F8: a rule's own pattern is tried only on texts that can match it, and no match is lost by that."""

import random

from pyspark.sql import functions as F

from quillforge.functions import pii as P
from quillforge.operators import sanitize as S

from .test_privacy import CASES

PARTS = ["-----BEGIN RSA PRIVATE KEY-----\nab+/=\n-----END RSA PRIVATE KEY-----", "sk-live-" + "a1B2" * 6, "AROA" + "Z9" * 8, "ghp_" + "a1" * 18, "xoxb-1-a-B", "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9,
         "API-Key: '" + "q7" * 9, "Secret_Key=" + "q7" * 9, "PASSWD = hunter22", "Bearer " + "q7" * 11, "toKen:" + "q7" * 11, "x.y@a-b.co.uk", "+49 (30) 1234 5678", "(555) 123-4567", "255.1.20.3", "1:2:3:4:5:6:7:8", "a::b", "::1",
         "123-45-6789", "1234 5678 9012 3456", "1234567890123", "/Users/ann", "Prof. Ada Byron", "Signed-off-by: Ada Byron", "customer=Ada Byron"]


def table(spark):
    rng = random.Random(5)
    whole = PARTS + [c[0] for c in CASES]
    cut = lambda p: p if rng.random() < 0.5 else p[rng.randrange(len(p)) :] if rng.random() < 0.5 else p.replace(rng.choice(p), rng.choice(" :=.@+-_é\n"), 1)
    texts = whole + ["".join(cut(rng.choice(whole)) + rng.choice(["", " ", "\n", ":"]) for _ in range(rng.randrange(5))) for _ in range(600)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def test_no_match_is_lost(spark):
    plain = [F.regexp_count("text", F.lit(r.pattern)).alias(f"p{k}") for k, r in enumerate(P.RULES)]
    gated = [P.match_count(F.col("text"), r).alias(f"g{k}") for k, r in enumerate(P.RULES)]
    rows = table(spark).select("text", *plain, *gated).collect()
    n = len(P.RULES)
    assert all(row[1 : n + 1] == row[n + 1 :] for row in rows)
    assert all(any(row[k + 1] for row in rows) for k in range(n))  # each rule has matches


def test_same_redaction_as_trees(spark):
    for row in S.sanitise(table(spark)).collect():
        assert row.clean_text == S.redact_tree(row.text)[0]


def test_plain_prose_meets_few_patterns(spark):
    """Of the rules, all but those with a cheap pattern of their own leave prose alone."""
    prose = spark.createDataFrame([("Some prose, and more of it. The 12 of them came.",)], "text string")
    tried = prose.select(*[P.may_match(F.col("text"), r).alias(r.name) for r in P.RULES]).first().asDict()
    assert {k for k, v in tried.items() if v} == {"bearer", "phone_local", "ssn"}
