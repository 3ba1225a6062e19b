"""Secret scan, in DataFrame operations only: fixed shapes, and two character Markov models.

One model is of random strings, one of ordinary identifiers; both are bigram models trained from labelled
samples. A token that no fixed shape covers is reported where the mean log-likelihood ratio of its characters
says that it is random. The training runs as a query as well; only its table of ratios, of fixed size, comes
to the driver.

Defined results: a null text counts as empty, and has no spans; offsets count code points, ends are exclusive;
equal rows get equal results, one each; an empty table gives no rows. Texts are scanned whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import as_struct

#: kind, pattern, what a match must have (in terms of the match m). Matches are leftmost and do not overlap within a kind.
#: Runs are taken whole, so a least length in the pattern is the same as dropping short runs, but for the first kind.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")
#: Tokens that the models judge: long runs with a digit and a letter. Threshold: nats a character.
TOKEN, MIN_MEAN_LLR = r"[A-Za-z0-9+/_=-]{20,}", 0.2
#: A character of no text, at most, that stands for those of a span; matches whose places are summed at a time.
FILL, CHUNK = "\ue000", 256
TOKEN_OR_FILL = rf"[A-Za-z0-9+/_=\-{FILL}]{{20,}}"

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_SIZE = len(ALPHABET) + 1  # and the start of a token
#: Words of which the built-in samples of identifiers are made.
IDENTIFIER_WORDS = ("get set user name value index count list item file path read write open close data table column row key hash map node tree graph "
                    "page link image style script test config option default result error message event handler request response server client session cache buffer stream "
                    "time date year month version update delete insert select where order group limit offset total size width height color").split()  # fmt: skip


def labelled_samples(spark: SparkSession, n: int = 1500, first: int = 0) -> DataFrame:
    """(token, random): built-in samples, n of each label; other ranges of ``first`` give other samples."""
    words = F.array(*[F.lit(w) for w in IDENTIFIER_WORDS])
    pick = lambda k: F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(IDENTIFIER_WORDS))) + 1).cast("int"))
    mod = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    ids = spark.range(first, first + n)
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    secret = F.when(mod(8, 3) == 0, digest).otherwise(F.base64(F.unhex(digest)))
    parts = F.slice(F.array(*[pick(k) for k in range(6)]), 1, (3 + mod(9, 4)).cast("int"))
    number = F.when(mod(11, 2) == 0, (mod(12, 3000)).cast("string")).otherwise(F.lit(""))
    style = mod(10, 4)
    name = F.when(style == 0, F.array_join(parts, "_")).when(style == 1, F.array_join(F.transform(parts, F.initcap), "")).when(style == 2, F.array_join(parts, "-")).otherwise(F.array_join(parts, "/"))
    return ids.select(secret.alias("token"), F.lit(True).alias("random")).unionByName(ids.select(F.concat(name, number).alias("token"), F.lit(False).alias("random")))


def train(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of each pair of characters, random over ordinary, with one added to every count: _SIZE x _SIZE values."""
    place = lambda c: F.position(c, F.lit(ALPHABET))
    chars = samples.where("token is not null and random is not null").select("random", F.split(F.concat(F.lit("\n"), "token"), "").alias("c"))
    pairs = chars.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.struct(F.col("c")[i - 1].alias("a"), F.col("c")[i].alias("b")))).alias("p"))
    counts = pairs.where("p.b <> ''").groupBy("random", place(F.col("p.a")).alias("a"), place(F.col("p.b")).alias("b")).count()
    table = {True: [[1.0] * _SIZE for _ in range(_SIZE)], False: [[1.0] * _SIZE for _ in range(_SIZE)]}
    for r in counts.collect():  # at most 2 x _SIZE x _SIZE rows, whatever the samples
        table[r["random"]][r["a"]][r["b"]] += r["count"]
    share = {k: [[x / sum(row) for x in row] for row in t] for k, t in table.items()}
    return [math.log(p / q) for a, b in zip(share[True], share[False]) for p, q in zip(a, b)]


def mean_llr(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's characters."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    place = F.transform(F.split(F.concat(F.lit("\n"), token), ""), lambda c: F.when(c == "", 0).otherwise(F.position(c, F.lit(ALPHABET))))
    total = lambda p: F.aggregate(F.sequence(F.lit(1), F.length(token)), F.lit(0.0), lambda acc, i: acc + F.element_at(table, F.element_at(p, i) * _SIZE + F.element_at(p, i + 1) + 1))
    # the places are bound once, by a lambda over an array of one
    return F.element_at(F.transform(F.array(place), total), 1) / F.length(token)


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once: a lambda over an array of one binds it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _spans(text: Column, found: Column, pattern: str, kind: str) -> Column:
    """start, end and text of each match: what lies between matches, and the matches, laid end to end. Places are summed in pieces of CHUNK
    matches, each of which starts where the pieces before it end, so that no list of all matches is copied for each of them."""
    n, none = KINDS.index(kind), F.expr("cast(array() as array<struct<s:int,k:int,e:int,m:string>>)")
    length = lambda p: F.length(p["g"]) + F.length(p["m"])

    def step(acc, p):
        s = acc["at"] + F.length(p["g"])
        e = s + F.length(p["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), F.lit(n).alias("k"), e.alias("e"), p["m"].alias("m")))).alias("out"))

    def placed(pairs):
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int")), lambda i: F.slice(pairs, i * CHUNK + 1, CHUNK))
        sums = lambda ps: F.transform(ps, lambda p: F.aggregate(p, F.lit(0), lambda acc, x: acc + length(x)))
        starts = lambda ps: F.aggregate(sums(ps), F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        laid = lambda ps: F.flatten(F.transform(F.arrays_zip(ps.alias("p"), F.slice(starts(ps), 1, F.size(ps)).alias("at")), lambda z: F.aggregate(z["p"], F.struct(z["at"].alias("at"), none.alias("out")), step, lambda acc: acc["out"])))
        return _bound(pieces, laid)

    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), found.alias("m"))
    return F.when(F.size(found) == 0, none).otherwise(_bound(pairs, placed))


def _blanked(text: Column, pattern: str, valid=lambda m: F.lit(True)) -> Column:
    """``text`` with FILL for each character of the matches that are valid: the same length, in one pass."""
    found = _matches(text, pattern)
    piece = lambda g, m: F.concat(g, F.when(valid(m), F.repeat(F.lit(FILL), F.length(m))).otherwise(m))
    blank = F.array_join(F.zip_with(F.split(text, pattern, -1), F.concat(found, F.array(F.lit(""))), piece), "")
    return F.when(F.size(found) == 0, text).otherwise(blank)


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _is_assigned(m: Column) -> Column:
    return F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8


def _without_shapes() -> list:
    """What to make of a text in turn: FILL goes, then the fixed shapes become FILL. An assignment's name may end an access key; what stands before it goes too."""
    rest = rf"{ACCESS}|AKIA[A-Z0-9]*(?={FILL})"
    return [lambda t: F.translate(t, FILL, " "), lambda t: _blanked(t, ASSIGN, _is_assigned), lambda t: _blanked(t, rest), lambda t: _blanked(t, HEX)]


def _is_random(m: Column, ratios: list[float], min_mean_llr: float) -> Column:
    return ~m.contains(FILL) & m.rlike("[0-9]") & m.rlike("[A-Za-z]") & F.when(~m.contains(FILL), mean_llr(m, ratios) >= min_mean_llr).otherwise(False)


def _plain(found: DataFrame) -> DataFrame:
    """With ``_plain``, the text without its fixed shapes: a token that touches one holds FILL there."""
    out = found.withColumn("_plain", F.coalesce(F.col("text"), F.lit("")))
    for f in _without_shapes():
        out = out.withColumn("_plain", f(F.col("_plain")))
    return out


def scan_secrets(docs: DataFrame, ratios: list[float] | None = None, min_mean_llr: float = MIN_MEAN_LLR) -> DataFrame:
    """``docs`` with ``_base`` and ``_markov``: arrays of the spans (s, k, e, m) of the fixed shapes and of the models."""
    ratios = ratios or train(labelled_samples(docs.sparkSession))
    text = F.coalesce(F.col("text"), F.lit(""))
    found = _plain(docs).withColumns({"_a": _matches(text, ASSIGN), "_x": _matches(text, ACCESS), "_h": _matches(text, HEX), "_t": _matches(F.col("_plain"), TOKEN_OR_FILL)})
    spans = found.withColumns({f"_{c}s": _spans(t, F.col(f"_{c}"), p, k) for c, t, p, k in (("a", text, ASSIGN, "assign"), ("x", text, ACCESS, "access"), ("h", text, HEX, "hex"), ("t", F.col("_plain"), TOKEN_OR_FILL, "markov"))})
    base = spans.withColumn("_base", F.array_sort(F.concat(F.filter("_as", lambda x: _is_assigned(x["m"])), F.col("_xs"), F.col("_hs"))))
    judged = base.withColumn("_markov", F.filter("_ts", lambda t: _is_random(t["m"], ratios, min_mean_llr)))
    return judged.drop("_a", "_x", "_h", "_t", "_as", "_xs", "_hs", "_ts", "_plain")


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, counts of the fixed shapes, their digest, and all spans as ``kind:start:end``, comma-joined, by start, then kind."""
    s = scan_secrets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), **options)
    n = lambda k: F.size(F.filter("_base", lambda x: x["k"] == k)).cast("long")
    return s.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"), _listed(F.array_sort(F.concat("_base", "_markov"))).alias("spans"), F.size("_markov").cast("long").alias("n_markov"))


def redact_secrets(docs: DataFrame, ratios: list[float] | None = None, min_mean_llr: float = MIN_MEAN_LLR) -> DataFrame:
    """``docs``, same columns, with every span in the text replaced by ``[SECRET]``; spans that overlap or touch become one. A text with a span
    has a space where FILL stood."""
    ratios = ratios or train(labelled_samples(docs.sparkSession))
    s = _plain(docs.select(as_struct(docs).alias("doc"), "text"))
    s = s.withColumn("_plain", _blanked(F.col("_plain"), TOKEN_OR_FILL, lambda m: _is_random(m, ratios, min_mean_llr)))
    text = F.when(F.col("_plain").contains(FILL), F.regexp_replace("_plain", f"{FILL}+", "[SECRET]")).otherwise(F.col("text"))
    return s.select(F.col("doc").withField("text", text).alias("doc")).select("doc.*")
