"""Text, hash and JSON columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A token is a run of ASCII word characters or one character that is neither a letter, a digit nor white space, in any script.
TOKEN = r"[A-Za-z0-9_]+|[^\p{L}\p{N}_\s\p{Z}\x0B\x1C-\x1F\x{85}]"
NGRAM = 13


def tokens(text: Column) -> Column:
    """Lower-cased tokens; letters beyond ASCII are dropped and split tokens. Null gives none."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)), F.lower)


def bound(value: Column, f) -> Column:
    """``f(value)`` with the value made once a row, also where the optimizer moves its expression into f's own lambdas."""
    return F.element_at(F.transform(F.array(value), f), 1)


def ngram_count(toks: Column, n: int = NGRAM) -> Column:
    return F.greatest(F.size(toks) - (n - 1), F.lit(0))


def ngrams(toks: Column, n: int = NGRAM, key=None) -> Column:
    """``key`` of each run of n tokens, the run joined by spaces unless another is asked for."""
    key = key or (lambda run: F.array_join(run, " "))

    def runs(t):
        last = F.size(t) - (n - 1)
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: key(F.slice(t, i, n)))).otherwise(F.expr("array()"))

    return bound(toks, runs)


def run_hash(run: Column) -> Column:
    """128 bits of a token run: two seeds of a 64-bit hash. Equal runs only, but for a chance of 2^-128 a pair."""
    return F.struct(F.xxhash64(run).alias("a"), F.xxhash64(F.lit(1), run).alias("b"))


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+", " "))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def leading_bits(text: Column, digits: int = 15) -> Column:
    """The first hex digits of a text's SHA-256 as a number; 15 digits fit a signed 64-bit one."""
    return F.conv(F.substring(sha256(text), 1, digits), 16, 10).cast("long")


def whitespace_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def token_estimate(text: Column) -> Column:
    """The greater of the words and a quarter of the characters, rounded up."""
    return F.greatest(whitespace_words(text), F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4)).cast("long")


def first_truthy(*cols: Column) -> Column:
    """The first text that is neither null nor empty; null if there is none."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def shannon_entropy(text: Column) -> Column:
    """Bits a character."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.length(text)
    share = lambda c: F.size(F.filter(chars, lambda d: d == c)) / n
    return F.when(n > 0, F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))).otherwise(0.0)


def character_classes(text: Column) -> Column:
    """How many of lower, upper, digit and other characters a text has."""
    return sum((text.rlike(p).cast("int") for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")), F.lit(0))


def is_sha256(value: Column) -> Column:
    """64 lower-case hex digits; null is not."""
    return F.coalesce(value.rlike("^[0-9a-f]{64}$"), F.lit(False))


def version_parts(value: Column) -> Column:
    """(major, minor, patch) of ``N.N.N``, or null."""
    part = lambda k: F.regexp_extract(value, r"^(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)$", k)
    return F.when(part(1) != "", F.struct(part(1).cast("int").alias("major"), part(2).cast("int").alias("minor"), part(3).cast("int").alias("patch")))


def canonical_json(json_text: Column) -> Column:
    """Sorted keys and no white space; null where the text is no JSON."""
    return F.to_json(F.try_parse_json(json_text))
