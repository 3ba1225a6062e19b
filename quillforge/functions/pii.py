"""Personal data and secrets: one table of rules, spans, redaction, entropy.

Patterns need no look-around and no word boundary that depends on the engine, so they mean the same in Java and RE2;
a rule may redact one group of its match only. Guards against neighbours are part of a pattern (``pre``, a class of
characters that must not stand before a match).
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, character_classes, shannon_entropy


@dataclass(frozen=True)
class Rule:
    """``group`` is what is replaced; ``severe`` findings quarantine a record. Of ``needs`` one at least is in every text that matches, and ``gate``, a
    cheap pattern, matches it: most texts have neither, and a rule's own pattern is not tried on them."""

    name: str
    category: str
    pattern: str
    group: int = 0
    severe: bool = False
    needs: tuple[str, ...] = ()
    gate: str = ""


_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_VALUE = r"""["']?[ ]*[:=][ ]*["']?"""
_ASSIGN = (":", "=")
RULES: tuple[Rule, ...] = (
    Rule("private_key_block", "PRIVATE_KEY", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----", 0, True, needs=("-----BEGIN ",)),
    Rule("vendor_key", "API_KEY", r"sk-(?:[a-z]{2,8}-)?[A-Za-z0-9_-]{20,}", 0, True, needs=("sk-",)),
    Rule("cloud_access_key", "API_KEY", r"(?:AKIA|ASIA|ABIA|ACCA|AROA|AIDA)[A-Z0-9]{16}", 0, True, needs=("AKIA", "ASIA", "ABIA", "ACCA", "AROA", "AIDA")),
    Rule("forge_token", "API_KEY", r"(?:ghp|gho|ghu|ghs|ghr|glp|github_pat)_[A-Za-z0-9_]{36,}", 0, True, needs=("_",)),
    Rule("chat_token", "API_KEY", r"xox[abprs]-[A-Za-z0-9]+-[A-Za-z0-9]+-[A-Za-z0-9-]+", 0, True, needs=("xox",)),
    Rule("json_web_token", "JWT", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, True, needs=("eyJ",)),
    Rule("key_assignment", "API_KEY", rf"(?i)(?:api|access|auth|client)[_-]?(?:key|token){_VALUE}([A-Za-z0-9+/_.=-]{{16,}})", 1, True, needs=_ASSIGN),
    Rule("secret_assignment", "SECRET", rf"(?i)secret(?:[_-]?key)?{_VALUE}([A-Za-z0-9+/_.=-]{{16,}})", 1, True, needs=_ASSIGN),
    Rule("password_assignment", "PASSWORD", rf"(?i)(?:password|passwd|pwd|db[_-]?pass){_VALUE}([^\s\"',;\[][^\s\"',;]{{5,}})", 1, True, needs=_ASSIGN),
    Rule("bearer", "CREDENTIAL", r"(?i)bearer[ ]+([A-Za-z0-9._~+/=-]{20,})", 1, True),
    Rule("generic_token", "SECRET", rf"(?i)token{_VALUE}([A-Za-z0-9+/_.=-]{{20,}})", 1, True, needs=_ASSIGN),
    Rule("email", "EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", needs=("@",)),
    Rule("phone_international", "PHONE", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}", needs=("+",)),
    Rule("phone_local", "PHONE", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}"),
    Rule("ipv4", "IP_ADDRESS", rf"{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}", gate=r"[0-9]\.[0-9]"),
    Rule("ipv6", "IP_ADDRESS", r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|::(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{1,4}\b", needs=(":",)),
    Rule("ssn", "SSN", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    Rule("card", "CREDIT_CARD", r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{13,19}", gate="[0-9]{4}"),
    Rule("home_path", "PATH", r"/(?:home|Users)/[A-Za-z0-9._-]+(?:/[A-Za-z0-9._~-]+)*", needs=("/home/", "/Users/")),
    Rule("titled_name", "NAME", r"(?:Mr|Mrs|Ms|Dr|Prof)\. [A-Z][a-z]+(?: [A-Z][a-z]+)+", needs=("Mr. ", "Mrs. ", "Ms. ", "Dr. ", "Prof. ")),
    Rule("labelled_name", "NAME", r"(?i)(?:full[ _-]?name|legal[ _-]?name|user[ _-]?name|author|contributor|developer|contact|signed-off-by|customer|patient|employee)[ ]*[:=][ ]*([A-Z][a-z]+(?: [A-Z][a-z]+)+)", 1, needs=_ASSIGN),
)
TOKENS = {r.category: f"[REDACTED:{r.category}]" for r in RULES}
#: Rows that a cast counts without rewriting them.
CAST_RULES = ("cloud_access_key", "key_assignment", "private_key_block", "email")
SPAN = "array<struct<start:int,end:int,rule:int,category:string,match:string>>"


def phrase_rule(phrase: str, category: str = "PHRASE", ignore_case: bool = True) -> Rule:
    """A rule for a registered name or phrase: any run of white space between its words."""
    import re

    body = r"\s+".join(re.escape(w) for w in phrase.split())
    return Rule(f"phrase:{phrase}", category, ("(?i)" if ignore_case else "") + body)


def may_match(text: Column, rule: Rule) -> Column:
    """Whether a rule's own pattern has to be tried: scans for fixed strings cost a tenth of it."""
    needed = [F.contains(text, F.lit(w)) for w in rule.needs]
    found = functools.reduce(lambda a, b: a | b, needed) if needed else F.lit(True)
    return found & text.rlike(rule.gate) if rule.gate else found


def match_count(text: Column, rule: Rule) -> Column:
    """How often a rule's pattern matches."""
    n = F.regexp_count(text, F.lit(rule.pattern))
    return F.when(may_match(text, rule), n).otherwise(0) if rule.needs or rule.gate else n


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """start, end (code points, end exclusive), rule, category and matched text of a rule's matches, left to right.

    Matches and what lies between them alternate, so running lengths are offsets; nothing leaves the JVM."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    none = F.expr(f"cast(array() as {SPAN})")
    pairs = F.arrays_zip(F.split(text, rule.pattern, -1).alias("g"), found.alias("m"))

    def step(acc, p):
        s = acc["at"] + F.length(p["g"])
        e = s + F.length(p["m"])
        inner = F.regexp_extract(p["m"], rule.pattern, rule.group) if rule.group else p["m"]
        lo = s + F.position(inner, p["m"]) - 1 if rule.group else s
        span = F.struct(lo.alias("start"), (lo + F.length(inner)).alias("end"), F.lit(number).alias("rule"), F.lit(rule.category).alias("category"), inner.alias("match"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    walk = F.aggregate(F.slice(pairs, 1, F.size(found)), F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(may_match(text, rule) & text.rlike(rule.pattern), walk).otherwise(none)


def all_spans(text: Column, rules=RULES) -> Column:
    """All rules' spans by (start, longest first, rule). The text is bound: rules name it some hundred times, and what makes it may itself be a scan."""
    spans = bound(text, lambda t: F.concat(*[rule_spans(t, r, k) for k, r in enumerate(rules)]))
    key = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), (s["start"] - s["end"]).alias("b"), s["rule"].alias("c"), s.alias("span")))
    return F.transform(F.array_sort(key), lambda s: s["span"])


def chosen(spans: Column) -> Column:
    """Greedy: a span counts if it starts where the last one chosen has ended, or later."""
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("out"))
    return F.aggregate(spans, start, lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(s)).alias("out"))).otherwise(acc), lambda acc: acc["out"])


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every chosen span replaced by its category's token."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("[REDACTED:"), s["category"], F.lit("]")).alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1))))


def own_home(text: Column, home: str) -> Column:
    """The configured home directory as /workspace; a longer name that starts like it is left."""
    import re

    return F.regexp_replace(text, rf"{re.escape(home.rstrip('/'))}(?=/|\s|$)", "/workspace")


#: High entropy: least length, bits a character for 64 hex digits, and for tokens of three classes of characters or more.
MIN_ENTROPY_LENGTH, MIN_HEX_BITS, MIN_BITS, MIN_CLASSES = 24, 3.5, 4.2, 3
ENTROPY_TOKEN = r"[A-Za-z0-9+/_=.-]{24,}"


def is_high_entropy(token: Column) -> Column:
    hex64 = token.rlike("^[0-9a-fA-F]{64}$")
    bits = shannon_entropy(token)
    return (F.length(token) >= MIN_ENTROPY_LENGTH) & F.when(hex64, bits >= MIN_HEX_BITS).otherwise((character_classes(token) >= MIN_CLASSES) & (bits >= MIN_BITS))
