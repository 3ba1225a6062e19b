"""Licence identifiers and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SPDX identifiers by category, and common spellings.
PERMISSIVE = ("MIT", "APACHE-2.0", "BSD-2-CLAUSE", "BSD-3-CLAUSE", "ISC", "ZLIB", "UNLICENSE", "CC0-1.0", "CC-BY-4.0", "0BSD", "BSL-1.0", "PYTHON-2.0", "POSTGRESQL", "MIT-0", "NCSA", "X11", "WTFPL", "APACHE-1.1", "BSD-4-CLAUSE", "CC-BY-3.0")
COPYLEFT_PREFIXES = ("GPL", "LGPL", "AGPL", "MPL", "EPL", "CC-BY-SA")
COPYLEFT = ("EUPL-1.2", "CDDL-1.0", "OSL-3.0", "SSPL-1.0")
ALIASES = {"APACHE": "APACHE-2.0", "APACHE2": "APACHE-2.0", "APACHE-2": "APACHE-2.0", "APACHE-LICENSE-2.0": "APACHE-2.0", "APACHE-LICENSE,-VERSION-2.0": "APACHE-2.0", "BSD": "BSD-3-CLAUSE", "NEW-BSD": "BSD-3-CLAUSE", "SIMPLIFIED-BSD": "BSD-2-CLAUSE", "MIT-LICENSE": "MIT", "THE-MIT-LICENSE": "MIT", "EXPAT": "MIT", "GPLV2": "GPL-2.0", "GPLV3": "GPL-3.0", "LGPLV3": "LGPL-3.0", "AGPLV3": "AGPL-3.0", "CC0": "CC0-1.0", "PUBLIC-DOMAIN": "UNLICENSE", "PSF": "PYTHON-2.0"}
PROPRIETARY = r"(?i)all rights reserved|proprietary|confidential|no license|commercial use (?:only|prohibited)|not for redistribution"
#: Phrases by licence, in order; the licence of most phrases wins, the first of equals.
SIGNATURES = (
    ("MIT", (r"(?i)mit license", r"(?i)permission is hereby granted, free of charge")),
    ("APACHE-2.0", (r"(?i)apache license", r"(?i)version 2\.0, january 2004|licensed under the apache license")),
    ("BSD-3-CLAUSE", (r"(?i)redistribution and use in source and binary forms", r"(?i)neither the name of")),
    ("GPL-3.0", (r"(?i)gnu general public license|gnu gpl", r"(?i)version 3, 29 june 2007")),
    ("LGPL-3.0", (r"(?i)gnu lesser general public license", r"(?i)lesser general public")),
    ("AGPL-3.0", (r"(?i)gnu affero general public license", r"(?i)affero")),
    ("MPL-2.0", (r"(?i)mozilla public license", r"(?i)mpl[, ]+version 2")),
    ("EPL-2.0", (r"(?i)eclipse public license", r"(?i)epl-2\.0")),
    ("CC-BY-NC-4.0", (r"(?i)cc[ -]by[ -]nc", r"(?i)attribution-noncommercial")),
    ("CC0-1.0", (r"(?i)cc0 1\.0", r"(?i)no copyright")),
    ("UNLICENSE", (r"(?i)free and unencumbered software released into the public domain", r"(?i)unlicense")),
)


def normalise(value: Column) -> Column:
    """Trimmed, upper case, spaces and underscores as dashes, aliases resolved."""
    flat = F.regexp_replace(F.upper(F.trim(F.coalesce(value, F.lit("")))), "[ _]+", "-")
    known = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    return F.coalesce(F.element_at(known, flat), flat)


def classify_identifier(value: Column) -> Column:
    """PERMISSIVE, COPYLEFT, PROPRIETARY or UNKNOWN; only the first is compliant."""
    n = normalise(value)
    copyleft = n.isin(*COPYLEFT) | n.rlike("^(?:" + "|".join(COPYLEFT_PREFIXES) + ")")
    return F.when(n.isin(*PERMISSIVE), "PERMISSIVE").when(copyleft, "COPYLEFT").when(n.rlike("-NC-|-NC$|-ND") | F.coalesce(value, F.lit("")).rlike(PROPRIETARY), "PROPRIETARY").otherwise("UNKNOWN")


def spdx_header(text: Column) -> Column:
    """The identifier of the first SPDX tag; empty without one."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"SPDX-License-Identifier:[ ]*([A-Za-z0-9.+-]+)", 1)


def classify_text(text: Column) -> Column:
    """(license_id, category, confidence): the SPDX tag, else the licence of most signature phrases, else a proprietary phrase."""
    t = F.coalesce(text, F.lit(""))
    hits = [sum((t.rlike(p).cast("int") for p in ps), F.lit(0)) for _, ps in SIGNATURES]
    best = F.array_max(F.array(*[F.struct(h.alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("id")) for k, (h, (name, _)) in enumerate(zip(hits, SIGNATURES))]))
    spdx = spdx_header(t)
    made = lambda i, c, p: F.struct(i.alias("license_id"), c.alias("category"), p.alias("confidence"))
    return (F.when(spdx != "", made(normalise(spdx), classify_identifier(spdx), F.lit(1.0)))
            .when(t.rlike(PROPRIETARY), made(F.lit("PROPRIETARY"), F.lit("PROPRIETARY"), F.lit(0.95)))
            .when(best["n"] > 0, made(best["id"], classify_identifier(best["id"]), F.when(best["n"] >= 2, 0.95).otherwise(0.8)))
            .otherwise(made(F.lit("UNKNOWN"), F.lit("UNKNOWN"), F.lit(0.0))))


def classify(value: Column) -> Column:
    """An identifier, or a text if it has several lines or over 80 characters: its category."""
    v = F.coalesce(value, F.lit(""))
    return F.when(v.contains("\n") | (F.length(v) > 80), classify_text(v)["category"]).otherwise(classify_identifier(v))


def classify_metadata(json_text: Column) -> Column:
    """The category of a metadata licence: a string, an object (type, name or identifier), or a list, all of which must be permissive."""
    v = F.try_parse_json(json_text)
    one = F.coalesce(*[F.try_variant_get(v, p, "string") for p in ("$.type", "$.name", "$.identifier")], F.try_variant_get(v, "$", "string"))
    many = F.try_variant_get(v, "$", "array<string>")
    return F.when(many.isNotNull(), F.when((F.size(many) > 0) & F.forall(many, lambda x: classify_identifier(x) == "PERMISSIVE"), "PERMISSIVE").when(F.exists(many, lambda x: classify_identifier(x) == "PROPRIETARY"), "PROPRIETARY").when(F.exists(many, lambda x: classify_identifier(x) == "COPYLEFT"), "COPYLEFT").otherwise("UNKNOWN")).otherwise(classify_identifier(one))
