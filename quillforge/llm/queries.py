"""The registered training-data queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import htmltext, mixing, neardup, ogg, packing, passages, quality, secrets, urlfilter, weaklabel
from .base import table

QUERIES, ORACLES = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query
def op2_wildcard_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.url_filter(table(spark, sf_dir, "pages"))


@query
def op3_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weaklabel.classify_quality(table(spark, sf_dir, "documents"))


@query
def op4_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(table(spark, sf_dir, "pages"))


@query
def op5_tensored_banding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85).drop("first", "_th", "_tl")


@query
def op6_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_power_of_two(table(spark, sf_dir, "documents"))


@query
def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.duplicate_passages(table(spark, sf_dir, "documents"))


@query
def op8_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query
def op9_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.from_ogg(ogg.to_ogg(table(spark, sf_dir, "documents")))


@query
def op10_exponential_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("_th", "_tl")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


# SQL forms ------------------------------------------------------------------------------------------------------------------------------


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _url_sql() -> str:
    """The rules by host suffix and path prefix, the globs as regular expressions."""
    import re

    ranked = sorted(urlfilter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"((host = {_lit(h)} OR ends_with(host, {_lit('.' + h)})) AND starts_with(path, {_lit(p)}))"
    case = lambda k: " ".join(f"WHEN {fits(h, p)} THEN {_lit((h + p, v)[k])}" for v, h, p in ranked)
    shape = lambda g: "".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in re.split(r"(\*\*|\*|\?)", g))
    globs = " OR ".join(f"regexp_full_match(host || path, {_lit(shape(g))})" for g in urlfilter.BLOCK_GLOBS)
    return f"""WITH a AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a)
SELECT page_id, host, path, CASE {case(0)} END AS rule, CASE {case(1)} WHEN {globs} THEN 'block' ELSE 'allow' END AS verdict FROM b"""


ORACLES["op2_wildcard_automaton"] = _url_sql()


def _quality_sql() -> str:
    """Histograms as columns, references as sums over the documents that pass the base rules, distances as sums over both."""
    q = quality
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    of = {c: [] for c in q.CLASSES}
    for byte in range(128):
        of[q.CLASSES[q.CLASS_OF[byte]]].append(byte)
    n = lambda bytes_: f"(length(t) - length(regexp_replace(t, '[{''.join(f'\\x{{{b:02x}}}' for b in bytes_)}]', '', 'g')))"
    chars = [f"(length(t) - length(regexp_replace(t, '[^\\x{{00}}-\\x{{7f}}]', '', 'g')))" if c == "wide" else n(of[c]) for c in q.CLASSES]
    common = [f"len(list_filter(lw, lambda x: x IN ({_lit(w)}, {_lit(w + ',')}, {_lit(w + '.')})))" for w in q.WORDS]
    other = f"(n_words - ({' + '.join(f'w{k}' for k in range(len(common)))}))"
    cs, ws = [f"c{k}" for k in range(len(chars))], [f"w{k}" for k in range(len(common) + 1)]
    lang = "CASE WHEN lang IN (" + ", ".join(_lit(x) for x in q.LANGS) + ") THEN lang ELSE '' END"

    def js(own, names):
        p, r = f"({{0}}::DOUBLE / {own}_n)", f"({{1}}::DOUBLE / {own}_r)"
        half = lambda a, b: " + ".join(f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({a} + {b}) / 2)) ELSE 0 END".format(f"f.{x}", f"r.{x}") for x in names)
        return f"CASE WHEN {own}_n > 0 AND {own}_r > 0 THEN sqrt(greatest(0, (({half(p, r)}) + ({half(r, p)})) / 2)) ELSE 0 END"

    total = lambda side, names: " + ".join(f"{side}.{x}" for x in names)
    return f"""WITH a AS (SELECT doc_id, {lang} AS lg, coalesce(text, '') AS t FROM documents),
b AS (SELECT *, regexp_extract_all(t, '[^\\x{{20}}\\x{{09}}-\\x{{0D}}]+') AS ws, regexp_extract_all(translate(t, '{upper}', '{lower}'), '[^\\x{{20}}\\x{{09}}-\\x{{0D}}]+') AS lw FROM a),
tri AS (SELECT doc_id, i, (ws[i], ws[i + 1], ws[i + 2]) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM b)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM tri) WHERE k > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY doc_id),
lines AS (SELECT doc_id, sum(k - 1)::BIGINT AS n FROM (SELECT doc_id, l, count(*) AS k FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM b) WHERE regexp_matches(l, '[^\\x{{20}}\\x{{09}}-\\x{{0D}}]') GROUP BY ALL) GROUP BY doc_id),
c AS (SELECT b.doc_id, lg, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, {n([ord(x) for x in q.SYMBOLS])}::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
{', '.join(f'{x} AS c{k}' for k, x in enumerate(chars))}, {', '.join(f'{x} AS w{k}' for k, x in enumerate(common))} FROM b LEFT JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, {other} AS w{len(common)}, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words AS base_failed FROM c),
r AS (SELECT lg, {', '.join(f'sum({x}) FILTER (NOT base_failed) AS {x}' for x in cs + ws)} FROM f GROUP BY lg),
d AS (SELECT f.*, ({total('f', cs)}) AS c_n, ({total('r', cs)}) AS c_r, ({total('f', ws)}) AS w_n, ({total('r', ws)}) AS w_r, {', '.join(f'r.{x} AS r{x}' for x in cs + ws)} FROM f JOIN r USING (lg)),
e AS (SELECT *, CASE WHEN c_n >= {q.MIN_CHARS} THEN {js('c', cs).replace('f.', '').replace('r.', 'r')} ELSE 0 END AS cj, CASE WHEN n_words >= {q.MIN_COMMON_WORDS} THEN {js('w', ws).replace('f.', '').replace('r.', 'r')} ELSE 0 END AS wj FROM d)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(cj, 4) AS char_js, round(wj, 4) AS word_js, NOT base_failed AND cj <= {q.MAX_CHAR_JS}::DOUBLE AND wj <= {q.MAX_WORD_JS}::DOUBLE AS kept FROM e"""


ORACLES["op1_distribution_divergence"] = _quality_sql()


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x{20}\x{09}-\x{0D}]+'"

ORACLES["op5_tensored_banding"] = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_WORDS}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w)),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.y FROM reach r JOIN e ON r.b = e.x)
SELECT n.doc_id, n.n AS n_shingles, m.component_id, n.doc_id = m.component_id AS kept FROM n JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = n.doc_id"""

_W, _CAP = mixing.WEIGHTS, mixing.MAX_EPOCHS
ORACLES["op10_exponential_keys"] = f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS}))::BIGINT AS size, length(coalesce(text, '')) AS n_chars,
(('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE) / {float(1 << 52)!r}::DOUBLE AS u FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / CASE WHEN size > 0 THEN 1::DOUBLE / (1 + least(abs(n_chars::DOUBLE / size - 6.5::DOUBLE), 11::DOUBLE)) ELSE 1 END AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS ss, ({list(map(float, _W))})[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(_W)} + 1]::DOUBLE AS w FROM k GROUP BY source),
v AS (SELECT *, {_CAP} * ss / w AS cut, sum(ss) OVER () AS total, sum(w) OVER () AS wall, coalesce(sum({_CAP} * ss) OVER b, 0) AS capped, coalesce(sum(w) OVER b, 0) AS wb FROM s WINDOW b AS (ORDER BY {_CAP} * ss / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
x AS (SELECT arg_min((total - capped) / (wall - wb), cut) AS level FROM v WHERE cut >= (total - capped) / (wall - wb)),
t AS (SELECT source, ss, least(({_CAP} * ss)::DOUBLE, w * level::DOUBLE) AS target FROM v, x),
q AS (SELECT k.*, ss, target, CASE WHEN ss > 0 THEN floor(target / ss)::BIGINT ELSE 0 END AS epochs, round(target)::BIGINT AS whole, sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, ss AS source_size, target, (epochs * size + greatest(0, least(size, whole - epochs * ss - before)))::BIGINT AS taken FROM q"""
