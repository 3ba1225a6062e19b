"""Quality rules by distribution divergence.

Each document's histograms of character classes and of common words are compared, by Jensen-Shannon
distance, with those of its language: the counts summed over all documents of that language which pass
the base rules. A histogram of too short a text says little, so each distance counts only from a least
length on.

Defined results: a null text counts as empty; an empty text fails the base rules (under 50 words); a
null or unlisted language is compared with the pool of all such documents; equal rows get equal results,
one each; an empty table gives an empty result. Long texts are taken whole.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import slices

LANGS = ("en", "de", "fr", "es")
#: Frequent function words, ASCII only, so that lower-casing is the same everywhere.
COMMON = {
    "en": "the of and to in a is that for it as with be on by this from or an are which was at",
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur",
    "es": "de la que el en y a los del se las por un para con no una su al lo es",
}
WORDS = tuple(sorted({w for v in COMMON.values() for w in v.split()}))
#: Character classes over UTF-8 bytes: lower, upper, digit, space, line end, sentence marks, table and markup marks, brackets and
#: quotes, other ASCII, beyond ASCII. Continuation bytes of a code point are not counted.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "symbol", "quote", "other", "wide")
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
#: Least letters and marks for the class distance, least words for the word distance, and the distances (square root of the
#: divergence in bits, from 0 to 1) above which a document is rejected.
MIN_CHARS, MIN_COMMON_WORDS, MAX_CHAR_JS, MAX_WORD_JS = 200, 100, 0.28, 0.34

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, char_js double, word_js double, kept boolean"


def _class_of_byte() -> np.ndarray:
    out = np.full(256, CLASSES.index("other"))
    for chars, name in (("abcdefghijklmnopqrstuvwxyz", "lower"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "upper"), ("0123456789", "digit"), (" \t\v\f\r", "space"), ("\n", "newline"), (".,;:?", "stop"), (SYMBOLS + "!=~^_@\\/+", "symbol"), ("'\"()[]{}-", "quote")):
        out[[ord(c) for c in chars]] = CLASSES.index(name)
    out[0xC0:] = CLASSES.index("wide")
    out[0x80:0xC0] = len(CLASSES)
    return out


CLASS_OF = _class_of_byte()
_SPACES, _SYMBOLS = [9, 10, 11, 12, 13, 32], [ord(c) for c in SYMBOLS]


def repeat_words(words: list) -> int:
    """Words covered by 3-word windows that the text has twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def dup_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def features(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class counts, common-word counts and the rest)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    bins = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    counts = Counter(raw.translate(_FOLD).split())
    common = [counts.get(w, 0) + counts.get(w + b",", 0) + counts.get(w + b".", 0) for w in _WORDS]
    chars = np.bincount(CLASS_OF, weights=bins, minlength=len(CLASSES) + 1)[: len(CLASSES)].astype(np.int64)
    word_chars = len(raw) - int(bins[0x80:0xC0].sum()) - int(bins[_SPACES].sum())
    return len(words), word_chars, int(bins[_SYMBOLS].sum()), dup_lines(raw), repeat_words(words), chars, np.array([*common, len(words) - sum(common)], np.int64)


_WORDS = [w.encode() for w in WORDS]
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PCT * n_words


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits; 0 if either side has no counts."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    kl = lambda x: float((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum())
    return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def _lang(value: str | None) -> int:
    return LANGS.index(value) if value in LANGS else len(LANGS)


def language_references(docs: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Class and common-word counts of each listed language and of the rest, over all documents that pass the base rules.

    Every task returns one row of sums for each language, so what meets in the reduce is a few rows a task.
    """
    n = len(CLASSES) + len(WORDS) + 1

    def sums(batches):
        total = np.zeros((len(LANGS) + 1, n), np.int64)
        for b in slices(batches):
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = features(text)
                if not base_failed(f[0], f[4]):
                    total[_lang(lang)] += np.concatenate(f[5:])
        k = np.flatnonzero(total.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(k, n), pa.int32()), pa.array(np.tile(np.arange(n), len(k)), pa.int32()), pa.array(total[k].ravel(), pa.int64())], names=["lang", "bin", "n"])

    parts = docs.select("text", "lang").mapInArrow(sums, "lang int, bin int, n long")
    out = {k: np.zeros(n) for k in range(len(LANGS) + 1)}
    for r in parts.groupBy("lang", "bin").sum("n").collect():  # at most 5 languages x n bins, whatever the input
        out[r[0]][r[1]] = r[2]
    return {k: (v[: len(CLASSES)], v[len(CLASSES) :]) for k, v in out.items()}


def verdict(f: tuple, reference: tuple[np.ndarray, np.ndarray], max_char_js: float, max_word_js: float) -> tuple[bool, float, float, bool]:
    failed = base_failed(f[0], f[4])
    char_js = js_distance(f[5], reference[0]) if int(f[5].sum()) >= MIN_CHARS else 0.0
    word_js = js_distance(f[6], reference[1]) if f[0] >= MIN_COMMON_WORDS else 0.0
    return failed, char_js, word_js, not failed and char_js <= max_char_js and word_js <= max_word_js


def quality_rules(docs: DataFrame, max_char_js: float = MAX_CHAR_JS, max_word_js: float = MAX_WORD_JS) -> DataFrame:
    """One row of SCHEMA for each row of ``docs`` (doc_id, text, lang): two passes over the texts, no row is shuffled."""
    refs = language_references(docs)

    def judge(batches):
        for b in slices(batches):
            rows = []
            for i, text, lang in zip(*(b.column(k).to_pylist() for k in range(3))):
                f = features(text)
                failed, cj, wj, kept = verdict(f, refs[_lang(lang)], max_char_js, max_word_js)
                rows.append((i, *f[:5], failed, round(cj, 4), round(wj, 4), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 10, [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()])], names=_NAMES)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text", "lang").mapInArrow(judge, SCHEMA)


_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep."""
    refs = language_references(docs)
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def judge(batches):
        for b in slices(batches):
            kept = [verdict(features(t), refs[_lang(x)], MAX_CHAR_JS, MAX_WORD_JS)[3] for t, x in zip(b.column(text).to_pylist(), b.column(lang).to_pylist())]
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)
