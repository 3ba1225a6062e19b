"""URL filter: a bit-parallel automaton over all glob rules at once.

A rule is a glob over ``host + path``. Every pattern position is one bit of a multiword mask; a step shifts
all patterns by one character, keeps those bits whose character fits (Shift-And), and holds the bits before a
wildcard. ``**`` spans any characters, ``*`` any but ``/`` (so a wildcard in the host never reaches into the
path), ``?`` is one byte but ``/``. A batch of URLs is simulated together, one character of each at a time.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; hosts are
lower-cased (A-Z), paths are not; of fitting rules the longest wins, of equally long ones the first listed;
without a rule the glob list decides. Equal rows get equal results, one each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: (verdict, host, path): the rule fits the host and its subdomains where the path starts so.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: What decides where no rule fits: a URL that fits one of these is blocked, any other allowed.
BLOCK_GLOBS = ("*casino*/**", "*casino*", "*-pills.*", "*-pills.*/**", "ads.*/**", "ads.*", "*.ads.*/**", "tracker.*/**", "**/login/**", "**/cart/**", "**/wp-admin/**", "**.exe", "**.zip", "**.js", "**.css")
SCHEMA = "page_id long, host string, path string, rule string, verdict string"


@dataclass(frozen=True)
class Automaton:
    """Masks by byte, as rows of 64-bit words: where a byte fits, where it may stay; start and end bits of the patterns."""

    fits: np.ndarray
    stays: np.ndarray
    start: np.ndarray
    ends: list[tuple[int, np.uint64]]

    @classmethod
    def build(cls, globs: list[str]) -> Automaton:
        # A state stands before each literal or "?", and one stands after the last; wildcards are loops on the state they precede.
        states: list[tuple[str, str]] = []  # (byte that leads to the next state or "" at the end, loop)
        starts, ends = [], []
        for glob in globs:
            starts.append(len(states))
            loop, raw = "", glob.encode("utf-8").decode("latin-1")
            i = 0
            while i < len(raw):
                if raw.startswith("**", i):
                    loop, i = "**", i + 2
                elif raw[i] == "*":
                    loop, i = loop or "*", i + 1
                else:
                    states.append((raw[i], loop))
                    loop, i = "", i + 1
            ends.append(len(states))
            states.append(("", loop))
        words = -(-len(states) // 64)
        fits, stays = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
        for n, (byte, loop) in enumerate(states):
            word, bit = n // 64, np.uint64(1) << np.uint64(n % 64)
            for c in range(256):
                if loop == "**" or loop == "*" and c != 0x2F:
                    stays[c, word] |= bit
                if byte == chr(c) or byte == "?" and c != 0x2F:
                    word_to, bit_to = (n + 1) // 64, np.uint64(1) << np.uint64((n + 1) % 64)
                    fits[c, word_to] |= bit_to
        start = np.zeros(words, np.uint64)
        for n in starts:
            start[n // 64] |= np.uint64(1) << np.uint64(n % 64)
        return cls(fits, stays, start, [(n // 64, np.uint64(1) << np.uint64(n % 64)) for n in ends])

    def match(self, urls: list[bytes]) -> np.ndarray:
        """A row for each URL and a column for each pattern: whether the whole URL fits the pattern."""
        out = np.zeros((len(urls), len(self.ends)), bool)
        lengths = np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-lengths, kind="stable")  # those still running stay a prefix
        raw = np.frombuffer(b"".join(urls) or b"\0", np.uint8)
        at = (np.cumsum(lengths) - lengths)[order]
        left, running = lengths[order], np.tile(self.start, (len(urls), 1))
        ended = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), side="right")
        for step, n in enumerate(ended.tolist()):
            byte, now = raw[at[:n] + step], running[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            running[:n] = moved & self.fits[byte] | now & self.stays[byte]
        for k, (word, bit) in enumerate(self.ends):
            out[order, k] = running[:, word] & bit != 0
        return out


def host_and_path(url: str | None) -> tuple[str, str]:
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min((i for c in "?#" if (i := rest.find(c)) >= 0), default=len(rest))
    return host.encode().translate(_FOLD).decode(), rest[:cut]


_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def url_filter(pages: DataFrame, rules=RULES, block_globs=BLOCK_GLOBS, slice_rows: int = 4096) -> DataFrame:
    """One row of SCHEMA for each row of ``pages`` (page_id, url); no row is shuffled."""
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    globs = [g for _, host, path in ranked for g in (f"{host}{path}**", f"*.{host}{path}**")]
    n_rule = len(globs)
    automaton = Automaton.build([*globs, *block_globs])
    names = np.array([h + p for _, h, p in ranked] + [None], object)
    verdicts = np.array([v for v, _, _ in ranked] + [None], object)

    def judge(batches):
        for b in batches:
            for lo in range(0, b.num_rows, slice_rows):
                part = b.slice(lo, slice_rows)
                split = [host_and_path(u) for u in part.column(1).to_pylist()]
                hit = automaton.match([(h + p).encode() for h, p in split])
                by_rule = hit[:, :n_rule].reshape(-1, len(ranked), 2).any(axis=2)
                first = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1) if ranked else 0, len(ranked))
                none = np.where(hit[:, n_rule:].any(axis=1), "block", "allow").astype(object)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()), pa.array(names[first], pa.string()), pa.array(np.where(first < len(ranked), verdicts[first], none), pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    return pages.selectExpr("cast(page_id as long) page_id", "url").mapInArrow(judge, SCHEMA)
