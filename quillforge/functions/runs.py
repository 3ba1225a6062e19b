"""Token runs of many texts at once, over whole arrays: the tokens of ``text.tokens`` and the hashes that ``xxhash64`` gives for runs of them.

A run's hash takes its tokens one after another, each seeded by what the tokens before gave. So all runs of a piece are
hashed together, a step a token, and in a step the tokens of one length together. Memory is bounded by a text and WINDOW.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import text as T

_U = np.uint64
_P1, _P2, _P3, _P4, _P5 = (_U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Seed of Spark's xxhash64, bytes cut into tokens and runs hashed at a time, and the length from which xxhash works in stripes.
SEED, PIECE, WINDOW, STRIPE = 42, 1 << 20, 1 << 16, 32
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORD = b"abcdefghijklmnopqrstuvwxyz0123456789_"
_LENGTH = np.ones(256, np.int64)
_LENGTH[0xC0:], _LENGTH[0xE0:], _LENGTH[0xF0:] = 2, 3, 4
_made: list[tuple[bytes, dict[int, str]]] = []


def symbols(spark: SparkSession) -> tuple[bytes, dict[int, str]]:
    """Which code points are tokens (compressed bits), and those that lower case changes, as the JVM's own patterns have it: its Unicode version need not
    be Python's. Made once a process, of one small job."""
    if not _made:
        blocks = spark.range(0x1100).where("id not between 216 and 223")
        char = lambda i: F.decode(F.unhex(F.concat(F.lit("0000000A"), F.lpad(F.hex(i), 8, "0"))), "UTF-32")  # after a line end, as a mark of byte order would go
        each = F.transform(F.sequence(F.col("id") * 256, F.col("id") * 256 + 255), lambda i: F.struct(i.alias("cp"), F.substring(char(i), 2, 1).alias("char"), F.get(T.tokens(char(i)), 0).alias("token")))
        found = blocks.select("id", each.alias("e")).select("id", F.transform("e", lambda x: x["token"].isNotNull()).alias("is"), F.filter("e", lambda x: (x["cp"] > 127) & (x["token"] != x["char"])).alias("lower")).toArrow()
        bits = np.zeros((0x1100, 256), bool)
        bits[found["id"].to_numpy()] = np.asarray(found["is"].combine_chunks().flatten()).reshape(-1, 256)
        lower = {x["cp"]: x["token"] for xs in found["lower"].to_pylist() for x in xs}
        _made.append((zlib.compress(np.packbits(bits).tobytes()), lower))
    return _made[0]


class Runs:
    """Hashes of the runs of ``n`` tokens of texts; a text with fewer has one, of all its tokens, and one without tokens none."""

    def __init__(self, table: tuple[bytes, dict[int, str]], n: int = T.NGRAM):
        self.n, self.lower = n, table[1]
        self.is_symbol = np.unpackbits(np.frombuffer(zlib.decompress(table[0]), np.uint8)).astype(bool)
        self.changed = np.zeros(0x110000, bool)
        self.changed[list(self.lower)] = True
        self.kind = np.where(self.is_symbol[:256], 2, 0).astype(np.uint8)
        self.kind[128:] = 0
        self.kind[list(_WORD)] = 1

    def _leads(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and code points of what is not ASCII; ``buf`` has three bytes more than its text."""
        at = np.flatnonzero(buf[:-3] >= 0xC0)
        b = [buf[at + i].astype(np.int64) & 0x3F for i in range(4)]
        size = _LENGTH[buf[at]]
        two, three = (b[0] & 0x1F) << 6 | b[1], (b[0] & 0x0F) << 12 | b[1] << 6 | b[2]
        return at, np.where(size == 2, two, np.where(size == 3, three, (b[0] & 0x07) << 18 | b[1] << 12 | b[2] << 6 | b[3]))

    def _tokens(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths in bytes of the tokens of a lower-cased piece (and three bytes more)."""
        kind = self.kind[buf[:-3]]
        at, cps = self._leads(buf)
        kind[at] = np.where(self.is_symbol[cps], 2, 0)
        word = np.zeros(len(kind) + 2, np.int8)
        word[1:-1] = kind == 1
        edge = np.diff(word)
        first = edge[:-1] == 1
        starts = np.flatnonzero(first | (kind == 2))
        sizes = _LENGTH[buf[starts]]
        sizes[first[starts]] = np.flatnonzero(edge == -1) - np.flatnonzero(first)
        return starts, sizes

    def _chained(self, raw: bytes, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, short: dict[int, np.ndarray]) -> np.ndarray:
        """The hash of the run that begins at each token; ``short``: by its number of tokens, where a run of fewer begins."""
        n, size = self.n, len(starts)
        out = np.empty(size, _U)
        wide = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
        half = np.ndarray((len(buf) - 3,), "<u4", buf, strides=(1,))
        for lo in range(0, size, WINDOW):
            hi = min(lo + WINDOW, size)
            end = min(hi + n - 1, size)
            s, length = starts[lo:end], np.minimum(sizes[lo:end], STRIPE).astype(np.uint8)
            order, counts = np.argsort(length, kind="stable"), np.bincount(length)
            groups, at, early = [], 0, []
            for L, c in enumerate(counts.tolist()):
                if c:
                    idx = order[at : at + c]
                    groups.append((idx, L, *self._words(wide, half, buf, s[idx], L)))
                    at += c
            h = np.full(end - lo + n - 1, SEED, _U)
            for j in range(n):
                seeds = h[n - 1 - j :]
                for idx, L, words, four, tail in groups:
                    v = seeds.take(idx)
                    if L == STRIPE:
                        spans = zip(s[idx].tolist(), sizes[lo:end][idx].tolist(), v.tolist())
                        seeds[idx] = np.fromiter((xxhash.xxh64_intdigest(raw[a : a + k], seed) for a, k, seed in spans), _U, len(idx))
                        continue
                    v += _P5 + _U(L)
                    for w in words:
                        v ^= w
                        v = (v << _U(27)) | (v >> _U(37))
                        v *= _P1
                        v += _P4
                    if four is not None:
                        v ^= four
                        v = (v << _U(23)) | (v >> _U(41))
                        v *= _P2
                        v += _P3
                    for w in tail:
                        v ^= w
                        v = (v << _U(11)) | (v >> _U(53))
                        v *= _P1
                    v ^= v >> _U(33)
                    v *= _P2
                    v ^= v >> _U(29)
                    v *= _P3
                    v ^= v >> _U(32)
                    seeds[idx] = v
                if j + 1 in short:
                    p = short[j + 1]
                    p = p[np.searchsorted(p, lo) : np.searchsorted(p, hi)]
                    early.append((p, h[p - lo + n - 1]))
            out[lo:hi] = h[n - 1 : n - 1 + hi - lo]
            for p, v in early:
                out[p] = v
        return out

    @staticmethod
    def _words(wide, half, buf, s, L):
        """What a step mixes in for tokens of L bytes at ``s``: words of eight bytes, one of four, single ones."""
        if L == STRIPE:
            return [], None, []
        words = []
        for i in range(L // 8):
            w = wide[s + 8 * i] * _P2
            words.append(((w << _U(31)) | (w >> _U(33))) * _P1)
        at = L // 8 * 8
        four = half[s + at].astype(_U) * _P1 if L & 4 else None
        at += L & 4
        return words, four, [buf[s + at + i].astype(_U) * _P5 for i in range(L & 3)]

    def of(self, texts: Iterable[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all texts' runs, laid end to end, and how many each text has. What is no UTF-8 is taken as the JVM takes it."""
        texts = [t or b"" for t in texts]
        try:
            b"\n".join(texts).decode()
        except UnicodeDecodeError:
            texts = [t.decode(errors="replace").encode() for t in texts]
        raw = b"\n".join([*texts, b""])
        raw = raw.translate(_FOLD)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        buf = np.frombuffer(raw + bytes(8), np.uint8)
        starts, sizes, at = [], [], 0
        while at < len(raw):
            end = min(at + PIECE, len(raw))
            if end < len(raw):  # back to white space, or on to it
                cut = max(raw.rfind(b" ", at, end), raw.rfind(b"\n", at, end))
                if cut < 0:
                    cut = min(k for k in (raw.find(b" ", end), raw.find(b"\n", end)) if k >= 0)
                end = cut + 1
            a, b = self._tokens(np.concatenate([buf[at:end], np.zeros(3, np.uint8)]))
            starts.append(a + at)
            sizes.append(b)
            at = end
        if not starts:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        starts, sizes = np.concatenate(starts), np.concatenate(sizes)
        last = np.searchsorted(starts, ends)
        if not raw.isascii() and self.changed[self._leads(buf[:-5])[1]].any():  # rare: tokens that lower case changes are written anew, and not cut again
            toks = [raw[a : a + k].decode().translate(self.lower).encode() for a, k in zip(starts.tolist(), sizes.tolist())]
            raw, sizes = b"".join(toks), np.fromiter(map(len, toks), np.int64, len(toks))
            starts, buf = np.cumsum(sizes) - sizes, np.frombuffer(raw + bytes(8), np.uint8)
        counts = np.diff(last, prepend=0)
        short = {k: (last - counts)[counts == k] for k in range(1, self.n) if (counts == k).any()}
        hashes = self._chained(raw, buf, starts, sizes, short)
        n_runs = np.where(counts >= self.n, counts - self.n + 1, np.minimum(counts, 1))
        keep = np.arange(len(starts)) - np.repeat(last - counts, counts) < np.repeat(n_runs, counts)
        return hashes[keep], n_runs
