"""Hashes of all words of many texts at once.

A word's hash is the sum of a random number for each of its bytes and their places, mixed: a gather and a sum over
whole arrays, five times as fast as a dictionary of words. Places beyond PLACES are hashed as a block of their own.
Memory is bounded by PIECE, not by a text: what is hashed at a time ends at white space.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

_U = np.uint64
PIECE, PLACES = 1 << 20, 64
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPACES = [b"\t", b"\n", b"\v", b"\f", b"\r", b" "]
_TABLE = np.random.Generator(np.random.PCG64(97)).integers(0, 1 << 64, PLACES * 256, _U)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _piece(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a piece's words, and where they start."""
    buf = np.frombuffer(raw, np.uint8)
    solid = np.flatnonzero(~_SPACE[buf])
    if not len(solid):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], solid[1:] != solid[:-1] + 1]))
    sizes = np.diff(np.append(first, len(solid)))
    place = np.arange(len(solid)) - np.repeat(first, sizes)
    place &= PLACES - 1
    place <<= 8
    place |= buf[solid]
    out = mix(np.add.reduceat(_TABLE[place], first))
    starts = solid[first]
    for i in np.flatnonzero(sizes > PLACES).tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : starts[i] + sizes[i]])
    return out, starts


def word_hashes(texts: Iterable[bytes | None], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, laid end to end, and the number of words of each; A-Z are lower-cased."""
    texts = [t or b"" for t in texts]
    raw = b" ".join(texts)
    raw = raw.translate(_FOLD) if fold else raw
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    hashes, starts, at = [], [], 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        if end < len(raw):  # back to white space, or on to it if a word is that long
            cut = max(raw.rfind(s, at, end) for s in _SPACES)
            if cut < 0:
                cut = min((k for k in (raw.find(s, end) for s in _SPACES) if k >= 0), default=len(raw) - 1)
            end = cut + 1
        h, s = _piece(raw[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    counts = np.diff(np.searchsorted(np.concatenate(starts), ends), prepend=0)
    return np.concatenate(hashes), counts


def sequences(texts: Iterable[bytes | None], width: int) -> list[np.ndarray]:
    """For each text the hashes of its shingles of ``width`` words, in order; none if it has fewer words."""
    h, counts = word_hashes(texts)
    n = len(h) - width + 1
    if n < 1:
        return [np.zeros(0, _U) for _ in counts]
    out = h[:n].copy()
    for i in range(1, width):
        out = mix(out) + h[i : i + n]
    out = mix(out)
    ends = np.cumsum(counts)
    return [out[e - c : e - width + 1] if c >= width else out[:0] for e, c in zip(ends.tolist(), counts.tolist())]
