"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on every document. Expectation-maximisation over the counts of the
vote patterns of all documents estimates how often each labeller votes on either class, and so each pattern's
posterior of being good; no labelled row is needed. The posteriors of a bounded sample train a linear scorer on
hashed words and character pairs, which then scores all documents.

Defined results: a null text counts as empty: labellers that need words abstain, and the bias alone scores it; equal
texts get equal results; an empty table gives no rows; if no document has a vote, every posterior is the prior. Texts
are taken whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import slices

#: The scorer's fit: hashed features, sampled documents (those of least hash; the rest are only scored), passes, step, decay.
DIMS, MAX_SAMPLE, ROUNDS, RATE, L2 = 1 << 11, 6000, 200, 2.0, 1e-4
KEEP_FROM = 0.5
GOOD, BAD, NONE = 1, 0, -1
_STOPS = frozenset(b"the of and to in a is that for it der die und den von das mit de la le et les des en un que el los del se por con du est pour".split())


def _profile(raw: bytes) -> dict:
    words = raw.split()
    low = Counter(raw.lower().split())
    bins = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = int(bins[65:91].sum() + bins[97:123].sum() + bins[0xC0:].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return {"n": len(words), "len": max(1, len(raw)), "letters": letters, "upper": int(bins[65:91].sum()), "symbols": int(bins[[ord(c) for c in "#*$%&|<>!~^_=+@"]].sum()), "stops": sum(c for w, c in low.items() if w.rstrip(b",.") in _STOPS), "distinct": len(low), "ended": sum(x.rstrip()[-1:] in b".?\"')" and x.rstrip()[-2:-1] not in b"!.$*&#%|" for x in lines), "lines": len(lines), "repeats": len(lines) - len(set(lines))}


def _vote(good: bool, bad: bool) -> int:
    return BAD if bad else GOOD if good else NONE


#: name: votes on a profile. Each sees another side of a text; each abstains in its middle range.
LABELLERS: dict[str, Callable[[dict], int]] = {
    "symbols": lambda p: _vote(p["symbols"] < 0.005 * p["len"], p["symbols"] > 0.05 * p["len"]),
    "capitals": lambda p: _vote(p["upper"] < 0.1 * p["letters"], p["upper"] > 0.4 * p["letters"]) if p["letters"] > 40 else NONE,
    "function words": lambda p: _vote(p["stops"] > 0.12 * p["n"], p["stops"] < 0.04 * p["n"]) if p["n"] >= 40 else NONE,
    "sentence ends": lambda p: _vote(p["ended"] > 0.7 * p["lines"], p["ended"] < 0.25 * p["lines"]) if p["lines"] else NONE,
    "repeated lines": lambda p: _vote(p["lines"] > 2 and not p["repeats"], p["repeats"] > 0.3 * p["lines"]) if p["lines"] > 1 else NONE,
    "variety": lambda p: _vote(p["distinct"] > 0.35 * p["n"], p["distinct"] < 0.15 * p["n"]) if 40 <= p["n"] <= 2000 else NONE,
    "word length": lambda p: _vote(3.5 < p["len"] / p["n"] < 9.5, not 2.5 < p["len"] / p["n"] < 14) if p["n"] >= 10 else NONE,
}


def votes(raw: bytes | None) -> tuple[int, ...]:
    p = _profile(raw or b"")
    return tuple(f(p) for f in LABELLERS.values())


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good, chances [labeller, class, vote] of a cast vote being bad or good, each pattern's posterior of good).

    Starts from each pattern's majority; every chance has a small prior towards labellers that are right. To abstain says
    nothing of the class, so short texts are not taken for bad ones."""
    n, m = patterns.shape
    if not n:
        return 0.5, np.full((m, 2, 2), 1 / 2), np.zeros(0)
    good = (1 + (patterns == GOOD).sum(1)) / (2 + (patterns >= 0).sum(1))
    share, chance = 0.5, np.zeros((m, 2, 2))
    prior = np.array([[0.8, 0.2], [0.2, 0.8]]) * (1 + 0.01 * counts.sum())
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        for j in range(m):
            cast = patterns[:, j] >= 0
            chance[j] = np.stack([np.bincount(patterns[cast, j], weight[c][cast], 2) for c in range(2)]) + prior
        chance /= chance.sum(axis=2, keepdims=True)
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        log = np.log([1 - share, share])[:, None] + sum(np.where(patterns[:, j] >= 0, np.log(chance[j][:, patterns[:, j]]), 0) for j in range(m))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return float(share), chance, good


class _Slots(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 17:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word) % (DIMS // 2)
        return h


_slots = _Slots()


def hashed(raw: bytes | None) -> np.ndarray:
    """Frequencies of hashed words and of hashed pairs of neighbouring bytes, square roots, each half of length one."""
    out = np.zeros(DIMS, np.float32)
    raw = (raw or b"").lower()
    words = raw.split()
    if words:
        half = DIMS // 2
        out[:half] = np.bincount(np.fromiter(map(_slots.__getitem__, words), np.int64, len(words)), minlength=half)[:half]
        b = np.frombuffer(raw, np.uint8).astype(np.int64)
        out[half:] = np.bincount((b[:-1] * 257 + b[1:]) * 2654435761 % (1 << 32) % half, minlength=half)[:half]
        for part in (out[:half], out[half:]):
            np.sqrt(part / max(1.0, float(part.sum())), out=part)
    return out


def fit_linear(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch steps with momentum; targets are probabilities; the classes weigh the same."""
    w, b, vw, vb = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
    if not len(x):
        return w, b
    weight = target / max(1e-9, target.sum()) + (1 - target) / max(1e-9, (1 - target).sum())
    weight /= weight.sum()
    for _ in range(ROUNDS):
        gap = weight * (1 / (1 + np.exp(-(x @ w + b))) - target)
        vw, vb = 0.9 * vw - RATE * (x.T @ gap + L2 * w).astype(np.float32), 0.9 * vb - RATE * float(gap.sum())
        w, b = w + vw, b + vb
    return w, float(b)


def weak_label_model(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> tuple[dict[tuple[int, ...], float], np.ndarray, float]:
    """Posteriors by vote pattern, from all documents, and the scorer's weights and bias, from ``max_sample`` of them at most."""
    m = len(LABELLERS)

    def vote(batches):
        for b in slices(batches):
            seen = Counter(votes(v.as_py()) for v in b.column(0).cast(pa.large_binary()))
            yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())], names=["votes", "n"])

    text = docs.select(F.col("text").cast("string").alias("text"))
    found = text.mapInArrow(vote, "votes array<int>, n long").groupBy("votes").agg(F.sum("n")).collect()  # at most 3 ** labellers rows
    found.sort()
    patterns = np.array([r[0] for r in found], int).reshape(-1, m)
    _, _, good = expectation_maximisation(patterns, np.array([r[1] for r in found], float))
    posterior = {tuple(p): float(g) for p, g in zip(patterns.tolist(), good)}

    def features(batches):
        for b in slices(batches):
            raw = [v.as_py() for v in b.column(0).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([hashed(r).astype("<f2").tobytes() for r in raw], pa.binary()), pa.array([posterior.get(votes(r), 0.5) for r in raw], pa.float64())], names=["_h", "x", "good"])

    # The sample: least hashes first, equal texts once; the hash alone is sorted, then joined back to its texts.
    sample = text.withColumn("_h", F.xxhash64("text"))
    chosen = sample.select("_h").distinct().orderBy("_h").limit(max_sample)
    edge = chosen.agg(F.max("_h")).first()[0]
    rows = sample.where(F.col("_h") <= F.lit(edge)).dropDuplicates(["_h"]).select("text", "_h").mapInArrow(features, "_h long, x binary, good double").collect() if edge is not None else []
    rows.sort(key=lambda r: r[0])  # sums of floats don't depend on the order of tasks
    x = np.frombuffer(b"".join(r[1] for r in rows), "<f2").reshape(-1, DIMS).astype(np.float32)
    w, bias = fit_linear(x, np.array([r[2] for r in rows], np.float32))
    return posterior, w, bias


def classify_quality(docs: DataFrame, max_sample: int = MAX_SAMPLE, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, each labeller's vote joined, posterior of the votes, score of the scorer and kept, for each row of ``docs`` (doc_id, text)."""
    posterior, w, bias = weak_label_model(docs, max_sample)

    def score(batches):
        for b in slices(batches):
            cols: list[list] = [[], [], [], []]
            for v in b.column(1).cast(pa.large_binary()):
                raw = v.as_py()
                own = votes(raw)
                p = 1 / (1 + np.exp(-float(hashed(raw) @ w + bias)))
                for c, x in zip(cols, ("".join("-01"[k + 1] for k in own), round(posterior.get(own, 0.5), 6), round(p, 6), p >= keep_from)):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.float64(), pa.bool_())))], names=["doc_id", "votes", "posterior", "score", "kept"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(score, "doc_id long, votes string, posterior double, score double, kept boolean")
