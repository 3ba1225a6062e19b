"""Near-duplicate passages by compact windows.

A text is its sequence of shingles of ``width`` words. For a hash function, a compact window (l, c, r) stands for all
subsequences that start in l..c, end in c..r and so have the shingle at c as their minimum: the nodes of the Cartesian tree
over the hashes. Only nodes that span ``least_run`` shingles or more are made; the parent of such a node is one too, so
the tree over the positions that are the minimum of some stretch of that length has them all, and both ends of their spans.
``least_run`` is what makes one function enough: a stretch of ``min_words`` words or more that is as similar as asked after words were
changed, put in or left out has a run of that many equal shingles, 21 with the defaults, and equal runs share their minimum.

Windows of one minimum are candidates. None is expanded into pairs: each is held against one, the hub, of the least document.
How far both agree to the left and right of the minimum, within the window, tells what is left to find: two windows that agree with each
other beyond what they share with the hub part from it at the same place, and go on with the same shingle. So of each side a window goes to
the next round under a key of its old key, that place and that shingle, and the windows of a key have a hub of their own there. Keys of one document
end. Rounds go on until no key is left; in each the agreement grows, so there are at most some tens, and few in practice. Thus every
stretch of ``min_words`` words that occurs in a lesser document is held against one that has all of it. A stretch that is similar but not equal is missed
only where each run of ``least_run`` shingles that it shares with its partner is also in a lesser document that is not similar there.

A document's windows that meet one partner are joined by intervals: where their spans lie no further apart than REACH and near one
diagonal. Each interval, with REACH shingles on either side, is verified on the shingles themselves: the longest stretch around an anchor, from one shared shingle to another, of
which as large a part as the similarity asks for occurs in the partner near the diagonal, then the Jaccard similarity of both stretches.

Keys with more than 1 / HOT of all windows are fewer than HOT: they are joined by a broadcast of so many rows, and a hub with more than
that share of all pairs is dealt over SALTS copies of its row. So no task gets a hot key whole.

Defined results: a null or empty text has no passages; of rows equal in id and text each gets the same result, and they
are no partners of each other; a null id (as the greatest 64-bit number) ranks after all others and, as a partner, is null; texts under ``min_words`` words
take no part; an empty table gives no rows. Repeats within a document are not reported. Texts are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch, slices
from .words import mix, sequences

WIDTH, MIN_WORDS, PERCENT, HASHES, REACH = 5, 50, 80, 1, 64
#: Shares that make a key hot, copies of a hot hub's row, and ids that are broadcast at most (16 bytes each) to read only the texts of a small round.
HOT, SALTS, FEW = 1000, 32, 500_000
NO_ID = (1 << 63) - 1
_U = np.uint64
_PLACES = np.dtype([("c", "<i4"), ("d", "<i4"), ("left", "<i2"), ("right", "<i2"), ("more", "?"), ("key", "<i8")])


def least_run(width: int, min_words: int, percent: int) -> int:
    """The least length, in shingles, of the longest run of equal ones in stretches of ``min_words`` words or more that k single words set apart
    and that are still as similar as asked: k words take ``width`` * k shingles of each, and leave k + 1 runs."""
    n = min_words - width + 1
    if percent >= 100:
        return n
    least = lambda k: max(n, -(-width * k * (100 + percent) // (100 - percent)))
    return max(1, min(-(-(least(k) - width * k) // (k + 1)) for k in range(n + 1)))


def _least(values: np.ndarray, span: int) -> tuple[np.ndarray, np.uint64]:
    """The least of each ``span`` values that follow one another, with its place in the low bits that the mask holds; of equal values the first."""
    bits = _U(max(24, len(values).bit_length()))
    packed = (values >> bits << bits) | np.arange(len(values), dtype=_U)  # the high bits decide, then the place
    least, length = packed, 1
    while length < span:  # minima over 1, 2, 4, ... places, the last step overlapping
        step = min(length, span - length)
        least = np.minimum(least[: len(least) - step], least[step:])
        length += step
    return least, _U((1 << int(bits)) - 1)


def trees(values: np.ndarray, span: int, sizes: np.ndarray) -> np.ndarray:
    """The nodes (l, c, r), r - l + 1 >= span, of the Cartesian trees over sequences laid end to end in ``values``, of so many each: a row a node, by
    rising c, places counted from the first sequence on; of equal values the first is the least."""
    if len(values) < span:
        return np.zeros((0, 3), np.int64)
    ends = np.cumsum(sizes)
    least, mask = _least(values, span)
    end = np.repeat(ends, sizes)[: len(least)]  # of the sequence in which a stretch begins
    whole = np.arange(span, span + len(least)) <= end
    fresh = whole & np.append(True, (least[1:] != least[:-1]) | (end[1:] != end[:-1]))
    nodes, first, end = least[fresh], (end - np.repeat(sizes, sizes)[: len(least)])[fresh], end[fresh]
    c, at = (nodes & mask).astype(np.int64), np.arange(len(nodes))
    edge = end[1:] != end[:-1]
    below = np.maximum.accumulate(np.where(np.append(True, edge), at, 0)[: len(at)]) - 1
    above = np.minimum.accumulate(np.where(np.append(edge, True), at, len(at))[: len(at)][::-1])[::-1] + 1
    before, after = at - 1, at + 1
    for to, stop in ((before, below), (after, above)):  # the next lesser node: from a greater one it is looked for where that one looks
        on = at
        while len(on := on[to[on] != stop[on]]) and len(on := on[nodes[to[on]] > nodes[on]]):
            to[on] = to[to[on]]
    if len(at):
        first = np.where(before == below, first, c[before] + 1)
        end = np.where(after == above, end, c[np.minimum(after, len(c) - 1)])
    return np.stack([first, c, end - 1], axis=1)[end - first >= span]


def compact_windows(values: np.ndarray, span: int) -> list[tuple[int, int, int]]:
    """``trees`` of one sequence."""
    return [tuple(w) for w in trees(values, span, np.array([len(values)])).tolist()]


def _named(docs: DataFrame) -> DataFrame:
    """(id, th, text): a document is told apart by its id and a hash of its text."""
    th = F.coalesce(F.xxhash64("text"), F.lit(0))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), th.alias("th"), F.col("text").cast("string").alias("text"))


def _seeds(hashes: int, seed: int = 23) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, hashes, _U)


def windows(docs: DataFrame, width: int, min_words: int, percent: int, hashes: int) -> DataFrame:
    """(id, th, key, c, left, right): the compact windows of every document, with a key of hash function and minimum, and how far each reaches
    beside its minimum, up to what a stretch of ``min_words`` words can."""
    seeds, most = _seeds(hashes), min_words - width
    run = least_run(width, min_words, percent)

    def rows(batches):
        for b in slices(batches, 64):
            seqs = [s if len(s) > most else s[:0] for s in sequences((v.as_py() for v in b.column(2).cast(pa.large_binary())), width)]
            sizes, s = np.fromiter(map(len, seqs), np.int64, len(seqs)), np.concatenate(seqs)
            found = [trees(mix(s ^ seed), run, sizes) for seed in seeds]
            k = np.concatenate([mix(s[w[:, 1]] + seed) for w, seed in zip(found, seeds)]).view(np.int64)
            l, c, r = np.concatenate(found).T
            ends = np.cumsum(sizes)
            doc = np.searchsorted(ends, c, "right")
            at, c, l, r = pa.array(doc), *(v - (ends - sizes)[doc] for v in (c, l, r))
            reach = (np.minimum(d, most).astype(np.int16) for d in (c - l, r - c))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(k), pa.array(c.astype(np.int32)), *map(pa.array, reach)], names=["id", "th", "key", "c", "left", "right"])

    return _named(docs).mapInArrow(rows, "id long, th long, key long, c int, left short, right short")


def _stretch(hit: np.ndarray, anchor: int, percent: int) -> tuple[int, int]:
    """The longest stretch [i, j] around ``anchor`` with hits at both ends and a share of them of 2p / (1 + p) or more, p the similarity."""
    num, den = 2 * percent, 100 + percent
    total = np.concatenate([[0], np.cumsum(np.where(hit, den - num, -num))])
    lefts = np.flatnonzero(hit[: anchor + 1])
    rights = anchor + np.flatnonzero(hit[anchor:])
    best = np.maximum.accumulate(total[rights + 1][::-1])  # of the rights from the last on
    k = np.searchsorted(best, total[lefts], side="left")  # how many from the last on are too low
    ok = k < len(rights)
    if not ok.any():
        return anchor, anchor
    ends = rights[::-1][np.minimum(k, len(rights) - 1)]
    best_i = np.argmax(np.where(ok, ends - lefts, -1))
    return int(lefts[best_i]), int(ends[best_i])


def _run(hit: np.ndarray, at: np.ndarray, anchor: int) -> tuple[int, int]:
    """The stretch around ``anchor`` of hits that follow one another in both documents."""
    broken = np.flatnonzero(~hit[1:] | ~hit[:-1] | (np.diff(at) != 1))
    k = int(np.searchsorted(broken, anchor))
    return int(broken[k - 1]) + 1 if k else 0, int(broken[k]) if k < len(broken) else len(hit) - 1


def intervals(places: np.ndarray) -> list[np.ndarray]:
    """Windows of one pair of documents (_PLACES), joined where their spans lie within REACH and their diagonals drift less than a fourth of it."""
    if len(places) == 1:
        return [places]
    places = places[np.argsort(places["c"], kind="stable")]
    shift = places["d"] - places["c"]
    starts, ends = places["c"] - places["left"], places["c"] + places["right"]
    if (shift == shift[0]).all() and (starts[1:] <= np.maximum.accumulate(ends)[:-1] + REACH).all():
        return [places]
    drift, out, last = REACH // 4, [], {}
    for i, (k, lo, hi) in enumerate(zip(shift.tolist(), starts.tolist(), ends.tolist())):
        at = k // drift
        near = [n for n in (last.get(at), last.get(at - 1), last.get(at + 1)) if n is not None and lo <= n[1] + REACH and abs(k - n[2]) <= drift]
        own = max(near, key=lambda n: n[1]) if near else [[], hi, k]
        if not near:
            out.append(own)
        own[0].append(i)
        own[1], own[2] = max(own[1], hi), k
        last[at] = own
    return [places[n[0]] for n in out]


def agreement(x: np.ndarray, y: np.ndarray, places: np.ndarray, bounds: tuple, most: int) -> tuple[np.ndarray, np.ndarray]:
    """How many shingles before and after each place x and y agree, up to ``most`` and to where either text ends (``bounds``: first and end in x and in y)."""
    before, after = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    for lo in range(0, len(places), 4096):
        of = slice(lo, lo + 4096)
        for out, step in ((before, -1), (after, 1)):
            off = np.arange(1, most + 1) * step
            i, j = places["c"][of, None] + off, places["d"][of, None] + off
            x0, x1, y0, y1 = (v[of, None] for v in bounds)
            same = (i >= x0) & (i < x1) & (j >= y0) & (j < y1)
            same &= x[np.clip(i, 0, len(x) - 1)] == y[np.clip(j, 0, len(y) - 1)]
            out[of] = np.where(same.all(axis=1), most, np.argmin(same, axis=1))
    return before, after


def left_over(x: np.ndarray, y: np.ndarray, places: np.ndarray, bounds: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each side, which windows go on where x and y part, and their keys in the next round."""
    if not len(places):
        return []
    before, after = agreement(x, y, places, bounds, int(max(places["left"].max(), places["right"].max(), 1)))
    key = places["key"].view(_U) if places["key"].flags.c_contiguous else np.ascontiguousarray(places["key"]).view(_U)
    out = []
    for side, n, most, at in ((0, before, places["left"], places["c"] - before - 1), (1, after, places["right"], places["c"] + after + 1)):
        on = np.flatnonzero((n < most) & (at >= bounds[0]) & (at < bounds[1]))
        out.append((on, mix(key[on] + mix((x[at[on]].astype(_U) << _U(8)) + n[on].astype(_U) * _U(2) + _U(side))).view(np.int64)))
    return out


def _similar(x: np.ndarray, y: np.ndarray, hits: int, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of the distinct shingles; counted only where the matched places leave it open."""
    spread = len(x) + len(y)
    if 100 * hits >= (percent + 5) * (spread - hits):
        return True
    common = len(np.intersect1d(x, y))
    return 100 * common >= percent * (len(np.unique(x)) + len(np.unique(y)) - common)


def _on_diagonal(x: np.ndarray, y: np.ndarray, anchors: list[tuple[int, int]], width: int, min_words: int, percent: int, there: np.ndarray) -> list[tuple[int, int, int, int]] | None:
    """``align`` where all anchors lie on one diagonal, one stretch along it holds them all and no shingle beside it is elsewhere in y; else None."""
    c, shift = anchors[0][0], anchors[0][1] - anchors[0][0]
    if any(d - k != shift for k, d in anchors):
        return None
    lo, hi = max(0, -shift), min(len(x), len(y) - shift)
    equal = x[lo:hi] == y[lo + shift : hi + shift]
    if not equal[c - lo]:
        return None
    breaks = np.flatnonzero(~equal)
    k = int(np.searchsorted(breaks, c - lo))
    i, j = int(breaks[k - 1]) + 1 if k else 0, int(breaks[k]) - 1 if k < len(breaks) else hi - lo - 1
    if j - i + 1 + len(breaks) < hi - lo:  # other shingles agree than those of this run
        i, j = _stretch(equal, c - lo, percent)
    i, j = i + lo, j + lo
    if i > c or j < max(k for k, _ in anchors):
        return None
    off = there.copy()
    off[lo:hi] &= ~equal
    if off[:i].any() or off[j + 1 :].any():  # words were put in or left out, perhaps
        return None
    own, other = x[i : j + 1], y[i + shift : j + shift + 1]
    if not _similar(own, other, int(np.count_nonzero(own == other)), percent):
        return None
    return [(i, j + width - 1, i + shift, j + shift + width - 1)] if j - i + width >= min_words else []


def align(x: np.ndarray, y: np.ndarray, anchors: list[tuple[int, int]], width: int, min_words: int, percent: int, there: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """Verified stretches (first and last word of x, of y) around anchors (place in x, place in y), in order of their place in x; ``there``: what of x occurs in y."""
    direct = _on_diagonal(x, y, anchors, width, min_words, percent, np.isin(x, y) if there is None else there)
    if direct is not None:
        return direct
    order = np.argsort(y, kind="stable")
    ranked = y[order]
    shared = np.flatnonzero(ranked[np.minimum(np.searchsorted(ranked, x), len(y) - 1)] == x)
    lows, highs = np.searchsorted(ranked, x[shared], "left"), np.searchsorted(ranked, x[shared], "right")
    many = np.flatnonzero(highs - lows > 1)
    group = np.cumsum(np.append(False, ranked[1:] != ranked[:-1])) * (len(y) + 1)  # so group + place rises along ``order``
    ordered = group + order
    group, lows_many, highs_many = group[lows[many]], lows[many], highs[many]
    out: list[tuple[int, int, int, int]] = []
    seen: list[tuple[int, int, int, int]] = []
    for c, d in anchors:
        if any(i <= c <= j and k <= d <= m for i, j, k, m in seen):
            continue
        # A shingle of x counts if it occurs in y within a drift of the diagonal that grows with the distance from the anchor.
        want, place = shared - c + d, order[lows]
        if len(many):  # of several places the one nearest to the diagonal, of two as near the first
            to = want[many]
            k = np.searchsorted(ordered, group + np.clip(to, 0, len(y)))
            before, after = order[np.maximum(k - 1, lows_many)], order[np.minimum(k, highs_many - 1)]
            place[many] = np.where(np.abs(before - to) <= np.abs(after - to), before, after)
        near = np.abs(place - want) <= width + np.abs(shared - c) // 4
        hit, at = np.zeros(len(x), bool), np.zeros(len(x), np.int64)
        hit[shared[near]], at[shared[near]] = True, place[near]
        if not hit[c]:
            continue
        # The longest stretch may be too loose in y; then the run of equal words around the anchor is taken by itself.
        for i, j in (_stretch(hit, c, percent), _run(hit, at, c)):
            ys = at[i : j + 1][hit[i : j + 1]]
            k, m = int(ys.min()), int(ys.max())
            if good := _similar(x[i : j + 1], y[k : m + 1], len(ys), percent):
                break
        seen.append((i, j, k, m))
        if good and min(j - i, m - k) + width >= min_words:
            out.append((i, j + width - 1, k, m + width - 1))
    return out


def _hot(rows: DataFrame, by: list[str], total: int) -> DataFrame | None:
    """Of counted keys (n) those with more than 1 / HOT of all rows, if there are any: fewer than HOT, so that they can be broadcast."""
    hot = rows.where(F.col("n") > max(1000, total // HOT)).select(*by, F.lit(True).alias("hot"))
    return F.broadcast(hot) if hot.take(1) else None


def _met(found: DataFrame, scratch: Scratch, step: int) -> DataFrame | None:
    """(id, th, y, yth, anchors): windows of keys that two documents or more have, each against its key's hub; none if there are no such keys.
    Of keys and hubs there is one row a key, small in each partition: of many windows none need be sorted, as these are hashed."""
    ends = found.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.min("th").alias("a"), F.max("th").alias("b"), F.count("*").alias("n")).where("lo <> hi or a <> b").select("key", "lo", "n")
    ends = scratch.save(ends, f"keys-{step}")
    total = ends.agg(F.sum("n")).first()[0]
    if not total:
        return None
    hashed = lambda side: side.hint("shuffle_hash") if total > FEW else side
    hot = _hot(ends, ["key"], total)
    if hot is None:
        hits = scratch.save(found.join(hashed(ends), "key"), f"hits-{step}")
        met = hits.join(hashed(hits.where("id = lo").groupBy("key").agg(F.min(F.struct("id", "th", "c")).alias("h"))), "key")
    else:
        dealt = ends.join(hot, "key", "left")
        hits = scratch.save(found.join(F.broadcast(dealt.where("hot")), "key").unionByName(found.join(hashed(dealt.where("hot is null")), "key")), f"hits-{step}")
        hubs = hits.where("id = lo").groupBy("key", "hot").agg(F.min(F.struct("id", "th", "c")).alias("h"))
        side = lambda on: hubs.where(on).select("key", "h")
        met = hits.where("hot").join(F.broadcast(side("hot")), "key").unionByName(hits.where("hot is null").join(hashed(side("hot is null")), "key"))
    met = met.where("not (id = h.id and th = h.th) or n > 2 and c <> h.c")
    anchor = F.struct("c", F.col("h.c").alias("d"), "left", "right", (F.col("n") > 2).alias("more"), "key")
    pairs = scratch.save(met.groupBy("id", "th", F.col("h.id").alias("y"), F.col("h.th").alias("yth")).agg(F.collect_list(anchor).alias("anchors")), f"pairs-{step}")
    scratch.drop(f"keys-{step}", f"hits-{step}")
    return pairs


def _verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch, step: int, width: int, min_words: int, percent: int) -> DataFrame:
    """Verified stretches (xs..ye), and windows with keys of the next round (key, c, left, right), of the documents (id, th)."""

    margin = max(REACH, min_words)  # no window's reach ends beyond it

    def cut(batches):
        """The partner's part of each interval goes to the document; its own text is there once."""
        last: tuple = (None, None)
        for b in slices(batches):
            at, first, part, places = [], [], [], []
            ids, ths = b.column(2).to_pylist(), b.column(3).to_pylist()
            flat = b.column(4).flatten()
            values, ends = np.empty(len(flat), _PLACES), np.cumsum(b.column(4).value_lengths().to_numpy()).tolist()
            for k, name in enumerate(_PLACES.names):
                values[name] = flat.field(k).to_numpy(zero_copy_only=False)
            for i, end in enumerate(ends):
                if last[0] != (ids[i], ths[i]):
                    last = ((ids[i], ths[i]), sequences([b.column(5)[i].as_py().encode()], width)[0])
                for k in intervals(values[ends[i - 1] if i else 0 : end]):
                    lo = max(0, int(k["d"].min()) - margin)
                    at.append(i)
                    first.append(lo)
                    part.append((last[1][lo : int(k["d"].max()) + margin + 1] >> _U(32)).astype("<u4").tobytes())
                    places.append(k.tobytes())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(take) for k in range(4)), pa.array(first, pa.int32()), pa.array(part, pa.binary()), pa.array(places, pa.binary())], names=["id", "th", "y", "yth", "first", "part", "places"])

    hot = _hot(pairs.groupBy("y", "yth").agg(F.count("*").alias("n")), ["y", "yth"], pairs.count())
    dealt, copies, by = pairs, texts.select(F.col("id").alias("y"), F.col("th").alias("yth"), "text"), ["y", "yth"]
    if hot is not None:
        whole = lambda k: F.lit(k).cast("long")
        dealt = pairs.join(hot, by, "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id", "th"), whole(SALTS))).otherwise(whole(0))).drop("hot")
        copies = copies.join(hot, by, "left").withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(whole(0), whole(SALTS - 1))).otherwise(F.array(whole(0))))).drop("hot")
        by = [*by, "salt"]
    parts = dealt.join(copies, by).select("id", "th", "y", "yth", "anchors", "text").mapInArrow(cut, "id long, th long, y long, yth long, first int, part binary, places binary")
    parts = scratch.save(parts.groupBy("id", "th").agg(F.collect_list(F.struct("y", "yth", "first", "part", "places")).alias("parts")), f"parts-{step}")
    scratch.drop(f"pairs-{step}")

    def verify(batches):
        """All parts of some documents at a time: what goes on, and which parts can be similar at all, is told over whole arrays."""
        need = -(-2 * percent * (min_words - width + 1) // (100 + percent))  # shingles that a stretch shares at least
        for b in slices(batches, 64):
            xs = [(s >> _U(32)).astype(np.uint32) for s in sequences((t.as_py().encode() for t in b.column(2)), width)]
            flat, owner = b.column(3).flatten(), np.repeat(np.arange(b.num_rows), b.column(3).value_lengths().to_numpy())
            other = [flat.field(k).to_numpy() for k in (0, 1)]
            first, raw, found = flat.field(2).to_numpy().astype(np.int64), flat.field(3).to_pylist(), flat.field(4).to_pylist()
            y, places = np.frombuffer(b"".join(raw), "<u4"), np.frombuffer(b"".join(found), _PLACES).copy()
            sizes, counts = np.fromiter(map(len, raw), np.int64, len(raw)) // 4, np.fromiter(map(len, found), np.int64, len(found)) // _PLACES.itemsize
            x_ends, y_ends, ends = np.cumsum([len(x) for x in xs]), np.cumsum(sizes), np.cumsum(counts)
            x_starts, y_starts, starts = x_ends - [len(x) for x in xs], y_ends - sizes, ends - counts
            x, part = np.concatenate(xs), np.repeat(np.arange(len(raw)), counts)
            # Windows that go on.
            on, keys = [], []
            more = np.flatnonzero(places["more"])
            asked, of = places[more], part[more]
            asked["c"] += x_starts[owner[of]]
            asked["d"] += y_starts[of] - first[of]
            for k, key in left_over(x, y, asked, (x_starts[owner[of]], x_ends[owner[of]], y_starts[of], y_ends[of])):
                on.append(more[k])
                keys.append(key)
            # Shingles of x that occur in y, part by part.
            lo = np.maximum(0, np.minimum.reduceat(places["c"], starts) - margin) if len(starts) else starts
            hi = np.minimum(x_ends[owner] - x_starts[owner], np.maximum.reduceat(places["c"], starts) + margin + 1) if len(starts) else starts
            cuts = np.cumsum(hi - lo)
            own = np.concatenate([xs[i][p:q] for i, p, q in zip(owner.tolist(), lo.tolist(), hi.tolist())]) if len(lo) else x[:0]
            tag = lambda values, n: (np.repeat(np.arange(len(raw), dtype=_U), n) << _U(32)) | values
            there = np.isin(tag(own, hi - lo), tag(y, sizes))
            self_ = (other[0] == b.column(0).to_numpy()[owner]) & (other[1] == b.column(1).to_numpy()[owner])
            able = np.flatnonzero((np.add.reduceat(there, cuts - (hi - lo)) >= need) & ~self_) if len(lo) else lo
            at, spans = [], []
            for p in able.tolist():
                k = places[starts[p] : ends[p]]
                end, n, f = int(cuts[p]), int(hi[p] - lo[p]), int(first[p])
                anchors = list(zip((k["c"] - lo[p]).tolist(), (k["d"] - f).tolist()))
                for s in align(own[end - n : end], y[y_starts[p] : y_ends[p]], anchors, width, min_words, percent, there[end - n : end]):
                    at.append(p)
                    spans.append((s[0] + lo[p], s[1] + lo[p], s[2] + f, s[3] + f))
            p, at = np.array(spans, np.int32).reshape(-1, 4), np.array(at, np.int64)
            on = np.concatenate([np.zeros(0, np.int64), *on])
            rest, take = places[on], pa.array(np.concatenate([owner[at], owner[part[on]]]).astype(np.int64))
            stretch = [pa.concat_arrays([pa.array(v, t), pa.nulls(len(on), t)]) for v, t in ((other[0][at], pa.int64()), (other[1][at], pa.int64()), *((p[:, j].copy(), pa.int32()) for j in range(4)))]
            goes = [pa.concat_arrays([pa.nulls(len(at), t), pa.array(v, t)]) for v, t in ((np.concatenate([np.zeros(0, np.int64), *keys]), pa.int64()), (rest["c"].copy(), pa.int32()), (rest["left"].copy(), pa.int16()), (rest["right"].copy(), pa.int16()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *stretch, *goes], names=["id", "th", "y", "yth", "xs", "xe", "ys", "ye", "key", "c", "left", "right"])

    both = texts.join(parts, ["id", "th"]).select("id", "th", "text", "parts")
    out = scratch.save(both.mapInArrow(verify, "id long, th long, y long, yth long, xs int, xe int, ys int, ye int, key long, c int, left short, right short"), f"verified-{step}")
    scratch.drop(f"parts-{step}")
    return out


def passages(docs: DataFrame, width: int = WIDTH, min_words: int = MIN_WORDS, percent: int = PERCENT, hashes: int = HASHES) -> DataFrame:
    """Verified stretches (x, xs, xe, y, ys, ye): documents x and y as (id, th), y a hub of x; words xs..xe of x and ys..ye of y, from 0, both included."""
    scratch = Scratch(docs.sparkSession)
    named = _named(docs).dropDuplicates(["id", "th"])
    found, out, step = scratch.save(windows(docs, width, min_words, percent, hashes), "windows"), None, 0
    while (pairs := _met(found, scratch, step)) is not None:
        texts = named
        if step:
            sides = scratch.save(pairs.select("id", "th").unionAll(pairs.select("y", "yth")).distinct(), f"sides-{step}")
            if sides.count() <= FEW:
                texts = _named(docs).join(F.broadcast(sides), ["id", "th"], "left_semi").dropDuplicates(["id", "th"])
        else:
            scratch.drop("windows")
        done = _verified(pairs, texts, scratch, step, width, min_words, percent)
        stretches = done.where("key is null").select(F.struct("id", "th").alias("x"), F.struct(F.col("y").alias("id"), F.col("yth").alias("th")).alias("y"), "xs", "xe", "ys", "ye")
        out = stretches if out is None else out.unionAll(stretches)
        found, step = done.where("key is not null").select("id", "th", "key", "c", "left", "right"), step + 1
    if out is None:
        who = "struct<id:bigint,th:bigint>"
        return docs.sparkSession.createDataFrame([], f"x {who}, y {who}, xs int, xe int, ys int, ye int")
    return out


def duplicate_passages(docs: DataFrame, **options) -> DataFrame:
    """For each row of ``docs`` (doc_id, text), by place, in words from 0: ``passages`` that an earlier document (by id) has too, as
    (first, last, partner, partner_first, partner_last); ``n_dup_words`` in them, which a deduplicated text leaves out; and
    ``sources``, stretches (first, last) that later documents repeat. Of the stretches from one word only the longest
    is listed, of equal ones that of the least partner: it holds the others, and no list grows with the number of copies."""
    found = passages(docs, **options)
    side = lambda own, s, e, other, ps, pe: found.select(F.col(own).alias("who"), F.col(s).alias("first"), F.col(e).alias("last"), F.col(other).alias("partner"), F.col(ps).alias("pf"), F.col(pe).alias("pl"))
    both = side("x", "xs", "xe", "y", "ys", "ye").unionAll(side("y", "ys", "ye", "x", "xs", "xe"))
    best = both.groupBy("who", "first", (F.col("partner") < F.col("who")).alias("later")).agg(F.min_by(F.struct("last", "partner", "pf", "pl"), F.struct(-F.col("last"), "partner", "pf")).alias("b"))
    lists = best.groupBy("who").agg(F.array_sort(F.collect_list(F.when(F.col("later"), F.struct("first", "b.*")))).alias("p"), F.array_sort(F.collect_list(F.when(~F.col("later"), F.struct("first", "b.last")))).alias("s"))

    def merged(spans, kind, same, longer):
        """Interval join: a stretch that starts within the last one, on its diagonal, goes on with it."""
        def step(acc, x):
            last = F.try_element_at(acc, F.lit(-1))
            return F.when(F.coalesce((x["first"] <= last["last"] + 1) & same(last, x), F.lit(False)), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer(last, x)))).otherwise(F.concat(acc, F.array(x)))

        return F.aggregate(F.coalesce(spans, F.expr(f"cast(array() as array<struct<{kind}>>)")), F.expr(f"cast(array() as array<struct<{kind}>>)"), step)

    kind = "first:int,last:int,partner:struct<id:bigint,th:bigint>,pf:int,pl:int"
    own = merged(F.col("p"), kind, lambda a, x: (a["partner"] == x["partner"]) & (F.abs((a["first"] - a["pf"]) - (x["first"] - x["pf"])) <= WIDTH * 5), lambda a, x: F.struct(a["first"].alias("first"), F.greatest(a["last"], x["last"]).alias("last"), a["partner"].alias("partner"), F.least(a["pf"], x["pf"]).alias("pf"), F.greatest(a["pl"], x["pl"]).alias("pl")))
    given = merged(F.col("s"), "first:int,last:int", lambda a, x: F.lit(True), lambda a, x: F.struct(a["first"].alias("first"), F.greatest(a["last"], x["last"]).alias("last")))
    named = _named(docs).select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), F.struct("id", "th").alias("who"))
    out = named.join(lists, "who", "left").select("doc_id", F.transform(own, lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), F.when(p["partner"]["id"] != NO_ID, p["partner"]["id"]).alias("partner"), p["pf"].alias("partner_first"), p["pl"].alias("partner_last"))).alias("passages"), given.alias("sources"))
    covered = F.aggregate("passages", F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")), lambda acc, p: F.struct(F.greatest(acc["at"], p["last"] + 1).alias("at"), (acc["n"] + F.greatest(F.lit(0), p["last"] + 1 - F.greatest(acc["at"], p["first"]))).alias("n")), lambda acc: acc["n"])
    return out.select("doc_id", covered.cast("long").alias("n_dup_words"), "passages", "sources")
