"""Near-duplicate documents and passages, and the pipeline, against brute force."""

import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from quillforge.llm import neardup, packing, passages, quality
from quillforge.llm import words as words_module

from .conftest import words


def sets_of(text, width):
    w = (text or "").encode().translate(words_module._FOLD).split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def plain_components(rows, width, percent):
    """Least id reachable, of each row, by all pairs."""
    sets, up = [sets_of(t, width) for _, t in rows], list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(rows))]


def family(base, n, most, rng):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(most + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block,queries,shingles", [(1024, 256, 500_000), (7, 3, 2000)])
def test_components(spark, monkeypatch, block, queries, shingles):
    for name, value in (("BLOCK", block), ("QUERIES", queries), ("BLOCK_SHINGLES", shingles)):
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(8)
    texts = family(words(150, 1), 60, 12, rng) + family(words(90, 2), 25, 4, rng) + [" ".join(words(80, k)) for k in range(10, 30)]
    texts += [texts[0]] * 20 + [texts[3].upper(), texts[3].replace(" ", "\n "), None, "", "one", "ONE", "one two"]
    rows = [(i, t) for i, t in enumerate(rng.sample(texts, len(texts)))]
    got = {r.doc_id: r for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    want = plain_components(rows, 3, 85)
    for (i, t), w in zip(rows, want):
        assert got[i].component_id == w and got[i].n_shingles == len(sets_of(t, 3)) and got[i].kept == (i == w)


def test_chain_of_links(spark):
    base, chain = words(200, 3), []
    for k in range(6):  # each links with the next, not with those further on
        base = base[:]
        base[k * 30 : k * 30 + 12] = [f"c{k}x{j}" for j in range(12)]
        chain.append((k, " ".join(base)))
    want = plain_components(chain, 3, 85)
    assert [r.component_id for r in neardup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string"), 3, 85).orderBy("doc_id").collect()] == want


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = Counter((r.doc_id, r.component_id, r.n_shingles) for r in neardup.near_duplicates(awkward, 3, 85).collect())
    assert got == Counter((d, c if sets_of(t, 3) else d, len(sets_of(t, 3))) for (d, t), c in zip(rows, plain_components(rows, 3, 85)))
    assert neardup.near_duplicates(nothing).count() == 0 and neardup.drop_near_duplicates(nothing).count() == 0
    kept = neardup.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    groups = Counter(c for (d, t), c in zip(rows, plain_components(rows, 5, 80)) if sets_of(t, 5))
    assert kept.where("text is not null and trim(text) <> ''").where("length(trim(translate(text, '\n\t', ''))) > 0").count() >= len(groups)


def test_one_of_each_group_stays(spark):
    rng = random.Random(9)
    rows = [(i, t, f"x{i}") for i, t in enumerate(family(words(100, 4), 30, 1, rng) + [" ".join(words(60, 50 + k)) for k in range(5)])]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, extra string")
    want = sorted(set(plain_components([r[:2] for r in rows], 5, 80)))
    assert sorted(r.doc_id for r in neardup.drop_near_duplicates(docs).collect()) == want


def test_half_keys_are_the_only_minhashes():
    s = neardup.sets([b"a b c d e f g"], 3)[0]
    assert len(s) == 5 and [len(x) for x in neardup.sets([b"A b", None, b"", b" x "], 3)] == [1, 0, 0, 1] and neardup.sets([b"A b"], 3)[0] == neardup.sets([b"a  B"], 3)[0]


# Passages ---------------------------------------------------------------------------------------------------------------------------------


def test_word_hashes(monkeypatch):
    rng = random.Random(3)
    for piece in (1 << 20, 50):
        monkeypatch.setattr(words_module, "PIECE", piece)
        texts = [rng.choice([b" ", b"\t", b"\n\r", b"\x0b"]).join(rng.choice([b"a", b"b", b"ab", b"ba", "é".encode(), b"x" * 64, b"x" * 65, b"x" * 200]) for _ in range(rng.randrange(30))) for _ in range(60)] + [None, b"", b" \n", b"\tone "]
        h, counts = words_module.word_hashes(texts)
        plain = [w for t in texts for w in (t or b"").split()]
        assert counts.tolist() == [len((t or b"").split()) for t in texts] and len(h) == len(plain)
        assert len(set(zip(plain, h.tolist()))) == len(set(plain)) == len(set(h.tolist()))
    assert words_module.word_hashes([b"AbC"])[0] == words_module.word_hashes([b"abc"])[0] != words_module.word_hashes([b"AbC"], fold=False)[0]


def test_compact_windows():
    rng = np.random.default_rng(0)
    for _ in range(200):
        v = rng.integers(0, 30, rng.integers(1, 50)).astype(np.uint64) << np.uint64(40)
        span, want = int(rng.integers(1, 12)), set()
        for c in range(len(v)):
            lo = hi = c
            while lo and v[lo - 1] > v[c]:
                lo -= 1
            while hi + 1 < len(v) and v[hi + 1] >= v[c]:
                hi += 1
            if hi - lo + 1 >= span:
                want.add((lo, c, hi))
        assert set(passages.compact_windows(v, span)) == want


def test_windows_of_texts_laid_end_to_end():
    """op7: the trees of many texts, made at once, are those of each by itself."""
    rng = np.random.default_rng(3)
    for _ in range(100):
        texts = [rng.integers(0, 30, rng.integers(0, 60)).astype(np.uint64) << np.uint64(40) for _ in range(int(rng.integers(1, 8)))]
        sizes, span = np.array([len(v) for v in texts]), int(rng.integers(1, 12))
        got, at = passages.trees(np.concatenate(texts), span, sizes).tolist(), np.cumsum(sizes) - sizes
        assert sorted(got) == sorted([i + l, i + c, i + r] for i, v in zip(at.tolist(), texts) for l, c, r in passages.compact_windows(v, span))


def test_shingles_that_the_partner_repeats():
    """op7: of a shingle's places in the partner the nearest to the diagonal is found for all shingles at once."""
    rng = np.random.default_rng(4)
    p = rng.integers(0, 1 << 32, 2000, np.uint64).astype(np.uint32)
    x, y, calls = np.concatenate([p[:1500], p[:1], p[1500:]]), np.concatenate([p, p[:7], p]), []
    align = lambda at: passages.align(x, y, [(1001, 1001 + at)], 5, 50, 80)
    got = [align(at) for at in (0, 2007)]
    assert got == [[(0, 2004, at, 2003 + at)] for at in (0, 2007)]
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        align(0)
    finally:
        sys.setprofile(None)
    assert len(calls) < 2000  # a search for each shingle takes several calls


def test_passages_that_repeat(spark):
    own = lambda k, n: words(n, 1000 + k)
    p, q = words(70, 5), words(55, 6)
    edited = p[:30] + ["changed"] + p[31:]
    rows = [(1, own(1, 90) + p + own(2, 40)), (2, own(3, 10) + p + own(4, 200) + q), (3, q + own(5, 80)), (4, own(6, 300)), (5, own(7, 60) + edited + own(8, 60)), (6, own(9, 40) + p[:30] + own(10, 40))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.duplicate_passages(docs).collect()}
    covers = lambda spans, lo, hi: any(s.first <= lo and hi <= s.last for s in spans)
    assert covers(got[1].sources, 90, 159) and covers(got[2].passages, 10, 79) and covers(got[2].sources, 280, 334)
    assert covers(got[3].passages, 0, 54) and covers(got[5].passages, 60, 125)
    assert not got[4].passages and not got[4].sources and not got[6].passages and got[1].n_dup_words == 0
    assert {s.partner for s in got[2].passages} == {1}


def test_every_repeat_of_fifty_words_is_covered(spark):
    rng = random.Random(11)
    pool = [words(rng.randrange(50, 120), 300 + k) for k in range(8)]
    rows = []
    for i in range(40):
        w = words(rng.randrange(0, 150), 500 + i)
        for _ in range(rng.randrange(3)):
            w += rng.choice(pool) + words(rng.randrange(5, 60), rng.random())
        rows.append((i, w))
    got = {r.doc_id: [(s.first, s.last) for s in [*r.passages, *r.sources]] for r in passages.duplicate_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    where = defaultdict(set)
    for i, w in rows:
        for k in range(len(w) - 49):
            where[tuple(w[k : k + 50])].add((i, k))
    for at in where.values():
        if len({i for i, _ in at}) > 1:
            for i, k in at:
                assert any(a <= k and k + 49 <= b for a, b in got[i]), (i, k, got[i])


def test_a_common_line_hides_no_passage(spark):
    """Every minimum of the short passages lies in a line that lesser and greater documents hold elsewhere, also several times, or is passed over by them."""
    line, rows, shared = words(40, 77), [], {}
    for i in range(8):
        around = [words(60, 4000 + 10 * i + k) for k in range(3)]
        rows.append((i if i < 4 else 1000 + i, around[0] + line + around[1] + (line + around[2] if i % 2 else [])))
    for k in range(60):  # each passage has its own words around the line, and is in two documents
        passage = words(6, 5000 + k) + line + words(6, 6000 + k)
        for j in range(2):
            before = words(30 + 7 * j, 7000 + 2 * k + j)
            shared[100 + 2 * k + j] = (len(before), len(before) + 51)
            rows.append((100 + 2 * k + j, before + passage + words(40, 8000 + 2 * k + j)))
    got = {r.doc_id: r for r in passages.duplicate_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    for i, (lo, hi) in shared.items():
        spans = got[i].sources if i % 2 == 0 else got[i].passages
        assert any(s.first <= lo and hi <= s.last for s in spans), (i, lo, hi, spans)
        assert got[i].n_dup_words == (52 if i % 2 else 0)


def test_a_short_repeat_hides_no_longer_one(spark):
    notice, rest = words(55, 31), words(545, 32)
    rows = [(1, notice + words(100, 33)), (2, notice + rest), (3, notice + rest), (4, words(20, 34) + notice + rest)]
    got = {r.doc_id: r for r in passages.duplicate_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    for i, lo in ((3, 0), (4, 20)):
        assert got[i].n_dup_words == 600 and any((s.first, s.last, s.partner, s.partner_first, s.partner_last) == (lo, lo + 599, 2, 0, 599) for s in got[i].passages), got[i]
    assert got[2].n_dup_words == 55 and [tuple(s) for s in got[2].sources] == [(0, 599)] and [tuple(s) for s in got[1].sources] == [(0, 54)]


def plain_similar(a, b, width=5, percent=80):
    x, y = sets_of(" ".join(a), width), sets_of(" ".join(b), width)
    return 100 * len(x & y) >= percent * len(x | y)


def test_edited_passages_are_found(spark):
    """Passages of which a word in fifty at most is changed, put in or left out, but none at the ends; recall over those that are similar by brute force."""
    assert passages.least_run(5, 50, 80) == 21 and passages.least_run(5, 50, 100) == 46
    rng, rows, where = random.Random(21), [], {}
    for k in range(150):
        n = rng.choice([50, 55, 60, 75, 100, 150])
        passage = words(n, 20000 + k)
        edited = list(passage)
        for at in sorted(rng.sample(range(6, n - 6), max(1, n // 50)), reverse=True):
            edited[at : at + rng.choice([0, 1])] = words(1, rng.random()) * rng.choice([1, 1, 0])
        before, after = words(rng.randrange(80), rng.random()), words(30, rng.random())
        rows += [(2 * k, words(20, rng.random()) + passage + words(40, rng.random())), (2 * k + 1, before + edited + after)]
        if len(edited) >= 50 and plain_similar(passage, edited):
            where[2 * k + 1] = (len(before), len(before) + len(edited) - 1, passage, edited)
    got = {r.doc_id: r.passages for r in passages.duplicate_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    found = [i for i, (lo, hi, *_) in where.items() if any(s.first <= lo + 9 and hi - 9 <= s.last and s.partner == i - 1 for s in got[i])]
    assert len(where) > 100 and len(found) == len(where), sorted(set(where) - set(found))
    assert sum(len(got[i]) for i in got if i % 2 == 0) == 0


def test_copies_with_edits_of_their_own(spark):
    """A family of copies, each repeated itself: whatever two have in common over fifty words is covered, by rounds if the least document has less of it."""
    rng, base, rows = random.Random(4), words(160, 900), []
    for k in range(14):
        own = list(base)
        for at in rng.sample(range(160), rng.randrange(1, 4)):
            own[at] = f"edit{k}"
        rows += [own, words(10, 910 + k) + own + words(10, 930 + k)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = {r.doc_id: [(s.first, s.last) for s in r.passages] for r in passages.duplicate_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    seen = set()
    for i, w in rows:
        own = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        for k, g in enumerate(own):
            if g in seen:
                assert any(a <= k and k + 49 <= b for a, b in got[i]), (i, k, got[i])
        seen |= set(own)


def test_passages_awkward(awkward, nothing):
    got = passages.duplicate_passages(awkward)
    assert got.count() == awkward.count() and passages.duplicate_passages(nothing).count() == 0
    assert all(r.n_dup_words > 0 for r in got.where("doc_id = 1").collect())  # document 0 has the same words


# Pipeline ---------------------------------------------------------------------------------------------------------------------------------


def test_pipeline_keeps_what_plain_versions_keep(spark, tmp_path):
    rng = random.Random(12)
    common = ["the", "of", "and", "to", "in", "is", "that", "for"]
    prose = lambda: " ".join(rng.choice(common) if rng.random() < 0.3 else f"{rng.choice('bcdfgst')}{rng.choice(['an', 'ing', 'oor', 'ead'])}{rng.choice('aeiou')}{rng.choice('lmnrst')}" for _ in range(150)) + "."
    texts = [prose() for _ in range(40)]
    texts += [texts[0]] * 3 + [texts[1] + " more words"] + ["too short", "", None, " ".join(f"{w}***" for w in prose().split()), prose() + ' token = "' + "0af3" * 10 + '"']
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    good = {r.doc_id for r in quality.quality_rules(docs).where("kept").collect()}
    assert set(range(40)) <= good and not good & {44, 45, 46, 47}
    left = [(i, texts[i]) for i in sorted(good)]
    stay = set(plain_components(left, 5, 80))
    assert len(corpus_pipeline.STAGES) == 5
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/s{k}")
        kept = spark.read.parquet(f"{tmp_path}/s{k}")
        assert kept.columns == docs.columns
        if k == 1:
            assert sorted(r.doc_id for r in kept.collect()) == sorted(stay)
        if k == 2:
            assert kept.where("text like '%0af3%'").count() == 0 and kept.count() == len(stay)
    encode = packing.encoder(packing.public_vocabulary())
    want = Counter((r.doc_id, len(encode(r.text)) + 1) for r in kept.collect())
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = Counter()
    for r in out:
        if r.start == 0:
            got[(r.doc_id, r.doc_tokens)] += 1
    assert got == want and sum(r.length for r in out) == sum(n * c for (_, n), c in want.items())


def test_pipeline_awkward(awkward, nothing, spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and clashing names; of equal texts one row goes on. An empty table gives none."""
    for name, docs in (("some", awkward), ("none", nothing)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    prose = awkward.where("doc_id = 0 and text like '% %' and text not like 'another%'").first().text
    ids = {r.doc_id for r in out}
    assert ids <= {r.doc_id for r in awkward.where("length(text) >= 50").collect()} and len(ids & {None, 0, 1, 8}) <= 1 and len(prose) > 50
    whole = Counter((r.doc_id, r.start) for r in out)
    assert all(sum(r.length for r in out if r.doc_id == i) == whole[(i, 0)] * next(r.doc_tokens for r in out if r.doc_id == i) for i in ids)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
