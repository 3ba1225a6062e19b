"""URL automaton and page text."""

import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillforge.llm import htmltext, urlfilter

from .conftest import words


def plain(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts), re.S)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab/*?", min_size=1, max_size=9), min_size=1, max_size=20), st.lists(st.text("ab/", max_size=12), min_size=1, max_size=8))
def test_automaton_is_the_globs(globs, urls):
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    got = urlfilter.Automaton.build(globs).match([u.encode() for u in urls])
    assert got.tolist() == [[bool(plain(g).fullmatch(u)) for g in globs] for u in urls]


def test_many_words_of_mask():
    globs = [f"host{i}.example/*/page{i}**" for i in range(80)]
    got = urlfilter.Automaton.build(globs).match([f"host{i}.example/x/page{i}/y".encode() for i in range(80)])
    assert (got == np.eye(80, dtype=bool)).all()


def rule_of(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].lower(), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = ["http://A.ORG/x", "https://example.org/es/a", "http://www.example.org/en/12?q", "http://example.org/en/2", "http://x.com/fr/1#t", "http://x.com/de/1", "http://com/fr/", "http://notorg/x", "http://evil.com/x.org/", "http://org", "org/es/", None, "", "://?", "http://a.b?c/d", "http://ads.site.net/x", "http://site.net/cart/1", "ftp://é.org/ü"]


def test_rules(spark):
    rows = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(0, URLS[0], "x", "y"), (None, None, None, None)], "page_id long, url string, rule string, html string")
    for r in urlfilter.url_filter(rows, slice_rows=4).collect():
        host, path, rule, verdict = rule_of(URLS[r.page_id] if r.page_id is not None else None)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    got = {r.page_id: r.verdict for r in urlfilter.url_filter(rows).collect()}
    assert got[15] == got[16] == "block" and got[11] == "allow" and urlfilter.url_filter(rows.limit(0)).count() == 0


def test_blocks():
    page = """<!DOCTYPE html><head><title>T</title></head><body><header>Top</header><nav><ul><li>a</ul></nav><div class="x sidebar">s<div>deep</div></div>
    <article><header><h1>H&amp;1</h1></header><p>One <b>bold</b>\n two<br>three<p>Next<script>var a="</p>";</script> end<aside>note</aside>
    <form><input name=a>Ask</form><div id="comments"><p>hi</div>last</article><footer>f</footer><p>loose</body>"""
    got = [(b.zone, b.text) for b in htmltext.blocks(page)]
    assert [t for z, t in got if z == "article"] == ["H&1", "One bold two three", "Next end", "last"]
    assert [t for z, t in got if z == "body"] == ["loose"] and {"Top", "a", "s", "deep", "note", "Ask", "hi", "f"} <= {t for z, t in got if z == "side"}
    assert htmltext.blocks(None) == htmltext.blocks("") == htmltext.blocks("<p><!-- never closed") == []


def test_unclosed_menu_ends_at_the_article():
    assert [b.text for b in htmltext.blocks("<nav><p>menu<article><p>text</article>") if b.zone == "article"] == ["text"]


def covered_plainly(streams, n):
    out = [np.zeros(len(s), bool) for s in streams]
    where = {}
    for i, s in enumerate(streams):
        for k in range(len(s) - n + 1):
            where.setdefault(tuple(s[k : k + n]), []).append((i, k))
    for at in where.values():
        if len({i for i, _ in at}) > 1:
            for i, k in at:
                out[i][k : k + n] = True
    return out


def test_suffix_array_against_all_substrings():
    rng = random.Random(6)
    for _ in range(60):
        streams = [np.array([rng.randrange(3) for _ in range(rng.randrange(0, 25))], np.int64) for _ in range(rng.randrange(1, 6))]
        n = rng.randrange(1, 9)
        for a, b in zip(htmltext.repeated(streams, n), covered_plainly(streams, n)):
            assert (a == b).all()


def test_boilerplate_goes_and_articles_stay(spark):
    menu = "<div>" + " ".join(f"item{i}" for i in range(12)) + "</div>"
    shared = "<p>" + " ".join(f"shared{i}" for i in range(20)) + "</p>"
    own = lambda k: f"<p>own words of page {k} only {k}</p>"
    rows = [(k, "http://h.net/x", f"<body>{menu}{own(k)}</body>") for k in range(3)] + [(k, "http://h.net/y", f"<body>{menu}<article>{own(k)}{shared}</article></body>") for k in (10, 11)] + [(20, "http://other.net/", f"<body>{menu}</body>"), (21, None, None), (None, "http://h.net/z", ""), (20, "http://other.net/", f"<body>{menu}</body>")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in htmltext.extract_text(pages).collect()}
    assert got[1].text == "own words of page 1 only 1" and got[10].text.startswith("own words of page 10 only 10\n\nshared0 shared1")
    assert got[20].text.startswith("item0") and got[21].text == got[None].text == "" and got[10].n_chars == len(got[10].text)
    assert htmltext.extract_text(pages).count() == len(rows) and htmltext.extract_text(pages.limit(0)).count() == 0


def test_unique_body_text_stays_beside_an_article(spark):
    menu = "<div>" + " ".join(f"item{i}" for i in range(12)) + "</div>"
    rows = [(k, "http://h.net/x", f"<body>{menu}<h1>Heading {k}</h1><article><p>said {k}</p></article><p>after it {k}</p></body>", "t") for k in range(3)]
    got = {r.page_id: r.text for r in htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert got == {k: f"Heading {k}\n\nsaid {k}\n\nafter it {k}" for k in range(3)}


def test_articles_within_a_side_part_are_side():
    page = """<body><article><p>said</p><div class="comments"><div>top</div><article><p>first</p></article><article>second</article>end</div>still</article>
    <aside><article>teaser</article></aside><p>loose<nav>menu<article>own</article></body>"""
    got = [(b.zone, b.text) for b in htmltext.blocks(page)]
    assert got == [("article", "said"), ("side", "top"), ("side", "first"), ("side", "second"), ("side", "end"), ("article", "still"), ("side", "teaser"), ("body", "loose"), ("side", "menu"), ("article", "own")]


def test_a_great_host_gives_what_one_suffix_array_gives(spark):
    rng = random.Random(7)
    pool = [" ".join(f"n{k}w{i}" for i in range(rng.randrange(6, 15))) for k in range(30)]  # each on some pages only
    rows = []
    for i in range(120):
        body = "".join(f"<p>{rng.choice(pool)}</p>" if rng.random() < 0.4 else f"<p>{' '.join(f'é{i}x{rng.randrange(50)}' for _ in range(9))}</p>" for _ in range(4))
        rows.append((i, "http://h.net/x" if i % 3 else "http://g.net/", f"<body>{body}" + ("<article><p>said</article>" if i % 5 == 0 else ""), "t"))
    rows += [(200, *rows[0][1:]), rows[1], (300, None, None, "t"), (301, None, "", "t"), (302, None, "<p>two words", "t"), (303, "http://h.net/x", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    whole, dealt, some = (sorted(map(tuple, htmltext.extract_text(pages, bucket_chars=n).collect()), key=str) for n in (10**9, 500, 13_000))
    assert whole == dealt == some and len(whole) == len(rows)


def test_names_that_only_look_like_side_parts():
    zones = lambda name: {b.zone for b in htmltext.blocks(f'<div class="{name}"><p>some words</p></div>')}
    for name in ("container no-sidebar", "article-header", "share-price", "with-menu", "header-image-text", "shared", "navy blue"[5:]):
        assert zones(name) == {"body"}, name
    for name in ("ad", "top ad-slot", "site-header", "comments", "post-comments", "comment-list", "cookie-banner", "widget_2", "related-posts", "main-nav", "footer-links", "adverts"):
        assert zones(name) == {"side"}, name


@pytest.mark.parametrize("piece", ["<a ", "<", "<!", '<a "', "<p title='", "</", "<!--", "<script>", "<a b='x'\"", "<section class=comments>"])
def test_broken_markup_takes_time_in_proportion(piece):
    page = "<p>first words</p>" + piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    assert htmltext.blocks(page)[0].text == "first words"
    assert htmltext.blocks(page + ">")[0].text == "first words"
    assert time.perf_counter() - start < 20


def test_tags_against_a_plain_scan():
    page = """<P class='a>b' id=x>one<br/>two</p><!-- no > here --><script>if (a<b) "</p>"</script ><b>t < 3 & 4 > 2</b><!DOCTYPE x><div title="a
b>c">three</div> <a href="x>y four"""
    found = [(c, t) for _, _, c, t, _ in htmltext._tags(page) if t]
    assert found == [(False, "p"), (False, "br"), (True, "p"), (False, "b"), (True, "b"), (False, "div"), (True, "div"), (False, "a")]
    assert [b.text for b in htmltext.blocks(page)] == ["one two", "t < 3 & 4 > 2", "three", "y four"]


def test_how_many_pages_the_array_changes(spark):
    """Unmarked notices on pages with and without an article: without the suffix array each would stay."""
    notice = " ".join(f"term{k}" for k in range(30))
    page = lambda i: f"<div>{notice}</div>" + (f"<article><p>{' '.join(words(40, i))}</p></article>" if i % 2 else f"<div>{' '.join(words(40, i))}</div>") + f"<div>{' '.join(words(12, 900 + i))}</div>"
    rows = [(i, f"http://host{i % 3}.org/{i}", page(i)) for i in range(30)] + [(99, "http://alone.org/", page(99))]
    got = {r.page_id: r.text for r in htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    plain = {i: [b.text for b in htmltext.blocks(h) if b.zone != "side"] for i, _, h in rows}
    assert all(got[i] == "\n\n".join(plain[i][1:]) for i in range(30)) and got[99] == "\n\n".join(plain[99])
