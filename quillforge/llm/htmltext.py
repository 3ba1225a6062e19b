"""Main text of HTML pages, with a host suffix array against boilerplate.

A page is cut into blocks, each in a zone: ``article`` (inside article or main elements), ``side`` (inside menus,
headers, footers, sidebars, notices, adverts, forms, comments: by element, role, class or id) or ``body`` (the rest).
The token streams of a host's pages, without article blocks, are concatenated, and a suffix array over them finds the substrings of
MIN_RUN tokens or more that two distinct pages or more share. Runs that such substrings cover are boilerplate and go
from ``body`` blocks, of which the unique runs stay; ``side`` blocks go whole. What an article says is never cut, even
where pages share a passage, nor does it make boilerplate of what another page says beside its own: only its side parts go. The text of a
page is its article blocks and the unique runs of its body blocks, in page order. On a page without an article every block is in the streams.

A suffix array over a host's pages is made in one task, so it serves hosts of at most BUCKET_CHARS characters of html. Of
a greater host the same runs are found by a 64-bit hash of each MIN_RUN tokens, dealt by the hash into as many parts as the host
has BUCKET_CHARS: a part has every page's runs of its hashes, and those of two distinct pages go back to their pages by a join.
Both ways give the same result.

Defined results: a null or empty html gives an empty text; a null url is a host of its own; equal rows get one result
each, and equal pages do not count as distinct; an empty table gives no rows. Pages are taken whole.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch
from .words import mix, word_hashes

MIN_RUN, BUCKET_CHARS = 8, 4_000_000
_U = np.uint64
_RUNS = pa.schema([("_h", pa.string()), ("part", pa.int64()), ("runs", pa.binary()), ("pages", pa.binary())])
_OPEN = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>")
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp")}
_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SIDE_TAGS = frozenset("nav footer aside form head menu dialog svg button select object canvas audio video".split())
#: Of a class or id, each name by itself: it ends in a word for a side part, perhaps with one for a box after it; adverts may have any end.
_SIDE_NAME = re.compile(
    r"""(?!(?:no|not|without|with|has)[_-])(?!(?:article|post|entry|story)[_-]header)(?:\w+[_-])*?(?:(?:ads?|advert\w*|sponsor\w*)(?:[_-].*)?|
    (?:banner|sidebar|menu|nav\w*|footer|header|masthead|cookies?|consent|gdpr|notices?|popup|modal|promo\w*|comments?|replies|disqus|share|sharing|social|
    related|recommend\w*|subscribe|newsletter|signup|breadcrumbs?|pagination|pager|widget\w*|toolbar|skip)
    (?:[_-](?:box|bar|list|wrap|wrapper|container|links?|area|section|block|inner|items?|posts?|articles?|form|top|bottom|left|right|main|content|buttons?|\d+))*)$""", re.I | re.X)  # fmt: skip
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SIDE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu".split())
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=\s|$|=)|aria-hidden\s*=\s*["']?true)""", re.I)


@dataclass(slots=True)
class Block:
    zone: str
    text: str


def _is_side(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _SIDE_TAGS or tag == "header" and not in_article:
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTR.findall(attrs):
        value = next(filter(None, values), "")
        if name.lower() == "role" and value.lower() in _SIDE_ROLE or name.lower() != "role" and any(map(_SIDE_NAME.match, value.split())):
            return True
    return bool(_HIDDEN.search(attrs))


def _tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Start, end, whether it closes, name and attributes of each tag, in one pass; comments, and elements of raw text whole, have no name.

    What no ``>`` follows is text. From a tag on whose quotes never close, ``>`` ends a tag within quotes too."""
    at, last, shape = 0, page.rfind(">"), _TAG
    while m := _OPEN.search(page, at):
        at = m.start()
        if at > last and m[0] != "<!--":
            at = page.find("<!--", at)  # no tag ends any more, but a comment goes to the end
            if at < 0:
                return
            yield at, len(page), False, "", ""
            return
        if m[0] == "<!--":
            end = page.find("-->", at + 4)
            end = end + 3 if end >= 0 else len(page)
            yield at, end, False, "", ""
        elif m[0][1] in "!?":
            end = page.index(">", at) + 1
            yield at, end, False, "", ""
        else:
            t = shape.match(page, at)
            if t is None:
                shape = _PLAIN_TAG
                t = shape.match(page, at)
            end, name = t.end(), t[2].lower()
            if not t[1] and name in _RAW and not t[3].endswith("/"):
                close = _RAW[name].search(page, end)
                end = close.end() if close else len(page)
                yield at, end, False, "", ""
            else:
                yield at, end, bool(t[1]), name, t[3]
        at = end


def _closed(page: str) -> set[int]:
    """Where the elements start that are closed before the body ends, counting elements of one name only."""
    out: set[int] = set()
    opened: dict[str, list[int]] = {}
    for start, _, closing, tag, _ in _tags(page):
        if tag and not closing:
            opened.setdefault(tag, []).append(start)
        elif tag in ("body", "html"):
            opened.clear()
        elif opened.get(tag):
            out.add(opened[tag].pop())
    return out


def blocks(page: str | None) -> list[Block]:
    """The page's blocks in order, character references decoded and white space made single spaces; empty ones are left out.

    No tree is built: unclosed elements are common. A side part ends where its own element does, articles within it (comments, say)
    included; one that is never closed ends at the latest where an article begins. Both end where the article around them, or the body, ends."""
    out: list[Block] = []
    parts: list[str] = []
    side, depth, article, at, page = "", 0, 0, 0, page or ""
    start, inner, closed = 0, 0, None

    def flush():
        if parts:
            if text := " ".join(_html.unescape("".join(parts)).split()):
                out.append(Block("side" if side else "article" if article else "body", text))
            parts.clear()

    for begin, end, closing, tag, attrs in _tags(page):
        if begin > at:
            parts.append(page[at:begin])
        at = end
        if not tag:
            continue
        if tag in _BLOCKS:
            flush()
        elif tag == "br":
            parts.append(" ")
        if tag in ("article", "main"):
            if side and not closing:
                closed = _closed(page) if closed is None else closed
                if start in closed:
                    inner += 1
                    continue
            elif side and inner:
                inner -= 1
                continue
            side, depth = "", 0
            article = article + 1 if not closing else max(0, article - 1)
        elif side:
            if tag == side:
                depth += -1 if closing else 1
            if depth == 0 or closing and tag in ("body", "html"):
                flush()
                side, depth = "", 0
        elif not closing and tag not in _VOID and not attrs.endswith("/") and _is_side(tag, attrs, article > 0):
            flush()
            side, depth, start, inner = tag, 1, begin, 0
    parts.append(page[at:])
    flush()
    return out


def repeated(streams: list[np.ndarray], min_run: int = MIN_RUN) -> list[np.ndarray]:
    """For each page's token numbers, which tokens lie in a substring of ``min_run`` tokens or more that another page has too.

    The suffixes of the concatenation are ranked by their first 1, 2, 4, ... tokens up to ``min_run`` (prefix doubling, the last
    step overlapping); suffixes of equal rank start the same substring. Every page ends in a token of its own, so none crosses."""
    sizes = [len(s) for s in streams]
    total = sum(sizes) + len(streams)
    if not total:
        return [np.zeros(0, bool) for _ in streams]
    top = max((int(s.max()) for s in streams if len(s)), default=0) + 1
    rank = np.concatenate([np.append(s, top + i) for i, s in enumerate(streams)]).astype(np.int64)
    page = np.repeat(np.arange(len(streams)), np.array(sizes) + 1)
    rank = np.unique(rank, return_inverse=True)[1]
    length = 1
    while length < min_run:
        step = min(length, min_run - length)
        ahead = np.zeros(total, np.int64)
        ahead[: max(0, total - step)] = rank[step:] + 1
        rank = np.unique(rank * (total + 1) + ahead, return_inverse=True)[1]
        length += step
    order = np.argsort(rank, kind="stable")  # the suffix array; ties by place, so pages rise within a rank
    starts = np.flatnonzero(np.r_[True, np.diff(rank[order]) != 0])
    many = page[order[starts]] != page[order[np.r_[starts[1:], total] - 1]]
    hit = many[rank]
    edge = np.zeros(total + min_run + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + min_run, -1)
    covered = np.cumsum(edge)[:total] > 0
    cuts = np.cumsum(np.array(sizes) + 1)
    return [covered[end - n - 1 : end - 1] for end, n in zip(cuts.tolist(), sizes)]


def long_runs(covered: np.ndarray, min_run: int) -> np.ndarray:
    """Of a block's covered tokens those that go: all, if the whole block is covered; else runs of ``min_run`` or more within it. What is
    covered at its edges only because a menu beside it repeats stays."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    out = np.zeros(len(covered), bool)
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out[lo:hi] = hi - lo >= min(min_run, len(covered))
    return out


def main_text(zones: list[str], texts: list[str], covered: np.ndarray, min_run: int) -> str:
    """Article blocks, and of body blocks the tokens that do not go as repeated, in page order."""
    kept, at = [], 0
    for zone, text in zip(zones, texts):
        if zone == "article":
            kept.append(text)
            continue
        words = text.split(" ")
        if zone == "body":
            left = [w for w, c in zip(words, long_runs(covered[at : at + len(words)], min_run).tolist()) if not c]
            if left:
                kept.append(" ".join(left))
        at += len(words)
    return "\n\n".join(kept)


def host_texts(pages: list[tuple[list[str], list[str]]], min_run: int = MIN_RUN) -> list[tuple[str, int]]:
    """For each page of a host, given as the zones and texts of its blocks: its main text, and how many tokens repeat on other pages."""
    number: dict[str, int] = {}
    streams = [np.fromiter((number.setdefault(w, len(number)) for z, t in zip(zones, texts) if z != "article" for w in t.split(" ")), np.int64) for zones, texts in pages]
    first: dict[bytes, int] = {}
    copy_of = [first.setdefault(xxhash.xxh3_128_digest(" ".join(texts).encode("utf-8", "surrogatepass")), i) for i, (_, texts) in enumerate(pages)]
    own = sorted(set(copy_of))
    covered = dict(zip(own, repeated([streams[i] for i in own], min_run)))
    out = []
    for i, (zones, texts) in enumerate(pages):
        out.append((main_text(zones, texts, covered[copy_of[i]], min_run), int(covered[copy_of[i]].sum())))
    return out


def run_hashes(zones: list[str], texts: list[str], host: str, min_run: int) -> tuple[int, np.ndarray]:
    """64-bit hashes: of a page's tokens, and of each ``min_run`` tokens of its blocks beside the article, in order, on this host."""
    beside = " ".join(t for z, t in zip(zones, texts) if z != "article")
    h, _ = word_hashes([beside.encode("utf-8", "surrogatepass")], fold=False)
    own = _U(xxhash.xxh3_64_intdigest(host.encode()))
    out, length = mix(h + own), 1
    while length < min_run and len(out):
        step = min(length, min_run - length)
        out = mix(mix(out[: max(0, len(out) - step)]) + out[step:])
        length += step
    return xxhash.xxh3_64_intdigest(" ".join(texts).encode("utf-8", "surrogatepass")) - (1 << 63), out.view(np.int64)


def extract_text(pages: DataFrame, min_run: int = MIN_RUN, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """page_id, url, text, n_chars and n_repeated for each row of ``pages`` (page_id, url, html)."""
    scratch = Scratch(pages.sparkSession)
    result = "page_id long, url string, text string, n_chars long, n_repeated long"

    def parts(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                yield part, [blocks(h.as_py()) for h in part.column(2)]

    def cut(batches):
        for part, found in parts(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array([[x.zone for x in p] for p in found], pa.list_(pa.string())), pa.array([[x.text for x in p] for p in found], pa.list_(pa.string()))], names=["page_id", "url", "_h", "zones", "texts"])

    def hashed(batches):
        for part, found in parts(batches):
            of_host: dict[tuple[str, int], list[tuple[int, np.ndarray]]] = {}
            for p, h, n in zip(found, part.column(3).to_pylist(), part.column(4).to_pylist()):
                of_host.setdefault((h, n), []).append(run_hashes([x.zone for x in p], [x.text for x in p], h, min_run))
            rows = []
            for (h, n), each in of_host.items():
                runs = [np.unique(r) for _, r in each]
                page = np.repeat(np.array([p for p, _ in each], "<i8"), [len(r) for r in runs])
                run = np.concatenate(runs)
                to = run % n
                order = np.argsort(to, kind="stable")
                cuts = np.flatnonzero(np.diff(to[order])) + 1
                rows += [(h, int(to[k[0]]), run[k].astype("<i8").tobytes(), page[k].tobytes()) for k in np.split(order, cuts) if len(k)]
            yield pa.RecordBatch.from_pylist([dict(zip(_RUNS.names, r)) for r in rows], schema=_RUNS)

    def shared(group: pa.Table) -> pa.Table:
        run, page = (np.frombuffer(b"".join(group[c].to_pylist()), t) for c, t in (("runs", "<i8"), ("pages", "<i8")))
        order = np.lexsort((page, run))
        run, page = run[order], page[order]
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        sizes = np.diff(np.r_[starts, len(run)])
        hit = np.repeat(page[starts] != page[starts + sizes - 1], sizes)
        run, page = run[hit], page[hit]
        order = np.argsort(page, kind="stable")
        ends = np.split(order, np.flatnonzero(np.diff(page[order])) + 1)
        rows = [(int(page[k[0]]), np.unique(run[k]).tobytes()) for k in ends if len(k)]
        return pa.table([pa.array([group["_h"][0].as_py()] * len(rows), pa.string()), pa.array([p for p, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.binary())], names=["_h", "page", "runs"])

    def named(batches):
        for part, found in parts(batches):
            keys = [run_hashes([x.zone for x in p], [x.text for x in p], h, min_run)[0] for p, h in zip(found, part.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(keys, pa.int64()), pa.array([[x.zone for x in p] for p in found], pa.list_(pa.string())), pa.array([[x.text for x in p] for p in found], pa.list_(pa.string()))], names=["page_id", "url", "_h", "page", "zones", "texts"])

    def finish(batches):
        for b in batches:
            out = []
            for h, zones, texts, many in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(5)):
                runs = run_hashes(zones, texts, h, min_run)[1]
                hit = np.isin(runs, np.frombuffer(b"".join(many.as_py() or []), "<i8"))
                n = sum(t.count(" ") + 1 for z, t in zip(zones, texts) if z != "article")
                edge = np.zeros(n + min_run + 1, np.int64)
                at = np.flatnonzero(hit)
                edge[at] += 1
                edge[at + min_run] -= 1
                covered = np.cumsum(edge)[:n] > 0
                out.append((main_text(zones, texts, covered, min_run), int(covered.sum())))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([t for t, _ in out], pa.string()), pa.array([len(t) for t, _ in out], pa.int64()), pa.array([n for _, n in out], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_repeated"])

    def per_host(group: pa.Table) -> pa.Table:
        found = host_texts(list(zip(group["zones"].to_pylist(), group["texts"].to_pylist())), min_run)
        return pa.table([group["page_id"], group["url"], pa.array([t for t, _ in found], pa.string()), pa.array([len(t) for t, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_repeated"])

    host = F.coalesce(F.lower(F.regexp_extract("url", "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("_h"))
    # Great hosts, by a pass over the lengths alone: no more than all characters by BUCKET_CHARS.
    great = scratch.save(source.groupBy("_h").agg(F.ceil(F.sum(F.coalesce(F.length("html"), F.lit(0))) / bucket_chars).alias("n")).where("n > 1"), "great")
    few = source.join(F.broadcast(great), "_h", "left_anti").select("page_id", "url", "html", "_h")
    whole = few.mapInArrow(cut, "page_id long, url string, _h string, zones array<string>, texts array<string>").groupBy("_h").applyInArrow(per_host, result)
    if not great.take(1):
        return whole
    many = source.join(F.broadcast(great), "_h").select("page_id", "url", "html", "_h", "n")
    runs = many.mapInArrow(hashed, "_h string, part long, runs binary, pages binary")
    found = scratch.save(runs.groupBy("_h", "part").applyInArrow(shared, "_h string, page long, runs binary").groupBy("_h", "page").agg(F.collect_list("runs").alias("runs")), "runs")
    cut_up = many.mapInArrow(named, "page_id long, url string, _h string, page long, zones array<string>, texts array<string>")
    return whole.unionAll(cut_up.join(found, ["_h", "page"], "left").select("page_id", "url", "_h", "zones", "texts", "runs").mapInArrow(finish, result))
