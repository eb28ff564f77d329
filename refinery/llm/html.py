"""Main text of web pages: a suffix array over each host's token streams, with structure as the second signal.

A page's blocks are read in one pass. What stands in a menu, footer, advert and the like is out; the
article (else main) is the body; where neither is, all that is not marked is. The token streams of a
host's pages are concatenated and a suffix array finds the strings of LENGTH tokens that repeat across
distinct pages. Unmarked text loses what they cover and keeps its unique runs. Text in weakly marked
wrappers (a class name that may mean anything) stays only where it is long and unique. Blocks of an
article go as a whole where half of the host's pages have them in their articles, as only a template
does; a page that would lose most of its article so is a copy of another page, and keeps it.

A host of more than HTML_IN_CELL bytes is dealt to cells, whose suffix arrays count their own pages;
the counts of equal strings are added up over the cells, so that a host of any size gives the same
result as in one piece. Strings that hold three tokens seen only there repeat nowhere in a cell and stay
out of its suffix array.
"""

from __future__ import annotations

import html as entities
import json
import re
from array import array
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import partitions, stage
from refinery.llm.suffix import common_prefixes, ranges, suffix_array
from refinery.operators.partitioning import spread

#: A string repeats on so many pages of a host; a template's inside articles on so many at least.
LENGTH, PAGES, TEMPLATE = 6, 3, 8
HTML_IN_CELL = 8 << 20
#: Rows of a table that is broadcast to the pages; one of more is joined by shuffling.
MOST_BROUGHT = 500_000

# Elements that break blocks, that never hold text, and words that mark what is not the article.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template svg math iframe object canvas textarea select audio video"
HARD = frozenset("nav footer aside dialog menu head title button".split())
HARD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored menu nav navbar navigation breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices notification popup modal newsletter comment comments commentlist disqus replies respond pagination pager".split()
)
SOFT_WORDS = frozenset("banner promo promotion rail masthead alert overlay subscribe subscription signup share sharing social related recommended recommendations reply widget toolbar legal copyright login search".split())
HARD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
WRAPPERS = frozenset("wrap wrapper container layout page with has no".split())
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + RAW.replace(" ", "|") + r")(?![\w:-])"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attr>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<>]*(?:>|\Z)",
    re.S | re.I,
)
TAG_END = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+")
CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split()}
ATTR = re.compile(r"([\w-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Where a block stands, added to its mark.
ARTICLE, MAIN, OPEN = range(3)
SOFT, EDGE = 3, 6


def _mark(name: str, attr: str, in_article: bool, in_main: bool) -> int:
    """EDGE, SOFT or 0 of an element. Words that say wrapper excuse a weak mark, and a hard one outside of articles, where the element may hold the article."""
    if name in HARD or (name == "header" and not (in_article or in_main)) or (name == "form" and in_article):
        return EDGE
    if not attr or name in ("html", "body", "main"):
        return 0
    found = {k.lower(): (a or b or c) for k, a, b, c in ATTR.findall(attr)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").lower().replace(" ", ""):
        return EDGE
    if found.get("role", "").lower() in HARD_ROLES:
        return EDGE
    words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{found.get('class', '')} {found.get('id', '')}").lower()))
    wraps = bool(words & WRAPPERS)
    if words & HARD_WORDS:
        return 0 if wraps and not in_article else EDGE
    return SOFT if words & SOFT_WORDS and not wraps else 0


class _RawElements:
    """Ends of tags and of elements that never hold text. What was looked for in vain is not looked for again, so all looks together are linear in the page."""

    def __init__(self, page: str) -> None:
        self.page, self.last, self.stuck = page, page.rfind(">"), -1
        self.unclosed: set[str] = set()

    def tag_end(self, at: int) -> int:
        """After the > of the tag whose attributes begin at ``at``, -1 if there is none. A quote without an end means nothing."""
        if at > self.last:
            return -1
        if at > self.stuck:
            end = TAG_END.match(self.page, at).end()
            if end < len(self.page) and self.page[end] == ">":
                return end + 1
            self.stuck = end
        return self.page.find(">", at) + 1

    def close(self, name: str, at: int) -> int:
        """After the element's closing tag, -1 if there is none."""
        if name not in self.unclosed:
            if m := CLOSE[name].search(self.page, at):
                return m.end()
            self.unclosed.add(name)
        return -1


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(place + mark) and text of each block with text in page order: white space is one space, character references are decoded.

    A weak mark or a form around an article or main says nothing of what is inside. Articles in weakly marked
    wrappers are teasers where another article is not in one. A form outside of main is dropped, unless it
    holds more than all other text that is not marked, as one around the whole page does. Linear in the page.
    """
    page = page or ""
    out: list[tuple[int, str]] = []
    # Number of the article that a block is in (0: none), and whether it is in a form.
    of_article: list[int] = []
    in_form: list[bool] = []
    teasers: set[int] = set()
    buffer: list[str] = []
    stack: list[tuple[str, int, int, int]] = []
    open_names: dict[str, int] = {}
    hard = soft = forms = articles = mains = seen = 0
    raw = _RawElements(page)
    at = 0

    def flush() -> None:
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                place = ARTICLE if articles else MAIN if mains else OPEN
                out.append((EDGE if hard else place + (SOFT if soft else 0), text))
                of_article.append(seen if articles else 0)
                in_form.append(forms > 0)

    def close() -> str:
        nonlocal hard, soft, forms, articles, mains
        name, mark, soft, forms = stack.pop()
        open_names[name] -= 1
        hard -= mark == EDGE
        articles -= name == "article"
        mains -= name == "main"
        return name

    while m := TAG.search(page, at):
        if m.start() > at:
            buffer.append(page[at : m.start()])
        at, name, attr = m.end(), (m["name"] or "").lower(), m["attr"] or ""
        if m["raw"]:
            name, end = m["raw"].lower(), raw.tag_end(at)
            if end < 0:
                # The page ends within a tag.
                at = len(page)
                break
            attr = page[at : end - 1]
            if name in ("svg", "math") and attr.endswith("/"):
                at = end
                continue
            after = raw.close(name, end)
            if after >= 0:
                at = after
                continue
            if name in ("script", "style"):
                at = len(page)
                break
            at = end
        if not name:
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            buffer.append(" ")
        if m["end"]:
            while open_names.get(name):
                if stack[-1][0] in BLOCK:
                    flush()
                if close() == name:
                    break
        elif name not in VOID and not attr.endswith("/"):
            if name == "p" or name == "li":
                # An open paragraph or item ends where the next one starts.
                while stack and (stack[-1][0] not in BLOCK or stack[-1][0] == name):
                    close()
            mark = _mark(name, attr, bool(articles), bool(mains))
            if name == "article" and articles and soft:
                mark = EDGE
            stack.append((name, mark, soft, forms))
            open_names[name] = open_names.get(name, 0) + 1
            hard += mark == EDGE
            if name == "article" and not articles:
                seen += 1
                if soft:
                    teasers.add(seen)
            holds = (name == "article" or name == "main") and not articles
            soft, forms = (0, 0) if holds else (soft + (mark == SOFT), forms + (name == "form"))
            articles += name == "article"
            mains += name == "main"
    buffer.append(page[at:])
    flush()
    if not any(kind == ARTICLE and n not in teasers for (kind, _), n in zip(out, of_article)):
        teasers = set()
    size = [sum(len(t) for (kind, t), f in zip(out, in_form) if kind == OPEN and f == inside) for inside in (False, True)]
    wraps_page = size[1] > size[0]
    dropped = [n in teasers or (f and kind != OPEN + SOFT and not (kind == OPEN and wraps_page)) or (f and kind == OPEN + SOFT and not wraps_page) for (kind, _), n, f in zip(out, of_article, in_form)]
    # What a form around the page holds has a weak mark.
    return [(EDGE if gone else OPEN + SOFT if f else kind, text) for (kind, text), gone, f in zip(out, dropped, in_form)]


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))


def body_kind(kinds) -> int:
    """The place that the page's text is in: its article, else its main part, else anywhere."""
    return ARTICLE if ARTICLE in kinds else MAIN if MAIN in kinds else OPEN


class Streams:
    """The token streams of some pages, and for each string of LENGTH tokens on how many different pages it is.

    A block of fewer tokens is filled up, so that it is a string of its own. Hosts do not mix; pages
    of one key count once, those that are not ``counted`` never. With ``least`` above 2, strings on
    fewer pages may count as on one; with ``least`` None nothing is counted.
    """

    def __init__(self, hosts: list[str], keys: list[int], kinds: list, texts: list, least: int | None = 2, counted: list[bool] | None = None) -> None:
        ids: dict[str, int] = defaultdict(count(2).__next__)
        host_ids: dict[str, int] = {}
        page_ids: dict[tuple, int] = {}
        host_of_page, page, within, flat, sizes = [], [], [], array("i"), []
        for h, k, ks, ts, own in zip(hosts, keys, kinds, texts, counted or [True] * len(hosts)):
            k = (k, own)
            if (h, k) not in page_ids:
                page_ids[h, k] = len(page_ids)
                host_of_page.append(host_ids.setdefault(h, len(host_ids)))
            body = body_kind(ks)
            for kind, text in zip(ks, ts):
                words = text.split(" ")
                page.append(page_ids[h, k])
                within.append(kind == body and body != OPEN)
                flat.extend(map(ids.__getitem__, words))
                sizes.append(len(words))
        self.size = np.array(sizes, np.int64)
        self.room = np.maximum(self.size, LENGTH)
        self.begin = np.cumsum(self.room + 1) - self.room - 1
        # Symbol 0 parts the blocks, 1 fills them up.
        t = np.zeros(int((self.room + 1).sum()), np.int32)
        t[ranges(self.begin, self.room)] = 1
        t[ranges(self.begin, self.size)] = np.frombuffer(flat, np.int32) if len(flat) else 0
        block = np.repeat(np.arange(len(sizes), dtype=np.int32), self.room - LENGTH + 1)
        self.at = ranges(self.begin, self.room - LENGTH + 1)
        page, within = np.array(page, np.int64), np.array(within, bool)
        host = np.array(host_of_page, np.int64)[page] if len(page) else page
        real = np.array([own for _, (_, own) in page_ids], bool)
        letters = np.array([0, 1, *[xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in ids]], np.uint64)
        host_names = np.array([xxhash.xxh64_intdigest(h.encode("utf-8", "surrogatepass")) for h in host_ids], np.uint64)
        self.group = np.arange(len(self.at))
        self.pages = real[page[block]].astype(np.int64)
        self.inside = within[block] * self.pages
        first = self.group
        if least is not None and len(self.at):
            first = self._count(t, block, page, within, host, max(len(host_ids), 1), real, least)
        self.host = host[block[first]]
        h = host_names[self.host] if len(first) else np.array([], np.uint64)
        for j in range(LENGTH):
            h = (h ^ letters[t[self.at[first] + j]]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        self.hash = h

    def _count(self, t, block, page, within, host, hosts: int, real: np.ndarray, least: int) -> np.ndarray:
        """Groups equal strings by the suffix array of those that may repeat; the place of each group's first string among ``at``."""
        m = np.uint64(0x9E3779B97F4A7C15)
        gram = np.repeat(host, self.room + 1).astype(np.uint64)[: len(t) - 2]
        for j in range(3):
            gram = (gram ^ t[j : len(t) - 2 + j].astype(np.uint64)) * m
            gram ^= gram >> np.uint64(31)
        _, same, times = np.unique(gram, return_inverse=True, return_counts=True)
        often = np.concatenate([[0], np.cumsum(times[same] >= least)])
        some = np.flatnonzero(often[self.at + LENGTH - 2] - often[self.at] == LENGTH - 2)
        if not len(some):
            return self.group
        # Runs of such strings, with a symbol between; symbols of different hosts differ.
        at = self.at[some]
        head = np.concatenate([[True], at[1:] != at[:-1] + 1])
        start = np.flatnonzero(head)
        size = np.diff(np.append(start, len(at))) + LENGTH - 1
        place = np.cumsum(size + 1) - size - 1
        symbols = np.zeros(int((size + 1).sum()), np.int64)
        source = ranges(at[start], size)
        symbols[ranges(place, size)] = t[source].astype(np.int64) * hosts + np.repeat(host[block[some[start]]], size)
        symbols = np.unique(symbols, return_inverse=True)[1]
        sa = suffix_array(symbols)
        group = np.empty(len(symbols), np.int64)
        group[sa] = np.cumsum(common_prefixes(symbols, sa) < LENGTH)
        mine = np.unique(group[ranges(place, size - LENGTH + 1)], return_inverse=True)[1]
        groups = int(mine.max()) + 1
        where, pages = page[block[some]], len(real)
        own, inner = real[where], real[where] & within[block[some]]
        each = np.unique((mine * pages + where)[own]) // pages
        inner = np.unique((mine * pages + where)[inner]) // pages
        # Groups of several strings come first, then each other string by itself.
        rest = np.ones(len(self.at), bool)
        rest[some] = False
        alone = np.flatnonzero(rest)
        self.group = np.empty(len(self.at), np.int64)
        self.group[some], self.group[alone] = mine, groups + np.arange(len(alone))
        self.pages = np.concatenate([np.bincount(each, minlength=groups), self.pages[alone]])
        self.inside = np.concatenate([np.bincount(inner, minlength=groups), self.inside[alone]])
        return np.concatenate([some[np.unique(mine, return_index=True)[1]], alone])

    def covered(self, chosen: np.ndarray) -> list[np.ndarray]:
        """For each block which of its tokens strings of the chosen groups cover."""
        edge = np.zeros(int((self.room + 1).sum()) + 1, np.int64)
        at = self.at[chosen[self.group]]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + LENGTH, -1)
        mask = np.cumsum(edge) > 0
        return [mask[b : b + n] for b, n in zip(self.begin.tolist(), self.size.tolist())]


def _text(kinds, texts: list[str], repeated: list[np.ndarray], template: list[np.ndarray]) -> str:
    """A page's text, from its blocks and which of their tokens repeat."""
    body = body_kind(kinds)
    if body == OPEN:
        out = []
        for kind, text, gone in zip(kinds, texts, repeated):
            if kind == OPEN or (kind == OPEN + SOFT and len(gone) >= LENGTH):
                left = text if not gone.any() else " ".join(w for w, g in zip(text.split(" "), gone.tolist()) if not g)
                if left:
                    out.append(left)
        return "\n".join(out)
    own = [(n, text) for n, (kind, text) in enumerate(zip(kinds, texts)) if kind == body or (kind == body + SOFT and len(repeated[n]) >= LENGTH and not repeated[n].any())]
    gone = {n for n, _ in own if template[n].all()}
    words = sum(len(template[n]) for n, _ in own)
    if 2 * sum(len(template[n]) for n in gone) > words:
        gone = set()
    return "\n".join(text for n, text in own if n not in gone)


def _pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).tobytes()


def _pack48(h: np.ndarray) -> bytes:
    """Numbers of 48 bits in order: byte by byte, so that the first bytes, which change slowly, take little room."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes())


def _unpack48(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(6, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :6] = raw.T
    return out.view("<u8").ravel()


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html).

    text: the main blocks in page order, joined by newlines, empty if there are none; n_chars: its
    code points. Null html is empty; a null or odd url is host ''. Repeated rows repeat; equal pages
    of a host count once. Strings of a host count over all of its pages, however many cells they are
    dealt to; cells are told apart by a hash of the page, so that no host meets in one task, and the
    copies of a very frequent page by hashes of their rows.
    """
    low48 = np.uint64((1 << 48) - 1)

    def parse(batches):
        """The pages of each cell, read and packed together."""
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in batches:
            found = [[page_id, url, where, key, counted, *zip(*blocks(page))] for page_id, url, where, key, counted, page in zip(*(b[c].tolist() for c in ("page_id", "url", "host", "key", "counted", "html")))]
            cells = b.groupby("cell", sort=False).indices
            info = b.drop_duplicates("cell").set_index("cell")
            yield pd.DataFrame(
                [(cell, int(info.at[cell, "cells"]), int(info.at[cell, "in_host"]), squeeze.compress(json.dumps([found[i] for i in at], ensure_ascii=False).encode())) for cell, at in cells.items()],
                columns=["cell", "cells", "in_host", "body"],
            )

    def unpacked(rows: pd.DataFrame) -> list[tuple]:
        """(page_id, url, host, key, counted, kinds, texts) of each page of a cell."""
        unzip = zstandard.ZstdDecompressor()
        return [(*p[:5], *(p[5:] or [[], []])) for x in rows["body"] for p in json.loads(unzip.decompress(x))]

    def streams(found: list[tuple], least: int | None) -> Streams:
        _, _, hosts, keys, counted, kinds, texts = (list(x) for x in zip(*found))
        return Streams(hosts, keys, kinds, texts, least, counted)

    def tally(rows: pd.DataFrame) -> pd.DataFrame:
        """A cell's strings by shard: their hashes and on how many pages each is; those on one page only without the numbers. Nothing where the cell has whole hosts."""
        out = []
        if rows["cells"].iloc[0] > 1:
            s = streams(unpacked(rows), 2)
            shard = ((s.hash >> np.uint64(48)) * np.uint64(shards) >> np.uint64(16)).astype(np.int64)
            h = s.hash & low48
            code = np.where(s.pages == 1, s.inside, 2)
            order = np.lexsort((h, code, shard))
            both = (shard * 3 + code)[order]
            for part in np.split(order, np.flatnonzero(both[1:] != both[:-1]) + 1):
                c = int(code[part[0]])
                counts = _pack(s.pages[part].astype(np.uint64) << np.uint64(32) | s.inside[part].astype(np.uint64)) if c == 2 else None
                out.append((int(shard[part[0]]), rows["cell"].iloc[0], c, _pack48(h[part]), counts))
        return pd.DataFrame(out, columns=["shard", "cell", "code", "h", "n"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        """To each cell: its strings that are on PAGES pages or more of all cells, with the numbers."""
        h = [_unpack48(x) for x in rows["h"]]
        one = np.uint64(1 << 32)
        n = np.concatenate([np.frombuffer(x, "<u8") if c == 2 else np.full(len(k), one + np.uint64(c), np.uint64) for x, c, k in zip(rows["n"], rows["code"], h)])
        origin = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in h])
        h = np.concatenate(h)
        order = np.argsort(h, kind="stable")
        h, n, origin = h[order], n[order], origin[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        sums = np.repeat(np.add.reduceat(n, first), np.diff(np.append(first, len(h))))
        often = sums >> np.uint64(32) >= PAGES
        h, sums, origin = h[often] | np.uint64(rows["shard"].iloc[0]) << np.uint64(48), sums[often], origin[often]
        order = np.argsort(origin, kind="stable")
        cuts = np.searchsorted(origin[order], np.arange(len(rows) + 1))
        out = [(rows["cell"].iloc[k], _pack(h[order[cuts[k] : cuts[k + 1]]]), _pack(sums[order[cuts[k] : cuts[k + 1]]])) for k in np.flatnonzero(np.diff(cuts))]
        return pd.DataFrame(out, columns=["cell", "h", "n"])

    def clean(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names = ["page_id", "url", "text"]
        if rows.empty:
            return pd.DataFrame({c: [] for c in names})
        # In a cell of a host's several the counts of all of them are given.
        parted = rows["cells"].iloc[0] > 1
        found = unpacked(rows)
        s = streams(found, None if parted else PAGES)
        n, inside = s.pages, s.inside
        if parted:
            in_host = {p[2]: int(rows["in_host"].iloc[0]) for p in found}
            n, inside = np.zeros(len(s.hash), np.int64), np.zeros(len(s.hash), np.int64)
            if len(known):
                h, sums = (np.concatenate([np.frombuffer(x, "<u8") for x in known[c]]) for c in ("h", "n"))
                order = np.argsort(h)
                h, sums = h[order], sums[order]
                mine = ((s.hash >> np.uint64(48)) * np.uint64(shards) >> np.uint64(16)) << np.uint64(48) | s.hash & low48
                place = np.minimum(np.searchsorted(h, mine), len(h) - 1)
                hit = h[place] == mine
                n[hit], inside[hit] = (sums[place] >> np.uint64(32))[hit], (sums[place] & np.uint64(0xFFFFFFFF))[hit]
        else:
            in_host: dict[str, int] = {}
            for where, _ in {(p[2], p[3]) for p in found}:
                in_host[where] = in_host.get(where, 0) + 1
        # Hosts are numbered as they come.
        sizes = np.array([in_host[where] for where in dict.fromkeys(p[2] for p in found)], np.int64)[s.host]
        repeated = s.covered(n >= PAGES)
        template = s.covered((inside >= TEMPLATE) & (2 * inside >= sizes))
        texts, at = [], 0
        for *_, kinds, parts in found:
            to = at + len(parts)
            texts.append(_text(kinds, parts, repeated[at:to], template[at:to]))
            at = to
        return pd.DataFrame({"page_id": [p[0] for p in found], "url": [p[1] for p in found], "text": texts})

    spark = pages.sparkSession
    # Ids travel as text: in a batch with a null, numbers would pass through doubles.
    rows = pages.select(F.col("page_id").cast("string"), "url", host(F.col("url")).alias("host"), "html", F.coalesce(F.xxhash64("html"), F.lit(0)).alias("key"))
    each = rows.groupBy("host", "key").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.octet_length("html"), F.lit(0))).alias("size"), F.min(F.struct("page_id", "url")).alias("first"))
    each = stage(each)
    sized = each.groupBy("host").agg(F.count("*").alias("in_host"), F.sum("size").alias("size"))
    sized = stage(sized.withColumn("cells", F.ceil(F.col("size") / HTML_IN_CELL).cast("int")))
    size = sized.agg(F.sum("size")).first()[0] or 0
    shards = groups = min(max(partitions(spark), -(-size // HTML_IN_CELL)), 1 << 16)
    # Large hosts; and pages whose copies fill a cell: one copy counts, the others are dealt to all of the host's cells.
    large = sized.where("cells > 1").select(F.col("host").alias("_host"), "in_host", "cells")
    copied = each.where(F.col("size") > HTML_IN_CELL // 4).where("n > 1").select(F.col("host").alias("_of"), F.col("key").alias("_key"), F.col("first.page_id").alias("_id"), F.col("first.url").alias("_url"))
    # One row for some megabytes of html each: known to be few, so that pages are not shuffled to meet them.
    large, copied = (F.broadcast(t) if t.count() <= MOST_BROUGHT else t for t in (stage(large), stage(copied)))
    rows = spread(rows).join(large, F.col("host") == F.col("_host"), "left").join(copied, (F.col("host") == F.col("_of")) & (F.col("key") == F.col("_key")), "left")
    counted = F.col("_of").isNull() | (F.col("page_id").eqNullSafe(F.col("_id")) & F.col("url").eqNullSafe(F.col("_url")))
    by = F.when(counted, F.col("key")).otherwise(F.xxhash64("page_id", "url"))
    # Small hosts share a cell; the pages of a large one are dealt to its own, equal ones to the same.
    cell = F.when(F.col("cells") > 1, F.concat_ws("#", F.pmod(by, F.col("cells")), "host")).otherwise(F.concat(F.lit("#"), F.pmod(F.xxhash64("host"), F.lit(groups))))
    dealt = rows.select("page_id", "url", "host", "key", "html", F.coalesce("in_host", F.lit(0)).alias("in_host"), F.coalesce("cells", F.lit(1)).alias("cells"), counted.alias("counted"), cell.alias("cell"))
    packed = dealt.mapInPandas(parse, "cell string, cells int, in_host long, body binary")
    counts = packed.groupBy("cell").applyInPandas(tally, "shard long, cell string, code int, h binary, n binary")
    replies = counts.groupBy("shard").applyInPandas(total, "cell string, h binary, n binary")
    found = packed.groupBy("cell").cogroup(replies.groupBy("cell")).applyInPandas(clean, "page_id string, url string, text string")
    return found.select(F.col("page_id").cast(pages.schema["page_id"].dataType), "url", "text", F.length("text").cast("long").alias("n_chars"))
