import time

import numpy as np
import pytest

from refinery.llm import html

PAGE = """<!DOCTYPE html><html><head><title>Title</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>hidden</p> --><div class="ad">Buy</div>
<article><h1>Head &amp; line</h1><p><b>First&nbsp;text <i>goes</i> on.<br>more<p>Second &lt;x&gt; &#233;
text</p><aside>aside</aside><div class="share-buttons">Share</div><form>q</form><ul><li>one<li>two</ul><div id="comments"><p>Nice!</p></div></article>
<footer>&copy; me</footer></body></html>"""


def test_article():
    found = html.blocks(PAGE)
    assert [t for k, t in found if k == html.ARTICLE] == ["Head & line", "First text goes on. more", "Second <x> é text", "one", "two"]
    assert [t for k, t in found if k == html.EDGE] == ["Title", "Home", "Buy", "aside", "q", "Nice!", "© me"]
    assert [t for k, t in found if k == html.ARTICLE + html.SOFT] == ["Share"]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</", "&am", "<article>", "</p></p>", "a < b > c", "<p>x</p", "<!-- open", "<script>open", "<p " + "a" * 5000])
def test_broken_pages(page):
    html.blocks(page)


@pytest.mark.parametrize("tag", ["<video-player src='a'></video-player>", "<svg-icon>", "<select-menu>", "<svg/>", "<math a='b' />", "<svg>", "<object data='x'>", "<svg><path/></svg>", "<select:x>"])
def test_raw_names_do_not_swallow_the_page(tag):
    found = html.blocks(f"<article><p>one</p>{tag}<p>two</p></article>")
    assert [t for k, t in found if k == html.ARTICLE] == ["one", "two"]


def test_open_script_hides_the_rest():
    assert html.blocks("<article><p>one</p><script>var x = '<p>two</p>'") == [(html.ARTICLE, "one")]


def test_main_and_hidden():
    assert html.blocks("<main><div hidden>h</div><div style='display: none'>d</div><p>x</p></main>tail") == [(html.EDGE, "h"), (html.EDGE, "d"), (html.MAIN, "x"), (html.OPEN, "tail")]
    assert html.blocks('<div class="content-sidebar-wrap"><p>x</p></div>') == [(html.OPEN, "x")]


@pytest.mark.parametrize("before, after", [("<form action='/'>", "</form>"), ("<div class='search-results'>", "</div>"), ("<div class='legal social'><form>", "</form></div>")])
def test_wrappers_of_an_article_do_not_matter(before, after):
    for tag in ("article", "main"):
        found = html.blocks(f"<body>{before}<{tag}><p>body text</p><form>ask</form></{tag}>{after}</body>")
        assert [t for k, t in found if k < html.SOFT] == ["body text"]


@pytest.mark.parametrize("name", ["comments with-replies", "cookie-notice page", "page-comments", "ad-container", "advert layout", "sidebar wrapper", "newsletter container", "footer-wrap", "comments", "notice"])
def test_wrapper_words_excuse_no_junk_in_an_article(name):
    words = "reader wrote eight words that stand nowhere else"
    found = html.blocks(f"<div class='{name}'><article><p>a</p><div class='{name}'><p>{words}</p></div></article></div>")
    # A wrapper around the article is harmless unless it is plainly no wrapper.
    assert [t for k, t in found if k != html.EDGE] == (["a"] if name not in ("comments", "notice") else [])
    assert (html.EDGE, words) in found


@pytest.mark.parametrize("page", ["<article>main</article><div class='related'><article>teaser other</article></div>", "<div class='related'><article>teaser other</article></div><article>main</article>", "<article>main<div class='related'><article>teaser other</article></div></article>"])
def test_teasers_are_no_article(page):
    assert [t for k, t in html.blocks(page) if k != html.EDGE] == ["main"]


def test_forms_outside_of_articles():
    form = "<form><label>Please leave your address here and we will write to you</label></form>"
    assert [t for k, t in html.blocks(f"<p>{'body text ' * 20}</p>{form}") if k != html.EDGE] == [("body text " * 20).strip()]
    assert [t for k, t in html.blocks(f"<main><p>body</p>{form}</main>") if k != html.EDGE] == ["body"]
    # A form around a page that marks no article.
    assert [t for k, t in html.blocks(f"<form><p>{'body text ' * 20}</p></form><p>x</p>") if k != html.EDGE] == [("body text " * 20).strip(), "x"]


@pytest.mark.parametrize("junk", ["<svg ", "<svg x ", "<video>", "<select>", "<!--", '"', "<!", "<svg '>' ", '<a "', "<svg \"x' ", "</select", '<textarea ">'])
def test_malformed_pages_in_linear_time(junk):
    for around in ("{}", "<article>x{}\">\"</article>"):
        took = []
        for size in (1_000_000, 4_000_000):
            page = around.format(junk * (size // len(junk)))
            began = time.time()
            html.blocks(page)
            took.append(time.time() - began)
        assert took[1] < 8 * took[0] + 2


def test_comments_are_no_article():
    found = html.blocks("<article><p>a</p></article><ol class='commentlist'><li><article><p>me too</p></article></li></ol>")
    assert found == [(html.ARTICLE, "a"), (html.EDGE, "me too")]


def test_deep_pages_in_linear_time():
    page = "<div>" * 16_000 + "</p>" * 16_000 + "<article><p>x</p></article>" + "<b><i>" * 20_000 + "</u>" * 20_000
    began = time.time()
    assert html.blocks(page) == [(html.ARTICLE, "x")]
    assert time.time() - began < 5
    assert html.blocks("<article>" + "<p>word " * 50_000 + "</article>") == [(html.ARTICLE, "word")] * 50_000


def odd_pages(n, seed=0):
    rng = np.random.default_rng(seed)
    pages = []
    for k in range(n):
        kinds = rng.choice([0, 2, 5, 6], rng.integers(0, 6)).tolist()
        pages.append((f"h{rng.integers(0, 2)}", k // 2 if k % 5 == 0 else k, kinds, [" ".join(f"w{rng.integers(0, 3)}" for _ in range(rng.integers(1, 20))) for _ in kinds]))
    return [pages[2 * p[1]] if p[1] != n and k % 5 == 0 and 2 * p[1] < k else p for k, p in enumerate(pages)]


def brute_counts(pages):
    """(host, string) -> its pages, and those that have it in an article; shorter blocks are strings of their own."""
    every, inside = {}, {}
    for host, key, kinds, texts in pages:
        for kind, text in zip(kinds, texts):
            w = text.split(" ")
            for i in range(max(len(w) - html.LENGTH, 0) + 1):
                s = (host, tuple(w[i : i + html.LENGTH]))
                every.setdefault(s, set()).add(key)
                if kind == html.ARTICLE:
                    inside.setdefault(s, set()).add(key)
    return {s: len(x) for s, x in every.items()}, {s: len(x) for s, x in inside.items()}


def test_streams_equal_brute():
    pages = odd_pages(60)
    s = html.Streams(*map(list, zip(*pages)))
    every, inside = brute_counts(pages)
    masks, n = s.covered(s.pages >= html.PAGES), 0
    at = iter(s.group.tolist())
    for host, _, kinds, texts in pages:
        for text in texts:
            w = text.split(" ")
            want = [False] * len(w)
            for i in range(max(len(w) - html.LENGTH, 0) + 1):
                g, key = next(at), (host, tuple(w[i : i + html.LENGTH]))
                assert (s.pages[g], s.inside[g]) == (every[key], inside.get(key, 0))
                if every[key] >= html.PAGES:
                    want[i : i + html.LENGTH] = [True] * len(w[i : i + html.LENGTH])
            assert masks[n].tolist() == want
            n += 1
    assert len(set(s.hash.tolist())) == len(s.pages) == len(every)
    assert len(html.Streams([], [], [], []).pages) == 0


def site(n):
    """Pages of one host: a notice in a plain wrapper inside each article, a passage on two pages, one on three of them, and copies of one article."""
    rng = np.random.default_rng(1)
    words = lambda k: " ".join(f"v{x}" for x in rng.integers(0, 10**9, k))
    notice, rare, few, copied, strip = words(12), words(20), words(20), [words(30) for _ in range(4)], words(9)
    pages, want = [], []
    for k in range(n):
        own = copied if k < 4 else [words(25), *([rare] if k in (7, n - 1) else []), *([few] if k in (8, n // 2, n - 2) else []), words(5)]
        legal = words(14)
        if k % 3:
            pages.append(f"<body><nav>Home</nav><article>{''.join(f'<p>{x}</p>' for x in own)}<div>{notice}</div><div class='legal'>{legal}</div><div class='social'>{strip}</div><div class='share'>Share {k}</div><p>end {k}</p></article></body>")
            want.append("\n".join([*own, legal, f"end {k}"]))
        else:
            pages.append(f"<body><div>{strip}</div>{''.join(f'<p>{x}</p>' for x in own)}<div>{notice} {legal}</div></body>")
            want.append(None)
    return pages, want


@pytest.mark.parametrize("room", [8 << 20, 9_000])
def test_a_host_gives_the_same_in_any_number_of_cells(spark, monkeypatch, room):
    monkeypatch.setattr(html, "HTML_IN_CELL", room)
    pages, want = site(120)
    # Copies of one page do not count; where they fill cells, they are dealt to several.
    copies = [(2**61 + k, f"http://one.example/copy/{k}", pages[10]) for k in range(40)]
    df = spark.createDataFrame([(2**60 + k, f"http://one.example/{k}", p) for k, p in enumerate(pages)] + copies + [(None, "http://one.example/", None)], "page_id long, url string, html string")
    rows = html.extract(df).collect()
    got = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == len(got) and all(got[2**61 + k] == want[10] for k in range(40))
    assert got[None] == ""
    for k, text in enumerate(want):
        if text is not None:
            assert got[2**60 + k] == text, k
    # Without an article: the strip, the notice and the copies go, what is on one or two pages stays.
    assert got[2**60 + 0].count("\n") == 0 and len(got[2**60 + 0].split(" ")) == 14
    assert len(got[2**60 + 9].split("\n")) == 3


def test_extract(spark):
    unmarked = "<body><div>Home About Us Contact Jobs News Help</div><div>short</div><div>own text number {0} of {0} words</div></body>"
    rows = [(i, f"http://a.com/{i}", unmarked.format(i)) for i in range(5)] + [(7, "https://B.com/x?y", PAGE), (7, "https://B.com/x?y", PAGE), (None, None, None), (8, "odd", "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r["page_id"] if r["page_id"] is not None else -1, r["text"], r["n_chars"]) for r in html.extract(df.select("page_id", "url", "html")).collect())
    want = [(i, t := f"own text number {i} of {i} words", len(t)) for i in range(5)]
    article = "\n".join(["Head & line", "First text goes on. more", "Second <x> é text", "one", "two"])
    want += [(7, article, len(article))] * 2 + [(-1, "", 0), (8, "", 0)]
    assert got == sorted(want)
    assert html.extract(df.select("page_id", "url", "html").limit(0)).count() == 0


def test_pages_are_not_shuffled_to_meet_few_rows(spark, tmp_path):
    # Only the packed cells and their counts are shuffled, whatever Spark's own limit for broadcasts says.
    df = spark.createDataFrame([(i, f"http://h{i % 3}/{i}", f"<article><p>text {i}</p></article>") for i in range(20)], "page_id long, url string, html string")
    df.repartition(8).write.parquet(f"{tmp_path}/pages")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = html.extract(spark.read.parquet(f"{tmp_path}/pages"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
        assert {r["page_id"]: r["text"] for r in found.collect()} == {i: f"text {i}" for i in range(20)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
