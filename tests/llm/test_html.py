from __future__ import annotations

import html as entities
import re

import pytest

from ordermill.llm import html_extraction as h
from ordermill.llm import registry

SF = "/root/testdata/sf0.01"


def one(page: str) -> str:
    return h.main_text(h.blocks(page, h._Places()), set())


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article><h1>T</h1><p>a\n <b>b</b>c&nbsp;d<br>e</article>", "T a bc d e"),
        ("<nav>x</nav><div class='ad'>y</div><article>z<p>w</article><footer>f</footer>", "z w"),
        ("<article><p>1<p>2<b>3<br><p>4</p></article>", "1 23 4"),
        ("<script>var t='</p>'; if (a<b) {}</script><p>k</p><style>p{}</style>", "k"),
        ("<div class=\"side-bar sidebar\">s</div><div id=mainContent>m</div><aside>q</aside>", "m"),
        ("<nav><ul><li>open <article>a</article>", "a"),
        ("<article>a<div class=comments>c<p>d</p></div>b</article>", "a b"),
        ("<header>site</header><article><header><h1>T</h1></header>a<form>f</form></article>", "T a"),
        ("<article>1 < 2 &lt;b&gt; &#233; &#x41;</article>", "1 < 2 <b> é A"),
        ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"),
        ("<p title='a>b'>t</p></b></p>", "t"),
        ("<article><p>one</p><svg-icon name='x'></svg-icon><p>two three</p></article>", "one two three"),
        ("<article><p>a</p><title-bar>b</title-bar><template-x/>c<style-guide>d</style-guide><script-1></script-1>e</article>", "a b c d e"),
        ("<article><p>1<svg/>2<svg viewBox='0 > 1' />3<math/>4</p><p>5<svg><path d='M0'/><text>no</text></svg>6</p></article>", "1234 56"),
        ("<article><p>a</p><svg width=1 height=2/><MATH /><p>b</p></article>", "a b"),
        ("<p>k<script src='x>y/'/>var t;</script\n>l</p><style>p{}</style x><p>m</p>", "kl m"),
    ],
)
def test_pages(page, text):
    assert one(page) == text


@pytest.mark.parametrize(
    "page,text",
    [
        # a word of a wrapper's name says nothing about what it holds
        ('<div class="page has-sidebar"><h1>T</h1><p>one two</p></div>', "T one two"),
        ('<div class="layout no-sidebar"><p>one</p><div class="sidebar-left">s</div></div>', "one"),
        ('<body class="search login"><div id="content"><p>one</p></div></body>', "one"),
        # nor does a name that is noise by itself, if the page is in it
        ('<div class="banner"><h1>A long heading</h1><p>and all the text of the page</p></div><p>end</p>', "A long heading and all the text of the page end"),
        ('<div id="banner"><p>the text of the page</p><div class="ads">buy</div></div>', "the text of the page"),
        ('<article><p>a</p><div class="related-work">b</div><div class="search-results">c</div><p id="notice-period">d</p><p class="share-price">e</p></article>', "a b c d e"),
        ('<article><p>all the text</p><div class="related-posts">b</div><ul class="social-share"><li>c</ul><div class="ad-slot">d</div></article>', "all the text"),
        # comments of readers
        ('<article><p>all of the story</p><article class="comment"><p>first!</p></article></article>', "all of the story"),
        ('<article><p>all of the story</p></article><section id="comments"><article><p>first!</p></article><article class="x">b</article></section>', "all of the story"),
        ('<article><p>all of the story</p><div class="reader-comments"><article><header>who</header>b</article></div><p>end</p></article>', "all of the story end"),
        ('<div><p>all of the story here</p></div><div class="comment-list"><article>b</article></div>', "all of the story here"),
        # quotes in odd places
        ('<p class=a">one</p>', "one"),
        ("<p class='a' \">one</p><p title=\"x > y\">two</p>", "one two"),
        ("<p data-x=it's>one</p><p>don't</p>", "one don't"),
        # drawings that are not closed
        ('<article><p>one</p><svg width="1"><path d="M0"><p>two</p></article><footer>f</footer>', "one two"),
        ('<article><p>one<svg><text>no</text></svg> two</p><math><mi>x</mi></article>', "one two"),
        ('<article><svg><foreignObject><p>no</p></foreignObject><text>no</text></svg><p>yes</p></article>', "yes"),
        ('<div><svg><g>no</div><div>yes</div>', "yes"),
    ],
)
def test_names_prompt_and_broken_markup(page, text):
    assert one(page) == text


def test_pages_without_article_on_one_site(spark):
    """Boilerplate without telling names goes by importance alone, on pages that have no article."""
    page = '<div class="layout has-sidebar"><div class="x1"><p>Join our club today.</p></div><div class="x2"><h1>Title {0}</h1><p>Story {0} told.</p></div></div>'
    pages = spark.createDataFrame([(i, "http://s.example/", page.format(i)) for i in range(30)], "page_id long, url string, html string")
    assert {r["text"] for r in h.extract(pages).collect()} == {f"Title {i} Story {i} told." for i in range(30)}


def test_site_noise_goes_and_content_stays(spark):
    site = [
        (i, f"http://a.example/{i}", f"<div><p>We sell all sorts of things.</p></div><section><p>Story {i}</p><p>part {i * 7}</p></section>", 1)
        for i in range(20)
    ]
    copies = [(100 + i, f"http://b.example/{i}", "<div><p>The same article on every page</p></div>", 1) for i in range(30)]
    odd = [(None, None, None, 1), (200, "no url", "<p>x</p>", 1), (201, "http://a.example/", "", 1), (None, None, None, 1)]
    pages = spark.createDataFrame(site + copies + odd, "page_id long, url string, html string, text int").repartition(3)
    for limit in (h.BROADCAST_ROWS, -1):
        h.BROADCAST_ROWS, before = limit, h.BROADCAST_ROWS
        try:
            got = h.extract(pages).collect()
        finally:
            h.BROADCAST_ROWS = before
        by = {r["page_id"]: r["text"] for r in got if r["page_id"] is not None}
        assert len(got) == pages.count()
        assert all(by[i] == f"Story {i} part {i * 7}" for i in range(20))
        assert all(by[100 + i] == "The same article on every page" for i in range(30))
        assert by[200] == "x" and by[201] == "" and [r["n_chars"] for r in got if r["page_id"] is None] == [0, 0]
    assert h.extract(pages.limit(0)).count() == 0


def test_copies_count_once_and_unique_blocks_stay(spark):
    long = "".join(f"<p>Copied paragraph {j}.</p>" for j in range(30))
    copies = [
        f"<script>track({i})</script><div class=ad>ad {i}</div><article class='x'><h1>Copy</h1><p>2026-03-{i % 28 + 1:02}</p>{long}</article>"
        for i in range(60)
    ]
    unique = [f"<article class='x'><h1>Page {i}</h1>" + "".join(f"<p>Own {i} {j}</p>" for j in range(5)) + "</article>" for i in range(40)]
    # the same place holds a line that all pages share, and a page's own line on a few
    lines = [f"<main><h1>T {i}</h1><p>Shared line.</p>" + (f"<p>Own line {i}</p>" if i % 10 == 0 else "") + "</main>" for i in range(40)]
    rows = [(i, "http://c.example/", page) for i, page in enumerate(copies + unique)] + [(1000 + i, "http://d.example/", x) for i, x in enumerate(lines)]
    got = {r["page_id"]: r["text"] for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(60):
        assert got[i] == f"Copy 2026-03-{i % 28 + 1:02} " + " ".join(f"Copied paragraph {j}." for j in range(30))
    for i in range(40):
        assert got[60 + i] == f"Page {i} " + " ".join(f"Own {i} {j}" for j in range(5))
        assert got[1000 + i] == f"T {i}" + (f" Own line {i}" if i % 10 == 0 else "")


def test_templates_are_judged_at_any_share_and_number_of_pages(spark):
    page = "<div class='t{0}'><p>Line of all pages of template {0}.</p></div><section class='s{0}'><p>Story {1} of {0}.</p></section>"
    rows = [(100 * k + i, "http://e.example/", page.format(k, i)) for k in range(3) for i in range(20)]
    for size in range(2, 9):  # small hosts, one template each
        rows += [(1000 * size + i, f"http://n{size}.example/", page.format(0, i)) for i in range(size)]
    # a template of 6 pages on a host of 300
    rows += [(50_000 + i, "http://f.example/", page.format(7, i) if i < 6 else page.format(8, i)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for limit in (h.BROADCAST_ROWS, -1):
        h.BROADCAST_ROWS, before = limit, h.BROADCAST_ROWS
        try:
            got = {r["page_id"]: r["text"] for r in h.extract(pages).collect()}
        finally:
            h.BROADCAST_ROWS = before
        assert all(got[100 * k + i] == f"Story {i} of {k}." for k in range(3) for i in range(20))
        for size in range(2, 9):
            line = "" if size >= 5 else "Line of all pages of template 0. "
            assert all(got[1000 * size + i] == f"{line}Story {i} of 0." for i in range(size))
        assert all(got[50_000 + i] == f"Story {i} of {7 if i < 6 else 8}." for i in range(300))


def test_importance_by_hand(spark):
    rows = [("h", p, 1, 7, 1) for p in range(8)] + [("h", p, 2, 100 + p, 1 + p % 2) for p in range(8)]
    nodes = spark.createDataFrame(rows + rows, "host string, page long, place long, block long, times long")
    got = {r["place"]: r for r in h.importance(nodes).collect()}
    assert got[1]["pages"] == got[2]["pages"] == got[1]["host_pages"] == 8
    assert abs(got[1]["importance"]) < 1e-9
    assert abs(got[2]["importance"] - (0.9 + 0.1 / 3)) < 1e-9


def test_registered_query(spark):
    """The pages' articles, found by their own tags."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = registry.QUERIES["op8_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        expect = " ".join(entities.unescape(re.sub(r"<(p|br|/p|/h1)>", " ", body).replace("<b>", "").replace("<h1>", "")).split())
        assert r["text"] == expect and r["n_chars"] == len(expect)
