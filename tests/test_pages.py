"""Links and texts of small pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fitlens.operators import pages as pg


def page(frame, html, url="https://site.org/a/b.html?x=1#f"):
    return frame([(1, url, html)], "page_id int, url string, html string")


def test_links(frame):
    html = """<script>var a = "<a href='/no'>"</script><!-- <a href="/hidden"> -->
    <a href="/x">one</a><a>two</a><a class=k href='https://h/abs now'>three</a><A HREF="rel/y"><span>Our <b>story</b></span></A>
    <abbr href="/abbr">z</abbr><img src="https://h/i.png"><img src="/local.png"> see https://h/t)."""
    got = rows(pg.links(page(frame, html)))
    assert got == [
        (1, "https://h/abs", "absolute", ""),
        (1, "https://h/i.png", "image", ""),
        (1, "https://h/t", "text", ""),
        (1, "https://site.org/a/rel/y", "relative", "Our story"),
        (1, "https://site.org/x", "relative", ""),
    ]


@pytest.mark.parametrize(
    "base,href,expected",
    [
        ("https://h/a/b?q#f", "c", "https://h/a/c"),
        ("https://h/a/b?q#f", "?z", "https://h/a/b?z"),
        ("https://h/a/b?q#f", "#z", "https://h/a/b?q#z"),
        ("https://h/a/b?q#f", "//o/z", "https://o/z"),
        ("https://h", "c", "https://h/c"),
        ("https://h", "/c", "https://h/c"),
        ("https://h/a", "mailto:x@y", "mailto:x@y"),
    ],
)
def test_joined_url(frame, base, href, expected):
    df = frame([(base, href)], "b string, h string")
    assert df.select(pg.joined_url(F.col("b"), F.col("h"))).first()[0] == expected


def test_about_links(frame):
    found = frame(
        [(1, "https://h/about-us", ""), (1, "https://h/OurStory", ""), (1, "https://h/shop", ""), (1, "https://h/1", "Who we are")],
        "page_id int, url string, label string",
    )
    got = rows(pg.about_links(found).select("url", "pattern"))
    assert got == [("https://h/1", 3), ("https://h/OurStory", 2), ("https://h/about-us", 1)]


def test_page_text(frame):
    html = """<nav><p>one two three four five six seven</p></nav><p>a b c d e f</p><p>short</p>
    <header>x <p>h h h h h h h</p></header><p class="k">g &amp; h &lt;i&gt; j <b>k l</b> m n<p>unclosed but long enough to stay</div>"""
    got = pg.page_text(page(frame, html)).first()["text"]
    assert got.split("\n\n")[0] == "a b c d e f"
    assert got.split("\n\n")[1] == "g & h <i> jk lm n"
    assert got.split("\n\n")[2] == "unclosed but long enough to stay"
    assert pg.page_text(page(frame, "<p>few</p>")).first()["text"] == ""


def test_site_text(frame):
    df = frame([("s", "u2", "two"), ("s", "u1", "one"), ("s", "u2", "two"), ("e", "u", "")], "site string, url string, text string")
    assert rows(pg.site_text(df, "site", "url", "text")) == [("e", 0, None), ("s", 0, "one\ntwo")]


def test_site_text_splits_large_sites(frame):
    df = frame([("hot", f"u{i:03}", "x" * 10) for i in range(200)], "site string, url string, text string")
    got = pg.site_text(df, "site", "url", "text", chars=100).collect()
    assert len(got) > 5 and max(len(r["text"]) for r in got) < 400
    assert sum(r["text"].count("x") for r in got) == 2000


def test_container_text(frame):
    html = """<p class="section-text">outside</p><div class="scrollTarget divider"><div><p class="big section-text">one &amp;
    </p></div><p>no</p><p class='section-text'><i>two</i></p></div><p class="section-text">after</p>"""
    got = rows(pg.container_text(page(frame, html), "page_id", "html", "scrollTarget divider", "section-text"))
    assert got == [(1, "one &\n    two")]
    empty = page(frame, '<div class="scrollTarget divider"><p>no</p></div>')
    assert rows(pg.container_text(empty, "page_id", "html", "scrollTarget divider", "section-text")) == [(1, None)]
    assert pg.container_text(page(frame, "<div>x</div>"), "page_id", "html", "scrollTarget divider", "section-text").count() == 0


def test_first_result(frame):
    html = """<a href="/menu">m</a><div class="results gs-row offset"><a href="https://h/1"><div class="resultsCard-logo-title">
    First &amp; Co</div></a><a href="https://h/2"><div class="resultsCard-logo-title">Second</div></a></div>"""
    args = ("page_id", "html", "results gs-row offset", "resultsCard-logo-title")
    assert rows(pg.first_result(page(frame, html), *args)) == [(1, "https://h/1", "First & Co")]
    assert pg.first_result(page(frame, html), *args, skip=["First & Co"]).count() == 0
    assert pg.first_result(page(frame, "<div>none</div>"), *args).count() == 0


def test_bare_attributes_dots_and_other_schemes(frame):
    got = rows(pg.links(page(frame, "<a href=/bare>x</a><a href='../up'>y</a><a href=mailto:a@b.org>z</a><a href='./c/./d/../e'>w</a>")))
    assert got == [
        (1, "https://site.org/a/c/e", "relative", ""),
        (1, "https://site.org/bare", "relative", ""),
        (1, "https://site.org/up", "relative", ""),
        (1, "mailto:a@b.org", "other", ""),
    ]


def test_sites_without_about_pages_stay(frame):
    df = frame([("s", "u", "text")], "site string, url string, text string")
    sites = frame([("s",), ("t",), ("t",)], "site string")
    assert rows(pg.site_text(df, "site", "url", "text", sites=sites)) == [("s", 0, "text"), ("t", 0, None)]


def test_nested_and_unclosed_elements_and_numbers(frame):
    html = "<nav>a<nav><p>x x x x x x</p></nav><p>y y y y y y</p></nav><p>it&#8217;s &#x41; b c d e &#55296; f</p></aside><NAV id=z><p>z z z z z z z</p>"
    assert pg.page_text(page(frame, html)).first()["text"] == "it\u2019s A b c d e &#55296; f"


def test_url_keys(frame):
    same = ["http://Example.com/a/b%2f?q=%c3#x", "HTTP://example.COM:80/a/./b%2F?q=%C3", " http://example.com/a/c/../b%2F?q=%C3 ", "http://example.com:/../a/b%2F?q=%C3"]
    other = ["https://example.com/a/b%2F?q=%C3", "http://example.com:8080/a", "http://example.com", "http://example.com/?", "http://example.com/A", "mailto:a@b", "/a", "", None, "http:///x"]
    df = frame([(u,) for u in same + other], "u string")
    got = [r[0] for r in df.select(pg.url_key(df["u"])).collect()]
    assert set(got[:4]) == {"http://example.com/a/b%2F?q=%C3"}
    assert got[4:] == ["https://example.com/a/b%2F?q=%C3", "http://example.com:8080/a", "http://example.com/", "http://example.com/", "http://example.com/A", None, None, None, None, None]


def test_about_texts(frame):
    words = "<p>We are a team of six people here</p>"
    pages = [
        ("http://a.com", '<a href="/about">x</a><a href="HTTP://A.com:80/who-we-are#top">x</a><a href="/news">x</a><a href="/about-us">gone</a>'),
        ("http://a.com/about", words), ("http://a.com/about", ""), ("http://a.com/who-we-are", "<p>And this is what we all do</p>"), ("http://a.com/news", "<p>News that nobody should ever read</p>"),
        ("http://b.com/", '<a href="/about">x</a>'), ("http://b.com/about", "<p>short</p>"), ("http://c.com", "none"), (None, words), ("mailto:x", words),
    ]
    sites = [("A", "http://A.com/"), ("A", "http://A.com/"), ("B", "http://b.com"), ("C", "http://c.com"), ("D", "http://d.com"), ("E", None), (None, "http://a.com")]
    out = pg.about_texts(frame(sites, "name string, website string"), frame(pages, "url string, html string"))
    text = "We are a team of six people here\nAnd this is what we all do"
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("A", "http://A.com/", 0, text), ("B", "http://b.com", 0, None), ("C", "http://c.com", 0, None), ("D", "http://d.com", 0, None), ("E", None, 0, None), (None, "http://a.com", 0, text)], key=repr
    )


def test_pages_are_read_once(frame):
    sites = [("s", "http://h/")]
    pages = [("http://h/", '<a href="/about"><span>About us</span></a>'), ("http://h/about", "<p>one two three four five six</p>")]
    out = pg.about_texts(frame(sites, "name string, website string"), frame(pages, "url string, html string"))
    assert "html" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r["text"] for r in out.collect()] == ["one two three four five six"]
