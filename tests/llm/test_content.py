"""Main texts of pages: hand-written pages with known articles, whole tables, and odd input."""

from __future__ import annotations

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from stallwise.llm import content

LONG = "This sentence of the article tells what happened, when, and to whom. Nobody had expected it; few were ready."
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News of the day</a></li><li><a href=/c>About</a></li></ul>"


def text(body):
    return content.main_text(f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>")


@pytest.mark.parametrize("body", [
    # Marked articles.
    f"<nav>{MENU}</nav><article><h1>Head</h1><p>{LONG}<p>Short.</article><footer>&copy; 2024</footer>",
    f"<header><h1>The site</h1>{MENU}</header><main><h1>Head</h1><p>{LONG}</p><aside>By the way.</aside><p>Short.</p></main><p>All rights reserved, really.</p>",
    f"<article><header><h1>Head</h1><span>by A. Writer</span></header><p>{LONG}</p><form><label>Mail</label><input></form><p>Short.</p></article>",
    f"<div class='page has-sidebar'><article class=post><h2>Head</h2><p>{LONG}</p><div class='ad-slot'>Buy it, now!</div><p>Short.</p></article></div>",
    f"<article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article><section id=comments><article class=comment><p>{LONG}</p></article></section>",
    f"<article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article><section class=comments><article><p>{LONG}</p></article></section>",
    f"<div class=cookie-notice>We use cookies, as all do. {LONG}</div><article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article>",
    f"<article><h1>Head</h1><script>var a = '</article>';</script><p>{LONG}<button>Like</button></p><p hidden>No</p><p>Short.</article>",
    f"<div id=content role=main><h1>Head</h1><div><p>{LONG}</p></div><p>Short.</p></div><div role=complementary>{LONG}</div>",
    # Nothing is marked: the ratios decide.
    f"<div class=notice>Please note, all of you.</div><div class=story><h1>Head</h1><p>{LONG}</p><p>Short.</p></div><div class=comments><p>{LONG}</p></div>",
    f"<div>{MENU}</div><div class=c1><h2>Head</h2><p>{LONG}</p><p>Short.</p></div><div class=c2>{MENU}</div><p>Copyright</p>",
    f"<table><tr><td>{MENU}</td><td><h2>Head</h2><p>{LONG}</p><p>Short.</p></td></tr></table>",
    f"<form action=/x><div>{MENU}</div><div id=b7><h2>Head</h2><p>{LONG}</p><p>Short.</p></div></form>",
])
def test_article_of_a_page(body):
    assert text(body) == f"Head\n\n{LONG}\n\nShort."


def test_blocks_and_references():
    assert text("<article><p>a&nbsp;&nbsp;b<br>c &lt;d&gt; &#x41;&amp;amp; &zzz; 1 < 2 &am</p><ul><li>x<li>y</ul><pre> l1\n  l2 </pre></article>") == (
        "a b c <d> A&amp; &zzz; 1 < 2 &am\n\nx\n\ny\n\nl1 l2"
    )
    assert text("<article><p>one <b>two<br><p>three</p><!-- <p>no</p> --><p>four<!-->five</article>") == "one two\n\nthree\n\nfourfive"
    assert text("<article><p>He said <a href='/x?a=\"b>c\"'>this</a>, then <i>that</i>.</p></article>") == "He said this, then that."


def test_odd_pages():
    assert content.main_text(None) == content.main_text("") == content.main_text("<p></p>") == content.main_text("<!--") == ""
    assert content.main_text("only text, no tags") == "only text, no tags"
    for page in ("<" * 300_000, "<div>" * 100_000 + "x", "<a href=\"" * 100_000, "<!--" * 300_000, "</div>" * 100_000, "<p><table>" + "<div>" * 50_000, "&" * 300_000):
        start = time.perf_counter()
        content.main_text(page)
        assert time.perf_counter() - start < 10
    words = [f"w{i}," for i in range(300_000)]
    assert text(f"<nav>{MENU}</nav><article><p>{' '.join(words)}</p></article>") == " ".join(words)


def by_pattern(page):
    """The article of a test page, whose markup is regular, cut by patterns."""
    inner = re.search("<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = re.split("</?(?:h1|p)>", inner)
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", b))).split()) for b in blocks]
    return "\n\n".join(filter(None, blocks))


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = content.with_main_text(pages).select("html", "text").collect()
    assert len(rows) == pages.count() and all(r.text == by_pattern(r.html) for r in rows)


def test_rows_stay_as_they_are(spark):
    rows = [(1, "u", f"<article><p>{LONG}</article>"), (1, "u", f"<article><p>{LONG}</article>"), (None, None, None), (2, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("Text", F.lit(1)).withColumn("_html", F.lit("kept"))
    found = content.with_main_text(pages)
    assert found.columns == ["page_id", "url", "html", "_html", "text"]
    assert sorted(map(str, found.select("page_id", "text", "_html").collect())) == sorted(
        f"Row(page_id={i}, text={t!r}, _html='kept')" for i, t in ((1, LONG), (1, LONG), (None, ""), (2, ""))
    )
    assert content.with_main_text(pages.limit(0)).count() == 0
