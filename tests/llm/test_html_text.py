"""Line-block extraction against the marked article of the pages, and on pages without one."""

import html
import re

import pytest

from tickloom.llm.html_text import extracted, main_text


def marked(page):
    inner = re.sub(r"<!--.*?-->", "", page[page.index("<article>") + 9 : page.index("</article>")], flags=re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in extracted(pages).collect()}
    for page_id, url, page in pages.select("page_id", "url", "html").collect():
        assert got[page_id].text == marked(page)
        assert (got[page_id].url, got[page_id].n_chars) == (url, len(got[page_id].text))


LONG = "word " * 40


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<script>var a='<p>x</p>'</script><style>p{}</style>", ""),
        ("<p>a <b>b</b>\n c<br>d<p>e", "a b c d\ne"),
        ("<article><h1>T</h1><p>x&nbsp;y &#233;&lt;p&gt;</p><aside>no</aside><p>z</p></article><p>out</p>", "T\nx y é<p>\nz"),
        (f"<nav><a href=1>m</a></nav><div id=content><h2>T</h2><p>{LONG}</p><p class='ad'>buy<p>{LONG}<p>end</div><footer>f</footer>", f"T\n{LONG.strip()}\n{LONG.strip()}\nend"),
        (f"<header><h1>Site</h1></header><p>{LONG}</p><div class='post-comments'><div><p>nice</p></div><p>{LONG}</p></div>", LONG.strip()),
        (f"<main><p>{LONG}</p><form><input><p>mail</p></form></main>", LONG.strip()),
        ("<div class=sidebar><article><p>unclosed sidebar</p></article>", "unclosed sidebar"),
        ("<p>a<p hidden>b<p>c</p>", "a\nc"),
        ("<!-- <p>no</p> --><p>1 < 2 & 3 > 2</p><![CDATA[raw]]>", "1 < 2 & 3 > 2\nraw"),
    ],
)
def test_shapes(page, text):
    assert main_text(page) == text


def test_hostile_pages_take_linear_time():
    for page in ("<a b='" * 50_000, "<p>" * 100_000, "<div class=ad>" * 50_000, "<" * 100_000, "<!--" * 50_000, "&" * 100_000, "<script>" * 20_000):
        assert isinstance(main_text(page), str)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "<p>x</p>", "t", 0)] * 2 + [(None, "u", None, "t", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    assert sorted(map(tuple, extracted(pages).collect()), key=str) == [(1, None, "x", 1), (1, None, "x", 1), (None, "u", "", 0)]
    assert extracted(pages.limit(0)).collect() == []
