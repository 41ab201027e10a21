import html
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qaflow.llm import wrapper_html as w
from tests.conftest import SF_SMALL

SCHEMA = "page_id long, url string, html string, text string, n_chars int, host string, salt int, digest int"
PAGE = """<!doctype html><html><head><title>T {0}</title><style>p{{}}</style></head><body class="has-sidebar"><div class="top"><span>The Daily</span></div>
<div id=wrap><div class=x>{1}<div>All rights reserved by the paper</div></div><ul><li><a href=/a>One {0}</a><li><a href=/b>Two</a></ul></div></body></html>"""


def plain(page):
    """What the tables' simple pages hold: the blocks of their article element."""
    body = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", body[1] if body else "")
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "br" in p else "", p)).split()) for p in parts]
    return "\n\n".join(p for p in parts if p)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "h", 2, 3) for r in rows], SCHEMA)
    return sorted(((r.page_id, r.url, r.text, r.n_chars) for r in w.extract(df).collect()), key=str)


def test_whole_table_against_plain_extraction(spark):
    pages = duckdb.sql(f"select page_id, url, html from '{SF_SMALL}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in w.query(spark, SF_SMALL).collect()}
    assert len(got) == len(pages)
    for i, url, page in pages:
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, plain(page), len(plain(page)))


def test_template_of_a_host_goes_and_slots_stay(spark):
    rows = [(i, f"https://Host.example:80/{i}", PAGE.format(i, f"<p>Words of page {i}.</p><div>More &amp; more {i}</div><p>tail<br>of {i * i}")) for i in range(8)]
    for i, _, text, n in run(spark, rows):
        assert text == f"Words of page {i}.\n\nMore & more {i}\n\ntail of {i * i}" and n == len(text)


def test_copies_are_not_template(spark):
    page = PAGE.format(1, "<p>The same words on every copy of this page, " + "word " * 40 + "</p>")
    got = run(spark, [(i, "http://h.example/", page) for i in range(5)])
    assert len({t for _, _, t, _ in got}) == 1 and "The same words" in got[0][2]


def test_a_passage_that_articles_share_stays(spark):
    rows = [(i, "http://h.example/", f"<nav>x</nav><article><h1>Title {i}</h1><p>Licensed to all.</p><p>{f'text{i} ' * 20}</p><div class=share>Tell a friend</div></article>") for i in range(6)]
    assert all("\n\nLicensed to all.\n\n" in t and "friend" not in t for _, _, t, _ in run(spark, rows))


def test_parts_that_are_not_article():
    page = """<body><header>H</header><div class="cookie-notice">C</div><main><article class="post with-sidebar"><h1>Title</h1><p>One <b>two</b>&nbsp;&lt;three&gt;
      four<p>five<aside>A</aside><form><input>F</form><script>var s="</p>";</script><div class="adSlot">Buy</div><ul><li>six<li>seven</ul></article>
      <section id="comments"><article><p>A very long comment, longer than the article itself, by far, by far, by far</p></article></section></main><footer>F</footer>"""
    assert w.main_text(page) == "Title\n\nOne two <three> four\n\nfive\n\nsix\n\nseven"


def test_defined_cases(spark):
    assert run(spark, []) == []
    rows = [(1, "http://h/", None), (2, "http://h/", ""), (3, None, "<p>a"), (None, "no url", "b < c &am"), (3, None, "<p>a")]
    assert run(spark, rows) == sorted([(1, "http://h/", "", 0), (2, "http://h/", "", 0), (3, None, "a", 1), (None, "no url", "b < c &am", 9), (3, None, "a", 1)], key=str)


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "deep", "<p>x</p><div>y</div>" * 20_000, "<!--" * 50_000, "<a href='" * 20_000, "</b>" * 50_000 + "<b>" * 50_000, "&amp" * 50_000 + "<"])
def test_very_long_and_broken_pages(page):
    assert isinstance(w.main_text(page, [page + "<p>z", "<p>q</p>" + page]), str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "a b", "<li>", "<ul>", "</ul>", "<b>", "</b>", "<!--", "-->", "<", "&lt;", "<article>", "<table>", "<td>", "<script>", "é"]), max_size=25).map("".join))
def test_any_markup_gives_trimmed_blocks(page):
    text = w.main_text(page, [page + "<p>more</p>", "<div>" + page])
    assert text == "" or all(b and b == " ".join(b.split()) for b in text.split("\n\n"))
