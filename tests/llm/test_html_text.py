"""Main text on whole pages whose article is known."""

import html
import re

import pytest

from nestmeans.llm import html_text
from nestmeans.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def simple(page):
    """The article element of a test page: its blocks, found by plain patterns."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", inner)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_query_matches_known_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = QUERIES["op2_html_text"](spark, DATA).collect()
    assert {r["page_id"] for r in rows} == set(pages)
    for r in rows:
        if "</article>" in pages[r["page_id"]]:
            assert r["text"] == simple(pages[r["page_id"]]), r["page_id"]
        assert r["n_chars"] == len(r["text"])


LONG = "The committee met on Tuesday and agreed that the bridge should be rebuilt before the winter begins. "
CASES = {
    "": "", "   ": "", "<p></p>": "", "plain text": "plain text", "<p>a < b &lt;c&gt; &amp;amp; &#233;": "a < b <c> &amp; é",
    "<p>one<p>two<li>three": "one\n\ntwo\n\nthree",
    "<p>so<b>me</b> <i>bold\n\t text</i></p>": "some bold text",
    "<style>p{}</style><script>if (a<b) document.write('<p>x</p>')</script><p>kept</p>": "kept",
    "<script>never closed <p>x": "",
    "<p>ok</p><!-- <p>gone</p> --><p>end": "ok\n\nend",
    f"<nav><a href=x>Home</a></nav><div class='content'><h1>Title</h1><p>{LONG}</p></div><div id='side-bar' class=\"sidebar left\"><p>{LONG}</p></div><div class=comments><p>{LONG}</p></div><footer>{LONG}</footer>": f"Title\n\n{LONG.strip()}",
    f"<header><h1>Site</h1></header><main><p>{LONG}<p>{LONG}</main><form><p>Name</p></form><aside>{LONG}</aside>": f"{LONG.strip()}\n\n{LONG.strip()}",
    f"<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul><p>{LONG}</p><p><a href=c>Read more</a></p>": LONG.strip(),
    f"<div class='cookie-notice'>{LONG}</div><article><p>{LONG}</p><div class='ad'>Buy!</div><p>Short end.</p></article>": f"{LONG.strip()}\n\nShort end.",
}


@pytest.mark.parametrize("page", list(CASES))
def test_small_pages(page):
    assert html_text.main_text(page) == CASES[page]


def test_table_cases(spark):
    rows = spark.createDataFrame(
        [(1, None, None, "x"), (2, "u", "<p>hi", "y"), (2, "u", "<p>hi", "y"), (3, "v", "<div>" * 5000 + "deep", "z"),
         (None, "w", "<p>" + "word " * 200000, None)],
        "page_id bigint, url string, html string, text string",
    )
    got = sorted(html_text.extract(rows).collect(), key=lambda r: (r["page_id"] is None, r["page_id"]))
    assert [(r["page_id"], r["text"][:4], r["n_chars"]) for r in got] == [
        (1, "", 0), (2, "hi", 2), (2, "hi", 2), (3, "deep", 4), (None, "word", 999999)]
    assert html_text.extract(rows.limit(0)).count() == 0


ONE = LONG.strip()
AD = "<div class='ad'>Buy!</div>"
WRAPPED = {
    f"<div class='page-with-sidebar'><p>{LONG}</p></div>": ONE,
    f"<div class='content no-sidebar'><p>{LONG}</p></div>": ONE,
    f"<div id=main class='post has-comments tags-x'><p>{LONG}</p><div class=comments><p>{LONG * 9}</p></div></div>": ONE,
    f"<form id=aspnetForm><div class=widget><h1>T</h1><p>{LONG}</p></div></form>": f"T\n\n{ONE}",
    f"<article><p>{LONG}</p><h2 id='related-work'>Related work</h2><p class='share-price'>Up.</p><p>{LONG}</p></article>":
        f"{ONE}\n\nRelated work\n\nUp.\n\n{ONE}",
    f"<article><p>{LONG}</p>{AD * 3}<p>Short end.</p></article>": f"{ONE}\n\nShort end.",
    f"<div><p>{LONG}</p>{AD * 4}<p>Short end.</p></div>": f"{ONE}\n\nShort end.",
    f"<article><h1>Title</h1>{AD * 3}<p>{LONG}</p></article>": f"Title\n\n{ONE}",
    f"<article><p>{LONG}</p><p><a href=x>A paragraph that is one link.</a></p><p>{LONG}</p></article>":
        f"{ONE}\n\nA paragraph that is one link.\n\n{ONE}",
    f"<section id='related-work'><p>{LONG}</p></section><section id=comments><p>{LONG}</p></section>": ONE,
    f"<article><p>{LONG}</p><p class='ad'>Buy this.</p><ul><li><a href=a>One</a><li><a href=b>Two</a></ul><p>{LONG}</p></article>": f"{ONE}\n\n{ONE}",
    f"<div class=comments><p>{LONG * 20}</p></div><p>{LONG}</p>": ONE,
    f"<article class='post tag-ads category-social'><p>{LONG}</p></article>": ONE,
}


@pytest.mark.parametrize("page", list(WRAPPED))
def test_articles_in_wrappers(page):
    assert html_text.main_text(page) == WRAPPED[page]


def test_deep_marks_take_linear_time():
    page = "<div class=ad>x" * 20_000 + f"<p>{LONG}"
    assert html_text.main_text(page) == ""


def test_query_without_article_tags(spark):
    """The same pages with the article named by a class, or by nothing."""
    pages = [r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect() if "</article>" in (r["html"] or "")]
    for page in pages:
        for tag, end in (("<div class='layout-with-sidebar'>", "</div>"), ("<div id=main class='post has-comments'>", "</div>"), ("", "")):
            other = page.replace("<article>", tag).replace("</article>", end)
            assert html_text.main_text(other) == simple(page)
