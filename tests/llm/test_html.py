import html
import re
import time
from collections import Counter

import pytest

from annolith.llm import html_extract as h

CASES = [
    ('<div class=menu><a href=x>Home</a></div><div><p>Long paragraph of text here that is the article body.</p><p>Second para.</p></div><div id="comments"><p>Nice!</p></div><footer>c</footer>', "Long paragraph of text here that is the article body.\nSecond para."),
    ('<body><header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav><main><h1>T</h1><p>one<br>two &amp; three<p class="ad">BUY</p><p>four</main><aside>x</aside>', "T\none two & three\nfour"),
    ('<article><h1>A</h1><p>b</p><form><input><p>send</p></form><div class="reader-comments"><p>c</p></div><p>d</p></article>', "A\nb\nd"),
    ('<div class="cookie-notice">We use <article><p>Body</p></article>', "Body"),
    ('<script>var t="</p>";</script><article><p>x &lt; y &#65;</p><!-- <p>no</p> --></article>', "x < y A"),
    ("", ""), (None, ""), ("text only", "text only"), ("<p", ""), ('<p class="x>a</p><p>b</p>', "a\nb"), ("<article><p>cut &am", "cut &am"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_pages(page, text):
    assert h.main_text(page) == text


def test_articles_of_the_corpus(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in h.extract(pages).collect():
        body = re.search(r"<article>(.*?)(</article>|<footer|$)", source[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body.replace("<br>", " ")))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def articles(pages):
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|<footer|$)", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body.replace("<br>", " ")))
        yield r.html, [b for b in blocks if b]


def test_windows_decide_where_no_name_helps(spark):
    """The corpus without article tags, classes and ids: what windows, boxes and link density alone find."""
    right = given = wanted = 0
    for page, blocks in articles(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")):
        bare = re.sub(r'\s(?:class|id|role)=("[^"]*"|[^\s>]+)', "", re.sub(r"</?(?:article|main)[^>]*>", "", page))
        got = h.main_text(bare).split("\n")
        common = sum((Counter(got) & Counter(blocks)).values())
        right, given, wanted = right + common, given + len([x for x in got if x]), wanted + len(blocks)
    assert right / given >= 0.98 and right / wanted >= 0.98, (right / given, right / wanted)


BODY = "<p>" + "</p><p>".join(f"Paragraph {k} of the body has a good many words in it, as bodies do." for k in range(8)) + "</p>"


@pytest.mark.parametrize(
    "page,lost",
    [
        (f"<body><div>Buy now, only today.</div>{BODY}<div>Terms apply.</div></body>", ["Buy now, only today.", "Terms apply."]), (f"<div><a href=x>Home</a> <a href=y>News</a></div><div><h1>Title</h1>{BODY}</div><div>Old text.</div>", ["Home News", "Old text."]),
        (f"<div>{BODY}<ul><li><a href=a>x</a><li><a href=b>y</a><li><a href=c>z</a></ul><p>A last section of the same element, a little way below.</p></div>", ["x", "y", "z"]),
        ("<div>" + "".join(f"<div>{x}</div>" for x in BODY.split("</p>")) + "</div>", []), (f"<table><tr><td><a href=m>Menu</a></td><td>{BODY}</td></tr></table>", ["Menu"]),
    ],
)
def test_pages_without_marks(page, lost):
    got = h.main_text(page).split("\n")
    every = [x.text for x in h.lines(page)]
    assert [x for x in every if x not in got] == lost or [x for x in lost if x in got] == [] and [x for x in every if "Paragraph" in x or "last section" in x or x == "Title"] == [x for x in got if x not in lost]


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "</section>" * 20_000, "<div>" * 20_000 + "</b>" * 20_000, '<b class="ad">' * 20_000 + "<p>x" * 20_000, "<p>x</div>" * 40_000, "<a href='" * 20_000, "<div><p>" * 30_000 + "</div>" * 30_000])
def test_time_is_linear(page):
    began = time.perf_counter()
    h.main_text(page)
    assert time.perf_counter() - began < 3


def test_long_and_broken():
    page = "<div>" * 5000 + "<p>" + "word " * 100_000 + '<a href="' + "<" * 2000
    assert len(h.main_text(page)) > 400_000


def test_surge_and_dive():
    assert h.stretches([0, 0, 5, 0, 7, 0, 0, 0, 0, 9]) == [(2, 5), (9, 10)]
    assert h.stretches([]) == [] and h.stretches([0, -1]) == []


def test_empty_and_extra(spark):
    df = spark.createDataFrame([(1, None, None, 2), (None, "u", "<p>x</p>", 3)], "page_id bigint, url string, html string, text bigint")
    assert sorted((str(r.page_id), r.url, r.text) for r in h.extract(df).collect()) == [("1", None, ""), ("None", "u", "x")]
    assert h.extract(df.where("false")).count() == 0
