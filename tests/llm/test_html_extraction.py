from __future__ import annotations

import html
import re
import time

import pytest

from duesight.llm import html_extraction as H
from duesight.llm.queries import QUERIES
from tests.llm.conftest import SMALL


def plain(page):
    """The text of the only article, which has no elements but h1, p, b and br."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("</?(?:p|br|h1)>", " ", body))).split())


def test_given_pages(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = QUERIES["op3_html_extraction"](spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == plain(rows[r.page_id].html) and r.n_chars == len(r.text) and r.url == rows[r.page_id].url


def site(body, i):
    return (
        f'<!DOCTYPE html><html><head><title>T{i}</title><style>x</style><script>if (a<b) "<p>no</p>"</script></head><body class="with-sidebar">'
        f'<div class="cookie-notice">We use cookies {i}</div><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>'
        f'<div id="content">{body}</div><aside>Read {i} more</aside><form>Your mail <input></form>'
        f'<div class="comments"><p>First comment of a reader {i}, which is long enough to be counted.</p></div><footer>&copy; 2001</footer></body></html>'
    )


def test_template_without_article(spark):
    """The main slot is found by its text, not by its name."""
    bodies = [f"<h2>Head {i}</h2><p>Body   of\n page {i} &amp; more text, long <b>enough</b>ly written.<ul><li>one<li>two</ul>last &lt;tag&gt;" for i in range(6)]
    rows = [(i, f"HTTP://Host.example/{i}".lower(), site(b, i)) for i, b in enumerate(bodies)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == f"Head {i} Body of page {i} & more text, long enoughly written. one two last <tag>"


def extracted(spark, make, n=6):
    rows = [(i, f"http://host.example/{i}", f"<html><body>{make(i)}</body></html>") for i in range(n)]
    found = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(found)]


def test_all_slots_stay(spark):
    """Without an article, every slot that isn't furniture is text, however small, and links around it don't count."""
    make = lambda i: (
        f'<div class=page><div class=menu>{"<a href=/>Menu entry</a> " * 30}</div><div class=links>{f"<a href=/>Other {i}</a>" * 30}</div>'
        f'<div class=content><div class=text>{f"first {i} " * 70}</div><div class=part-two>{f"second {i} " * 30}</div></div></div>'
    )
    assert extracted(spark, make) == [" ".join(["first", str(i)] * 70 + ["second", str(i)] * 30) for i in range(6)]


def test_places_that_repeat_count(spark):
    """Paragraphs that are div, section, ul or table elements count for the place around them."""
    for tag, inner in (("div", "{}"), ("section", "{}"), ("ul", "<li>{}"), ("table", "<tr><td>{}")):
        parts = lambda i: [f"Paragraph {k} of page {i}, long enough." for k in range(20)]
        body = lambda i: "".join(f"<{tag}>{inner.format(p)}</{tag}>" for p in parts(i))
        assert extracted(spark, lambda i: f"<div class=tagline>Tag line {i}</div><div class=content>{body(i)}</div>") == [" ".join([f"Tag line {i}", *parts(i)]) for i in range(6)]
        assert extracted(spark, lambda i: f"<div class=tagline>Tag line {i}</div><article>{body(i)}</article>") == [" ".join(parts(i)) for i in range(6)]


def test_vectors_make_classes(spark):
    rows = [(i, "http://h/x", "<html><body><div class=a>x</div>" + "<section>y</section>" * (i % 2) + "<div class=b>z</div></body>") for i in range(8)]
    stats = H.tokens(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", "url", "html").collect()
    mark = {r.place: (r.a, r.b, r.pages) for r in stats}
    assert mark["html/body/div.a"] == mark["html/body/div.b"] == mark["html/body"]
    assert mark["html/body/section"] != mark["html/body"] and mark["html/body/section"][2] == 4


def test_awkward_pages(spark):
    rows = [
        (1, None, None), (2, "no url", ""), (3, "http://a/", "plain text, no tags"), (4, "http://a/", "<article>a <b>b"), (None, "http://b/", "<p>x<!-- open <p>y"),
        (5, "http://b/", "<body>" + "<div>" * 500 + "deep" + "</div>" * 500), (6, "http://c/", "a < b &amp; c > d <3"), (6, "http://c/", "a < b &amp; c > d <3"),
        (7, "http://d/", "<script>never closed <article>x</article>"), (8, "http://e/", "<article>" + "word " * 50_000 + "</article>"), (9, "http://f/", "<<<<" * 50_000),
        (10, "http://g/", "<article><header><h1>T</h1></header><p>x\x00y</p><div class='comment'>no</div></article>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS place", "2 AS main", "3 AS text", "4 AS drop")
    out = H.extract(pages).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(rows)
    assert got[1] == got[2] == got[7] == ""
    assert got[3] == "plain text, no tags" and got[4] == "a b" and got[None] == "x" and got[5] == "deep"
    assert got[6] == "a < b & c > d <3" and got[8] == ("word " * 50_000).strip() and got[10] == "T x y"
    assert H.extract(pages.filter("false")).collect() == []


def text_in(page):
    return "".join(text for _, text, _ in H.pieces(page) if text != "\0")


def test_signs_in_quoted_attributes():
    assert text_in('<p title="a > b">Hello</p>') == "Hello"
    assert text_in("<p title='a > b' class=x>Hello</p> it's <b>so</b>") == "Hello it's so"
    assert text_in('<p title="open>one</p><p>two') in ("one" + "two", "onetwo")
    assert text_in("a <b> c") == "a  c" and text_in("1 < 2 <a x") == "1 < 2 <a x"
    assert text_in("x</p") == "x" and text_in("x<!-- y") == "x" and text_in("<math><mi>k</mi></math>") == "k"


def test_names_of_furniture():
    for name in ("sidebar", "left-sidebar", "site-header", "cookie-notice"):
        assert H.is_furniture(f"body/div.{name}")
    for name in ("content with-sidebar", "article-header", "has-sidebar", "post-header"):
        assert not H.is_furniture(f"body/div.{name}")
    assert [p for p, _, _ in H.pieces('<div data-id="notice" class="text">x</div>') if p][0] == "div.text"


@pytest.mark.parametrize("part", ["<a ", "<a b=\">\" ", "<p title='", "</p", "<!-", "<a href=\"x>", "<div class=\"a\">"])
def test_broken_pages_stay_linear(part):
    started = time.perf_counter()
    for _ in H.pieces(part * (200_000 // len(part))):
        pass
    assert time.perf_counter() - started < 3
