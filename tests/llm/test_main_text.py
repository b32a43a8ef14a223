"""Main text of pages: the marked article of every page, markup traps, odd rows."""

import html
import re
import time

import pytest

from broadloom.llm import content
from broadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(page):
    """The article by its own tags: for pages whose article holds nothing else."""
    body = re.search(r"<article[^>]*>(.*?)(?:</article>|\Z)", page, re.S).group(1)
    runs = re.split(r"</?(?:p|h[1-6]|div|li|ul)[^>]*>", re.sub(r"</?b>", "", body.replace("<br>", " ")))
    return "\n".join(x for x in (" ".join(html.unescape(r).split()) for r in runs) if x)


def test_query_against_the_marked_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op9_main_text"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


BODY = "".join(f"<p>Paragraph {i} of the story, with several words in it.</p>" for i in range(6))


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("no markup at all", "no markup at all"), ("<p>A &lt;b&gt; &amp;amp; &eacute;</p>", "A <b> &amp; é"),
    ("<nav>a b c d e f g h</nav><p>one</p>", "one"), ("<script>var t='</p><p>x y z';</script><p>one<!-- <p>two --></p>", "one"),
    ("<article><p>See <a href='/x'>this</a> page</p></article>", "See this page"), ("<p>a\n\t b&nbsp;c</p><p> </p><p>d", "a b c\nd"),
    ("<article><h1>T</h1><p>one</p><div class='share-buttons'>Tweet it now</div><p>two</p><section id=comments><p>First comment!</p></section></article>", "T\none\ntwo"),
    ("<aside>x</aside><form><p>name</p></form><p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<p>cut <a href='x", "cut"), ("<ul><li>one<li>two</ul>", "one\ntwo"),
    ("<div class='header'>h</div><p>x<br>y</p>", "x y"), ("<p title='a > b'>kept</p>", "kept"), ("<div data-hidden=1>kept</div><div hidden>gone</div>", "kept"),
])
def test_markup(page, text):
    assert content.extract(page, {}) == text


def test_run_needs_no_article():
    weights = {"p": -0.05, "a": -2.0, "li": -2.0, "div": -0.5, "ul": -1.0}
    links = "<ul>" + "<li><a href='#'>link</a></li>" * 8 + "</ul>"
    assert content.extract(f"<div>{links}</div>{BODY}<div>{links}</div>", weights).count("\n") == 5


@pytest.mark.parametrize(("page", "text"), [
    ("<p>a</p><div style='overflow:hidden'>b</div><p title='hidden gems'>c</p><div data-grid='share'>d</div>", "a\nb\nc\nd"),
    ("<article><p>Read <a href='/x?id=menu'>this report</a> now</p></article>", "Read this report now"),
    ("<div class='site no-sidebar'><p>one two</p></div>", "one two"),
    ("<article><header><h1>Title</h1></header><p>one</p></article>", "Title\none"),
    ("<article><div class='entry-header'>Title</div><p class='notice-board-story'>one</p></article>", "Title\none"),
    ("<header><p>Site name</p></header><p>one</p>", "one"), ("<p>x</p></div><p>y</p>", "x\ny"),
])
def test_attributes_and_headers(page, text):
    assert content.extract(page, {}) == text


LAYOUT = "<body><div class='top-bar'>{a}</div><div class='wrap'><article><h1>T</h1><p>{b}</p></article></div><div class='rail'>{c}</div></body>"


def test_learned_costs_find_content_without_labels(spark):
    """Classes that no list knows, learned from labelled pages; the same layout without <article> is cut alike."""
    def page(i):
        return LAYOUT.format(a="x " * (i % 7 + 1), b="word " * (3 * i + 1), c="more to read " * (i % 3 + 1))

    pages = [page(i) for i in range(40)]
    weights = content.fit_weights(spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id int, html string").repartition(3))
    assert weights["div.top-bar"] < -7 and weights["div.rail"] < -9 and weights["div.wrap"] > -0.01
    for i, p in enumerate(pages):
        want = "T\n" + " ".join(["word"] * (3 * i + 1))
        assert content.extract(p, weights) == want
        assert content.extract(p.replace("article>", "section>"), weights) == want
    assert "more to read" in content.extract(pages[5], {k: 0.0 for k in weights})


def test_the_scan_makes_the_text(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = content.fit_weights(pages)
    texts = [r.html for r in pages.limit(40).collect()]
    right = [content.extract(t, weights) for t in texts]
    monkeypatch.setattr(content, "NAMED", frozenset())
    assert [content.extract(t, weights) for t in texts] == right
    monkeypatch.setattr(content, "best_run", lambda scores: (0, len(scores)))
    assert all(content.extract(t, weights) != r for t, r in zip(texts, right))


def test_deep_nests_take_linear_time():
    start = time.time()
    assert content.extract("<div>" * 100000 + "x", {}) == "x"
    assert content.extract("<p><b>" * 50000 + "x", {}) == "x"
    assert time.time() - start < 3


def test_best_run():
    assert content.best_run([]) == (0, -1) and content.best_run([-1.0, -2.0]) == (0, -1)
    assert content.best_run([1.0, -3.0, 2.0, -1.0, 4.0, -9.0, 5.0]) == (2, 4)


def test_odd_rows(spark):
    rows = [(1, None, None, 7), (1, "u", "<p>x</p>", 8), (1, "u", "<p>x</p>", 8), (None, "u", "<p>" + "word " * 200000, 9)]
    pages = spark.createDataFrame(rows, "page_id bigint, text string, html string, tag int")
    weights = content.fit_weights(pages)
    assert weights == {}
    got = content.main_text(pages, weights)
    assert got.columns == ["page_id", "tag", "text"]
    assert sorted((r.tag, len(r.text)) for r in got.collect()) == [(7, 0), (8, 1), (8, 1), (9, 999999)]
    assert content.main_text(pages.limit(0), weights).count() == 0
