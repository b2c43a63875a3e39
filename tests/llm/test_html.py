"""Extraction on constructed pages, cuts against trying all labellings, odd markup."""

import itertools
import re
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchpoint.llm import html

ZERO = np.zeros(html.FEATURES)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html.train(pages)
    got = {r["page_id"]: r["text"] for r in html.main_text(pages, weights).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*)</article>", row["html"], re.DOTALL)
        parts = re.split(r"</?(?:p|h1)>", article[1] if article else "")
        plain = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        assert got[row["page_id"]] == "\n".join(p for p in plain if p)


@pytest.mark.parametrize(("page", "expected"), [
    (None, ""), ("", ""), ("   ", ""), ("<html><head><title>t</title></head></html>", ""),
    ("<article><p>a &lt;b&gt; &eacute;&#233;&amp</p></article>", "a <b> éé&"),
    ("<article>one<br>two <b>th</b>ree\n\t four</article>", "one two three four"),
    ("<nav>menu</nav><main><p>first<p>second<ul><li>x<li>y</ul></main><footer>foot</footer>", "first\nsecond\nx\ny"),
    ("<article><p>text<div class='ad-box'>buy</div><p>more</article>", "text\nmore"),
    ("<article><p>text</p><section class=comments><p>nice one</p></section></article>", "text"),
    ("<article><script>if(a<b){'</p>'}</script><style>p{}</style><p>kept</p><!-- <p>gone</p> --></article>", "kept"),
    ("<article><p title='a>b'>q</p><form><input><button>Send</button></form></article>", "q"),
    ("<article><p>1 < 2 and <unknown>tag</unknown></p><p hidden>secret</p></article>", "1 < 2 and tag"),
    ("<aside>s</aside><article><h1>Head</h1><p>Body.</article><div id='cookie-notice'>ok?</div>", "Head\nBody."),
])
def test_small_pages(page, expected):
    assert html.extract(page, ZERO) == expected


ARTICLE = "<article><h1>Head</h1><p>The text of the page, at length.</p></article>"


@pytest.mark.parametrize(("page", "expected"), [
    (f'<div class="layout has-sidebar">{ARTICLE}<div class="sidebar"><p>side</p></div></div>', "Head\nThe text of the page, at length."),
    (f'<div id="page" class="no-ads"><nav>menu</nav>{ARTICLE}<div class="related-posts"><article><p>teaser</p></article></div></div>', "Head\nThe text of the page, at length."),
    (f'<div class="no-ads"><main><div class="with-toc">{ARTICLE}</div></main></div><div class="comments"><article><p>{"a comment " * 20}</p></article></div>', "Head\nThe text of the page, at length."),
    (f'<div class="comments">{ARTICLE}</div>', ""),
])
def test_names_of_wrappers_do_not_silence_the_article(page, expected):
    assert html.extract(page, ZERO) == expected


def test_wrapper_without_article_is_judged_by_its_blocks():
    blocks = html.blocks_of('<div class="has-sidebar"><div><p>The text of the page, at length.</p></div><div class="sidebar"><p>side</p></div></div>')
    assert [b.element.place for b in blocks] == [0.0, -6.0]


def test_cut_is_the_cheapest_labelling():
    source = np.random.default_rng(5)
    for _ in range(60):
        n = int(source.integers(1, 8))
        odds = np.round(source.normal(0, 2, n), 2).tolist()
        edges = [(int(a), int(b), round(float(source.uniform(0, 2)), 2)) for a, b in source.integers(0, n, (6, 2)) if a != b]

        def cost(keep):
            return sum(max(o, 0) if not k else max(-o, 0) for o, k in zip(odds, keep, strict=True)) + sum(w for a, b, w in edges if keep[a] != keep[b])

        best = min(cost(k) for k in itertools.product((False, True), repeat=n))
        assert abs(cost(html.minimum_cut(odds, edges)) - best) < 1e-6


def test_tables(spark):
    rows = [(1, "u", "<article><p>a</p></article>"), (1, "u", "<article><p>a</p></article>"), (None, None, None), (2, "v", "<article>" + "<p>word. </p>" * 3000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("mine")).withColumn("n_chars", F.lit("x"))
    got = sorted((tuple(r) for r in html.main_text(pages, html.train(pages)).collect()), key=repr)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, "v", "\n".join(["word."] * 3000), 17999)], key=repr)
    assert html.main_text(pages.where("false"), html.train(pages.where("false"))).count() == 0
