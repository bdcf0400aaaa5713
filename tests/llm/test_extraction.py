"""HTML extraction: main text of unseen layouts, broken pages, and the field against brute force."""

import itertools
import math
import random
import time

import pytest

from finloom.llm import html_extract

PAGES = {
    "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><article><h1>Head &amp; tail</h1><p>One<b> two</b>\n three.<br>Four</p><div class='ad'>Buy this now.</div><p>Last.</p></article><footer>&copy; us</footer></body></html>": "Head & tail\nOne two three. Four\nLast.",
    "<body><div id=header><p>Site of sites</p></div><main><p>Text that counts.</p><form><label>Name</label><button>Send</button></form><p>More of it.</p></main><section class=comments><p>A reader says this is long enough to look like text, is it not?</p></section></body>": "Text that counts.\nMore of it.",
    "<body><div class='cookie-notice'><p>We use cookies.</p></div><div class=content><h1>Title</h1><p>Body text, first part.<p>Second part without an end tag.</div><aside class=sidebar><p>Popular posts of this week and others.</p></aside></body>": "Title\nBody text, first part.\nSecond part without an end tag.",
    "<article><p>a<script>var t='</p><p>no</p>';</script>b &lt;i&gt; &amp;amp;</p><!-- <p>no</p> --><style>x": "ab <i> &amp;",
    "": "",
    None: "",
    "<": "<",
    "<p": "<p",
}


def test_extraction(spark):
    pages = spark.createDataFrame([(i, "u", h, 1) for i, h in enumerate(PAGES)], "page_id int, url string, html string, text int")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    wanted = list(PAGES.values())
    for i in range(6):
        assert got[i] == wanted[i], (i, got[i])
    assert all(got[i] is not None for i in (6, 7))
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_extraction_cuts_no_article_at_silent_tags():
    pages = {
        "<article><p>a</p><svg/><p>b</p></article>": "a\nb",
        "<article><p>a</p><svg width='1' /><p>b</p><svg><text>x</text></svg><p>c</p></article>": "a\nb\nx\nc",
        "<article><p>a</p><math/><p>b</p></article>": "a\nb",
        "<article><p>a</p><svg><path><p>b</p></article>": "a\nb",
        "<article><p>a</p><svg><path><p>b</p><p>c</p><svg></svg></article>": "a\nb\nc",
        "<article><p>a</p><svg><svg/><svg><title>t</title></svg><text>x</text></svg><p>b</p></article>": "a\nt x\nb",
        "<article><p>a</p><svg><foreignObject><p>x</p></foreignObject></svg><p>b</p></article>": "a\nx\nb",
        "<article><p>a</p><template><p>b</p></article>": "a\nb",
        "<article><p>a</p><template><template>x</template>y</template><p>b</p></article>": "a\nb",
        "<article><p>a</p><noscript><p>b</p></article>": "a\nb",
        "<article><p>a</p><noscript><p>b</p></noscript><p>c</p></article>": "a\nb\nc",
        "<article><p>a</p><object data=x><p>b</p></object><p>c</p></article>": "a\nb\nc",
        "<article><p>a</p><object data=x><p>b</p></article>": "a\nb",
        "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p></article>": "Let x=1 hold.",
        "<article><p>a</p><script>b</article>": "a",
    }
    model = html_extract.default_model()
    assert {p: html_extract.main_text(p, model) for p in pages} == pages
    many = "<article>" + "<svg><template>" * 20_000 + "<p>a</p></article>"
    assert html_extract.main_text(many, model) == "a"


def test_extraction_reads_what_pages_leave_open():
    pages = {
        "<head><title>T</title><p>a</p>": None,
        "<article><p>a</p><title>x</title><p>b</p></article>": "a\nx\nb",
        "<article><p>a</p><iframe>framed</iframe><p>b</p></article>": "a\nframed\nb",
        "<article><p>See <svg><path/></svg> this <my-tag>one</my-tag>.</p></article>": None,
        "<article><p>a &lt b</p><p class='x>y'>c</p><p title=\">\">d</p></article>": "a < b\nc\nd",
        "<article><p>one</p><!-- never ended <p>two</p></article>": "one\ntwo",
        "<head><title>no end<body><article><p>a</p></article>": "a",
        "<article><template><p>x</p></template><p>a</p></article>": "a",
        "<article><p>1 < 2</p></article>": "1 < 2",
    }
    model = html_extract.default_model()
    for page, text in pages.items():
        got = html_extract.main_text(page, model)
        assert text is None or got == text, (page, got)


PROSE = "The council met on Tuesday to discuss the bridge. Nobody expected the vote to be so close, and it was put off."
MORE = "Work is to begin in the spring, once the river has fallen. Until then the old bridge stays open for walkers only."
LAYOUTS = [
    f"<div class=x1><h1>Bridge vote put off</h1><p>{PROSE}</p><p>{MORE}</p></div><div class=respond><p>Anna says: great post, thanks for sharing!</p></div>",
    f"<div class=zz><h1>Bridge vote put off</h1><p>{PROSE}</p><p>{MORE}</p></div><div class=bottom-bar>All rights reserved</div>",
    f"<div class=gdpr><p>We use cookies. Accept all cookies.</p></div><section class=q7><h1>Bridge vote put off</h1><p>{PROSE}</p><p>{MORE}</p></section>",
    f"<div class=k><a href=/>Home</a></div><div class=k><a href=/a>Latest news</a></div><div class=w><h1>Bridge vote put off</h1><p>{PROSE}</p><p>{MORE}</p></div>",
    f"<body><header><p>The Daily Page</p></header><main><h1>Bridge vote put off</h1><p>{PROSE}</p><aside><p>Advertisement</p></aside><p>{MORE}</p></main><footer><p>Contact us</p></footer>",
    f"<table><tr><td><a href=/1>Archive</a></td></tr></table><div id=qqq><h1>Bridge vote put off</h1><p>{PROSE}<p>{MORE}</div><ul><li><a href=/2>Read more</a></li><li><a href=/3>Most popular</a></li></ul>",
]


@pytest.mark.parametrize("page", LAYOUTS)
def test_extraction_of_layouts_it_has_not_seen(page):
    assert html_extract.main_text(page, html_extract.default_model()) == f"Bridge vote put off\n{PROSE}\n{MORE}"


def test_extraction_text_decides_where_names_do_not():
    """Without text features the same pages can't be told apart."""
    held, model = html_extract.labelled_pages(200, seed=99), html_extract.default_model()
    blind = html_extract.Crf({f: w for f, w in model.emission.items() if f.startswith(("in:", "name:", "leaf:", "article+", "main+"))}, model.moves)

    def wrong(m):
        pairs = [(m.best([b.score for b in html_extract.blocks(p, m.emission)]), y) for p, y in held]
        return sum(a != b for got, y in pairs for a, b in zip(got, y)) / sum(len(y) for _, y in pairs)

    assert wrong(model) < 0.01 < 0.05 < wrong(blind)


@pytest.mark.parametrize(
    "page",
    ["<a " * 1_700_000, "<div>" * 100_000 + "x", "<div>" * 50_000 + "</p>" * 50_000, '<a x=">" ' * 200_000, "<p>" + "x<template></template>" * 50_000, "<p>" + "x<template>" * 50_000, "<!--" * 300_000, "<script>" * 100_000, "".join(f"<div class=a{i}>t" for i in range(100_000))],
)
def test_extraction_takes_linear_time(page):
    start = time.time()
    html_extract.main_text(page, html_extract.default_model())
    assert time.time() - start < 20


def test_extraction_of_long_texts_and_repeated_rows(spark):
    page = "<article>" + "".join(f"<p>{PROSE}</p>" for _ in range(20_000)) + "</article>"
    rows = html_extract.extract(spark.createDataFrame([(1, page), (1, page)], "page_id int, html string")).collect()
    assert [r.text for r in rows] == ["\n".join([PROSE] * 20_000)] * 2


def test_viterbi_equals_brute_force():
    r = random.Random(8)
    model = html_extract.Crf({f"f{i}": (r.gauss(0, 1), r.gauss(0, 1)) for i in range(6)}, [[r.gauss(0, 1) for _ in "ab"] for _ in "ab"])
    for _ in range(30):
        seq = [[f"f{r.randrange(6)}" for _ in range(r.randint(0, 3))] for _ in range(r.randint(1, 7))]

        def total(labels):
            return sum(sum(model.emission[f][y] for f in fs) for fs, y in zip(seq, labels)) + sum(model.moves[a][b] for a, b in zip(labels, labels[1:]))

        best = max(total(x) for x in itertools.product((0, 1), repeat=len(seq)))
        assert math.isclose(total(model.decode(seq)), best, abs_tol=1e-9)
