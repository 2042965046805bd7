from __future__ import annotations

import html
import re
import time

import pytest

from tidemark.llm import extraction, queries

LONG = "This paragraph of the story is long enough to make the window sums surge well over their level, as it should."


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op5_extraction(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r.page_id].html
        article = page[page.index("<article>") + 9 : page.rindex("</article>")]
        blocks = [re.sub("<[^>]*>", "", x.replace("<br>", " ")) for x in re.split("</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(x).split()) for x in blocks]
        assert r.text == "\n\n".join(x for x in blocks if x)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("no markup at all", "no markup at all"),
        (f"<nav><a href=x>Home</a></nav><p>{LONG}</p><p>Short end.</p><footer>c</footer>", f"{LONG}\n\nShort end."),
        (f"<article><h1>A &amp; B</h1><p>{LONG}<p>x &lt; y<br>z</article><aside>{LONG}</aside>", f"A & B\n\n{LONG}\n\nx < y z"),
        (f"<div class='sidebar'>{LONG}</div><main><p>{LONG}</p></main><div id=comments><article class=comment>{LONG}</article></div>", LONG),
        (f"<article><p>{LONG}</p><div class='ad-box'><p>{LONG}</p></div><p>End</p></article>", f"{LONG}\n\nEnd"),
        (f"<header><p>{LONG}</p></header><article><header><h1>Title</h1></header><p>One <b>bold</b>word.</p></article>", "Title\n\nOne boldword."),
        (f"<script>var t='<p>{LONG}</p>';</script><style>p{{}}</style><p>{LONG}</p><!-- <p>no</p> -->", LONG),
        (f"<article><p>{LONG}", LONG),
        (f"<div class=ad>Buy<article><p>{LONG}</p></article>", LONG),
        (f"<form><p>{LONG}</p></form><p>{LONG} <a href='a>b'>link</a></p>", f"{LONG} link"),
        ("<ul>" + "<li><a href=x>Some linked entry of a menu</a></li>" * 20 + f"</ul><p>{LONG}</p><hr><p>{LONG}</p>", f"{LONG}\n\n{LONG}"),
        ("<p", ""),
    ],
)
def test_pages(page, text):
    assert extraction.main_text(page) == text


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, f"<p>{LONG}</p>", "x"), (2, "v", f"<p>{LONG}</p>" * 3000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(tuple(r) for r in extraction.extracted(pages).where("page_id is not null").collect())
    assert got[0] == got[1] == (1, "u", "", 0)
    assert got[2][2] == "\n\n".join([LONG] * 3000)
    assert extraction.extracted(pages.limit(0)).count() == 0
    assert extraction.extracted(pages.where("page_id is null")).first().text == LONG


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><div class='content has-sidebar'><p>{LONG}</p><p>End.</p></div></body>", f"{LONG}\n\nEnd."),
        (f"<div id='page' class='fixed-header'><p>{LONG}</p><div class=sidebar>x</div><p>End.</p></div>", f"{LONG}\n\nEnd."),
        (f"<article class='post tag-social'><p>{LONG}</p></article>", LONG),
        (f"<div class='widget'><article><p>{LONG}</p></article></div><div class='comments'><p>c</p></div>", LONG),
        (f"<div class='widget'><p>{LONG}</p><p>{LONG}</p></div><article><p>{LONG} b</p></article>", f"{LONG} b"),
        (f"<div class='layout--sidebar'><p>{LONG}</p></div><p>{LONG}</p><p>{LONG}</p>", f"{LONG}\n\n{LONG}\n\n{LONG}"),
        (f"<article><p class=byline>By A<p>{LONG}<p>End.</article><p>{LONG}</p>", f"{LONG}\n\nEnd."),
        (f"<article><p class=byline>By A<div>{LONG}</div></article>", LONG),
        (f"<article><ul><li class=share>Send<ul><li>on<li>off</ul><li>{LONG}</ul><p>End.</article>", f"{LONG}\n\nEnd."),
        (f"<table><tr><td class=sidebar>Menu<td>{LONG}<tr><th class=ad>Buy<td>{LONG}</table>", f"{LONG}\n\n{LONG}"),
        (f"<article><dl><dt class=ad>Buy<dd>{LONG}</dl><p>End.</article>", f"{LONG}\n\nEnd."),
        (f"<article><div class=intro><p class=byline>By A</div><p>{LONG}</article>", LONG),
        (f"<body><div class=ad>Buy<article><p>{LONG}</p></article></body>", LONG),
    ],
)
def test_names_and_left_out_ends(page, text):
    assert extraction.main_text(page) == text


def bare(page):
    """A page without its class, id and role attributes, its semantic elements made plain ones."""
    page = re.sub(r"<(/?)(?:article|main|nav|header|footer|aside|section)\b[^>]*>", r"<\1div>", page)
    return re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)


def test_sums_alone_find_the_articles(spark):
    """With names, roles and semantic elements stripped: precision and recall in characters."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    found = right = wanted = 0
    for page in pages:
        got, true = (set(extraction.main_text(x).split("\n\n")) for x in (bare(page), page))
        found += sum(map(len, got))
        wanted += sum(map(len, true))
        right += sum(map(len, got & true))
    assert right / found > 0.97 and right / wanted > 0.99, (right / found, right / wanted)


def test_names_do_not_overrule_the_sums():
    """A part that names call another one, but of which the page consists, is what the sums find."""
    story = f"<p>{LONG}</p>" * 4
    assert extraction.main_text(f"<div class=menu-page>{story}</div><div class=box><p>Short.</p></div>") == "\n\n".join([LONG] * 4)
    # Between two long parts a short one is kept, at the page's end it is not.
    assert extraction.main_text(f"<div><p>{LONG}</p></div><div><p>So it was.</p></div><div><p>{LONG}</p></div><div><p>Imprint</p></div>") == f"{LONG}\n\nSo it was.\n\n{LONG}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><form action=x><div><article><p>{LONG}</p></article></div><input></form></body>", LONG),
        (f"<body><form action=x><div><p>{LONG}</p><p>{LONG}</p></div></form><p>Short.</p></body>", f"{LONG}\n\n{LONG}"),
        (f"<form><label>Name</label></form><p>{LONG}</p>", LONG),
        (f"<div style='display: none'><p>{LONG}</p></div><p>{LONG} b</p>", f"{LONG} b"),
    ],
)
def test_forms_and_hidden_parts(page, text):
    assert extraction.main_text(page) == text


@pytest.mark.parametrize("unit", ["<b>", "<div>", "<li>", "<table><tr><td>", "<p><i>", "<article>", "</b>", "<ul><li><div>"])
def test_time_grows_with_the_page(unit):
    def seconds(n):
        page = unit * n + "<p>t" * n + "</i>" * n + "</div>" * n
        start = time.perf_counter()
        extraction.main_text(page)
        return time.perf_counter() - start

    seconds(200)
    assert seconds(16_000) < 24 * max(seconds(2_000), 0.01)  # squares would take 64 times as long


def test_a_page_of_a_million_characters():
    assert extraction.main_text("x" * 1_000_000) == "x" * 1_000_000
    assert extraction.main_text(f"<p>{LONG}</p>" * 9_000).count(LONG) == 9_000
