"""Main text of pages of several makes."""

import re

import pytest

from cartwheel.llm.html_density import extract, main_text

LONG = "This sentence has a good many words in it, and goes on for a while so that it counts as text."
PAGES = [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("<script>var x = '<p>no</p>';</script>", ""),
    ("plain text  without\na tag", "plain text without a tag"),
    ("<p>a<p>b<br>c&amp;d&nbsp;e&#x41;</p>tail", "a\nb c&d eA\ntail"),
    # menus, header, footer, sidebar, notice, advert, form and comments around div soup
    (f"""<html><head><title>T</title><style>p{{}}</style></head><body><div id=header>Site</div>
     <div class='main-menu'><a href=/a>A</a> <a href=/b/>B</a></div><div class="cookie-notice"><p>{LONG}</p></div>
     <div><h1>Title</h1><p>{LONG}</p><p>Short <a href=x>link</a>.</p><h2>Sub</h2><div class="ad">{LONG}</div>
     <p>{LONG}<script>if (a<b) x='</p>';</script> More.</p><ul><li>One<li>Two</ul></div>
     <div class=sidebar><p>{LONG}</p></div><form><p>{LONG}</p><input></form>
     <div class="comments"><p>{LONG * 30}</p></div><footer>Foot</footer></body></html>""",
     f"Title\n{LONG}\nShort link.\nSub\n{LONG} More.\nOne\nTwo"),
    # a form around the whole page, a header and an aside and comments inside the article
    (f"""<body><form id=f><nav><a href=1>x</a></nav><article><header><h1>H</h1></header><p>Text <b>bold</b>er. {LONG}</p><aside>side</aside>
     <form>name <input></form><section class=comments><article><p>{LONG}</p></article></section>
     <table><tr><td>1<td>2<tr><td>3</table></article></form>""", f"H\nText bolder. {LONG}\n1\n2\n3"),
    # unclosed elements, an open paragraph, odd attributes, a comment with markup
    (f"<body><nav><ul><li><a href='/x>y'>m</a><li><a title=it's href=/z>n</a></ul></nav><!-- <p>no</p> --><article><h1>A &lt; B</h1><p><b>{LONG}<br><p>Next"
     f"</article><footer>&copy; f", f"A < B\n{LONG}\nNext"),
    (f"<main><p hidden>{LONG}</p><p style='display: none'>{LONG}</p><p aria-hidden=true>{LONG}</p><div role=navigation>{LONG}</div><p>{LONG}</p></main>", LONG),
    (f"<body class='has-sidebar'><div class='widget page'><article class='no-comments'><p>{LONG}</p></article></div>", LONG),
    ("<p>" + "x " * 300_000 + "</p>", ("x " * 300_000).strip()),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_pages(page, text):
    assert main_text(page) == text


def test_unclosed_tags_take_linear_time():
    assert main_text("<p>a</p>" + "<a x=\"1\" y='" * 20_000) == "a"
    assert main_text("<a" * 50_000) == ""
    assert main_text("<div>" * 3_000 + LONG + "</div>" * 3_000) == LONG


def test_result_has_one_row_a_page(spark):
    rows = [(1, "u", PAGES[6][0], "x"), (1, "u", PAGES[6][0], "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text) for r in out) == [(0, "", ""), *[(1, "u", PAGES[6][1])] * 2]
    assert extract(pages.limit(0)).collect() == []


def test_against_the_article_element(spark):
    """The test pages hold one article element each: a plain reading of it."""
    import html
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1]
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br>" in x else "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in lines if x)
