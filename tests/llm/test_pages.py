"""Operator 2 on hand-made pages and on the article elements of the given ones."""

from __future__ import annotations

import html
import itertools
import re

from sluice.llm import pages as p
from sluice.llm import queries as q

TREE = p.DecisionTree(*p.read_labelled())


def text(page):
    return p.main_text(page, TREE)


LONG = "the main text of this page goes on for quite a few words so that it counts as a paragraph of its own"


def test_article_without_the_rest():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{a>b}}</style><script>var t="<p>x</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu one</a><li><a href='/b'>two</a></ul></nav><!-- <p>no</p> -->
    <div class="cookie-notice">We use cookies {LONG}</div><div class="ad">Buy &amp; save</div>
    <article><h1>Head&nbsp;line</h1><p>One &lt;b&gt; &eacute;<b>bold
    text</b><br>next<p>Two words<div id="comments"><p>{LONG}</p></div><form><p>Name</p><input></form></article>
    <aside>{LONG}</aside><div class="sidebar"><p>{LONG}</p></div><footer>&copy; 2020 {LONG}</footer></body></html>"""
    assert text(page) == "Head line\nOne <b> ébold text next\nTwo words"


def test_pages_without_article_mark():
    menu = "".join(f'<li><a href="/{k}">item {k}</a></li>' for k in range(5))
    assert text(f"<ul>{menu}</ul><p>{LONG}</p><p>{LONG}.</p><ul>{menu}</ul>") == f"{LONG}\n{LONG}."


def test_broken_and_empty_pages():
    assert text(None) == text("") == text("<") == text("<p>") == text("<script>never closed <p>x</p>") == ""
    assert text("<article><p>cut off &am") == "cut off &am"
    assert text("<article><p>a < b and b > a</p><p>cut <a href='/x") == "a < b and b > a\ncut"
    assert text("<article><!-- open <p>x</p>") == ""
    assert len(text("<article>" + "<div>" * 3000 + "deep" + "<p>x</p>" * 2000)) == 4 + 2000 * 2


def test_given_pages(spark):
    got = {r["page_id"]: r for r in q.op2_html_text(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1])
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]]["text"] == "\n".join(filter(None, want))
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


def test_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<p>", "y")], "page_id bigint, url string, html string, text string")
    assert [(r["text"], r["n_chars"]) for r in p.extract_main_text(df).collect()] == [("", 0)] * 3
    assert p.extract_main_text(df.limit(0)).count() == 0


def test_tree_agrees_with_its_table():
    rows, labels = p.read_labelled()
    assert sum(TREE.predict(r) == bool(x) for r, x in zip(rows, labels)) >= 0.95 * len(rows)


def test_inline_adverts_and_headers_inside_articles():
    assert text('<article><p>Hello world .. <span class="ad">Buy now cheap</span> more text follows.</p></article>') == "Hello world .. more text follows."
    assert text('<article><header><h1>The title</h1></header><p>One two three.</p><span class="promo"><div>Buy <p>this</p></div></span><p>Four.</p></article>') == "The title\nOne two three.\nFour."
    assert text(f'<body><header><h1>Site</h1></header><article class="social policy"><p>{LONG} <b class="ad">never closed</p><p>{LONG}</p></article>') == f"{LONG}\n{LONG}"


def test_neighbours_decide():
    """The same blocks of 12 words, 10 linked, and of 5 words, unlinked: by what stands around them."""
    linked, short = '<div>read more <a href="/">about all of this and of that here and there</a></div>', "<div>five plain words stand here</div>"
    long = f"<p>{LONG}</p>"
    assert text(f"<main>{long}{linked}{long}</main>").count("\n") == 2
    assert text(f"<div>{linked * 5}</div>") == ""
    assert text(f"<div>{short}{long}{long}</div>").startswith("five plain words")
    assert text(f"<div>{linked * 3}{short}{linked * 3}</div>") == ""


def test_marked_parts_are_never_kept():
    """Between two paragraphs, in an article, in main and in neither: menus, related links, adverts, footers, buttons, comments, hidden parts."""
    parts = [
        "<nav><a>Home</a> <a>News</a></nav>", '<aside class="related"><a>Some</a> <a>links here</a></aside>', '<div class="ad"><a>Buy cheap boats now</a></div>', "<footer><a>Terms</a> <a>Imprint</a></footer>",
        "<button><a>Subscribe now</a></button>", '<div class="share-buttons">Share this</div>', f'<div class="user-opinions"><p>{LONG}</p></div>', f'<div style="color:red; display : none">{LONG}</div>', "<div hidden>not seen</div>",
        '<div class="related"><a>One story</a></div>', f'<div class="adSlot"><a>{LONG}</a></div>', f'<section id="reader-comments"><p>{LONG}</p><p>short</p></section>', f'<div class="cookie-notice">{LONG}</div>',
    ]
    paragraph = f"<p>{LONG}</p>"
    for part in parts:
        for tag in ("article", "main", "div"):
            assert text(f"<body><{tag}>{paragraph}{part}{paragraph}</{tag}></body>") == f"{LONG}\n{LONG}", (tag, part)
            assert text(f"<body><{tag}>{part}{paragraph}{paragraph}{part}</{tag}></body>") == f"{LONG}\n{LONG}", (tag, part)
        assert text(f'<article><p>{LONG} <span class="ad"><a>Buy cheap</a></span> on</p></article>') == f"{LONG} on"
    for words, links, before, after, mark, share, article in itertools.product((1, 2, 4, 8, 15, 23, 40, 80), (0, 0.5, 1), ((0, 0), (3, 1), (23, 0), (40, 0)), ((0, 0), (3, 1), (23, 0), (40, 0)), (2, 3), (0.05, 0.3, 0.6), (0, 1)):
        assert not TREE.predict((words, links, *before, *after, mark, share, article))


def test_unmarked_text_of_an_article_is_always_kept():
    around = ((0, 0), (2, 1), (3, 0), (8, 0), (8, 0.8), (20, 0), (40, 0), (70, 0), (120, 0), (300, 0), (40, 0.9))
    for words, before, after in itertools.product((1, 2, 3, 4, 5, 6, 8, 10, 14, 20, 30, 50, 90, 200, 500), around, around):
        assert TREE.predict((words, 0.0, *before, *after, 0.0, 0.0, 1.0))


def test_no_word_of_a_class_alone_takes_an_article():
    assert text(f'<article class="popular-post"><p class="search-term">{LONG}</p><section class="related-work"><p>{LONG}</p></section></article>') == f"{LONG}\n{LONG}"
    assert text(f'<body><div class="page-sidebar-right"><h1>What is new here</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></body>') == f"What is new here\n{LONG}\n{LONG}\n{LONG}"
    assert text(f"<body><p>{LONG}</p><p>Yes.</p><p>{LONG}</p><ul><li>one</li><li>two</li></ul><p>{LONG}</p></body>") == f"{LONG}\nYes.\n{LONG}\none\ntwo\n{LONG}"


def test_layouts_that_the_table_does_not_hold():
    menu = "".join(f'<td><a href="/{k}">Item {k}</a></td>' for k in range(7))
    old = f"<html><body><table><tr>{menu}</tr></table><center><font size=5>A page of the old days</font></center><font>{LONG}<br><br>{LONG} too.</font><hr><p>{LONG}, and so on.</p><table><tr>{menu}</tr></table><small>Last changed in 1999</small>"
    assert text(old) == f"A page of the old days\n{LONG} {LONG} too.\n{LONG}, and so on."
    cards = "".join(f'<div class="card"><a href="/{k}"><h3>Another story, number {k}</h3></a></div>' for k in range(6))
    modern = f'<div id="root"><div class="topbar"><a href="/">Home</a></div><div><h1>On something new</h1><div>{LONG}.</div><ul><li>{LONG}; one</li><li>{LONG}; two</li></ul><div>{LONG}!</div></div><div>{cards}</div><div class="cookieConsent"><p>{LONG}</p></div></div>'
    assert text(modern) == f"On something new\n{LONG}.\n{LONG}; one\n{LONG}; two\n{LONG}!"


def test_hostile_pages_take_linear_time():
    import time

    n = 100_000
    pages = ['<a "' * n, "<p " * n, "<div>" * n + "</b>" * n, "<a x='>" * n, '<b class="ad">' * n, "<p>" * n + "</div>" * n, "<!--" * n, "<span class=ad><div>" * n + "</span>" * n, "<a =" + '"' * n + ">", "<script>" + "</script" * n, "<title>" + "</title x" * n, "<p>" + "<span class=ad>x</span>y " * n]
    begin = time.time()
    for page in pages:
        text(page)
    assert time.time() - begin < 40
