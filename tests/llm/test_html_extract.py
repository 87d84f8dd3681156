"""HTML extraction against a regular expression on the test pages, and broken pages."""

import html
import re

import numpy as np

from shopshift.llm import html_extract as H
from tests.llm.helpers import SF


def plain(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in H.extract(pages).collect()}
    assert {k: v.text for k, v in got.items()} == want
    assert all(v.n_chars == len(v.text) for v in got.values())


def test_boilerplate_is_left_out():
    filler = "many words of the story " * 20
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body class="page with-sidebar">
    <header><h2>Site</h2></header><nav><a href=a>Home</a></nav><div class="cookie-notice">We use cookies {filler}</div>
    <article><h1>Head &amp; line</h1><p>Short.</p><p>{filler}<br>more&nbsp;&#x41;</p><script>var a="</p>";</script>
    <div class="ad">Buy {filler}</div><aside>Aside {filler}</aside><form><p>Name</p></form><p>End <b>bold</b>ly</p></article>
    <section id="comments"><p>Nice {filler}</p></section><div class="siteSidebar">side</div><footer>foot</footer></body></html>"""
    assert H.main_text(page).split("\n") == ["Head & line", "Short.", f"{filler}more A", "End boldly"]


def test_without_an_article_element():
    text = "alpha beta gamma delta " * 15
    page = f"<body><div><a href=x>one</a> <a>two</a></div><h1>Head</h1><p>{text}</p><p>short</p><p>{text}</p><div><a>next</a></div></body>"
    assert H.main_text(page).split("\n") == ["Head", text.strip(), "short", text.strip()]


def test_broken_and_empty_pages():
    for page in (None, "", "<", "<!x[ a ]>", "<![CDATA[x]]>", "<script>never closed <p>x", "<nav>menu only"):
        assert H.main_text(page) in ("", "<", "x]]>"), page
    assert H.main_text("<article><p>a<p>b<div>c") == "a\nb\nc"
    assert H.main_text("just text") == "just text"
    assert len(H.main_text("<p>" + "word " * 400_000)) == 5 * 400_000 - 1


def test_null_columns_and_repeated_rows(spark):
    pages = spark.createDataFrame([(None, None, None), (1, "u", "<p>x"), (1, "u", "<p>x")], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.extract(pages).collect()), key=str)
    assert got == sorted([(None, None, "", 0), (1, "u", "x", 1), (1, "u", "x", 1)], key=str)
    assert H.extract(pages.limit(0)).count() == 0


def test_short_paragraphs_at_the_ends_without_an_article_element():
    text = ("alpha beta gamma delta " * 18).strip()
    nav, foot = "<nav><a href=x>Home</a> <a href=y>News</a></nav>", "<footer>All rights</footer>"
    own = ["Head", "By Ann", *[text] * 5, "Closing line.", "The end."]
    inner = "<h1>Head</h1>" + "".join(f"<p>{x}</p>" for x in own[1:])
    assert H.main_text(f"<body>{nav}{inner}{foot}</body>").split("\n") == own
    blocks = f"<div>{inner}</div><div><p>{text}</p></div><div><p>Last words.</p></div>"
    assert H.main_text(f"<body>{nav}{blocks}{foot}</body>").split("\n") == [*own, text, "Last words."]


def test_paragraphs_of_link_text_stay_and_lists_of_links_go():
    text = ("alpha beta gamma delta " * 18).strip()
    linked = "<p>See <a href=x>a long story of many linked words</a></p>"
    menu = "<ul><li><a href=x>one</a><li><a href=y>two</a></ul>"
    page = f"<body>{menu}<p>{text}</p>{linked}<p><a href=x>The source</a></p><p>{text}</p>{menu}</body>"
    assert H.main_text(page).split("\n") == [text, "See a long story of many linked words", "The source", text]


LONG = ("alpha beta gamma delta epsilon " * 15).strip()
STORY = ["A headline", "By Ann", LONG, "Short one.", LONG, LONG, "The end."]
INNER = "<h1>A headline</h1>" + "".join(f"<p>{x}</p>" for x in STORY[1:])
NAV, FOOT = "<nav><a href=x>Home</a> <a href=y>News</a></nav>", "<footer>All rights</footer>"
LAYOUTS = {
    "form around all": f'<body><form id="aspnetForm">{NAV}{INNER}{FOOT}</form></body>',
    "widget": f'<body>{NAV}<div class="widget Blog">{INNER}</div>{FOOT}</body>',
    "social post": f'<body>{NAV}<div class="post social">{INNER}</div>{FOOT}</body>',
    "page with sidebar": f'<body>{NAV}<div class="page-with-sidebar">{INNER}</div><div class="sidebar">Old posts</div>{FOOT}</body>',
    "discussion in the article": f'<body>{NAV}<article>{INNER}<div class="discussion"><p>Nice {LONG}</p></div></article>{FOOT}</body>',
    "list of links in the article": f'<body>{NAV}<article>{INNER}<ul><li><a href=a>Mail</a></li><li><a href=b>Print</a></li><li><a href=c>Save</a></li></ul></article></body>',
    "small form in the text": f'<body>{NAV}<div id="main-col">{INNER}<form><p>Your mail</p></form></div>{FOOT}</body>',
    "article in a form": f"<body><form>{NAV}<article>{INNER}</article>{FOOT}</form></body>",
    "table layout": f"<body><table><tr><td>{NAV}</td><td>{INNER}</td></tr></table>{FOOT}</body>",
    "sections": f'<body class="has-sidebar no-header">{NAV}<div><section>{INNER}</section></div><div class="share">Share this</div>{FOOT}</body>',
}


def test_layouts():
    for name, page in LAYOUTS.items():
        assert H.main_text(page).split("\n") == STORY, name


def test_ratios_decide(monkeypatch):
    """With all ratios alike the marked containers, and the lists of links, are told wrongly."""
    right = {n for n, page in LAYOUTS.items() if H.main_text(page).split("\n") == STORY}
    monkeypatch.setattr(H, "smooth", lambda r, *_: np.zeros_like(r))
    flat = {n for n, page in LAYOUTS.items() if H.main_text(page).split("\n") == STORY}
    assert {"form around all", "widget", "social post", "list of links in the article"} <= right - flat


def test_marked_boilerplate_stays_out_without_an_article():
    for mark in ("sidebar", "widget", "social", "ad", "comments", "cookie-notice"):
        page = f'<body>{NAV}<div>{INNER}</div><div class="{mark}"><p>Other {LONG}</p></div>{FOOT}</body>'
        assert H.main_text(page).split("\n") == STORY, mark
