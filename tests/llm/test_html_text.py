import pytest

from passagemill.llm.html_text import extract_main_text, main_text

LONG = "It was a long day by the river, and the boats came in late, with little wind."
MORE = "Nobody spoke of it again, but the stones were moved, one by one, before winter."
SHORT = "Buy this now, it is cheap and good."

PAGES = {
    "article": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a>Home</a></nav>"
        f"<article><h1>Head</h1><p>{LONG}<p>{MORE}</article><footer>&copy; x</footer></body></html>",
        f"Head {LONG} {MORE}",
    ),
    "containers without names": (
        f"<div><ul><li><a href=/>One</a><li><a>Two</a></ul></div><div><p>{LONG}</p><p>{MORE}</p></div>"
        "<div><a>About us, and more, and more, and more</a></div>",
        f"{LONG} {MORE}",
    ),
    "surroundings by name": (
        f'<div class="cookie-notice">We use cookies, and we like them, so please agree to all of them.</div>'
        f'<div id="content"><p>{LONG}</p><div class="share">Share it</div><form>Name <input></form><p>{MORE}</p></div>'
        f'<aside>{MORE}</aside><div id="sidebar">{LONG}</div><section class="comments"><p>{LONG}</p></section>',
        f"{LONG} {MORE}",
    ),
    "layout names around the article": (
        f'<div class="page with-sidebar"><div class="post"><p>{LONG}</p><p>{MORE}</p></div></div>',
        f"{LONG} {MORE}",
    ),
    "scripts and comments": (
        f"<p>{LONG}</p><script>if (a < b) document.write('<p>no</p>');</script><!-- <p>no</p> --><p>{MORE}</p>"
        "<SCRIPT src=x></SCRIPT><noscript><p>no</p></noscript>",
        f"{LONG} {MORE}",
    ),
    "white space and entities": (
        f"<article><p>Caf&eacute; &amp;&#32;bar&#x2019;s\n\n  <b>bo</b>ld&nbsp;&lt;3</p>{LONG}<br>{MORE}</article>",
        f"Café & bar’s bold <3 {LONG} {MORE}",
    ),
    "header inside an article": (
        f"<header><h1>Site</h1></header><article><header><h1>Head</h1><p>by me</p></header><p>{LONG}</p></article>",
        f"Head {LONG}",
    ),
    "lists and tables": (
        f"<main><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></main>",
        f"{LONG} one two a b c",
    ),
    "short article beside an advert": (
        f'<div class="ad">{LONG}</div><article><h1>A</h1><p>Few words.</p></article><footer>{MORE}</footer>',
        "A Few words.",
    ),
    "comment articles": (
        f'<article><p>{LONG}</p></article><article class="comment"><p>{MORE}</p></article>',
        LONG,
    ),
    "sections of one article": (
        f"<article><section><p>{LONG}</p></section><section><h2>Part</h2><p>Brief.</p></section></article>",
        f"{LONG} Part Brief.",
    ),
    "form around the page": (
        f'<form id="aspnetForm"><div class="menu"><a>Home</a></div><div><p>{LONG}</p><p>{MORE}</p>'
        "<form>Search <input></form></div></form>",
        f"{LONG} {MORE}",
    ),
    "advert words on a wrapper": (
        f'<div class="post has-ads"><p>{LONG}</p><div class="ads">{SHORT}</div><p>{MORE}</p></div>',
        f"{LONG} {MORE}",
    ),
    "sharing words and a role on a wrapper": (
        f'<div role="search"><div class="content social-share"><p>{LONG}</p><p>{MORE}</p></div></div>',
        f"{LONG} {MORE}",
    ),
    "hidden wrapper": (f'<div hidden class="ads"><p>{LONG}</p></div><p>{SHORT}</p>', "Buy this now, it is cheap and good."),
    "plain text": ("just <i>text</i>", "just text"),
    "only a menu": ("<nav><a>Home</a></nav>", ""),
    "broken": ("<p>a <b", "a"),
    "unclosed comment": ("<p>a</p><!-- b <p>c</p>", "a"),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_main_text(name):
    page, want = PAGES[name]
    assert main_text(page) == want


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 20_000 + LONG + "</div>" * 20_000) == LONG
    long_page = "<article>" + f"<p>{LONG}</p>" * 5_000 + "</article>"
    assert main_text(long_page) == " ".join([LONG] * 5_000)
    assert main_text("<" * 20_000) == "<" * 20_000
    assert main_text("<a href='" * 2_000) == ""


def test_table(spark):
    rows = [(1, PAGES["article"][0], "x"), (1, PAGES["article"][0], "x"), (None, None, None), (2, "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = extract_main_text(pages)
    assert found.columns == pages.columns
    assert sorted(row["text"] for row in found.collect()) == ["", "", *[PAGES["article"][1]] * 2]
    assert extract_main_text(pages.where("false")).count() == 0
