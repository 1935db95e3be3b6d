import html
import re

import pytest

from partwise.llm.html_text import extract_text, main_text
from partwise.llm.queries import op6_html_text
from partwise.llm.tables import read

STORY = ["One, two, three words of a story, and more of it.", "The second paragraph goes on, as they do, for a while.", "Short end."]
BODY = "".join(f"<p>{p}</p>" for p in STORY)
WANTED = "\n\n".join(STORY)


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav><a href=/>Home</a></nav><article>{BODY}</article><footer>&copy; me, you, all of us</footer></body></html>",
        f"<body><header>Site, name, motto</header><div id=content>{BODY}</div><div class='sidebar'><p>Other, things, here, to read, and more</p></div>",
        f"<div class=page><div class='menu'><ul><li><a href=a>a</a><li><a href=b>b</a></ul></div><div>{BODY}</div></div>",
        f"<main>{BODY}<section class='comments'><article><p>I, for one, think, that this, is nice, all of it</p></article></section></main>",
        f"<article>{BODY}<div class=\"ad-box advert\"><p>Buy, buy, buy now, it is cheap</p></div><form><p>Your, name, please</p><input></form></article>",
        f"<script>var a = '</p><p>no, no, no';</script><style>p > a {{}}</style><!-- <p>not, this</p> --><article>{BODY}</article>",
        f"<ARTICLE><P>{STORY[0]}<P>{STORY[1].replace(' ', '&#32;' + chr(10))}<P>{STORY[2].replace('.', '&period;')}</ARTICLE>",
        f"<article><p>{STORY[0].replace('two', '<b>t<i>w</i>o</b>')}</p><p>{STORY[1].replace(' ', '<br>')}<p>{STORY[2]}</article",
        f"<div class='cookie notice'><p>We, use, cookies, a lot, of them, really.</p></div><div><div>{BODY}</div></div><aside><p>x, y, z, w, v</p></aside>",
    ],
)
def test_main_text(page):
    assert main_text(page) == WANTED


LONG = [f"Paragraph {i} of the article, which has, as is usual, some commas and a good many words in it." for i in range(8)]
LONG_BODY = "".join(f"<p>{p}</p>" for p in LONG)
MENU = "<div class=menu><ul>" + "".join(f"<li><a href=/{i}>Entry {i}</a>" for i in range(9)) + "</ul></div>"
COOKIES = "<div class='cookie-consent'><p>We, and others, use cookies, to know, you, better.</p></div>"
THREAD = "<div class=comments>" + "".join(f"<article><p>I think, {i} times over, that this is, in all, quite right.</p></article>" for i in range(12)) + "</div>"


@pytest.mark.parametrize(
    "page",
    [
        f'<body><div id="page" class="with-sidebar">{MENU}{LONG_BODY}</div>{COOKIES}',
        f'<body><div class="site header-fixed">{MENU}<div>{LONG_BODY}</div>{COOKIES}</div>',
        f'<body>{MENU}<div class="search-result-detail">{LONG_BODY}</div>{COOKIES}',
        f'<body>{MENU}<article><div class="post-related-style">{LONG_BODY}</div></article>{COOKIES}',
        f'<body>{MENU}<article><section id="notice-of-change">{LONG_BODY}</section></article>{THREAD}',
        f"<body><form action=/ id=aspnetForm>{MENU}<div>{LONG_BODY}</div><input type=hidden></form></body>",
        f'<body><div class="with-sidebar"><div class="no-banner">{LONG_BODY}{COOKIES}</div><div class=sidebar><p>A, b, c, d, e</p></div></div>',
        f"<body><div class=content>{LONG_BODY}</div>{THREAD}",
        f"<main>{LONG_BODY}{THREAD}{THREAD.replace('right', 'wrong')}</main>",
        f"<article>{LONG_BODY}</article><div class='gdpr notice'>{'<p>We, and others, use cookies, to know, you, better.</p>' * 40}</div>",
        f'<div class="site header-fixed">{COOKIES}<main>{LONG_BODY}</main></div>',
    ],
)
def test_words_do_not_outrank_the_text(page):
    assert main_text(page) == "\n\n".join(LONG)


def test_small_suspects_go():
    assert main_text("<body><form><p>Your name, please, and your address</p><input></form>") == ""
    assert main_text(f"<article></article>{COOKIES}") == ""
    assert main_text("<div class=ad>" * 30_000 + "<p>x, y, z" + "</div>" * 30_000) == "x, y, z"


def test_nothing_else_is_dropped():
    page = "<article><h1>Title</h1>" + BODY + "<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><blockquote>q</blockquote><pre>x  y</pre></article>"
    assert main_text(page) == "\n\n".join(["Title", *STORY, "a", "b", "c", "d", "q", "x y"])
    assert main_text("no markup, at all: a < b &amp; c") == "no markup, at all: a < b & c"
    assert [main_text(x) for x in (None, "", "<p>", "<nav>x</nav>", "<!-- only -->", "<", "<<>>", "</p>")][:5] == [""] * 5
    long = "<article>" + "".join(f"<p>{i}, word</p>" for i in range(50_000)) + "</article>"
    assert main_text(long).count("\n\n") == 49_999
    assert main_text("<div " * 30_000) == ""
    assert main_text("<a b='" + "x" * 100_000) == ""
    assert main_text("<div>x" * 60_000 + "</p>" * 60_000).count("x") == 60_000


def plain(page):
    """The article of the given pages, which have no nested blocks in it."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    inner = re.sub(r"<[^>]*\Z", "", found[1] if found else "").replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|article|footer)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_whole_table(spark, sf_dir):
    pages = {r["page_id"]: r for r in read(spark, sf_dir, "pages").collect()}
    found = op6_html_text(spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        assert (r["url"], r["text"]) == (pages[r["page_id"]]["url"], plain(pages[r["page_id"]]["html"]))
        assert r["n_chars"] == len(r["text"])


def test_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", f"<article>{BODY}</article>"), (3, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "1 as n_chars", "2 as id")
    found = sorted(map(tuple, extract_text(pages).collect()), key=str)
    assert found == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", WANTED, len(WANTED)), (3, "u", "", 0)], key=str)
    assert extract_text(pages.limit(0)).count() == 0
