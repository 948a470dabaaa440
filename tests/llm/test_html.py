"""Main text of pages: the given layout, others, and broken markup."""

import re
import time
from html import unescape

import pytest

from vintner.llm.html_main_text import main_text
from vintner.llm.queries import op3_html_main_text

SF = "/root/testdata/sf0.01"


def inside_article(page):
    """Text of the given pages' only article, by cutting its known tags out."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    body = re.sub(r"</?(?:p|br|h1)>", " ", body)
    return " ".join(unescape(re.sub(r"</?b>", "", body)).split())


def test_whole_table(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op3_html_main_text(spark, SF).collect()
    assert {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in rows} == {
        i: (p["url"], inside_article(p["html"]), len(inside_article(p["html"]))) for i, p in pages.items()
    }


ARTICLE = "<h2>The title</h2><p>First, of <a href='x'>some</a> words.</p><ul><li>one<li>two</ul><p>Short.</p>"
TEXT = "The title First, of some words. one two Short."
AROUND = "<p>Other text, with commas, many of them, and quite long, so that it would win, if it could, the race.</p>" * 5


@pytest.mark.parametrize(
    "page",
    [
        f"<main>{ARTICLE}</main><aside>{AROUND}</aside>",
        f"<div class='sidebar'>{AROUND}</div><article>{ARTICLE}</article>",
        f"<article>{ARTICLE}</article><section id='comments'><article class='comment'>{AROUND}</article></section>",
        f"<body class='has-sidebar'><div id='wrap' class='with-sidebar'><article>{ARTICLE}</article><div id=sidebar>{AROUND}</div></div>",
        f"<nav>{AROUND}</nav><div class=content>{ARTICLE}</div><footer>{AROUND}</footer>",
        f"<header>{AROUND}</header><article>{ARTICLE}<form>{AROUND}</form></article>",
        f"<article>{ARTICLE}<div class='cookie-notice'>{AROUND}</div><div role='complementary'>{AROUND}</div></article>",
        f"<article>{ARTICLE}<script>var a = '<p>no</p>';</script><style>p {{}}</style><!-- <p>no</p> --></article>",
        f"<article>{ARTICLE}<div hidden>{AROUND}</div><div style='display: none'>{AROUND}</div></article>",
        f"<ARTICLE>{ARTICLE.upper().replace('FIRST', 'First')}</ARTICLE>".replace("THE TITLE", "The title")
        .replace("OF <", "of <").replace("SOME", "some").replace("WORDS", "words").replace("SHORT", "Short")
        .replace("ONE", "one").replace("TWO", "two"),
    ],
)
def test_layouts(page):
    assert main_text(f"<html><head><title>No</title></head>{page}") == TEXT


def test_white_space_references_and_inline_elements():
    assert main_text("<article><p>a&amp;b&nbsp;c &eacute;&#233;&#x41; x<b>y</b>z\n\n w<br>v</p></article>") == "a&b c ééA xyz w v"
    assert main_text("<article><p>cut &am") == "cut &am"


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<nav><p>menu</p></nav>", "<!-- only", "<script>x"])
def test_no_main_text(page):
    assert main_text(page) == ""


def test_text_without_markup_is_kept():
    assert main_text("plain <i>text</i> & more") == "plain text & more"


@pytest.mark.parametrize(
    "page",
    ["<div " * 20000, "<div>" * 20000 + "</section>" * 20000, "<a '" * 20000, '<a "' * 20001, "<!" * 20000, "<ul><li>" * 10000, "<p><b>" * 10000 + "x", "</p>" * 30000, "&" * 50000, "<li>" * 20000 + "x"],
)
def test_broken_markup_takes_linear_time(page):
    started = time.process_time()
    main_text(page)
    assert time.process_time() - started < 5


@pytest.mark.parametrize(
    "before",
    ["<svg class='icon' />", "<svg/>", "<math/>", "<select>", "<noscript>", "<noembed>", "<noframes>", "<svg>", "<svg/><svg><text>no</text></svg>"],
)
def test_text_after_elements_without_an_end(before):
    assert main_text(f"{before}<article>{ARTICLE}</article>") == TEXT


def test_many_elements_without_an_end_take_linear_time():
    started = time.process_time()
    main_text("<svg>" * 50000 + "x")
    assert time.process_time() - started < 5


SENTENCES = [f"Part {k}, with some commas, and words enough that it counts as a paragraph of running text, as all of them do." for k in range(6)]


@pytest.mark.parametrize("wrappers", [1, 2, 4, 9])
@pytest.mark.parametrize("longer", [1, 3])
def test_paragraphs_in_wrappers_of_their_own(wrappers, longer):
    texts = [SENTENCES[0] * longer, *SENTENCES[1:]]
    rows = "".join("<div class=row>" * wrappers + f"<p>{t}</p>" + "</div>" * wrappers for t in texts)
    links = "<div>" + "<a href=x>A link, with words, of other pages</a> " * 9 + "</div>" if wrappers > 1 else ""
    page = f"<body><div class=menu>{AROUND}</div><div id=content>{rows}{links}</div><div class=footer>{AROUND}</div></body>"
    assert main_text(page) == " ".join(" ".join(texts).split())


def test_text_at_every_level_takes_linear_time():
    started = time.process_time()
    main_text("<div>some words, and a comma, of a text that is nested" * 20000)
    assert time.process_time() - started < 5


@pytest.mark.parametrize(
    "part",
    [
        "<section id='discussion'><h2>Discussion</h2><p>{}</p></section>",
        "<section id='related-work'><h2>Related</h2><p>{}</p></section>",
        "<section id='advertising-revenue'><p>{}</p></section>",
        "<div id='social-history'><h2 id='sharing-data'>Data</h2><p>{}</p></div>",
        "<h2 id='sharing-data'>Data</h2><p class='notice'>{}</p>",
        "<h3 id='menu-planning'>Menus</h3><p id='legal'>{}</p>",
    ],
)
@pytest.mark.parametrize("around", ["article", "main"])
def test_words_of_ids_do_not_drop_parts_of_an_article(part, around):
    part = part.format(SENTENCES[0])
    want = " ".join(re.sub("<[^>]*>", " ", part).split())
    assert main_text(f"<{around}><p>{SENTENCES[1]}</p>{part}</{around}>") == f"{SENTENCES[1]} {want}"


@pytest.mark.parametrize(
    "part",
    [
        "<div class='share'><a href=x>Here</a> <a href=y>There</a></div>",
        "<div id='related'><p><a href=x>Another page of this site, with a long title, and more of it</a></p><p><a href=y>And one more, of many words as well</a></p></div>",
        "<section id='comments-section'><p>{0}</p></section>",
        "<div class='newsletter-signup'><p>{0}</p></div>",
        "<p class='advert'>{0}</p>",
    ],
)
def test_what_is_beside_the_article_is_dropped_inside_it_too(part):
    assert main_text(f"<article><p>{SENTENCES[1]}</p>{part.format(SENTENCES[0])}</article>") == SENTENCES[1]


def test_an_article_is_not_dropped_for_a_word_of_its_title():
    assert main_text(f"<article id='a-reply-to-smith'>{ARTICLE}</article>") == TEXT
    assert main_text(f"<article>{ARTICLE}</article><section class='comments'><article>{AROUND}</article></section>") == TEXT
    assert main_text(f"<article>{ARTICLE}</article><article id='comment-12'>{AROUND}</article>") == TEXT


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<span>" * n + "<p></p>" + "<div></div>" * n,
        lambda n: "<table><tr><td>" + "<i>" * n + "<div>" * n + "<li>" * n,
        lambda n: "<html>" * n + "<body>" * n,
        lambda n: "<main>" * n + f"<article></article><div>{ARTICLE}</div>",
        lambda n: "<svg " + "=" * (6 * n) + '""/>',
        lambda n: "<i>" * n + "<div>" + "</i>" * n,
        lambda n: "<dl><dt>" * n + "<dd>" * n,
        lambda n: "<x-y>" * n + "<p>a" * n,
        lambda n: """<a "'""" * n,
    ],
)
def test_a_megabyte_of_open_elements_takes_linear_time(page):
    n = 1000 * 10**6 // len(page(1000))
    started = time.process_time()
    main_text(page(n))
    assert time.process_time() - started < 5


@pytest.mark.parametrize("name", ["x-y", "my-term", "unheardof", "output"])
def test_unknown_elements_do_not_split_words(name):
    assert main_text(f"<p>ab<{name}>cd</{name}>ef, and more.</p>") == "abcdef, and more."
    assert main_text(f"<{name}><p>One, two.</p><p>Three, four.</p></{name}>") == "One, two. Three, four."


def test_points_alone_find_the_articles_of_the_given_pages(spark):
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        plain = re.sub(r"<(/?)(?:article|main)\b", r"<\1div", row["html"] or "")
        assert main_text(plain) == inside_article(row["html"])
