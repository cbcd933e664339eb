from html.parser import HTMLParser

import pytest

from tidemark.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p><article>no</article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>ad</p> --><div class="ad">Buy  now</div>
<article><h1>Caf&eacute; &amp; more</h1><p>One\n  two<br>three</p><p><b>Four <i>five</i><p>six<div class="share">Share me</div><ul><li>seven<li>eight</ul>
<table><tr><td>nine</td><td>ten</td></tr></table><form><input><p>Mail</p></form><aside>Side</aside>
<section id="comments"><p>I disagree with everything here</p></section><p>1 &lt; 2 a < b &#x41;</p></article>
<footer>&copy; x</footer>"""


def test_article():
    assert html_text.main_text(PAGE) == "Café & more\nOne two three\nFour five\nsix\nseven\neight\nnine ten\n1 < 2 a < b A"


def test_line_blocks_without_an_article():
    p = "<html><body><div><a href=x>Home</a> <a href=y>About us</a></div><div><h1>Head</h1><p>" + "long text here. " * 20 + "</p><p>ok</p><p>" + "more words " * 20 + "</p></div>"
    p += "<div class=comments><p>" + "I disagree " * 30 + "</p></div><div>Copyright</div></body></html>"
    got = html_text.main_text(p).split("\n")
    assert [g[:4] for g in got] == ["Head", "long", "ok", "more"]


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("<html></html>", ""), ("plain words", "plain words"), ("<p>unclosed", "unclosed"), ("<nav>x", ""), ("<article><p>a<", "a<"), ("<article>x<script>y", "x"), ("<nav>menu<article><p>text</p></article>", "text"), ("<article>&am &quo x&nbsp; y</article>", "&am &quo x y"), ("<article><a href='x>y'>link</a> <a href=\"z\">two</a></article>", "link two"), ("<main hidden>a</main><main>b</main>", "a\nb")])
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_text_outside_a_marked_article_surges_by_itself():
    body = ["The body lies in a plain element. " * 9, "Short.", "It goes on for a second paragraph. " * 9]
    page = "<div>Home</div><div>" + "".join(f"<p>{b}</p>" for b in body) + "</div><div class=ad>Buy</div><article class=card><p>Another story</p></article><div>Imprint</div>"
    assert html_text.main_text(page).split("\n") == [" ".join(b.split()) for b in ["Home", *body]]  # a card without a surge is left out
    assert html_text.main_text("<div>Home</div><article><p>a</p><p>" + "b " * 90 + "</p></article><div>Imprint</div>") == "a\n" + "b " * 89 + "b"


LONG = "A paragraph of the article, with words enough to surge by itself on any page. " * 3


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-sidebar", "no-sidebar", "with-menu", "page-with-nav", "layout--sidebar", "sidebar", "content sidebar", "no-comments"])
@pytest.mark.parametrize("inner", ["<main><article><p>{}</p><p>End.</p></article></main>", "<article><p>{}</p><p>End.</p></article>", "<p>{}</p><p>End.</p>"])
def test_wrappers_named_after_a_part_of_the_layout(name, inner):
    for attr in ("class", "id"):
        page = f"<nav>Menu</nav><div {attr}='{name}'>" + inner.format(LONG) + "<div class='sidebar'>Side</div><div class=main-nav>Nav</div></div><footer>f</footer>"
        got = html_text.main_text(page)
        assert got.startswith(LONG.strip()) and got.split("\n")[1] == "End.", got
        assert "Nav" not in got and "Side" not in got, got


@pytest.mark.parametrize("name", ["sidebar", "left widget", "site-footer", "main-nav", "page-header", "post-comments", "ad-container", "cookie-notice", "share-buttons", "related-posts"])
def test_names_of_boilerplate(name):
    assert html_text.main_text(f"<div><p>{LONG}</p><p>{LONG}</p></div><div class='{name}'><p>{LONG}</p></div>").count("\n") == 1


def test_comments_in_articles_are_no_article():
    page = f"<div id=comments><article class=comment><p>{LONG}</p></article></div>"
    assert html_text.main_text(f"<article><p>Body</p></article>{page}") == "Body"
    assert html_text.main_text(f"<main><div class=widget><p>no</p></div><p>Body</p></main>{page}") == "Body"
    assert html_text.main_text(f"<div class=social><main><p>Body</p></main></div>{page}") == "Body"
    assert html_text.main_text(page) == LONG.strip()


@pytest.mark.parametrize("page,want", [
    (f"<p>{LONG}</p><div class=ad>Buy</div><p>Short end.</p>", ["Short end."]),
    (f"<div><p>{LONG}</p><div class=ad>Buy</div><p>Short.</p><div class=share><p>a</p><p>b</p><p>c</p><p>d</p></div><p>End.</p></div><div class=ad>Buy</div><div>Imprint</div>", ["Short.", "End."]),
    (f"<div><div><p>{LONG}</p></div><div class=ad>Buy</div><div><p>Short end.</p></div></div>", ["Short end."]),
    (f"<div><p>{LONG}</p><p>See <a href=x>a text of many words that is linked</a>.</p><p>End.</p><p>By <a href=y>Somebody Or Other</a></p><ul><li><a href=z>More</a></ul></div>", ["See a text of many words that is linked.", "End.", "By Somebody Or Other"]),
])
def test_short_lines_beside_boilerplate(page, want):
    assert html_text.main_text(page).split("\n") == [LONG.strip(), *want]
    assert html_text.main_text("<h1>Title</h1><div class=ad>Buy</div>" + page).split("\n") == ["Title", LONG.strip(), *want]


@pytest.mark.parametrize("name", ["layout has-sidebar", "content with-comments", "page-header-fixed", "single-post no-ads", "tags-page", "social-studies"])
def test_names_that_mislead(name):
    two = f"<p>{LONG}</p><p>{LONG}</p>"
    for page in (f"<div class='{name}'>{two}</div>", f"<article><h1>Title</h1><div class='{name}'>{two}</div></article>"):
        assert html_text.main_text(page).split("\n")[-2:] == [LONG.strip()] * 2


def test_formulas_and_objects_stay():
    assert html_text.main_text(f"<article><p>{LONG}</p><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p><object data=x><p>Fallback</p></object></article>").split("\n")[1:] == ["So x=1 holds.", "Fallback"]


def test_parsing_is_linear():
    import time

    for page in ("<b>" * 100_000, "<b></i>" * 100_000, "<nav>" + "<section>" * 100_000, "<div>" * 50_000 + "</p>" * 50_000, "<section><p>a" * 50_000):
        began = time.process_time()
        html_text.main_text(page + f"<p>{LONG}</p>")
        assert time.process_time() - began < 3


class Plain(HTMLParser):
    """The lines of the one article of a well-formed page, by the standard parser."""

    BAD, BLOCK = {"nav", "aside", "form", "footer", "script", "style"}, {"p", "h1", "li", "ul", "div", "section", "article", "blockquote", *{"nav", "aside", "form", "footer"}}

    def __init__(self):
        super().__init__()
        self.open, self.lines, self.now = [], [], []

    def close_line(self):
        line = " ".join("".join(self.now).split())
        self.lines += [line] if line else []
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCK:
            self.close_line()
        self.open.append((tag, tag in self.BAD or dict(attrs).get("class") in ("ad", "comments", "share")))

    def handle_endtag(self, tag):
        if tag in self.BLOCK:
            self.close_line()
        self.open.pop()

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.open) and not any(b for _, b in self.open):
            self.now.append(data)


def test_equals_a_plain_version_on_well_formed_pages():
    import random

    r = random.Random(6)
    say = lambda n: " ".join(r.choice(["stone", "river &amp; sea", "caf&eacute;", "<b>bold</b> word", "<a href=x>link</a>", "a &lt; b"]) for _ in range(n))
    kinds = [lambda: f"<p>{say(r.randint(1, 60))}</p>", lambda: f"<ul><li>{say(3)}</li><li>{say(9)}</li></ul>", lambda: f"<section><h1>{say(2)}</h1><p>{say(20)}</p></section>", lambda: f"<div class='ad'>{say(30)}</div>", lambda: f"<aside>{say(30)}</aside>", lambda: f"<blockquote>{say(8)}</blockquote>", lambda: f"<div class='comments'><p>{say(40)}</p></div>", lambda: f"<form>{say(3)}</form>", lambda: f"<div class='share'>{say(2)}</div>"]
    for _ in range(150):
        body = "".join(r.choice(kinds)() for _ in range(r.randint(1, 12)))
        page = f"<html><body><nav><ul><li><a href=x>{say(2)}</a></li></ul></nav><article><h1>{say(5)}</h1><p>{say(30)}</p>{body}</article><aside>{say(30)}</aside><footer>{say(12)}</footer></body></html>"
        plain = Plain()
        plain.feed(page)
        assert html_text.main_text(page).split("\n") == plain.lines


def test_long_page_is_whole():
    n = 20000
    assert html_text.main_text("<article>" + "<p>word</p>" * n + "</article>") == "\n".join(["word"] * n)
    assert len(html_text.main_text("<article><p>" + "w " * 300000 + "</p></article>")) == 599999


def test_table(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (2, "v", "", "x")], "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == 4 and all(r["n_chars"] == len(r["text"]) for r in got) and sum(r["text"] == "" for r in got) == 2
    assert html_text.extract(df.limit(0)).count() == 0
