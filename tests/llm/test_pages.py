"""Extraction of layouts that are not in the training generator, and of faulty pages."""
import time

import pytest

from sluice.llm import html

TEXT = "The river of stone runs under old bridges, and people cross them when the light is low. " * 4
ONE = "A single plain sentence, about eighty characters long, that makes up the whole text."
MANY = "Hello world, this is a text. " * 20


@pytest.fixture(scope="module")
def model():
    return html.default_model()


@pytest.mark.parametrize("page,want", [
    (f"<body>{TEXT}<br><br>{TEXT}</body>", f"{TEXT.strip()} {TEXT.strip()}"),
    (TEXT, TEXT.strip()),
    (f"<main><pre>{ONE}</pre><p>{TEXT}</p></main>", f"{ONE}\n\n{TEXT.strip()}"),
    (f"<article><p>{ONE[:40]}<span>{ONE[40:]}</span></p></article>", ONE),
    ('<article><p>See <a href="/x">the long link of another page</a></p><p>Short.</p></article>', "See the long link of another page\n\nShort."),
    (f"<div>{TEXT}</div><div>{ONE}</div>", f"{TEXT.strip()}\n\n{ONE}"),
    (f'<body><div class="menu"><a href="/">Home</a> <a href="/b">News</a></div><div>{TEXT}</div>'
     '<div class="footer">Copyright 2024, all rights reserved.</div></body>', TEXT.strip()),
    (f'<body><div class="cookie-notice">We use cookies, please accept them.</div><p>{TEXT}</p></body>', TEXT.strip()),
    ('<nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li></ul></nav>', ""),
])
def test_layouts(model, page, want):
    assert html.main_text(page, model) == want


@pytest.mark.parametrize("depth", [0, 1, 3, 5, 10, 50])
def test_depth_of_wrappers(model, depth):
    for outer in ("article", "body"):
        page = f"<{outer}>" + "<div>" * depth + f"<p>{MANY}</p>" + "</div>" * depth + f"</{outer}>"
        assert html.main_text(page, model) == MANY.strip(), (outer, depth)


@pytest.mark.parametrize("page", [
    "<!--" * 250_000, "<a " * 350_000, '<a b="' * 170_000, "<" * 300_000, "<div>" * 100_000, "<p>x" * 50_000,
    "<li><ul>" + "<div>" * 30_000 + "<li></li>" * 30_000, "<select>" + "<div>" * 50_000 + "</p>" * 50_000,
    "<svg>" * 100_000 + "</b>" * 100_000, "<script>" + "</scrip" * 100_000, "&amp" * 200_000, "<a" + " x" * 300_000,
])
def test_rubbish_is_read_in_linear_time(model, page):
    start = time.process_time()
    html.Page(page)
    assert time.process_time() - start < 5


def test_deep_page_keeps_its_text(model):
    page = "<div>" * 20_000 + f"<article><p>{TEXT}</p></article>" + "</div>" * 20_000
    assert html.main_text(page, model) == TEXT.strip()


@pytest.mark.parametrize("page,want", [
    ("<p>a &lt;b&gt; c &amp;amp; &#233;</p>", "a <b> c &amp; é"), ("<p>1 < 2 <3</p>", "1 < 2 <3"),
    ("<p title='a>b' data-x=\"</p>\">x</p>", "x"), ("<p>x<!-- <p>no</p> -->y</p>", "xy"), ("<p>x</p><!-- open <p>no</p>", "x"),
    ("<p>x</p><a href='open>no", "x"), ("<script>if (a<b) '<p>no</p>'</script><p>x</p>", "x"), ("<p>x<?php no ?>y<!no>z</p>", "xyz"),
    ("<SCRIPT>no</script ><P>x</P>", "x"), ("<script src=/a/>no</script><p>x</p>", "x"), ("<p a=1 a=2 / b>x</p>", "x"),
])
def test_tokens(page, want):
    read = html.Page(page)
    assert "".join(t for _, parts in read.segments for t in parts).strip() == want
