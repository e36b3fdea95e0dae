"""Pages whose dropped elements have no end tag."""
import pytest

from sluice.llm import html

TEXT = "One two, three four five six seven eight nine ten. Eleven, twelve."


def words(page):
    return " ".join("".join("".join(parts) for _, parts in html.Page(page).segments).split())


@pytest.mark.parametrize("head", ["<head><title>T</title>", "<head><meta charset=x><script>var a;</script>", "<head><noscript><link href=x>"])
def test_body_ends_an_open_head(head):
    page = f"<html>{head}<body><article><p>{TEXT}</p></article></body></html>"
    assert words(page) == TEXT
    assert html.main_text(page, html.default_model()) == TEXT


def test_other_elements_and_text_end_an_open_head():
    assert words(f"<head><title>T</title><article><p>{TEXT}</p></article>") == TEXT
    assert words(f"<head><title>T</title>{TEXT}") == TEXT
    assert words(f"<head><title>T</title></head><p>{TEXT}</p>") == TEXT


@pytest.mark.parametrize("tag", "noscript iframe object button select textarea svg audio video".split())
def test_an_enclosing_block_ends_a_dropped_element(tag):
    assert words(f"<body><div><{tag}>x</div><p>{TEXT}</p></body>") == TEXT
    assert words(f"<body><div><{tag}><div>x</div><p>y</{tag}>a</div><p>{TEXT}</p></body>") == "a" + TEXT


def test_nested_blocks_do_not_end_it():
    assert words(f"<div><noscript><div>x</div>y<div/>z</div></noscript>{TEXT}</div>") == TEXT
    assert words(f"<div><svg><g><path d=x/><title>t</title></svg>{TEXT}</div>") == TEXT
    assert words(f"<div><button>a<button>b</button>{TEXT}</div>") == TEXT
