"""Marks are evidence, the ratio decides, and no page takes more than linear time."""

import time

import pytest

from evenkeel.llm import html_text
from evenkeel.llm.html_text import extract, marks

LONG = "This is a paragraph of the article that is long enough to be a cluster of its own, and more so. " * 4
LONG = LONG.strip()
MENU = "<nav><a href=a>Home</a></nav>"


def page(body, attributes=""):
    return f"<html><head><title>t</title></head><body {attributes}>{MENU}{body}<footer>Imprint</footer></body></html>"


@pytest.mark.parametrize(
    "body",
    [
        f'<div class="content with-sidebar"><h1>Title</h1><p>{LONG}</p></div>',
        f'<form action="/x"><input type=hidden name=a><div><h1>Title</h1><p>{LONG}</p></div></form>',
        f'<main><div class="ad-free-layout"><h1>Title</h1><p>{LONG}</p></div></main>',
        f'<article><div class="entry-header"><h1>Title</h1></div><p>{LONG}</p></article>',
        f'<div class="sidebar"><h1>Title</h1><p>{LONG}</p></div>',  # a name that is plainly wrong
        f'<div><h1>Title</h1><p>{LONG}</p></div><div class="comments"><p>{LONG} {LONG} {LONG}</p></div>',
        f'<div><h1>Title</h1><p>{LONG}</p></div><div class="sidebar"><p>{LONG[:150]}</p></div>',
        f'<div><h1>Title</h1><p>{LONG}</p></div><form><label>Your mail</label><input name=m><button>Send</button></form>',
    ],
)
def test_the_text_stays_and_clutter_goes(body):
    assert extract(page(body)) == f"Title\n{LONG}"


def test_a_form_without_anything_to_fill_in_is_no_form():
    assert extract(page(f"<p>{LONG}</p><form><p>Short but no form.</p></form><p>{LONG}</p>")) == f"{LONG}\nShort but no form.\n{LONG}"


def test_a_paragraph_named_after_what_it_tells_stays():
    body = f'<article><p>{LONG}</p><p class="social-history">The social history of the town.</p></article>'
    assert extract(page(body)) == f"{LONG}\nThe social history of the town."


def test_names():
    words = html_text.CLUTTER_WORDS
    marked = ["sidebar", "left-sidebar", "sidebarLeft", "comment-list", "x comments-area", "relatedPosts", "ad", "cookie_notice", "ad-slot-1"]
    plain = ["with-sidebar", "no-sidebar", "ad-free-layout", "social-history", "shadow", "headline", "has-comments", "", "1"]
    assert all(marks(name, words) for name in marked) and not any(marks(name, words) for name in plain)


def several_articles():
    """The first article has more text, in many short lines full of tags; the second is dense."""
    thin = "".join(f"<p><b>a</b><i>b</i><u>c</u> item number {n} <b>d</b></p>" for n in range(60))
    return page(f"<article>{thin}</article><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article>")


def test_the_ratio_decides_between_articles(monkeypatch):
    assert extract(several_articles()) == f"Title\n{LONG}\n{LONG}"
    monkeypatch.setattr(html_text, "smoothed", lambda values, sigma: values * 0 + 1)  # a constant instead of the ratio
    assert extract(several_articles()) != f"Title\n{LONG}\n{LONG}"


def test_the_ratio_decides_without_articles(monkeypatch):
    links = "".join(f"<tr><td><b>n</b><i>{n}</i></td></tr>" for n in range(9))
    body = page(f"<table><tr><td><table>{links}</table></td><td><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></td></tr></table>")
    assert extract(body) == f"Title\n{LONG}\n{LONG}"
    monkeypatch.setattr(html_text, "smoothed", lambda values, sigma: values * 0 + 1)
    assert extract(body) != f"Title\n{LONG}\n{LONG}"


@pytest.mark.parametrize(
    "piece", ["<i></b>", "<i><h1>x</h1>", "<header>", "<div>", "<p><i>", "<article><b>", "<b><p></b>", "<form>", "<div class=ad>", "</div>"]
)
def test_odd_nesting_takes_linear_time(piece):
    def seconds(n):
        began = time.perf_counter()
        extract(f"<p>{LONG}</p>" + piece * n)
        return time.perf_counter() - began

    seconds(2_000)
    assert seconds(40_000) < 12 * max(seconds(10_000), 0.05)
