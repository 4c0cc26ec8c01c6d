"""Which regions of a page are its main text."""

from evenkeel.llm.html_text import extract

LONG = "This is a paragraph of the article that is long enough to be a cluster of its own, and more so. " * 4
LONG = LONG.strip()
OTHER = "Another paragraph with quite a few words in it, which is shorter than the longest of them."
MENU = "<div><a href=a>Home</a></div><div><a href=b>About us</a></div>"


def page(body):
    return f"<html><head><title>t</title></head><body>{MENU}{body}<div><a href=c>Imprint</a></div></body></html>"


def test_nested_sections_stay():
    body = f"<article><h1>Title</h1><p>Intro.</p><section><p>{LONG}</p></section><section><h2>B</h2><p>{OTHER}</p></section></article>"
    assert extract(page(body)) == f"Title\nIntro.\n{LONG}\nB\n{OTHER}"
    assert extract(page(body.replace("<section><h2>", "<section><section><h2>").replace("</section></article>", "</section></section></article>"))) == (
        f"Title\nIntro.\n{LONG}\nB\n{OTHER}"
    )


def test_short_cells_of_a_table_stay():
    body = f"<main><h1>Title</h1><article><p>{LONG}</p><table><tr><th>Year<th>n<tr><td>1999<td>7<tr><td>2000<td>8</table></article><p>End.</main>"
    assert extract(page(body)) == f"Title\n{LONG}\nYear\nn\n1999\n7\n2000\n8\nEnd."


def test_link_lists_of_an_article_stay_and_marked_elements_go():
    body = f"<article><p>{LONG}</p><ul><li><a href=x>First source</a><li><a href=y>Second source</a></ul><nav><a href=z>Next</a></nav></article>"
    assert extract(page(body)) == f"{LONG}\nFirst source\nSecond source"


def test_the_article_with_most_text_below_it_is_taken():
    parts = "".join(f"<section><p>{n} {OTHER}</p></section>" for n in range(6))
    body = f"<article><h2>Teaser</h2><p>{LONG}</p></article><article><h1>Title</h1>{parts}</article>"
    assert extract(page(body)) == "\n".join(["Title", *[f"{n} {OTHER}" for n in range(6)]])


def test_without_an_article_the_common_parent_of_the_clusters_is_taken():
    parts = f"<section><h2>A</h2><p>{LONG}</p></section><p><a href=x>A source</a><section><h2>B</h2><p>{LONG}</p></section>"
    assert extract(page(f"<h1>Title</h1>{parts}")) == f"Title\nA\n{LONG}\nA source\nB\n{LONG}"
    cells = f"<table><tr><td><p>Side.</p></td><td><h1>Title</h1><p>{LONG}</p><table><tr><td>1</td></tr></table></td></tr></table>"
    assert extract(page(cells)) == f"Title\n{LONG}\n1"
    assert extract(page(f"<article><p>Teaser.</p></article><p>{LONG}</p><p>{LONG}</p>")) == f"Teaser.\n{LONG}\n{LONG}"
