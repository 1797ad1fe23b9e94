import random

import pytest

from feedweave.llm import mincut
from feedweave.llm.html_parts import blocks

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body class="main">
<header><h1>Site name</h1><nav><ul><li><a href="/a">Home</a><li><a href="/b">About us</a></ul></nav></header>
<div class="cookie-notice">We use cookies. Accept?</div><div id="ad-top" class="ad">Buy now, it is cheap.</div>
<article><h1>The title &amp; more</h1><p>First   paragraph with <b>bold<i> text</i></b> &lt;ok&gt; caf&eacute;.<br>second line
<p>Short.</p><ul><li>one item</li><li>another <a href="x">item</a> here</ul><blockquote>Quoted words of somebody.</blockquote>
<table><tr><td>cell a<td>cell b</table><pre>a  b
c</pre><aside>Related: something else to read.</aside></article>
<div class="comments"><p>Nice article, I liked it very much indeed.</p></div><form><label>Mail</label><input><button>Send</button></form>
<aside class="sidebar"><p>A long text in the side bar that goes on and on for a while.</p></aside>
<footer>&copy; 2020 somebody</footer></body></html>"""
TEXT = ["The title & more", "First paragraph with bold text <ok> café. second line", "Short.", "one item", "another item here",
        "Quoted words of somebody.", "cell a", "cell b", "a b c"]


def test_article_without_what_stands_around_it():
    assert mincut.main_text(PAGE) == "\n\n".join(TEXT)


@pytest.mark.parametrize("html", ["", None, "   ", "<", "<p", "<!-- x", "<script>", "<p class='a", "&#x110000;", "<div></div>"])
def test_broken_and_empty_pages(html):
    assert isinstance(mincut.main_text(html), str)


@pytest.mark.parametrize("frame", ['<div class="layout has-sidebar">{}</div>', '<form action="/" id="aspnetForm">{}</form>',
                                   '<div class="page-content with-comments"><div id="main-nav-layout">{}</div></div>'])
def test_what_frames_a_page_does_not_empty_it(frame):
    """A wrapper named after one of its parts, or a form around the whole page, takes nothing from the article in it."""
    head, body = PAGE.split('<body class="main">')
    framed = f'{head}<body class="main">{frame.format(body.removesuffix("</body></html>"))}</body></html>'
    assert mincut.main_text(framed) == "\n\n".join(TEXT)


def test_controls_in_a_paragraph_are_no_text():
    html = "<article><p>One two <button type='button'>Copy</button>three.</p><p>Four <BUTTON>x</BUTTON>five.</p><p>Six <button>seven.</article>"
    assert mincut.main_text(html) == "One two three.\n\nFour five.\n\nSix seven."


def test_a_frame_of_comments_alone_stays_out():
    html = PAGE.replace("<p>Nice article, I liked it very much indeed.</p>", "<p>Nice article, I liked it very much indeed.</p>" * 3)
    assert mincut.main_text(html) == "\n\n".join(TEXT)


def test_page_without_article_keeps_prose():
    html = ("<body><div class='menu'><a>One</a> <a>Two</a></div><div id='content'><p>" + "Some words of prose. " * 10 +
            "</p><p>More prose that follows here.</p></div><div class='footer'>All rights reserved.</div></body>")
    assert mincut.main_text(html) == ("Some words of prose. " * 10).strip() + "\n\nMore prose that follows here."


def test_unclosed_elements_and_hidden_text():
    html = "<article><p><b>Open<br><p>Second<p hidden>gone<p style='display: none'>gone too<p>Third</article><footer>f</footer>"
    assert mincut.main_text(html) == "Open\n\nSecond\n\nThird"
    assert [b.text for b in blocks("a < b and <i>c</i> > d<p>e")] == ["a < b and c > d", "e"]


def brute_cut(gains, edges):
    best = None
    for mask in range(1 << len(gains)):
        side = [bool(mask >> i & 1) for i in range(len(gains))]
        cost = sum(g for g, s in zip(gains, side) if g > 0 and not s) - sum(g for g, s in zip(gains, side) if g < 0 and s)
        cost += sum(c for a, b, c in edges if side[a] != side[b])
        best = cost if best is None else min(best, cost)
    return best


def test_the_cut_is_minimal():
    rnd = random.Random(4)
    for _ in range(150):
        n = rnd.randint(1, 9)
        gains = [rnd.choice([0, rnd.uniform(-3, 3)]) for _ in range(n)]
        edges = [(i, j, rnd.uniform(0, 2)) for i in range(n) for j in range(i) if rnd.random() < 0.4]
        side = mincut.minimum_cut(gains, edges)
        cost = sum(g for g, s in zip(gains, side) if g > 0 and not s) - sum(g for g, s in zip(gains, side) if g < 0 and s)
        cost += sum(c for a, b, c in edges if side[a] != side[b])
        assert abs(cost - brute_cut(gains, edges)) < 1e-6


def test_edges_smooth_a_doubtful_block():
    assert mincut.minimum_cut([5.0, -0.3, 5.0], [(0, 1, 0.5), (1, 2, 0.5)]) == [True, True, True]
    assert mincut.minimum_cut([5.0, -3.0, 5.0], [(0, 1, 0.5), (1, 2, 0.5)]) == [True, False, True]


def test_rows(table):
    rows = [(1, "u", PAGE, "t", 5), (2, None, None, None, None), (None, "v", "", None, None), (3, "w", "<article>" + "<p>word</p>" * 5000 + "</article>", "", 0),
            (1, "u", PAGE, "t", 5)]
    found = mincut.extract(table(rows, "page_id long, url string, html string, text string, n_chars int"))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = found.collect()
    assert [r.n_chars for r in got] == [len(r.text) for r in got]
    assert [r.text for r in got][:3] == ["\n\n".join(TEXT), "", ""] and got[3].text.count("word") == 5000
    assert mincut.extract(table([], "page_id long, url string, html string")).count() == 0
