"""HTML as browsers read it: left-out end tags, quotes, elements without text of the page."""

from __future__ import annotations

import time

import pytest

from adlens.llm.html_text import blocks


def texts(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize("html, want", [
    ("<html><head><title>t</title><meta charset=utf-8><p>One<p>Two", ["One", "Two"]),                  # </head> left out
    ("<head><title>t</title>bare text<p>Two", ["bare text", "Two"]),
    ("<head><link rel=x><style>p{}</style><body><p>One</body>", ["One"]),
    ("<p title='it's'>One</p><p>Two</p>", ["One", "Two"]),
    ("<p title=\"a > b\" class=x>One</p>", ["One"]),
    ("<p title=\"never closed>One</p><p>Two</p>", ["One", "Two"]),
    ("<p title = 'x' data-q=a\"b>One</p>", ["One"]),
    ("<p>One</p><a href='x", ["One"]),                                                                 # a tag that ends with the page
    ("<article><button>Share<p>One</p><p>Two</p></article>", ["One", "Two"]),                          # </button> missing
    ("<p>One <button>Like</button> two</p>", ["One two"]),
    ("<p>One</p><button><span>Like</span></button><p>Two</p>", ["One", "Two"]),
    ("<select><option>A<option>B</select><p>One", ["One"]),
    ("<select><option>A<option>B<div><p>One</p></div>", ["One"]),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold</p>", ["Let x=2 hold"]),
    ("<p>Let <math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math> hold</p>", ["Let x hold"]),
    ("<p aria-hidden=true>One</p>", ["One"]),                                                          # visible all the same
    ("<p hidden>No</p><p data-hidden=1>One</p><p title='hidden gem'>Two</p>", ["One", "Two"]),
    ("<p style='display: none'>No</p><p style='color:red'>One</p>", ["One"]),
    ("<svg><title>t</title><text>No</text></svg><p>One", ["One"]),
    ("<svg><path d='M0'/><p>One</p>", ["One"]),
    ("<video><p>No video</p></video><p>One</p>", ["One"]),
    ("<p>a < b and c > d</p>", ["a < b and c > d"]),
    ("<script>var t='<p>No</p>'</script><p>One", ["One"]),
    ("", []), (None, []), ("plain", ["plain"]), ("<>", ["<>"]),
])
def test_blocks(html, want):
    assert texts(html) == want


@pytest.mark.parametrize("piece", ["<option>a", "<button>a", "<textarea>a", "<p title='x", "<svg>", "<b>", "</p>", "<a =", "<p a=\"b"])
def test_time_grows_with_the_page(piece):
    def took(n):
        start = time.perf_counter()
        blocks(piece * n)
        return time.perf_counter() - start

    took(500)
    assert took(16_000) < 40 * max(took(2_000), 0.01)
