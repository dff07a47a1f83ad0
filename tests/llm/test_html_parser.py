"""Broken tags, and pages that a parser must not walk through again and again."""

from __future__ import annotations

import time

import pytest

from consolida.llm import html_text


def texts(html):
    return [t for t, _, _ in html_text.blocks(html)]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article><p title=it's>First.</p><p>Second it's here.</p><p>Third.</p>", ["First.", "Second it's here.", "Third."]),
        ("<p title='a>First", ["First"]),
        ('<p title="a > b">First</p>', ["First"]),
        ("<p data-x='<b>no</b>'>First</p>", ["First"]),
        ("<a \"href=x>link</a> text", ["link text"]),
        ("<p class=>First<p a = 'x>y' b>Second", ["First", "Second"]),
        ("<p>1 < 2 and <3</p>a <b", ["1 < 2 and <3", "a <b"]),
        ("<p>kept<!-- not kept", ["kept"]),
        ("<p>kept<!-- > not", ["kept"]),
        ("<p>a<table><tr><td>b</p>c</table>d", ["a", "b", "c", "d"]),
        ("<p>a<b>b<div>c</div>", ["ab", "c"]),
    ],
)
def test_broken_tags(html, want):
    assert texts(html) == want


@pytest.mark.parametrize("page", ["<div>x" * 100_000, '<a "' * 100_000, "<b>x<hr>" * 50_000, "<div>" * 50_000 + "</i>" * 50_000, "<p a='" * 100_000, "<p><button>" + "<div>y" * 50_000, "<" * 200_000, "<!" * 100_000])
def test_linear_time(page):
    begin = time.process_time()
    html_text.blocks(page)
    assert time.process_time() - begin < 3
