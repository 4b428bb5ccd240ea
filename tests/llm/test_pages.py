"""Pages whose layout names and short texts once cost them their content."""

from __future__ import annotations

import time

import pytest

from ledgerwright.llm import html_text

RULES = "This is the text that was written for all of the people who read it."


@pytest.mark.parametrize(
    "page",
    [
        "<body class='single no-sidebar'><article><p>{}</p></article></body>",
        "<body class='ast-no-sidebar ast-header-break-point'><main><p>{}</p></main></body>",
        "<article class='post has-comments'><p>{}</p></article>",
        "<div class='content-with-sidebar'><p>{}</p></div>",
        "<div class='sidebar-layout'><p>A note of the house.</p><main><p>{}</p></main></div>",
        "<p>{}</p>",
        "<article><p>{}</p></article><div id='comments'><article class='comment'><p>It is not for me.</p></article></div>",
    ],
)
def test_layout_names_and_short_pages(page):
    text = html_text.main_text(page.format(RULES))
    assert RULES in text and "not for me" not in text


def test_nested_and_stray_tags_take_linear_time():
    """Pages of about a megabyte; reading them was quadratic once."""
    n = 100_000
    pages = ["<div>" * n + "<b>x" * n, "<div>" * n + "</i>" * n, "<p>x<svg/>" * n, "<div class=ad>" * n + "</div>" * n]
    for page in pages:
        start = time.perf_counter()
        html_text.blocks(page)
        assert time.perf_counter() - start < 5
