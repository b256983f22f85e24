"""Ambiguous names, nesting depth and broken markup in HTML extraction."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hst

from opspulse.llm.html import main_text

PROSE = "The survey of the northern district went on for several weeks in spring, and its results were written down. " * 3
P = f"<p>{PROSE}</p>"


def page(inner):
    return f"<body><nav><a href=1>Home</a></nav><main><h1>Title</h1>{P * 6}{inner}</main></body>"


@pytest.mark.parametrize("name", ['id="related-work"', 'id="social-history"', 'class="ad-hoc-analysis"', 'class="menu"', 'class="notice-of-meeting"'])
def test_prose_under_an_ambiguous_name_stays(name):
    assert main_text(page(f"<section {name}><h2>Further</h2>{P * 6}</section>{P}")).count("survey") == 39


@pytest.mark.parametrize("name", ['id="related-work"', 'class="menu"', 'class="related-posts"', 'class="social-share"'])
def test_links_under_such_a_name_go(name):
    links = "".join(f"<li><a href={i}>A long title of another page, number {i}</a></li>" for i in range(9))
    assert "another page" not in main_text(page(f"<div {name}><ul>{links}</ul></div>{P}"))


@pytest.mark.parametrize("name", ['class="comments-thread"', 'class="sidebar-history"', 'class="ad-slot"', 'id="related-articles"', 'class="cookie-policy-text"', 'role="navigation"'])
def test_parts_that_hold_prose_by_their_nature_go(name):
    assert main_text(page(f"<div {name}>{P * 6}</div>")).count("survey") == 18


def test_a_comment_inside_an_ambiguous_part_goes():
    assert main_text(page(f'<section id="related-work">{P * 3}<div class="comments">{P}</div></section>')).count("survey") == 27


@pytest.mark.parametrize("open_tag", ["<div class=sidebar>", "<div>", "<form>", "<div class=menu>", "<span>"])
def test_depth_is_linear(open_tag):
    start = time.time()
    main_text(open_tag * 8000 + P + "x</p></i></div>" * 8000)
    assert time.time() - start < 3


PIECES = ["<div class=menu>", "<![if x]>", "<![CDATA[a]]>", "<!--", "-->", "<", "</", "<article>", "</p>", "<p>", "text ", "&#x;", "&amp", "<!DOCTYPE", "<a href='", ">", "<?x", "<form>", "</div>", "\x00", "<br/>"]


@settings(max_examples=200, deadline=None)
@given(hst.lists(hst.sampled_from(PIECES), max_size=30))
def test_broken_markup_never_stops_the_job(parts):
    assert isinstance(main_text("".join(parts)), str)
