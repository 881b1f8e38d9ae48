"""Main text of pages: markup that hides, names that mislead, readers' posts, hostile pages."""

import time

import pytest

from foliograph.llm import html_text
from foliograph.llm.html_text import attributes_of, main_blocks

LONG = " ".join(f"word{k}" for k in range(30))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<article data-note="it is hidden here" title="aria-hidden=true"><p>{LONG}</p></article>', [LONG]),
        (f'<body data-id="sidebar" alt="display: none"><p>{LONG}</p></body>', [LONG]),
        (f"<p hidden>x y</p><p aria-hidden='TRUE'>z z</p><p style='color:red; DISPLAY : none'>u v</p><p>{LONG}</p>", [LONG]),
        (f"<div><p>Yes.</p><p>No.</p><p>{LONG}</p><ul><li><a href=x>a link</a></li></ul></div>", ["Yes.", "No.", LONG]),
        (f'<div><h1>T</h1><p>{LONG}</p></div><section class="discussion"><p>{LONG} no</p></section>', ["T", LONG]),
        (f'<article><p>{LONG}</p></article><ol class="commentlist"><li>{LONG} no</li></ol>', [LONG]),
        (f'<div><p>{LONG}</p></div><div id="disqus_thread"><p>{LONG} no</p></div>', [LONG]),
        (f'<div><p>{LONG}</p></div><div class="cookie-policy-banner"><p>We use cookies on this site and more of them than you would like us to use.</p></div>', [LONG]),
        (f"<div><p>{LONG}</p></div><div>Copyright 2020 the owners of this site and all of their heirs and lawyers and friends</div>", [LONG]),
        (f'<div><p>{LONG}</p></div><div class="voices"><div><b class="author">A</b><p>{LONG} 1</p></div><div><a rel="author">B</a><p>{LONG} 2</p></div></div>', [LONG]),
        (f'<article class="post"><span class="author">Me</span><p>{LONG}</p><section id="discussion"><p>{LONG} yes</p></section></article>', ["Me", LONG, f"{LONG} yes"]),
        (f"<div title='x> <p>{LONG}</p>", [LONG]),
        (f'<div title="a > b"><p>{LONG}</p></div>', [LONG]),
        (f"<!-- <p>no</p> --><![CDATA[a < b]]><p>{LONG}</p><!-- open {LONG}", ["a < b", LONG]),
        ("", []),
        (None, []),
    ],
)
def test_pages(page, want):
    assert main_blocks(page) == want


def test_attributes():
    assert attributes_of(""" class="a b" ID=x data-x='1' hidden title="&amp;" class=c /""") == {"class": "a b", "id": "x", "data-x": "1", "hidden": "", "title": "&"}
    assert attributes_of(" = '") == {} and attributes_of("") == {}


@pytest.mark.parametrize("part", ["<a ", "<div></x>", "</script ", "<script></script ", '<a b="c', "<!", "<p x='\"", "<a x=   ", "<textarea", "<b><article><div>", "</b></article>", "&", "<!--", "<![CDATA["])
def test_hostile_pages_take_time_in_proportion(part):
    began = time.process_time()
    main_blocks(part * (2_000_000 // len(part)) + "'")
    assert time.process_time() - began < 20  # a reader that goes back takes hours


def test_deep_pages():
    began = time.process_time()
    main_blocks("<b><article>" + "<div>" * 200_000 + "</b>" * 200_000)
    assert time.process_time() - began < 20


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, f"<p>{LONG}</p>", "x"), (1, f"<p>{LONG}</p>", "x"), (2, None, "y")], "page_id long, html string, text string")
    rows = sorted(tuple(r) for r in html_text.extract(df, "page_id").collect())
    assert rows == [(1, LONG, len(LONG)), (1, LONG, len(LONG)), (2, "", 0)]
    assert html_text.extract(df.where("false"), "page_id").count() == 0
