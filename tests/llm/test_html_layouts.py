"""Boilerplate words in class names of wrappers, long tags, formulas."""

import pytest

from skewkit.llm.html_extract import main_text

BODY = "".join(f"<p>Paragraph {i} of the article goes on with some more words, as they all do.</p>" for i in range(4))
TEXT = "\n\n".join(f"Paragraph {i} of the article goes on with some more words, as they all do." for i in range(4))
REST = ('<div class="sidebar"><p>Most read stories of the week, in a list.</p></div><div class="cookie-notice"><p>We use cookies here.</p></div>'
        '<div id="comments"><p>I liked it very much, thank you.</p></div><footer>All rights reserved.</footer>')


@pytest.mark.parametrize("open_, close", [
    ('<div class="page has-sidebar"><article>', "</article></div>"), ('<main class="no-sidebar">', "</main>"),
    ('<div class="post comments-open">', "</div>"), ('<div class="sidebar-layout"><div class="menu">', "</div></div>"),
    ('<div class="social"><div class="widget"><article>', "</article></div></div>"), ('<div class="page with-nav share">', "</div>"),
    ('<div class="tags story">', "</div>"), ('<div class="header-visible"><div id="popup-root">', "</div></div>"),
    ('<div aria-hidden="true">', "</div>")])
def test_layout_words_on_wrappers(open_, close):
    assert main_text(f"<body>{open_}{BODY}{close}{REST}</body>")[0] == TEXT
    assert main_text(f"<body>{open_}{BODY}{REST}{close}</body>")[0] == TEXT


def test_long_comments_and_teasers_stay_out():
    comment = '<article class="comment-body"><p>I liked it very much, thank you for writing all of this.</p></article>'
    page = f'<article>{BODY}</article><div id="comments">{comment * 12}</div><div class="related"><article><p>Teaser of a text.</p></article></div>'
    assert main_text(page)[0] == TEXT
    assert main_text(f'<div class="post">{BODY}</div><div id="comments">{"<p>I liked it very much, thank you.</p>" * 20}</div>')[0] == TEXT


def test_tags_of_many_attributes():
    attrs = " ".join(f'data-{i}="a > b"' for i in range(300))
    assert main_text(f"<p {attrs}>The text of it.</p>")[0] == "The text of it."


def test_formulas_are_text():
    page = "<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='application/x-tex'>x=2 tex</annotation></math> holds.</p></article>"
    assert main_text(page)[0] == "So x=2 holds."


def test_words_of_other_attributes_hide_nothing():
    assert main_text('<p title="a hidden gem" data-hidden="no" data-id="sidebar">The text of it.</p>')[0] == "The text of it."
