"""Elements inside a line: hidden ones, adverts, share links, labels, and all others."""

import pytest

from skewkit.llm.html_extract import main_text

BEFORE = "The first part of this sentence, which is long enough to be text,"
AFTER = "and the second part of it, which goes on for quite some words."
OTHERS = "".join(f"<p>Paragraph {i} of the article goes on with some more words, as they all do.</p>" for i in range(3))
REST = "\n\n".join(f"Paragraph {i} of the article goes on with some more words, as they all do." for i in range(3))


def line(inner, after=f" {AFTER}"):
    return main_text(f"<body><article><p>{BEFORE} {inner}{after}</p>{OTHERS}</article></body>")[0]


@pytest.mark.parametrize("inner", [
    "<span hidden>SECRET</span>", '<span style="display:none">SECRET</span>', '<b hidden="">SECRET <i>more</i></b>',
    '<span style="color:red; visibility : hidden">SECRET<span>inner</span>SECRET</span>',
    '<span class="ad">BUY NOW</span>', '<span class="ad inline">BUY <b>NOW</b> and <span>save</span></span>',
    '<a class="share" href="x">Share this</a>', '<a class="share-button">Share</a>', "<label>Your e-mail</label>",
    '<span id="newsletter-signup">Get our letter</span>', '<ins class="adsense">Advert</ins>'])
def test_what_does_not_belong_goes_and_the_line_is_one(inner):
    assert line(inner) == f"{BEFORE} {AFTER}\n\n{REST}"


@pytest.mark.parametrize("inner,text", [
    ("<span>plain</span>", "plain"), ('<a href="x">a link</a>', "a link"), ("<b>bold <i>both</i></b>", "bold both"),
    ('<span class="term">word</span>', "word"), ('<a class="related-work" href="x">work</a>', "work"), ('<em class="share-price">12</em>', "12"),
    ('<span class="loaded address">home</span>', "home"), ('<span data-hidden="no" title="hidden">seen</span>', "seen"),
    ('<span aria-hidden="true">x</span>', "x"), ("<span hidden/>kept", "kept")])
def test_other_inline_elements_change_nothing(inner, text):
    assert line(inner) == f"{BEFORE} {text} {AFTER}\n\n{REST}"


def test_no_white_space_is_made_up():
    assert line('word<span class="ad">BUY</span>', after=f", {AFTER}") == f"{BEFORE} word, {AFTER}\n\n{REST}"
    assert line("wo<span hidden>x</span>rd", after=f", {AFTER}") == f"{BEFORE} word, {AFTER}\n\n{REST}"


def test_missing_and_crossed_ends():
    page = f"<article><p>{BEFORE} <span hidden>SECRET</p><p>{AFTER}</p>{OTHERS}</article>"
    assert main_text(page)[0] == f"{BEFORE}\n\n{AFTER}\n\n{REST}"
    page = f'<article><p>{BEFORE} <span class="ad">BUY NOW</p><p>{AFTER}</p>{OTHERS}</article>'
    assert main_text(page)[0] == f"{BEFORE}\n\n{AFTER}\n\n{REST}"
    assert line("<b><span hidden>SECRET</b></span> seen") == f"{BEFORE} seen {AFTER}\n\n{REST}"
    assert line("</span></b> seen") == f"{BEFORE} seen {AFTER}\n\n{REST}"
    page = f"<article><p>{BEFORE} <span hidden>SECRET<p>{AFTER}</p>{OTHERS}</article>"
    assert main_text(page)[0] == f"{BEFORE}\n\n{AFTER}\n\n{REST}"


def test_blocks_inside_inline_elements():
    page = f'<article><a hidden><div>SECRET</div></a><span class="ad"><div><p>BUY NOW, it is cheap today.</p></div></span>{OTHERS}</article>'
    assert main_text(page)[0] == REST
