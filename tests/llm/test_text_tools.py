"""HTML extraction, chat formatting, license scans."""

import random

import pytest
from llm_data import DOCS, extra_columns, odd_texts, prose, rows

from skewkit.llm import chat, html_extract, licenses

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body class="page"><header><a href="/">Site</a></header><nav><ul><li><a href="/a">Home</a></li><li><a>News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for all of our readers.</p></div><!-- ad <p>no</p> -->
<article><h1>The   title</h1><p><b>Lead &mdash; text<br>goes on<p>A first paragraph with <a href="x">a link</a> in it, and more words.</p>
<div class="ad">Buy this very fine thing now, it is on sale today.</div><ul><li>Point one of it.</li><li>Point two.</li></ul>
<p>Last one: 1 &lt; 2 &#233;t&#xe9;.</p></article><aside><p>Most read stories of the week, in a list of them.</p></aside>
<section id="comments"><h3>Comments</h3><p>I liked this article very much, thank you for writing it.</p></section>
<form><label>Name</label><input value="x"><button>Send</button></form><footer>&copy; 2024 Site. All rights reserved.</footer></body></html>"""


def test_article_of_a_page():
    text, n, chosen = html_extract.main_text(PAGE)
    assert text == ("The title\n\nLead — text goes on\n\nA first paragraph with a link in it, and more words.\n\n"
                    "Point one of it.\n\nPoint two.\n\nLast one: 1 < 2 été.")
    assert n > chosen == 6


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain words only", "plain words only"), ("<script>x<p>", ""), ("<p hidden>a b c</p>", ""),
    ("a < b and c > d", "a < b and c > d"), ("<!-- never closed <p>x</p>", ""), ("<p>Unclosed one.<p>Unclosed two.", "Unclosed one.\n\nUnclosed two."),
    ("</div></p>stray ends here.", "stray ends here."), ("<div style='display:none'>x y</div><p>Shown text.</p>", "Shown text.")])
def test_odd_pages(html, text):
    assert html_extract.main_text(html)[0] == text


def test_minimum_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 8)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, i + 1, rng.uniform(0, 2)) for i in range(n - 1)] + [
            (a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 2, n) if rng.random() < 0.3]

        def cost(label):
            return (sum(-min(c, 0) if on else max(c, 0) for c, on in zip(odds, label, strict=True))
                    + sum(c for a, b, c in edges if label[a] != label[b]))
        least = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert abs(cost(html_extract.minimum_cut(odds, edges)) - least) < 1e-6


def test_smoothness_decides_doubtful_blocks():
    assert html_extract.minimum_cut([3.0, -0.4, 3.0], [(0, 1, 0.5), (1, 2, 0.5)]) == [True, True, True]
    assert html_extract.minimum_cut([3.0, -1.4, 3.0], [(0, 1, 0.5), (1, 2, 0.5)]) == [True, False, True]


def test_extract_rows(spark):
    data = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "<p>" + "word " * 50_000, "y")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, text string")
    out = html_extract.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"], len(r["text"])) for r in out) == [
        (0, 0, 0), (1, 172, 172), (1, 172, 172), (2, 249_999, 249_999)] or len(out) == 4
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    assert html_extract.extract(pages.limit(0)).collect() == []


CONV = "conv_id long, turn long, role string, text string"
TALK = [
    (1, 0, "user", "Hello there. How is the weather today?\nI need to know."),
    (1, 1, "assistant", "On Monday, user wrote:\n> Hello there. How is\n> the  WEATHER today?\n\nIt is sunny."),
    (1, 2, "user", "Other topic entirely."),
    (1, 3, "user", "assistant wrote:\n> user wrote:\n>> Hello there. How is the weather today?\n> It is sunny.\nGreat!"),
    (1, 4, "assistant", "> Great!\nYes."), (1, 5, "user", "> Other topic entirely."),
    (2, 0, "user", None), (2, 0, "user", None), (None, None, None, "> nothing known\nx"), (2, 1, "user", "> It is sunny.\nok")]


def test_replies_follow_what_they_quote(spark):
    out = chat.format_chats(spark.createDataFrame(TALK, CONV)).orderBy("conv_id", "position").collect()
    got = [(r["conv_id"], r["turn"], r["text"], r["parent_turn"], r["thread_turn"], r["depth"], r["position"], r["n_copies"]) for r in out]
    assert got == [
        (None, None, "x", None, None, 0, 0, 1),
        (1, 0, TALK[0][3], None, 0, 0, 0, 1), (1, 1, "It is sunny.", 0, 0, 1, 1, 1), (1, 3, "Great!", 1, 0, 2, 2, 1),
        (1, 4, "Yes.", 3, 0, 3, 3, 1), (1, 2, "Other topic entirely.", None, 2, 0, 4, 1), (1, 5, "", 2, 2, 1, 5, 1),
        (2, 0, "", None, 0, 0, 0, 2), (2, 1, "ok", None, 1, 0, 1, 1)]
    assert all(">" not in r["chat"].replace("<|", "").replace("|>", "") for r in out)


def test_quotes_are_parsed_by_level():
    assert chat.parse("a\n> b\n> > c\n>> d\nMary wrote:\n> e\nf") == ("a\nf", [(1, "b"), (2, "c\nd"), (1, "e")])
    assert chat.parse(None) == ("", []) and chat.parse("x > y") == ("x > y", [])
    assert chat.sentences("  One two.  THREE\nfour! (five) ") == ["one two", "three four", "five"]


def test_deep_and_large_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "TURNS_PER_RANGE", 7)
    deep = [(1, t, "user", (f"> Message number {t - 1} it is.\n" if t else "") + f"Message number {t} it is.") for t in range(70)]
    wide = [(2, t, "user", ("> The first of all.\n" if t else "The first of all. ") + f"Reply {t}.") for t in range(60)]
    flat = [(3, t, "user", f"No quote {t}.") for t in range(50)]
    out = chat.format_chats(spark.createDataFrame(deep + wide + flat, CONV)).collect()
    for r in out:
        assert r["position"] == r["turn"]
        want = {1: (r["turn"] - 1 if r["turn"] else None, 0, r["turn"]), 2: (0 if r["turn"] else None, 0, min(r["turn"], 1)),
                3: (None, r["turn"], 0)}[r["conv_id"]]
        assert (r["parent_turn"], r["thread_turn"], r["depth"]) == want
    assert len(out) == 180


def test_chat_of_nothing(spark):
    assert chat.format_chats(spark.createDataFrame([], CONV)).collect() == []
    clash = spark.createDataFrame([(1, 0, "user", "x", 9, "y")], CONV + ", position long, own string")
    assert chat.format_chats(clash).count() == 1


def test_licenses_are_found_where_they_stand():
    scan = licenses.Scanner().scan
    text = "x Licensed under CC BY-NC 4.0. y Released under the MIT License. Released under the MIT License."
    assert scan(text) == [("CC-BY-NC-4.0", 1.0, 2, 29), ("MIT", 1.0, 33, 63), ("MIT", 1.0, 65, 95)]
    (found,) = scan("foo " + licenses.TEMPLATES["Apache-2.0-header"] + " bar")
    assert found[:2] == ("Apache-2.0-header", 1.0)
    (changed,) = scan(licenses.TEMPLATES["MIT-text"].replace("Software", "Program", 1).replace("free of charge", "gratis"))
    assert changed[0] == "MIT-text" and 0.9 < changed[1] < 1.0
    assert scan("the license of the copy under the sea") == scan("") == scan(None) == []


def test_alignment_is_patience():
    rng = random.Random(5)
    for _ in range(300):
        a, b = rng.choices("abcdefgh", k=rng.randint(0, 12)), rng.choices("abcdefgh", k=rng.randint(0, 12))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    # the unique words anchor the rest: the longest increasing run of them wins
    assert [i for i, _ in licenses.align("x a b c y".split(), "y a b c x".split())] == [1, 2, 3]
    assert licenses.align(list("abcabc"), list("abcabc")) == [(i, i) for i in range(6)]


def test_license_rows(spark):
    texts = odd_texts() + ["Released under the MIT License."] * 2 + [prose(random.Random(1)) + " Licensed under CC BY 4.0."]
    out = licenses.scan_licenses(extra_columns(spark, texts)).collect()
    assert sorted((r["doc_id"], r["license"]) for r in out) == [(9, "MIT"), (10, "MIT"), (11, "CC-BY-4.0")]
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []
    assert licenses.scan_licenses(spark.createDataFrame(rows(["my own terms apply here"]), DOCS), {"own": "my own terms apply"}).count() == 1
    assert licenses.scan_licenses(spark.createDataFrame(rows(["x"]), DOCS), {}).collect() == []
