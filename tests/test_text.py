"""Row-local text functions against hand-worked cases and plain Python."""

import string

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import one_col
from quire.functions import text as T


def test_word_count_cases(spark):
    vals = ["This is a test chapter with exactly nine words.", "", "   ", "a\xa0b\x1cc　d\x0be", "a​b"]
    assert one_col(spark, vals, T.word_count) == [9, 0, 0, 5, 1]


def test_safe_filename_cases(spark):
    vals = ['A<B>:"/\\|?* c ', "x" * 120, 'Vol/3: "Notes"? ']
    assert one_col(spark, vals, T.safe_filename) == ["A_B_________c", "x" * 100, "Vol_3___Notes__"]


def test_noise_rule_cases(spark):
    dropped = ["", "abcd", "123456", "PAGE 7", "Page 12 of the story", "²²²²²"]
    kept = ["abcde", "Pages 12", "12345 x"]
    got = one_col(spark, dropped + kept, lambda c: T.noise_rule(T.clean_line(c)))
    assert all(g is not None for g in got[: len(dropped)])
    assert all(g is None for g in got[len(dropped):])


def test_heading_like_cases(spark):
    true = ["A department store", "1 Two", "The Day Trader"]
    false = ["1 two", "The Day", "Don't Stop Me Now"]
    assert one_col(spark, true + false, T.heading_like) == [True] * 3 + [False] * 3


def test_heading_rule_cases(spark):
    vals = ["Chapter 1", "ch.3", "12 apples", "3. über", "Part two", "  SECTION 4 ", "1. Intro"]
    assert one_col(spark, vals, T.heading_rule) == ["chapter", "ch.", "n word", None, None, "section", "n."]


def test_preview(spark):
    assert one_col(spark, ["abc", "x" * 61], lambda c: T.preview(c, 60)) == ["abc", "x" * 60 + "..."]


def test_html_text_and_title(spark):
    html = ("<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style></head>"
            "<body><!-- c > d --><script>var t=\"</p>\";</script><h1> Head </h1><p>a &lt;b&gt;<br>c &#233;</p></body></html>")
    assert one_col(spark, [html], T.html_text) == ["T & U Head a <b> c é"]
    cases = [
        "<title>X</title><h1>H</h1>",
        "<title> </title><title>Y</title><h1>H</h1>",
        "<i>x</i><h1> </h1><h3>Three</h3>",
        '<h2 class="c"> Two <b>bold</b></h2>',
        "<p>none</p>",
        "<!-- <h1>old</h1> --><h1>new</h1>",
        "<script>var a='<h1>js</h1>'</script><h1>real</h1>",
        "<!-- <title>gone</title> --><title>Kept</title>",
    ]
    got = one_col(spark, cases, lambda c: T.chapter_title(c, 7))
    assert got == ["X", "", "Three", "Two bold", "Chapter 7", "new", "real", "Kept"]


def test_file_name_parts(spark):
    vals = ["/books/a.b/f1.epub", "/x/.bashrc", "/x/name.", "/books/my_src1-vol.pdf"]
    assert one_col(spark, vals, T.file_suffix) == [".epub", "", "", ".pdf"]
    assert one_col(spark, vals, lambda c: T.book_title_paged(T.F.lit(""), c))[3] == "my src1 vol"


texts = st.text(alphabet=string.ascii_letters + string.digits + " \t\n\xa0　\x1c.-" + "²٣", max_size=40)


@settings(max_examples=40, deadline=None)
@given(st.lists(texts, min_size=1, max_size=20))
def test_word_count_matches_python(spark, vals):
    assert one_col(spark, vals, T.word_count) == [len(v.split()) for v in vals]


# Lines whose fate is chosen: (is noise, the line).
digits = st.text(alphabet="0123456789", min_size=5, max_size=9)
noise = st.one_of(
    digits, st.text(alphabet="abc", max_size=4),
    st.tuples(st.sampled_from(["Page ", "page ", "PAGE "]), digits).map("".join),
).map(lambda s: (True, s))
prose = st.text(alphabet="bcdf", min_size=5, max_size=9)
text_lines = st.one_of(prose, st.tuples(prose, digits).map(" ".join), digits.map("pages ".__add__)).map(lambda s: (False, s))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.one_of(noise, text_lines), st.sampled_from(["", " ", "   "])), min_size=1, max_size=20))
def test_noise_rule_on_chosen_lines(spark, items):
    vals = [pad + line + pad for (_, line), pad in items]
    got = one_col(spark, vals, lambda c: T.noise_rule(T.clean_line(c)))
    assert [g is not None for g in got] == [is_noise for (is_noise, _), _ in items]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.one_of(st.tuples(prose, st.just("")), st.tuples(st.just(""), st.sampled_from('<>:"/\\|?* '))),
                         min_size=1, max_size=8), min_size=1, max_size=10))
def test_safe_filename_of_parts(spark, names):
    # Every unsafe mark and every inner blank is one underscore; letters stay.
    vals = ["x" + "".join(a + b for a, b in parts) + "y" for parts in names]
    want = ["x" + "".join(a or "_" for a, _ in parts) + "y" for parts in names]
    assert one_col(spark, vals, T.safe_filename) == [w[:100] for w in want]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=string.ascii_letters + " '-.", max_size=30), min_size=1, max_size=10))
def test_title_case_matches_python(spark, vals):
    assert one_col(spark, vals, T.is_title_case) == [v.istitle() for v in vals]


def test_references_as_html_parsers_read_them(spark):
    cases = [("a &#150; b", "a \u2013 b"), ("&copy 2020 &amp c", "\u00a9 2020 & c"), ("x&#0;y", "x\ufffdy"),
             ("&#x80;1", "\u20ac1"), ("&#65 B", "A B"), ("&amp;lt; &unknown; &", "&lt; &unknown; &"),
             ("&notin; &notit;", "\u2209 \u00acit;"), ("&#xD800;|&#99999999;", "\ufffd|\ufffd")]
    assert one_col(spark, [c[0] for c in cases], T.decode_entities) == [c[1] for c in cases]


def test_html_as_a_left_to_right_token_stream(spark):
    cases = [
        ('<p title="a > b">x</p>', "x"), ("<p data-a='>>' b=\"<\">x</p>y", "x y"),
        ("a<script>var x = '<p>no</p>'", "a"), ("a<!-- open <p>no</p>", "a"), ("a<style>p > q", "a"),
        ("1 < 2 <b>and</b> 3", "1 < 2 and 3"), ("x<br/>y<br>z", "x y z"), ("a <SCRIPT SRC='x>y'>no</SCRIPT > b", "a b"),
        ("", ""), ("plain", "plain"), ("<p>&nbsp;</p><p>&lt;b&gt;</p>", "<b>"), ("<!DOCTYPE html><p>d</p><?pi x?>", "d"),
        ("<template><p>no</p></template>yes", "yes"), ("a <b unclosed", "a <b unclosed"), ("<" * 3000, None),
    ]
    got = one_col(spark, [c[0] for c in cases], T.html_text)
    for (html, want), text in zip(cases, got):
        assert want is None or text.split() == want.split(), html


def test_text_and_title_from_one_scan(spark):
    html = '<title>A &amp; B</title><h1 class="x>y">H</h1><h2>&am<i>p;</i></h2>'
    got = one_col(spark, [html, "<h1>&nbsp;</h1><h2> two </h2>", "<title>a<b>c</title><h3>d", None], T.html_parts)
    assert [(r.text, r.title.title, r.title.source) for r in got[:3]] == [
        ("A & B H &am p;", "A & B", "title"), ("two", "two", "h2"), ("a c d", None, None)]
    assert got[3].text is None


names_ = st.sampled_from(["p", "b", "div", "em"])
attrs = st.sampled_from(["", ' a="1 > 0"', " b='<i>'", " c=d", ' e=">"'])
words = st.text(alphabet="abc ", min_size=1, max_size=6)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(
    words.map(lambda w: (w, w)),
    st.tuples(names_, attrs, words).map(lambda x: (f"<{x[0]}{x[1]}>{x[2]}</{x[0]}>", x[2])),
    st.tuples(words, attrs).map(lambda x: (f"<script{x[1]}>{x[0]}</script>", "")),
    words.map(lambda w: (f"<!--{w}<p>-->", ""))), max_size=12))
def test_html_text_of_chosen_nodes(spark, parts):
    html = "|".join(h for h, _ in parts)
    got = one_col(spark, [html], T.html_text)[0]
    assert "".join(got.split()) == "".join("|".join(w for _, w in parts).split())
