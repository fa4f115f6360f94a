"""C4 against Python's own reader: repeated keys, NaN and Infinity."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.operators import cards as C

REPLIES = "reply_id long, book_id string, chapter_title string, response_text string"

texts = st.lists(st.sampled_from(["a", "NaN", "Infinity", "-Infinity", ":", ",", "{", "\"", "\\", " ", "é"]), max_size=5).map("".join)
string = texts.map(lambda x: json.dumps(x, ensure_ascii=False))
number = st.sampled_from(["1", "-2", "0.5", "NaN", "Infinity", "-Infinity"])
key = st.sampled_from(["front", "front", "back", "back", "card_type", "card_type", "difficulty", "other"])
member = st.one_of(st.tuples(key, string), st.tuples(st.sampled_from(["difficulty", "other", "other", "front"]), number))
full = st.tuples(string, string, string, st.lists(member, max_size=4)).map(
    lambda c: [("front", c[0]), ("back", c[1]), ("card_type", c[2]), *c[3]])
card = st.one_of(full, st.lists(member, max_size=3)).map(lambda m: "{" + ", ".join(f'"{k}": {v}' for k, v in m) + "}")
cards = st.lists(st.one_of(card, card, number, string), max_size=3).map(lambda x: "[" + ",".join(x) + "]")
reply = st.lists(st.one_of(cards, cards, number), min_size=1, max_size=2).map(
    lambda x: "{" + ",".join(f'"cards": {c}' for c in x) + "}")


def plain(text):
    """Cards of a reply by Python's reader and the rules of SURVEY C5 and C7; None for no JSON."""
    value = json.loads(text)
    listed = value.get("cards") if isinstance(value, dict) else None
    out = []
    for n, c in enumerate(listed if isinstance(listed, list) else [], 1):
        if not isinstance(c, dict) or not all(k in c for k in ("front", "back", "card_type")):
            continue
        d = c.get("difficulty")  # no text made above is an integer
        if not all(isinstance(c[k], str) for k in ("front", "back", "card_type")) or not (d is None or isinstance(d, int)):
            return []
        out.append((n, c["front"], c["back"], c["card_type"], d))
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(reply, min_size=1, max_size=40))
def test_like_pythons_reader(spark, replies):
    parsed = C.parse_replies(spark.createDataFrame([(i, "b", "t", x) for i, x in enumerate(replies)], REPLIES))
    assert {r.stage for r in parsed.select("stage").collect()} == {"direct"}
    got = {i: [] for i in range(len(replies))}
    for r in C.valid_cards(parsed).orderBy("reply_id", "card_no").collect():
        got[r.reply_id].append((r.card_no, r.front, r.back, r.card_type, r.difficulty))
    assert got == {i: plain(x) for i, x in enumerate(replies)}


def test_what_python_refuses_is_refused(spark):
    good = ['{"a": NaN}', '{"a": [-Infinity,Infinity]}', '{"a": 1, "a": 2}', '{"NaN": "\\\\"}', '{"a": "\\\\", "b": NaN}', "[NaN]"]
    bad = ['{"a": -NaN}', '{"a": 1NaN}', '{"a": NaNa}', '{"a": +Infinity}', '{"a": --Infinity}', "{NaN: 1}", '{"a": nan}',
           '{"a": "\x01", "b": NaN}', '{"a": \x01NaN}', '{"a": NaN', '{"a": "NaN}', '{"a": "\\", "b": NaN}']
    for x in good:
        json.loads(x)
    for x in bad:
        try:
            json.loads(x)
            raise AssertionError(x)
        except json.JSONDecodeError:
            pass
    rows = [(i, "b", "t", x) for i, x in enumerate(good + bad)]
    parsed = C.parse_replies(spark.createDataFrame(rows, REPLIES))
    stages = {r.reply_id: r.stage for r in parsed.select("reply_id", "stage").collect()}
    assert stages == {i: "direct" if i < len(good) else "none" for i in range(len(rows))}


def test_long_replies(spark):
    many = ",".join('{"front": "say \\"NaN\\"", "back": "b", "card_type": "qa", "other": NaN}' for _ in range(20000))
    parsed = C.parse_replies(spark.createDataFrame([(1, "b", "t", '{"cards": [' + many + "]}")], REPLIES))
    got = C.valid_cards(parsed).select("front").distinct().collect()
    assert [r.front for r in got] == ['say "NaN"'] and C.valid_cards(parsed).count() == 20000
