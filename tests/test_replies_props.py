"""Property tests for replies whose outcome is chosen first: a reply is built from
a chosen stage and from cards chosen to be kept, skipped or fatal, and the engine
must report what was chosen."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.operators import cards as C

REPLIES = "reply_id long, book_id string, chapter_title string, response_text string"
TITLE = "Lesson 9"

words = st.text(alphabet="abc xyz:", min_size=0, max_size=6)
required = {"front": words, "back": words, "card_type": words}

# (what must become of it, the card)
kept = st.fixed_dictionaries(required, optional={"tags": st.lists(words, max_size=2), "source": words,
                                                 "difficulty": st.integers(-5, 5)}).map(lambda c: ("keep", c))
skipped = st.one_of(
    words, st.integers(0, 3),
    st.fixed_dictionaries({"front": words, "back": words}),
    st.fixed_dictionaries({"back": words, "card_type": words}, optional={"difficulty": st.just("hard")}),
).map(lambda c: ("skip", c))
broken = st.sampled_from([("front", 3), ("back", None), ("card_type", True), ("tags", None), ("tags", [1]),
                          ("source", 4), ("difficulty", "hard"), ("difficulty", 2.5), ("difficulty", [1])])
fatal = st.tuples(st.fixed_dictionaries(required), broken).map(lambda x: ("fatal", {**x[0], x[1][0]: x[1][1]}))

# (stage, text around the JSON)
wrappers = st.sampled_from([("direct", "{}"), ("fenced", "```json\n{}\n```"), ("fenced", "Here:\n```\n{}\n```\nBye."),
                            ("greedy", "Sure. {} Enjoy."), ("greedy", "{} trailing")])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(wrappers, st.lists(st.one_of(kept, kept, skipped, fatal), max_size=4)), min_size=1, max_size=10))
def test_what_was_chosen_comes_back(spark, items):
    rows, want = [], set()
    for i, ((_, around), chosen) in enumerate(items):
        rows.append((i, "b", TITLE, around.replace("{}", json.dumps({"cards": [c for _, c in chosen]}), 1)))
        if all(kind != "fatal" for kind, _ in chosen):
            want |= {(i, n, c["front"], c["back"], c["card_type"], tuple(c.get("tags", [])), c.get("source", TITLE),
                      c.get("difficulty")) for n, (kind, c) in enumerate(chosen, 1) if kind == "keep"}
    parsed = C.parse_replies(spark.createDataFrame(rows, REPLIES))
    stages = {r.reply_id: r.stage for r in parsed.select("reply_id", "stage").collect()}
    assert stages == {i: stage for i, ((stage, _), _) in enumerate(items)}
    got = {(r.reply_id, r.card_no, r.front, r.back, r.card_type, tuple(r.tags), r.source, r.difficulty)
           for r in C.valid_cards(parsed).collect()}
    assert got == want


def test_lax_difficulties(spark):
    """Values whose integer is known by construction."""
    known = [(2.0, 2), (" 3 ", 3), ("3.0", 3), ("-2", -2), (True, 1), (None, None)]
    rows = [(i, "b", TITLE, json.dumps({"cards": [{"front": "f", "back": "b", "card_type": "qa", "difficulty": v}]}))
            for i, (v, _) in enumerate(known)]
    got = {r.reply_id: r.difficulty
           for r in C.valid_cards(C.parse_replies(spark.createDataFrame(rows, REPLIES))).collect()}
    assert got == {i: n for i, (_, n) in enumerate(known)}
