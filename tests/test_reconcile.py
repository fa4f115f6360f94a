"""Requests and replies held against one another; reports of replies that share an id."""

import json

from conftest import SF_SMALL
from quire.operators import cards as C
from quire.operators import export as K
from quire.plans import queries as Q

CARD = '{"front":"f","back":"b","card_type":"qa"}'
GOOD, NONE, BAD = f'{{"cards":[{CARD}]}}', "sorry", '{"cards":[{"front":1,"back":"b","card_type":"qa"}]}'
REPLIES = "request_id long, attempt long, reply_id long, book_id string, chapter_title string, response_text string"


def test_every_request_and_reply_has_a_row(spark):
    requests = spark.createDataFrame([(1,), (2,), (3,), (3,), (4,), (None,), (None,)], "request_id long")
    replies = spark.createDataFrame([
        (1, 1, 10, "a", "t", NONE), (1, 2, 11, "a", "t", GOOD),      # answered at the second attempt
        (2, 1, 20, "a", "t", GOOD), (2, 2, 21, "a", "t", BAD),       # the later reply replaces the good one
        (4, None, 40, "a", "t", GOOD), (4, 0, 41, "a", "t", NONE),   # an attempt without a number counts as the first
        (9, 1, 90, "a", "t", GOOD), (9, 1, 90, "a", "t", GOOD),      # nobody asked, twice
        (None, 1, 5, "a", "t", GOOD), (None, 7, None, "a", "t", None),
    ], REPLIES)
    got = C.reconcile(requests, C.parse_replies(replies)).collect()
    known = {r.request_id: (r.status, r.requests, r.attempts, r.last_attempt, r.fatal, r.cards) for r in got if r.request_id is not None}
    assert known == {
        1: ("answered", 1, 2, 2, 0, 1), 2: ("empty", 1, 2, 2, 1, 0), 3: ("no_reply", 2, 0, None, None, None),
        4: ("empty", 1, 2, 0, 0, 0), 9: ("unrequested", 0, 2, 1, 0, 1)}
    rest = sorted((r.status, r.requests, r.attempts, r.last_attempt or 0, r.cards or 0) for r in got if r.request_id is None)
    assert rest == [("no_reply", 1, 0, 0, 0)] * 2 + [("unidentified", 0, 1, 1, 1), ("unidentified", 0, 1, 7, 0)]
    assert sum(r.requests for r in got) == 7 and sum(r.attempts for r in got) == 10
    summary = {r.status: (r["keys"], r.cards) for r in C.reconciliation_summary(C.reconcile(requests, C.parse_replies(replies))).collect()}
    assert summary == {"answered": (1, 1), "empty": (2, 0), "no_reply": (3, 0), "unrequested": (1, 1), "unidentified": (2, 1)}


def test_empty_sides(spark):
    none = C.parse_replies(spark.createDataFrame([], REPLIES))
    some = spark.createDataFrame([(1,)], "request_id long")
    assert [r.status for r in C.reconcile(some, none).collect()] == ["no_reply"]
    assert C.reconcile(some.limit(0), none).count() == 0


def test_report_counts_replies_of_one_id_each(spark):
    replies = spark.createDataFrame([(1, 1, 10, "a", "t", GOOD), (1, 1, 10, "a", "t", BAD), (1, 1, None, "a", "t", GOOD)], REPLIES)
    got = sorted((r.reply_id or 0, r["items"], r.fatal, r.cards) for r in C.reply_report(C.parse_replies(replies)).collect())
    assert got == [(0, 1, 0, 1), (10, 1, 0, 1), (10, 1, 1, 0)]


def test_each_candidate_is_parsed_once(spark):
    for name in ("cards_valid", "cards_exploded", "reply_report", "reply_parse_stage"):
        plan = Q.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parse_json(") <= 3, name
        assert plan.count("schema_of_variant(") + plan.count("schemaofvariant(") <= 40, name


def test_export_of_replies_that_share_an_id_is_json(spark, tmp_path):
    books = spark.createDataFrame([(1, 1, "T", "A")], "book_id long, discovery_no long, title string, author string")
    cards = [(7, 1, 1, f, "b", "qa", ["x"], "s", 1) for f in ("one", "two", "two", "three")]
    cards += [(7, 1, 2, "last", "b", "qa", [], "s", None)] * 2 + [(None, 1, 1, "no id", "b", "qa", [], "s", None)]
    df = spark.createDataFrame(cards, "reply_id long, book_id long, card_no int, front string, back string, card_type string, "
                                      "tags array<string>, source string, difficulty long")
    chapters = spark.createDataFrame([(1, 1)], "book_id long, chapter_number int")
    K.write_cards(books, chapters, df, str(tmp_path), "json", "2024-01-01T00:00:00")
    parts = sorted((tmp_path / "json" / "file_stem=T").glob("part-*"))
    doc = json.loads("".join(p.read_text() for p in parts))
    assert doc["metadata"]["total_flashcards"] == 7
    assert sorted(c["front"] for c in doc["flashcards"]) == ["last", "last", "no id", "one", "three", "two", "two"]
    assert [c["front"] for c in doc["flashcards"]][-2:] == ["last", "last"]
