"""Reply parsing and card validation."""

from pyspark.sql import functions as F

from conftest import SF_CHECK
from quire.functions import replies as R
from quire.operators import cards as C
from quire.plans.queries import Corpus

REPLIES = "reply_id long, book_id string, chapter_title string, response_text string"


def test_reply_text_cascade(spark):
    df = spark.createDataFrame([
        ("F", [["x"]], ["m"], "c"),
        ("", [["a", "b"], ["", "c"], []], ["m"], "c"),
        (None, [[], [""]], ["m"], "c"),
        (None, [], ["m1", "m2"], "c"),
        (None, None, None, "c"),
    ], "final_output string, items array<array<string>>, messages array<string>, content string")
    got = [r[0] for r in df.select(R.reply_text("final_output", "items", "messages", "content")).collect()]
    assert got == ["F", "a", None, "m2", "c"]


def test_validation_severities(spark):
    g = '{"front":"q","back":"a","card_type":"basic","tags":["t::s","u"],"source":"S 1","difficulty":2}'
    rows = [
        (7, "b", "L", '{"cards":[' + g + ',{"front":"q","card_type":"qa","difficulty":"hard"}]}'),
        (8, "b", "L", '{"cards":[' + g + ',{"front":"q","back":"x","card_type":"qa","difficulty":"hard"}]}'),
        (9, "b", "L", '{"cards":[{"front":"q","back":"x","card_type":"qa","tags":null}]}'),
        (11, "b", "L", '{"cards":["x",{"front":"q","back":"x","card_type":"odd","difficulty":" 3 "}]} trailing'),
        (12, "b", "L", '```json\n{"cards":[{"front":"q","back":"x","card_type":"cloze","difficulty":2.0}]}\n```'),
        (13, "b", "L", '{"cards":[{"front":"q","back":"x","card_type":"qa","difficulty":2.5}]}'),
    ]
    parsed = C.parse_replies(spark.createDataFrame(rows, REPLIES))
    got = {(r.reply_id, r.card_no): (r.card_type, r.source, r.difficulty, list(r.tags))
           for r in C.valid_cards(parsed).collect()}
    assert got == {
        (7, 1): ("basic", "S 1", 2, ["t::s", "u"]),
        (11, 2): ("odd", "L", 3, []),
        (12, 1): ("cloze", "L", 2, []),
    }
    stages = {r.reply_id: r.stage for r in parsed.collect()}
    assert stages == {7: "direct", 8: "direct", 9: "direct", 11: "greedy", 12: "fenced", 13: "direct"}


def test_fixture_replies_sf001(spark):
    c = Corpus(spark, SF_CHECK)
    assert c.responses.count() == 233
    per_variant = {r.variant: r.n for r in c.cards.join(c.responses.select("reply_id", "variant"), "reply_id")
                   .groupBy("variant").agg(F.count("*").alias("n")).collect()}
    n_replies = {r.variant: r["count"] for r in c.responses.groupBy("variant").count().collect()}
    expected_cards = {0: 2, 1: 1, 2: 2, 3: 1, 7: 1, 11: 1, 12: 1}
    assert per_variant == {v: k * n_replies[v] for v, k in expected_cards.items()}


def test_card_mix_basis_points(spark):
    cards = spark.createDataFrame([("b", "basic"), ("b", "basic"), ("b", "cloze")], "book_id string, card_type string")
    got = {r.card_type: (r.share_bp, r.target_bp) for r in C.card_mix(cards).collect()}
    assert got == {"basic": (6666, 6000), "cloze": (3333, 2000), "definition": (0, 1500), "qa": (0, 500)}
