import hashlib

import pytest
from pyspark.sql import functions as F

from quire.llm import quotes
from quire.llm.registry import op4_quotations

SF = "/root/testdata/sf0.01"


def test_levels_and_passages():
    assert quotes.split_level("> > deep") == (2, "deep") and quotes.split_level(">>x") == (2, "x")
    assert quotes.split_level("plain > not") == (0, "plain > not")
    clean, passages = quotes.parse("> One  two\n> THREE\n>\n>> old\nmine\n\nmore")
    assert clean == "mine\n\nmore" and [v for v, _ in passages] == [1, 2, 0, 0]
    assert passages[0][1] == quotes.parse("one two three")[1][0][1]


def test_replies_follow_quotations(spark):
    rows = [("c", 1, "alpha beta"), ("c", 2, "gamma"), ("c", 3, "> Alpha\n> beta\nyes"), ("c", 4, "> gamma\n>> alpha beta\nno"),
            ("c", 5, "> unknown words\nhm"), ("d", 1, "> alpha beta\nother"), ("d", 9, None), (None, 1, "> x\ny"),
            ("d", 9, "twin"), ("c", None, "z")]
    df = spark.createDataFrame([(c, t, x, 0) for c, t, x in rows], "conv_id string, turn long, text string, position int")
    got = {(r.conv_id, r.turn, r.clean_text): r for r in quotes.link_quotations(df).collect()}
    assert len(got) == len(rows)
    assert got["c", 3, "yes"].parent_turn == 1 and got["c", 4, "no"].parent_turn == 2
    assert got["c", 4, "no"].n_linked == 2 and got["c", 5, "hm"].parent_turn == 4 and got["c", 5, "hm"].n_linked == 0
    assert got["d", 1, "other"].parent_turn is None and got["d", 9, None].position == 2
    assert got[None, 1, "y"].position is None and got["d", 9, "twin"].parent_turn == 1
    assert quotes.link_quotations(df.limit(0)).count() == 0


def test_query_undoes_the_quotations(spark):
    got = op4_quotations(spark, SF).collect()
    texts = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        assert r.clean_sha256 == hashlib.sha256(texts[r.conv_id, r.turn].encode()).hexdigest()
        assert r.parent_turn == (r.turn - 1 if (r.conv_id, r.turn - 1) in texts else None) and r.position == r.turn + 1


def test_ranges_of_turns_are_joined(spark, monkeypatch):
    monkeypatch.setattr(quotes, "RANGE", 8)
    df = spark.createDataFrame([("a", t * 3) for t in range(50)], "conv_id string, turn long")
    rows = sorted(quotes.positions(df).collect(), key=lambda r: r.turn)
    assert [r.position for r in rows] == list(range(1, 51))
    assert [r.previous for r in rows] == [None, *[t * 3 for t in range(49)]]


def linked(spark, texts, step=1):
    df = spark.createDataFrame([("c", t * step, x) for t, x in enumerate(texts)], "conv_id string, turn long, text string")
    return {r.turn // step: r for r in quotes.link_quotations(df).collect()}


@pytest.mark.parametrize("width", [2, 1 << 12])
def test_repeated_passages_belong_to_the_latest_original(spark, monkeypatch, width):
    monkeypatch.setattr(quotes, "RANGE", width)
    texts = ["ok", "a b", "ok", "thanks", "> ok\nfine", "ok", "> ok\nyes",       # 6 answers 5, not 0
             "one\n\nthanks", "thanks", "> one\n>\n> thanks\nwell",            # 9 answers 7, which wrote all of it
             "> one\nleft\n> thanks\nright", "p\n\nq\n\nr", "p", "q",         # 10 too, answered in between
             "> p\n>\n> q\nx", "> nothing known\ny", "> a b\n>> thanks\nz"]
    got = linked(spark, texts, step=3)
    assert [got[t].parent_turn // 3 for t in (4, 6, 9, 10, 14, 15, 16)] == [2, 5, 7, 7, 11, 14, 1]
    assert [got[t].n_linked for t in (4, 6, 9, 14, 15, 16)] == [1, 1, 2, 2, 0, 2]


@pytest.mark.parametrize("back", [1, 3])
def test_links_of_the_test_table_are_found(spark, back):
    """Also when a turn other than the one before is quoted, where the fallback is wrong."""
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    if back == 1:
        sent = quotes.with_quotations(conv)
    else:
        old = conv.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("text").alias("_old"))
        sent = conv.join(old, ["conv_id", "turn"]).withColumn("text", F.concat(quotes.quote(F.col("_old")), F.lit("\n"), "text"))
        sent = sent.drop("_old").unionByName(conv.where(F.col("turn") < back))
    got = [r for r in quotes.link_quotations(sent).collect() if r.turn >= back]
    assert got and all(r.n_linked == r.n_passages > 0 and r.parent_turn == r.turn - back for r in got)
