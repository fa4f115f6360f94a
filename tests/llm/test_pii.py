import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import pii
from quire.llm.registry import op1_pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    """The stated patterns, tried as they stand."""
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(re.sub(r"\D", "", m.group())) <= 15]
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a.@-1234560 +()é", max_size=60))
def test_base_spans_match_the_plain_patterns(text):
    assert sorted(pii.base_spans(text)) == brute(text)
    assert sorted((s, e, k) for s, e, k, added in pii.find(text) if not added) == brute(text)


def found(text):
    return [(text[s:e], k) for s, e, k, added in pii.find(text) if added]


def test_disguises_map_back_to_source_characters():
    for text, want in [
        ("mail john.smith [at] example (dot) com now", [("john.smith [at] example (dot) com", "email")]),
        ("bob at example dot com", [("bob at example dot com", "email")]),
        ("hnp.46 at mail3.example.com x", [("hnp.46 at mail3.example.com", "email")]),
        ("call plus one two six nine five five five three two nine six ok",
         [("plus one two six nine five five five three two nine six", "phone")]),
        ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", [("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email")]),
        ("jоhn@exаmple.com", [("jоhn@exаmple.com", "email")]),
        ("jo​hn@exam­ple.com", [("jo​hn@exam­ple.com", "email")]),
        ("192[.]168[.]0[.]1", [("192[.]168[.]0[.]1", "ip")]),
        ("one nine two dot one six eight dot one dot one", [("one nine two dot one six eight dot one dot one", "ip")]),
        ("four " + "one " * 15, [("four " + "one " * 14 + "one", "card")]),
        ("mail john at example.com please", [("john at example.com", "email")]),
        ("E-mail: john at example.com", [("john at example.com", "email")]),
        ("write to jane_d at mail.example.org", [("jane_d at mail.example.org", "email")]),
        ("dial +1 five five 0 one two 3 four five six", [("+1 five five 0 one two 3 four five six", "phone")]),
        ("j𝐨hn@example.com", [("j𝐨hn@example.com", "email")]),
    ]:
        assert found(text) == want, text


def test_clean_prose_is_left_alone():
    for text in ["I scored 7 at game.com yesterday", "room b2 at hotel.paris is nice", "contact us at example.com",
                 "we met john at example.com", "an antidote, plusher, 3 one 4", "look at example.com", "one at a time", "the dot on the i", "", "é at ü", "seven or eight of nine"]:
        assert pii.find(text) == []
        assert pii.redact(text, pii.find(text)) == text


PIECES = ["mail ", "john", " at ", "example", ".com", " dot ", "[at]", "(.)", "one", "two", "ſix", "nıne", " ", ", ", "-",
          "7", "42", "+1 ", "plus ", "İ", "é", "b2", "anecdote ", "DOT", "Plus\t", "\n", "1.2.3.4", "@x.yz"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_texts_without_a_hint_have_no_disguise(text):
    """The quick test in front never hides what the transducers would find."""
    if not pii._disguised(text):
        assert not any(pii._spelled_ip_changes(text) + pii._spelled_changes(text) + pii._at_changes(text))
        assert not any(p.search(text) for p in (pii._PLUS, pii._BRACKET, pii._DOT))


def test_long_runs_stay_linear():
    for text in ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "at " * 100_000,
                 "mail to " * 50_000, "one " * 80_000 + "x", "1 one " * 60_000, "a at b.c " * 40_000, "mail bob at b.c " * 30_000]:
        pii.find(text)


def test_overlapping_spans_become_one_mark():
    assert pii.redact("abcdefgh", [(1, 4, "card", False), (2, 6, "phone", False)]) == "a<CARD>gh"


def test_table_with_nulls_repeats_and_clashing_columns(spark, tmp_path):
    rows = [(1, "a@b.co 1.2.3.4", 7), (1, "a@b.co 1.2.3.4", 7), (2, None, 8), (3, "", None), (None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op1_pii(spark, str(tmp_path)).collect()), key=str)
    assert [r[:2] for r in got].count((1, 1)) == 2 and len(got) == 5
    assert {r[6] for r in got if r[0] == 1} == {"email:0:6,ip:7:14"}
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert {r[5] for r in got if r[0] in (2, 3)} == {empty}
    out = pii.redact_pii(df.withColumn("n_chars", df.spans.cast("long")), "text", "n_chars").collect()
    assert [r.text for r in out][:1] == ["<EMAIL> <IP>"] and out[2].text is None and out[0].n_chars == 12
    df.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert op1_pii(spark, f"{tmp_path}/empty").count() == 0
