"""Token counts against the library on whole texts."""

import json

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from quire.llm import registry
from quire.llm import tokencount as K

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as f:
        return K.Counter(f.read())


def whole(counter, text):
    return len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


PARTS = st.sampled_from(["word", " ", "  ", "\n", "\t", "\u00a0", " ", "\x1c", "don't", "'s", "'", "!!", "...", "12", "3.5",
                         "<|endoftext|>", "<|endof", "text|>", "漢字", "。", "ü", "\u180e", "🙂", "é", ", ", ".", "²"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=40).map("".join), st.integers(1, 12))
def test_pieces_count_as_the_whole(counter, text, size):
    pieces = K.cut(text, counter.boundary, size)
    assert "".join(pieces) == text
    assert counter.counts([text], size, 16) == [whole(counter, text)]


def test_long_texts_are_cut_and_stretches_without_boundary_stay(counter):
    prose = "plain words, and more. " * 20_000
    assert len(K.cut(prose, counter.boundary)) > 5
    joined = "漢字。" * 60_000
    assert len(K.cut(joined, counter.boundary)) > 1
    solid = "x" * 200_000
    assert K.cut(solid, counter.boundary) == [solid]
    assert counter.counts([prose, None, joined, ""]) == [whole(counter, prose), 0, whole(counter, joined), 0]


def test_batches_are_balanced_by_bytes():
    pieces = [(i, "ab" * n) for i, n in enumerate([5, 5, 5, 100, 1, 1])]
    got = list(K.balanced(pieces, 25))
    assert [[i for i, _ in b] for b in got] == [[0, 1], [2], [3], [4, 5]]


def test_no_boundary_where_settings_do_not_warrant_one():
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    assert K.safe_boundary(spec) is not None
    assert K.safe_boundary(spec | {"normalizer": {"type": "NFC"}}) is None
    assert K.safe_boundary(spec | {"added_tokens": [{"content": "<x>", "lstrip": True}]}) is None
    blank = K.safe_boundary(spec | {"added_tokens": [{"content": "a b"}]})
    assert not blank.search("word word") and blank.search("word\nword")


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 9), (1, "<|endoftext|> a", 9), (None, "", 9), (2, "a " * 2000, 9)],
                               "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_bytes): (r.n_tokens, r.over_limit)
           for r in K.token_counts(df, K.TokenCounter(spark, PATH)).collect()}
    assert got == {(1, 0): (0, False), (1, 15): (2, False), (None, 0): (0, False), (2, 4000): (2001, True)}
    assert K.token_counts(df.limit(0), K.TokenCounter(spark, PATH)).count() == 0


def test_query_equals_the_library_on_every_document(spark, counter):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in registry.op13_token_counts(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = {r.doc_id: (len((r.text or "").encode()), n := whole(counter, r.text or ""), n > 1024) for r in docs}
    assert got == want


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=40).map("".join))
def test_parts_lie_between_safe_boundaries(counter, text):
    parts = counter.part.findall(text)
    assert "".join(parts) == text
    ends = [m for m in range(1, len(text)) if counter.boundary.fullmatch(text, m - 1, m + 1)]
    assert [sum(map(len, parts[:k])) for k in range(1, len(parts))] == ends
    assert counter.by_parts([text]) == counter.encoded([text]) == [whole(counter, text)]


def test_a_part_is_encoded_once_and_forgotten_when_unused(monkeypatch):
    with open(PATH, encoding="utf-8") as f:
        c = K.Counter(f.read())
    asked, plain = [], c.encoded
    monkeypatch.setattr(c, "encoded", lambda texts: asked.extend(texts) or plain(texts))
    monkeypatch.setattr(K, "CACHE_ENTRIES", 40)
    want = [len(e) for e in c.tokenizer.encode_batch(["the same, the same words" * 50, "x" * 300], add_special_tokens=False)]
    for _ in range(3):
        assert c.counts(["the same, the same words" * 50, "x" * 300]) == want
    assert asked.count(" same") == 1 and asked.count("x" * 300) == 3  # long parts are not remembered
    for i in range(100):
        text = f"the same new{i} odd{i} words"
        assert c.counts([text]) == [whole(c, text)]
        assert len(c.known) <= 40 + 10 and len(c.older) <= 40 + 10
    assert asked.count(" same") == 1 and "new0" not in c.known
    spec = json.loads(c.tokenizer.to_str())
    assert K.part_pattern(spec | {"normalizer": {"type": "NFC"}}) is None
