import hashlib
import struct

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import bpe
from quire.llm.registry import VOCABULARY, op2_bpe

TOKENS = bpe.load_ranks(P.path(VOCABULARY))
CODEC = bpe.Codec(TOKENS, bpe.serialise_model(TOKENS), P.PATTERN)
TRUTH = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)},
                          special_tokens={})


def ids(text):
    return list(struct.unpack(f"<{len(CODEC.encode(text)) // 4}I", CODEC.encode(text)))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\ta'sreé1漢՘", max_size=80))
def test_ids_equal_the_library_and_round_trip(text):
    assert ids(text) == TRUTH.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


def test_every_token_is_reached():
    assert all(ids_ == [i] for i, ids_ in enumerate(CODEC.sp.encode(
        [t.decode("latin-1").translate(CODEC.alphabet) for t in TOKENS])))


def test_long_pre_tokens_and_a_full_memory(monkeypatch):
    text = "ab" * 50_000 + " " * 20_000 + "x"
    assert ids(text) == TRUTH.encode_ordinary(text)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    many = " ".join(f"w{i} ü{i}" for i in range(50))
    assert ids(many) == TRUTH.encode_ordinary(many)


def test_generations_chunks_and_long_words_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 8)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 40)
    codec = bpe.Codec(TOKENS, bpe.serialise_model(TOKENS), P.PATTERN)
    texts = ["", "the cat sat", "x" * 30 + " the cat"] + [f"w{i % 7}q the ü{i % 3} " + "long" * 4 for i in range(40)]
    for _ in range(3):
        got = codec.encode_many(texts)
        assert [list(struct.unpack(f"<{len(g) // 4}I", g)) for g in got] == [TRUTH.encode_ordinary(t) for t in texts]
        assert len(codec.known) <= 5 + 40 and not any(len(w) > 8 for w in codec.known)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=[chr(c) for c in range(128)], max_size=60))
def test_ascii_texts_split_as_the_library_splits_them(text):
    assert CODEC.ascii.pattern != P.PATTERN
    assert CODEC.split(text) == CODEC.pattern.findall(text)
    assert ids(text) == TRUTH.encode_ordinary(text)


def test_query_on_nulls_repeats_and_empty_tables(spark, tmp_path):
    rows = [(1, "Hello wörld", 1), (1, "Hello wörld", 1), (2, None, 2), (3, "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op2_bpe(spark, str(tmp_path)).collect()}
    want = set()
    for d, text, _ in rows:
        t = TRUTH.encode_ordinary(text or "")
        want.add((d, len(t), hashlib.sha256(struct.pack(f"<{len(t)}I", *t)).hexdigest(),
                  hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == want and op2_bpe(spark, str(tmp_path)).count() == 4
    df.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert op2_bpe(spark, f"{tmp_path}/empty").count() == 0
