"""Source divergence against a plain walk over all documents."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from conftest import SF_SMALL
from quire.llm import divergence as D
from quire.llm import registry

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string"


def plain_terms(text):
    return [t.translate(LOW) for t in TERM.findall(text)]


def brute(rows, least):
    docs = [(plain_terms(t or ""), lang or "", source or "") for _, t, lang, source in rows]
    out = []
    for lang in sorted({d[1] for d in docs}):
        mine = [d for d in docs if d[1] == lang]
        seen = Counter(t for terms, _, _ in mine for t in set(terms))
        kept = {t for t, n in seen.items() if n >= least}
        counts = defaultdict(Counter)
        for terms, _, source in mine:
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, c in counts.items():
            pairs = [(o, sum(f(p(c, t), p(counts[o], t)) for t in kept)) for o in counts if o != s]
            terms = [(t, f(p(c, t), p(whole, t))) for t in kept if c[t] > 0 and p(c, t) > p(whole, t)]
            for part, found, top in (("pair", pairs, None), ("term", terms, 10)):
                ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:top]
                out += [(lang, s, part, item, value, r) for r, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def result(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def test_random_documents_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["a", "ab", "abc", "abcd", "abcdef", "abcdefg", "Élan", "élan", "x" * 13, "y" * 60, "y" * 61, "ü", "漢字", "漢"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 9))) + rng.choice(["", "-", "1", "\n"]),
             rng.choice(["en", "de", None, "xx"]), rng.choice(["s0", "s0", "s1", None, "é"])) for i in range(120)]
    rows += [(None, None, "en", "empty"), (7, "", None, None), (7, "solo", "only", "s0"), *rows[:5]]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("doc_id", "value")
    assert result(D.source_divergence(df, threshold=4)) == brute(rows, 4)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert D.source_divergence(df).collect() == []


def test_no_kept_terms_gives_pairs_of_zero(spark):
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b"), (3, None, "en", None)]
    got = result(D.source_divergence(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows, 10) and {r[4] for r in got} == {0} and len(got) == 6


@given(st.text(alphabet="aZ~@[`{\x7f\x80ÿé漢🙂 1-", max_size=30))
def test_terms_are_those_of_the_pattern(text):
    assert [t.decode() for t in D.terms_of(text.encode())] == plain_terms(text)


@given(st.integers(0, 10**13), st.integers(0, 10**13), st.integers(1, 10**9))
def test_smoothing_is_exact(count, rest, terms):
    got = D.smoothed(np.array([count]), np.array([count + rest]), terms)
    assert got[0] == 1 + 10**9 * (count + 2) // (count + rest + 2 * terms)


def test_refinement_discards_rare_prefixes_only(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(["abcdefgh abcdefgi", "abcdefgh", "abcdefgx", "abx ab", "ab abcdefgh"])]
    kept = D.refine(D.term_lists(spark.createDataFrame(rows, SCHEMA)), threshold=2)
    assert {bytes(r.term) for r in kept.collect()} == {b"ab", b"abcdefgh"}
    # "abc" is in four documents though none of these terms but one is in two.
    assert D.prefixes_of(b"abcdefgh abcdefgi abcx", D.Known("en", None, 3, None)) == {b"abc"}
    assert D.prefixes_of(b"abcdefgh abx abcdefgi", D.Known("en", None, 6, 3)) == {b"abcdef", b"abx"}
    assert D.prefixes_of(b"abcdefgh ab", D.Known("en", bytes(D.BITS // 8), 6, 3)) == set()


@pytest.mark.parametrize("stripe,cells", [(2, 7), (3, 10**6), (256, 1)])
def test_stripes_and_chunks_give_the_same_sums(monkeypatch, stripe, cells):
    rng = np.random.default_rng(3)
    size, terms = 7, 20
    counts = rng.integers(0, 4, (terms, size))
    totals = counts.sum(axis=0)

    def rows(width):
        out = []
        for k in range(terms):
            ids = np.flatnonzero(counts[k])
            for s in range(-(-size // width)):
                out.append({"lang": "en", "term": b"t%d" % k, "stripe": s, "sources": [f"s{x}" for x in ids],
                            "ns": counts[k, ids].tolist(), "names": [f"s{x}" for x in range(size)], "totals": totals.tolist(), "v": terms})
        schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("stripe", pa.int32()), ("sources", pa.list_(pa.string())),
                            ("ns", pa.list_(pa.int64())), ("names", pa.list_(pa.string())), ("totals", pa.list_(pa.int64())), ("v", pa.int64())])
        return pa.RecordBatch.from_pylist(out, schema)

    def total(batches):
        found = Counter()
        for b in batches:
            for r in b.to_pylist():
                found[r["i"], r["j"], r["term"]] += r["value"]
        return found

    want = total(D._compare([rows(256)]))
    monkeypatch.setattr(D, "STRIPE", stripe)
    monkeypatch.setattr(D, "CELLS", cells)
    assert total(D._compare([rows(stripe)])) == want


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(registry.op12_source_divergence(spark, SF_SMALL)) == brute(rows, 10)


def test_terms_let_through_by_chance_are_not_counted(spark):
    """Every occurrence of the kept terms is counted once, in one list of a document's terms,
    whatever the table of survivors lets through."""
    rows = [(i, "aa bb aa " + ("cc aa" if i == 0 else "bb"), "en", f"s{i % 2}") for i in range(4)]
    lists = D.term_lists(spark.createDataFrame(rows, SCHEMA))
    assert {bytes(r.every) for r in lists.collect()} == {b"aa bb aa cc aa", b"aa bb aa bb"}
    kept = spark.createDataFrame([("en", bytearray(b"aa"))], "lang string, term binary")
    table, D.bit_table = D.bit_table, lambda pieces: b"\xff" * (D.BITS // 8)
    try:
        got = {bytes(r.term): sorted(map(tuple, r.found)) for r in D.term_counts(lists, kept).collect()}
    finally:
        D.bit_table = table
    assert got == {b"aa": [("s0", 5), ("s1", 4)]}


@pytest.mark.parametrize("chunk", [1, 400, 1 << 23])
def test_blocks_count_what_the_documents_hold(monkeypatch, chunk):
    """Terms are written once a block, not once a document, and the counts are the documents'."""
    monkeypatch.setattr(D, "CHUNK", chunk)
    rng = random.Random(9)
    words = ["a", "abc", "abcd", "abcdefg", "abcdefgh", "abcdefghi", "Élan", "élan", "漢字", "y" * 40, "y" * 41]
    rows = [{"lang": rng.choice(["en", "de", ""]), "source": rng.choice(["s0", "s1", "é", ""]),
             "text": rng.choice(["", " ", "1\n"]).join(rng.choices(words, k=rng.randint(0, 12))).encode()} for _ in range(300)]
    rows += [{"lang": "only", "source": "s", "text": b""}]
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("text", pa.binary())])
    batches = [pa.RecordBatch.from_pylist(rows[k:k + 100], schema) for k in range(0, len(rows), 100)]
    got = [r for b in D._blocks(batches) for r in b.to_pylist()]
    assert len(got) == (4 if chunk == 1 << 23 else len(rows) if chunk == 1 else len(got))
    assert sum(r["documents"] for r in got) == len(rows)
    assert {(r["lang"], s) for r in got for s in r["sources"]} == {(r["lang"], r["source"]) for r in rows}
    assert all(len(set(r["terms"].split())) == len(r["terms"].split()) for r in got)

    times = Counter()
    for r in got:
        terms, spread, which, n = D._counts_of(r)
        for term, k, c in zip(np.repeat(terms.to_pylist(), spread), which, n):
            times[r["lang"], r["sources"][k], bytes(term)] += int(c)
    assert times == Counter((r["lang"], r["source"], t) for r in rows for t in D.terms_of(r["text"]))

    table = np.zeros(D.BITS // 8, np.uint8)  # of the prefixes of four bytes, all but "abcd" survive
    for lang in ("en", "de", "", "only"):
        known = D.Known(lang, None, 4, None)
        for piece in {p for r in rows for p in D.prefixes_of(r["text"].translate(D._FOLD), known)} - {b"abcd"}:
            slot = D.zlib.crc32(piece, known.salt) & D.BITS - 1
            table[slot >> 3] |= 1 << (slot & 7)
    for args in ((None, 4, None), (table.tobytes(), 8, 4), (None, 32, 16)):
        found, want = Counter(), Counter()
        for r in got:
            pieces, docs = D.prefix_counts(r, D.Known(r["lang"], *args))
            found.update({(r["lang"], p): int(n) for p, n in zip(pieces.to_pylist(), docs)})
        for r in rows:
            want.update((r["lang"], p) for p in D.prefixes_of(r["text"].translate(D._FOLD), D.Known(r["lang"], *args)))
        assert found == want and want


@pytest.mark.parametrize("most", [1, 10**6])
def test_packs_of_a_bucket_are_added_up(monkeypatch, most):
    monkeypatch.setattr(D, "COUNTS", most)
    rows = [D.block(lang, [(s, b"aa bb " * n) for s, n in found]) | {"bucket": 0} for lang, found in (
        ("en", [("x", 1), ("y", 300)]), ("en", [("z", 2), ("y", 70000)]), ("de", [("x", 5)]), ("en", [("x", 4)]))]
    got = [r for b in D._added([pa.RecordBatch.from_pylist(rows)]) for r in b.to_pylist()]
    assert {(r["lang"], r["term"]): sorted((x["source"], x["n"]) for x in r["found"]) for r in got} == {
        (lang, t): n for t in (b"aa", b"bb") for lang, n in (("en", [("x", 5), ("y", 70300), ("z", 2)]), ("de", [("x", 5)]))}
