"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from quire.llm import registry
from quire.llm import spelling as S

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    out = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                out[w] += 1
    return {w: n for w, n in out.items() if n >= 2}


def shorter(w):
    return {w[:k] + w[k + 1:] for k in range(len(w))}


def plainly_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return a in shorter(b) or b in shorter(a)


def brute(rows):
    """Near words by a table of deletions, each verified plainly."""
    n = plain_words(rows)
    slots = {}
    for w in n:
        for s in {w, *shorter(w)}:
            slots.setdefault(s, []).append(w)
    near = {w: set() for w in n}
    for group in slots.values():
        for a in group:
            near[a].update(b for b in group if plainly_near(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out[w] = (f, root, n[w], len(near[w]), n[f] if f else None)
    return out


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


SCHEMA = "doc_id long, text string, n int, word string"


def test_variants_of_random_words_equal_brute_force(spark):
    rng = random.Random(9)
    base = ["separate", "definitely", "Été" * 3, "aaaaaaa", "aaaaaaaa", "abababab", "overflowing", "x" * 300, "ÿÀÿÀÿÀÿ"]
    rows = []
    for i in range(400):
        words = []
        for w, weight in zip(rng.choices(base, k=6), rng.choices([0, 0, 0, 1, 2], k=6)):
            for _ in range(weight):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("ab") + w[k:], w[:k] + rng.choice("ab") + w[k + 1:]])
            words.append(w.upper() if rng.random() < .1 and w.isascii() else w)
        rows.append((i, rng.choice([" ", ", ", "1"]).join(words), 0, "clash"))
    rows += [(None, "separate separate definitely", 0, None), (3, None, 0, None), (3, "", 0, None), *rows[:30]]
    rows += [(500 + i, "definitely separate overflowing", 0, "") for i in range(3000)]
    got = result(S.spelling_variants(spark.createDataFrame(rows, SCHEMA)))
    want = brute([r[:2] for r in rows])
    assert got == want
    assert any(f for f, *_ in got.values())


def test_chains_of_forms(spark):
    words = [("chainword", 2000), ("chainwordx", 200), ("chainwordxy", 20), ("chainwordxyz", 2)]
    links = spark.createDataFrame([(b, a) for (a, _), (b, _) in zip(words, words[1:])], "word string, form string")
    assert {r.root for r in S.roots(links).collect()} == {"chainword"}


def test_empty(spark):
    assert S.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []


WORD = st.text(alphabet="abÿ", min_size=7, max_size=10)


@settings(max_examples=300, deadline=None)
@given(WORD, WORD, st.integers(0, 9), st.sampled_from(["insert", "delete", "replace", "none"]))
def test_one_edit(a, other, k, how):
    k %= len(a)
    b = {"insert": a[:k] + "a" + a[k:], "delete": a[:k] + a[k + 1:], "replace": a[:k] + "b" + a[k + 1:], "none": other}[how]
    assert S.one_edit(*sorted((a, b), key=len)) == plainly_near(a, b)


def test_products_keep_every_near_pair_and_long_counts_stay_exact():
    words = ["q" * 9000, "q" * 8999 + "z", "q" * 9001, "z" * 9000]
    i, j = S.close_pairs(words, np.zeros(4, int), np.full(4, 9000))
    assert set(zip(i.tolist(), j.tolist())) == {(0, 1), (0, 2)}


def test_slabs_hold_whole_blocks():
    g = np.repeat([1, 2, 3, 4, 5], [3, 1, 10, 2, 2])
    got = list(S._slabs(g, 5))
    assert got == [(0, 4), (4, 14), (14, 18)]


def test_blocks_go_on_across_batches():
    words = ["abcdefgh", "abcdefgx", "abcdefgy"]
    rows = [{"g": 5, "m": 8, "tail": False, "tile": 0, "across": False, "word": w, "n": k + 2} for k, w in enumerate(words)]
    schema = pa.schema([("g", pa.int64()), ("m", pa.int64()), ("tail", pa.bool_()), ("tile", pa.int32()),
                        ("across", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])
    out = [r for b in S._near([pa.RecordBatch.from_pylist([r], schema) for r in rows]) for r in b.to_pylist()]
    assert len(out) == 6 and {(r["word"], r["other_n"]) for r in out} == {(w, n) for k, w in enumerate(words) for n in (2, 3, 4) if n != k + 2}


def test_large_blocks_are_tiled(spark):
    # One head of four letters shared by more words than a tile holds.
    rng = random.Random(1)
    words = {"head" + "".join(rng.choices("abcdefghij", k=4)) for _ in range(4000)}
    assert len(words) > 2 * S.TILE
    df = spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n long")
    got = {(r.word, r.other) for r in S.near_words(df).collect()}
    want = {(a, b) for a in words for k in range(4, 8) for c in "abcdefghij" if (b := a[:k] + c + a[k + 1:]) in words and b != a}
    assert got == want


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(registry.op11_spelling_variants(spark, SF_SMALL)) == brute(rows)
