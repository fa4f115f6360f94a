import math
import re
import zlib
from collections import Counter

import numpy as np

from quire.llm import pitmanyor as py
from quire.llm.registry import op9_pitman_yor

SF = "/root/testdata/sf0.01"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "</s>"]


def brute(rows):
    counts = Counter()
    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 7 != 2:
            counts.update(words(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        w = words(t)
        out.append((d, d is not None and zlib.crc32(str(d).encode()) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), total,
                    sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)))
    return out


def compare(got, want):
    def key(r):
        return (str(r[0]), r[2], r[5])

    got, want = sorted([tuple(r)[:6] for r in got], key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def test_base_scores_and_held_out_perplexity(spark, monkeypatch):
    monkeypatch.setattr(py, "BUCKET_BYTES", 300_000)  # several buckets and split words
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op9_pitman_yor(spark, SF).collect()
    compare(got, brute(rows))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_splitting_frequent_words_changes_no_count(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120).cache()
    one = {r.doc_id: r for r in py.score_documents(docs).collect()}
    monkeypatch.setattr(py, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(py, "HOT_SAMPLE", 0.9)
    many = {r.doc_id: r for r in py.score_documents(docs).collect()}
    for d, r in one.items():
        assert r[:5] == many[d][:5] and abs(r.base_score - many[d].base_score) < 1e-6
        assert abs(r.score - many[d].score) < 0.01 * abs(r.score)


def test_probabilities_of_a_context_sum_to_one(spark):
    texts = ["a b a c", "a b b", "c a b d", "a a a b"]
    rows = [(i, t) for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    seen = {w for _, t in rows for w in words(t)}
    # Every continuation after a text's last word, the unknown word included.
    asks = [(100 + 7 * i, "a " + w) for i, w in enumerate(sorted(seen - {"</s>"}) + ["unseen"])]
    asks = [(d, t) for d, t in ((next(x for x in range(d, d + 999) if zlib.crc32(str(x).encode()) % 7 == 2), t) for d, t in asks)]
    held = [(next(x for x in range(5000, 5999) if zlib.crc32(str(x).encode()) % 7 == 2), "a")]
    df = spark.createDataFrame(rows + asks + held, "doc_id long, text string")
    buckets = py.pack_documents(df.selectExpr("monotonically_increasing_id() row", "doc_id", "text"), {}, 1).toPandas()
    b = py.Bucket(buckets.blobs[0])
    totals = py.train(py.pack_documents(df.selectExpr("monotonically_increasing_id() row", "doc_id", "text"), {}, 1), {})
    context = int(py.mix(py.tokens("a")[:1])[0] % np.uint64(py.CONTEXTS))
    sweep, tables, customers, root_tables = list(b.sweeps(totals, 1))[-1]
    parent = b.parent(customers, root_tables, totals, 1)
    assert abs(parent[np.isin(b.words, [w for w, n in zip(b.words, b.word_count) if n > 0])].sum()
               + (py.STRENGTH + totals.root_discount * totals.root_tables[1]) / (totals.words + 1) / (
                   py.STRENGTH + totals.root_customers[1]) - 1) < 1e-9
    inside = (b.context == context) & (b.customers > 0)
    taken = (b.customers - totals.discount * tables)[inside].sum()
    rest = py.STRENGTH + totals.discount * totals.context_tables[1][context]
    assert abs((taken + rest) / (py.STRENGTH + totals.context_customers[context]) - 1) < 1e-9


def test_seating_follows_the_restaurant():
    n = np.full(20_000, 10)
    key = py.mix(np.arange(20_000, dtype=np.uint64))
    t = py.seat(n, np.full(20_000, 0.2), 0.5, 1.0, 4.0, key, 1)
    rng = np.random.default_rng(0)
    plain = []
    for _ in range(20_000):
        tables = 1
        for i in range(1, 10):
            new = (1.0 + 0.5 * 4.0) * 0.2
            tables += rng.random() < new / (new + i - 0.5 * tables)
        plain.append(tables)
    assert abs(t.mean() - np.mean(plain)) < 0.05 and abs(t.std() - np.std(plain)) < 0.05
    assert (t >= 1).all() and (t <= 10).all()
    assert (py.seat(n, np.full(20_000, 0.2), 0.5, 1.0, 4.0, key, 1) == t).all()


def test_nulls_repeats_long_texts_and_empty_tables(spark, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (1, "b"), (2, None), (3, ""), (None, "x y"), (4, "w " * 70_000), (5, "é É\x85x\ta")]
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    compare(op9_pitman_yor(spark, str(tmp_path)).collect(), brute(rows))
    df.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert op9_pitman_yor(spark, f"{tmp_path}/empty").count() == 0


def test_rows_are_numbered_once(spark, tmp_path, monkeypatch):
    big = (1 << 53) + 1  # not a double
    rows = [(i, f"word{i % 7} word{i % 11} b{i}") for i in range(300)] + [(None, "x y"), (big, "x"), (big, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    train = py.train

    def train_then_split_anew(*args):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # as after a loss of executors: other splits
        return train(*args)

    monkeypatch.setattr(py, "train", train_then_split_anew)
    try:
        got = py.score_documents(docs).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    compare(got, brute(rows))
    assert len(got) == len(rows)


def test_every_previous_word_has_its_own_restaurant(spark):
    """Contexts that share the lowest 12 bits, over several buckets and parts."""
    seen, pair = {}, None
    for i in range(10_000):
        h = int(py.mix(py.tokens(f"p{i}")[:1])[0]) % 4_096
        if h in seen:
            pair = seen[h], f"p{i}"
            break
        seen[h] = f"p{i}"
    u, v = pair
    texts = [f"{u} x {u} y {u} x", f"{v} z", f"{v} x {v} x {v} w {v} q", f"o {u}"] * 5
    ids = [d for d in range(200) if zlib.crc32(str(d).encode()) % 7 != 2]
    df = spark.createDataFrame([(r, ids[r], t) for r, t in enumerate(texts)], "row long, doc_id long, text string")
    totals = py.train(py.pack_documents(df, {}, 6), {})
    after = Counter()
    for t in texts:
        w = words(t)
        after.update(zip(w[:-1], w[1:]))
    for word in (u, v, "x", "o"):
        context = int(py.mix(py.tokens(word)[:1])[0] % np.uint64(py.CONTEXTS))
        assert totals.context_customers[context] == sum(n for (a, _), n in after.items() if a == word)
        assert totals.context_tables[0][context] == sum(a == word for a, _ in after)
    assert totals.context_customers[py.CONTEXTS] == len(texts)


def test_coded_words_change_nothing_and_old_sums_go(spark):
    """Words sent as two bytes give the same dishes and postings, sorted once when a bucket
    is packed; only the last sweep's sums stay on disk."""
    from pathlib import Path

    from quire.llm.common import shared_dir

    texts = [f"a b a c x{i % 5} y{i} a" for i in range(40)] + ["", None, "a " * 70_000]
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, doc_id long, text string").coalesce(1)
    frequent = [int(h) for h in py.tokens("a b c x1")]
    plain = {r.bucket: r for r in py.pack_documents(df, {}, 3).collect()}
    coded = {r.bucket: r for r in py.pack_documents(df, {}, 3, frequent).collect()}
    assert plain.keys() == coded.keys()
    for k, r in plain.items():
        assert r.blobs == coded[k].blobs and r.postings == coded[k].postings
    assert sum(int(py.Postings(r.postings).count.sum()) for r in plain.values()) == sum(len(words(t)) for t in texts)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("stage-sums-*"))
    py.train(py.pack_documents(df, {}, 3), {})
    assert len(set(folder.glob("stage-sums-*")) - before) == 1


def test_numbers_of_contexts_travel_narrowly():
    keys = np.array([3, 9, 1 << 63], np.uint64)
    values = [np.array([1.0, 0.0, 255.0]), np.array([2, 256, 65_535]), np.array([1.0, 65_536, 4]), np.array([0, 1 << 40, 7])]
    blob = py.pack_contexts(11, keys, values)
    bucket, got, back = py.parse_contexts(blob, 4)
    assert bucket == 11 and (got == keys).all()
    assert [v.tolist() for v in back] == [v.tolist() for v in values]
    assert [v.itemsize for v in back] == [1, 2, 4, 8] and len(blob) == 16 + 4 + 3 * (8 + 15)


def test_the_exchange_adds_up_and_sends_no_contexts_back(spark):
    """A bucket finds its contexts' totals by the order in which it asked for them."""
    rng = np.random.default_rng(1)
    parts, keys = 3, {b: np.unique(rng.integers(0, 60, 40).astype(np.uint64) << np.uint64(20)) for b in (5, 6)}
    own = {b: [k % np.uint64(7) + np.uint64(300), (k >> np.uint64(20)) * np.uint64(b)] for b, k in keys.items()}
    rows = [(int((k[at[0]] >> np.uint64(20)) % np.uint64(parts)), bytearray(py.pack_contexts(b, k[at], [v[at] for v in own[b]])))
            for b, k in keys.items() for at in py.by_part(k, parts)]
    got = py.exchange(spark.createDataFrame(rows, "part long, blob binary"), 2, 1, 2).collect()
    assert {r.bucket for r in got} == {5, 6}
    for r in got:
        assert sum(map(len, r.contexts)) < 8 * len(keys[r.bucket]) + 18 * parts  # less than the contexts alone
        totals = py.Totals(root_customers=[0.0], parts=parts).of_bucket(keys[r.bucket], r.contexts)
        assert (totals.context_customers[keys[r.bucket]] == own[r.bucket][0]).all()
        want = [sum(int(own[b][1][keys[b] == k][0]) for b in keys if k in keys[b]) for k in keys[r.bucket]]
        assert totals.context_tables[0][keys[r.bucket]].tolist() == want


def test_one_bucket_at_a_time_is_read(spark):
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(n) for n in names]
    with py.one_bucket_batches(spark):
        assert [spark.conf.get(n) for n in names] == ["1", "1"]
    assert [spark.conf.get(n) for n in names] == before


def test_sums_of_a_document_meet_packed(spark, monkeypatch):
    """Buckets send a blob for each part of the documents, not a row for each document."""
    docs = spark.createDataFrame([(r, r, f"a b{r % 5} c{r} d{r % 3}") for r in range(700)] + [(700, None, None)], "row long, doc_id long, text string")
    packed = py.staged_buckets(py.pack_documents(docs, {}, 6), 3)
    totals = py.train(packed, {}, 3)
    with py.one_bucket_batches(spark):
        got = py.score_buckets(packed, totals).collect()
        monkeypatch.setattr(py, "HELD", 3)
        apart = {r.row: r for r in py.score_buckets(packed, totals).collect()}
    assert all(abs(r.model - apart[r.row].model) < 1e-9 and r[:3] == apart[r.row][:3] for r in got) and len(apart) == 701
    assert sorted(r.row for r in got) == list(range(701))
    assert {r.row: r.n for r in got} == {**{r: 5 for r in range(700)}, 700: 1}
    made = []
    for n in (2, 3):  # the same document from several buckets
        made.append(py._blob([2, 1, 2], np.array([4, n]), np.array([1, n], np.uint8), np.array([0, 300], np.uint16),
                             np.array([-1.5, -2.0]), np.array([-1.0, float(-n)])))
    out = list(py.add_up([py.pa.RecordBatch.from_pylist([{"blobs": made}])]))[0].to_pylist()
    assert out == [{"row": 4, "n": 2, "k": 0, "base": -3.0, "model": -2.0}, {"row": 6, "n": 2, "k": 300, "base": -2.0, "model": -2.0},
                   {"row": 7, "n": 3, "k": 300, "base": -2.0, "model": -3.0}]
