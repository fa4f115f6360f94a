import hashlib

from pyspark.sql import functions as F

from quire.llm import fingerprint as fp
from quire.llm.registry import op3_fingerprints


def lanes(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    return {r.k: r.lanes for r in fp.lanes_by(df, "t", ["k"]).collect()}


def test_order_free_and_incremental(spark):
    got = lanes(spark, ["a b c.\nd e f.\nx", "x\nd e f.\na b c.", "a b c.\nd e f.", "x", "a b c.\nd e f.\ny"])
    assert got[0] == got[1] != got[2] and got[4] != got[0]
    df = spark.createDataFrame([(got[0], got[2], got[3])], "a array<long>, b array<long>, c array<long>")
    row = df.select(fp.add_lanes("b", "c") == F.col("a"), fp.subtract_lanes("a", "c") == F.col("b")).first()
    assert tuple(row) == (True, True)


def brute_edits(rows):
    ids = sorted({d for d, _ in rows if d is not None})
    head = {d: min(t or "" for e, t in rows if e == d) for d in ids}
    out = []
    for d, t in rows:
        t = t or ""
        k = len(t) // 4
        nxt = head[ids[(ids.index(d) + 1) % len(ids)]] if d is not None else ""
        out.append((d, len(t), hashlib.sha256((t[:len(t) - k] + nxt[:k]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, tmp_path):
    prose = [f"Alpha{i} beta gamma{i}. Delta eps{i}.\nZeta{i} eta theta, iota{i} kappa." * (1 + i % 3) for i in range(40)]
    rows = [(i * 7, t) for i, t in enumerate(prose)] + [(1000, None), (1001, ""), (1002, "é" * 9), (21, prose[3]),
                                                        (None, "no id here at all."), (1003, "w " * 30_000)]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, next_id int")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op3_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == brute_edits(rows)
    twins = {r.fingerprint for r in got if r.doc_id == 21}
    assert len(twins) == 1 and len([r for r in got if r.doc_id == 21]) == 2
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert {r.near_edited for r in got if r.doc_id == 1000} == {1.0}
    df.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert op3_fingerprints(spark, f"{tmp_path}/empty").count() == 0


def test_one_document_follows_itself(spark, tmp_path):
    spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = op3_fingerprints(spark, str(tmp_path)).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0


def test_likeness_tells_edits_from_strangers(spark):
    rows = op3_fingerprints(spark, "/root/testdata/sf0.001").collect()
    long = [r for r in rows if r.n_chars > 1500]
    near = sorted(r.near_edited for r in long)[len(long) // 2]
    far = sorted(r.near_next for r in long)[len(long) // 2]
    assert near > 0.5 > far + 0.2


def test_no_python_in_the_plan(spark):
    plan = op3_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
