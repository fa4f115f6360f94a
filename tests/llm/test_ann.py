import math

import numpy as np

from quire.llm import ann
from quire.llm.registry import op5_neighbours

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(rows, k=5):
    valid = [(i, np.asarray(v, float)) for i, v in rows
             if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = []
    for q, x in {i: x for i, x in valid}.items():
        if q % 50 == 0:
            scored = sorted((-float(x @ y) / float(np.linalg.norm(x) * np.linalg.norm(y)), i) for i, y in valid if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, path, rows):
    spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).write.parquet(f"{path}/embeddings.parquet")
    return sorted(tuple(r) for r in op5_neighbours(spark, str(path)).select("query_id", "rank", "vec_id", "score").collect())


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-9)


def test_small_tables_with_odd_vectors_and_hot_copies(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(8).astype("float32")]) for i in range(300)]
    hot = rows[7][1]
    rows += [(1000 + i, hot) for i in range(200)]
    rows += [(5000, None), (5050, []), (5100, [0.0] * 8), (5150, [1.0] * 7 + [None]), (5200, [float("nan")] * 8),
             (5250, [float("inf")] + [1.0] * 7), (None, hot)]
    same(run(spark, tmp_path / "a", rows), brute(rows))


def test_few_rows_and_none(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [0.0, 2.0])]
    same(run(spark, tmp_path / "a", rows), brute(rows))
    assert run(spark, tmp_path / "b", []) == []
    assert run(spark, tmp_path / "c", [(1, [1.0, 2.0])]) == []


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {(q, i) for q, _, i, _ in brute(rows)}
    got = {(r.query_id, r.vec_id) for r in op5_neighbours(spark, sf).collect()}
    assert len(want & got) / len(want) >= 0.9


def test_estimates_lie_within_their_bounds():
    rng = np.random.default_rng(5)
    x = ann.units(rng.standard_normal((4000, 64)))
    index = ann.fit(x, 40)
    cluster, codes, length, align = index.encode(x)
    guess, bound = ann.estimate(index, cluster, x[:50], codes, length, align)
    truth = x[:50] @ x.T
    assert (np.abs(guess - truth) <= bound).mean() > 0.93
    assert abs((guess - truth).mean()) < 0.01


def test_large_clusters_are_split_and_small_ones_share():
    first, parts = ann.shards(np.array([10, 50_000, 5, 19_990, 19_990]))
    assert parts.tolist() == [1, 3, 1, 1, 1] and first.tolist() == [0, 1, 4, 4, 5]
