import zlib

import numpy as np
from pyspark.sql import functions as F

from quire.llm import quality
from quire.llm.registry import op6_quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = op6_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 30 and np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_scores_equal_the_densities(spark):
    rng = np.random.default_rng(0)
    p = len(quality.FEATURES)
    x = np.concatenate([rng.standard_normal((300, p)), 1 + 2 * rng.standard_normal((200, p))])
    rows = [([float(a) for a in r], int(i >= 300)) for i, r in enumerate(x)]
    model = quality.fit(spark.createDataFrame(rows, "x array<double>, quality int"))
    mean, inverse, logdet = model.classes[1]
    cov = np.linalg.inv(inverse.T @ inverse)
    by_hand = -0.5 * (np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean))
    via_factor = -0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1)
    assert np.allclose(by_hand, via_factor) and abs(model.prior - 0.4) < 1e-12
    assert np.allclose(mean, x[300:].mean(axis=0))
    assert ((model.score(x) > 0.5) == (np.arange(500) >= 300)).mean() > 0.9


def test_nulls_repeats_empty_tables_and_one_class(spark, tmp_path):
    docs = [(i, "One sentence of words. And another line.\nMore text here, of course.") for i in range(30)]
    docs += [(100, None), (101, ""), (0, "x"), (0, "x"), (None, "y"), (102, "a " * 60_000)]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, x int, score int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(30)] + [(None, 0, 0), (100, None, 0), (3, 7, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = op6_quality(spark, str(tmp_path)).collect()
    assert len(got) == len(docs) and {r.score for r in got} == {1.0}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    labels_df = spark.read.parquet(f"{tmp_path}/labels.parquet")
    kept = quality.keep_good(df, labels_df)
    assert kept.columns == df.columns and kept.count() == len(docs)
    assert quality.quality_scores(df.limit(0), labels_df).count() == 0
    none = quality.quality_scores(df, labels_df.limit(0))
    assert {r.score for r in none.collect()} == {0.5}


def test_features_ignore_other_columns(spark):
    a = spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string")
    b = a.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.lit(9).cast("long"))
    x = [quality.features(d, "text", []).first().x for d in (a, b)]
    assert x[0] == x[1] and len(x[0]) == len(quality.FEATURES)
