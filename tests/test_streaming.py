from pyspark.sql import functions as F

from quire.streaming.replies import REPLY_SCHEMA, start_card_stream


def test_stream_validates_new_reply_files(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    g = '{"front":"q","back":"a","card_type":"basic"}'
    batch1 = [(1, "b", "L", '{"cards":[' + g + "," + g + "]}"), (2, "b", "L", "no json")]
    spark.createDataFrame(batch1, REPLY_SCHEMA).write.mode("append").parquet(str(src))
    q = start_card_stream(spark, str(src), str(out), str(ck), available_now=True)
    q.awaitTermination(120)
    batch2 = [(3, "c", "L", '```json\n{"cards":[' + g + "]}\n```")]
    spark.createDataFrame(batch2, REPLY_SCHEMA).write.mode("append").parquet(str(src))
    q = start_card_stream(spark, str(src), str(out), str(ck), available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(str(out)).groupBy("reply_id").agg(F.count("*").alias("n")).collect()
    assert sorted((r.reply_id, r.n) for r in got) == [(1, 2), (3, 1)]
